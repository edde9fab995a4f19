from __future__ import annotations

import random

import pytest

from mailrisk.llm import licenses
from mailrisk.llm.licenses import Match


def plain_align(left, right):
    """The same alignment by definition, recursively and with a quadratic search."""
    if not left or not right:
        return 0
    if left[0] == right[0]:
        return 1 + plain_align(left[1:], right[1:])
    if left[-1] == right[-1]:
        return 1 + plain_align(left[:-1], right[:-1])
    pairs = [(at, right.index(word)) for at, word in enumerate(left) if left.count(word) == 1 and right.count(word) == 1]
    if not pairs:
        return 0
    longest = increasing_runs(pairs)
    size = max(map(len, longest))
    total = 0
    run = next(run for run in longest if len(run) == size)
    a = b = 0
    for x, y in run:
        total += 1 + plain_align(left[a:x], right[b:y])
        a, b = x + 1, y + 1
    return total + plain_align(left[a:], right[b:])


def increasing_runs(pairs):
    best = [[pair] for pair in pairs]
    for at, pair in enumerate(pairs):
        for run in best[:at]:
            if run[-1][1] < pair[1] and len(run) >= len(best[at]):
                best[at] = [*run, pair]
    return best


def test_alignment_by_definition():
    chance = random.Random(8)
    for _ in range(300):
        words = [b"w%d" % at for at in range(chance.randint(3, 30))]
        left, right = chance.choices(words, k=chance.randint(0, 25)), chance.sample(words, chance.randint(0, len(words)))
        aligned = licenses.align(left, right)
        assert all(left[a] == right[b] for a, b in aligned)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(aligned, aligned[1:]))
        once = list(dict.fromkeys(left))  # without repeated words equally long runs leave equal gaps
        assert len(licenses.align(once, right)) == plain_align(once, right)
        numbers = [(at, chance.randrange(30)) for at in range(chance.randint(0, 20))]
        longest = max((len(run) for run in increasing_runs(numbers)), default=0)
        assert len(licenses._increasing(numbers)) == longest
    same = [b"a", b"b", b"c", b"d"]
    assert len(licenses.align(same, same)) == 4 and licenses.align(same, []) == []
    assert licenses._increasing([(0, 5), (1, 1), (2, 2), (3, 0), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]
    assert len(licenses.align([b"x", *same, b"y"], [b"a", b"q", b"c", b"d"])) == 3


def scan(spark, rows, templates=None, schema="doc_id long, text string", rule=Match()):
    known = licenses.default_templates(spark) if templates is None else spark.createDataFrame(templates, "template_id string, text string")
    result = licenses.scan_documents(spark.createDataFrame(rows, schema), known, rule)
    return [(r.doc_id, r.n_words, [(m.template_id, round(m.coverage, 3), m.start, m.end) for m in r.licenses]) for r in result.collect()]


def test_planted_licenses(spark):
    mit, words = licenses.TEMPLATES["mit"], "lorem ipsum dolor sit amet " * 40
    total = len(licenses.words_of(mit.encode()))
    changed = mit.replace("free of charge", "free of any charge").replace("merge, ", "")
    rows = [
        (1, words + mit + words), (2, words + changed.upper()), (3, words), (4, "ALL rights\n* reserved"),
        (5, mit[: len(mit) // 2]), (6, words + "Released under the MIT License." + words + "Licensed under CC BY-NC 4.0."),
        (7, mit + " " + mit), (8, "Released under some MIT of a License"),
    ]
    found = {doc_id: matches for doc_id, _, matches in scan(spark, rows)}
    assert found[1] == [("mit", 1.0, 200, 200 + total)] and found[3] == [] and found[5] == []
    assert found[2][0][:2] == ("mit", round((total - 1) / total, 3))
    assert found[4] == [("all-rights-reserved", 1.0, 0, 3)]
    assert [m[0] for m in found[6]] == ["cc-by-nc-4.0-line", "mit-line"] and found[7] == [("mit", 1.0, 0, total)]
    assert found[8] == []  # no three words in a row, so nothing to look at


def test_special_rows(spark):
    long = "x " * 200_000 + "All rights reserved"
    rows = [(None, None, "a"), (None, "", "a"), (1, long, "b"), (1, long, "b")]
    assert sorted(scan(spark, rows, schema="doc_id long, text string, licenses string"), key=str) == sorted(
        [(None, 0, []), (None, 0, [])] + [(1, 200_003, [("all-rights-reserved", 1.0, 200_000, 200_003)])] * 2, key=str
    )
    assert scan(spark, []) == []
    assert scan(spark, [(1, "All rights reserved")], templates=[]) == [(1, 3, [])]
    odd = [(None, "all rights"), ("e", ""), ("n", None), ("one", "Copyright"), ("two", "all rights"), ("two", "some rights")]
    assert scan(spark, [(1, "copyright some RIGHTS")], templates=odd) == [(1, 3, [("one", 1.0, 0, 1), ("two", 1.0, 1, 3)])]
    with pytest.raises(ValueError, match="template words"):
        scan(spark, [(1, "x")], rule=Match(most_words=2))


def test_every_place_that_reaches_the_coverage(spark):
    chance = random.Random(4)
    notices = {name: licenses.words_of(text.encode()) for name, text in licenses.TEMPLATES.items() if len(text) < 120}
    names, rule = sorted(notices), Match(everywhere=True)
    rows = [("Released under an MIT License",), (" ".join(w + (" so" if at % 2 else "") for at, w in enumerate("all rights reserved".split())),)]
    for _ in range(150):
        words = []
        for name in chance.choices(names, k=2):
            words += chance.choices(["lorem", "the", "license", "4", "by"], k=chance.randint(0, 9))
            for word in notices[name]:
                words += [] if chance.random() < 0.1 else [chance.choice(["x", "the", word.decode()]) if chance.random() < 0.2 else word.decode()]
                words += ["ipsum"] * (chance.random() < 0.3)
        rows.append((" ".join(words),))
    known = licenses.Templates([(name, licenses.TEMPLATES[name], "", "") for name in names], rule)
    found = scan(spark, [(at, *row) for at, row in enumerate(rows)], [(name, licenses.TEMPLATES[name]) for name in names], rule=rule)
    for at, _, matches in found:
        words, own = licenses.words_of(rows[at][0].encode()), {m[0]: m[1] for m in matches}
        for number, name in enumerate(names):
            size = len(notices[name])
            best = max(len(licenses.align(words[p : p + known.length(number)], notices[name])) for p in range(len(words)))
            assert best < 0.75 * size or own.get(name, 0) >= round(best / size, 3)  # shingles may add longer places
    assert "mit-line" in {m[0] for m in found[0][2]} and scan(spark, [(1, *rows[0])])[0][2] == []


def test_kin_licenses_are_told_apart(spark):
    texts = {
        "gpl-2.0-line": "This work is licensed under the GNU General Public License, version 2",
        "agpl-3.0-line": "this work is licensed under the GNU Affero General Public License, version 3",
        "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0", "cc-by-4.0-line": "Licensed under CC BY 4.0",
        "cc-by-nc-sa-4.0-line": "Licensed under CC BY-NC-SA 4.0",
        **{name: licenses.TEMPLATES[name] for name in ("bsd-2-clause", "bsd-3-clause", "isc", "lgpl-2.1", "lgpl-3.0", "gpl-2.0", "agpl-3.0", "mpl-2.0", "unlicense")},
    }
    found = scan(spark, list(enumerate(texts.values())), rule=Match(everywhere=True))
    assert [[m[0] for m in matches] for _, _, matches in found] == [[name] for name in texts]
    whole = scan(spark, [(1, licenses.TEMPLATES["mit-whole"])])[0][2]
    assert [m[:2] for m in whole] == [("mit", 1.0), ("mit-whole", 1.0)]
