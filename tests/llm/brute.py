"""Plain single-process versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repeated_words(words: list[str], size: int = 8) -> int:
    windows = Counter(tuple(words[at : at + size]) for at in range(len(words) - size + 1))
    places = set()
    for at in range(len(words) - size + 1):
        if windows[tuple(words[at : at + size])] > 1:
            places.update(range(at, at + size))
    return len(places)


def quality(rows, max_documents=10, max_share=0.0, max_removed=0.7):
    """``rows`` of (doc_id, text, host) -> {doc_id: measures}."""
    def lines(text):
        return [re.sub(" {2,}", " ", re.sub(r"[\x20\x09-\x0D]", " ", line).lower()).strip(" ") for line in text.split("\n")]

    texts = defaultdict(set)
    for _, text, host in rows:
        texts[host or ""].add(text or "")
    over = {}
    for host, own in texts.items():
        held = Counter(line for text in own for line in set(lines(text)) - {""})
        over[host] = {line for line, n in held.items() if n > max_documents and n > len(own) * max_share}
    result = {}
    for doc_id, text, host in rows:
        text = text or ""
        words, raw = WORD.findall(text), text.split("\n")
        gone = [line for line, key in zip(raw, lines(text)) if key in over[host or ""]]
        removed = sum(len(WORD.findall(line)) for line in gone)
        with_word = [line for line in raw if WORD.search(line)]
        repeat = repeated_words(words)
        failed = len(words) < 20 or 100 * repeat > 30 * len(words)
        result[doc_id] = (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(with_word) - len(set(with_word)), repeat, failed,
            not failed and not removed > max_removed * len(words), len(gone), removed,
        )
    return result


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)}


def near_groups(rows, size, percent=80):
    """``rows`` of (doc_id, text) -> {doc_id: (n_shingles, component, kept)}, all pairs compared."""
    sets = {doc_id: shingles(text, size) for doc_id, text in rows}
    parent = {doc_id: doc_id for doc_id in sets}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {doc_id: (len(sets[doc_id]), root(doc_id), root(doc_id) == doc_id) for doc_id in ids}


def cut_repeats(rows, size):
    words = {doc_id: WORD.findall(text or "") for doc_id, text in rows}
    first = {}
    for doc_id in sorted(words):
        for at in range(len(words[doc_id]) - size + 1):
            first.setdefault(tuple(words[doc_id][at : at + size]), doc_id)
    result = {}
    for doc_id, own in words.items():
        gone = set()
        for at in range(len(own) - size + 1):
            if first[tuple(own[at : at + size])] < doc_id:
                gone.update(range(at, at + size))
        result[doc_id] = (len(own), len(gone), sha(" ".join(w for at, w in enumerate(own) if at not in gone)))
    return result


def contaminated(rows, items, size=10):
    def folded(text):
        return FOLDED.findall((text or "").translate(LOWER))

    windows = []
    for item_id, text in items:
        words = folded(text)
        if words:
            span = min(size, len(words))
            windows += [(item_id, words[at : at + span]) for at in range(len(words) - span + 1)]
    result = {}
    for doc_id, text in rows:
        words, hit, found = folded(text), set(), set()
        for item_id, window in windows:
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item_id)
        result[doc_id] = (len(words), len(hit), sorted(str(item) for item in found if item is not None))
    return result


def damaged_rows(rows):
    """``rows`` of (conv_id, turn, role, text) -> the same after damage."""
    result = []
    for conv_id, turn, role, text in rows:
        named = ":".join(" " if value is None else str(value) for value in (conv_id, turn))
        fault = zlib.crc32(named.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        result += [(conv_id, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return result


def repaired_turns(rows):
    """``rows`` of (conv_id, turn, role, text), not damaged any more -> {conv_id: measures}."""
    nothing, letters = "", {}
    following, lacking = [2, 2, 3, 2], ["user", "user", "assistant", "user"]
    kept_state = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    told = defaultdict(list)
    for conv_id, turn, role, text in rows:
        tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        told[conv_id].append((turn is not None, turn or 0, tie, turn, role, text))
    result = {}
    for conv_id, own in told.items():
        own = [row[3:] for row in sorted(own)]
        faults, seen = [], set()
        for _, role, text in own:
            letters = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not letters else "duplicate" if (role, text) in seen else "truncated" if letters[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
        # Cheapest, then least, audit to the end from before each row in each state, with the rows it leaves.
        best = {0: (0, "", ()), 3: (0, "", ()), 2: (2, "I", (("assistant", nothing),)),
                1: (4, "II", (("user", nothing), ("assistant", nothing)))}
        for (_, role, text), fault in reversed(list(zip(own, faults))):
            here = {}
            for state in range(4):
                options = [(best[state][0] + 3, "D" + best[state][1], best[state][2])]
                extra = int(fault == "truncated")
                if fault not in ("blank", "duplicate"):
                    if role[:1] in kept_state[state]:
                        cost, audit, rest = best[kept_state[state][role[:1]]]
                        options.append((cost + extra, "K" + audit, ((role, text), *rest)))
                    cost, audit, rest = best[following[state]]
                    options.append((cost + 2 + extra, "R" + audit, ((lacking[state], text), *rest)))
                here[state] = min(options, key=lambda option: option[:2])
            for _ in range(4):
                for state in range(4):
                    cost, audit, rest = here[following[state]]
                    here[state] = min(here[state], (cost + 2, "I" + audit, ((lacking[state], nothing), *rest)), key=lambda option: option[:2])
            best = here
        turns = {turn for turn, _, _ in own if turn is not None}
        initials = "".join(role[:1] if role[:1] in "sua" and role else "?" for _, role, _ in own)
        cost, audit, rest = best[0]
        result[conv_id] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
            sum(initials[at : at + 2] not in ("su", "ua", "au") for at in range(len(own) - 1)),
            cost, audit, sha("\n".join(f"{role}:{text}" for role, text in rest)),
        )
    return result


def simhash_groups(rows, size, distance):
    """``rows`` of (doc_id, text) -> sorted (doc_id, fingerprint, component_id)."""
    prints = []
    for _, text in rows:
        words = [word.translate(LOWER) for word in WORD.findall(text or "")]
        grams = [" ".join(words[at : at + size]) for at in range(max(len(words) - size + 1, min(len(words), 1)))]
        hashes = [xxhash.xxh64_intdigest(gram.encode(), 42) for gram in grams]
        prints.append(sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64)))
    component = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = component[i], component[j]
                component = [b if one == a else one for one in component]
    least = {}
    for (doc_id, _), one in zip(rows, component):
        if doc_id is not None:
            least[one] = min(doc_id, least.get(one, doc_id))
    return sorted(((doc_id, f"{key:016x}", least.get(one)) for (doc_id, _), key, one in zip(rows, prints, component)), key=str)


def importance_draw(rows, target, longest=1, buckets=10_000, least_words=20, percent=10):
    """``rows`` of (doc_id, text), ``target`` texts -> sorted (doc_id, n_features, weight, score, rank)."""
    def grams(text):
        words = FOLDED.findall((text or "").translate(LOWER))
        return len(words), [
            zlib.crc32(" ".join(words[at : at + size]).encode()) % buckets
            for size in range(1, longest + 1) for at in range(len(words) - size + 1)
        ]

    found, aimed = [grams(text) for _, text in rows], Counter(one for text in target for one in grams(text)[1])
    corpus = Counter(one for _, own in found for one in own)
    s_all, t_all = corpus.total(), aimed.total()
    result = []
    for (doc_id, _), (n_words, own) in zip(rows, found):
        gains = [math.floor(1000 * math.log((aimed[b] + 1) * (s_all + buckets) / ((corpus[b] + 1) * (t_all + buckets)))) for b in own]
        weight = sum(gains) // len(gains) if gains else 0
        drawn = int(sha(f"2024:{'' if doc_id is None else doc_id}")[:8], 16)
        result.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 2**32))), n_words))
    fit = sorted((row for row in result if row[4] >= least_words), key=lambda row: (-row[3], row[0] is not None, row[0]))
    ranks = {id(row): rank for rank, row in enumerate(fit[: percent * len(fit) // 100], 1)}
    return sorted(((*row[:4], ranks.get(id(row))) for row in result), key=str)
