"""Token counts with a whole-token shortcut.

A byte-pair vocabulary holds many strings that encode alone as one token. Which
ones is proved once, by running the merges on every vocabulary string. Pre-tokens in
the proven set count as one without merging; only the rest are merged, each
distinct word once per task as far as a bounded memory holds.

Defined results. A null text is empty and has no bytes and no tokens. Special
strings inside a text count as one token each, as the library finds them. Other
columns and repeated rows pass through; an empty table gives no rows. A text is
read whole but worked on in pieces cut before white space, where no pre-token,
special string or normal form spans the cut, so memory does not grow with it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from mailrisk.session import ship_with_tasks

ship_with_tasks(__name__)

_PIECE = 1 << 18
_LONGEST_KEPT = 64
_MOST_KEPT = 1 << 19
_CUT = regex.compile(r"[ \n]")


def _byte_characters() -> dict[str, int]:
    """Byte behind each character of a byte-level vocabulary: printable bytes
    stand for themselves, the others take the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + at): byte for at, byte in enumerate(hidden)}


def whole_tokens(definition: str) -> frozenset[str]:
    """Strings that, as a pre-token of their own, are proven to come out as one
    token: every vocabulary string is spelled out and run through the merges."""
    tokenizer = Tokenizer.from_str(definition)
    suffix = json.loads(definition)["model"].get("end_of_word_suffix") or ""
    bytes_of = _byte_characters()
    proven = set()
    for string in tokenizer.get_vocab(with_added_tokens=False):
        if not string.endswith(suffix):
            continue
        try:
            spelled = bytes(bytes_of[character] for character in string[: len(string) - len(suffix)]).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        parts = tokenizer.pre_tokenizer.pre_tokenize_str(spelled)
        if len(parts) == 1 and parts[0][1] == (0, len(spelled)) and len(tokenizer.model.tokenize(parts[0][0])) == 1:
            proven.add(spelled)
    return frozenset(proven)


class _Counts(dict):
    """Token counts by string: the whole tokens, and what has been counted lately."""

    def __init__(self, whole: frozenset[str], count: Callable[[str], int]):
        super().__init__(dict.fromkeys(whole, 1))
        self._whole, self._count, self[""] = whole, count, 0

    def __missing__(self, string: str) -> int:
        count = self._count(string)
        if len(string) <= _LONGEST_KEPT:
            if len(self) > len(self._whole) + _MOST_KEPT:
                self.clear()
                self.update(dict.fromkeys(self._whole, 1))
                self[""] = 0
            self[string] = count
        return count


class PreTokenCounter:
    """Counts tokens as the library does for one tokenizer definition (JSON);
    ``whole`` are its ``whole_tokens``.

    Spaces and line feeds always end a pre-token, so a text is first cut there.
    A string between them that is a whole token, or was met before, is one
    lookup; any other is normalised, cut into pre-tokens and, where those are
    not whole tokens, merged.
    """

    def __init__(self, definition: str, whole: frozenset[str]):
        self._tokenizer = Tokenizer.from_str(definition)
        self._model = self._tokenizer.model
        self._normalizer = self._tokenizer.normalizer
        self._splitter = self._tokenizer.pre_tokenizer
        self._special = _alternatives(self._tokenizer.get_added_tokens_decoder().values())
        self._pattern = _split_pattern(json.loads(definition)["pre_tokenizer"])
        self._simple = _simple_characters(self._pattern, self._tokenizer) if self._pattern else None
        self._words = _Counts(whole, self._count_word)
        self._whole = whole

    def _count_word(self, word: str) -> int:
        if self._simple is not None and self._simple.fullmatch(word):
            pre_tokens = self._pattern.findall(word.lower())
        else:
            normal = self._normalizer.normalize_str(word) if self._normalizer else word
            pre_tokens = [normal[start:end] for _, (start, end) in self._splitter.pre_tokenize_str(normal)]
        return sum(1 if part in self._whole else self._merge(part) for part in pre_tokens)

    def _merge(self, pre_token: str) -> int:
        if pre_token.isascii() and pre_token.isprintable():  # these bytes stand for themselves
            return len(self._model.tokenize(pre_token))
        return sum(len(self._model.tokenize(part)) for part, _ in self._splitter.pre_tokenize_str(pre_token))

    def _plain(self, text: str) -> int:
        return sum(map(self._words.__getitem__, text.replace("\n", " ").split(" ")))

    def count(self, text: str | None) -> int:
        total = 0
        for piece in _pieces(text or ""):
            if self._special is None or not self._special.search(piece):
                total += self._plain(piece)
                continue
            place = 0
            for found in self._special.finditer(piece):
                total += self._plain(piece[place : found.start()]) + 1
                place = found.end()
            total += self._plain(piece[place:])
        return total


def _alternatives(added: Iterable[AddedToken]) -> regex.Pattern | None:
    """The special strings of a definition; only plain ones are supported."""
    tokens = list(added)
    if any(token.lstrip or token.rstrip or token.single_word or token.normalized for token in tokens):
        raise ValueError("special strings that look at their surroundings are not supported")
    return regex.compile("|".join(regex.escape(token.content) for token in tokens)) if tokens else None


def _split_pattern(definition: dict) -> regex.Pattern | None:
    """The pattern whose matches are the pre-tokens, where the definition is one
    split followed by a byte mapping; otherwise the library cuts."""
    steps = definition.get("pretokenizers", [definition])
    split = steps[0]
    if any(step["type"] != "ByteLevel" for step in steps[1:]):
        return None
    if (
        split.get("type") == "Split" and split.get("invert") and split.get("behavior") == "Removed"
        and not any(step["use_regex"] or step["add_prefix_space"] for step in steps[1:])
    ):
        return regex.compile(split["pattern"]["Regex"])
    return None


def _simple_characters(pattern: regex.Pattern, tokenizer: Tokenizer) -> regex.Pattern:
    """Words of characters for which lower-casing and this pattern do what the
    library does.

    It is asked for each character below U+0250 (none of them composes with
    another) next to a letter, a digit and a sign; words with any other
    character are normalised and cut by the library.
    """
    agreed = []
    for code in range(0x21, 0x250):
        character = chr(code)
        probe = f"a{character}a1{character}1!{character}!"
        normal = tokenizer.normalizer.normalize_str(probe)
        theirs = [normal[start:end] for _, (start, end) in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        if probe.lower() == normal and pattern.findall(normal) == theirs:
            agreed.append(character)
    return regex.compile("[" + "".join(map(regex.escape, agreed)) + "]*")


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``_PIECE`` characters, cut before white space."""
    place = 0
    while len(text) - place > _PIECE:
        cut = _CUT.search(text, place + _PIECE)
        if cut is None:
            break
        yield text[place : cut.start()]
        place = cut.start()
    yield text[place:]


def count_tokens(documents: DataFrame, tokenizer_file: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``documents`` without ``text``, plus a struct ``tokens`` of ``n_bytes``,
    ``n_tokens`` and ``over_limit``, which replaces a column of that name.

    The definition (one file of a few MB) is read, and its whole tokens proven,
    where the job is planned; both travel with the tasks and are bounded by the
    vocabulary, so executors need no copy of the file.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = file.read()
    whole = whole_tokens(definition)
    rest = [name for name in documents.columns if name not in (text, "tokens")]
    given = F.coalesce(F.col(text).cast("string"), F.lit(""))
    packed = documents.select(
        F.struct(*(F.col(f"`{name}`") for name in rest)).alias("_row") if rest else F.lit(None).alias("_row"),
        F.octet_length(given).cast("long").alias("n_bytes"), given.alias("_text"),
    )
    schema = packed.drop("_text").schema.add("n_tokens", "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or PreTokenCounter(definition, whole)
            counts = [counter.count(value.as_py()) for value in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["_row", "n_bytes", "n_tokens"],
            )

    counted = packed.mapInArrow(count, schema)
    return counted.select(
        "_row.*",
        F.struct("n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")).alias("tokens"),
    )
