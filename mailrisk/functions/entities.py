"""HTML entity decoding as a native expression (HTML5 rules, one pass).

The text is cut before every ampersand that can start a reference, so each piece
starts with at most one. Names are looked up in packed strings built from the
standard library's HTML5 table, one per first letter: a plan holds them as plain
string literals, which the optimizer compares cheaply (large map literals cost
it half a second per use), and a lookup searches a few hundred bytes.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of a numeric and of a named reference.
_NUMERIC = r"\A&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
_NAMED = r"\A&[a-zA-Z][a-zA-Z0-9]*;"
_START = r"&[#a-zA-Z]"
_REPLACEMENT = "\ufffd"


# Before a packed key, and between a key and its value.
_ENTRY, _VALUE = "\x01", "\x02"
# Packed value of a control character that decodes to nothing.
_DROPPED = "\x03"


def _pack(table: dict[str, str]) -> str:
    return "".join(f"{_ENTRY}{key}{_VALUE}{value}" for key, value in table.items()) + _ENTRY


def _lookup(packed: Column, key: Column) -> Column:
    """Value of ``key`` in a packed string, null when absent."""
    from_value = F.split_part(packed, F.concat(F.lit(_ENTRY), key, F.lit(_VALUE)), F.lit(2))
    return F.nullif(F.split_part(from_value, F.lit(_ENTRY), F.lit(1)), F.lit(""))


@lru_cache(maxsize=1)
def _packed_names() -> str:
    """JSON of first letter -> packed names (with semicolon, or short without)."""
    by_letter: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        by_letter.setdefault(name[0], {})[name] = text
    return json.dumps({letter: _pack(names) for letter, names in by_letter.items()})


@lru_cache(maxsize=1)
def _short_names() -> str:
    """Pattern of the names allowed without a semicolon, longest first."""
    names = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return rf"\A&({'|'.join(names)})"


@lru_cache(maxsize=1)
def _special_code_points() -> str:
    """Packed code points that HTML5 remaps or drops, found from the rule itself."""
    points = [*range(0x0, 0x20), *range(0x7F, 0xA0)]
    decoded = {point: unescape(f"&#{point};") for point in points}
    return _pack({str(p): text or _DROPPED for p, text in decoded.items() if text != chr(p)})


def _numeric_value(reference: Column) -> Column:
    """Character of a matched numeric reference such as ``&#39;`` or ``&#x27``."""
    digits = F.ltrim(F.regexp_extract(reference, r"([0-9a-fA-F]+);?\z", 1), F.lit("0"))
    digits = F.when(digits == "", "0").otherwise(digits)
    is_hex = F.lower(F.substring(reference, 3, 1)) == "x"
    # More than seven significant digits is beyond the last code point either way.
    point = (
        F.when(F.length(digits) > 7, F.lit(0x110000))
        .when(is_hex, F.conv(digits, 16, 10).cast("int"))
        .otherwise(digits.try_cast("int"))
    )
    invalid = (point > 0x10FFFF) | point.between(0xD800, 0xDFFF)
    non_character = point.between(0xFDD0, 0xFDEF) | (point.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    special = _lookup(F.lit(_special_code_points()), point.cast("string"))
    encoded = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    return (
        F.when(invalid, F.lit(_REPLACEMENT))
        .when(non_character, F.lit(""))
        .otherwise(F.coalesce(F.replace(special, F.lit(_DROPPED), F.lit("")), encoded))
    )


def _decode_piece(piece: Column) -> Column:
    """Decode the entity that may start a piece; the rest stays as it is."""
    names = F.from_json(F.lit(_packed_names()), "map<string,string>")
    numeric = F.regexp_extract(piece, _NUMERIC, 0)
    named = F.regexp_extract(piece, _NAMED, 0)
    short = F.regexp_extract(piece, _short_names(), 1)

    def value(name: Column) -> Column:
        return _lookup(F.try_element_at(names, F.substring(name, 1, 1)), name)

    by_name = value(F.substring(named, 2, 64))
    # Each lookup is referenced once; a failed one is null and falls through.
    return F.coalesce(
        F.when(~piece.startswith("&"), piece),
        F.when(numeric != "", F.concat(_numeric_value(numeric), _tail(piece, numeric))),
        F.concat(by_name, _tail(piece, named)),
        F.concat(
            value(short), _tail(piece, F.concat(F.lit("&"), short))
        ),
        piece,
    )


def _tail(piece: Column, head: Column) -> Column:
    return F.substr(piece, F.length(head) + 1)


def decode_entities(value: Column) -> Column:
    """Decode named, decimal and hexadecimal HTML references.

    Only texts with an ampersand that can start a reference are cut into pieces.
    """
    pieces = F.transform(F.split(value, rf"(?={_START})"), _decode_piece)
    return F.when(value.contains("&") & value.rlike(_START), F.array_join(pieces, "")).otherwise(value)
