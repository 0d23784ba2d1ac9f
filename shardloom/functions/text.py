"""Column expressions on text: splitting, bytes, trimming, seeded draws."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two split patterns (digit runs of up to three, or up to two).
SPLIT_DIGITS_3 = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}"
    r"| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)
SPLIT_DIGITS_2 = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}"
    r"| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)

# One character stands for one token id. Below 20,992 ids the characters are
# U+4E00.. in order; above, U+20000.. in order. Character order is id order.
_LOW_BASE, _LOW_COUNT, _HIGH_BASE = 0x4E00, 0x5200, 0x20000
MAX_TOKEN_ID = _LOW_COUNT + (0xE0000 - _HIGH_BASE)


def id_to_symbol(token_id: int) -> str:
    if token_id < _LOW_COUNT:
        return chr(_LOW_BASE + token_id)
    return chr(_HIGH_BASE + token_id - _LOW_COUNT)


def symbol_to_id(symbol: str) -> int:
    code = ord(symbol)
    return code - _LOW_BASE if code < _HIGH_BASE else code - _HIGH_BASE + _LOW_COUNT


def symbol_id(symbol: Column) -> Column:
    """Token id of a one-character symbol."""
    code = F.ascii(symbol)
    return (
        F.when(code < F.lit(_HIGH_BASE), code - F.lit(_LOW_BASE))
        .otherwise(code - F.lit(_HIGH_BASE - _LOW_COUNT))
        .cast("int")
    )


def byte_symbols(text: Column) -> Column:
    """Text as symbols, one per UTF-8 byte."""
    return F.decode(F.unhex(F.regexp_replace(F.hex(text), "(..)", "4E$1")), "UTF-16BE")


def split_pieces(text: Column, pattern: str = SPLIT_DIGITS_3) -> Column:
    """Cut text into pieces; concatenated they give the text back.

    The flag makes character classes follow Unicode, as the pattern expects.
    """
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def cap_bytes(text: Column, cap: int) -> Column:
    """Longest prefix of at most ``cap`` bytes that ends on a whole character.

    A cut character leaves at most three of its bytes, so one of four prefix
    lengths is valid UTF-8. ``cap`` 0 turns the cap off.
    """
    if cap <= 0:
        return text
    raw = text.cast("binary")
    prefixes = [F.substring(raw, 1, max(cap - cut, 0)).cast("string") for cut in range(4)]
    capped = F.coalesce(*[F.try_validate_utf8(p) for p in prefixes], prefixes[0])
    return F.when(F.octet_length(text) > cap, capped).otherwise(text)


def py_strip(text: Column) -> Column:
    """Drop Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def count_of(text: Column, needle: Column) -> Column:
    """Non-overlapping occurrences of ``needle``."""
    gone = F.length(text) - F.length(F.replace(text, needle, F.lit("")))
    return F.when(
        F.length(needle) > 0, (gone / F.length(needle)).cast("int")
    ).otherwise(F.length(text) + 1)


def json_string(text: Column) -> Column:
    """A JSON string literal with its quotes."""
    wrapped = F.to_json(F.array(text))
    return F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)


def seeded_hash(*parts: Column | str | int) -> Column:
    """Reproducible hex digest of ``part|part|...``: the same on any engine."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def draw(digest: Column, bound: Column | int) -> Column:
    """A number in [0, bound) from a digest (60 of its bits)."""
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    return F.pmod(number, bound if isinstance(bound, Column) else F.lit(bound)).cast("bigint")
