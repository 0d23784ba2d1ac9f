"""Secret scans: fixed patterns, and a randomness test battery over long tokens.

Patterns give the base spans (``assign``, ``access``, ``hex``). Every other run of
``MIN_TOKEN`` or more base64-like characters is a candidate, as is what base spans leave
of one: its alphabet is the smallest of ``NARROW`` or else of the encodings that holds
all its characters, and tests ask whether it could be random in that alphabet: chi-squared uniformity, the runs test about the alphabet's middle,
the lag-1 serial correlation and, where enough letters follow each other, a serial test on their pairs: the likelihood
of the pairs by the counts of all documents, against what random letters have. Their p-values are combined by Fisher's method.
Natural words fail the battery; those of 20 letters and more mostly by their pairs. In each length class the Benjamini-Hochberg step-up
rule over all candidates of the corpus decides which of them are declared
not random, so that at most ``FDR`` of those dismissed are random; what is left is
a span of kind ``random``. The rule works on a histogram of bounded size.

Spans count code points, ends are exclusive. Null and empty texts have no spans
and the digest of the empty list. Columns other than doc_id and text don't
matter; an empty table gives no rows. Long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shardloom.llm.common import steps, text_buffer

#: The patterns that define the base spans, in the order of their kinds.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "random")

MIN_VALUE = 8
MIN_TOKEN = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_TOKEN)
#: Share of wrongly dismissed random tokens that is allowed.
FDR = 0.01
#: Lower limits of the length classes.
LENGTHS = (20, 24, 32, 48, 64, 128, 512)
#: Letter pairs that a serial test of them needs.
MIN_PAIRS = 8
#: p-values are binned by tenths of a power of ten.
BINS = 400

_DIGITS = "0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABETS = {
    "hex": _DIGITS + "abcdef",
    "base32": _UPPER + "234567",
    "base64": _UPPER + _UPPER.lower() + _DIGITS + "+/",
}
#: Alphabets in which a token is tested if they hold it, the smallest first.
NARROW = (
    _DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _UPPER.lower(), _UPPER, _UPPER.lower() + "234567", _UPPER + "234567",
    _DIGITS + _UPPER.lower(), _DIGITS + _UPPER, "".join(c for c in _DIGITS + _UPPER + _UPPER.lower() if c not in "0OIl"),
    _DIGITS + _UPPER + _UPPER.lower(),
)
_NARROW = [{c: i for i, c in enumerate(chars)} for chars in NARROW]
_INDEX = {name: {c: i for i, c in enumerate(chars)} for name, chars in _ALPHABETS.items()}
_INDEX["base64"] |= {"-": 62, "_": 63}


def infer_encoding(token: str) -> tuple[str, list[int]]:
    """Encoding and symbol numbers of a token; padding at its end is left out."""
    body = token.rstrip("=")
    for name, text in (("hex", body.lower() if body.upper() == body or body.lower() == body else body), ("base32", body)):
        index = _INDEX[name]
        if all(c in index for c in text):
            return name, [index[c] for c in text]
    index = _INDEX["base64"]
    return "base64", [index[c] for c in body if c in index]


def smallest_alphabet(token: str) -> tuple[int, list[int]]:
    """Size of the smallest alphabet that holds a token, and the token's symbol numbers in it."""
    body = token.rstrip("=")
    used = set(body)
    for index in _NARROW:
        if used <= index.keys():
            return len(index), [index[c] for c in body]
    name, symbols = infer_encoding(token)
    return len(_ALPHABETS[name]), symbols


def _two_sided(z: float) -> float:
    return max(math.erfc(abs(z) / math.sqrt(2)), 1e-300)


class PairTable:
    """How much likelier each pair of small letters is in the documents than among random ones (log), by their counts."""

    def __init__(self, counts: np.ndarray) -> None:
        # One more of each: a pair that never occurs is rare, not impossible.
        self.scores = np.log((counts + 1.0) / (counts.sum() + counts.size) * counts.size)
        self.random = {len(letters): self._moments(len(letters)) for letters in ("abcdef", _UPPER)}

    def _moments(self, n: int) -> tuple[float, float, float]:
        """Mean, variance and covariance of neighbours for pairs of random letters among the first ``n``."""
        some = self.scores[:n, :n]
        left, right = some.mean(0), some.mean(1)
        return float(some.mean()), float(some.var()), float(((left - left.mean()) * (right - right.mean())).mean())

    def p_value(self, token: str, size: int) -> float | None:
        """Chance that random letters have pairs as likely as those of ``token``; None with fewer than MIN_PAIRS."""
        letters = np.frombuffer(token.lower().encode(), np.uint8).astype(np.int64) - 97
        inside = (letters >= 0) & (letters < 26)
        both = np.flatnonzero(inside[1:] & inside[:-1])
        m = len(both)
        mean, variance, shared = self.random[6 if size == 16 else 26]
        spread = m * variance + 2 * max(0, int((np.diff(both) == 1).sum())) * shared
        if m < MIN_PAIRS or spread <= 0:
            return None
        z = (float(self.scores[letters[both], letters[both + 1]].sum()) - m * mean) / math.sqrt(spread)
        return max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)


def pair_table(docs: DataFrame) -> PairTable:
    """Counts of neighbouring letters (A-Z as a-z) of all texts: 676 numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(26 * 26, np.int64)
        for batch in batches:
            data, limits = text_buffer(batch.column(0))
            for lo, hi in steps(limits):
                for at in range(int(limits[lo]), int(limits[hi]), 1 << 22):  # a long text in parts
                    part = data[at : min(at + (1 << 22) + 1, int(limits[hi]))]
                    # Setting the sixth bit lowers A-Z; what is no letter stays outside.
                    letters = (part | 0x20).astype(np.int32) - 97
                    inside = (letters >= 0) & (letters < 26) & (part >= 65)
                    pair = inside[1:] & inside[:-1]
                    totals += np.bincount((letters[:-1] * 26 + letters[1:])[pair], minlength=26 * 26)
        found = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(totals[found])], names=["k", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "k int, n bigint")
    out = np.zeros(26 * 26, np.int64)
    for k, n in counted.groupBy("k").agg(F.sum("n")).collect():
        out[k] = n
    return PairTable(out.reshape(26, 26))


def battery(symbols: list[int], size: int, p_pairs: float | None = None) -> float:
    """Combined p-value of the tests that ``symbols`` are random in an alphabet of ``size``, with that of their letter pairs."""
    n = len(symbols)
    if n < 3:
        return 1.0
    counts = np.bincount(symbols, minlength=size)
    chi = float((counts.astype(float) ** 2).sum()) * size / n - n
    z_chi = (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    p_chi = max(0.5 * math.erfc(z_chi / math.sqrt(2)), 1e-300)
    x = np.asarray(symbols, float)
    high = x >= size / 2
    runs = int((high[1:] != high[:-1]).sum())  # changes: binomial with one half
    p_runs = _two_sided((runs - (n - 1) / 2) / math.sqrt((n - 1) / 4))
    x = (x - (size - 1) / 2) / math.sqrt((size * size - 1) / 12)
    p_serial = _two_sided(float((x[1:] * x[:-1]).sum()) / math.sqrt(n - 1))
    found = [p_chi, p_runs, p_serial] + ([] if p_pairs is None else [p_pairs])
    # Fisher: minus the sum of logs has a gamma distribution of as many degrees.
    half, term, total = -sum(math.log(p) for p in found), 1.0, 0.0
    for i in range(len(found)):
        total += term
        term *= half / (i + 1)
    return max(math.exp(-half) * total, 1e-300)


def length_class(n: int) -> int:
    return sum(n >= lower for lower in LENGTHS) - 1


def p_bin(p: float) -> int:
    return min(BINS - 1, int(-10 * math.log10(p)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the pattern matches, in order."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]], pairs: PairTable | None = None) -> Iterator[tuple[int, int, int, int]]:
    """``(start, end, length class, p bin)`` of tokens, without the base spans in them."""
    for m in TOKEN.finditer(text):
        for start, end in _outside(text, m.start(), m.end(), base):
            size, symbols = smallest_alphabet(text[start:end])
            p_pairs = pairs.p_value(text[start:end], size) if pairs else None
            yield start, end, length_class(end - start), p_bin(battery(symbols, size, p_pairs))


def _outside(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What base spans leave of a token, where it is long enough; signs next to a cut are left out."""
    cuts = [(s, e) for s, _, e in base if s < end and start < e]
    for s, e in [*cuts, (end, end)]:  # in order of their starts
        left, right = start, min(s, end)
        if cuts:
            while left < right and text[left] in "+/_=-":
                left += 1
            while left < right and text[right - 1] in "+/_=-":
                right -= 1
        if right - left >= MIN_TOKEN:
            yield left, right
        start = max(start, e)


_TOKEN_BYTE = np.array([chr(b) in _ALPHABETS["base64"] + "-_=" for b in range(256)])


def _rows_with_tokens(column: pa.Array) -> np.ndarray:
    """Rows in which a run of MIN_TOKEN token bytes stands: every ``access``, ``hex`` and candidate does."""
    data, limits = text_buffer(column)
    rows = np.zeros(len(column), bool)
    for lo, hi in steps(limits):
        part = data[limits[lo] : limits[hi]]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], _TOKEN_BYTE[part].view(np.int8), [0]))))
        starts, ends = edges[::2], edges[1::2]
        # A run that crosses rows only names rows too many.
        for s, e in zip(starts[ends - starts >= MIN_TOKEN], ends[ends - starts >= MIN_TOKEN]):
            first, last = np.searchsorted(limits[lo : hi + 1] - limits[lo], [s, e - 1], "right") - 1
            rows[lo + first : lo + last + 1] = True
    return rows


def _scan(column: pa.Array, pairs: PairTable) -> Iterator[tuple[int, list, list]]:
    """Row number, base spans and candidates of the rows that have any."""
    long_run = _rows_with_tokens(column)
    for i, value in enumerate(column):
        # "AKIA" and 12 more characters are shorter than a token.
        text = value.as_py() if value.is_valid else ""
        if not (long_run[i] or ":" in text or "=" in text or "AKIA" in text):
            continue
        base = base_spans(text)
        yield i, base, list(candidates(text, base, pairs)) if long_run[i] else []


def p_histogram(docs: DataFrame, pairs: PairTable) -> list[tuple[int, int, int]]:
    """``(length class, p bin, tokens)`` over all documents: at most classes times bins rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(LENGTHS), BINS), np.int64)
        for batch in batches:
            for _, _, found in _scan(batch.column(0), pairs):
                for _, _, k, b in found:
                    totals[k, b] += 1
        k, b = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(totals[k, b])], names=["k", "b", "n"]
        )

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "k int, b int, n bigint")
    return [tuple(r) for r in counted.groupBy("k", "b").agg(F.sum("n")).collect()]


def step_up(histogram: list[tuple[int, int, int]], fdr: float = FDR) -> list[int]:
    """For each length class the lowest bin that is dismissed as not random (BINS: none).

    Benjamini-Hochberg: the largest p with ``p <= fdr * rank / tokens``, a bin's p
    being its upper limit.
    """
    cuts = [BINS] * len(LENGTHS)
    for k, rows in groupby(sorted(histogram, key=lambda r: (r[0], -r[1])), key=lambda r: r[0]):
        rows = list(rows)
        total, rank = sum(r[2] for r in rows), 0
        for _, b, n in rows:  # from the smallest p
            rank += n
            if 10 ** (-b / 10) <= fdr * rank / total:
                cuts[k] = b
    return cuts


def scan_spans(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """The columns of ``docs`` without clashing ones, and ``_spans``: array of (start, kind, end).

    Kinds are numbers in KINDS. Reads the texts three times: for the counts of letter pairs, the histogram of
    p-values and the spans.
    """
    pairs = pair_table(docs)
    cuts = step_up(p_histogram(docs, pairs), fdr)
    docs = docs.drop("_spans")
    at = docs.columns.index("text")
    spans_type = "array<struct<start: int, kind: int, end: int>>"
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"_spans {spans_type}").fields])
    arrow_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for i, base, found in _scan(batch.column(at), pairs):
                random = [(s, 3, e) for s, e, k, b in found if b < cuts[k]]
                out[i] = [{"start": s, "kind": k, "end": e} for s, k, e in sorted(base + random)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, arrow_type)], names=[*batch.schema.names, "_spans"])

    return docs.mapInArrow(find, schema)


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    spans = scan_spans(docs.select("doc_id", "text"), fdr).drop("text")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    told = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    text = lambda keep: F.array_join(F.transform(F.filter("_spans", keep), told), ",")
    number = lambda k: F.size(F.filter("_spans", lambda s: s["kind"] == k)).cast("bigint")
    return spans.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(text(lambda s: s["kind"] < 3).cast("binary"), 256).alias("base_sha256"),
        text(lambda s: s["kind"] >= 0).alias("spans"),
        number(3).alias("n_random"),
    )


def redact(docs: DataFrame, fdr: float = FDR, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one), all rows kept.

    ``n_chars``, where the table has it, follows the new text.
    """
    found = scan_spans(docs, fdr)
    columns = docs.columns
    # Spans are in order of their starts: a span begins a new piece where no earlier one reaches.
    step = lambda acc, s: F.struct(
        F.when(s["start"] < acc["end"], acc["out"])
        .otherwise(F.concat(acc["out"], F.substring(F.col("text"), acc["end"] + 1, s["start"] - acc["end"]), F.lit(mark)))
        .alias("out"),
        F.greatest(acc["end"], s["end"]).alias("end"),
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    end = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["end"] + 1, F.length("text")))
    new = F.when(F.size("_spans") > 0, F.aggregate("_spans", start, step, end)).otherwise(F.col("text"))
    out = found.withColumn("text", new)
    if "n_chars" in columns:
        length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        out = out.withColumn("n_chars", F.when(F.size("_spans") > 0, length).otherwise(F.col("n_chars")))
    return out.select(*columns)


def spans_digest(spans: list[tuple[int, int, int]]) -> str:
    """What ``base_sha256`` holds for base spans; for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
