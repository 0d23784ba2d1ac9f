"""Suffix-array dedup: bytes covered by strings of ``min_len`` bytes that occur again.

Every start of a ``min_len`` string is owned by an anchor inside it: the place with
the smallest hash of ``GRAM`` bytes in the string's window (the first of equals). The owner depends on
the string alone, so equal strings have owners with equal hashes, and strings
only need to be compared within an owner's group. A run of starts with one owner
is a region; regions equal in bytes are one representative with a count, so exact copies and the
insides of near copies cost one row.

Where a group has several different regions, their suffixes are put in order by prefix doubling, which also
gives what neighbours share, and the longest previous factor of each start follows from the nearest smaller positions before
and after it in that order: a start with a factor of ``min_len`` has an earlier
match, and its source has a later one. ``keep="first"`` removes later copies only and keeps
the first (documents in order of id, then position); ``keep="none"`` removes every copy. Groups of more than ``HOT`` different regions are settled
by counting 128-bit digests of all their strings instead: a sum that Spark splits, with the same result.

Strings are judged on the input, never across documents; overlaps count. A null
text is empty; texts shorter than ``min_len`` keep all bytes. Documents equal in
id and text are copies of each other. A null id comes last. Empty tables give no
rows. Long texts are cut into overlapping parts of ``STEP_BYTES`` starts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import STEP_BYTES, Rolling, if_small, key_filter, may_hold, mix, steps, text_buffer
from shardloom.session import materialize, session_conf

MIN_LEN = 400
#: Share of ``min_len`` that an anchor's gram takes: the rest is its window.
GRAM_SHARE = 0.36
#: Different regions of a group that are put in suffix order together.
HOT = 16_384
_BLOCK, _PAIRS = 64, 1 << 13  # bytes, and pairs of suffixes, that are compared at a time
#: Ranks that the factors of are found at a time, and more up to the next that shares nothing.
LPF_STEP = 1 << 16

ANCHORS = "doc_id bigint, k1 bigint, k2 bigint, h bigint, g bigint, lo bigint, hi bigint, at int"


def _sliding_least(values: np.ndarray, window: int) -> np.ndarray:
    size = 1
    while 2 * size <= window:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = window - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, limits: np.ndarray, min_len: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts between ``limits``: text, owner hash, region hash, first and last start, owner.

    Starts count from the beginning of ``data``, the owner from the first start.
    """
    gram = max(1, int(min_len * GRAM_SHARE))
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int32))
    if len(data) < min_len:
        return none
    rolling = Rolling(data)
    hashes = mix(rolling.windows(gram))
    # Upper hash bits and the place: the least is the first of the smallest.
    bits = np.uint64(len(data).bit_length())
    places = np.arange(len(hashes), dtype=np.uint64)
    packed = ((hashes >> bits) << bits) | places
    owner = (_sliding_least(packed, min_len - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(limits) - 1), np.diff(limits))[: len(owner)]
    starts = np.flatnonzero(np.arange(len(owner)) + min_len <= limits[1:][text])
    if not len(starts):
        return none
    own, of = owner[starts], text[starts]
    first = np.concatenate(([True], (own[1:] != own[:-1]) | (of[1:] != of[:-1]) | (starts[1:] != starts[:-1] + 1)))
    at = np.flatnonzero(first)
    lo, hi = starts[at], starts[np.concatenate((at[1:] - 1, [len(starts) - 1]))]
    region = rolling.between(lo, hi + min_len) + mix((own[at] - lo).astype(np.uint64)) + mix((hi - lo).astype(np.uint64) << np.uint64(20))
    return of[at], hashes[own[at]], mix(region), lo, hi, (own[at] - lo).astype(np.int32)


def anchor_table(docs: DataFrame, min_len: int) -> DataFrame:
    """One row per anchor of ``docs`` (``doc_id, k1, k2, text``)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffer(batch.column(3))
            for a, b in steps(limits):
                begin, end = int(limits[a]), int(limits[b])
                # A long text alone goes through in parts, each with the bytes its last start needs.
                for at in range(begin, max(end, begin + 1), 2 * STEP_BYTES):
                    to = min(end, at + 2 * STEP_BYTES + min_len - 1)
                    own = np.clip(limits[a : b + 1], at, to) - at
                    text, h, g, lo, hi, owner = anchors(data[at:to], own, min_len)
                    offset = at - limits[a + text]
                    rows = pa.array(a + text)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).take(rows) for k in range(3)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(lo + offset), pa.array(hi + offset), pa.array(owner)],
                        names=["doc_id", "k1", "k2", "h", "g", "lo", "hi", "at"],
                    )

    return docs.mapInArrow(find, ANCHORS)


def longest_previous_factors(order: list[int], lcp: list[int]) -> tuple[list[int], list[int]]:
    """LPF array and sources from suffix order.

    ``order`` lists positions by suffix, ``lcp[i]`` is what ``order[i - 1]`` and
    ``order[i]`` share. For each rank the nearest smaller positions before and
    after it in suffix order hold the longest earlier match; its length and the
    position come back by rank (0 and -1: none).
    """
    n = len(order)
    length, source = [0] * n, [-1] * n
    # Ranks with rising positions, each with the overlap to the one below it.
    stack: list[tuple[int, int]] = []
    for r in range(n + 1):
        shared = lcp[r] if r < n and r else 0
        while stack and (r == n or order[stack[-1][0]] > order[r]):
            top, below = stack.pop()
            # Before ``top``: the stack's next (overlap ``below``); after it: rank ``r`` (overlap ``shared``).
            if shared > below and r < n:
                length[top], source[top] = shared, order[r]
            elif below > 0:
                length[top], source[top] = below, order[stack[-1][0]]
            shared = min(shared, below) if stack else shared
        if r < n:
            stack.append((r, shared if stack else 0))
    return length, source


def _ranked(values: np.ndarray, first: int) -> np.ndarray:
    """Ranks of values among the different ones, from ``first``; takes little more than the order itself."""
    order = np.argsort(values)
    some = values[order]
    new = np.empty(len(some), np.int32)
    new[:1] = first
    np.cumsum(some[1:] != some[:-1], out=new[1:])
    new[1:] += first
    out = np.empty_like(new)
    out[order] = new
    return out


def suffix_order(regions: list[bytes], min_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of all regions in order, and what each shares with the one before it (0 if less than ``min_len``).

    Prefix doubling: places are ranked by their first 1, 2, 4 .. bytes; two ranks make the next. A region's
    end is smaller than any byte and unlike any other end, so no overlap runs past it. Two neighbours share ``min_len``
    bytes if the ranks by the largest power of two in it are equal at both ends of that stretch; how much
    more they share is compared block by block. Places count over the regions laid end to end.
    """
    data = np.frombuffer(b"".join(regions), np.uint8)
    n, sizes = len(data), np.array([len(r) for r in regions])
    region = np.repeat(np.arange(len(regions), dtype=np.int32), sizes)
    left = np.repeat(np.cumsum(sizes), sizes).astype(np.int32) - np.arange(n, dtype=np.int32)  # bytes from a place to its region's end
    # Ranks begin above the numbers of the regions, which stand for their ends.
    ends, step = len(regions), 1
    ranks = data.astype(np.int32) + np.int32(ends)
    kept, reach = ranks, 1
    while step < sizes.max():
        pairs = ranks * (np.int64(ranks.max()) + 1)
        pairs[: n - step] += np.where(left[: n - step] > step, ranks[step:], region[: n - step])
        pairs[n - step :] += region[n - step :]
        ranks = _ranked(pairs, ends)
        step *= 2
        if step <= min_len:
            kept, reach = ranks, step
    order = np.argsort(ranks, kind="stable")
    x, y = order[:-1], order[1:]
    pairs = np.flatnonzero((left[x] >= min_len) & (left[y] >= min_len))
    x, y = x[pairs], y[pairs]
    rest = min_len - reach
    same = (kept[x] == kept[y]) & (kept[x + rest] == kept[y + rest])
    pairs, x, y = pairs[same], x[same], y[same]
    shared = np.zeros(n, np.int64)
    shared[pairs + 1] = min_len
    for a in range(0, len(pairs), _PAIRS):
        some = slice(a, a + _PAIRS)
        _extend(data, shared, pairs[some] + 1, x[some], y[some], np.minimum(left[x[some]], left[y[some]]), min_len)
    return order, shared


def _extend(data: np.ndarray, shared: np.ndarray, ranks: np.ndarray, x: np.ndarray, y: np.ndarray, room: np.ndarray, at: int) -> None:
    """Adds to ``shared`` what the places ``x`` and ``y`` share from ``at`` on, ``room`` at most in all."""
    while len(ranks):
        block = np.arange(at, at + _BLOCK)
        fits = block < room[:, None]
        alike = fits & (data[np.minimum(x[:, None] + block, len(data) - 1)] == data[np.minimum(y[:, None] + block, len(data) - 1)])
        more = np.where(alike.all(1), _BLOCK, (~alike).argmax(1))
        shared[ranks] += more
        on = more == _BLOCK
        ranks, x, y, room, at = ranks[on], x[on], y[on], room[on], at + _BLOCK


def group_marks(regions: list[bytes], min_len: int) -> list[tuple[int, bool, int, int]]:
    """Runs of starts (region, kind, first, last) of regions in document order.

    Kind is true for starts with an earlier match, false for those with any.
    """
    order, shared = suffix_order(regions, min_len)
    # Suffixes that share min_len bytes with no neighbour have no factor of that length.
    long = shared >= min_len
    near = np.flatnonzero(long | np.append(long[1:], False))
    lengths = np.where(long[near], shared[near], 0)
    later, every = np.zeros(len(order), bool), np.zeros(len(order), bool)
    # Nothing is shared across a length of 0, so the order is worked through in parts that begin with one.
    cuts = np.flatnonzero(lengths == 0)
    at = 0
    while at < len(near):
        k = np.searchsorted(cuts, at + LPF_STEP)
        to = int(cuts[k]) if k < len(cuts) else len(near)
        length, source = longest_previous_factors(order[near[at:to]].tolist(), lengths[at:to].tolist())
        known = np.array(length) >= min_len
        mine = order[near[at:to]][known]
        later[mine] = every[mine] = True
        every[np.array(source)[known]] = True
        at = to
    begins = np.concatenate(([0], np.cumsum([len(r) for r in regions])))
    out = []
    for kind, marked in ((True, later), (False, every)):
        # The last start of a region is min_len before its end, so runs never touch.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.view(np.int8), [0]))))
        first, last = edges[::2], edges[1::2] - 1
        owner = np.searchsorted(begins, first, "right") - 1
        out += zip(owner.tolist(), [kind] * len(owner), (first - begins[owner]).tolist(), (last - begins[owner]).tolist())
    return out


MARKS = "h bigint, g bigint, later boolean, first bigint, last bigint"


def _suffix_marks(regions: DataFrame, min_len: int) -> DataFrame:
    """Marks of the regions (``h, g, place, bytes, at``) by LPF arrays, a group at a time."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(h: int, held: dict[int, tuple]) -> list[tuple]:
            ranked = sorted(held.items(), key=lambda x: x[1][0])
            return [(h, ranked[k][0], kind, a, b) for k, kind, a, b in group_marks([v[1] for _, v in ranked], min_len)]

        def rows() -> Iterator[list[tuple]]:
            last, held = None, {}
            for batch in batches:
                for h, g, place, text, owner in zip(*(c.to_pylist() for c in batch.columns)):
                    if h != last:
                        if len(held) > 1:
                            yield settle(last, held)
                        last, held = h, {}
                    held.setdefault(g, (place, text, owner))
            if len(held) > 1:
                yield settle(last, held)

        out: list[tuple] = []
        for some in rows():
            out += some
            if len(out) > 50_000:
                yield _mark_batch(out)
                out = []
        if out:
            yield _mark_batch(out)

    dealt = regions.repartition("h").sortWithinPartitions("h")
    return dealt.select("h", "g", "place", "bytes", "at").mapInArrow(mark, MARKS)


def _mark_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["h", "g", "later", "first", "last"])


def _digest_marks(regions: DataFrame, min_len: int) -> DataFrame:
    """Marks of the regions of crowded groups: every string's digest is counted."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(batch.num_rows):
                h, g, place, text = (batch.column(k)[part].as_py() for k in range(4))
                told = [hashlib.blake2b(text[s : s + min_len], digest_size=16).digest() for s in range(len(text) - min_len + 1)]
                n = len(told)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h] * n), pa.array([g] * n), pa.array([place] * n), pa.array(range(n), pa.int64()), pa.array(told, pa.binary())],
                    names=["h", "g", "place", "s", "d"],
                )

    strings = regions.select("h", "g", "place", "bytes").mapInArrow(digest, "h bigint, g bigint, place bigint, s bigint, d binary")
    strings = materialize(strings, "strings")
    shared = strings.groupBy("h", "d").agg(F.count("*").alias("n"), F.min("place").alias("low")).where("n > 1")
    found = strings.join(shared, ["h", "d"])
    every = found.select("h", "g", F.lit(False).alias("later"), F.col("s").alias("first"), F.col("s").alias("last"))
    later = found.where("place > low").select("h", "g", F.lit(True).alias("later"), F.col("s").alias("first"), F.col("s").alias("last"))
    return every.union(later)


def _picked(texts: DataFrame, held: np.ndarray, hit: bool) -> DataFrame:
    """The rows of ``texts`` (``keyed``) whose ``k1`` a filter may hold, or the others."""
    shared = texts.sparkSession.sparkContext.broadcast(held)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("k1")).to_numpy().view(np.uint64)
            some = batch.filter(pa.array(may_hold(shared.value, keys) == hit))
            if some.num_rows:
                yield some

    return texts.mapInArrow(pick, texts.schema)


def _cut_regions(docs: DataFrame, wanted: DataFrame, min_len: int) -> DataFrame:
    """``h, g, place, hot, at, bytes`` of the wanted regions (``doc_id, k1, k2, lo, hi, h, g, place, hot, at``)."""
    asked = wanted.groupBy("doc_id", "k1", "k2").agg(F.collect_list(F.struct("h", "g", "place", "hot", "at", "lo", "hi")).alias("asked"))
    asked = materialize(asked, "asked")
    # Texts are large: only those that may be asked for reach the join.
    docs = _picked(docs, key_filter(asked, "k1"), True)
    asked = asked.hint("shuffle_hash")  # the same plan at every size, and no text is sorted
    same = docs["doc_id"].eqNullSafe(asked["doc_id"]) & (docs["k1"] == asked["k1"]) & (docs["k2"] == asked["k2"])
    found = docs.join(asked, same).select("text", "asked")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffer(batch.column(0))
            for i, some in enumerate(batch.column(1).to_pylist()):
                base = int(limits[i])
                texts = [data[base + r["lo"] : base + r["hi"] + min_len].tobytes() for r in some]
                columns = [pa.array([r[k] for r in some], t) for k, t in (("h", pa.int64()), ("g", pa.int64()), ("place", pa.int64()), ("hot", pa.bool_()), ("at", pa.int32()))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())], names=["h", "g", "place", "hot", "at", "bytes"])

    return found.mapInArrow(cut, "h bigint, g bigint, place bigint, hot boolean, at int, bytes binary")


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text")
    )


def repeat_marks(texts: DataFrame, min_len: int = MIN_LEN, keep: str = "none") -> DataFrame:
    """``doc_id, k1, k2, marks`` of the texts (from ``keyed``) with bytes to remove; marks are (first, last) starts.

    With ``keep="none"`` equal texts have equal marks and doc_id is left out. A written table.
    """
    long = texts.where(F.octet_length("text") >= min_len)
    table = materialize(anchor_table(long, min_len), "anchors")
    again = table.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    shared = materialize(table.join(if_small(materialize(again, "again")), "h"), "shared")
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "k1", "k2", "lo", "hi")
    regions = shared.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(place).alias("rep"), F.min("at").alias("at"))
    regions = materialize(regions.select("h", "g", "n", "at", "rep.*"), "regions")
    groups = regions.groupBy("h").agg(F.count("*").alias("m")).where("m > 1")
    open_ = regions.join(if_small(materialize(groups, "groups")), "h")
    # Places in document order within a group; crowded groups are ranked by key alone.
    order = Window.partitionBy("h").orderBy("late", "doc_id", "k1", "k2", "lo")
    few = open_.where(F.col("m") <= HOT).withColumn("place", F.row_number().over(order).cast("bigint")).withColumn("hot", F.lit(False))
    crowd = open_.where(F.col("m") > HOT).withColumn("place", F.lit(0).cast("bigint")).withColumn("hot", F.lit(True))
    if keep == "first":
        crowd = crowd.withColumn("place", F.row_number().over(order).cast("bigint"))
    columns = ["doc_id", "k1", "k2", "lo", "hi", "h", "g", "place", "hot", "at"]
    cut = materialize(_cut_regions(texts, few.select(*columns).union(crowd.select(*columns)), min_len), "cut")
    marks = _suffix_marks(cut.where("NOT hot"), min_len)
    crowded = cut.where("hot")
    if not crowded.isEmpty():
        marks = marks.union(_digest_marks(crowded, min_len))
    marks = materialize(marks.where(F.col("later") == (keep == "first")), "marks")
    copies = regions.where("n > 1").select("h", "g", *(F.col(c).alias(f"r_{c}") for c in ("doc_id", "k1", "k2", "lo")))
    copies = shared.join(if_small(materialize(copies, "copies")), ["h", "g"])
    rep = F.col("doc_id").eqNullSafe(F.col("r_doc_id")) & (F.col("k1") == F.col("r_k1")) & (F.col("k2") == F.col("r_k2")) & (F.col("lo") == F.col("r_lo"))
    if keep == "first":
        copies = copies.where(~rep)
        owners = regions.select("h", "g", "doc_id", "k1", "k2", "lo")
    else:
        owners = shared
    inside = owners.join(if_small(marks), ["h", "g"])
    key = ["doc_id", "k1", "k2"] if keep == "first" else ["k1", "k2"]
    whole = copies.select(*key, F.col("lo").alias("first"), F.col("hi").alias("last"))
    parts = inside.select(*key, (F.col("lo") + F.col("first")).alias("first"), (F.col("lo") + F.col("last")).alias("last"))
    both = whole.union(parts).distinct()
    return materialize(both.groupBy(*key).agg(F.collect_list(F.struct("first", "last")).alias("marks")), "removed")


def remove_repeats(docs: DataFrame, min_len: int = MIN_LEN, keep: str = "none", text: bool = True) -> DataFrame:
    """``doc_id``, the columns of RESULT, ``spans`` and, with ``text``, the kept bytes.

    One row per row of ``docs``; spans are removed byte ranges (start, end).
    """
    texts = keyed(docs)
    with session_conf(docs.sparkSession, spark_sql_execution_arrow_maxRecordsPerBatch="2000"):
        marks = repeat_marks(texts, min_len, keep)
    held = key_filter(marks, "k1")
    marks = marks.hint("shuffle_hash").alias("m")  # the same plan at every size, and no text is sorted
    # Only texts that may have marks meet them; all others are done where they are read.
    t = _picked(texts, held, True).alias("t")
    same = (F.col("t.k1") == F.col("m.k1")) & (F.col("t.k2") == F.col("m.k2"))
    if keep == "first":
        same = same & F.col("t.doc_id").eqNullSafe(F.col("m.doc_id"))
    joined = t.join(marks, same, "left").select("t.doc_id", "t.text", "m.marks")
    rest = _picked(texts, held, False).select("doc_id", "text", F.lit(None).cast(joined.schema["marks"].dataType).alias("marks"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary()]
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    wanted = len(names) if text else len(names) - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffer(batch.column(1))
            rows = []
            for i, own in enumerate(batch.column(2).to_pylist()):
                value = data[limits[i] : limits[i + 1]].tobytes()
                spans: list[list[int]] = []
                for m in sorted(own or (), key=lambda m: m["first"]):
                    a, b = m["first"], m["last"] + min_len
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], b)
                    else:
                        spans.append([a, b])
                edges = [0, *(x for s in spans for x in s), len(value)]
                kept = b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2]))
                told = [{"start": a, "end": b} for a, b in spans]
                row = (len(value), len(value) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), told, kept)
                rows.append(row[:wanted])
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names[:wanted]])

    schema = "doc_id bigint, " + RESULT + ", spans array<struct<start: bigint, end: bigint>>" + (", kept binary" if text else "")
    return joined.mapInArrow(cut, schema).union(rest.mapInArrow(cut, schema))
