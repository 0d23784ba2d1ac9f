"""Benchmark decontamination by spaced-seed hashing, in built-in functions only.

A seed is the hash of the words that a fixed mask keeps out of a window; words at
ignored positions may differ. Seeds of all test items are joined with the seeds of
all document positions; each hit names a diagonal (document position less item
position). On a diagonal the whole item is compared word by word, and of all segments
that score 0 or more (a match counts 1, a substitution costs ``COST``) the one with
most matches is the overlap. An overlap is verified with ``MIN_WORDS`` matching words, or ``SHARE`` of
the item if that is less; by the cost at least 0.8 of its words match.

Words are runs of letters and digits of the lowered text. Any such overlap whose
substitutions are five words apart, or that has five matching words in a row,
holds a seed of MASKS. Null texts, null items and items of fewer than five words
match nothing; a null item id is an id of its own. Repeated rows of a document
give one row. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import if_small
from shardloom.session import materialize

#: 1: the word counts, 0: it is ignored.
MASKS = ("11111", "110111", "1101011")
MIN_WORDS = 12
SHARE = 0.8
COST = 4


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def seeds(table: DataFrame, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """``*, pos, seed`` for every window of the array column ``words``, which goes.

    Generators and hashes are compiled; the outer form keeps the array from being
    computed a second time for a filter below it.
    """
    at = table.select("*", F.posexplode_outer("words").alias("pos", "_word")).drop("_word")
    size = F.size("words")
    kept = []
    for k, mask in enumerate(masks):
        places = [i for i, c in enumerate(mask) if c == "1"]
        told = F.xxhash64(F.lit(k), *[F.get("words", F.col("pos") + i) for i in places])
        kept.append(F.when(F.col("pos") + len(mask) <= size, told))
    out = at.select("*", F.explode(F.array(*kept)).alias("seed")).drop("words")
    return out.where(F.col("seed").isNotNull())


def document_key(text: Column) -> Column:
    """Tells rows apart whose ids are equal or null."""
    return F.xxhash64(text)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps ``doc_id, text_key, item_id, n_words, matched, start``; one row per text and item.

    ``n_words`` is the item's length, ``start`` the document word where the best
    segment begins. A written table.
    """
    items = benchmark.where(F.col("text").isNotNull()).select("item_id", words(F.col("text")).alias("words"))
    items = materialize(items.where(F.size("words") >= len(MASKS[0])), "items")
    tests = seeds(items).select("seed", "item_id", F.col("pos").alias("item_pos"))
    # Several items, or places of one, may share a seed.
    tests = if_small(materialize(tests.distinct(), "tests"))
    texts = docs.select("doc_id", document_key(F.col("text")).alias("text_key"), words(F.coalesce("text", F.lit(""))).alias("words"))
    hits = seeds(texts).join(tests, "seed")
    hits = hits.select("doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct()
    hits = materialize(hits, "hits")
    found = hits.select("doc_id", "text_key").distinct().withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")
    found = if_small(materialize(found, "found"))
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (document_key(docs["text"]) == found["_key"])
    held = docs.join(found, same, "left_semi").select(
        "doc_id", document_key(F.col("text")).alias("text_key"), words(F.col("text")).alias("words")
    )
    d, h, t = held.alias("d"), hits.alias("h"), if_small(items).alias("t")
    joined = d.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_key") == F.col("h.text_key")))
    joined = joined.join(t, F.col("h.item_id").eqNullSafe(F.col("t.item_id")))
    cut = F.transform(
        F.col("t.words"), lambda w, i: F.get(F.col("d.words"), F.col("h.diagonal") + i).eqNullSafe(w)
    )
    compared = joined.select("d.doc_id", "d.text_key", "t.item_id", "h.diagonal", F.size("t.words").alias("n_words"), cut.alias("same"))
    need = F.least(F.lit(MIN_WORDS), F.ceil(F.col("n_words") * SHARE))
    # A diagonal with fewer matches in all holds no such segment.
    compared = compared.where(F.size(F.filter("same", lambda hit: hit)) >= need)
    scored = best_segment(compared, "same", "s")
    kept = scored.where(F.col("s.matched") >= need).groupBy("doc_id", "text_key", "item_id", "n_words")
    top = F.max(F.struct(F.col("s.matched").alias("matched"), (-(F.col("diagonal") + F.col("s.first"))).alias("place"))).alias("top")
    out = kept.agg(top)
    return materialize(out.select("doc_id", "text_key", "item_id", "n_words", F.col("top.matched").alias("matched"), (-F.col("top.place")).alias("start")), "overlaps")


def best_segment(table: DataFrame, same: str, out: str) -> DataFrame:
    """``table`` with the column ``out`` for ``same``: ``matched, first`` of the segment of an array of
    matches that has most matches among those scoring 0 or more (the first of equals).

    With the places of the substitutions, and the array's ends, as borders, the segment between
    borders ``i < k`` has ``(k's place - k) - (i's place - i)`` matches and scores 0 or more where
    ``i's place - (COST + 1) i <= k's place - (COST + 1) k + COST``. In order of these values the
    least ``i`` so far is the best start of ``k``. Starts before another substitution are left out.
    """
    places = F.filter(F.transform(same, lambda hit, i: F.when(~hit, i)), lambda i: i.isNotNull())
    table = table.withColumn("_borders", F.concat(F.array(F.lit(-1)), places, F.array(F.size(same))))

    # The next border comes by a zip: an array named in a function of its own elements is computed for each of them.
    after = F.slice("_borders", F.lit(2), F.size("_borders"))
    pairs = F.zip_with("_borders", after, lambda x, y: F.struct(x.alias("place"), (y > x + 1).alias("starts")))

    def border(end: int) -> Callable[[Column, Column], Column]:
        return lambda b, i: F.struct(
            (b["place"] - (COST + 1) * i + COST * end).alias("level"), F.lit(end).alias("end"),
            i.alias("i"), b["place"].alias("place"), b["starts"].alias("starts"),
        )

    starts = F.filter(F.transform(pairs, border(0)), lambda b: b["starts"])
    table = table.withColumn("_events", F.sort_array(F.concat(starts, F.transform(pairs, border(1)))))
    zero = F.lit(0)
    begin = F.struct(F.lit(None).cast("int").alias("i"), zero.alias("place"), zero.alias("matched"), zero.alias("first"))

    def step(acc: Column, b: Column) -> Column:
        earlier = (b["end"] == 0) & (acc["i"].isNull() | (b["i"] < acc["i"]))
        matched = (b["place"] - b["i"]) - (acc["place"] - acc["i"])
        first = acc["place"] + 1
        better = (b["end"] == 1) & (b["i"] > acc["i"])
        better &= (matched > acc["matched"]) | ((matched == acc["matched"]) & (first < acc["first"]))
        return F.struct(
            F.when(earlier, b["i"]).otherwise(acc["i"]).alias("i"),
            F.when(earlier, b["place"]).otherwise(acc["place"]).alias("place"),
            F.when(better, matched).otherwise(acc["matched"]).alias("matched"),
            F.when(better, first).otherwise(acc["first"]).alias("first"),
        )

    best = F.aggregate("_events", begin, step, lambda acc: F.struct(acc["matched"].alias("matched"), acc["first"].alias("first")))
    return table.withColumn(out, best).drop("_borders", "_events")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document id and item: ``doc_id, item_id, n_words, matched, start``."""
    found = overlaps(docs, benchmark)
    top = F.max(F.struct("matched", (-F.col("start")).alias("place"))).alias("top")
    best = found.groupBy("doc_id", "item_id", "n_words").agg(top)
    return best.select("doc_id", "item_id", "n_words", F.col("top.matched").alias("matched"), (-F.col("top.place")).alias("start"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a verified overlap with an item."""
    found = overlaps(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    found = if_small(materialize(found, "gone"))
    same = docs["doc_id"].eqNullSafe(found["_id"]) & (document_key(docs["text"]) == found["_key"])
    return docs.join(found, same, "left_anti")
