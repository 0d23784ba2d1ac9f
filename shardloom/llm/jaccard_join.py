"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A text is the set of its word n-grams, kept as 64-bit hashes. Two sets with
``100 * common >= percent * union`` share an n-gram among the first
``n - ceil(percent * n / 100) + 1`` of each in any common order; the order here
is rare first. A fixed share of all n-grams, chosen by hash, comes before all others, by the exact
number of texts that hold it (counted by partial sums; ties by hash); the others follow by hash
and are only needed where a text has few of the first kind. N-grams that one text holds for itself
come first of all and join nothing. A filter of those that several hold
(``common.key_filter``, a false hit is found out by the join) keeps all others from being shuffled with their texts.
Sets that are equal are one representative.

Prefix n-grams held by several representatives give candidate pairs in two steps, so that a
group of near copies never becomes all its pairs. First every member is
compared with two of the pivots of its n-grams (the smallest member of an n-gram and
length class is its pivot), and the links found are contracted to components. Then only members whose components still
differ are paired, where length, position, the pivot's distance (a metric:
two texts differ at least by the difference of their distances) and parity sketches of the sets (a bit that differs is an n-gram
that one side has alone) leave a link possible, so texts that share no more than passages are never paired. The first
n-gram that two members hold in common makes their pair, where the rest of both sets leaves the overlap possible. Pairs are
made distinct, pass a suffix filter on set profiles (counts by ``PROFILE`` hash
ranges bound the overlap), and are verified once, exactly, on the whole sets.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; a text with fewer words than n
is one n-gram of all its words; null and wordless texts are empty and linked with
nothing. Rows are told apart by an own number, so repeated and null ids are
harmless; a component's id is the smallest id in it (null if it has none). An
empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import hashed_words, if_small, key_filter, may_hold, mix, not_white
from shardloom.llm.components import components
from shardloom.session import discard, materialize, session_conf

#: Share of all n-grams that is counted; at least twice as large as a prefix.
COUNTED = 0.5
PROFILE = 64
#: First open n-grams of a row that tell which n-gram makes a pair.
FIRST = 16
#: 64-bit words of a sketch: for each of their bits, whether the set has an odd number of n-grams there.
SKETCH = 8
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _gram_runs(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, word limits, word hashes and the n-gram hash that starts at each word, by row range."""
    for lo, hi, limits, hashes in hashed_words(column, not_white()):
        grams = hashes[: max(0, len(hashes) - n + 1)].copy()
        for i in range(1, n):
            grams = mix(grams * _STEPS[0] + hashes[i : len(grams) + i] + np.uint64(i))
        yield hi - lo, limits, hashes, grams


def gram_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For every row of a text column its sorted distinct n-gram hashes."""
    for rows, limits, hashes, grams in _gram_runs(column, n):
        for a, b in zip(limits[:rows].tolist(), limits[1:].tolist()):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for h in hashes[a:b]:
                    whole = mix(whole * _STEPS[1] + h)
                yield whole
            else:
                yield hashes[:0]


_WORDS = [f"s{k}" for k in range(SKETCH)]


def _digests(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on order, as two signed numbers."""
    a, b = mix(grams * _STEPS[1] + np.uint64(1)), mix(grams * _STEPS[2] + np.uint64(2))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


FACTS = "row bigint, doc_id bigint, text_key bigint, n bigint, d1 bigint, d2 bigint, class int, profile binary, counted array<bigint>, rest array<bigint>, " + ", ".join(f"s{k} bigint" for k in range(SKETCH))


def facts_of(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """One row per text: set size, digest, length class, profile, n-grams that are counted, and as many others as a prefix may need."""
    ratio = math.log(100 / percent)
    share = min(1.0, max(COUNTED, 2 * (100 - percent) / 100))
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
        flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            sizes, digests, classes, profiles, counted, rest = [], [], [], [], [], []
            sketches = np.zeros((batch.num_rows, SKETCH), np.int64)
            for grams in gram_sets(batch.column(1), n):
                size = len(grams)
                bits = np.bincount((mix(grams ^ _STEPS[0]) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) % 2
                sketches[len(sizes)] = np.packbits(bits.astype(np.uint8)).view(np.int64)
                sizes.append(size)
                digests.append(_digests(grams))
                classes.append(int(math.log(size) / ratio) if size else -1)
                spread = np.bincount((grams >> np.uint64(64 - PROFILE.bit_length() + 1)).astype(np.int64), minlength=PROFILE)
                profiles.append(spread.astype(np.uint32).tobytes())
                first = mix(grams ^ _STEPS[2]) <= limit
                counted.append(grams[first])
                missing = max(0, size - -(-percent * size // 100) + 1 - len(counted[-1])) if size else 0
                rest.append(grams[~first][:missing])
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows), batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()), pa.array(classes, pa.int32()),
                    pa.array(profiles, pa.binary()), lists(counted), lists(rest), *(pa.array(sketches[:, k]) for k in range(SKETCH)),
                ],
                names=["row", "doc_id", "text_key", "n", "d1", "d2", "class", "profile", "counted", "rest", *_WORDS],
            )

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64("text").alias("text_key"))
    return slim.mapInArrow(cut, FACTS)


def _held_by_several(facts: DataFrame, held: np.ndarray) -> DataFrame:
    """``row, gram, late``: n-grams of the rows that a filter may hold; ``late`` is the place among those not counted, else null."""
    shared = facts.sparkSession.sparkContext.broadcast(held)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in ("counted", "rest"):
                lists = batch.column(batch.schema.get_field_index(name))
                grams = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(lists.offsets.to_numpy())
                hit = np.flatnonzero(may_hold(shared.value, grams.view(np.uint64)))
                of = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(grams)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                late = pa.array(place[hit], pa.int64(), mask=np.full(len(hit), name == "counted"))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of[hit])), pa.array(grams[hit]), late], names=["row", "gram", "late"])

    return facts.select("row", "counted", "rest").mapInArrow(pick, "row bigint, gram bigint, late bigint")


def prefix_members(facts: DataFrame, percent: int) -> DataFrame:
    """``gram, row, n, class, pos, own``: prefix n-grams that several rows hold. A written table.

    ``own`` is how many n-grams are known to be held by this row alone. Hot n-grams are counted by partial sums.
    """
    every = facts.select("row", F.explode(F.concat("counted", "rest")).alias("gram"))
    shared = every.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    shared = materialize(shared, "shared")
    found = materialize(_held_by_several(facts, key_filter(shared, "gram")).join(shared, "gram"), "found")
    discard(shared)
    sizes = facts.select("row", "n", "class", F.size("counted").cast("bigint").alias("c"))
    rows = found.groupBy("row").agg(F.count("*").alias("several"), F.count("late").alias("several_late"))
    # All counted n-grams of all rows were counted; of the others only those that a prefix may need.
    sizes = sizes.join(rows, "row").withColumn("alone", F.col("c") - (F.col("several") - F.col("several_late")))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # Rows whose prefix holds only n-grams of their own have no partner.
    open_ = sizes.where(F.col("alone") < length).withColumn("length", length).select("row", "n", "class", "c", "alone", "length")
    # A row has no more n-grams than its text has words.
    mine = Window.partitionBy("row").orderBy(F.col("late").isNotNull(), "late", "df", "gram")
    placed = found.join(open_, "row").withColumn("before", F.row_number().over(mine) - 1)
    pos = F.when(F.col("late").isNull(), F.col("alone") + F.col("before")).otherwise(F.col("c") + F.col("late"))
    placed = placed.withColumn("pos", pos.cast("bigint")).where(F.col("pos") < F.col("length"))
    members = placed.select("gram", "row", "n", "class", "pos", F.col("alone").alias("own"))
    members = materialize(members, "members")
    discard(found)
    return members


def _lengths_fit(a: Column, b: Column, percent: int) -> Column:
    return (a * percent <= b * 100) & (b * percent <= a * 100)


def _overlap_fits(x: dict[str, Column], y: dict[str, Column], percent: int) -> Column:
    """What is known of two prefixes leaves the overlap that a link needs.

    If this is the first n-gram that both have, common are at most those from this one
    on; n-grams that a row has for itself are all in the symmetric difference.
    """
    both = x["n"] + y["n"]
    here = F.least(x["n"] - x["pos"], y["n"] - y["pos"])
    apart = both - x["own"] - y["own"]
    return (here * (100 + percent) >= both * percent) & (apart * (100 + percent) >= both * percent * 2)


def _sketches_fit(x: str, y: str, percent: int) -> Column:
    """Every bit in which two sketches differ takes an n-gram that one side has alone."""
    apart = sum((F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _WORDS), F.lit(0)).cast("bigint")
    both = F.col(f"{x}.n") + F.col(f"{y}.n")
    return (both - apart) * 100 >= (both + apart) * percent


def suffix_bound(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """``a, b`` -> the same with sizes and ``least_far``, a lower bound of the Jaccard distance.

    Set sizes by hash range differ by at most the size of the symmetric difference.
    """
    side = lambda x: facts.select(F.col("row").alias(x), F.col("n").alias(f"n_{x}"), F.col("profile").alias(f"p_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(k) for k in ("a", "b", "n_a", "n_b"))
            if batch.num_rows == 0:
                continue
            p, q = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(-1, PROFILE).astype(np.int64) for k in ("p_a", "p_b"))
            total = n_a.to_numpy() + n_b.to_numpy()
            apart = np.abs(p - q).sum(1)
            far = 1 - (total - apart) / np.maximum(total + apart, 1)
            common = (total - apart) // 2  # at most
            possible = 100 * common >= percent * (total - common)
            yield pa.RecordBatch.from_arrays(
                [a, b, pa.array(far), pa.array(possible)], names=["a", "b", "least_far", "possible"]
            )

    columns = both.select("a", "b", "n_a", "n_b", "p_a", "p_b")
    return columns.mapInArrow(bound, "a bigint, b bigint, least_far double, possible boolean")


def gram_table(docs: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """``row, grams`` (sorted hashes as bytes) of the texts of ``rows`` (``row, doc_id, d1, d2``).

    Texts are found by id and digest; several rows of one id and digest give the set again.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(gram_sets(batch.column(1), n))
            digests = [_digests(g) for g in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()), pa.array([g.tobytes() for g in found], pa.binary()),
                ],
                names=["doc_id", "d1", "d2", "grams"],
            )

    ids = rows.select("doc_id").distinct()
    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    wanted = slim.join(if_small(ids), slim["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    found = wanted.mapInArrow(sets, "doc_id bigint, d1 bigint, d2 bigint, grams binary").alias("f")
    rows = if_small(rows).alias("r")
    same = (F.col("f.d1") == F.col("r.d1")) & (F.col("f.d2") == F.col("r.d2")) & F.col("f.doc_id").eqNullSafe(F.col("r.doc_id"))
    return found.join(rows, same).select("r.row", "f.grams")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Exact distance of each pair: ``a, b, far, linked``."""
    side = lambda x: sets.select(F.col("row").alias(x), F.col("grams").alias(f"g_{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, linked = [], []
            for x, y in zip(batch.column("g_a"), batch.column("g_b")):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                union = len(p) + len(q) - common
                far.append(1 - common / union)
                linked.append(100 * common >= percent * union)
            columns = [batch.column("a"), batch.column("b"), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "far", "linked"])

    return both.select("a", "b", "g_a", "g_b").mapInArrow(compare, "a bigint, b bigint, far double, linked boolean")


def _checked(docs: DataFrame, pairs: DataFrame, facts: DataFrame, n: int, percent: int) -> DataFrame:
    """``a, b, least, most, linked`` for distinct pairs: what is known of their distances."""
    bounded = materialize(suffix_bound(pairs, facts, percent), "bounded")
    hopeful = bounded.where("possible")
    rows = hopeful.select(F.col("a").alias("row")).union(hopeful.select(F.col("b").alias("row"))).distinct()
    wanted = materialize(facts.join(rows, "row").select("row", "doc_id", "d1", "d2"), "wanted")
    sets = materialize(gram_table(docs, wanted, n), "sets")
    exact = verify(hopeful, sets, percent)
    rest = bounded.where(~F.col("possible")).select("a", "b", F.col("least_far").alias("least"), F.lit(1.0).alias("most"), F.lit(False).alias("linked"))
    checked = materialize(exact.select("a", "b", F.col("far").alias("least"), F.col("far").alias("most"), "linked").union(rest).distinct(), "checked")
    discard(bounded, wanted, sets)
    return checked


def similar_groups(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``row, doc_id, text_key, n, root`` per text: ``root`` names its group of linked texts, null for empty sets.

    The result is a written table.
    """
    spark = docs.sparkSession
    # Binary columns of whole sets: few rows go to a worker at once.
    with session_conf(spark, spark_sql_execution_arrow_maxRecordsPerBatch="1000"):
        whole = materialize(facts_of(docs, n, percent), "facts")
        table = materialize(whole.drop("counted", "rest"), "rows")
        key = ["n", "d1", "d2"]
        heads = table.where("n > 0").groupBy(*key).agg(F.min("row").alias("rep"), F.count("*").alias("copies"))
        heads = materialize(heads, "heads")
        several = if_small(materialize(heads.where("copies > 1").select(*key, "rep"), "several"))
        copies = table.select("row", *key).join(several, key).where("row <> rep").select("row")
        copies = if_small(materialize(copies, "copies"))
        slim = table.where("n > 0").join(copies, "row", "left_anti").select("row", "doc_id", "n", "d1", "d2", "profile")
        members = prefix_members(whole.where("n > 0").join(copies, "row", "left_anti"), percent)
        discard(whole)
        # The pivot is the member with the fewest n-grams of its own: the likeliest centre.
        best = F.struct("own", "row")
        pivots = members.groupBy("gram", "class").agg(F.min_by("row", best).alias("pivot"), F.min_by("n", best).alias("pivot_n"))
        pivots = materialize(pivots, "pivots")
        first = materialize(_first_pairs(members, pivots, percent), "first")
        checked = _checked(docs, first, slim, n, percent)
        found = materialize(components(checked.where("linked").select("a", "b")), "components")
        left = _second_pairs(members, checked, found, table.select("row", *_WORDS), percent)
        left = materialize(left.join(first, ["a", "b"], "left_anti"), "left")
        more = _checked(docs, left, slim, n, percent).where("linked").select("a", "b")
        if not more.isEmpty():
            stars = found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            found = materialize(components(stars.union(more)), "components")
        roots = heads.join(found, heads["rep"] == found["node"], "left")
        roots = roots.select(*key, F.coalesce("root", "rep").alias("root"))
        groups = materialize(table.join(roots, key, "left").select("row", "doc_id", "text_key", "n", "root"), "groups")
        discard(table, heads, members, pivots, first, checked, left)
        return groups


def _first_pairs(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Two pivots for each member, and for each pivot that of the next length class of its n-gram."""
    fit = (F.col("row") != F.col("pivot")) & _lengths_fit(F.col("n"), F.col("pivot_n"), percent)
    near = members.join(pivots, ["gram", "class"]).where(fit)
    # The smallest pivot gathers a group in one star; the one by hash joins stars.
    two = near.groupBy("row").agg(F.min("pivot").alias("low"), F.min_by("pivot", F.xxhash64("pivot")).alias("other"))
    two = two.select(F.explode(F.array("low", "other")).alias("pivot"), "row")
    stars = two.select(F.least("pivot", "row").alias("a"), F.greatest("pivot", "row").alias("b"))
    above = pivots.select("gram", (F.col("class") - 1).alias("class"), F.col("pivot").alias("up"), F.col("pivot_n").alias("up_n"))
    steps = pivots.join(above, ["gram", "class"]).where(_lengths_fit(F.col("pivot_n"), F.col("up_n"), percent))
    steps = steps.groupBy("pivot").agg(F.min("up").alias("up"))
    ordered = steps.select(F.least("pivot", "up").alias("a"), F.greatest("pivot", "up").alias("b")).where("a <> b")
    return stars.union(ordered).distinct()


def _second_pairs(members: DataFrame, checked: DataFrame, found: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    # What is known of each row's distance to its smallest partner, a centre it may share with others.
    # The centre that gathers most rows is the one whose distances say most.
    both = checked.select("a", "b", "least", "most").union(checked.select("b", "a", "least", "most"))
    size = both.groupBy("a").agg(F.count("*").alias("size"))
    known = both.join(size, "a").groupBy(F.col("b").alias("row"))
    best = F.struct("size", "a")
    known = known.agg(F.max_by("a", best).alias("centre"), F.max_by("least", best).alias("least"), F.max_by("most", best).alias("most"))
    alone = F.col("centre").isNull()
    told = (
        members.alias("members").join(known, "row", "left")
        .join(found.withColumnRenamed("node", "row"), "row", "left")
        .select(
            "gram", "row", "n", "pos", F.col("members.own").alias("own"), F.coalesce("root", "row").alias("root"), F.coalesce("centre", "row").alias("centre"),
            F.when(alone, 0.0).otherwise(F.col("least")).alias("least"), F.when(alone, 0.0).otherwise(F.col("most")).alias("most"),
        )
    )
    told = materialize(told, "told")
    # N-grams whose holders are all in one component have nothing left to find.
    ends = told.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_ = materialize(told.join(if_small(materialize(ends.where("low < high").select("gram"), "open")), "gram"), "open-told")
    discard(told)
    # Places of shared n-grams follow one order in all rows: by the count of holders, then by hash.
    mine = Window.partitionBy("row").orderBy("pos")
    firsts = open_.select("row", "pos", "gram").withColumn("k", F.row_number().over(mine)).where(F.col("k") <= FIRST)
    firsts = firsts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "gram")))["gram"].alias("firsts"))
    whole = materialize(open_.join(sketches.join(firsts, "row"), "row"), "open-members")
    discard(open_)
    # A pair is made by the first n-gram that both hold, not by each: it is the first in both lists of
    # firsts, if any is (all before it are in them too). Other pairs are made distinct.
    x, y = whole.alias("x"), whole.alias("y")
    limit = F.lit((100 - percent) / 100 + 1e-9)
    col = lambda side, name: F.col(f"{side}.{name}")
    apart = (col("x", "centre") == col("y", "centre")) & (
        (col("x", "least") - col("y", "most") > limit) | (col("y", "least") - col("x", "most") > limit)
    )
    pairs = x.join(
        y,
        (col("x", "gram") == col("y", "gram"))
        & (col("x", "row") < col("y", "row"))
        & (col("x", "root") != col("y", "root"))
        & _lengths_fit(col("x", "n"), col("y", "n"), percent)
        & _overlap_fits(*({name: col(side, name) for name in ("n", "pos", "own")} for side in "xy"), percent)
        & ~apart
        & _sketches_fit("x", "y", percent)
        & (F.coalesce(F.get(F.array_intersect(col("x", "firsts"), col("y", "firsts")), F.lit(0)), col("x", "gram")) == col("x", "gram")),
    )
    return pairs.select(col("x", "row").alias("a"), col("y", "row").alias("b")).distinct()


def join_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    groups = similar_groups(docs, n, percent)
    # Only groups of two rows or more need their smallest id looked up.
    low = groups.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("low"), F.count("*").alias("rows"))
    low = if_small(materialize(low.where("rows > 1").select("root", "low"), "low"))
    named = groups.join(low, "root", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("low", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of linked texts: the one with the smallest id.

    Ids compare as numbers, a null id is the last; of equal ids one text stays, and
    of rows equal in id and text one. Rows with empty sets all stay.
    """
    told = similar_groups(docs, n, percent).where("root IS NOT NULL")
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_key")
    groups = told.groupBy("root").agg(F.min(rank).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    groups = if_small(materialize(groups.select("root", "first.doc_id", "first.text_key"), "groups"))
    mine = told.alias("t").join(groups.alias("g"), "root")
    same = F.col("t.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("t.text_key") == F.col("g.text_key"))
    mine = materialize(mine.select("t.doc_id", "t.text_key", same.alias("stays")), "mine")
    own = [docs["doc_id"].cast("bigint"), F.xxhash64(docs["text"])]
    match = lambda side: own[0].eqNullSafe(side["_id"]) & (own[1] == side["_key"])
    keys = lambda df: df.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    gone = if_small(materialize(keys(mine.where("NOT stays")).distinct(), "gone"))
    out = docs.join(gone, match(gone), "left_anti")
    again = mine.where("stays").groupBy("doc_id", "text_key").count().where("count > 1")
    again = materialize(keys(again), "again")
    if again.isEmpty():
        return out
    again = if_small(again)
    once = out.join(again, match(again), "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(again, match(again), "left_anti").union(once)
