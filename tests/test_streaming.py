"""Counts in levels and packing in state: restarts, repeated triggers, any order of files."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shardloom.operators import pack
from shardloom.streaming import levels, ordered_pack, streams

SCHEMA = "word string, cnt bigint"


def write_words(spark, path, words):
    spark.createDataFrame([(w,) for w in words], "word string").coalesce(1).write.mode("append").parquet(path)


def test_counts_go_on_over_restarts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(levels, "FAN_IN", 3)
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rng = random.Random(2)
    seen, sizes = Counter(), []
    for step in range(11):
        words = rng.choices("abcdefgh", k=40) + [f"new{step}"]
        seen.update(words)
        write_words(spark, source, words)
        stream = streams.shard_stream(spark, source, "word string")
        counts = levels.count_stream(stream, "word", out, progress)
        assert {r.word: r.cnt for r in counts.collect()} == dict(seen)
        sizes.append(len(levels.live_tables(spark, out)))
    # Tables of a level are summed once there are three: the live ones stay few.
    assert max(sizes) <= 5 and max(t[0] for t in levels.live_tables(spark, out)) == 2
    again = levels.count_stream(streams.shard_stream(spark, source, "word string"), "word", out, progress)
    assert {r.word: r.cnt for r in again.collect()} == dict(seen)


def test_a_table_of_a_higher_level_stands_for_those_it_covers(spark, tmp_path):
    out = str(tmp_path / "out")
    for t, n in (((0, 0, 0), 1), ((0, 1, 1), 2), ((1, 0, 1), 3), ((0, 2, 2), 5)):
        spark.createDataFrame([("a", n)], SCHEMA).write.parquet(levels._path(out, *t))
    # A summary that was not written to the end does not count.
    (tmp_path / "out" / "level-02-000000000-000000002").mkdir()
    assert levels.live_tables(spark, out) == [(0, 2, 2), (1, 0, 1)]
    assert levels.read_counts(spark, out, SCHEMA, "word").collect() == [("a", 8)]
    assert levels.read_counts(spark, str(tmp_path / "none"), SCHEMA, "word").count() == 0


def rows_of(rng, n=60):
    rows, token = [], 0
    for order in range(n):
        size = rng.choice([0, 1, 3, 9, 25])
        rows.append((order % 3 // 2, order, list(range(token, token + size))))
        token += size
    return rows


PACKED = "rank int, order bigint, ids array<int>"


@pytest.mark.parametrize("files", [2, 5])
def test_packing_in_state_is_the_same_for_any_order(spark, tmp_path, files):
    rng = random.Random(files)
    rows = rows_of(rng)
    whole = spark.createDataFrame(rows, PACKED)
    want = {(r["rank"], r.window_id, tuple(r.tokens)) for r in pack.windows(whole, "order", 7, ["rank"]).collect()}
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    mixed = rng.sample(rows, len(rows))
    for k in range(files):  # a run for each file, going on where the last one ended
        spark.createDataFrame(mixed[k::files], PACKED).coalesce(1).write.mode("append").parquet(source)
        if k + 1 == files:
            ordered_pack.end_mark(spark, 59, 60).coalesce(1).write.mode("append").parquet(source)
        stream = streams.shard_stream(spark, source, PACKED, files_per_trigger=1)
        found = ordered_pack.pack_in_order(stream, "rank", "order", 7, 60, out, progress)
    assert {(r["rank"], r.window_id, tuple(r.tokens)) for r in found.collect()} == want and len(want) > 20


def test_rows_later_than_the_delay_fail(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for order in (0, 50, 60, 3):
        spark.createDataFrame([(0, order, [1, 2])], PACKED).coalesce(1).write.mode("append").parquet(source)
        stream = streams.shard_stream(spark, source, PACKED)
        if order == 3:
            with pytest.raises(RuntimeError, match="later than the delay"):
                ordered_pack.pack_in_order(stream, "rank", "order", 3, 5, out, progress)
        else:
            found = ordered_pack.pack_in_order(stream, "rank", "order", 3, 5, out, progress)
    assert [r.tokens for r in found.collect()] == [[1, 2, 1]]


def test_a_rank_that_waits_is_packed_by_many_tasks(spark, tmp_path):
    rows = [(0, k, [k] * 3) for k in range(200)]
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.createDataFrame(rows[::-1], PACKED).repartition(3).write.parquet(source)
    ordered_pack.end_mark(spark, 199, 200).coalesce(1).write.mode("append").parquet(source)
    stream = streams.shard_stream(spark, source, PACKED, files_per_trigger=1)
    found = ordered_pack.pack_in_order(stream, "rank", "order", 7, 200, out, progress)
    want = [k for k in range(200) for _ in range(3)]
    assert {(r.window_id, tuple(r.tokens)) for r in found.collect()} == {(i, tuple(want[7 * i : 7 * i + 7])) for i in range(600 // 7)}
    assert len([f for f in found.inputFiles()]) > 1
    twice = str(tmp_path / "twice")
    spark.createDataFrame([(0, 1, [1]), (0, 1, [2]), (None, 9, [])], PACKED).coalesce(1).write.parquet(twice)
    with pytest.raises(Exception, match="comes twice"):
        ordered_pack.pack_in_order(streams.shard_stream(spark, twice, PACKED), "rank", "order", 3, 5, str(tmp_path / "o2"), str(tmp_path / "p2"))
