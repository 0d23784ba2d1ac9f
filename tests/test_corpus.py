"""Order-dependent operators, corpus preparation, sources."""

import itertools
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardloom.functions import text as tx
from shardloom.operators import chat, corpus, mix, ordered, tasks
from shardloom.sources import conversations as cs
from shardloom.sources import row_groups as rg
from shardloom.sources import shards


def crowded(n=900):
    """Unique keys, a third of them crowded into a tiny stretch."""
    rng = random.Random(1)
    keys = list(range(n // 3)) + rng.sample(range(10**9, 10**12), n - n // 3)
    rng.shuffle(keys)
    return [(k, rng.randint(0, 50), "big" if i % 3 else f"g{i % 5}") for i, k in enumerate(keys)]


@pytest.mark.parametrize("inclusive", [False, True])
def test_running_sum(spark, inclusive):
    rows = crowded()
    df = spark.createDataFrame(rows, "k bigint, v bigint, g string")
    got = {r.k: r.out for r in ordered.running(df, "k", F.col("v"), "out", inclusive=inclusive).collect()}
    total, want = 0, {}
    for k, v, _ in sorted(rows):
        want[k] = total + (v if inclusive else 0)
        total += v
    assert got == want


def test_running_minimum_in_groups(spark):
    rows = crowded()
    df = spark.createDataFrame(rows, "k bigint, v bigint, g string")
    got = {r.k: r.out for r in ordered.running(df, "k", F.col("v"), "out", by=["g"], agg=F.min, inclusive=True).collect()}
    for g, group in itertools.groupby(sorted(rows, key=lambda r: (r[2], r[0])), key=lambda r: r[2]):
        best = None
        for k, v, _ in group:
            best = v if best is None else min(best, v)
            assert got[k] == best


def test_positions_are_a_permutation(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    whole = ordered.shuffled_positions(df, tx.seeded_hash(1, F.col("id"))).collect()
    assert sorted(r.pos for r in whole) == list(range(1000)) and [r.pos for r in sorted(whole)] != list(range(1000))
    grouped = ordered.shuffled_positions(df, tx.seeded_hash(1, F.col("id")), by=["g"]).collect()
    for g in range(3):
        members = [r.pos for r in grouped if r.g == g]
        assert sorted(members) == list(range(len(members)))


def test_cap_never_cuts_a_character(spark):
    texts = ["abc", "aé", "a€", "a😀b", "é" * 5, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for cap in (0, 1, 2, 3, 4, 5, 8):
        for row in df.select("t", tx.cap_bytes(F.col("t"), cap).alias("c")).collect():
            if row.t is None or cap == 0:
                assert row.c == row.t
            else:
                assert row.c == row.t.encode()[:cap].decode(errors="ignore")


@pytest.mark.parametrize("budget,kept", [(0, 5), (1, 1), (3, 1), (4, 2), (6, 2), (7, 3), (14, 4), (15, 5), (99, 5)])
def test_byte_budget_keeps_the_crossing_document(spark, budget, kept):
    docs = [(1, "abc"), (2, "def"), (5, "ghijkl"), (9, "mn"), (12, "o")]
    df = spark.createDataFrame(docs, "k bigint, text string")
    assert sorted(r.k for r in corpus.byte_budget(df, "k", budget).collect()) == [k for k, _ in docs][:kept]


def test_slices_compose_and_clamp(spark):
    df = spark.range(20).withColumnRenamed("id", "idx").withColumn("v", F.col("idx"))
    once = corpus.slice_view(df, 2, 100, 3)
    assert [tuple(r) for r in once.orderBy("idx").collect()] == list(enumerate(range(2, 20, 3)))
    twice = corpus.slice_view(once, 1, 4, 2)
    assert [r.v for r in twice.orderBy("idx").collect()] == list(range(2, 20, 3))[1:4:2]
    for bad in ((-1, None, 1), (3, 2, 1), (0, None, 0)):
        with pytest.raises(ValueError):
            corpus.slice_view(df, *bad)


def test_mixture_and_sequence(spark):
    a = spark.range(5).select(F.lit("a").alias("task"), F.col("id").alias("idx"))
    empty = a.limit(0)
    rows = mix.mixture([a, empty, a, spark.range(3).select(F.lit("c").alias("task"), F.col("id").alias("idx"))]).collect()
    assert sorted(r.pos for r in rows) == list(range(13))
    assert sorted((r.member, r.idx) for r in rows) == [(m, i) for m, n in ((0, 5), (2, 5), (3, 3)) for i in range(n)]
    seq = mix.sequence([a, empty, a]).orderBy("pos").collect()
    assert [(r.pos, r.member, r.idx) for r in seq] == [(m // 2 * 5 + i, m, i) for m in (0, 2) for i in range(5)]


def test_shard_scan(spark, tmp_path):
    assert shards.scan_shards(spark, str(tmp_path / "none")).count() == 0
    folder = tmp_path / "data"
    folder.mkdir()
    for i in (1, 12):
        pq.write_table(pa.table({"text": [f"t{i}", None], "extra": [1, 2]}), folder / f"shard_{i:05d}.parquet")
    (folder / "shard_00003.parquet.tmp").write_bytes(b"half")
    rows = shards.scan_shards(spark, str(folder)).where("text is not null").collect()
    assert sorted((r.shard_id, r.text) for r in rows) == [(1, "t1"), (12, "t12")]
    assert shards.scan_split(spark, "val", str(folder)).count() == 4
    with pytest.raises(FileNotFoundError):
        shards.scan_split(spark, "train", str(tmp_path / "none"))
    with pytest.raises(ValueError):
        shards.scan_split(spark, "test", str(folder))
    with pytest.raises(ValueError):
        shards.scan_shards(spark, str(folder), text="extra")


def test_landing_twice_adds_nothing(spark, tmp_path):
    target = str(tmp_path / "landed")
    df = spark.range(30).select(F.col("id").cast("string").alias("text"), (F.col("id") % 3).cast("int").alias("shard_id"))
    assert shards.land_shards(df.where("shard_id = 1"), target).count() == 10
    assert shards.land_shards(df, target).count() == 30
    assert shards.land_shards(df, target).count() == 30


def test_a_shard_landed_in_part_is_replaced(spark, tmp_path):
    target = str(tmp_path / "landed")
    df = spark.range(100).select(F.col("id").cast("string").alias("text"), (F.col("id") % 2).cast("int").alias("shard_id"))
    assert shards.land_shards(df.where("text < 20 and shard_id = 0"), target).count() == 10
    landed = shards.land_shards(df, target, rows_per_file=15)
    assert landed.count() == landed.distinct().count() == 100
    # The first landing's files are gone, a large shard has several, and the log tells rows of both.
    assert sorted((r.shard_id, r.n_rows) for r in shards.landed_log(spark, target).collect()) == [(0, 50), (1, 50)]
    assert len(list((tmp_path / "landed" / "shard_id=0").glob("*.parquet"))) > 1
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "landed").rglob("*.parquet")}
    shards.land_shards(df, target)
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "landed").rglob("*.parquet")}


def test_a_landing_that_ends_on_the_way_is_repaired(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "landed")
    df = spark.range(60).select(F.col("id").cast("string").alias("text"), (F.col("id") % 3).cast("int").alias("shard_id"))
    shards.land_shards(df.where("shard_id = 2 and text < 30"), target)
    move, calls = shards._Store.move, []

    def fail(self, source, place):
        calls.append(place)
        if len(calls) == 4:  # after the old folder of the last shard was put away
            raise OSError("lost")
        move(self, source, place)

    monkeypatch.setattr(shards._Store, "move", fail)
    with pytest.raises(OSError):
        shards.land_shards(df, target)
    monkeypatch.setattr(shards._Store, "move", move)
    landed = shards.land_shards(df, target)
    assert landed.count() == landed.distinct().count() == 60


def test_exported_shards_of_several_files(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("text"), (F.col("id") % 2).cast("int").alias("shard_id"))
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        shards.export_shards(df, str(tmp_path / "a"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    shards.export_shards(df, str(tmp_path / "b"), rows_per_file=7)
    for name in "ab":
        rows = shards.scan_shards(spark, str(tmp_path / name))
        assert {(r.text, r.shard_id) for r in rows.collect()} == {(str(i), i % 2) for i in range(100)} and rows.count() == 100
        assert len(list((tmp_path / name).glob("shard_00000*.parquet"))) > 2
        assert [r.shard_id for r in shards.shard_ids(spark, str(tmp_path / name)).collect()] == [0, 1]
    # A file that is there already is an error and stays.
    with pytest.raises(FileExistsError):
        shards.export_shards(df.limit(1), str(tmp_path / "a"))
    assert shards.scan_shards(spark, str(tmp_path / "a")).count() == 100


def test_row_groups_are_the_unit(spark, tmp_path):
    for i, n in ((1, 50), (12, 7), (3, 20)):
        rows = pa.table({"text": [f"{i}-{k}" for k in range(n)], "k": list(range(n)), "extra": [0.5] * n})
        pq.write_table(rows, tmp_path / f"shard_{i:05d}.parquet", row_group_size=10)
    (tmp_path / "shard_00099.parquet.tmp").write_bytes(b"half")
    path = str(tmp_path)
    every = rg.scan_row_groups(spark, path, ["text", "k"], world_size=2)
    assert every.rdd.getNumPartitions() == 8 and every.columns == ["text", "k", "file_name", "row_group", "rank"]
    want = {(f"{i}-{k}", k, f"shard_{i:05d}.parquet", k // 10, k // 10 % 2) for i, n in ((1, 50), (12, 7), (3, 20)) for k in range(n)}
    assert {tuple(r) for r in every.collect()} == want
    for rank in (0, 1):
        mine = rg.scan_row_groups(spark, path, ["text", "k"], rank, 2)
        assert {tuple(r) for r in mine.collect()} == {w for w in want if w[4] == rank}
    # Statistics leave groups out before they are read; all rows that meet the filter come.
    some = rg.scan_row_groups(spark, path).where("k >= 33")
    assert some.rdd.getNumPartitions() == 2 and some.count() == 17 and "extra" in some.columns
    assert rg.scan_row_groups(spark, path).where("k > 1000").count() == 0
    with pytest.raises(Exception, match="no column"):
        rg.scan_row_groups(spark, path, ["nope"])
    with pytest.raises(Exception, match="no shards"):
        rg.scan_row_groups(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        rg.scan_row_groups(spark, path, rank=2, world_size=2)


def test_json_lines_round_trip(spark, tmp_path):
    parts = F.array(*[F.struct(F.lit(k).alias("type"), F.lit(t).alias("text")) for k, t in (("text", 'a "quoted"\n'), ("python", "1+1"), ("python_output", "2"))])
    messages = F.array(cs.plain_message("user", F.lit("hé \\ there")), cs.parts_message("assistant", parts))
    rows = spark.range(2).select(F.col("id").alias("idx"), messages.alias("messages")).selectExpr(
        "*", "if(idx = 0, array('A','B'), null) letters", "if(idx = 0, 's', null) subject", "cast(null as string) entry_point", "cast(null as string) test"
    )
    path = cs.write_jsonl(rows, str(tmp_path), "mid", "d4", "train", order="idx")
    read = cs.scan_jsonl(spark, path)
    assert {(str(r.messages), str(r.letters), r.subject) for r in read.collect()} == {
        (str(r.messages), str(r.letters), r.subject) for r in rows.collect()
    }


def test_lines_come_in_order_of_positions(spark, tmp_path):
    messages = F.array(cs.plain_message("user", F.col("text")))
    extras = ("letters array<string>", "subject string", "entry_point string", "test string")
    rows = spark.range(25).select(F.col("id").alias("pos"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    rows = rows.select("pos", messages.alias("messages"), *(F.lit(None).cast(e.split()[1]).alias(e.split()[0]) for e in extras)).repartition(4)
    path = cs.write_jsonl(rows, str(tmp_path), "sft", "d4", "val", order="pos", rows_per_file=10)
    assert path.endswith("datasets/sft/d4/val")
    written = sorted((tmp_path / "datasets" / "sft" / "d4" / "val").glob("part-*"))
    assert [len(f.read_text().splitlines()) for f in written] == [10, 10, 5]
    lines = [line for f in written for line in f.read_text().splitlines()]
    assert [f'"content":"t{i}"' in line for i, line in enumerate(lines)] == [True] * 25
    read = {r.pos: r.value for r in cs.scan_jsonl_in_order(spark, path, rows_per_file=10).collect()}
    assert read == dict(enumerate(lines))
    with pytest.raises(ValueError, match="are not 0 to"):
        cs.write_jsonl(rows.withColumn("pos", F.col("pos") * 2), str(tmp_path), "sft", "d4", "gaps", order="pos")
    empty = cs.write_jsonl(rows.limit(0), str(tmp_path), "sft", "d4", "none", order="pos")
    assert spark.read.text(empty).count() == 0


def test_mixtures_move_conversations_once(spark, monkeypatch):
    rows = [spark.range(30).select((F.col("id") * 7).alias("key"), F.array(F.col("id")).alias("messages"), F.lit(f"t{k}").alias("task")) for k in range(2)]
    placed = [mix.shuffled(r, "key") for r in rows]
    mixed = mix.mixture([placed[0], placed[1], placed[0]], stops=[10, None, 5])
    found = mixed.collect()
    assert sorted(r.pos for r in found) == list(range(45))
    # Equal to mixing whole rows.
    tables = [p.table() for p in placed]
    plain = ordered.shuffled_positions(
        mix._members([tables[0].where("idx < 10"), tables[1], tables[0].where("idx < 5")]), tx.seeded_hash(mix.SEED, F.col("member"), F.col("idx"))
    )
    key = lambda r: (r.pos, r.member, r.idx, r.task, r.messages)
    assert sorted(map(key, found)) == sorted(map(key, plain.collect()))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 2


def test_bad_lines_are_quarantined(spark):
    lines = ['[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]', "   ", "not json",
             '[{"role":"user","content":"q"}]', '[{"role":"assistant","content":"q"},{"role":"user","content":"a"}]',
             '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":[{"type":"image","text":"x"}]}]}',
             '{"messages":[{"role":"user","content":[{"type":"text","text":"x"}]},{"role":"assistant","content":"a"}]}',
             '{"messages":[{"role":"user"},{"role":"assistant","content":"a"}]}',
             '[{"role":"system","content":"s"},{"role":"user","content":"q"},{"role":"assistant","content":"a"}]']
    parsed = cs.parse_lines(spark.createDataFrame([(l,) for l in lines], "value string"))
    good, bad = chat.split_valid(parsed)
    assert good.count() == 2
    reasons = sorted(tuple(r.reasons) for r in bad.collect())
    assert ("not_a_conversation",) in reasons and ("too_few_messages",) in reasons and ("role_order",) in reasons
    assert ("content_not_plain",) in reasons and ("unknown_part",) in reasons and len(reasons) == 6
    assert any("missing_content" in r for r in reasons)
    with pytest.raises(Exception, match="bad conversation"):
        chat.split_valid(parsed, strict=True)[0].collect()


def test_benchmark_selection(spark):
    table = spark.createDataFrame([("all", "test", (1,)), ("auxiliary_train", "train", (2,))], "subset string, split string, train struct<q:int>")
    assert cs.select_benchmark(table, "mmlu", "auxiliary_train", "train").first().q == 2
    for args in (("mmlu", "all", "nope"), ("mmlu", "auxiliary_train", "test"), ("squad", "x", "y")):
        with pytest.raises(ValueError):
            cs.select_benchmark(table, *args)


def test_generators_differ_by_split(spark):
    words = tasks.index_words(spark.createDataFrame([(w,) for w in "strawberry banana kiwi fig melon".split()], "word string"))
    rows = {s: tasks.letter_count_rows(spark, words, 50, s).orderBy("idx").collect() for s in ("train", "test")}
    assert all(r["count"] == r.word.count(r.letter) for s in rows.values() for r in s)
    assert [r.question for r in rows["train"]] != [r.question for r in rows["test"]]
    assert all("{" not in r.question for r in rows["train"])
    with pytest.raises(ValueError):
        tasks.letter_count_rows(spark, words, 5, "val")


def test_exported_shards_have_numbers(spark, tmp_path):
    from shardloom.sources import shards

    rows = spark.createDataFrame([(i, f"text {i}", i % 3) for i in range(30)], "doc_id bigint, text string, shard_id int")
    path = str(tmp_path / "out")
    shards.export_shards(rows.repartition(5), path)
    (tmp_path / "out" / "shard_00007.parquet.tmp").write_text("half")
    assert sorted(p.name for p in (tmp_path / "out").glob("shard_*.parquet")) == [f"shard_0000{i}.parquet" for i in range(3)]
    assert {(r.shard_id, r.text) for r in shards.scan_shards(spark, path).collect()} == {(i % 3, f"text {i}") for i in range(30)}
    assert [r.shard_id for r in shards.shard_ids(spark, path).orderBy("shard_id").collect()] == [0, 1, 2]
    with pytest.raises(FileNotFoundError):
        shards.shard_ids(spark, str(tmp_path))


def test_landing_writes_a_file_a_shard(spark, tmp_path):
    from shardloom.sources import shards

    rows = spark.createDataFrame([(i, i % 4) for i in range(400)], "doc_id bigint, shard_id int").repartition(8)
    target = str(tmp_path / "landed")
    shards.land_shards(rows.where("shard_id < 2"), target)
    assert shards.land_shards(rows, target).count() == 400
    assert len(list((tmp_path / "landed").glob("shard_id=*/*.parquet"))) == 4


def test_complete_stream_comes_back_without_new_input(spark, tmp_path):
    from shardloom.streaming import streams

    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))
    run = lambda: streams.run_to_table(
        streams.stream_piece_counts(streams.shard_stream(spark, source, "text string", 1)), "x", "complete", out, progress
    )
    for k in range(4):
        spark.createDataFrame([("a b a",)], "text string").coalesce(1).write.mode("append").parquet(source)
        first = {r.piece: r.cnt for r in run().collect()}
        assert first == {"a": k + 1, " b": k + 1, " a": k + 1} == {r.piece: r.cnt for r in run().collect()}
    assert len(streams.written_triggers(spark, out)) <= 3


def test_rows_out_of_order_fail_the_packing(spark, tmp_path):
    from shardloom.streaming import streams

    source, out, progress = (str(tmp_path / x) for x in ("in", "out", "progress"))

    def land(keys):
        rows = [(k, 0, [k] * 3) for k in keys]
        spark.createDataFrame(rows, "doc_id bigint, rank int, ids array<int>").coalesce(1).write.mode("append").parquet(source)
        stream = streams.shard_stream(spark, source, "doc_id bigint, rank int, ids array<int>")
        return streams.pack_stream(stream, "rank", "doc_id", 1, 3, out, progress)

    assert land([1, 2, 3]).count() == 2
    assert land([4, 6]).count() == 3
    with pytest.raises(Exception, match="out of order"):
        land([5])


def test_small_shards_and_row_groups_share_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(600).select("id", F.expr("cast(id div 2 as int)").alias("shard_id"))
    counts = rows.groupBy("shard_id").agg(F.count("*").alias("n_rows"))
    assert shards._deal(rows, counts, 1000).rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert shards._deal(rows, counts, 1).rdd.getNumPartitions() == 600
    for i in range(12):
        pq.write_table(pa.table({"k": [10 * i + k for k in range(9)]}), tmp_path / f"shard_{i:05d}.parquet", row_group_size=2)
    want = {(10 * i + k, f"shard_{i:05d}.parquet", k // 2) for i in range(12) for k in range(9)}
    for name in ("MAX_FOOTERS", "MAX_PARTITIONS"):
        with monkeypatch.context() as limited:
            limited.setattr(rg, name, 4)
            reader = rg.RowGroupReader({"path": str(tmp_path), "start": "0", "step": "1"}, ["k"])
            parts = reader.partitions()
            read = [(k, f, g) for p in parts for b in reader.read(p) for k, f, g in zip(*(c.to_pylist() for c in b.columns))]
            assert len(parts) == 1 and len(read) == len(want) and set(read) == want
    assert rg.runs_of([3, 3, 9, 1, 1], 6) == [(0, 2), (2, 3), (3, 5)] and rg.runs_of([], 6) == []
    assert rg.runs_of([0, 2, 2], 0) == [(0, 1), (1, 2), (2, 3)]
