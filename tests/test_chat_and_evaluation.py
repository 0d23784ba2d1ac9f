"""Rendering, packing, collation, grading and streaming on small fixtures."""

import math
import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shardloom.operators import audit, chat, evaluation as ev, pack, reports, requests, tasks
from shardloom.operators import tokens as tk
from shardloom.operators.vocabulary import Tokenizer
from shardloom.session import materialize
from shardloom.sources.conversations import parts_message, plain_message
from shardloom.streaming import streams

TOK = Tokenizer(((116, 104, 9), (256, 101, 7)))  # "th", "the"
S = {name.strip("<|>"): TOK.special_id(name) for name in TOK.specials}


def ids_of(text):
    return list(text.encode()) if "th" not in text else tk.encode_piece(text, {(116, 104): 256, (256, 101): 257})


def conversation(spark, system=False):
    part = lambda k, t: F.struct(F.lit(k).alias("type"), F.lit(t).alias("text"))
    messages = [plain_message("system", F.lit("s"))] if system else []
    messages += [
        plain_message("user", F.lit("q")),
        parts_message("assistant", F.array(part("text", "the"), part("python", "1"), part("python_output", "2"))),
        plain_message("user", F.lit("r")),
        plain_message("assistant", F.lit("b")),
    ]
    return spark.range(1).select(F.col("id").alias("conv_id"), F.array(*messages).alias("messages"))


def expected(user):
    steps = [(S["bos"], 0), (S["user_start"], 0)] + [(b, 0) for b in user.encode()] + [(S["user_end"], 0)]
    steps += [(S["assistant_start"], 0), (257, 1), (S["python_start"], 1), (49, 1), (S["python_end"], 1)]
    steps += [(S["output_start"], 0), (50, 0), (S["output_end"], 0), (S["assistant_end"], 1)]
    steps += [(S["user_start"], 0), (114, 0), (S["user_end"], 0), (S["assistant_start"], 0), (98, 1), (S["assistant_end"], 1)]
    return [s[0] for s in steps], [s[1] for s in steps]


@pytest.mark.parametrize("system,user", [(False, "q"), (True, "s\n\nq")])
@pytest.mark.parametrize("limit", [2048, 7])
def test_render(spark, system, user, limit):
    row = chat.render(conversation(spark, system), TOK, limit).first()
    ids, mask = expected(user)
    assert row.ids == ids[:limit] and row["mask"] == mask[:limit]


def test_completion_prompt(spark):
    row = chat.completion_prompts(conversation(spark), TOK).first()
    ids, _ = expected("q")
    assert row.ids == ids[:-3] + [S["assistant_start"]]
    open_ended = conversation(spark).withColumn("messages", F.slice("messages", 1, 3))
    assert chat.completion_prompts(open_ended, TOK).count() == 0 and chat.open_conversations(open_ended).count() == 1


def test_turn_form_equals_row_form(spark):
    turns = []
    for conv in range(6):
        roles = (["system"] if conv % 2 else []) + ["user", "assistant"] * (conv + 1) + (["user"] if conv == 3 else [])
        turns += [(conv, i, r, f"{r} says the {i}") for i, r in enumerate(roles)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    rows = chat.assemble(df)
    for limit in (2048, 12):
        whole = {r.conv_id: r.ids for r in chat.render(rows, TOK, limit).collect()}
        first = {r.conv_id: r.ids for r in chat.render(chat.assemble(chat.first_turns(df, limit)), TOK, limit).collect()}
        assert whole == first
        a = {r.conv_id: r.ids for r in chat.completion_prompts(rows, TOK, limit).collect()}
        b = {r.conv_id: r.ids for r in chat.completion_prompts_of_turns(df, TOK, max_tokens=limit).collect()}
        assert a == b and 3 not in a and len(a) == 5


def test_tool_parts(spark):
    cases = {
        "plain": [("text", "plain")],
        "<<1+1=2>>2": [("text", ""), ("python", "1+1"), ("python_output", "2"), ("text", "2")],
        "a<<5>>": [("text", "a"), ("python", "5"), ("python_output", ""), ("text", "")],
        "<<a=b=c>>": [("text", ""), ("python", "a=b"), ("python_output", "c"), ("text", "")],
        "<<1=1>><<2=2>>": [("text", ""), ("python", "1"), ("python_output", "1"), ("text", ""), ("python", "2"), ("python_output", "2"), ("text", "")],
        "": [("text", "")],
    }
    df = spark.createDataFrame([(k,) for k in cases], "a string")
    for row in df.select("a", tasks.tool_parts(F.col("a")).alias("p")).collect():
        assert [(p.type, p.text) for p in row.p] == cases[row.a], row.a


def test_calculator(spark):
    cases = {
        "1+2*3": "7", "(1+2)*3": "9", "12/60": "0.2", "1,000+1": "1001", "2**3": None, "7//2": "3", "1/0": None, "007": None,
        "'Abc'.lower().count('a')": "1", "('aab').count('a')": "2", "1+1\n": None, "'a'.join('b')": None, "'abc'.upper()": None,
        "'strawberry'.count('r')": "3", '"aaa".count("aa")': "1", "'import'.count('i')": None, "len('a')": None, "-5": "-5", "": None, "abc": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    assert {r.c: r.result for r in audit.call_result(df, "c").collect()} == cases


def stream_rows(spark, lengths):
    token, rows = 0, []
    for key, n in enumerate(lengths):
        rows.append((key * 10, list(range(token, token + n))))
        token += n
    return spark.createDataFrame(rows, "k bigint, ids array<int>"), token


@pytest.mark.parametrize("lengths", [[3, 4, 5], [50], [1, 1], [0, 7, 0, 30, 2, 9, 1], [7, 7, 7]])
def test_windows_are_the_stream(spark, lengths):
    df, total = stream_rows(spark, lengths)
    rows = pack.windows(df, "k", 7).orderBy("window_id").collect()
    flat = [t for r in rows for t in r.tokens]
    assert flat == list(range(total // 7 * 7)) and all(len(r.tokens) == 7 for r in rows)


def random_stream(spark, seed, n=400):
    rng = random.Random(seed)
    rows, token = [], 0
    for key in rng.sample(range(10**6), n):
        rows.append([key, rng.choice([0, 1, 5, 40, 900]) if seed else 3, rng.randint(0, 2)])
    for row in sorted(rows):
        row[1] = list(range(token, token := token + row[1]))
    return spark.createDataFrame([tuple(r) for r in rows], "k bigint, ids array<int>, rank int").repartition(5), sorted(rows)


@pytest.mark.parametrize("seed, width", [(0, 7), (1, 7), (2, 250), (3, 5000)])
def test_windows_over_many_ranges(spark, seed, width):
    """Ranges shorter and longer than a window, documents longer than both, groups."""
    df, rows = random_stream(spark, seed)
    for rank in (None, 0, 1, 2):
        mine = [r for r in rows if rank is None or r[2] == rank]
        tokens = [(t, r[0]) for r in mine for t in r[1]]
        want = [tokens[i : i + width] for i in range(0, len(tokens), width)]
        found = pack.windows(df, "k", width, [] if rank is None else ["rank"], keep_rest=True)
        found = (found if rank is None else found.where(F.col("rank") == rank)).orderBy("window_id").collect()
        assert [r.tokens for r in found] == [[t for t, _ in w] for w in want]
        assert [(r.window_id, r.last_key) for r in found] == [(i, w[-1][1]) for i, w in enumerate(want)]


def test_epochs_are_cut_without_repeating_rows(spark):
    df, rows = random_stream(spark, 4, 60)
    order = {r[0]: i for i, r in enumerate(rows)}
    places = spark.createDataFrame(list(order.items()), "k bigint, pos bigint")
    tokens = [(t, e * 60 + order[r[0]]) for e in range(3) for r in rows for t in r[1]]
    found = pack.windows(df.join(places, "k"), "pos", 77, epochs=3, size=60).orderBy("window_id").collect()
    want = [tokens[i : i + 77] for i in range(0, len(tokens) - 76, 77)]
    assert [(r.tokens, r.last_key) for r in found] == [([t for t, _ in w], w[-1][1]) for w in want]


def test_token_arrays_move_once(spark, monkeypatch):
    """One exchange holds token arrays; what is shuffled after it are the pieces at the ends of ranges."""
    df, _ = stream_rows(spark, [30] * 200)
    seen = []
    monkeypatch.setattr(pack, "materialize", lambda table, name: seen.append(table) or materialize(table, name))
    found = pack.windows(df, "k", 50)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Window" not in plan.split("RepartitionByExpression")[0]
    pieces = spark.read.parquet(*[p for p in seen and found.inputFiles()])
    assert pieces.where(F.size("tokens") < 50).count() <= 2 * 4 * 8 < found.count()


def test_pack_shapes(spark):
    df, _ = stream_rows(spark, [5, 9, 11, 2])
    rows = pack.pack(df, "k", 2, 3).orderBy("batch_id", "row_in_batch").collect()
    assert [(r.batch_id, r.row_in_batch) for r in rows] == [(b, i) for b in range(3) for i in range(2)]
    assert rows[0].inputs == [0, 1, 2] and rows[1].inputs == [3, 4, 5] and rows[1].targets == [4, 5, 6]
    assert rows[2].inputs == [7, 8, 9]


def test_pack_epochs_reports_progress(spark):
    df, _ = stream_rows(spark, [4, 4, 4])
    df = df.withColumn("pos", F.expr("k div 10"))
    rows = pack.pack_epochs(df, "pos", 3, 1, 4, epochs=2).orderBy("batch_id").collect()
    assert [(r.batch_id, round(r.progress, 3), r.last_step) for r in rows] == [(0, 0.667, False), (1, 0.0, True), (2, 0.333, True), (3, 0.667, True)]
    counted = pack.pack_epochs(df, "pos", 3, 1, 4, num_iterations=2).orderBy("batch_id").collect()
    assert [(r.progress, r.last_step) for r in counted] == [(0.5, False), (1.0, True)]


def test_collate(spark):
    rows = [(0, [1, 2, 3], [0, 1, 1]), (1, [4, 5], [0, 0]), (2, [6, 7, 8, 9], [0, 0, 1, 1]), (3, [5], [0]), (4, [1, 2], [0, 1])]
    df = spark.createDataFrame(rows, "idx bigint, ids array<int>, mask array<int>")
    got = {r.idx: r for r in pack.collate(df, 99, 2).collect()}
    assert got[0].inputs == [1, 2] and got[0].targets == [2, 3]
    assert got[1].inputs == [4, 99] and got[1].targets == [-1, -1]
    assert got[2].targets == [-1, 8, 9] and got[3].inputs == [99, 99, 99]
    assert (got[4].batch_id, got[4].inputs, got[4].targets) == (2, [1], [2])


def test_fewshot_never_draws_itself(spark):
    items = spark.createDataFrame([("t", i) for i in range(9)] + [("u", 0), ("v", 0), ("v", 1)], "task string, idx bigint")
    rows = ev.fewshot_pairs(items, 4).collect()
    for i in range(9):
        mine = [r.shot_idx for r in rows if r.task == "t" and r.idx == i]
        assert len(set(mine)) == 4 and i not in mine
    assert [r.shot_idx for r in rows if r.task == "v"] in ([0, 1], [1, 0]) and not [r for r in rows if r.task == "u"]


def test_fewshot_sets_overlap_as_by_chance(spark):
    n, k = 60, 4
    items = spark.createDataFrame([("t", i) for i in range(n)], "task string, idx bigint")
    sets = {}
    for r in ev.fewshot_pairs(items, k).collect():
        sets.setdefault(r.idx, {})[r.shot] = r.shot_idx
    pairs = [(a, b) for a in sets for b in sets if a < b]
    common = sum(len(set(sets[a].values()) & set(sets[b].values())) for a, b in pairs) / len(pairs)
    assert abs(common - k * k / n) < 0.05  # a ring of neighbours has the same mean, but
    spread = sum(len(set(sets[a].values()) & set(sets[b].values())) >= 2 for a, b in pairs) / len(pairs)
    assert spread < 0.045  # sets of neighbours would share two or more in 0.08 of all pairs
    used = [i for s in sets.values() for i in s.values()]
    assert max(used.count(i) for i in range(n)) < 14 and len({s[0] for s in sets.values()}) > n // 2


def test_prompts_without_examples(spark):
    item = spark.createDataFrame([("t", 0, " q \n", ["x", "y"], 1, "end")], "task string, idx bigint, query string, choices array<string>, gold int, continuation string")
    assert [r.prompt for r in ev.prompts_mc(item, F.lit("=")).orderBy("option").collect()] == [" q \n=x", " q \n=y"]
    lm = ev.prompts_lm(item.withColumnRenamed("query", "context"), F.lit(" ")).first()
    assert (lm.prompt_without, lm.prompt_with) == ("q", "q end")


@pytest.mark.parametrize("seqs,left,right", [([[1, 2, 3], [1, 2, 4]], 2, 0), ([[1, 2], [1, 2]], 2, 2), ([[1], [1, 2]], 1, 0), ([[3, 2], [1, 3, 2]], 0, 2), ([[], [1]], 0, 0)])
def test_common_length(spark, seqs, left, right):
    df = spark.createDataFrame([(seqs,)], "s array<array<int>>")
    row = df.select(ev.common_length(F.col("s")).alias("l"), ev.common_length(F.col("s"), "right").alias("r")).first()
    assert (row.l, row.r) == (left, right)


def test_spans_and_truncation(spark):
    df = spark.createDataFrame([(1, 0, [1, 2, 3]), (1, 1, [1, 2, 3, 4])], "i int, option int, ids array<int>")
    lm = ev.answer_spans(df, "language_modeling", ["i"]).first()
    assert (lm.start, lm.end, lm.valid) == (3, 4, True)
    swapped = ev.answer_spans(df.withColumn("option", 1 - F.col("option")), "language_modeling", ["i"]).first()
    assert not swapped.valid
    mc = ev.answer_spans(df, "multiple_choice", ["i"])
    cut = {r.option: (r.ids, r.start, r.end, r.valid) for r in ev.left_truncate(mc, 2).collect()}
    assert cut == {0: ([2, 3], 2, 2, True), 1: ([3, 4], 1, 2, True)}
    # With one token left the span of option 0 ends at its start; of the longer one it still fits.
    assert not ev.left_truncate(mc.withColumn("start", F.lit(1)), 1).where("valid").where("option = 1").count()
    with pytest.raises(ValueError):
        ev.answer_spans(df, "other", ["i"])


def test_choice_ties_take_the_first(spark):
    losses = spark.createDataFrame([(1, o, p, l) for o, l in ((0, 2.0), (1, 1.0), (2, 1.0)) for p in range(4)], "i int, option int, pos int, loss double")
    spans = spark.createDataFrame([(1, o, 2, 4) for o in range(3)], "i int, option int, start int, end int")
    row = ev.grade_choice(losses, spans, spark.createDataFrame([(1, 1)], "i int, gold int"), ["i"]).first()
    assert row.predicted == 1 and row.correct


def brute_grade_lm(predictions, spans):
    """Grades of (key, pos, target, predicted) rows by (key, start, end) rows, a position at a time."""
    seen = {}
    for key, pos, target, predicted in predictions:
        for k, start, end in spans:
            if None not in (key, pos, start, end) and k == key and start - 1 <= pos < end - 1:
                seen.setdefault(key, set()).add(None if None in (target, predicted) else target == predicted)
    return {key: False if False in found else True if True in found else None for key, found in seen.items()}


def test_grade_lm_equals_plain_loops(spark):
    rng = random.Random(5)
    predictions, spans = [], []
    for key in range(120):
        wrong = rng.choice([0, 0, 0.005, 0.2])
        unknown = rng.choice([0, 0.1, 1])
        for pos in range(rng.choice([-70, 0]), rng.choice([3, 63, 64, 65, 128, 400])):
            target = rng.choice([0, 7, None]) if rng.random() < unknown else 7
            predictions.append((key, pos, target, rng.choice([8, None]) if rng.random() < wrong else target))
        for _ in range(rng.choice([0, 1, 1, 1, 2])):
            start = rng.choice([-64, 0, 1, 2, 60, 64, 65, 66, 129])
            spans.append((key, start, start + rng.choice([-1, 0, 1, 2, 63, 64, 65, 300])))
    predictions += predictions[::5] + [(3, None, 7, 8), (None, 1, 7, 8)]
    spans += [(4, None, 9), (5, 1, None), (None, 0, 9), (6, -(1 << 31) + 1, (1 << 31) - 1)]
    rng.shuffle(predictions)
    df = spark.createDataFrame(predictions, "k bigint, pos int, target_id int, pred_id int").repartition(3)
    graded = ev.grade_lm(df, spark.createDataFrame(spans, "k bigint, start int, end int"), ["k"])
    want = brute_grade_lm(predictions, spans)
    assert {True, False, None} <= set(want.values()) and graded.columns == ["k", "correct"]
    assert Counter((r.k, r.correct) for r in graded.collect()) == Counter(want.items())


def test_grade_lm_joins_blocks_of_positions(spark):
    from shardloom.session import session_conf

    rows = spark.range(20, numPartitions=2).select(F.col("id").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(999))).alias("pos"))
    df = rows.select("*", F.lit(1).alias("target_id"), F.lit(1).alias("pred_id"))
    spans = spark.range(20, numPartitions=2).select(F.col("id").alias("k"), F.lit(1).alias("start"), F.lit(1001).alias("end"))
    with session_conf(spark, spark_sql_adaptive_enabled="false", spark_sql_autoBroadcastJoinThreshold="-1"):
        graded = ev.grade_lm(df, spans, ["k"])
        plan = graded._jdf.queryExecution().executedPlan()
        assert plan.executeCollect() and graded.count() == 20

    def shuffled(node):
        metric = node.metrics().get("shuffleRecordsWritten")
        below = sum(shuffled(node.children().apply(i)) for i in range(node.children().size()))
        return below + (metric.get().value() if metric.isDefined() else 0)

    assert 0 < shuffled(plan) < 1000  # of 20,000 positions


def test_answers_and_programs(spark):
    texts = {"#### 1,234": "1234", "#### -5.5 and #### 6": "-5.5", "none": None, "####7": None}
    df = spark.createDataFrame([(k,) for k in texts], "t string")
    assert {r.t: r.a for r in df.select("t", ev.extract_answer(F.col("t")).alias("a")).collect()} == texts
    both = spark.createDataFrame([("x", "y"), ("#### 1", "y"), ("#### 1", "#### 1")], "r string, c string")
    assert [r[0] for r in both.select(ev.grade_numeric(F.col("r"), F.col("c"))).collect()] == [1, 0, 1]
    programs = {"```python\na\n```\n```\nb\n```": "a", "  plain \n": "plain", "x ```\n\n  c\n``` y": "c"}
    df = spark.createDataFrame([(k,) for k in programs], "t string")
    assert {r.t: r.p for r in df.select("t", ev.program_of(F.col("t")).alias("p")).collect()} == programs
    prompt = spark.createDataFrame([("# c\n\n  import a\nfrom b import c\nx = 1\nimport d",), ("import z",), ("",)], "p string")
    assert [r[0] for r in prompt.select(ev.leading_imports(F.col("p"))).collect()] == ["import a\nfrom b import c", "import z", ""]


def test_bits_per_byte(spark):
    lengths = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "token_id int, n_bytes int")
    losses = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 9.0), ("a", -1, 9.0), ("b", 2, 5.0)], "g string, target_id int, loss double")
    rows = {r.g: r.bpb for r in ev.bits_per_byte(losses, lengths, "g").collect()}
    assert rows["a"] == pytest.approx(3.0 / (math.log(2) * 3)) and rows["b"] == math.inf


def test_letter_outside_the_allowed_set(spark):
    df = spark.createDataFrame([("A", "A"), ("B", "A"), ("Z", "A")], "p string, a string")
    letters = F.array(F.lit("A"), F.lit("B"))
    assert [r[0] for r in df.select(ev.grade_letter(F.col("p"), F.col("a"), letters)).collect()] == [True, False, None]
    with pytest.raises(ValueError):
        tasks.find_task("nothing")


REQUESTS = [
    ('{"input":{"messages":[{"role":"user","content":"hi"}],"top_k":3}}', None),
    ('{"input":{"messages":[]}}', "No messages provided"),
    ("{}", "No messages provided"),
    ('{"input":{"messages":[{"role":"user"}]}}', "Each message must have 'role' and 'content'"),
    ('{"input":{"messages":[{"role":"bot","content":"x"}]}}', "Invalid role: bot. Must be 'user' or 'assistant'"),
    ('{"input":{"messages":[{"role":"assistant","content":"x"}]}}', "Last message must be from 'user'"),
]


def test_requests(spark):
    df = spark.createDataFrame([(r,) for r, _ in REQUESTS], "request string")
    rows = requests.validate_requests(df).collect()
    assert [r.error for r in rows] == [e for _, e in REQUESTS]
    assert (rows[0].max_tokens, rows[0].temperature, rows[0].top_k) == (256, 1.0, 3)


def test_sections_hold_plain_text_and_none(spark):
    rows = [("S", 0, "a", "int", "12345"), ("S", 1, "b", "str", None), ("S", 2, None, "raw", "as it is"), ("S", 3, None, "raw", ""), ("S", 4, None, "raw", None), ("S", 5, "c", "float", "2")]
    metrics = spark.createDataFrame(rows, "section string, ord int, key string, kind string, value string").withColumn("ts", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    text = reports.section_text(metrics).first().text
    assert text == "## S\ntimestamp: 2024-01-02 03:04:05\n\n- a: 12,345\n- b: None\nas it is- c: 2.0000\n\n"


def test_report_values(spark):
    df = spark.createDataFrame([("float", "1.5"), ("int", "12345"), ("int", "9999"), ("str", "x")], "k string, v string")
    assert [r[0] for r in df.select(reports.format_value(F.col("k"), F.col("v"))).collect()] == ["1.5000", "12,345", "9999", "x"]
    section = spark.createDataFrame([("a", "- CORE: 0.5\n- ChatCORE: 0.7\nbad")], "slug string, text string")
    assert {r.key: r.value for r in reports.extract_metrics(section, ["CORE"]).collect()} == {"CORE": "0.5"}
    listing = spark.createDataFrame([("r/d4/model_9.pt", 1), ("r/d4/model_10.pt", 2), ("r/d12/model_3.pt", 1), ("r/d12/other_99.pt", 9)], "path string, modified int")
    best = reports.largest_model(reports.run_catalog(listing)).first()
    assert (best.tag, best.last_step) == ("d12", 3)
    catalog = {r.tag: r.last_step for r in reports.run_catalog(listing).collect()}
    assert catalog["d4"] == 10


def test_stream_pack_carries_the_remainder(spark, tmp_path):
    df, _ = stream_rows(spark, [5, 9, 11, 2, 30, 1])
    other = df.where("k = 10").select("k", "ids", F.lit(1).alias("rank"))
    df = df.withColumn("rank", F.lit(0)).unionByName(other)
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for low, high in ((0, 20), (20, 40), (40, 100)):
        df.where((F.col("k") >= low) & (F.col("k") < high)).write.mode("append").parquet(source)
        stream = streams.shard_stream(spark, source, "k bigint, ids array<int>, rank int")
        result = streams.pack_stream(stream, "rank", "k", 2, 3, out, progress)
    batch = pack.windows(df, "k", 7, ["rank"])
    shown = lambda rows: {(r["rank"], r.window_id, tuple(r.tokens)) for r in rows.collect()}
    assert shown(result) == shown(batch) and len(shown(batch)) == 9


def test_batches_of_a_rank_come_back_in_order(spark, tmp_path):
    df, _ = stream_rows(spark, [5] * 300)
    packed = pack.pack(df, "k", 2, 3)
    path = str(tmp_path / "b")
    pack.write_rank_batches(packed, path, "train", 2, 3, rows_per_file=20)
    pack.write_rank_batches(packed.where("batch_id < 3"), path, "val", 2, 3, rows_per_file=20)
    rows = packed.collect()
    for rank in range(3):
        mine = sorted((r.batch_id, r.row_in_batch, r.inputs, r.targets) for r in rows if r.batch_id % 3 == rank)
        read = pack.read_rank_batches(spark, path, "train", rank).collect()
        assert [(r.batch_id, r.row_in_batch, r.inputs, r.targets) for r in read] == mine
        assert [r.position for r in read] == list(range(len(mine)))
        later = pack.read_rank_batches(spark, path, "train", rank, 45, 20)
        assert [r.position for r in later.collect()] == list(range(45, len(mine)))
        filters = later._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        assert "split" in filters and "rank" in filters and "file" in filters
    # A file holds the rows of its positions, as many as were asked for.
    sizes = {f.parent.name: pq.read_table(f, columns=["position"]).num_rows for f in (tmp_path / "b" / "split=train" / "rank=0").rglob("*.parquet")}
    assert sizes["file=0"] == sizes["file=1"] == 20
    assert pack.read_rank_batches(spark, path, "val", 1).count() == 2


def test_written_batches(spark, tmp_path):
    df, _ = stream_rows(spark, [20])
    packed = pack.pack(df, "k", 2, 3).withColumn("split", F.lit("train")).withColumn("rank", F.col("batch_id") % 2)
    pack.write_batches(packed, str(tmp_path / "b"), "split", "rank")
    assert spark.read.parquet(str(tmp_path / "b")).where("rank = 1").count() == 2


def test_turns_count_in_order_whatever_their_numbers(spark):
    gapped = [(0, n, r, f"{r}{n}") for n, r in ((0, "user"), (1000, "assistant"), (2000, "user"), (3000, "assistant"))]
    one_based = [(1, n, r, f"{r}{n}") for n, r in ((1, "system"), (2, "user"), (3, "assistant"))]
    wrong = [(2, 4, "user", "a"), (2, 9, "user", "b"), (2, 12, None, "c")]
    df = spark.createDataFrame(gapped + one_based + wrong, "conv_id bigint, turn bigint, role string, text string")
    assert chat.first_turns(df).count() == 10 and chat.first_turns(df, 2).where("conv_id = 0").count() == 3
    checked = {r.conv_id: r.reasons for r in chat.validate_turns(df).collect()}
    assert checked == {0: [], 1: [], 2: ["role_order", "missing_role"]}
    merged = {(r.conv_id, r.turn): r.text for r in chat.merge_system_turns(df).collect() if r.conv_id == 1}
    assert merged == {(1, 0): "system1\n\nuser2", (1, 1): "assistant3"}


def brute_turns(rows):
    """Places, validity and merged texts of (conv, turn, role, text) rows, a conversation at a time."""
    convs, merged, checked = {}, [], {}
    none_first = lambda x: (x is not None, x)
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    for conv, turns in convs.items():
        turns.sort(key=lambda r: [none_first(x) for x in r[1:]])
        has_system = turns[0][2] == "system"
        rest = turns[has_system:]
        reasons = ["too_few_messages"] if len(rest) < 2 else []
        reasons += ["role_order"] if any(r[2] != ("user", "assistant")[i % 2] for i, r in enumerate(rest)) else []
        reasons += ["missing_role"] if any(r[2] is None for r in turns) else []
        reasons += ["missing_content"] if any(r[3] is None for r in turns) else []
        checked[conv] = (len(turns), reasons)
        system = turns[0][3] if has_system else None
        for i, r in enumerate(rest):
            text = f"{system}\n\n{r[3]}" if system is not None and i == 0 and r[3] is not None else r[3]
            merged.append((conv, i + (has_system and system is None), r[2], text))
    return checked, merged


@pytest.mark.parametrize("numbers", ["dense", "gapped", "repeated", "one conversation"])
def test_turn_windows_equal_plain_loops(spark, numbers):
    rng = random.Random(numbers)
    rows = []
    for conv in range(40):
        n = rng.randint(1, 9)
        if numbers == "one conversation" and conv == 7:
            n = 700  # most of all turns
        start = rng.randint(-3, 5)
        step = {"dense": lambda i: i, "gapped": lambda i: 3 * i + i % 2, "repeated": lambda i: i // 2, "one conversation": lambda i: i * (1 + conv % 2)}[numbers]
        for i in range(n):
            role = ("user", "assistant")[(i + conv % 2) % 2] if i or conv % 3 else "system"
            rows.append((conv, start + step(i), rng.choice([role] * 12 + [None, "user"]), rng.choice([f"t{i}"] * 9 + [None])))
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    checked, merged = brute_turns(rows)
    assert {r.conv_id: (r.n_messages, r.reasons) for r in chat.validate_turns(df).collect()} == checked
    assert Counter(tuple(r) for r in chat.merge_system_turns(df).select("conv_id", "turn", "role", "text").collect()) == Counter(merged)


def test_rank_limit_is_below_the_shuffle(spark):
    df = spark.createDataFrame([(0, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    for longest in (None, 6):
        plan = chat.first_turns(df, longest=longest)._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Exchange hashpartitioning") :]
        assert "WindowGroupLimit" in below


def test_texts_bound_the_turns_that_are_gathered(spark):
    rows = [(0, i, ("user", "assistant")[i % 2], "x" * 100) for i in range(300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    longest = max(map(len, TOK.token_bytes()))
    first = chat.first_turns(df, 200, longest=longest)
    assert first.count() < chat.first_turns(df, 200).count()
    a, b = (chat.render(chat.assemble(t), TOK, 200).first().ids for t in (first, df))
    assert a == b and len(a) == 200


def test_too_few_examples_fail(spark):
    items = spark.createDataFrame([("t", 0), ("t", 1)], "task string, idx bigint")
    assert ev.fewshot_pairs(items, 1, strict=True).count() == 2
    assert [tuple(r) for r in ev.short_tasks(items, 2).collect()] == [("t", 2, 1)] and ev.short_tasks(items, 1).count() == 0
    with pytest.raises(Exception, match="too few examples"):
        ev.fewshot_pairs(items, 2, strict=True).collect()


def test_exact_halves_round_to_even(spark):
    from shardloom.operators.reports import format_value

    values = [0.03125, 0.09375, -0.03125, 0.15625, 0.12345, 2.5, 1 / 3, 1234567.96875]
    df = spark.createDataFrame([(str(v),) for v in values], "v string")
    got = {r.v: r.f for r in df.select("v", format_value(F.lit("float"), F.col("v")).alias("f")).collect()}
    assert got == {str(v): f"{v:.4f}" for v in values}


def test_long_pieces_encode_quickly():
    import time

    start = time.perf_counter()
    ids = tk.encode_piece("ab" * 500_000, {(97, 98): 256, (256, 256): 257})
    assert ids == [257] * 250_000 and time.perf_counter() - start < 30


def test_few_rules_go_over_many_pieces(monkeypatch):
    monkeypatch.setattr(tk, "_RULE_BYTES", 50)  # several rounds
    rng = random.Random(2)
    ranks = {(97, 98): 256, (97, 97): 257, (256, 256): 258, (257, 97): 259, (258, 97): 260, (195, 164): 261, (261, 98): 262}
    pieces = ["", "a", "ä" * 60] + ["".join(rng.choice("aaabbä c") for _ in range(rng.choice([0, 1, 2, 7, 30, 200]))) for _ in range(300)]
    rules = [(*pair, new) for pair, new in ranks.items()]
    assert tk.encode_pieces(pieces, rules).to_pylist() == [tk.encode_piece(p, ranks) for p in pieces]
    assert tk.encode_pieces([], rules).to_pylist() == [] and tk.encode_pieces(["", "é"], []).to_pylist() == [[], [195, 169]]


def test_encoders_of_few_and_many_rules_agree(spark):
    later = tuple((0, 1 + i, 0) for i in range(80))  # rules that no text here needs
    many = Tokenizer(TOK.merges + later)
    rows = [("the theory", 0), ("", 1), (None, 2), ("th the bathe \n" * 50, 3)]
    df = spark.createDataFrame(rows, "text string, i int").repartition(2)
    few_ids, many_ids = ({r.i: r.ids for r in tk.encode_corpus(df, t).collect()} for t in (TOK, many))
    assert few_ids == many_ids and few_ids[2] is None and few_ids[1] == []
    # A rule with a part that is younger than its token makes work for one before it.
    young = Tokenizer(((257, 101, 1), (116, 104, 2)))
    assert tk.encode_corpus(df.where("i = 0").select(F.lit("the").alias("text")), young).first().ids == [256]


def test_the_cache_of_many_rules_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(tk, "_CACHE_TOKENS", 40)
    encode = tk.piece_encoder(spark, Tokenizer(TOK.merges + tuple((0, 1 + i, 0) for i in range(80)))).func
    known = dict(zip(encode.__code__.co_freevars, encode.__closure__))["known"].cell_contents
    for i in range(30):
        words = [f"{i}a{j}" for j in range(8)]
        assert encode(pa.array([words])).to_pylist() == [[b for w in words for b in w.encode()]]
        assert 0 < sum(map(len, known.values())) <= 40 + 8 * 4


def test_unknown_subjects_are_listed(spark):
    rows = spark.createDataFrame([("anatomy",), ("x",), ("x",), (None,)], "subject string")
    assert {(r.subject, r.n) for r in tasks.unknown_subjects(rows).collect()} == {("x", 2), (None, 1)}
