"""Vocabulary training, encoding and decoding against plain step-by-step versions."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardloom.functions import text as tx
from shardloom.operators import checks, merge_index
from shardloom.operators import tokens as tk
from shardloom.operators import vocabulary as vb
from shardloom.sources import artifacts

EDGE_TEXTS = [
    "", "   ", "\n\n  x", "a b　c​d", "\u0085x", "it'LL don'ſ we'Re", "\U0001f600 ok \U0001f468‍\U0001f469",
    "éä", "12345 678", "١٢٣٤", "½ Ⅷ", "tab\t\tend  ", "a  b   c\r\n\r\nd", "x!!??\n\n", " leading", "한국어 텍스트", "\x1e\x00z",
]


def pair_totals(words):
    totals = Counter()
    for word, count in words:
        for pair in zip(word, word[1:]):
            totals[pair] += count
    return totals


def merge(word, pair, symbol):
    out, i = [], 0
    while i < len(word):
        if i + 1 < len(word) and (word[i], word[i + 1]) == pair:
            out.append(symbol)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


def greedy(words, n):
    words = [(list(w), c) for w, c in words]
    rules = []
    for step in range(n):
        totals = pair_totals(words)
        if not totals:
            break
        pair = min(totals, key=lambda p: (-totals[p], p))
        rules.append((*pair, totals[pair]))
        words = [(merge(w, pair, chr(1000 + step)), c) for w, c in words]
    return rules


def batched(words, n):
    words = [(list(w), c) for w, c in words]
    rules = []
    while len(rules) < n:
        totals = pair_totals(words)
        ranked = sorted(((a + b, c) for (a, b), c in totals.items()), key=lambda x: (-x[1], x[0]))
        run = vb.independent_prefix(ranked[:40], n - len(rules))
        if not run:
            break
        for pair, count in run:
            words = [(merge(w, tuple(pair), chr(1000 + len(rules))), c) for w, c in words]
            rules.append((pair[0], pair[1], count))
    return rules


def test_batched_rounds_pick_the_greedy_rules():
    rng = random.Random(5)
    for _ in range(1500):
        letters = "abcdef"[: rng.randint(1, 6)]
        words = [
            ("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))), rng.randint(1, 4))
            for _ in range(rng.randint(1, 8))
        ]
        assert batched(words, 12) == greedy(words, 12)


def spark_rules(spark, words, n):
    rows = [("".join(tx.id_to_symbol(ord(c)) for c in w), c) for w, c in words]
    found = vb.train_merges(spark.createDataFrame(rows, "syms string, cnt bigint"), n)
    return found


@pytest.mark.parametrize("dense", [0, 3, 64])
@pytest.mark.parametrize("words", [
    [("aaaa", 1), ("aaaaa", 2)], [("abab", 3), ("bab", 1)], [("a", 5)], [("ab", 1), ("cd", 1), ("abcd", 2)],
])
def test_training_on_spark_equals_greedy(spark, monkeypatch, words, dense):
    monkeypatch.setattr(vb, "_DENSE_RULES", dense)
    want = []
    for left, right, count in greedy(words, 6):
        number = lambda s: ord(s) if ord(s) < 256 else ord(s) - 1000 + 256
        want.append((number(left), number(right), count))
    assert list(spark_rules(spark, words, 6)) == want


def random_words(seed, n, letters="abcdefghij"):
    rng = random.Random(seed)
    found = {"".join(rng.choices(letters, weights=range(len(letters), 0, -1), k=rng.randint(1, 10))) for _ in range(n)}
    return [(w, rng.randint(1, 6)) for w in sorted(found)]


def expected_rules(words, n):
    number = lambda s: ord(s) if ord(s) < 256 else ord(s) - 1000 + 256
    return [(number(left), number(right), count) for left, right, count in greedy(words, n)]


@pytest.mark.parametrize("window, fan_in", [(1 << 16, 3), (6, 2), (1, 12)])
def test_long_training_equals_greedy(spark, monkeypatch, window, fan_in):
    """Segments are rewritten over several levels; a small window is filled again and again."""
    monkeypatch.setattr(merge_index, "WINDOW", window)
    monkeypatch.setattr(vb, "_DENSE_RULES", 0 if fan_in < 12 else 5)
    monkeypatch.setattr(merge_index, "FAN_IN", fan_in)
    words = random_words(3, 150)
    n = 60 if window > 6 else 14
    assert list(spark_rules(spark, words, n)) == expected_rules(words, n)


def test_a_round_reads_only_words_that_hold_a_chosen_pair(spark):
    words = random_words(4, 300)
    rows = [("".join(tx.id_to_symbol(ord(c)) for c in w), c) for w, c in words]
    table = spark.createDataFrame(rows, "syms string, cnt bigint")
    index = merge_index.MergeIndex(table, vb._pair_totals(table))
    pair = index.ranked(1)[0][0]
    entries = index._read([index.base]).where(F.col("pair") == pair)
    assert {r.syms for r in entries.collect()} == {s for s, _ in rows if pair in s}
    assert "PushedFilters: [IsNotNull(pair), EqualTo(pair," in entries._jdf.queryExecution().toString()
    index.merge([(pair, tx.id_to_symbol(256))])
    again = Counter()
    for s, c in rows:
        now = s.replace(pair, tx.id_to_symbol(256))
        for p in merge_index.pairs_of(now):
            again[p] += c
    assert index.counts == dict(again)


def test_words_are_brought_up_to_date():
    rng = random.Random(6)
    for _ in range(300):
        rules = {}
        letters = list("abc")
        for rank in range(rng.randint(0, 8)):
            pair = rng.choice(letters) + rng.choice(letters)
            if pair not in rules:
                rules[pair] = (rank, chr(1000 + rank))
                letters.append(chr(1000 + rank))
        word = "".join(rng.choices("abc", k=rng.randint(0, 14)))
        want = word
        for pair, (_, symbol) in rules.items():
            want = want.replace(pair, symbol)
        assert merge_index.current(word, rules) == want


@pytest.fixture(scope="module")
def tok(spark):
    lines = [(i, t) for i, t in enumerate(["the cat sat on the mat", "the theory of the thing", "hat that bat", "été à la thé", None])]
    return vb.train_tokenizer(spark.createDataFrame(lines, "id bigint, text string"), 256 + 20, "id")


def test_symbols_cover_high_ids():
    for i in (0, 255, 20991, 20992, 300000):
        assert tx.symbol_to_id(tx.id_to_symbol(i)) == i
    assert tx.id_to_symbol(20991) < tx.id_to_symbol(20992)


def test_symbol_id_column(spark):
    ids = [0, 255, 20991, 20992, 100000]
    df = spark.createDataFrame([(tx.id_to_symbol(i),) for i in ids], "s string")
    assert [r[0] for r in df.select(tx.symbol_id(F.col("s"))).collect()] == ids


def test_pieces_follow_the_unicode_pattern(spark):
    regex = pytest.importorskip("regex")
    rng = random.Random(2)
    alphabet = "aA1 \n\r\t'é한½ 　!?.sStT́\U0001f600"
    texts = EDGE_TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (tx.SPLIT_DIGITS_3, tx.SPLIT_DIGITS_2):
        compiled = regex.compile(pattern)
        got = df.select("t", tx.split_pieces(F.col("t"), pattern).alias("p")).collect()
        for row in got:
            assert row.p == compiled.findall(row.t), repr(row.t)
            assert "".join(row.p) == row.t


def test_encode_decode_roundtrip_and_naive_encoder(spark, tok):
    ranks = {(l, r): 256 + i for i, (l, r, _) in enumerate(tok.merges)}
    rules = [(tx.id_to_symbol(l) + tx.id_to_symbol(r), tx.id_to_symbol(256 + i)) for i, (l, r, _) in enumerate(tok.merges)]
    rng = random.Random(3)
    for _ in range(300):
        piece = "".join(rng.choice("thea cé") for _ in range(rng.randint(1, 12)))
        symbols = "".join(tx.id_to_symbol(b) for b in piece.encode())
        for pair, symbol in rules:
            symbols = symbols.replace(pair, symbol)
        assert tk.encode_piece(piece, ranks) == [tx.symbol_to_id(s) for s in symbols]
    texts = EDGE_TEXTS + ["the cat", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    encoded = tk.encode_corpus(df, tok)
    back = {r.id: r.d for r in encoded.select("id", tk.decode_ids(tok, F.col("ids")).alias("d")).collect()}
    assert [back[i] for i in range(len(texts))] == texts


def test_the_encoder_holds_few_bytes(spark, tok, monkeypatch):
    """Batches are bounded by bytes, and the cache by tokens."""
    monkeypatch.setattr(tk, "_CACHE_TOKENS", 40)
    encode = tk.piece_encoder(spark, tok)
    rows = spark.range(40, numPartitions=1).select(F.array_repeat(F.lit("x" * 1000), 1000).alias("pieces"))
    size = F.arrow_udf(lambda a: pa.array([len(a)] * len(a), pa.int32()), "int")
    assert rows.select(size("pieces").alias("n")).agg(F.max("n")).first()[0] <= 10
    names, cells = encode.func.__code__.co_freevars, encode.func.__closure__
    known = dict(zip(names, cells))["known"].cell_contents
    for i in range(30):
        words = [f"{i}a{j}" for j in range(8)]
        assert encode.func(pa.array([words])).to_pylist() == [[b for w in words for b in tk.encode_piece(w, {})]]
    assert sum(map(len, known.values())) <= 40 + 8 * 4


def test_encoder_agrees_with_a_second_library(spark, tok):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = {t: i for i, t in enumerate(tok.token_bytes()[: tok.base_size])}
    enc = tiktoken.Encoding("t", pat_str=tok.pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [t for t in EDGE_TEXTS if t] + ["the cat sat on that mat with the thing"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in tk.encode_corpus(df, tok).collect():
        assert row.ids == enc.encode_ordinary(row.text)


def test_prepend_append_and_lengths(spark, tok):
    df = spark.createDataFrame([("the",), ("",)], "text string")
    rows = tk.encode_corpus(df, tok, prepend="<|bos|>", append=7).collect()
    assert rows[1].ids == [tok.special_id("<|bos|>"), 7]
    assert rows[0].ids[0] == tok.base_size and rows[0].ids[-1] == 7
    lengths = spark.range(1).select(tk.token_lengths(tok)).first()[0]
    assert lengths[:256] == [1] * 256 and lengths[tok.base_size :] == [0] * 9


def test_lossy_decode(spark, tok):
    df = spark.createDataFrame([([0xE9, 65],)], "ids array<int>")
    assert df.select(tk.decode_ids(tok, F.col("ids"))).first()[0] == "�A"


def test_compression_of_nothing_is_zero(spark, tok):
    df = spark.createDataFrame([("", "x")], "text string, g string")
    rows = tk.compression_ratio(tk.encode_corpus(df, tok), "g").collect()
    assert {r.ratio for r in rows} == {0.0}


def test_sizes_are_checked(spark):
    df = spark.createDataFrame([(1, "a")], "id int, text string")
    with pytest.raises(ValueError):
        vb.train_tokenizer(df, 255, "id")
    with pytest.raises(ValueError):
        vb.train_tokenizer(df, 260, "id", reserve_specials=True)
    with pytest.raises(ValueError):
        vb.train_tokenizer(df, 300, "text", text="id")
    # Fewer possible merges than asked for.
    assert vb.train_tokenizer(df, 300, "id").merges == ()


def test_tokenizer_artifact(spark, tok, tmp_path):
    path = str(tmp_path / "tok")
    artifacts.write_tokenizer(spark, tok, path, 1, 99)
    assert artifacts.read_tokenizer(spark, path, tok.pattern) == tok
    read = artifacts.read_vocabulary_json(spark, f"{path}/json").orderBy("token_id").collect()
    assert [bytes(r.token_bytes) for r in read] == tok.token_bytes()[: tok.base_size]
    broken = str(tmp_path / "broken")
    spark.createDataFrame([('{"vocab_size": 3}',)], "value string").write.text(broken)
    with pytest.raises(Exception, match="required field"):
        artifacts.read_vocabulary_json(spark, broken).collect()


def test_tokenizer_check_failures(spark, tok):
    vocabulary = vb.vocabulary_table(spark, tok)
    verdict = lambda df, size: checks.check_tokenizer(df, size).first()
    assert verdict(vocabulary, tok.base_size).passed
    assert not verdict(vocabulary, tok.base_size + 1).passed
    gap = vocabulary.where("token_id <> 5")
    assert verdict(gap, tok.base_size - 1).description == "token ids are not dense"
    small = vocabulary.where("token_id < 10")
    assert "smaller" in verdict(small, 10).description
    gate = checks.check_gate(checks.union_checks(checks.check_tokenizer(gap, 1))).first()
    assert gate.stop and gate.n_failed == 1


def test_pieces_and_pairs_are_counted_by_batches(spark, monkeypatch):
    texts = ["aaaa aaaaa é 12345", None, "", "ab ab abab  \n\n x", "aaaa aaaaa " * 30] + [f"w{i} aaab" for i in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    plain = df.select(F.explode(vb.split_pieces(F.col("text"))).alias("piece")).groupBy("piece").agg(F.count("*").alias("cnt"))
    want = {(r.piece, r.cnt) for r in plain.collect()}
    monkeypatch.setattr(vb, "_HELD_PIECES", 3)
    counts = vb.piece_counts(df)
    assert {(r.piece, r.cnt) for r in counts.collect()} == want
    # No row for each piece of the corpus.
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    words = vb.with_symbols(counts).where(F.length("syms") > 1).select("syms", "cnt")
    a, b, e = 97, 98, 257
    rules = [(a, a, 256), (256, a, e), (e, b, 258), (32, 256, 259)]
    symbols = [(vb.id_to_symbol(l) + vb.id_to_symbol(r), vb.id_to_symbol(n)) for l, r, n in rules]
    for k in range(len(rules) + 1):
        merged = words.withColumn("syms", vb.merge_symbols(F.col("syms"), symbols[:k]))
        assert sorted(vb._merged_totals(words, rules[:k]).collect()) == sorted(vb._pair_totals(merged).collect())
    assert vb._merged_totals(words.limit(0), rules).count() == 0
