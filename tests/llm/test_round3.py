"""Embedding near-dedup, fill-in-middle and collocations against brute force and exact round trips."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SCHEMA, edge_rows, prose
from pyspark.sql import functions as F

from shardloom.llm import collocations as col
from shardloom.llm import common, embedding_dedup, fill_in_middle

# -- fill in middle -------------------------------------------------------------------


def expected_form(doc_id, text):
    text = text or ""
    h = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(text) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_slicing(spark, edge_docs):
    rng = random.Random(3)
    marked = [(100 + i, "".join(rng.choices(["<", "P", ">", "<S", "<M>", "é", "😀", "\n", "M>"], k=12)), "xx", None, None) for i in range(60)]
    docs = edge_docs.unionByName(spark.createDataFrame(marked, SCHEMA), allowMissingColumns=True)
    out = fill_in_middle.restore(fill_in_middle.fill_in_middle(docs)).collect()
    want = Counter((r[0], *expected_form(r[0], r[1]), len(r[1] or ""), r[1] or "") for r in edge_rows() + marked)
    assert Counter((r.doc_id, r.form, r.prefix_chars, r.middle_chars, r.output, r.n, r.restored) for r in out) == want
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_long_texts_are_cut_in_segments(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "STEP_BYTES", 64)
    monkeypatch.setattr(common, "STEP_BYTES", 64)
    rng = random.Random(1)
    texts = ["".join(rng.choices("aé😀 \n", k=rng.randint(0, 300))) for _ in range(120)] + ["", None]
    whole = [t or "" for t in texts]
    first = np.array([rng.randint(0, len(t)) for t in whole])
    second = np.array([rng.randint(a, len(t)) for a, t in zip(first, whole)])
    found = fill_in_middle.pieces(pa.array(texts, pa.large_string()), first, second)
    want = [(t[:a], t[a:b], t[b:]) for t, a, b in zip(whole, first, second)]
    assert list(zip(*(f.to_pylist() for f in found))) == want


def test_fill_in_middle_of_no_rows(no_docs):
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(no_docs)).count() == 0


# -- collocations ---------------------------------------------------------------------


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def grams(rows):
    counts = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            for i in range(len(words)):
                for k in (1, 2, 3):
                    if i + k <= len(words):
                        counts[lang or "und", tuple(words[i : i + k])] += 1
    return counts


def brute_collocations(rows, least, top=2000, inside=50):
    f = grams(rows)
    total = Counter()
    for (lang, p), c in f.items():
        total[lang] += c if len(p) == 1 else 0
    wanted = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    out = {}
    for (lang, p), a in wanted.items():
        if len(p) == 2 and any(
            l2 == lang and len(q) == 3 and p in (q[:2], q[1:]) and 100 * c >= inside * a for (l2, q), c in wanted.items()
        ):
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], total[lang]))
    return {
        (lang, i + 1, p.decode(), -a, x, y, n, -s) for lang, found in out.items() for i, (s, a, p, x, y, n) in enumerate(sorted(found)[:top])
    }


def collocation_rows(rng, n=160):
    vocabulary = ["ab", "Cd", "é", "x.y", "ef", "gh\t", "É", "q,", "0", "-"]
    fixed = "the long fixed passage that comes again and again without any change at all"
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(vocabulary, weights=range(10, 0, -1), k=rng.randint(0, 25)))
        rows.append((text + (" " + fixed if i % 8 == 0 else "") + ("\n" + fixed.upper() if i % 20 == 0 else ""), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("ab ab ab ab", "en"), ("ab", "fr"), (" ".join(["loop"] * 40), "de")]


@pytest.mark.parametrize("top", [2000, 5])
def test_collocations_equal_counting_all_phrases(spark, top):
    rows = collocation_rows(random.Random(8))
    docs = spark.createDataFrame([(i, t, l, None, None) for i, (t, l) in enumerate(rows)], SCHEMA)  # noqa: E741
    for name in ("w1", "n", "f", "words", "pair"):
        docs = docs.withColumn(name, F.lit("x"))
    found = col.collocations(docs.repartition(5), min_count=4, top=top)
    assert {tuple(r) for r in found.collect()} == brute_collocations(rows, 4, top)


def test_flows_and_paths(spark):
    rows = collocation_rows(random.Random(9), 200)
    docs = spark.createDataFrame(rows, "text string, lang string")
    f = grams(rows)
    table = col.graph(docs, 4)
    words, nodes = col.flows(table, 4)
    assert {(r.lang, (r.w,)): r.f for r in words.collect()} == {k: c for k, c in f.items() if len(k[1]) == 1}
    assert {(r.lang, (r.w1, r.w2)): r.f for r in nodes.collect()} == {k: c for k, c in f.items() if len(k[1]) == 2 and c >= 4}
    paths = col.compact(table, nodes, 4).collect()
    edges = Counter((r.lang, tuple(r.words[i : i + 3])) for r in paths for i in range(len(r.words) - 2))
    assert edges == Counter({k: 1 for k, c in f.items() if len(k[1]) == 3 and c >= 4})
    assert all(f[r.lang, tuple(r.words[i : i + 3])] == r.n for r in paths for i in range(len(r.words) - 2))
    # The fixed passage is one path but for what surrounds it.
    assert max(len(r.words) for r in paths) >= 12


def test_long_texts_overlap_by_two_words(spark, monkeypatch):
    monkeypatch.setattr(col, "STEP_BYTES", 50)
    rows = collocation_rows(random.Random(4), 30) + [(prose(random.Random(1), 300, "ab"), "en"), ("z" * 500 + " a b " + "y" * 300, "en"), (" " * 400 + "a b", "en")]
    data, limits = common.text_buffer(pa.array([t for t, _ in rows], pa.string()))
    counts = Counter()
    for first, words, n in col._parts(data, limits, 50):
        lang = np.zeros(len(rows), np.uint64)
        one, two, _ = col._links(words, n, lang[first:])
        told = words.take(np.arange(len(words.starts))).to_pylist()
        for i in range(n):
            counts[tuple(told[i : i + 1 + int(one[i]) + int(two[i])])] += 1
    want = Counter()
    for text, _ in rows:
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            want.update(tuple(words[i : i + 3]) for i in range(len(words)))
    assert counts == want


def test_collocations_of_no_rows_and_edges(spark, no_docs, edge_docs):
    assert col.collocations(no_docs).count() == 0
    rows = [(r[1], r[2]) for r in edge_rows()]
    assert {tuple(r) for r in col.collocations(edge_docs, 3).collect()} == brute_collocations(rows, 3)


def test_scores_past_64_bits(spark):
    one = spark.range(1).selectExpr("cast(3000000000000 as bigint) a", "cast(3000000000001 as bigint) l", "cast(9000000000000 as bigint) r")
    assert one.select(col._score("a", "l", "r")).first()[0] == 10**6 * 3000000000000**2 // (3000000000001 * 9000000000000)


def test_key_filter_holds_every_key(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k"))
    held = common.key_filter(keys, "k")
    inside = np.array([r.k for r in keys.collect()], np.int64).view(np.uint64)
    others = np.array([r.k for r in spark.range(5000, 25_000).select(F.xxhash64("id").alias("k")).collect()], np.int64).view(np.uint64)
    assert common.may_hold(held, inside).all()
    assert common.may_hold(held, others).mean() < 0.05
    assert not common.may_hold(common.key_filter(keys.limit(0), "k"), others).any()


# -- embeddings -----------------------------------------------------------------------


def brute_links(rows, cosine):
    """Links, components and counts of (vec_id, vector, label) rows by all pairs."""
    ok = [
        v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, label in rows
    ]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = [0] * len(rows)
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            w, b = rows[j][1], rows[j][2]
            if ok[i] and ok[j] and a == b and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                    n[i] += 1
                    n[j] += 1
                    parent[top(i)] = top(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    low = {k: min((x for x in g if x is not None), default=None) for k, g in groups.items()}
    return [(rows[i][0], n[i], low[top(i)]) for i in range(len(rows))]


def vectors(seed, n, dim=24, near=60, noise=0.18):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    rows = [(i, [float(np.float32(x)) for x in v], int(rng.integers(3))) for i, v in enumerate(base)]
    for k in range(near):  # chains, stars and one large group of near copies
        i = int(rng.integers(n // 4)) if k < near // 2 else 7
        v = base[i] + noise * rng.normal(size=dim) * np.linalg.norm(base[i]) / np.sqrt(dim)
        rows.append((n + k, [float(np.float32(x)) for x in v], rows[i][2]))
    return rows


VECTORS = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("block", [2048, 5])
def test_embedding_links_equal_all_pairs(spark, monkeypatch, block):
    """Few vectors: one cell, so every pair is compared."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors(1, 200)
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1), (903, [nan] + [1.0] * 23, 1), (904, [inf] + [1.0] * 23, 1), (905, [None] + [1.0] * 23, 1)]
    rows += [(906, rows[3][1], None), (907, rows[3][1], rows[3][2]), (907, rows[3][1], rows[3][2]), (None, rows[4][1], rows[4][2]), (908, rows[5][1][:12], rows[5][2])]
    rows += [(909, [3 * x for x in rows[5][1]], rows[5][2]), (910, [1e-30] * 24, 0), (911, [1e30] * 24, 0)]
    docs = spark.createDataFrame(rows, VECTORS)
    for name in ("node", "cell", "n", "copies"):
        docs = docs.withColumn(name, F.lit("x"))
    found = embedding_dedup.near_duplicates(docs.repartition(4)).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == Counter(brute_links(rows, 0.93))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)


def test_embedding_recall_over_many_cells(spark, monkeypatch):
    """A fine grid: every link found is one, and nearly all are found, also those just above the threshold."""
    monkeypatch.setattr(embedding_dedup, "CELL", 4)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = vectors(2, 1500, near=0)
    for i in range(500):
        v = np.array(rows[i][1])
        away = rng.normal(size=len(v))
        away -= (away @ v) / (v @ v) * v
        cosine = 0.935 if i % 2 else 0.97
        w = cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * away / np.linalg.norm(away)
        rows.append((2000 + i, [float(np.float32(x)) for x in w], rows[i][2]))
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    labels = np.array([c for *_, c in rows])
    linked = (x @ x.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(linked, False)
    want = dict(zip((i for i, *_ in rows), linked.sum(1)))
    found = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert all(found[i] <= want[i] for i in want)
    assert sum(found.values()) >= 0.93 * sum(want.values()) > 900


def test_embeddings_of_no_rows(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_visits_are_the_cheapest_cells():
    """The staircase holds what a full sort of the product grid holds, in its order."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    grid = embedding_dedup.Grid(x, 6, 0.93)
    u, v = grid.costs(x)
    row, cell = grid.visits(x)
    for i in range(40):
        cost = (u[i][:, None] + v[i]).ravel()
        order = np.argsort(cost, kind="stable")
        inside = order[cost[order] <= cost.min() + grid.slack]
        mine = cell[row == i]
        assert set(mine) == set(inside) and (np.diff(cost[mine]) >= -1e-12).all() and mine[0] == grid.cells(x)[i]
