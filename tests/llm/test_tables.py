"""Mixing, archives and search, against plain Python."""

import base64
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from conftest import edge_rows
from pyspark.sql import functions as F

from shardloom.llm import warc
from shardloom.llm.mixing import mix_documents, mix_plan
from shardloom.llm.topk_search import search
from shardloom.session import materialize, scratch_path


def word_count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight; what is over a limit goes round again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return share | {s: most * sizes[s] for s in capped}
        capped |= over


def test_mixing_meets_targets(edge_docs, no_docs):
    rows = mix_plan(edge_docs).collect()
    assert len(rows) == len(edge_rows())
    sizes = defaultdict(int)
    for r in edge_rows():
        sizes[r[3]] += word_count(r[1])
    targets = brute_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 3  # equal rows round down together
    again = mix_plan(edge_docs.repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mix_plan(no_docs).count() == 0 and mix_documents(no_docs).count() == 0


def test_mixture_rows_hold_the_words_taken(edge_docs):
    plan = defaultdict(int)
    for r in mix_plan(edge_docs).collect():
        plan[(r["doc_id"], r["source"])] += r["taken"]
    mixed = mix_documents(edge_docs)
    assert set(edge_docs.columns) <= set(mixed.columns)
    told = defaultdict(int)
    for r in mixed.collect():
        assert word_count(r["text"]) == r["taken"]
        told[(r["doc_id"], r["source"])] += r["taken"]
    assert told == {k: v for k, v in plan.items() if v}


PAGES = "page_id bigint, url string, html string"


def brute_records(rows, least):
    first = {}
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(html or "", page_id)
    out, used = [], set()
    for page_id, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        owner = (html or "") not in used and first[html or ""] == page_id
        if owner:
            used.add(html or "")
        response = owner or len(body) < least
        out.append((page_id, len(body), digest, "response" if response else "revisit", None if response else first[html or ""]))
    return out


@pytest.mark.parametrize("least,chunk,roll", [(0, 1 << 18, 1 << 26), (5, 7, 300)])
def test_archives_round_trip(spark, monkeypatch, least, chunk, roll):
    monkeypatch.setattr(warc, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(warc, "ROLL_BYTES", roll)
    rng = random.Random(4)
    body = "<html>é\r\n\r\nWARC/1.1\r\n</html>" * 40
    rows = [(3, "http://a/", body), (2, "http://b/\r\nx: y", body), (9, None, body), (4, "u", ""), (5, "u", None), (6, "u", "x"), (7, "u", "x")]
    rows += [(None, "u", "only"), (None, "u", body), (8, "u", "y"), (8, "u", "y")]
    rows += [(100 + i, f"u{i}", "".join(rng.choices("abc\n", k=50 * i))) for i in range(20)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("rec", F.lit(1)).repartition(3)
    got = [tuple(r)[:5] for r in warc.round_trip(pages, least).collect()]
    assert sorted(got, key=repr) == sorted(brute_records(rows, least), key=repr)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_archives_hold_the_payloads(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 10)
    rows = [(1, "u", "é" * 33), (2, "v", "0123456789"), (3, "w", "0123456789" * 3 + "x")]
    folder = scratch_path(spark, "warc")
    chunks = materialize(warc.chunk_rows(spark.createDataFrame(rows, PAGES)), "chunks")
    manifest = materialize(warc.write_archives(chunks, warc.revisits(chunks), folder), "manifest")
    back = warc.read_archives(manifest, folder).collect()
    bodies = defaultdict(bytes)
    for r in sorted(back, key=lambda r: (r["page_id"], r["chunk_no"])):
        assert len(r["data"]) <= 10
        bodies[r["page_id"]] += bytes(r["data"])
    assert bodies == {i: html.encode() for i, _, html in rows}


def test_search_is_exact(spark, monkeypatch):
    from shardloom.llm import topk_search

    monkeypatch.setattr(topk_search, "BLOCK", 150)
    monkeypatch.setattr(topk_search, "QUERIES", 5)
    rng = np.random.default_rng(0)
    x = rng.normal(0, 0.2, (700, 24)).astype(np.float32)
    x[300:420] = x[300]  # many equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(750, None), (800, [1.0, None] + [0.0] * 22), (850, [float("nan")] * 24), (900, [float("inf")] * 24), (None, [0.5] * 24)]
    vectors = spark.createDataFrame(rows + bad + [(50, x[50].tolist())], "vec_id bigint, embedding array<float>").withColumn("row", F.lit(1))
    got = defaultdict(list)
    for r in sorted(search(vectors, F.col("vec_id") % 50 == 0).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    ids = np.array([i for i, _ in rows] + [50])
    q = np.floor(256 * np.vstack([x, x[50:51]]).astype(np.float64)).astype(np.int64)
    for query in range(0, 700, 50):
        own = np.flatnonzero(ids == query)
        scores = q @ q[own[0]]
        want = sorted((-int(s), int(i)) for k, (s, i) in enumerate(zip(scores, ids)) if k != own[0])[:5]
        found = got[query] if query != 50 else got[query][::2]  # the repeated row asks twice
        assert found == [(-s, i) for s, i in want]
    few = spark.createDataFrame([(0, [0.1, -0.2]), (1, [0.3]), (50, [])], "vec_id bigint, embedding array<float>")
    rows = search(few, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows) == [(0, 1, 1, 25 * 76), (0, 2, 50, 0), (50, 1, 0, 0), (50, 2, 1, 0)]
    assert search(few.where("false"), F.col("vec_id") % 50 == 0).count() == 0
