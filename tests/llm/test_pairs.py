"""Operators that compare texts, against brute force over all pairs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import edge_rows, prose
from pyspark.sql import functions as F

from shardloom.llm import jaccard_join, suffix_dedup
from shardloom.llm.components import components
from shardloom.llm.decontaminate import best_segment, contaminated, remove_contaminated
from shardloom.llm.jaccard_join import join_components, keep_first
from shardloom.llm.suffix_dedup import longest_previous_factors, remove_repeats

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if 0 < len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_components(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return out


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("n,percent,words", [(3, 80, 120), (2, 50, 20), (3, 90, 600)])
def test_a_pair_is_made_by_its_first_common_ngram_alone(spark, monkeypatch, n, percent, words):
    """Near copies share many n-grams of their prefixes; no link is lost and pairs are not made by each of them."""
    rng = random.Random(31)
    base, rows = prose(rng, words).split(" "), []
    for i in range(40):
        own = list(base)
        for at in rng.sample(range(words), rng.randint(1, max(2, words // 40))):
            own[at] = f"w{rng.randrange(3)}"
        rows.append((i, " ".join(own[: words - rng.randrange(3)])))
    rows = list({t: (i, t) for i, t in rows}.values())
    facts = jaccard_join.facts_of(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), n, percent).cache()
    members = jaccard_join.prefix_members(facts.where("n > 0"), percent)
    checked = spark.createDataFrame([], "a bigint, b bigint, least double, most double, linked boolean")
    found = spark.createDataFrame([], "node bigint, root bigint")
    with monkeypatch.context() as patch:
        patch.setattr(type(facts), "distinct", lambda self: self)  # what the join makes
        made = jaccard_join._second_pairs(members, checked, found, facts.select("row", *jaccard_join._WORDS), percent).collect()
    ids = {r["row"]: r["doc_id"] for r in facts.select("row", "doc_id").collect()}
    pairs = [tuple(sorted((ids[r["a"]], ids[r["b"]]))) for r in made]
    sets = {i: shingles(t, n) for i, t in rows}
    links = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])}
    assert len(links) > 20 and links <= set(pairs)
    assert len(pairs) <= 1.5 * len(set(pairs))
    facts.unpersist()


@pytest.mark.parametrize("n,percent", [(3, 90), (2, 50)])
def test_components_on_edges(edge_docs, n, percent):
    got = [tuple(r) for r in join_components(edge_docs, n, percent).collect()]
    assert order(got) == order(brute_components([r[:2] for r in edge_rows()], n, percent))


def test_components_of_a_drifting_group(spark):
    """A chain of near copies, each a little further from the first: links between neighbours only."""
    rng = random.Random(1)
    words, rows = prose(rng, 160).split(" "), []
    for i in range(60):
        rows.append((1000 - i, " ".join(words)))
        words = list(words)
        words[(i * 7) % 160] = f"new{i}"
        if i % 10 == 0:
            words.insert(3, f"more{i}")
    rows += [(2000 + i, prose(rng, 12)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for n, percent in ((3, 90), (5, 80)):
        got = [tuple(r) for r in join_components(docs, n, percent).collect()]
        assert order(got) == order(brute_components(rows, n, percent))


def test_keep_first_keeps_one_of_each_group(edge_docs, no_docs):
    kept = keep_first(edge_docs, 5, 80)
    assert kept.columns == edge_docs.columns
    found = Counter((r["doc_id"], r["text"]) for r in kept.select("doc_id", "text").collect())
    rows = [r[:2] for r in edge_rows()]
    low = Counter((c, n > 0) for _, n, c in brute_components(rows, 5, 80))
    assert sum(found.values()) == sum(n if not full else 1 for (c, full), n in low.items() if c is not None) + 2  # the null id, and two texts of id 18
    assert found[(1, rows[0][1])] == 1 and (2, rows[0][1]) not in found and (None, rows[0][1]) not in found
    assert found[(5, rows[4][1])] == 1  # a repeated row
    assert found[(None, rows[13][1])] == 1  # a null id of another text stays
    assert found[(6, "")] == 2 and found[(7, None)] == 1 and found[(8, "   \n\t")] == 1  # empty sets all stay
    assert keep_first(no_docs).count() == 0


def test_components_contract_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def brute_repeats(rows, min_len, keep):
    ranked = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    count, first = Counter(), {}
    data = [(t or "").encode() for _, t in rows]
    for i in ranked:
        for s in range(len(data[i]) - min_len + 1):
            piece = data[i][s : s + min_len]
            count[piece] += 1
            first.setdefault(piece, (i, s))
    out = []
    for i, b in enumerate(data):
        mask = bytearray(len(b))
        for s in range(len(b) - min_len + 1):
            piece = b[s : s + min_len]
            if count[piece] > 1 and (keep == "none" or first[piece] != (i, s)):
                mask[s : s + min_len] = b"\1" * min_len
        kept = bytes(x for x, m in zip(b, mask) if not m)
        runs = len(re.findall(rb"\x01+", bytes(mask)))
        out.append((rows[i][0], len(b), sum(mask), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("min_len,hot", [(400, 512), (40, 2)])
def test_repeats_on_edges(edge_docs, monkeypatch, min_len, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = [tuple(r)[:5] for r in remove_repeats(edge_docs, min_len, text=False).collect()]
    assert order(got) == order(brute_repeats([r[:2] for r in edge_rows()], min_len, "none"))


def test_repeats_keep_the_first(spark):
    rng = random.Random(3)
    part = prose(rng, 40)
    rows = [(i, prose(rng, 10) + part[: 60 + 9 * i] + prose(rng, 5)) for i in range(12)] + [(20, part + part)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    result = remove_repeats(docs, 50, keep="first").collect()
    assert order(tuple(r)[:5] for r in result) == order(brute_repeats(rows, 50, "first"))
    assert all(len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in result)


def test_suffix_order_by_sorting():
    rng = random.Random(9)
    for _ in range(150):
        letters = rng.choice(["a", "ab", "abcd"])
        regions = ["".join(rng.choices(letters, k=rng.randint(1, 200))).encode() for _ in range(rng.randint(1, 6))]
        regions += [regions[0][: rng.randint(1, 200)], regions[-1]]
        min_len = rng.randint(1, 70)
        order, shared = suffix_dedup.suffix_order(regions, min_len)
        suffixes = [(r[s:], k) for k, r in enumerate(regions) for s in range(len(r))]
        # An end comes before all bytes, the ends in order of their regions.
        want = sorted(range(len(suffixes)), key=lambda i: ([*(b + 1 for b in suffixes[i][0])], suffixes[i][1]))
        assert order.tolist() == want
        for i in range(1, len(want)):
            a, b = suffixes[want[i - 1]][0], suffixes[want[i]][0]
            n = next((j for j, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert shared[i] == (n if n >= min_len else 0)


def test_longest_previous_factors_by_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        s = "".join(rng.choices("ab", k=rng.randint(1, 20)))
        ranks = sorted(range(len(s)), key=lambda i: s[i:])

        def shared(a, b):
            k = 0
            while max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            return k

        length, source = longest_previous_factors(ranks, [0] + [shared(a, b) for a, b in zip(ranks, ranks[1:])])
        for p, n, q in zip(ranks, length, source):
            assert n == max((shared(p, e) for e in range(p)), default=0)
            assert n == 0 or (q < p and shared(p, q) == n)


def test_best_segment_by_brute_force(spark):
    rng = random.Random(10)
    rows = [[rng.random() < share for _ in range(rng.randint(1, 30))] for share in (0.2, 0.5, 0.8, 0.9) for _ in range(40)]
    table = best_segment(spark.createDataFrame([(r,) for r in rows], "same array<boolean>"), "same", "s")
    for r in table.collect():
        best = (0, 0)
        for i in range(len(r["same"])):
            for k in range(i + 1, len(r["same"]) + 1):
                hits = sum(r["same"][i:k])
                if r["same"][i] and 5 * hits >= 4 * (k - i):
                    best = max(best, (hits, -i))
        assert (r["s"]["matched"], r["s"]["first"]) == (best[0], -best[1]), r["same"]


def test_overlaps_with_early_and_regular_substitutions(spark):
    rng = random.Random(11)
    cases = [(14, (4, 9)), (20, (4, 9, 14)), (20, (3, 7, 11)), (30, range(4, 30, 5)), (9, (4,))]
    items = [[f"w{k}x{i}" for i in range(n)] for k, (n, _) in enumerate(cases)]
    texts = [" ".join("other" if i in gone else w for i, w in enumerate(item)) for item, (_, gone) in zip(items, cases)]
    docs = spark.createDataFrame([(k, prose(rng, 12) + " " + t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["matched"], r["start"]) for r in contaminated(docs, benchmark).collect()}
    assert got == {(k, k): (n - len(gone), 12) for k, (n, gone) in enumerate(cases)}
    assert remove_contaminated(docs, benchmark).count() == 0


def test_decontamination_tolerates_substitutions(spark, edge_docs, no_docs):
    rng = random.Random(9)
    item = prose(rng, 40).split(" ")
    changed = list(item)
    for i in (6, 17, 29):
        changed[i] = "other"
    broken = [w if i % 3 else f"x{i}" for i, w in enumerate(item)]
    rows = [
        (1, prose(rng, 15) + ". " + " ".join(item).upper() + "! " + prose(rng, 5)),
        (2, prose(rng, 33) + " " + ", ".join(changed)),
        (3, " ".join(broken)),  # a third of the words differ: no five in step
        (4, " ".join(item[10:24]) + " " + prose(rng, 30)),  # a part of 14 words
        (5, " ".join(item[:8])),  # too little
        (6, None), (7, ""), (None, " ".join(item)), (8, prose(rng, 80)), (1, "clean"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("seed", F.lit(1)).withColumn("item_id", F.lit(1))
    items = [(70, " ".join(item)), (71, "one two three"), (72, None), (None, prose(rng, 20)), (73, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["matched"], r["start"]) for r in contaminated(docs, benchmark).collect()}
    assert got == {(1, 70): (40, 15), (2, 70): (37, 33), (4, 70): (14, 0), (None, 70): (40, 0)}
    kept = remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert order(left) == order([r for r in rows if r[0] in (3, 5, 6, 7, 8) or r == (1, "clean")])
    assert contaminated(no_docs, benchmark).count() == 0
    assert contaminated(edge_docs, benchmark.where("false")).count() == 0
