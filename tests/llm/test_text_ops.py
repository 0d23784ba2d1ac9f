"""Operators on single texts, against plain Python and held-out accuracy."""

import hashlib
import random
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SCHEMA, edge_rows, prose
from pyspark.sql import functions as F

from shardloom.llm import common, language_id, license_scan, secret_scan, toxicity
from shardloom.llm.language_id import identify, presence
from shardloom.llm.license_scan import SuffixAutomaton, scan_licenses
from shardloom.llm.secret_scan import KINDS, base_spans, battery, candidates, find_secrets, infer_encoding, redact, step_up
from shardloom.llm.toxicity import detect, remove_toxic


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_hashed_words_match_a_plain_split(monkeypatch):
    monkeypatch.setattr(common, "STEP_BYTES", 64)
    texts = [t for _, t, *_ in edge_rows()] + ["a", " a", "A b\x0bc", "x" * 500, "x" * 200 + " " + "y z " * 90, None, "ÀÉ à"]
    for table, pattern in ((common.not_white(), r"[^\x20\x09-\x0D]+"), (common.alnum_or_high(), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
        words = [re.findall(pattern, (t or "").translate(lower)) for t in texts]
        hashes = []
        for lo, hi, limits, found in common.hashed_words(pa.array(texts), table):
            hashes += [found[limits[i] : limits[i + 1]].tolist() for i in range(hi - lo)]
        assert [len(h) for h in hashes] == [len(w) for w in words]
        name = {}
        for h, w in zip(sum(hashes, []), sum(words, [])):
            assert name.setdefault(w, h) == h
        assert len(set(name.values())) == len(name)


# -- secrets ------------------------------------------------------------------------


def plain_spans(text):
    """The contract word for word: match, then drop what is too short."""
    found = []
    key = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    for m in re.finditer(rf"({key})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def test_base_spans_by_the_contract():
    rng = random.Random(0)
    bits = ["password", "Token", "API_KEY", "secret", "ſecret", "toKen", " ", '"', "'", ":", "=", "  = ", "AKIA", "é", "a1b2c3d4", "ABCD1234", "0" * 20, "f" * 15, "x", ".-_/+", "\n"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert base_spans(text) == plain_spans(text), text


def test_find_secrets_on_edges(edge_docs, no_docs):
    got = {}
    for r in find_secrets(edge_docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    rows = edge_rows()
    assert sum(map(len, got.values())) == len(rows)
    for doc_id, text, *_ in rows:
        spans = plain_spans(text or "")
        told = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        own = [r for r in got[doc_id] if r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()]
        assert own, doc_id
        assert {(r["n_assign"], r["n_access"], r["n_hex"]) for r in own} == {tuple(sum(k == x for _, k, _ in spans) for x in range(3))}
        assert set(told.split(",")) - {""} <= set(own[0]["spans"].split(","))
    assert find_secrets(no_docs).count() == 0


def test_battery_parts_random_from_natural():
    rng = random.Random(1)
    alphabets = {"hex": "0123456789abcdef", "base32": string.ascii_uppercase + "234567", "base64": string.ascii_letters + string.digits + "+/"}
    for name, chars in alphabets.items():
        kept = 0
        for _ in range(200):
            token = "".join(rng.choices(chars, k=40))
            kind, symbols = infer_encoding(token)
            assert kind == name or set(token) <= set(alphabets[kind])
            kept += battery(symbols, len(alphabets[kind])) > 0.001
        assert kept >= 190  # p-values of random tokens are about uniform
    for token in ("thisisaverylongwordwithoutanyspaces", "a" * 40, "-" * 60, "abcabcabcabcabcabcabcabcabcabc"):
        kind, symbols = infer_encoding(token)
        assert battery(symbols, len(alphabets[kind])) < 1e-5


def test_step_up_by_definition():
    rng = random.Random(2)
    for _ in range(50):
        bins = [min(399, int(rng.expovariate(0.05))) for _ in range(rng.randint(1, 60))]
        histogram = [(0, b, bins.count(b)) for b in set(bins)]
        cut, fdr = step_up(histogram, 0.05)[0], 0.05
        p = sorted(10 ** (-b / 10) for b in bins)
        passed = [x for i, x in enumerate(p) if x <= fdr * sum(y <= x for y in p) / len(p)]
        assert sum(b >= cut for b in bins) == sum(x <= max(passed, default=0) for x in p)


def test_random_tokens_are_added_and_redacted(spark):
    rng = random.Random(3)
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
    rows = [(i, prose(rng, 20) + " " + "".join(rng.choices("abcde", k=30)) + " é", 7) for i in range(40)]
    rows += [(99, f"é key {key} end token: abcdefgh12 !", 5), (98, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").withColumn("_spans", F.lit(1))
    got = {r["doc_id"]: r for r in find_secrets(docs).collect()}
    assert got[99]["spans"] == "random:6:46,assign:51:68"
    assert sum(r["n_random"] for r in got.values()) == 1
    out = {r["doc_id"]: r for r in redact(docs).collect()}
    assert redact(docs).columns == docs.columns
    assert out[99]["text"] == "é key [secret] end [secret] !" and out[99]["n_chars"] == len(out[99]["text"])
    assert all(out[i]["text"] == text and out[i]["n_chars"] == n for i, text, n in rows if i != 99)


def test_random_tokens_of_every_alphabet_look_random():
    rng = random.Random(13)
    low, up, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    for chars in (low, up, low + "234567", low + digits, up + digits, digits, low + up + digits, low + up + digits + "+/"):
        for n in (20, 32, 64):
            tokens = ["".join(rng.choices(chars, k=n)) for _ in range(200)]
            p = [b for t in tokens for *_, b in candidates(t, [])]
            assert len(p) == 200 and np.mean(np.array(p) >= 20) < 0.07, (chars, n)  # p <= 0.01


def test_what_base_spans_leave_of_a_token_is_tested():
    rng = random.Random(14)
    key = "".join(rng.choices(string.ascii_lowercase[6:] + string.digits, k=30))
    text = f"x {key}-{'0123456789abcdef' * 2}_{key.upper()} y"
    base = base_spans(text)
    assert base == [(33, 2, 65)]
    assert [(s, e) for s, e, *_ in candidates(text, base)] == [(2, 32), (66, 96)]


# -- licenses -----------------------------------------------------------------------


def test_matching_statistics_by_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        sequences = [rng.choices(range(3), k=rng.randint(1, 9)) for _ in range(3)]
        automaton = SuffixAutomaton(sequences)
        parts = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i, len(s) + 1)}
        text = rng.choices(range(4), k=25)
        for i, (length, state) in enumerate(automaton.statistics(text), 1):
            assert length == max(n for n in range(i + 1) if n == 0 or tuple(text[i - n : i]) in parts)
            ends = {(k, e) for k, s in enumerate(sequences) for e in range(len(s) + 1) if length and tuple(s[max(0, e - length) : e]) == tuple(text[i - length : i]) and e >= length}
            assert not length or set(automaton.ends[state]) == ends


def test_licenses_by_the_contract(spark, edge_docs, no_docs):
    rng = random.Random(5)
    bits = ["mit", "MIT", "license", "License.", "apache", "general", "public", "é", "x", "the", "Version 2.0", "software"]
    rows = [(i, " ".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(150)]
    rows += [(1000, license_scan.TEMPLATES[0][1]), (1001, license_scan.TEMPLATES[9][1].replace("source and binary", "any"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for table, own in ((docs, rows), (edge_docs, [r[:2] for r in edge_rows()])):
        got = sorted(scan_licenses(table).collect(), key=repr)
        want = []
        for doc_id, text in own:
            words = license_scan.words(text or "")
            places = [(p, i) for p, (phrase, _) in enumerate(license_scan.PHRASES) for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
            starts = [i for _, i in places]
            labels = ",".join(sorted({license_scan.PHRASES[p][1] for p, _ in places}))
            want.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), labels))
        assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
        assert all(0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} for r in got)
    found = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    assert (found[1000]["labels"], found[1000]["score"]) == ("mit", 1.0)
    assert found[1001]["labels"] == "bsd" and 0.6 < found[1001]["score"] < 1
    assert scan_licenses(no_docs).count() == 0


# -- classifiers --------------------------------------------------------------------


def test_presence_by_brute_force():
    texts = [b"", b"a", b"abc", b"Abcabc", bytes(range(200, 256)) * 3]
    limits = np.cumsum([0] + [len(t) for t in texts])
    x = presence(np.frombuffer(b"".join(texts), np.uint8), limits)
    for i, t in enumerate(texts):
        alone = presence(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        assert (x[i] == alone[0]).all()
        grams = {t.lower()[a : a + n] for n in (1, 2, 3, 4) for a in range(len(t) - n + 1)}
        assert x[i].sum() <= len(grams) and (x[i].sum() > 0) == (len(t) > 0)
    assert (x[2] <= x[3]).all()


def test_languages_are_told_apart(spark, edge_docs, no_docs):
    rng = random.Random(6)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "éèàçqrst"}
    rows = [(i, prose(rng, rng.randint(5, 60), letters[k]), k) for i, k in enumerate(rng.choices(sorted(letters), k=300))]
    odd = [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !", "bb"), (None, prose(rng, 9, "abcdefgh"), "aa"), (903, "abc", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string").withColumn("score", F.lit(1))
    got = {r["doc_id"]: r for r in identify(docs).collect()}
    assert len(got) == len(rows) + len(odd)
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3 and got[None]["lang_pred"] == "aa"
    assert all(r["held_out"] == is_held_out(i) and 0 <= r["score"] <= 1 for i, r in got.items())
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in rows if is_held_out(i)]) > 0.97
    assert {r["lang_pred"] for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert identify(edge_docs).count() == len(edge_rows()) and identify(no_docs).count() == 0


def test_every_language_is_learned(spark):
    rng = random.Random(12)
    rows = []
    for k in range(40):  # the last ones have fewest rows, and the very last long texts only
        letters = "".join(chr(0x4E00 + 8 * k + j) for j in range(8))
        rows += [(1000 * k + i, prose(rng, 4500 if k == 39 else 20, letters), f"l{k:02}") for i in range(15 if k < 35 else 10)]
    assert min(len(t) for _, t, lang in rows if lang == "l39") > 20_000
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in identify(docs).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, rng.randint(8, 80)).split(" ")
        bad = i % 4 == 0
        for _ in range(rng.randint(1, 3) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vile", "awful"]))
        rows.append((i, " ".join(words), rng.choice(["aa", None])))
        if i % 6:
            labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("x"))
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rows


def test_toxic_texts_are_found(spark, toxic_docs, edge_docs, no_docs):
    docs, labels, rows = toxic_docs
    got = {r["doc_id"]: r for r in detect(docs, labels).collect()}
    assert len(got) == len(rows) and all(r["held_out"] == is_held_out(i) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    right = [got[i]["predicted"] == int(i % 4 == 0) for i, *_ in rows if is_held_out(i)]
    assert np.mean(right) > 0.95
    kept = remove_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if not r["predicted"]}
    # Nothing to learn from: every score is 0 and every row stays.
    assert {r["score"] for r in detect(edge_docs, labels.where("false")).collect()} == {0.0}
    assert detect(no_docs, labels).count() == 0


def test_words_of_abuse_of_a_small_language_are_learned(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1200):
        small, bad = i % 8 == 0, i // 8 % 3 == 0
        words = prose(rng, 30, "stuvwxyz" if small else "abcdefgh").split(" ")
        if bad:  # each of the small language's in far less than MIN_SHARE of all texts
            words[rng.randrange(30)] = ["vilo", "awfulo", "nasto"][i // 24 % 3] if small else rng.choice(["nasty", "vile", "awful"])
        rows.append((i, " ".join(words), "ss" if small else "ll"))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r for r in detect(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    for part in ([i for i in got if i % 8 == 0], [i for i in got if i % 8 != 0]):
        assert np.mean([got[i]["predicted"] for i in part if i // 8 % 3 == 0]) > 0.9
        assert np.mean([got[i]["predicted"] for i in part if i // 8 % 3 != 0]) < 0.05


def test_every_labelled_text_trains(spark, monkeypatch):
    """Long texts and rows beyond any sample take part; the number of shards changes no count."""
    rng = random.Random(9)
    rows = [(i, prose(rng, 4500) + (" nasty" if i % 3 == 0 else " fine"), "aa") for i in range(150)]
    rows += [(i, "short", None) for i in range(150, 8000)]
    labels = [(i, 1, int(i % 3 == 0 and i < 150)) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    told = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert toxicity.coded_texts(docs, told).count() == sum(not is_held_out(i) for i in range(8000))
    monkeypatch.setattr(toxicity, "SHARD_WORDS", 100_000)
    got = {r["doc_id"]: r["predicted"] for r in detect(docs, told).where("doc_id < 150").collect()}
    assert min(len(rows[0][1]), len(rows[1][1])) > 20_000
    assert np.mean([p == int(i % 3 == 0) for i, p in got.items()]) > 0.9


def test_long_texts_are_pooled_in_parts(monkeypatch):
    rng = np.random.default_rng(0)
    words = [rng.integers(0, 1 << 63, 30, dtype=np.uint64) for _ in range(40)]
    labels = np.arange(40) % 2
    model = toxicity.fit([np.append(w, np.uint64(5 + y)) for w, y in zip(words * 1, labels)], labels.astype(float))
    long = np.concatenate(words)
    limits = np.array([0, len(long), len(long), len(long) + 30])
    hashes = np.concatenate((long, words[0]))
    whole = model.logits(hashes, limits)
    monkeypatch.setattr(toxicity, "STEP_WORDS", 50)
    assert np.allclose(whole, model.logits(hashes, limits), atol=1e-5)


def test_the_language_sample_is_bounded():
    for langs in (0, 1, 4, 40, 100, 200, 1000, 2000):
        texts, chars, marks = language_id.shares(langs)
        assert texts * langs <= language_id.MOST_TEXTS and texts >= 8
        assert texts * chars * langs <= language_id.MOST_CHARS and chars >= 200
        assert marks * langs <= max(language_id.MOST_LANDMARKS, langs) and marks >= 1
    assert language_id.shares(4) == (language_id.PER_LANG, language_id.MAX_CHARS, language_id.LANDMARKS)


def test_random_tokens_are_found_and_long_words_are_not(spark):
    """Of random tokens of 24 characters and more 0.95 are found in every alphabet; of long words none is marked."""
    rng = random.Random(12)
    syllables = ["".join(rng.choices("bcdfghklmnprstvw", k=1) + rng.choices("aeiou", k=1) + rng.choices(["", "n", "r", "s", "st"])) for _ in range(60)]
    word = lambda k: "".join(rng.choices(syllables, k=k))
    words = [word(9)[: rng.randint(20, 30)] for _ in range(400)] + [word(9).upper() for _ in range(100)] + [f"{word(4).title()}{word(4).title()}{word(3)}" for _ in range(100)]
    words = [w for w in words if len(w) >= 20]
    rows = [(i, " ".join(word(rng.randint(1, 4)) for _ in range(60)) + " " + w, None, None, None) for i, w in enumerate(words)]
    tokens = [(n, "".join(rng.choices(alphabet, k=n))) for alphabet in secret_scan.NARROW[3:] for n in (24, 32, 48) for _ in range(40)]
    rows += [(10_000 + i, f"{word(3)} {t} {word(3)}", None, None, None) for i, (_, t) in enumerate(tokens)]
    found = {r.doc_id: r.n_random for r in find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(found[i] for i in range(len(words))) == 0
    for k in range(len(secret_scan.NARROW) - 3):
        mine = [found[10_000 + i] for i in range(120 * k, 120 * (k + 1))]
        assert sum(mine) >= 0.95 * len(mine), secret_scan.NARROW[3 + k]


def test_pair_test_is_uniform_on_random_letters():
    rng = random.Random(3)
    counts = np.zeros((26, 26), np.int64)
    text = "".join(rng.choices("etaoinshrdlu", weights=range(12, 0, -1), k=20_000))
    for a, b in zip(text, text[1:]):
        counts[ord(a) - 97, ord(b) - 97] += 1
    table = secret_scan.PairTable(counts)
    letters = "abcdefghijklmnopqrstuvwxyz"
    p = sorted(table.p_value("".join(rng.choices(letters, k=30)), 26) for _ in range(4000))
    assert all(abs(p[int(q * 4000)] - q) < 0.05 for q in (0.05, 0.25, 0.5, 0.75, 0.95))
    assert table.p_value(text[:30], 26) < 1e-6 and table.p_value("ab1c2d", 36) is None


def test_secret_scan_digest_helper():
    assert secret_scan.spans_digest([]) == hashlib.sha256(b"").hexdigest()
