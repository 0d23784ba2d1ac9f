"""Toxicity by a convolutional text classifier, trained in numpy.

Words (digits, letters, non-ASCII; A-Z lowered) are hashed to embeddings; filters
of several widths run over them, the largest response of each filter anywhere in
the text is its feature (max pooling), and a logistic layer adds them up. A text is
scored whole; long texts are pooled part by part. Each language has its own
threshold: the score is 0.5 where the output is at the threshold of the text's
language. That language is guessed from the text's words (naive Bayes over the same
hashes), never taken from a column, so only the text enters a score.

The network knows the words of many texts (``MIN_SHARE`` of all), and every word that
``MIN_TEXTS`` texts of one label and language hold if its share of positive texts there
differs from that language's mean: a language's own words of abuse count however
few texts it has.

Every labelled text that is not held out takes part, whole. Three in four are fitted, one in four, by
a hash of the id, sets the thresholds. Words are counted by Spark. The texts of the fit are dealt
into shards of about ``SHARD_WORDS`` words; in each of ``EPOCHS`` rounds every shard trains the common
network on its own texts and the mean of all is the network of the next round, each
label with the same weight. Thresholds come from counts of outputs in bins of 1 / ``BINS``; a language with
fewer than ``CALIBRATE`` positives there uses the threshold of all, the others are drawn towards it.
Null and empty texts have no words: their features are 0 and they get a score like any other.
Without labels of both kinds all scores are 0. Ties and repeated rows are scored
alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from shardloom.llm.common import alnum_or_high, hashed_words, held_out, if_small
from shardloom.session import discard, materialize

BUCKETS = 1 << 16
WIDTH = 8
FILTERS = ((1, 8), (2, 4), (3, 4))
PAD = max(w for w, _ in FILTERS) - 1
SHARD_WORDS = 1 << 22
MIN_SHARE = 0.03
MIN_TEXTS = 4
EPOCHS = 6
BATCH = 32
RATE = 0.01
DECAY = 2e-3
CALIBRATE = 10
SHRINK = 20
#: Standard errors from the mean at which a word marks a label; a word counts as if in so many more texts.
SIGNIFICANT = 2.0
RARE = 2
UPPER = 0.75
#: Outputs are counted in bins of 1 / BINS within BOUND when thresholds are set.
BINS, BOUND = 256, 64
#: Languages whose word counts a task holds at once, and values of the network in a slice of the mean.
HELD_LANGS = 8
SLICE = 1 << 14
#: Words convolved in one step.
STEP_WORDS = 1 << 15


@dataclass
class Model:
    known: np.ndarray  # bucket -> row of the embeddings; 0 for words seen in few texts that mark no label
    embed: np.ndarray
    filters: list[np.ndarray]  # (width * WIDTH) x filters
    bias: list[np.ndarray]
    out: np.ndarray
    offset: float
    langs: np.ndarray | None = None  # bucket x language: log odds of the words
    thresholds: np.ndarray | None = None
    scale: float = 1.0

    def responses(self, rows: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every word of ``rows`` but the padding at the end."""
        e = self.embed[rows]
        n = len(rows) - PAD
        out = []
        for (width, _), w, b in zip(FILTERS, self.filters, self.bias):
            total = np.broadcast_to(b, (n, len(b))).copy()
            for i in range(width):
                total += e[i : i + n] @ w[i * WIDTH : (i + 1) * WIDTH]
            out.append(total)
        return out

    def features(self, rows: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Max-pooled features of texts given as word rows, ``PAD`` zeros after each."""
        pooled = [np.maximum.reduceat(r, limits[:-1], axis=0) for r in self.responses(rows)]
        return np.maximum(np.concatenate(pooled, axis=1), 0.0)

    def logits(self, hashes: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Outputs for texts given by word hashes; any number of words."""
        buckets = (hashes % np.uint64(BUCKETS)).astype(np.int64)
        texts = len(limits) - 1
        pooled = np.zeros((texts, len(self.out)), np.float32)
        a = 0
        while a < texts:
            b = max(a + 1, int(np.searchsorted(limits, limits[a] + STEP_WORDS, "right")) - 1)
            b = min(b, texts)
            if b - a > 1 or limits[b] - limits[a] <= 2 * STEP_WORDS:
                rows, own = padded(self.known[buckets[limits[a] : limits[b]]], limits[a : b + 1] - limits[a])
                pooled[a:b] = self.features(rows, own)
            else:  # one long text: parts that overlap by PAD words
                for at in range(int(limits[a]), int(limits[b]), STEP_WORDS):
                    rows = self.known[buckets[at : min(int(limits[b]), at + STEP_WORDS + PAD)]]
                    rows, own = padded(rows, np.array([0, len(rows)]))
                    pooled[a] = np.maximum(pooled[a], self.features(rows, own)[0])
            a = b
        return pooled @ self.out + self.offset

    def scores(self, hashes: np.ndarray, limits: np.ndarray) -> np.ndarray:
        lang = guess(self.langs, hashes, limits)
        z = np.clip(self.scale * (self.logits(hashes, limits) - self.thresholds[lang]), -30, 30)
        return 1.0 / (1.0 + np.exp(-z))


def padded(rows: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word rows with ``PAD`` zeros after each text (one more where a text is empty)."""
    sizes = np.diff(limits)
    room = sizes + PAD + (sizes == 0)
    own = np.concatenate(([0], np.cumsum(room)))
    out = np.zeros(own[-1] + PAD, rows.dtype)
    out[np.arange(len(rows)) + np.repeat(own[:-1] - limits[:-1], sizes)] = rows
    return out, own


def guess(langs: np.ndarray, hashes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Number of the likeliest language of each text; 0 for a text without words."""
    if langs.shape[1] == 1 or not len(hashes):
        return np.zeros(len(limits) - 1, np.int64)
    odds = langs[(hashes % np.uint64(BUCKETS)).astype(np.int64)]
    sums = np.zeros((len(limits), langs.shape[1]))
    total = np.concatenate((np.zeros((1, langs.shape[1])), np.cumsum(odds, axis=0, dtype=np.float64)))
    sums = total[limits[1:]] - total[limits[:-1]]
    return sums.argmax(1)


def fit(words: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Train the network on texts of one language given by word hashes, in one shard."""
    buckets = [(w % np.uint64(BUCKETS)).astype(np.uint16) for w in words]
    seen, positive = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b, y in zip(buckets, labels):
        held = np.unique(b)
        seen[held] += 1
        positive[held] += y
    model = _untrained(seen, _association([(seen, positive, len(labels), labels.sum())]), len(labels), seed)
    for epoch in range(EPOCHS):
        _train_shard(model, buckets, labels, np.ones(len(labels)), epoch, 0)
    return model


def _untrained(seen: np.ndarray, marks: np.ndarray, texts: int, seed: int = 7) -> Model:
    """The network before training, from the texts that hold each word and the words' marks."""
    rng = np.random.default_rng(seed)
    known = np.zeros(BUCKETS, np.int64)
    often = np.flatnonzero((seen >= max(MIN_TEXTS, MIN_SHARE * texts)) | (marks != 0))
    known[often] = np.arange(1, len(often) + 1)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    embed = (0.02 * rng.standard_normal((len(often) + 1, WIDTH))).astype(np.float32)
    embed[0] = 0.0
    embed[1:, 0] = marks[often]
    total = sum(n for _, n in FILTERS)
    return Model(known, embed, [normal(w * WIDTH, n) for w, n in FILTERS], [np.zeros(n, np.float32) for _, n in FILTERS], normal(total), 0.0)


def _association(langs: list[tuple[np.ndarray, np.ndarray, int, int]]) -> np.ndarray:
    """How far a word's share of positive texts is from the mean of a language, in fours of standard
    errors, in the language where it is farthest; 0 where it is not significant in any.

    A language is given by the texts and positive texts that hold each word, and by its texts and positive texts.
    """
    best = np.zeros(BUCKETS)
    for seen, positive, texts, marked in langs:
        mean = marked / max(texts, 1)
        if not 0 < mean < 1:
            continue
        z = (positive - mean * seen) / np.sqrt(mean * (1 - mean) * (seen + RARE))
        z[(np.maximum(positive, seen - positive) < MIN_TEXTS) | (np.abs(z) < SIGNIFICANT)] = 0.0
        best = np.where(np.abs(z) > np.abs(best), z, best)
    return np.clip(best / 4, -2, 2)


def _train_shard(model: Model, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, epoch: int, shard: int) -> None:
    """One pass over the texts of a shard: Adam on the logistic loss."""
    order = np.random.default_rng((epoch, shard)).permutation(len(texts))
    rows = [model.known[t] for t in texts]
    state: dict[str, list] = {}
    for batch in np.array_split(order, max(1, len(order) // BATCH)):
        ends = np.cumsum([len(rows[i]) for i in batch])
        for part in np.split(batch, np.flatnonzero(np.diff(ends // STEP_WORDS)) + 1):  # long texts: fewer at once
            _step(model, [rows[i] for i in part], y[part], weight[part], RATE * (1 - epoch / EPOCHS), state)


def _tops(model: Model, texts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Largest responses, texts by filters for each width, and the words at their first places."""
    if len(texts) == 1 and len(texts[0]) > 2 * STEP_WORDS:  # one long text: parts that overlap by PAD words
        parts = [_tops(model, [texts[0][at : at + STEP_WORDS + PAD]]) for at in range(0, len(texts[0]), STEP_WORDS)]
        found, windows = [], []
        for k, (_, n) in enumerate(FILTERS):
            tops = np.concatenate([f[k] for f, _ in parts])
            best = tops.argmax(0)
            found.append(tops[best, np.arange(n)][None])
            windows.append(np.concatenate([w[k] for _, w in parts])[best, np.arange(n)][None])
        return found, windows
    limits = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    rows, own = padded(np.concatenate(texts), limits)
    text_of = np.repeat(np.arange(len(texts)), np.diff(own))
    found, windows = [], []
    for (width, _), r in zip(FILTERS, model.responses(rows)):
        top = np.maximum.reduceat(r, own[:-1], axis=0)
        hit = r == top[text_of]
        # First place of the largest response, by text and filter.
        at = np.where(hit, np.arange(len(r))[:, None], len(r))
        places = np.minimum.reduceat(at, own[:-1], axis=0)
        found.append(top)
        windows.append(rows[places[:, :, None] + np.arange(width)])  # text, filter, word
    return found, windows


def _step(model: Model, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float, state: dict) -> None:
    """One step of gradient descent; only the pooled places carry a gradient back."""
    found, windows = _tops(model, texts)
    feature = np.maximum(np.concatenate(found, axis=1), 0.0)
    z = feature @ model.out + model.offset
    slope = (weight * (1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)).astype(np.float32)
    d_feature = np.outer(slope, model.out) * (feature > 0)
    grads: dict[str, np.ndarray] = {"out": feature.T @ slope + DECAY * model.out, "offset": np.array(slope.sum())}
    d_embed = np.zeros_like(model.embed)
    at = 0
    for k, ((width, n), w) in enumerate(zip(FILTERS, model.filters)):
        d = d_feature[:, at : at + n]
        at += n
        words = windows[k]
        x = model.embed[words].reshape(len(texts), n, width * WIDTH)
        grads[f"f{k}"] = np.einsum("tn,tnx->xn", d, x) + DECAY * w
        grads[f"b{k}"] = d.sum(0)
        back = (d[:, :, None] * w.T[None]).reshape(-1, WIDTH)
        np.add.at(d_embed, words.reshape(-1), back)
    d_embed += DECAY / len(y) * model.embed
    d_embed[0] = 0.0
    grads["embed"] = d_embed
    targets = {"embed": model.embed, "out": model.out}
    targets |= {f"f{k}": w for k, w in enumerate(model.filters)} | {f"b{k}": b for k, b in enumerate(model.bias)}
    for name, g in grads.items():
        m, v, t = state.get(name, (np.zeros_like(g, np.float32), np.zeros_like(g, np.float32), 0))
        m, v, t = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, t + 1
        state[name] = (m, v, t)
        change = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
        if name == "offset":
            model.offset -= float(change)
        else:
            targets[name] -= change.astype(np.float32)


def best_threshold(z: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> float:
    """The output that parts labels with the fewest errors, in the upper part of its gap.

    ``z`` are different outputs, with the texts of each label that have them. Among equal places the
    highest is taken: what cannot be told apart is left alone.
    """
    order = np.argsort(-z)
    z = z[order]
    gain = np.concatenate(([0.0], np.cumsum((positive - negative)[order])))  # if cut after k outputs
    k = int(gain.argmax())
    edge = np.concatenate(([z[0] + 1.0], z, [z[-1] - 1.0]))
    return float(UPPER * edge[k] + (1 - UPPER) * edge[k + 1])


def calibrate(model: Model, lang: np.ndarray, z: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> None:
    """Set the thresholds by language and the scale of the scores from counts by language and output."""

    def best(own: np.ndarray) -> float:
        values, at = np.unique(z[own], return_inverse=True)
        return best_threshold(values, np.bincount(at, positive[own]), np.bincount(at, negative[own]))

    every = best(np.ones(len(z), bool)) if positive.sum() and negative.sum() else 0.0
    model.thresholds = np.full(model.langs.shape[1], every)
    for k in range(model.langs.shape[1]):
        own = lang == k
        known = positive[own].sum()
        if known >= CALIBRATE and negative[own].sum():
            model.thresholds[k] += known / (known + SHRINK) * (best(own) - every)
    n = positive + negative
    spread = np.sqrt(np.average((z - np.average(z, weights=n)) ** 2, weights=n)) if n.sum() else 0.0
    model.scale = 4.0 / max(float(spread), 1e-3)


def coded_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``key, part, lang, toxic, words`` of every labelled text that is not held out: words are buckets of 16 bits.

    ``part`` 3 sets the thresholds. A written table.
    """
    told = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    told = told.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.where(~held_out() & (F.length("text") > 0)).select(F.col("doc_id").cast("string").alias("id"), "lang", "text")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = alnum_or_high()
        for batch in batches:
            for lo, hi, limits, hashes in hashed_words(batch.column(2), word):
                buckets = (hashes % np.uint64(BUCKETS)).astype(np.uint16)
                words = [buckets[limits[i] : limits[i + 1]].tobytes() for i in range(hi - lo)]
                columns = [c.slice(lo, hi - lo) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(words, pa.binary())], names=["id", "lang", "words"])

    # Words are joined, not texts: they take a third of the room where labels are too many to broadcast.
    told = if_small(materialize(told.select(F.col("doc_id").cast("string").alias("id"), "toxic"), "told"))
    coded = texts.mapInArrow(code, "id string, lang string, words binary").join(told, "id")
    key = F.xxhash64("id")
    return materialize(coded.select(key.alias("key"), F.pmod(F.shiftright(key, 40), F.lit(4)).cast("int").alias("part"), "lang", "toxic", "words"), "coded")


def word_counts(coded: DataFrame) -> DataFrame:
    """``lang, bucket, n, seen, positive``: occurrences in all texts, texts and positive texts of the fit (column ``fitted``)."""
    names = ["lang", "bucket", "n", "seen", "positive"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts[0])
                columns = [pa.array([lang] * len(at), pa.string()), pa.array(at), *(pa.array(c[at]) for c in counts)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            held.clear()

        for batch in batches:
            for lang, toxic, fitted, words in zip(*(c.to_pylist() for c in batch.columns)):
                if lang not in held:
                    if len(held) == HELD_LANGS:
                        yield from flush()
                    held[lang] = np.zeros((3, BUCKETS), np.int64)
                own, n = np.unique(np.frombuffer(words, np.uint16), return_counts=True)
                held[lang][0, own] += n
                if fitted:
                    held[lang][1, own] += 1
                    held[lang][2, own] += toxic
        yield from flush()

    slim = coded.select("lang", "toxic", "fitted", "words")
    found = slim.mapInArrow(count, "lang string, bucket bigint, n bigint, seen bigint, positive bigint")
    return found.groupBy("lang", "bucket").agg(*(F.sum(c).alias(c) for c in names[2:]))


def shards(fitted: DataFrame) -> DataFrame:
    """``shard, toxic, limits, words``: the texts of the fit in groups of about SHARD_WORDS words, one row each. A written table."""
    total = fitted.agg(F.sum(F.length("words"))).first()[0] // 2
    shard = F.pmod(F.xxhash64("key", "words"), F.lit(max(1, -(-total // SHARD_WORDS))))

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("words", "ascending"), ("toxic", "ascending")])
        words = group["words"].to_pylist()
        limits = np.concatenate(([0], np.cumsum([len(w) // 2 for w in words])))
        columns = [group["shard"][:1], [group["toxic"].to_numpy().astype(np.uint8).tobytes()], [limits.tobytes()], [b"".join(words)]]
        return pa.table(dict(zip(["shard", "toxic", "limits", "words"], columns)))

    slim = fitted.select(shard.alias("shard"), "key", "toxic", "words")
    return materialize(slim.groupBy("shard").applyInArrow(join, "shard bigint, toxic binary, limits binary, words binary"), "shards")


def _values(model: Model) -> np.ndarray:
    """All trained values in one array."""
    return np.concatenate([x.ravel() for x in (model.embed, *model.filters, *model.bias, model.out)] + [[model.offset]])


def _with_values(model: Model, values: np.ndarray) -> Model:
    """A network with the words of ``model`` and other values."""
    old = (model.embed, *model.filters, *model.bias, model.out)
    parts = np.split(values, np.cumsum([x.size for x in old]))
    embed, *rest, out = [p.reshape(x.shape).astype(np.float32) for p, x in zip(parts, old)]
    k = len(FILTERS)
    return Model(model.known, embed, rest[:k], rest[k:], out, float(parts[-1][0]), model.langs)


def _round(table: DataFrame, model: Model, weights: tuple[float, float], epoch: int) -> Model:
    """Every shard trains the network on its texts; the mean of all by their numbers of texts.

    Tasks pass on the sums of their shards in slices, which are added up slice by slice.
    """
    shared = table.sparkSession.sparkContext.broadcast(model)
    schema = "at int, texts double, total binary"

    def train_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = 0.0, 0
        for batch in batches:
            for shard, toxic, limits, words in zip(*(c.to_pylist() for c in batch.columns)):
                own = _with_values(shared.value, _values(shared.value))
                y, cuts = np.frombuffer(toxic, np.uint8), np.frombuffer(limits, np.int64)
                _train_shard(own, np.split(np.frombuffer(words, np.uint16), cuts[1:-1]), y.astype(float), np.where(y == 1, weights[1], weights[0]), epoch, shard)
                total, texts = total + len(y) * _values(own), texts + len(y)
        if texts:
            cuts = range(0, len(total), SLICE)
            columns = [pa.array(range(len(cuts)), pa.int32()), pa.array([float(texts)] * len(cuts)), pa.array([total[i : i + SLICE].tobytes() for i in cuts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "texts", "total"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(t, np.float64) for t in parts["total"].to_pylist())
        return pa.table({"at": parts["at"][:1], "texts": [sum(parts["texts"].to_pylist())], "total": [total.tobytes()]})

    found = table.select("shard", "toxic", "limits", "words").mapInArrow(train_all, schema).groupBy("at").applyInArrow(add, schema)
    slices = sorted(found.collect(), key=lambda r: r["at"])
    return _with_values(model, np.concatenate([np.frombuffer(r["total"], np.float64) / r["texts"] for r in slices]))


def output_counts(coded: DataFrame, model: Model) -> DataFrame:
    """``lang, bin, positive, negative``: texts by guessed language and bin of the output."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            words = [np.frombuffer(w, np.uint16) for w in batch.column(1).to_pylist()]
            limits = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
            hashes = np.concatenate([*words, np.empty(0, np.uint16)]).astype(np.uint64)
            z = np.clip(own.logits(hashes, limits), -BOUND, BOUND)
            columns = [pa.array(guess(own.langs, hashes, limits)), pa.array(np.floor(z * BINS).astype(np.int64)), batch.column(0)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "bin", "toxic"])

    found = coded.select("toxic", "words").mapInArrow(outputs, "lang bigint, bin bigint, toxic int")
    return found.groupBy("lang", "bin").agg(F.sum("toxic").alias("positive"), F.sum(1 - F.col("toxic")).alias("negative"))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit and calibrate on all rows that are not held out; None without both labels."""
    stored = coded_texts(docs, labels)
    sizes = stored.groupBy("lang", "toxic", (F.col("part") < 3).alias("fitted")).count().collect()
    total = lambda **own: sum(r["count"] for r in sizes if all(r[k] == v for k, v in own.items()))
    if not total(toxic=0) or not total(toxic=1):
        return None
    split = all(total(toxic=y, fitted=f) for y in (0, 1) for f in (True, False))
    coded = stored.withColumn("fitted", (F.col("part") < 3) | F.lit(not split))
    fits = {"fitted": True} if split else {}
    names = sorted({r["lang"] for r in sizes if r["lang"] is not None}) or [""]
    counts = {lang: np.zeros((3, BUCKETS)) for lang in [*names, None]}
    found = word_counts(coded).toArrow()
    langs = np.array(found["lang"].to_pylist(), object)
    for lang, own in counts.items():
        rows = np.flatnonzero(langs == lang)
        own[:, found["bucket"].to_numpy()[rows]] = [found[c].to_numpy()[rows] for c in ("n", "seen", "positive")]
    marks = _association([(c[1], c[2], total(lang=lang, **fits), total(lang=lang, toxic=1, **fits)) for lang, c in counts.items()])
    n = total(**fits)
    model = _untrained(sum(c[1] for c in counts.values()), marks, n)
    odds = 0.5 + np.stack([counts[lang][0] for lang in names], axis=1)
    model.langs = np.log(odds / odds.sum(0)).astype(np.float32)
    table = shards(coded.where("fitted"))
    weights = tuple(n / (2 * total(toxic=y, **fits)) for y in (0, 1))
    for epoch in range(EPOCHS):
        model = _round(table, model, weights, epoch)
    held = output_counts(coded.where(~F.col("fitted")) if split else coded, model).toArrow()
    lang, at, positive, negative = (held[c].to_numpy() for c in ("lang", "bin", "positive", "negative"))
    calibrate(model, lang, at / BINS, positive, negative)
    discard(stored, table)
    return model


def score(docs: DataFrame, model: Model | None, out: str = "score") -> DataFrame:
    """The columns of ``docs`` (without one named ``out``) and the score of every row."""
    docs = docs.drop(out)
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields, StructField(out, DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, word = shared.value, alnum_or_high()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for lo, hi, limits, hashes in hashed_words(batch.column(at), word) if own is not None else ():
                scores[lo:hi] = own.scores(hashes, limits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, out])

    return docs.mapInArrow(predict, schema)


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model).drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def remove_toxic(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their columns."""
    learn = docs if usable is None else docs.where(usable)
    scored = score(docs, train(learn, labels), "_toxicity")
    return scored.where(F.col("_toxicity") < 0.5).drop("_toxicity")
