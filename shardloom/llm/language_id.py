"""Language identification with a blended-spectrum presence kernel and Nystrom landmarks.

Features of a text are which byte n-grams of 1 to 4 bytes it holds (presence, not
counts), hashed to ``DIM`` places; the kernel of two texts is the number of places
they share over the root of the product of their numbers. Landmarks are labelled
texts; Nystrom maps a text to its kernel values with them times the inverse root
of the landmarks' own kernel, and one ridge regression for each language (against
the rest) is fitted on the mapped training texts in closed form. Landmarks and weights are
multiplied once, so a batch of texts is scored by one matrix product.

Training reads up to ``PER_LANG`` labelled texts of every language with the smallest hash
of their ids, the first ``LANDMARKS`` of them landmarks, and of longer texts, which are taken after
all others of their language, the first ``MAX_CHARS`` characters. Where languages are many, each has its share of ``MOST_TEXTS``
texts, ``MOST_CHARS`` characters and ``MOST_LANDMARKS`` landmarks (at least 8, 200 and 1), so the driver's sample and
the kernel of the landmarks stay bounded and every language is learned. Prediction covers all documents and whole texts. Null
texts and texts without letters are ``und`` with score 0, as is everything when there
is nothing to learn from; rows without an id are not learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import held_out, steps, text_buffer

ORDERS = (1, 2, 3, 4)
DIM = 1 << 14
PER_LANG = 160
LANDMARKS = 24
MAX_CHARS = 20_000
MOST_TEXTS, MOST_CHARS, MOST_LANDMARKS = 16_000, 1 << 25, 1200
RIDGE = 1e-2
SHARPNESS = 8.0
UNKNOWN = "und"
#: Rows scored by one matrix product, and bytes looked at in one step.
ROWS = 64
FIT_ROWS = 1024
PART = 1 << 18

_LETTER = re.compile(r"[^\W\d_]")
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _places(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order the hashed places of the n-grams that start at each byte."""
    part = _LOWER[part].astype(np.uint32)
    gram = np.zeros(len(part), np.uint32)
    for n, multiplier in zip(ORDERS, _MULTIPLIERS):
        if len(part) < n:
            return
        gram = (gram[: len(part) - n + 1] << np.uint32(8)) | part[n - 1 :]
        scrambled = (gram ^ (gram >> np.uint32(15))) * np.uint32(multiplier)
        yield n, scrambled >> np.uint32(32 - DIM.bit_length() + 1)


def presence(data: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Rows by DIM: 1 where a text (bytes between two limits) holds an n-gram of that place."""
    rows = len(limits) - 1
    out = np.zeros((rows, DIM), np.float32)
    flat = out.reshape(-1)
    end = int(limits[-1])
    for at in range(int(limits[0]), end, PART):  # a part and the bytes its last n-grams need
        to = min(end, at + PART)
        first, last = np.searchsorted(limits, [at, to - 1], "right") - 1
        counts = np.diff(np.clip(limits[first : last + 2], at, to))
        row_of = np.repeat(np.arange(first, last + 1), counts) * DIM
        left = np.repeat(limits[first + 1 : last + 2], counts) - np.arange(at, to)
        for n, place in _places(data[at : min(end, to + max(ORDERS) - 1)]):
            place = place[: to - at]
            inside = left[: len(place)] >= n
            flat[(row_of[: len(place)] + place)[inside]] = 1.0
    return out


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # DIM x languages: the landmarks times the weights of their kernel values

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and score of the best language for each row of presences."""
        sizes = np.maximum(x.sum(1, keepdims=True), 1.0)
        margins = SHARPNESS * (x @ self.weights) / np.sqrt(sizes)
        margins -= margins.max(1, keepdims=True)
        odds = np.exp(margins)
        best = odds.argmax(1)
        return best, odds[np.arange(len(x)), best] / odds.sum(1)


def _scaled(texts: list[bytes]) -> np.ndarray:
    """Presences of texts over the roots of their sizes."""
    x = presence(np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))))
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1.0))


def fit(texts: list[bytes], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on texts in a given order; each language's first ``landmarks`` are landmarks."""
    names = sorted(set(langs))
    number = {lang: k for k, lang in enumerate(names)}
    y = np.array([number[lang] for lang in langs])
    chosen = np.concatenate([np.flatnonzero(y == k)[:landmarks] for k in range(len(names))])
    marks = _scaled([texts[i] for i in chosen])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(float))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])  # Nystrom map: kernel values times this
    # Every language weighs the same, however many texts it has.
    weight = 1.0 / np.bincount(y, minlength=len(names))[y]
    left, right = ridge * np.eye(root.shape[1]), np.zeros((root.shape[1], len(names)))
    for a in range(0, len(texts), FIT_ROWS):
        part = slice(a, a + FIT_ROWS)
        z = (_scaled(texts[part]) @ marks.T) @ root
        zw = z * weight[part, None]
        left += zw.T @ z
        right += zw.T @ np.where(y[part, None] == np.arange(len(names)), 1.0, -1.0)
    beta = np.linalg.solve(left, right)
    return Model(names, marks.T @ (root @ beta).astype(np.float32))


def shares(langs: int) -> tuple[int, int, int]:
    """Texts, characters of each and landmarks that a language has among ``langs``."""
    texts = max(8, min(PER_LANG, MOST_TEXTS // max(1, langs)))
    chars = max(200, min(MAX_CHARS, MOST_CHARS // (max(1, langs) * texts)))
    return texts, chars, max(1, min(LANDMARKS, MOST_LANDMARKS // max(1, langs)))


def training_sample(docs: DataFrame, usable: Column, per_lang: int | None = None) -> list[tuple[bytes, str]]:
    """Texts and languages of the sample, in a fixed order: ``per_lang`` for every language, its share if not given.

    The ids are chosen on slim rows (``row_number`` with a limit keeps only the
    first rows of each language before the shuffle); their texts are fetched after.
    """
    held = docs.where(usable & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") >= 1))
    texts, chars, _ = shares(held.select("lang").distinct().count())
    per_lang = texts if per_lang is None else per_lang
    held = held.select("doc_id", "lang", "text", (F.length("text") > chars).alias("long"))
    order = Window.partitionBy("lang").orderBy("long", F.xxhash64("doc_id"), "doc_id")
    ranked = held.drop("text").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
    rows = held.join(F.broadcast(ranked.drop("rank").distinct()), ["doc_id", "lang", "long"], "left_semi")
    rows = rows.select("doc_id", "lang", F.substring("text", 1, chars).alias("text"))
    # An id may stand in several rows; the sample stays bounded and in a fixed order.
    found = sorted(rows.dropDuplicates(["doc_id", "lang"]).collect(), key=lambda r: (r["doc_id"], r["lang"]))
    return [(r["text"].encode(), r["lang"]) for r in found]


def train(docs: DataFrame, usable: Column) -> Model | None:
    sample = training_sample(docs, usable)
    if not sample:
        return None
    langs = [lang for _, lang in sample]
    return fit([t for t, _ in sample], langs, shares(len(set(langs)))[2])


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = batch.column(1)
            lang, score = [UNKNOWN] * len(column), np.zeros(len(column))
            letters = np.array([bool(t.is_valid and _LETTER.search(t.as_py())) for t in column], bool)
            data, limits = text_buffer(column)
            for lo, hi in steps(limits, 1 << 18) if own is not None else ():
                for a in range(lo, hi, ROWS):
                    b = min(hi, a + ROWS)
                    best, odds = own.predict(presence(data, limits[a : b + 1]))
                    for i in np.flatnonzero(letters[a:b]):
                        lang[a + i], score[a + i] = own.langs[best[i]], min(1.0, float(odds[i]))
            columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return slim.mapInArrow(predict, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows that are not held out and classify all: adds ``held_out``."""
    model = train(docs, ~held_out())
    return classify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
