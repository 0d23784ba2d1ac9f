"""Fill-in-middle transformation: texts cut into prefix, middle and suffix, and put in another order.

A pyarrow.compute pipeline on every batch: units (code points) of the texts become list arrays,
are flattened with the index of their text, numbered within it, filtered by
role (before, between, after the two cuts), built into lists again and joined to one
piece a role. Pieces and markers are then joined element by element to the output.
The step is narrow: no row leaves its task. A text over ``STEP_BYTES`` goes through in segments of whole
code points, whose pieces are joined to the text's pieces by a second list array.

Cuts and form come from the sha256 of ``1:`` and the id, so every run gives the same rows. A text
that is empty or holds a marker stays plain, and so does a fixed share of all others.
Markers cannot arise at a seam, as none begins inside another; ``restore`` therefore
rebuilds the exact text from output and form alone.

A null text is empty, a null id counts as the empty id; repeated rows give
repeated rows, an empty table gives none. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.llm.common import STEP_BYTES, steps, text_buffer

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts, so many are cut; of 100 cut ones, so many have the suffix first.
CUT_SHARE, SUFFIX_FIRST_SHARE = 90, 20


def forms(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n, form, first, second``: length in code points, form and cuts of each text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit(""))), 256)
    slim = docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.char_length(text).cast("bigint").alias("n"), told.alias("told"))
    h = [F.conv(F.substring("told", 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]
    cuts = [h[k] % (F.col("n") + 1) for k in (0, 1)]
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("n") == 0) | marked | (h[2] % 100 >= CUT_SHARE)
    form = F.when(plain, "plain").when(h[3] % 100 < SUFFIX_FIRST_SHARE, "spm").otherwise("psm")
    return slim.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("second"))


def _segments(limits: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte limits of segments of at most about STEP_BYTES, between code points, and the first segment of each text."""
    edges, firsts = [0], [0]
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
        at = a + STEP_BYTES
        while at < b:
            while at < b and data[at] & 0xC0 == 0x80:
                at += 1
            edges.append(at)
            at += STEP_BYTES
        edges.append(b)
        firsts.append(len(edges) - 1)
    return np.array(edges, np.int64), np.array(firsts, np.int64)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """Consecutive values as lists of the given lengths."""
    limits = np.concatenate(([0], np.cumsum(counts)))
    return pa.LargeListArray.from_arrays(pa.array(limits, pa.int64()), values)


def _units(data: np.ndarray, limits: np.ndarray) -> pa.Array:
    """Texts between ``limits`` as lists of their code points; no byte is copied."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    offsets = pa.array(np.append(starts, len(data)), pa.int64()).buffers()[1]
    flat = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(data))
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(starts, limits), pa.int64()), flat)


def _joined(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pc.binary_join(_lists(values, counts), pa.scalar("", pa.large_string()))


def pieces(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut after ``first`` and ``second`` code points."""
    data, limits = text_buffer(texts)
    edges, firsts = _segments(limits, data)
    of = np.repeat(np.arange(len(limits) - 1), np.diff(firsts))
    found: list[list[pa.Array]] = [[], [], []]
    gone = 0  # code points of the current text before this segment
    for lo, hi in steps(edges):
        begin, end = int(edges[lo]), int(edges[hi])
        units = _units(data[begin:end], edges[lo : hi + 1] - begin)
        flat, parent = pc.list_flatten(units), pc.list_parent_indices(units).to_numpy()
        sizes = pc.list_value_length(units).to_numpy()
        ordinal = np.arange(len(flat)) - units.offsets.to_numpy()[parent]
        # Segments of one text follow each other; each starts where the last one ended.
        own = of[lo:hi]
        before = np.cumsum(sizes) - sizes
        new = np.concatenate(([True], own[1:] != own[:-1]))
        at = np.maximum.accumulate(np.where(new, np.arange(len(own)), 0))
        base = before - before[at]
        if lo and of[lo - 1] == own[0]:
            base[at == 0] += gone
        gone = int(base[-1] + sizes[-1])
        ordinal += base[parent]
        role = (ordinal >= first[own][parent]).astype(np.int8) + (ordinal >= second[own][parent])
        for k in range(3):
            mine = role == k
            counts = np.bincount(parent[mine], minlength=len(own))
            found[k].append(_joined(flat.filter(pa.array(mine)), counts))
    whole = [pa.concat_arrays(f) if f else pa.array([], pa.large_string()) for f in found]
    return [_joined(w, np.diff(firsts)) for w in whole]


def _join(*parts: pa.Array | str) -> pa.Array:
    parts = [pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts]
    return pc.binary_join_element_wise(*parts, pa.scalar("", pa.large_string()))


def _choose(form: pa.Array, **by_form: pa.Array) -> pa.Array:
    names = list(by_form)
    return pc.choose(pc.index_in(form, pa.array(names)), *by_form.values())


RESULT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    Lengths are null where the form is ``plain`` and the output the text itself.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            texts, form = batch.column("text").cast(pa.large_string()), batch.column("form").cast(pa.string())
            first, second = (batch.column(k).to_numpy() for k in ("first", "second"))
            prefix, middle, suffix = pieces(texts, first, second)
            output = _choose(
                form,
                plain=texts,
                psm=_join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
                spm=_join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
            )
            plain = pc.equal(form, "plain").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("n"), form, pa.array(first, pa.int64(), mask=plain),
                    pa.array(second - first, pa.int64(), mask=plain), output.cast(pa.string()),
                ],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return forms(docs).mapInArrow(cut, RESULT)


def restore(table: DataFrame) -> DataFrame:
    """Adds ``restored``, the text that ``output`` and ``form`` came from."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema) + ", restored string"

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            output, form = batch.column("output").cast(pa.large_string()), batch.column("form").cast(pa.string())
            cut = pc.not_equal(form, "plain")
            # A cut output is '', piece, piece, middle when split at its three markers.
            parts = pc.split_pattern_regex(pc.if_else(cut, output, PREFIX + SUFFIX + MIDDLE), "<[PSM]>")
            one, two, middle = (pc.list_element(parts, k) for k in (1, 2, 3))
            text = _choose(form, plain=output, psm=_join(one, middle, two), spm=_join(two, middle, one))
            yield pa.RecordBatch.from_arrays([*batch.columns, text.cast(pa.string())], names=[*batch.schema.names, "restored"])

    return table.mapInArrow(back, schema)
