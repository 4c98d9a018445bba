"""Quality rules: counted base rules, and a calibrated logistic regression on hashed word and character n-grams.

Features are the relative frequencies of hashed words, word pairs and character four-grams, so a text's score
does not depend on its length. The model is fitted on a bounded sample of labelled rows, calibrated by Platt's
method on the part it was not fitted on, and scored in Arrow batches against a fixed threshold.

Edge cases: null and empty texts have no words and fail the base rules; repeated rows each get their result; without
labels of both kinds the model keeps everything; an empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from berthlake.llm import arrays

SAMPLE_ROWS = 3000       # labelled rows that the model is fitted and calibrated on, at most
SAMPLE_BYTES = 64 << 20  # bytes of their texts, at most: 3000 mean texts many times over
TABLE_BITS = 16          # size of each hash table
KEEP = 0.35              # calibrated probability of good quality from which a text is kept
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80  # of a code point

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class Model(NamedTuple):
    weights: np.ndarray   # 3 tables after one another
    bias: float
    slope: float          # Platt's method: probability = 1 / (1 + exp(-(slope * margin + shift)))
    shift: float


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of runs; empty runs give 0."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where the same hash occurs again within its text."""
    keyed = arrays.mix(hashes + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(keyed)
    same = keyed[order][1:] == keyed[order][:-1]
    out = np.zeros(len(keyed), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray, found: arrays.Words, hashes: np.ndarray, sums: np.ndarray) -> dict:
    texts = len(offsets) - 1
    letters = arrays.NOT_BLANK[data] & FIRST_BYTE[data]
    # words inside three-word windows that occur again
    grams, inside = arrays.window_hashes(hashes, 3), arrays.window_mask(found.bounds, 3)
    owner = np.repeat(np.arange(texts), np.diff(found.bounds))
    again = np.zeros(len(hashes), bool)
    at = np.flatnonzero(inside)
    if len(at):
        at = at[repeated(grams[at], owner[at])]
        for k in range(3):
            again[at + k] = True
    # lines with a word that equal an earlier line of their text
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))
    ends = ends - ((ends > starts) & (data[ends - 1] == 0x0A)) if len(starts) else ends
    filled = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends = starts[filled], ends[filled]
    line_owner = np.searchsorted(offsets, starts, "right") - 1
    keyed = arrays.mix(arrays.span_hashes(sums, starts, ends) + line_owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, firsts = np.unique(keyed, return_index=True)
    later = np.ones(len(starts), bool)
    later[firsts] = False
    return {
        "n_words": np.diff(found.bounds).astype(np.int64),
        "word_chars": per_text(letters, offsets),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_owner[later], minlength=texts).astype(np.int64),
        "n_repeat_words": per_text(again, found.bounds),
    }


def feature_slots(data: np.ndarray, offsets: np.ndarray, found: arrays.Words, hashes: np.ndarray):
    """Per table: the slot of every occurrence, and the occurrences' bounds per text."""
    mask = np.uint64((1 << TABLE_BITS) - 1)
    yield (hashes & mask).astype(np.int64), found.bounds
    pairs, inside = arrays.window_hashes(hashes, 2), arrays.window_mask(found.bounds, 2)
    at = np.flatnonzero(inside)
    yield (pairs[at] & mask).astype(np.int64) + (1 << TABLE_BITS), np.searchsorted(at, found.bounds)
    if len(data) < 4:
        yield np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        return
    # byte four-grams; those over a text's end fall to the text they begin in
    codes = data.astype(np.uint32)
    codes = codes[:-3] | (codes[1:-2] << 8) | (codes[2:-1] << 16) | (codes[3:] << 24)
    slots = ((codes * np.uint32(2654435769)) >> np.uint32(32 - TABLE_BITS)).astype(np.int64)
    keep = np.ones(len(codes), bool)
    for k in range(3):
        at = offsets[1:-1] - 1 - k
        keep[at[(at >= 0) & (at < len(keep))]] = False
    at = np.flatnonzero(keep)
    yield slots[at] + (2 << TABLE_BITS), np.searchsorted(at, offsets)


def margins(model: Model, data: np.ndarray, offsets: np.ndarray, found: arrays.Words, hashes: np.ndarray) -> np.ndarray:
    total = np.full(len(offsets) - 1, model.bias)
    for slots, bounds in feature_slots(data, offsets, found, hashes):
        total += per_text(model.weights[slots], bounds) / np.maximum(np.diff(bounds), 1)
    return total


def probability(model: Model, margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(model.slope * margin + model.shift, -500, 500)))


def usable_labels(labels: DataFrame, label: str, among: Column | None = None) -> DataFrame:
    """(_id, _label): one label, 0 or 1, per document, the larger if there are several; only of rows that may be learned from."""
    ids = labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_label"))
    ids = ids.filter(F.col("_label").isin(0, 1) & F.col("_id").isNotNull())
    if among is not None:
        ids = ids.filter(among)
    return ids.groupBy("_id").agg(F.max("_label").alias("_label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, value: int | None = None, among: Column | None = None,
                    rows: int = SAMPLE_ROWS) -> pa.Table:
    """At most ``rows`` labelled (text, label) rows and SAMPLE_BYTES bytes: those with the lowest digests of their ids."""
    ids = usable_labels(labels, label, among)
    if value is not None:
        ids = ids.filter(F.col("_label") == value)
    ids = ids.withColumn("_order", F.md5(F.col("_id").cast("string"))).orderBy("_order", "_id").limit(rows)
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    # the right side has ``rows`` rows at most, so it may be sent to all tasks; texts of one id beyond one count once
    found = texts.join(F.broadcast(ids), "_id").groupBy("_id", "_label", "_order").agg(F.min("text").alias("text"))
    size = F.sum(F.octet_length("text")).over(Window.orderBy("_order", "_id"))
    found = found.withColumn("_sum", size).filter(F.col("_sum") <= SAMPLE_BYTES).orderBy("_order", "_id")
    return found.select("text", F.col("_label").alias("label")).toArrow().combine_chunks()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample: three quarters for the weights, one quarter for the calibration."""
    sample = labelled_sample(docs, labels, "quality")
    y = np.array(sample["label"].to_pylist(), np.float64)
    empty = Model(np.zeros(3 << TABLE_BITS, np.float32), 0.0, 0.0, 20.0)
    if len(y) < 20 or y.min() == y.max():
        return empty
    texts = arrays.one_chunk(sample["text"])
    cells = []  # per slice of texts: (row, slot, value) of each filled cell, in narrow types
    for first, end, data, offsets in arrays.slices(texts):
        data = arrays.LOWER[data]
        found = arrays.words(data, offsets, arrays.NOT_BLANK)
        hashes = arrays.word_hashes(data, found)
        for slots, bounds in feature_slots(data, offsets, found, hashes):
            n = np.diff(bounds)
            owner = np.repeat(np.arange(first, end), n)
            at, counts = np.unique(owner * (3 << TABLE_BITS) + slots, return_counts=True)
            row, slot = np.divmod(at, 3 << TABLE_BITS)
            cells.append((row.astype(np.int32), slot.astype(np.int32), (counts / n[row - first]).astype(np.float32)))
    fitted = np.arange(len(y)) % 4 != 3
    weights, bias = logistic(cells, y, fitted)
    margin = sample_margins(cells, weights, bias, len(y))
    slope, shift = platt(margin[~fitted], y[~fitted]) if len(set(y[~fitted])) == 2 else (1.0, 0.0)
    del sample, texts, cells, data, offsets, found, hashes, slots, bounds, n, owner, at, counts, row, slot
    give_back()
    return Model(weights.astype(np.float32), float(bias), slope, shift)


def give_back() -> None:
    """Hand freed memory back to the system, where the C library can: the fit's cells would stay beside the driver for good."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def sample_margins(cells: list, weights: np.ndarray, bias: float, rows: int) -> np.ndarray:
    margin = np.full(rows, bias)
    for row, slot, value in cells:
        if len(row):
            low = int(row[0])  # rows ascend
            part = np.bincount(row - low, weights[slot] * value)
            margin[low: low + len(part)] += part
    return margin


def logistic(cells: list, y: np.ndarray, used: np.ndarray, rounds: int = 120, rate: float = 0.5, ridge: float = 1e-6):
    """Full-batch AdaGrad on sparse rows, slice by slice; both classes weigh the same."""
    weights, bias = np.zeros(3 << TABLE_BITS), 0.0
    squares, bias_square = np.full(3 << TABLE_BITS, 1e-8), 1e-8
    share = np.where(y == 1, 0.5 / max(1, (used & (y == 1)).sum()), 0.5 / max(1, (used & (y == 0)).sum())) * used
    for _ in range(rounds):
        margin = sample_margins(cells, weights, bias, len(y))
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y) * share
        step = ridge * weights
        for row, slot, value in cells:
            step += np.bincount(slot, error[row] * value, len(weights))
        squares += step * step
        weights -= rate * step / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias -= rate * 0.1 * error.sum() / np.sqrt(bias_square)
    return weights, bias


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps on (slope, shift), with Platt's smoothed targets."""
    up, down = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    scale = margin.std() or 1.0
    x, at = np.stack([margin / scale, np.ones(len(y))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -50, 50)))
        gradient = x @ (p - target) + 1e-3 * at
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(hessian, gradient)
    return float(at[0] / scale), float(at[1])


def judge_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in arrays.slices(batch.column(0)):
                found = arrays.words(data, offsets, arrays.NOT_BLANK)
                sums = arrays.prefix_sums(data)
                hashes = arrays.span_hashes(sums, found.starts, found.ends)
                counts = base_counts(data, offsets, found, hashes, sums)
                low = arrays.LOWER[data]
                score = probability(model, margins(model, low, offsets, found, arrays.word_hashes(low, found)))
                failed = (counts["n_words"] < MIN_WORDS) | (
                    100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, end - first).columns[1:], *(pa.array(counts[c], pa.int64()) for c in COUNTS),
                     pa.array(score), pa.array(failed), pa.array(~failed & (score >= KEEP))],
                    names=[*batch.schema.names[1:], *COUNTS, "quality_score", "base_failed", "kept"])

    return run


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, model: Model | None = None) -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``) with counts, ``quality_score``, ``base_failed``, ``kept``."""
    model = model or fit(docs, labels)
    row = F.struct(*(keep or ["*"]))
    picked = docs.select(F.coalesce("text", F.lit("")).alias("_text"), row.alias("_row"))
    schema = T.StructType([picked.schema["_row"], *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("quality_score", T.DoubleType()), T.StructField("base_failed", T.BooleanType()),
                           T.StructField("kept", T.BooleanType())])
    return picked.mapInArrow(judge_batches(model), schema)


def kept_docs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, labels).filter("kept").select("_row.*")
