"""Toxic spans and documents by a linear-chain conditional random field.

The field tags each word as toxic or not from the word itself, its beginnings and its two neighbours (hashed), and from the
tag before. Only documents are labelled, so words get their training tags from them: words that stand in many toxic
documents and in hardly any clean one (copies counted once), or whose beginning does, are tagged where they stand in a
toxic document; all others are not toxic. The field is fitted to these tags by its exact gradient, on a bounded sample.

Forward-backward marginals give the chance of each word to be toxic. Their sum and their maximum are
calibrated into a score for the document; words above one half are the offending spans.

Edge cases: null and empty texts have no words and the score of a text without toxic words; without labels of both kinds
all scores are 0; repeated rows each get their result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from berthlake.llm import arrays
from berthlake.llm.quality import FIRST_BYTE, labelled_sample, per_text, usable_labels

SAMPLE_PER_LABEL = 1500  # labelled documents of each kind that words are counted in, at most
FIELD_PER_LABEL = 300    # of these, documents that the field is fitted on
LEXICON_SHARE = 0.015    # of the toxic documents that a telling word or beginning stands in, at least
TABLE_BITS = 17
TABLES = 5
BEGINNINGS = (5, 7)      # bytes of a word
ROUNDS = 45


class Model(NamedTuple):
    tables: np.ndarray    # 5 x 2**TABLE_BITS: the word, its two beginnings, the word before, the word after
    bias: float
    jumps: np.ndarray     # 2 x 2 log weights from tag to tag
    score: np.ndarray     # calibration: constant, log of the expected toxic words, highest marginal


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, arrays.Words]:
    """Hashes of each word and of its beginnings (one row each)."""
    low = arrays.LOWER[data]
    found = arrays.words(low, offsets, arrays.LETTERS)
    sums = arrays.prefix_sums(low)
    rows = [arrays.span_hashes(sums, found.starts, found.ends)]
    for n in BEGINNINGS:
        rows.append(arrays.mix(arrays.span_hashes(sums, found.starts, np.minimum(found.starts + n, found.ends)) + np.uint64(n)))
    return np.stack(rows), found


def slots(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Table slots of each word, its beginnings and its neighbours; 0 stands for no neighbour."""
    own = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    before, after = np.roll(own[0], 1), np.roll(own[0], -1)
    inner = bounds[(bounds > 0) & (bounds < len(before))]
    before[inner], after[inner - 1] = 0, 0
    if len(before):
        before[0] = after[-1] = 0
    return np.concatenate([own, before[None], after[None]])


def emissions(model: Model, at: np.ndarray) -> np.ndarray:
    out = np.full(at.shape[1], model.bias)
    for k, row in enumerate(at):
        out += model.tables[(k << TABLE_BITS) + row]
    return out


def chains(emission: np.ndarray, bounds: np.ndarray, jumps: np.ndarray, pairs: bool = False):
    """Marginals of tag 1 for all words; with ``pairs`` also the expected number of each step from tag to tag.

    Texts of like length go side by side, so a step of the recursion serves many texts.
    """
    weight = np.exp(np.clip(emission, -30, 30))
    a = np.exp(jumps)
    out = np.zeros(len(weight))
    expected = np.zeros((2, 2))
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    while len(order):
        longest = lengths[order[0]]
        many = int(np.searchsorted(-lengths[order], -(longest // 2), "right"))
        many = max(1, min(many, (1 << 21) // int(longest) + 1))
        group, order = order[:many], order[many:]
        size = lengths[group]
        column = np.repeat(np.arange(many), size)
        row = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        flat = np.repeat(bounds[group], size) + row
        e = np.ones((longest, many))
        e[row, column] = weight[flat]
        live = np.searchsorted(-size, -np.arange(longest), "left")  # texts longer than t
        r, q = np.empty_like(e), np.ones_like(e)
        r[0] = e[0]
        for t in range(1, longest):
            k = live[t]
            p = r[t - 1, :k]
            r[t, :k] = e[t, :k] * (a[0, 1] + p * a[1, 1]) / (a[0, 0] + p * a[1, 0])
        for t in range(longest - 2, -1, -1):
            k = live[t + 1]
            n = e[t + 1, :k] * q[t + 1, :k]
            q[t, :k] = (a[1, 0] + a[1, 1] * n) / (a[0, 0] + a[0, 1] * n)
        both = r[row, column] * q[row, column]
        out[flat] = both / (1 + both)
        if pairs:
            step = row < np.repeat(size, size) - 1
            left = r[row[step], column[step]]
            right = e[row[step] + 1, column[step]] * q[row[step] + 1, column[step]]
            cells = np.stack([np.full_like(left, a[0, 0]), a[0, 1] * right, a[1, 0] * left, a[1, 1] * left * right])
            expected += (cells / cells.sum(0)).sum(1).reshape(2, 2)
    return (out, expected) if pairs else out


def without_copies(texts: pa.Array) -> np.ndarray:
    """Numbers of texts that are no near copies of earlier ones: no equal lowest shingle hash under four mixings."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for first, end, data, offsets in arrays.slices(texts):
        for i, members in enumerate(arrays.shingle_sets(data, offsets)):
            marks = {(k, int(arrays.mix(members + np.uint64(k)).min())) for k in range(4)} if len(members) else {(9, 0)}
            if not marks & seen:
                kept.append(first + i)
            seen |= marks
    return np.array(kept, np.int64)


def telling_words(words: np.ndarray, owner: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Hashes of words that stand in many toxic documents and in few clean ones."""
    kinds, word = np.unique(words, return_inverse=True)
    cells = np.unique(word.astype(np.int64) * len(toxic) + owner)
    word, owner = cells // len(toxic), cells % len(toxic)
    clean = np.bincount(word[~toxic[owner]], minlength=len(kinds))
    bad = np.bincount(word[toxic[owner]], minlength=len(kinds))
    enough = bad >= max(6.0, LEXICON_SHARE * toxic.sum())
    return kinds[enough & (bad / max(1, toxic.sum()) > 6 * clean / max(1, (~toxic).sum()))]


def fit(docs: DataFrame, labels: DataFrame, among: Column | None = None) -> Model:
    """``among`` says which rows of the labels (id in ``_id``) may be learned from."""
    parts = [labelled_sample(docs, labels, "toxic", v, among, SAMPLE_PER_LABEL) for v in (1, 0)]
    none = Model(np.zeros(TABLES << TABLE_BITS, np.float32), 0.0, np.zeros((2, 2)), np.array([-30.0, 0, 0]))
    if not all(len(p) for p in parts):
        return none
    kept = []
    for p in parts:  # copies would count their words as often as there are copies
        texts = arrays.one_chunk(p["text"])
        kept.append(texts.take(pa.array(without_copies(texts))))
    toxic = np.repeat([True, False], [len(k) for k in kept])
    # toxic and clean documents in turn, so that any leading part has both
    turn = np.argsort(np.concatenate([np.arange(len(k)) / len(k) for k in kept]), kind="stable")
    texts, toxic = pa.concat_arrays(kept).take(pa.array(turn)), toxic[turn]
    data, offsets = arrays.buffer(texts)
    hashes, found = tokens(data, offsets)
    owner = np.repeat(np.arange(len(toxic)), np.diff(found.bounds))
    tag = np.zeros(len(owner), bool)
    for units in hashes:
        tag |= np.isin(units, telling_words(units, owner, toxic)) & toxic[owner]
    number = np.where(toxic, np.cumsum(toxic), np.cumsum(~toxic))
    used = number <= np.minimum(FIELD_PER_LABEL, np.where(toxic, toxic.sum(), (~toxic).sum()) * 3 // 4)
    mine = np.flatnonzero(used[owner])
    bounds = np.concatenate([[0], np.cumsum(np.diff(found.bounds)[used])])
    model = field(slots(hashes[:, mine], bounds), bounds, tag[mine])
    marginal = chains(emissions(model, slots(hashes, found.bounds)), found.bounds, model.jumps)
    x = evidence(marginal, found.bounds)
    prior = usable_labels(labels, "toxic", among).agg(F.avg("_label")).first()[0]
    weight = np.where(toxic, prior / max(1, toxic.sum()), (1 - prior) / max(1, (~toxic).sum())) * len(toxic)
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.diag([1e-3, 1e-2, 1e-2])
        w -= np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (p - toxic)) + ridge @ w)
    return model._replace(score=w)


def field(at: np.ndarray, bounds: np.ndarray, tag: np.ndarray) -> Model:
    """AdaGrad on the exact gradient of the chains' log likelihood, with a ridge."""
    size = 1 << TABLE_BITS
    model = Model(np.zeros(TABLES * size), -2.0, np.zeros((2, 2)), np.zeros(3))
    starts = np.zeros(len(tag) + 1, bool)
    starts[bounds] = True
    step = ~starts[1: len(tag)]
    seen = np.zeros((2, 2))
    np.add.at(seen, (tag[:-1][step].astype(int), tag[1:][step].astype(int)), 1)
    squares, jump_squares, bias_square = np.full(TABLES * size, 1e-6), np.full((2, 2), 1e-6), 1e-6
    for _ in range(ROUNDS):
        marginal, expected = chains(emissions(model, at), bounds, model.jumps, pairs=True)
        error = tag - marginal
        up = np.concatenate([np.bincount(a, weights=error, minlength=size) for a in at]) - 0.002 * model.tables
        squares += up * up
        tables = model.tables + 2.5 * up / np.sqrt(squares)
        jump = seen - expected - 0.002 * model.jumps
        jump_squares += jump * jump
        bias_square += error.sum() ** 2
        model = model._replace(
            tables=tables, jumps=model.jumps + 0.3 * jump / np.sqrt(jump_squares), bias=model.bias + 0.3 * error.sum() / np.sqrt(bias_square))
    return model._replace(tables=model.tables.astype(np.float32))


def evidence(marginal: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: 1, log of the expected toxic words, highest marginal."""
    n = np.diff(bounds)
    total = per_text(marginal, bounds)
    highest = np.zeros(len(n))
    if len(marginal):
        filled = n > 0
        highest[filled] = np.maximum.reduceat(marginal, bounds[:-1][filled])
    return np.stack([np.ones(len(n)), np.log(np.maximum(total, 0) + 0.2), highest], axis=1)


def tag_batches(model: Model, spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in arrays.slices(batch.column(0), 4 * arrays.SLICE_BYTES):
                hashes, found = tokens(data, offsets)
                marginal = chains(emissions(model, slots(hashes, found.bounds)), found.bounds, model.jumps)
                score = 1 / (1 + np.exp(-np.clip(evidence(marginal, found.bounds) @ model.score, -50, 50)))
                columns = [batch.column(1).slice(first, end - first), pa.array(score)]
                names = ["_row", "toxicity"]
                hit = np.flatnonzero(marginal >= 0.5)
                owner = np.searchsorted(found.bounds, hit, "right") - 1
                columns.append(pa.array(np.bincount(owner, minlength=end - first).astype(np.int64)))
                names.append("n_toxic_words")
                if spans:
                    points = np.concatenate([[0], np.cumsum(FIRST_BYTE[data])])
                    base = points[offsets[owner]]
                    rows: list[list] = [[] for _ in range(end - first)]
                    for o, a, b, p in zip(owner.tolist(), (points[found.starts[hit]] - base).tolist(),
                                          (points[found.ends[hit]] - base).tolist(), marginal[hit].tolist()):
                        rows[o].append({"start": a, "end": b, "chance": p})
                    columns.append(pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))))
                    names.append("toxic_spans")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def tag(docs: DataFrame, labels: DataFrame | None = None, model: Model | None = None, among: Column | None = None,
        keep: list[str] | None = None, spans: bool = True) -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``) with ``toxicity`` (0 to 1), ``n_toxic_words`` and, with
    ``spans``, ``toxic_spans`` (code points)."""
    model = model or fit(docs, labels, among)
    picked = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.struct(*(keep or ["*"])).alias("_row"))
    schema = T.StructType([picked.schema["_row"], T.StructField("toxicity", T.DoubleType()), T.StructField("n_toxic_words", T.LongType())])
    if spans:
        span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("chance", T.DoubleType())])
        schema = schema.add("toxic_spans", T.ArrayType(span))
    return picked.mapInArrow(tag_batches(model, spans), schema)
