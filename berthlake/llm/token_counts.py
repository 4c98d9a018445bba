"""Token counts of a piece tokenizer, with huge documents encoded in overlapping chunks.

A document up to ``chunk`` bytes is encoded as a whole. A longer one is cut into chunks of ``chunk`` code points, each of
which reaches ``overlap`` code points into the next one; chunks are dealt out to tasks and encoded on their own. The tokens of two
following chunks are spliced inside their overlap, at a place p where both have the same token from p to q.

Why the splice is exact: merges go by score, then by place, and no merge crosses a boundary that stands at the end. So if
the left chunk ends a token T at p and starts T' there, the pieces left and right of p develop as they would alone, and
in the left chunk no merge of T's pieces with those of T' ever came first. In the whole text, the pieces left of p end with
the same T and those right of p, as the right chunk shows, begin with the same T'; their merges come in the same
order, so none crosses p there either. By induction over the chunks the spliced tokens are those of the whole text.
A chunk that begins inside the text is given a blank by the tokenizer; that is another left neighbour, before the splice.

Where an overlap has no common token, the document goes through the next round with chunks and overlap four times as
wide, at last as one chunk. Equal long texts are encoded once.

The tokenizer must keep its text (no normalisation but the blank's own sign), which is checked for every chunk.

Edge cases: null and empty texts have no tokens; repeated rows get their counts; empty tables give no rows; the input row
is handed on as a struct, so its names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from berthlake.llm import arrays
from berthlake.llm.storage import stored

CHUNK = 1 << 15
OVERLAP = 256
WIDER = 4
LIMIT = 4096


@lru_cache(maxsize=2)
def pieces(path: str):
    """The tokenizer, and the number of code points of each id; of a character in bytes, the first byte has it."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    if not model.encode("a b") == model.encode("a") + model.encode("b"):
        raise ValueError("the tokenizer does not begin a text as it begins a word")
    ids = range(model.get_piece_size())
    lengths = [len(model.id_to_piece(k)) for k in ids]
    for k in ids:
        if model.is_byte(k):
            lengths[k] = int(int(model.id_to_piece(k)[1:-1], 16) & 0xC0 != 0x80)
    return model, np.array(lengths, np.int64)


def whole(path: str):
    """Batches of (row, text): the tokens of each text, copies in a slice encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = pieces(path)
        for batch in batches:
            for first, end, _, _ in arrays.slices(batch.column(1)):
                part = batch.slice(first, end - first)
                texts = part.column(1).to_pylist()
                kinds = list(dict.fromkeys(texts))
                counts = dict(zip(kinds, map(len, model.encode(kinds, num_threads=1))))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([counts[t] for t in texts], pa.int64())], names=["_row", "n_tokens"])

    return run


def cut(chunk: int, overlap: int):
    """Batches of (key, text): the chunks of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                chunks = max(1, -(-(len(text) - overlap) // chunk))
                for first in range(0, chunks, 64):
                    own = range(first, min(first + 64, chunks))
                    parts = [text[i * chunk: (i + 1) * chunk + overlap] if i < chunks - 1 else text[i * chunk:] for i in own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()] * len(own), pa.string()), pa.array(own, pa.int64()),
                         pa.array([chunks] * len(own), pa.int64()), pa.array(parts, pa.string())], names=["key", "i", "chunks", "part"])

    return run


def encoded(path: str, chunk: int, overlap: int):
    """Batches of (key, i, chunks, part): tokens of a chunk, and its tokens inside the overlaps at both ends.

    A token is (from, to, lost): its places in the overlap, and the tokens of this chunk that go if it is spliced there.
    """
    tokens = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("lost", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lengths = pieces(path)

        def inside(ends: np.ndarray, sizes: np.ndarray, low: int, head: bool) -> list[dict]:
            starts = ends - sizes
            at = np.flatnonzero((sizes > 0) & (starts >= low) & (ends <= low + overlap))
            lost = at if head else len(ends) - at
            return [{"p": p, "q": q, "lost": k} for p, q, k in zip((starts[at] - low).tolist(), (ends[at] - low).tolist(), lost.tolist())]

        for batch in batches:
            counts, heads, tails = [], [], []
            for i, chunks, part in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                sizes = lengths[np.array(model.encode(part), np.int64)]
                ends = np.cumsum(sizes) - 1  # the blank in front has no place in the text
                if len(part) and ends[-1] != len(part):
                    raise ValueError("the tokenizer changes its text, so its tokens have no places")
                counts.append(len(sizes))
                heads.append(inside(ends, sizes, 0, True) if i else [])
                tails.append(inside(ends, sizes, chunk, False) if i < chunks - 1 else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(counts, pa.int64()), pa.array(heads, tokens), pa.array(tails, tokens)],
                names=["key", "i", "chunks", "n", "head", "tail"])

    return run


def spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of texts (key, text); null where two following chunks have no common token."""
    parts = texts.mapInArrow(cut(chunk, overlap), "key string, i bigint, chunks bigint, part string").dropDuplicates(["key", "i"])
    token = "array<struct<p:int,q:int,lost:int>>"
    done = stored(parts.mapInArrow(
        encoded(path, chunk, overlap), f"key string, i bigint, chunks bigint, n bigint, head {token}, tail {token}"), "chunks")
    left = done.select("key", (F.col("i") + 1).alias("i"), F.inline("tail")).withColumnRenamed("lost", "after")
    right = done.select("key", "i", F.inline("head")).withColumnRenamed("lost", "before")
    splices = left.join(right, ["key", "i", "p", "q"]).groupBy("key", "i").agg(
        F.min(F.struct("p", (F.col("after") + F.col("before")).alias("lost"))).alias("s"))
    splices = splices.groupBy("key").agg(F.sum("s.lost").alias("lost"), F.count(F.lit(1)).alias("splices"))
    sums = done.groupBy("key").agg(F.sum("n").alias("n"), F.max("chunks").alias("chunks"))
    found = F.coalesce("splices", F.lit(0)) == F.col("chunks") - 1
    return sums.join(splices, "key", "left").select(
        "key", F.when(found, F.col("n") - F.coalesce("lost", F.lit(0))).alias("n_tokens"))


def long_counts(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of long texts: rounds of wider chunks until every text is spliced."""
    out = None
    while True:
        counts = stored(spliced(texts, path, chunk, overlap), "counts")
        known = counts.filter(F.col("n_tokens").isNotNull())
        out = known if out is None else out.unionByName(known)
        open_ = counts.filter(F.col("n_tokens").isNull()).select("key")
        if open_.isEmpty():
            return out
        texts = texts.join(open_, "key", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def count(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, limit: int = LIMIT,
          chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``) with ``n_tokens`` and ``over_limit``."""
    if not 0 < overlap <= chunk:
        raise ValueError("an overlap is at most as long as a chunk")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*(keep or ["*"])).alias("_row"), body.alias("text"))
    short = rows.filter(F.octet_length("text") <= chunk)
    schema = T.StructType([rows.schema["_row"], T.StructField("n_tokens", T.LongType())])
    long = rows.filter(F.octet_length("text") > chunk).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    found = long_counts(long.select("key", "text"), path, chunk, overlap)
    both = short.mapInArrow(whole(path), schema).unionByName(long.select("_row", "key").join(found, "key").select("_row", "n_tokens"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
