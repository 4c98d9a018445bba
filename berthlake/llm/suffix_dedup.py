"""Removal of long byte strings that occur elsewhere, with suffix arrays over shards of the corpus.

A string of ``size`` bytes is cut out wherever it occurs if it starts at two places or more, in one text or in two.

1. Every window of ``size`` bytes has an anchor: the gram of half as many bytes inside it with the lowest hash, the leftmost if
   it occurs twice. Equal windows have equal anchors at equal places, so they meet if rows are dealt out by anchor.
   Windows that follow each other and have the same anchor are one segment.
2. Anchors that occur once are done with. Segments of equal content are one unit with a count, and only one text per unit
   sends its bytes. An anchor with a single unit is a plain copy: all its windows repeat.
3. The units of all other anchors are put in blocks of bounded size. A suffix array by induced sorting with permuted common
   prefixes finds the windows of a block that start at two places. All windows of a unit hold its anchor, which stands there as a short
   sign: it need not be sorted again byte by byte.
4. An anchor whose units exceed a block (a passage that many texts share in different surroundings) is not dealt to a task. Its units
   are cut into pieces of fewer windows, whose anchor is all that the windows of a piece have in common: first ``PIECE`` windows, then
   one. Most pieces are alone then; the others go through steps 2 and 3 again.
5. Hits go back to the texts as byte intervals, and each text is cut once.

Memory of a task is bounded by two blocks; joins by anchor and by unit are salted, so no key is tied to one task.

Edge cases: null and empty texts have no bytes; a text shorter than ``size`` is never cut; a repeated row is a copy
like any other, so all its windows occur twice; an empty table gives no rows. What is kept may begin or end
inside a character, so it is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from berthlake.llm import arrays, suffixes
from berthlake.llm.storage import stored

SIZE = 400
BLOCK_BYTES = 1 << 20
TASK_BYTES = 4 << 20       # of units that a task sorts, on average
PIECE = 25                 # windows of a piece of a segment whose anchor has more than a block
SALTS = 8
STRETCH = 1 << 26          # windows of a text that are worked on at once
FILTER_BITS = 1 << 22
SIGN, SIGN_BYTES = 0xfe, 4  # starts the sign of an anchor, as no byte of UTF-8 is 0xfe; 21 bits of number follow
SEGMENT = "key bigint, at int, n int, anchor bigint, digest bigint, copies bigint"


def anchored(data: np.ndarray, offsets: np.ndarray, size: int):
    """Per segment: its text, first window, number of windows (text positions), anchor hash and content hash."""
    gram = max(size // 2, 1)
    span = size - gram + 1  # grams per window
    n = len(data)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    lengths = np.diff(offsets)
    if not (lengths >= size).any():
        return none
    sums = arrays.prefix_sums(data)
    grams = n - gram + 1
    hashes = arrays.span_hashes(sums, slice(0, grams), slice(gram, None))
    rows = -(-grams // span)
    padded = np.full(rows * span, np.iinfo(np.uint64).max, np.uint64)
    # 36 bits of hash above 28 bits of place: the lowest is the leftmost of the lowest grams
    packed = padded[:grams]
    packed[:] = hashes
    packed >>= np.uint64(28)
    packed <<= np.uint64(28)
    packed |= np.arange(grams, dtype=np.uint64)
    grid = padded.reshape(rows, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - size + 1
    lowest = np.minimum(behind[:windows], ahead[span - 1: span - 1 + windows])
    del padded, packed, grid, ahead, behind  # eight bytes for each of the text
    anchor_at = (lowest & np.uint64((1 << 28) - 1)).astype(np.int64)
    valid = np.zeros(windows + 1, np.int64)
    whole = lengths >= size
    np.add.at(valid, offsets[:-1][whole], 1)
    np.add.at(valid, offsets[1:][whole] - size + 1, -1)
    at = np.flatnonzero(np.cumsum(valid)[:-1])
    new = np.ones(len(at), bool)
    new[1:] = (anchor_at[at][1:] != anchor_at[at][:-1]) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    start = at[first]
    count = np.diff(np.append(first, len(at)))
    return (np.searchsorted(offsets, start, "right") - 1, start, count, hashes[anchor_at[start]],
            arrays.span_hashes(sums, start, start + count + size - 1))


def segment_rows(size: int):
    """Batches of (key, text): the segments of each text, copies within a batch as one row with a count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, index, copies = np.unique(batch.column(0).to_numpy(), return_index=True, return_counts=True)
            texts = batch.column(1).take(pa.array(index))
            for first, end, data, offsets in arrays.slices(texts):
                # more than one stretch only if the slice is a single text
                for base in range(0, max(len(data), 1), STRETCH) if end - first == 1 else (0,):
                    part = data[base: base + STRETCH + size - 1] if end - first == 1 else data
                    bounds = np.array([0, len(part)]) if end - first == 1 else offsets
                    owner, start, count, anchor, digest = anchored(part, bounds, size)
                    if not len(owner):
                        continue
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[first + owner]), pa.array((start - bounds[owner] + base).astype(np.int32)),
                         pa.array(count.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)),
                         pa.array(copies[first + owner].astype(np.int64))],
                        names=["key", "at", "n", "anchor", "digest", "copies"])

    return run


def cut_segments(size: int):
    """Batches of (text, parts): the wanted segments with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, parts = batch.column(0), batch.column(1)
            data, offsets = arrays.buffer(texts)
            for i, own in enumerate(parts.to_pylist()):
                raw = data[offsets[i]: offsets[i + 1]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[k] for p in own], t) for k, t in
                     (("anchor", pa.int64()), ("digest", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()))]
                    + [pa.array([raw[p["at"]: p["at"] + p["n"] + size - 1] for p in own], pa.binary())],
                    names=["anchor", "digest", "n", "copies", "body"])

    return run


def gram_place(sums: np.ndarray, anchor: int, size: int) -> int:
    """Place of a segment's anchor in it: the first gram with that hash, as every window of the segment holds it."""
    gram = max(size // 2, 1)
    at = np.arange(min(size, len(sums) - 1) - gram + 1)
    return int(np.flatnonzero(arrays.span_hashes(sums, at, at + gram).view(np.int64) == anchor)[0])


def cut_pieces(size: int, width: int):
    """Batches of (key, text, parts): the parts in pieces of up to ``width`` windows, at places counted from the part's start, each
    with the hash of what all windows of such a piece share as its anchor. Pieces keep to a grid that hangs on the part's anchor, so
    that equal windows are in equal columns of it; a piece of one window needs no grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            data, offsets = arrays.buffer(batch.column(1))
            for i, own in enumerate(parts):
                for p in own:
                    raw = data[offsets[i] + p["at"]: offsets[i] + p["at"] + p["n"] + size - 1]
                    sums = arrays.prefix_sums(raw)
                    windows = np.arange(p["n"])
                    # a window that starts d bytes before its anchor is in column d // width of the grid
                    place = 0 if width == 1 else gram_place(sums, p["anchor"], size)
                    column = (place - windows) // width
                    first = np.flatnonzero(np.diff(column, prepend=column[0] + 1))
                    end = np.append(first[1:], p["n"])
                    column = column[first]
                    shared = arrays.span_hashes(sums, place - column * width, place - (column + 1) * width + 1 + size)
                    if width > 1:
                        shared = arrays.mix(shared + column.astype(np.uint64))
                    digest = arrays.span_hashes(sums, first, end + size - 1)
                    k = len(first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([keys[i]] * k, pa.int64()), pa.array((p["at"] + first).astype(np.int32)),
                         pa.array((end - first).astype(np.int32)), pa.array(shared.view(np.int64)), pa.array(digest.view(np.int64)),
                         pa.array([p["copies"]] * k, pa.int64()), pa.array([p["anchor"]] * k, pa.int64()),
                         pa.array([p["digest"]] * k, pa.int64()), pa.array(first.astype(np.int32))],
                        names=["key", "at", "n", "anchor", "digest", "copies", "whole_anchor", "whole_digest", "whole_at"])

    return run


def folded(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, anchors: np.ndarray, gram: int):
    """The spans of ``data``, each with a byte after it, with the gram that is a span's anchor as a short sign, one for each anchor; and
    the spans' places in that. Every window of a unit holds the whole anchor, so windows are equal if they are equal in this form."""
    grams = len(data) - gram + 1
    hashes = arrays.span_hashes(arrays.prefix_sums(data), slice(0, grams), slice(gram, None)).view(np.int64)
    at = np.flatnonzero(hashes == np.repeat(anchors, ends - starts + 1)[:grams])
    at = at[np.searchsorted(at, starts)]  # the first in each span
    number = np.unique(anchors, return_inverse=True)[1]
    data = data.copy()
    data[at] = SIGN
    for k in range(1, SIGN_BYTES):
        data[at + k] = number >> 7 * (k - 1) & 127
    gone = np.zeros(len(data) + 1, np.int8)
    gone[at + SIGN_BYTES] = 1
    gone[at + gram] = -1
    return data[np.cumsum(gone[:-1]) == 0], starts - np.arange(len(starts)) * (gram - SIGN_BYTES)


def block_hits(units: list[tuple], size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, digests, firsts and ends of windows that start at two places, by the suffix array of all units of a block. The anchor is
    the hash of ``gram`` bytes that all windows of a unit have, or of something else if ``gram`` is 0."""
    anchors, digests, counts, copies = (np.array([u[k] for u in units]) for k in range(4))
    sizes = np.array([len(u[4]) for u in units])
    places = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\xff".join([u[4] for u in units] + [b""]), np.uint8)  # no byte of UTF-8 is 0xff
    window = size
    if gram > SIGN_BYTES:
        data, places = folded(data, places, places + sizes, anchors, gram)
        window = size - gram + SIGN_BYTES
    repeat = suffixes.repeated_starts(data, window)
    inside, again = np.zeros((2, len(data) + 1), np.int32)
    inside[places] = 1
    inside[places + counts] = -1
    again[places] = copies > 1  # all windows of a copy start elsewhere, too
    again[places + counts] = -(copies > 1).astype(np.int32)
    repeat = (repeat | (np.cumsum(again[:-1]) > 0)) & (np.cumsum(inside[:-1]) > 0)
    edge = np.flatnonzero(np.diff(repeat.astype(np.int8), prepend=0, append=0))
    first, end = edge[::2], edge[1::2]
    unit = np.searchsorted(places, first, "right") - 1
    return anchors[unit], digests[unit], first - places[unit], end - places[unit]


def shard_hits(size: int, gram: int):
    """Batches of units sorted by anchor: the windows that repeat, per unit. No anchor has more than a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given(units):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(block_hits(units, size, gram), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["anchor", "digest", "first", "end"])

        units, held, anchor = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if row[0] != anchor:
                    anchor = row[0]
                    if held >= BLOCK_BYTES:
                        yield given(units)
                        units, held = [], 0
                units.append(row)
                held += len(row[4]) + 1
        if units:
            yield given(units)

    return run


def cut_texts(size: int):
    """Batches of (row, text, hits): what is left of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.buffer(batch.column(1))
            kept, sizes, removed, spans = [], [], [], []
            for i, hits in enumerate(batch.column(2).to_pylist()):
                raw = data[offsets[i]: offsets[i + 1]].tobytes()
                parts, at, gone, runs = [], 0, 0, 0
                end = -1
                for h in sorted((h["at"], h["to"]) for h in hits or ()):
                    if h[0] > end:
                        parts.append(raw[max(end, 0): h[0]])
                        runs += 1
                        gone += h[1] - h[0]
                        end = h[1]
                    elif h[1] > end:
                        gone += h[1] - end
                        end = h[1]
                parts.append(raw[max(end, 0):])
                kept.append(b"".join(parts))
                sizes.append(len(raw))
                removed.append(gone)
                spans.append(runs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(kept, pa.binary())],
                names=["_row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def salted(many: DataFrame, few: DataFrame, on: list[str], spread: str) -> DataFrame:
    """Inner join in which the rows of one key go to ``SALTS`` tasks by their column ``spread``."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return many.withColumn("_salt", F.pmod(spread, F.lit(SALTS)).cast("int")).join(
        few.withColumn("_salt", salts), [*on, "_salt"]).drop("_salt")


def with_text(texts: DataFrame, units: DataFrame) -> DataFrame:
    """(key, text, parts): one text per key that stands for units, and these units."""
    parts = units.groupBy("s.key").agg(F.collect_list(F.struct(
        "anchor", "digest", F.col("s.n").alias("n"), F.col("s.at").alias("at"), "copies")).alias("parts"))
    parts = stored(parts, "parts")
    sources = thinned(texts, parts).filter("_maybe").select("key", "text").dropDuplicates(["key"])
    return sources.join(parts, "key").select("key", "text", "parts")


def unit_hits(rows: DataFrame, texts: DataFrame, size: int, widths: tuple[int, ...], gram: int) -> DataFrame:
    """(anchor, digest, first, end): the windows of each unit of the segments ``rows`` that start at two places. For ``gram`` see
    ``block_hits``."""
    repeated = rows.groupBy("anchor").agg(F.sum("copies").alias("c")).filter("c > 1").select("anchor")
    units = stored(salted(rows, repeated, ["anchor"], "digest").groupBy("anchor", "digest").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("key", "at", "n")).alias("s")), "units")
    sizes = units.groupBy("anchor").agg(F.count("*").alias("d"), F.sum(F.col("s.n") + F.lit(size)).alias("bytes"))
    known = stored(salted(units, sizes, ["anchor"], "digest"), "known")
    hits = known.filter("d = 1").select("anchor", "digest", F.lit(0).alias("first"), F.col("s.n").alias("end"))
    shared = known.filter((F.col("d") > 1) & (F.col("bytes") <= BLOCK_BYTES))
    total = shared.agg(F.sum(F.col("s.n") + F.lit(size))).first()[0] or 0
    bodies = with_text(texts, shared).select("text", "parts").mapInArrow(
        cut_segments(size), "anchor bigint, digest bigint, n int, copies bigint, body binary")
    # the work grows with the bytes and is heavy for each, so their number and not the size of the shuffle says how many tasks
    bodies = bodies.repartition(max(1, -(-total // TASK_BYTES)), "anchor").sortWithinPartitions("anchor")
    hits = hits.unionByName(bodies.mapInArrow(shard_hits(size, gram), "anchor bigint, digest bigint, first int, end int"))
    large = known.filter((F.col("d") > 1) & (F.col("bytes") > BLOCK_BYTES))
    if widths and not large.isEmpty():
        pieces = stored(with_text(texts, large).mapInArrow(
            cut_pieces(size, widths[0]), SEGMENT + ", whole_anchor bigint, whole_digest bigint, whole_at int"), "pieces")
        inner = unit_hits(pieces.select("key", "at", "n", "anchor", "digest", "copies"), texts, size, widths[1:], 0)
        back = salted(pieces.select("key", "anchor", "digest", "whole_anchor", "whole_digest", "whole_at"), inner, ["anchor", "digest"], "key")
        hits = hits.unionByName(back.select(
            F.col("whole_anchor").alias("anchor"), F.col("whole_digest").alias("digest"),
            (F.col("whole_at") + F.col("first")).alias("first"), (F.col("whole_at") + F.col("end")).alias("end")))
    return hits


def intervals(texts: DataFrame, size: int = SIZE) -> DataFrame:
    """(key, hits): per distinct text (key, text) with repeated windows, their byte intervals."""
    rows = stored(texts.mapInArrow(segment_rows(size), SEGMENT), "segments")
    hits = unit_hits(rows, texts, size, (PIECE, 1), max(size // 2, 1))
    runs = hits.groupBy("anchor", "digest").agg(F.collect_list(F.struct("first", "end")).alias("runs"))
    back = salted(rows, stored(runs, "runs"), ["anchor", "digest"], "key")
    back = back.select("key", "at", F.explode("runs").alias("r")).distinct()
    return stored(back.groupBy("key").agg(F.collect_list(F.struct(
        (F.col("at") + F.col("r.first")).alias("at"), (F.col("at") + F.col("r.end") + size - 1).alias("to"))).alias("hits")), "intervals")


def thinned(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """Add ``_maybe``: false only where ``key`` is not among the keys. The bitmap behind it has a fixed size."""
    bit = F.pmod(F.col("key"), F.lit(FILTER_BITS)).cast("int")
    cells = keys.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("_cell")).agg(
        F.expr("bit_or(shiftleft(1L, bit % 64))").alias("_bits"))  # FILTER_BITS / 64 rows at most
    marked = texts.withColumn("_bit", bit).withColumn("_cell", F.expr("_bit div 64"))
    marked = marked.join(F.broadcast(cells), "_cell", "left")
    return marked.withColumn("_maybe", F.expr("coalesce(_bits & shiftleft(1L, _bit % 64), 0L) <> 0")).drop("_cell", "_bits", "_bit")


def deduplicate(docs: DataFrame, size: int = SIZE, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``) with ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and ``kept`` (the bytes left)."""
    body = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(F.struct(*(keep or ["*"])).alias("_row"), F.xxhash64(body, F.lit(1)).alias("key"), body.alias("text"))
    found = intervals(keyed.select("key", "text"), size)
    marked = thinned(keyed, found)
    no_hits = F.lit(None).cast("array<struct<at:int,to:int>>").alias("hits")
    # texts without hits, by far the most, are not shuffled
    clean = marked.filter(~F.col("_maybe")).select("_row", "text", no_hits)
    cut = marked.filter("_maybe").join(found, "key", "left").select("_row", "text", F.col("hits").cast("array<struct<at:int,to:int>>").alias("hits"))
    both = clean.unionByName(cut)
    schema = f"_row {both.schema['_row'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return both.mapInArrow(cut_texts(size), schema)
