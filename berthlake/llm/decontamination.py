"""Benchmark decontamination with a generalised suffix automaton.

The words of the test items go into one automaton. Training words are streamed through it, and the length of the longest
match that ends at each word is tracked: ten words or more are a window of some item. Items shorter than a
window count as one window of their own. The words inside hits are removed; a document that consists of hits beyond
a coverage limit goes altogether.

The items are taken in blocks of at most ``BLOCK_CHARS`` characters, so an automaton has a bounded size however large the
benchmark is; the documents pass through all of them in one narrow step, as a task holds a Python worker for each step in it.

Edge cases: null and empty texts have no words; items without words match nothing; an item without an id counts under the
empty id; repeated items count once per id; empty tables give no hits or no rows; input columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from berthlake.llm import arrays

WINDOW = 10
BLOCK_CHARS = 1_000_000
MAX_COVERAGE = 0.5  # share of a document's words inside hits beyond which it goes


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, numbers in items:
            last = 0
            for number in numbers:
                last = self._extend(last, number)
        self.items: list[set | None] = [None] * len(self.next)
        self.short: list[list | None] = [None] * len(self.next)
        for name, numbers in items:
            state = matched = 0
            for number in numbers:
                state, matched = self.step(state, matched, number)
                if matched >= window:
                    at = self.ancestor(state, window)
                    self.items[at] = (self.items[at] or set()) | {name}
            if 0 < len(numbers) < window:
                at = self.ancestor(state, len(numbers))
                self.short[at] = [*(self.short[at] or []), (len(numbers), name)]
        # short items that end a match: the state's own and those of all states it links to
        self.endings: list[tuple] = [()] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.endings[state] = (*self.endings[self.link[state]], *(self.short[state] or ()))

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, number: int, target: int) -> int:
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(number) == target:
            self.next[state][number] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, number: int) -> int:
        target = self.next[last].get(number)
        if target is not None:  # an earlier item went the same way
            return target if self.length[target] == self.length[last] + 1 else self._split(last, number, target)
        made, state = self._new(self.length[last] + 1, 0, {}), last
        while state >= 0 and number not in self.next[state]:
            self.next[state][number] = made
            state = self.link[state]
        if state >= 0:
            target = self.next[state][number]
            self.link[made] = target if self.length[target] == self.length[state] + 1 else self._split(state, number, target)
        return made

    def step(self, state: int, matched: int, number: int) -> tuple[int, int]:
        edges = self.next
        while state and number not in edges[state]:
            state = self.link[state]
            matched = self.length[state]
        target = edges[state].get(number)
        return (target, matched + 1) if target is not None else (0, 0)

    def ancestor(self, state: int, length: int) -> int:
        """The state of the match's last ``length`` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def hits(self, numbers: list[int], window: int) -> tuple[list[tuple[int, int]], set]:
        """Word spans inside occurrences of windows, and the items that have them."""
        spans, names, state, matched = [], set(), 0, 0
        for at, number in enumerate(numbers):
            state, matched = self.step(state, matched, number)
            if matched >= window:
                spans.append((at - window + 1, at + 1))
                names |= self.items[self.ancestor(state, window)]
            if self.endings[state]:
                for n, name in self.endings[state]:
                    if n <= matched:
                        spans.append((at - n + 1, at + 1))
                        names.add(name)
        return spans, names


def numbered(texts: pa.Array) -> tuple[np.ndarray, arrays.Words]:
    """Word hashes (ASCII letters lowered) of all texts."""
    data, offsets = arrays.buffer(texts)
    data = arrays.LOWER[data]
    found = arrays.words(data, offsets, arrays.LETTERS)
    return arrays.word_hashes(data, found), found


def build(block: pa.Table, window: int) -> tuple[np.ndarray, Automaton, int]:
    """Sorted hashes of the block's words, its automaton, and the fewest words of any of its windows."""
    hashes, found = numbered(arrays.one_chunk(block["text"]))
    vocabulary = np.unique(hashes)
    numbers, bounds = np.searchsorted(vocabulary, hashes).tolist(), found.bounds.tolist()
    items = [(name, numbers[a:b]) for name, a, b in zip(block["item"].to_pylist(), bounds, bounds[1:]) if b > a]
    return vocabulary, Automaton(items, window), min((min(len(n), window) for _, n in items), default=window)


def blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    """The items in blocks of bounded size; an item is never cut."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce("text", F.lit("")).alias("text")).distinct()
    # characters bound the words; slices of items keep the running sum out of one task
    sized = items.withColumn("_slice", F.pmod(F.xxhash64("item", "text"), F.lit(1024))).withColumn("_n", F.length("text") + 1)
    slices = sized.groupBy("_slice").agg(F.sum("_n").alias("_sum"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # 1024 rows at most
    firsts = slices.select("_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_slice").orderBy("item", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("_at", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(firsts, "_slice")
    placed = placed.withColumn("_block", F.floor((F.col("_first") + F.col("_at")) / block_chars))
    names = [r[0] for r in placed.select("_block").distinct().orderBy("_block").toLocalIterator()]
    return [placed.filter(F.col("_block") == b).select("item", "text").orderBy("item", "text") for b in names]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
         keep: list[str] | None = None, texts: bool = True) -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``), ``_text`` if ``texts``, ``n_words``, the numbers of the
    words inside hits ``hit_words`` (rising), their count ``n_hit`` and the ids ``items``."""
    picked = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.struct(*(keep or ["*"])).alias("_row"))
    fields = [picked.schema["_text"], picked.schema["_row"], T.StructField("n_words", T.LongType()),
              T.StructField("hit_words", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))]
    schema = T.StructType([f for f in fields if texts or f.name != "_text"])
    found = picked.mapInArrow(marker(automata(benchmark, window, block_chars), window, schema.names), schema)
    return found.withColumn("n_hit", F.size("hit_words").cast("bigint"))


def automata(benchmark: DataFrame, window: int, block_chars: int) -> list:
    """The automaton of each block, sent to the tasks."""
    parts = [b.toArrow() for b in blocks(benchmark, block_chars)]
    return [benchmark.sparkSession.sparkContext.broadcast(build(part, window)) for part in parts]


def marked(batches: Iterator[pa.RecordBatch], shared: list, window: int):
    """Per batch of (text, ...): the batch, and of each text the number of words, the words inside hits (rising) and the items."""
    for batch in batches:
        text = batch.column(0)
        counts = np.zeros(len(text), np.int64)
        hit_words, items = [[] for _ in range(len(text))], [[] for _ in range(len(text))]
        for first, end, data, offsets in arrays.slices(text):
            data = arrays.LOWER[data]
            found = arrays.words(data, offsets, arrays.LETTERS)
            counts[first:end] = np.diff(found.bounds)
            if not shared or not len(found.starts):
                continue
            hashes = arrays.word_hashes(data, found)
            for block in shared:
                vocabulary, automaton, fewest = block.value
                if not len(vocabulary):
                    continue
                at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                known = vocabulary[at] == hashes
                # only runs of known words that are long enough for a window can hold a hit
                edge = np.flatnonzero(np.diff(known.astype(np.int8), prepend=0, append=0))
                cuts = found.bounds[1:-1]
                cuts = cuts[(cuts > 0) & (cuts < len(known))]
                cuts = cuts[known[cuts] & known[cuts - 1]]
                starts = np.union1d(edge[::2], cuts)
                ends = np.union1d(edge[1::2], cuts)
                long = ends - starts >= fewest
                for a, b in zip(starts[long].tolist(), ends[long].tolist()):
                    spans, ids = automaton.hits(at[a:b].tolist(), window)
                    if spans:
                        doc = int(np.searchsorted(found.bounds, a, "right")) - 1
                        base = a - int(found.bounds[doc])
                        covered = set(hit_words[first + doc])
                        for x, y in spans:
                            covered.update(range(base + x, base + y))
                        hit_words[first + doc] = sorted(covered)
                        items[first + doc] = sorted(ids | set(items[first + doc]))
        yield batch, counts, hit_words, items
    pa.default_memory_pool().release_unused()  # an idle worker stays beside the executor


def marker(shared: list, window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts, hit_words, items in marked(batches, shared, window):
            made = {"_text": batch.column(0), "_row": batch.column(1), "n_words": pa.array(counts),
                    "hit_words": pa.array(hit_words, pa.list_(pa.int32())), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([made[n] for n in names], names=names)

    return run


def cleaner(shared: list, window: int, max_coverage: float):
    """Batches of (text, row): the rows that stay, each with its text without the hit words (and what stands between two of them) if
    there are any, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts, hit_words, _ in marked(batches, shared, window):
            stays = np.fromiter(map(len, hit_words), np.int64, len(hit_words)) <= max_coverage * counts
            clean = [None] * len(counts)
            for i, hits in enumerate(hit_words):
                if hits and stays[i]:
                    clean[i] = without_hits(batch.column(0)[i].as_py(), np.array(hits))
            out = pa.RecordBatch.from_arrays([pa.array(clean, pa.string()), batch.column(1)], names=["_clean", "_row"])
            yield out if stays.all() else out.filter(pa.array(stays))

    return run


def without_hits(text: str, hits: np.ndarray) -> str:
    found = numbered(pa.array([text]))[1]
    breaks = np.flatnonzero(np.diff(hits) > 1)
    starts = found.starts[hits[np.concatenate([[0], breaks + 1])]].tolist()
    ends = found.ends[hits[np.concatenate([breaks, [len(hits) - 1]])]].tolist()
    raw, kept, at = text.encode(), [], 0
    for a, b in zip(starts, ends):
        kept.append(raw[at:a])
        at = b
    return (b"".join(kept) + raw[at:]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents with hits cut out; those with more than ``max_coverage`` of their words in hits are left out.

    Columns are those of the input; ``text`` is changed where there were hits, and ``n_chars`` with it.
    """
    picked = docs.select(F.coalesce("text", F.lit("")).alias("_text"), F.struct("*").alias("_row"))
    schema = T.StructType([T.StructField("_clean", T.StringType()), picked.schema["_row"]])
    cleaned = picked.mapInArrow(cleaner(automata(benchmark, window, block_chars), window, max_coverage), schema)
    columns = []
    for name in docs.columns:
        old = F.col(f"_row.`{name}`")
        new = {"text": F.col("_clean"), "n_chars": F.length("_clean").cast(docs.schema[name].dataType)}.get(name)
        columns.append((F.when(F.col("_clean").isNotNull(), new).otherwise(old) if new is not None else old).alias(name))
    return cleaned.select(*columns)
