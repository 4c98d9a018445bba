"""Tokens of two tokenizers aligned by bytes, with the statistics of linked ids over the corpus.

Byte offsets at which tokens of A and of B both end cut a text into groups; all A-B token pairs of a group are links.

Fragments. What a range of bytes holds, taken as the tokens that end in it, is a fragment: an open prefix (tokens up to the first
common end, whose group may have begun earlier), closed groups, and an open suffix (tokens after the last common
end). Two neighbouring fragments make one: the left suffix and the right prefix close a group. This is associative, so the
ranges of a very long text are worked off in different tasks and put together along a tree.

Units. Both tokenizers cut before a blank that follows a character other than white space: no pattern of A runs on over
such a blank, and no piece of B holds one inside, which is checked on its vocabulary. The text between such places is a
unit (mostly a word with its blank); it is encoded once per task and remembered. A range of bytes may begin and end anywhere, also
inside a unit, a token or a character; it is read with the units at its two borders. No unit holds two borders, so a text without blanks is
read twice at most.

Counts. Documents go in blocks of bounded size. A block names its distinct id pairs once, the pairs are counted over
all blocks, and each block gets the counts of its pairs back, so that no link is shuffled by document.

Edge cases: texts that are null, empty or not kept byte for byte by both tokenizers have no tokens: zeros and the
empty text; repeated rows each count as a document; empty tables give no rows; the input row is handed on as a struct.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from berthlake.llm import arrays
from berthlake.llm.storage import stored

RANGE_BYTES = 1 << 16
BLOCK_PAIRS = 1 << 18
FAN = 8  # fragments put together in one step of the tree
HELD_UNITS = 1 << 18
HELD_CHARS = 1 << 23
LEARNED_AT_ONCE = 1 << 14
RUN_CHARS = 1 << 13
LARGE_GROUP = 4096  # links of a group from which on equal ids are counted first
BLANK = "▁"  # fixed value: the sign that B writes for a blank

# a blank, and all that follows up to a blank behind a character other than white space
UNIT = re.compile(r" (?:(?<=\s) |[^ ]+)*")
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Closed(NamedTuple):
    """Closed groups: their numbers, their text, and the links of each id pair."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    text: str
    links: Counter


class Fragment(NamedTuple):
    """Ids of A and B before the first common end, closed groups, ids after the last; without a common end, all ids are in ``prefix``."""

    cut: bool
    prefix: tuple[list[int], list[int]]
    closed: Closed
    suffix: tuple[list[int], list[int]]


NOTHING = Closed(0, 0, 0, 0, "", Counter())
IDENTITY = Fragment(False, ([], []), NOTHING, ([], []))


def pair_code(a: int, b: int) -> int:
    return a << 32 | b


def joined(parts: list[Closed]) -> Closed:
    links: Counter = Counter()
    for part in parts:
        links.update(part.links)
    return Closed(*(sum(p[k] for p in parts) for k in range(4)), ";".join(p.text for p in parts if p.text), links)


def group(a: list[int], b: list[int]) -> Closed:
    links = Counter()
    counts_b = Counter(b)
    for x, n in Counter(a).items():
        for y, m in counts_b.items():
            links[pair_code(x, y)] = n * m
    return Closed(len(a), len(b), 1, len(a) * len(b), ",".join(map(str, a)) + "|" + ",".join(map(str, b)), links)


def composed(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two ranges that follow each other."""
    if not left.cut:
        return right._replace(prefix=(left.prefix[0] + right.prefix[0], left.prefix[1] + right.prefix[1]))
    between = left.suffix[0] + right.prefix[0], left.suffix[1] + right.prefix[1]
    if not right.cut:
        return left._replace(suffix=between)
    return Fragment(True, left.prefix, joined([left.closed, group(*between), right.closed]), right.suffix)


def whole(fragment: Fragment) -> Closed:
    """The groups of a text, whose ends are common ends."""
    return joined([group(*fragment.prefix), fragment.closed]) if fragment.cut else NOTHING


class Grouped(NamedTuple):
    """Groups of several segments of text: per segment the counts and the groups' text; the id pairs, and per segment and pair its links."""

    counts: np.ndarray
    texts: list[str]
    pairs: np.ndarray
    segments: np.ndarray
    places: np.ndarray  # numbers of the pairs
    times: np.ndarray


@lru_cache(maxsize=1)
def written(ids: int) -> tuple[list[str], np.ndarray]:
    """Texts of the ids, followed by a comma, a bar or a semicolon, and their lengths."""
    texts = [f"{k}{mark}" for k in range(ids) for mark in ",|;"]
    return texts, np.fromiter(map(len, texts), np.int64, len(texts))


def grouped(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray, ids: int) -> Grouped:
    """Groups of the tokens up to each bound; bounds are common ends, and the last one is the end of all."""
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    of_a, of_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    n_a, n_b = np.bincount(of_a, minlength=len(cuts)), np.bincount(of_b, minlength=len(cuts))
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    segment = np.searchsorted(bounds, cuts)
    counts = np.zeros((len(bounds), len(COUNTS)), np.int64)
    for k, values in enumerate((n_a, n_b, np.ones(len(cuts), np.int64), n_a * n_b)):
        sums = np.concatenate([[0], np.cumsum(values)])
        at = np.searchsorted(segment, np.arange(len(bounds) + 1))
        counts[:, k] = sums[at[1:]] - sums[at[:-1]]

    large = n_a * n_b > LARGE_GROUP
    own = np.flatnonzero(~large[of_a])
    times = n_b[of_a[own]]
    left = np.repeat(own, times)
    right = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + first_b[of_a[left]]
    codes, segments, often = [a[left] << 32 | b[right]], [segment[of_a[left]]], [np.ones(len(left), np.int64)]
    for k in np.flatnonzero(large).tolist():
        links = group(a[first_a[k]: first_a[k] + n_a[k]].tolist(), b[first_b[k]: first_b[k] + n_b[k]].tolist()).links
        codes.append(np.array(list(links), np.int64))
        often.append(np.array(list(links.values()), np.int64))
        segments.append(np.full(len(links), segment[k]))
    pairs, places = np.unique(np.concatenate(codes), return_inverse=True)
    keys, times = summed(np.concatenate(segments) * max(len(pairs), 1) + places, np.concatenate(often))

    texts, lengths = written(ids)
    flat = np.zeros(len(a) + len(b), np.int64)
    flat[np.arange(len(a)) + first_b[of_a]] = a * 3 + (ends_a == cuts[of_a])
    flat[np.arange(len(b)) + (first_a + n_a)[of_b]] = b * 3 + 2 * (ends_b == cuts[of_b])
    text = "".join(map(texts.__getitem__, flat.tolist()))
    ends = np.concatenate([[0], np.cumsum(lengths[flat])])[np.cumsum(counts[:, 0] + counts[:, 1])]
    starts = np.concatenate([[0], ends[:-1]])
    own_texts = [text[x: y - 1] if y > x else "" for x, y in zip(starts.tolist(), ends.tolist())]
    return Grouped(counts, own_texts, pairs, keys // max(len(pairs), 1), keys % max(len(pairs), 1), times)


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(values[order], starts) if len(starts) else values


class Tokenizers:
    """Both tokenizers, and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        # byte-level entries write a byte by a printable character: itself, or the next free one above 255
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [k for k in range(256) if k not in set(plain)]
        byte = {chr(k): k for k in plain} | {chr(256 + n): k for n, k in enumerate(others)}
        self.bytes_a = {k: bytes(byte.get(c, 0) for c in entry) for entry, k in self.a.get_vocab(with_added_tokens=True).items()}
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any(BLANK in name.lstrip(BLANK) for name in names):
            raise ValueError("a piece of B goes on over a blank, so texts cannot be cut there")
        self.bytes_b = [bytes([int(name[1:-1], 16)]) if self.b.is_byte(k) else name.replace(BLANK, " ").encode() for k, name in enumerate(names)]
        self.alone = self.b.piece_to_id(BLANK)
        self.ids = max(max(self.bytes_a) + 1, len(names))
        self.sizes_a = np.array([len(self.bytes_a.get(k, b"")) for k in range(self.ids)], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, their ends in bytes, ids of B, their ends, the units' ends, and which units keep their bytes; others have no tokens."""
        raw = [u.encode() for u in units]
        a, b = self.ids_of(runs(units))
        kept = np.ones(len(units), bool)
        if not self.bytes_of(self.bytes_a, a) == b"".join(raw) == self.bytes_of(self.bytes_b, b):
            each = [self.ids_of([u]) for u in units]
            kept = np.array([self.bytes_of(self.bytes_a, x) == u == self.bytes_of(self.bytes_b, y) for (x, y), u in zip(each, raw)], bool)
            a, b = ([k for x, good in zip(each, kept) if good for k in x[side]] for side in (0, 1))
            raw = [u if good else b"" for u, good in zip(raw, kept)]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        return a, np.cumsum(self.sizes_a[a]), b, np.cumsum(self.sizes_b[b]), ends, kept

    def ids_of(self, texts: list[str]) -> tuple[list[int], list[int]]:
        """Ids of A and of B of texts that begin with a blank, one after the other."""
        a = list(chain.from_iterable(e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)))
        theirs = self.b.encode([t[1:] for t in texts], num_threads=1)  # B puts the blank in front by itself
        return a, list(chain.from_iterable([self.alone] if t == " " else x for t, x in zip(texts, theirs)))

    @staticmethod
    def bytes_of(table, ids: list[int]) -> bytes:
        return b"".join(map(table.__getitem__, ids))


def runs(units: list[str]) -> list[str]:
    """Units put together to texts that both tokenizers cut into these units again: one that ends with white space ends its run."""
    out, own, size = [], [], 0
    for unit in units:
        own.append(unit)
        size += len(unit)
        if size >= RUN_CHARS or unit[-1].isspace():
            out.append("".join(own))
            own, size = [], 0
    return [*out, "".join(own)] if own else out


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def fragment(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, low: int, high: int, ids: int) -> Fragment:
    """The fragment of the tokens that end after ``low`` and up to ``high``."""
    own_a, own_b = (ends_a > low) & (ends_a <= high), (ends_b > low) & (ends_b <= high)
    a, ends_a, b, ends_b = a[own_a], ends_a[own_a], b[own_b], ends_b[own_b]
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(cuts):
        return Fragment(False, (a.tolist(), b.tolist()), NOTHING, ([], []))
    (a0, a1), (b0, b1) = (np.searchsorted(ends, [cuts[0], cuts[-1]], "right") for ends in (ends_a, ends_b))
    closed = NOTHING
    if len(cuts) > 1:
        g = grouped(a[a0:a1], ends_a[a0:a1], b[b0:b1], ends_b[b0:b1], cuts[-1:], ids)
        closed = Closed(*g.counts[0].tolist(), g.texts[0], Counter(dict(zip(g.pairs[g.places].tolist(), g.times.tolist()))))
    return Fragment(True, (a[:a0].tolist(), b[:b0].tolist()), closed, (a[a1:].tolist(), b[b1:].tolist()))


class Units(dict):
    """Numbers of the units seen in a task, with the groups of each one."""

    def __init__(self, both: Tokenizers):
        super().__init__()
        self.both, self.fresh, self.chars = both, [], 0
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.fresh, self.chars, self.kept, self.texts = [], 0, [], []
        self.counts = np.zeros((0, len(COUNTS)), np.int64)
        # the pairs of unit k: numbers in ``pairs``, from firsts[k] to firsts[k + 1]
        self.firsts, self.places, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.codes = {}, np.zeros(0, np.int64)

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.fresh.append(unit)
        self.chars += len(unit)
        return number

    def learn(self) -> None:
        """Groups of the units that are new since the last call."""
        for first in range(0, len(self.fresh), LEARNED_AT_ONCE):
            fresh = self.fresh[first: first + LEARNED_AT_ONCE]
            *tokens, kept = self.both.encode(fresh)
            found = grouped(*tokens, self.both.ids)
            numbers = np.array([self.pairs.setdefault(code, len(self.pairs)) for code in found.pairs.tolist()], np.int64)
            sizes = np.bincount(found.segments, minlength=len(fresh))
            self.kept += kept.tolist()
            self.texts += found.texts
            self.counts = np.concatenate([self.counts, found.counts])
            self.firsts = np.concatenate([self.firsts, self.firsts[-1] + np.cumsum(sizes)])
            self.places = np.concatenate([self.places, numbers[found.places]])
            self.codes = np.concatenate([self.codes, np.array(list(islice(self.pairs, len(self.codes), None)), np.int64)])
            self.times = np.concatenate([self.times, found.times])
        self.fresh = []

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text the counts and the groups' text; per text and distinct id pair the text's number, the pair and its links."""
        if len(self) > HELD_UNITS or self.chars > HELD_CHARS:
            self.clear()
        number = self.__getitem__
        own = [list(map(number, UNIT.findall(" " + t))) if t else [] for t in texts]
        self.learn()
        own = [u if all(map(self.kept.__getitem__, u)) else [] for u in own]
        groups = [";".join(map(self.texts.__getitem__, u)) for u in own]
        sizes = np.array([len(u) for u in own], np.int64)
        flat = np.fromiter(chain.from_iterable(own), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(own)), sizes)
        sums = np.zeros((len(flat) + 1, len(COUNTS)), np.int64)
        np.cumsum(self.counts[flat], axis=0, out=sums[1:])
        ends = np.cumsum(sizes)
        counts = sums[ends] - sums[ends - sizes]
        span = max(len(self), 1)
        kinds, often = np.unique(doc * span + flat, return_counts=True)
        doc, flat = kinds // span, kinds % span
        first, size = self.firsts[flat], self.firsts[flat + 1] - self.firsts[flat]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
        span = max(len(self.codes), 1)
        found, times = summed(np.repeat(doc, size) * span + self.places[at], self.times[at] * np.repeat(often, size))
        return counts, groups, found // span, self.codes[found % span], times


class Blocks:
    """Documents of a task in blocks; each block ends with a row that names its pairs and in how many documents they are."""

    def __init__(self, source: int, row: pa.DataType):
        self.id, self.row = (TaskContext.get().partitionId() << 32) + source, row
        self.names = ["_row", "block", *COUNTS, "groups_sha256", "pairs", "times"]
        self.held, self.codes, self.size = [], [], 0

    def add(self, rows: pa.Array, counts: np.ndarray, groups: list[str], bounds: np.ndarray, codes: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        self.held.append([rows, *(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(shas, pa.string()),
                          pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(codes, pa.int64())),
                          pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(times, pa.int64()))])
        self.codes.append(codes)
        self.size += len(codes) + len(rows)
        if self.size >= BLOCK_PAIRS:
            yield from self.end()

    def end(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        for rows, *others in self.held:
            yield pa.RecordBatch.from_arrays([rows, pa.array([self.id] * len(rows), pa.int64()), *others], names=self.names)
        kinds, often = np.unique(np.concatenate(self.codes), return_counts=True)
        ends = pa.array([0, len(kinds)], pa.int32())
        nothing = [pa.nulls(1, pa.int64())] * len(COUNTS)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, self.row), pa.array([self.id], pa.int64()), *nothing, pa.nulls(1, pa.string()),
             pa.ListArray.from_arrays(ends, pa.array(kinds, pa.int64())), pa.ListArray.from_arrays(ends, pa.array(often, pa.int64()))], names=self.names)
        self.id += 2
        self.held, self.codes, self.size = [], [], 0


def short_documents(path_a: str, path_b: str):
    """Batches of (row, text): the documents in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, blocks = Units(tokenizers(path_a, path_b)), None
        for batch in batches:
            blocks = blocks or Blocks(0, batch.column(0).type)
            for first, end, _, _ in arrays.slices(batch.column(1)):
                counts, groups, doc, codes, times = units.documents(batch.column(1).slice(first, end - first).to_pylist())
                bounds = np.searchsorted(doc, np.arange(end - first + 1))
                yield from blocks.add(batch.column(0).slice(first, end - first), counts, groups, bounds, codes, times)
        if blocks:
            yield from blocks.end()
        units.clear()
        pa.default_memory_pool().release_unused()  # an idle worker stays beside the executor

    return run


def long_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (row, fragment): the documents in blocks."""
    blocks = None
    for batch in batches:
        blocks = blocks or Blocks(1, batch.column(0).type)
        names = batch.schema.names[1:]
        for i in range(len(batch)):
            fields = {n: batch.column(k)[i].as_py() for k, n in enumerate(names, 1)}
            done = whole(as_fragment(fields)) if fields["kept"] else NOTHING
            codes, times = (np.fromiter(x, np.int64, len(done.links)) for x in (done.links, done.links.values()))
            yield from blocks.add(batch.column(0).slice(i, 1), np.array([done[:4]], np.int64), [done.text], np.array([0, len(codes)]), codes, times)
    if blocks:
        yield from blocks.end()


def borders(sizes: list[int], step: int) -> list[int]:
    """Borders of byte ranges: multiples of ``step``, none inside a unit that holds one already, and the text's ends."""
    out, at = [0], 0
    for size in sizes:
        border = -(-(at + 1) // step) * step
        at += size
        if border < at:
            out.append(border)
        elif border == at:
            out.append(at)
    return out if out[-1] == at else [*out, at]


def cut_ranges(step: int):
    """Batches of (key, text): byte ranges with the whole units at their borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                units = UNIT.findall(" " + text.as_py())
                sizes = [len(u.encode()) for u in units]
                ends = np.cumsum(sizes)
                limits = borders(sizes, step)
                raw = (" " + text.as_py()).encode()
                count = len(limits) - 1
                for i, (low, high) in enumerate(zip(limits, limits[1:])):
                    first = int(np.searchsorted(ends, low, "right"))  # the unit that ends behind the range's begin
                    last = int(np.searchsorted(ends, high, "left"))
                    begin = int(ends[first - 1]) if first else 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], pa.string()), pa.array([i], pa.int64()), pa.array([count], pa.int64()),
                         pa.array([low - begin], pa.int64()), pa.array([high - begin], pa.int64()),
                         pa.array([raw[begin: int(ends[last])].decode()], pa.string())],
                        names=["key", "i", "ranges", "low", "high", "part"])

    return run


FRAGMENT_NAMES = ["key", "i", "kept", "cut", "prefix_a", "prefix_b", *COUNTS, "groups", "pairs", "times", "suffix_a", "suffix_b"]
FRAGMENT_SCHEMA = ("key string, i bigint, kept boolean, cut boolean, prefix_a array<int>, prefix_b array<int>, n_a bigint, n_b bigint, n_groups bigint, "
                   "n_links bigint, groups string, pairs array<bigint>, times array<bigint>, suffix_a array<int>, suffix_b array<int>")


def as_row(key: str, i: int, kept: bool, f: Fragment) -> pa.RecordBatch:
    ids = pa.list_(pa.int32())
    values = [(key, pa.string()), (i, pa.int64()), (kept, pa.bool_()), (f.cut, pa.bool_()), (f.prefix[0], ids), (f.prefix[1], ids),
              *((n, pa.int64()) for n in f.closed[:4]), (f.closed.text, pa.string()), (list(f.closed.links), pa.list_(pa.int64())),
              (list(f.closed.links.values()), pa.list_(pa.int64())), (f.suffix[0], ids), (f.suffix[1], ids)]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], names=FRAGMENT_NAMES)


def as_fragment(row: dict) -> Fragment:
    closed = Closed(row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups"], Counter(dict(zip(row["pairs"], row["times"]))))
    return Fragment(row["cut"], (row["prefix_a"], row["prefix_b"]), closed, (row["suffix_a"], row["suffix_b"]))


def range_fragments(path_a: str, path_b: str):
    """Batches of (key, i, low, high, part): the fragment of each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        for batch in batches:
            for key, i, low, high, part in zip(*(batch.column(k).to_pylist() for k in range(5))):
                *tokens, _, kept = both.encode(UNIT.findall(part))
                yield as_row(key, i, bool(kept.all()), fragment(*tokens, low, high, both.ids) if kept.all() else IDENTITY)

    return run


def composed_groups(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Up to FAN neighbouring fragments of a text as one."""
    out, kept = IDENTITY, True
    found = sorted(rows.to_pylist(), key=lambda r: r["i"])
    for row in found:
        kept = kept and row["kept"]
        out = composed(out, as_fragment(row)) if kept else IDENTITY
    return pa.Table.from_batches([as_row(found[0]["key"], found[0]["i"] // FAN, kept, out)])


def texts_of_ranges(texts: DataFrame, path_a: str, path_b: str, step: int) -> DataFrame:
    """(key, fragment) of long texts (key, text), written apart, so that a task never has more than one Python worker."""
    parts = texts.mapInArrow(cut_ranges(step), "key string, i bigint, ranges bigint, low bigint, high bigint, part string").dropDuplicates(["key", "i"])
    parts = stored(parts, "ranges")
    most = parts.agg(F.max("ranges")).first()[0] or 0
    now = parts.select("key", "i", "low", "high", "part").mapInArrow(range_fragments(path_a, path_b), FRAGMENT_SCHEMA)
    while most > 1:
        now = now.groupBy("key", F.expr(f"i div {FAN}")).applyInArrow(composed_groups, FRAGMENT_SCHEMA)
        most = -(-most // FAN)
    return stored(now.drop("i"), "fragments")


def linked(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None, step: int = RANGE_BYTES) -> DataFrame:
    """All documents in blocks, and one row per block without ``_row`` that names its pairs with their documents."""
    rows = docs.select(F.struct(*(keep or ["*"])).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), T.StructField("block", T.LongType()), *(T.StructField(n, T.LongType()) for n in COUNTS),
                           T.StructField("groups_sha256", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())),
                           T.StructField("times", T.ArrayType(T.LongType()))])
    short = rows.filter(F.octet_length("text") < step).mapInArrow(short_documents(path_a, path_b), schema)
    long = rows.filter(F.octet_length("text") >= step).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    found = texts_of_ranges(long.select("key", "text"), path_a, path_b, step)
    long = long.select("_row", "key").join(found, "key").select("_row", *FRAGMENT_NAMES[2:]).mapInArrow(long_documents, schema)
    return stored(short.unionByName(long), "linked")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many documents each id pair is linked, and whether its A id has no pair in more of them."""
    named = rows.filter(F.col("_row").isNull()).select(F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("n"))).alias("p"))
    counts = named.groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.n").alias("docs"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    # one row per id of A, so the vocabulary bounds what is broadcast
    return counts.join(F.broadcast(top), "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))


def scored():
    """Batches of (row, block, counts, sha, pairs, times, known) by block, the block's known pairs first: the documents with their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        block, table = None, (nothing, nothing, nothing)
        for batch in batches:
            own = batch.column(1).to_numpy()
            known = batch.column(len(COUNTS) + 5)
            heads = np.flatnonzero(known.is_valid().to_numpy(zero_copy_only=False))
            firsts = np.union1d(np.concatenate([[0], heads]), np.flatnonzero(np.diff(own)) + 1).astype(int)
            for first, end in zip(firsts, [*firsts[1:], len(batch)]):
                if own[first] != block:
                    block, table = own[first], (nothing, nothing, nothing)
                if known[int(first)].is_valid:
                    pairs = known.slice(first, 1).flatten()
                    codes = pairs.field(0).to_numpy()
                    order = np.argsort(codes)
                    table = (codes[order], pairs.field(1).to_numpy()[order], pairs.field(2).to_numpy(zero_copy_only=False)[order].astype(np.int64))
                    first += 1
                part = batch.slice(first, end - first)
                if not len(part):
                    continue
                lists, times = part.column(len(COUNTS) + 3), part.column(len(COUNTS) + 4).flatten().to_numpy()
                codes = lists.flatten().to_numpy()
                doc = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                at = np.searchsorted(table[0], codes)
                best, total = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                np.add.at(best, doc, times * table[2][at])
                np.add.at(total, doc, times * table[1][at])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(part.column(2 + k) for k in range(len(COUNTS) + 1)), pa.array(best), pa.array(total)],
                    names=["_row", *COUNTS, "groups_sha256", "n_best", "count_sum"])

    return run


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None, step: int = RANGE_BYTES) -> DataFrame:
    """``_row`` (the input row as a struct, or its columns ``keep``) with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum`` and ``groups_sha256``."""
    rows = linked(docs, path_a, path_b, text, keep, step)
    asked = rows.filter(F.col("_row").isNull()).select("block", F.explode("pairs").alias("pair"))
    known = asked.join(pair_counts(rows), "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "docs", "best")).alias("known"))
    answers = known.select(
        F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), "block", *(F.lit(None).cast("bigint").alias(n) for n in COUNTS),
        F.lit(None).cast("string").alias("groups_sha256"), F.lit(None).cast("array<bigint>").alias("pairs"),
        F.lit(None).cast("array<bigint>").alias("times"), "known")
    own = rows.filter(F.col("_row").isNotNull()).withColumn("known", F.lit(None).cast(known.schema["known"].dataType))
    dealt = answers.unionByName(own).repartition("block").sortWithinPartitions("block", F.col("known").isNull())
    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), *(T.StructField(n, T.LongType()) for n in COUNTS), T.StructField("groups_sha256", T.StringType()),
                           T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return dealt.mapInArrow(scored(), schema)
