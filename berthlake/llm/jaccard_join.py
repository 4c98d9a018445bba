"""Self-join of documents on the Jaccard similarity of their word shingles, by rare-first prefix filtering.

1. Documents with equal shingle sets are one class; everything after works on classes.
2. Shingles are ordered rare-first: those found often come last, by frequency, all others first, by hash. Any order
   that all tasks share gives the same links; the frequent ones come from counts over all texts, and the list of
   them is bounded.
3. Only the first ``n - ceil(0.75 n) + 1`` shingles of a class of size n are shuffled. Two classes that
   link share one of these at least.
4. Length, positional and suffix filters drop pairs that cannot reach the similarity; the rest is verified
   once per pair on whole sets.
5. Pairs are formed between classes that are not in one component yet. First every class meets one pivot per
   shared shingle: the class whose shingles are the most frequent on average, which in a group of edited copies is the one
   nearest to the original. Shingles whose classes are all in one component then are done with. While the pairs left
   outnumber the rows and pivots still halve them, other pivots are taken; then the pairs of classes in different components are joined and
   verified one by one. So a large group of near copies costs a few passes and not the square of its size, and no
   link between components is lost.

Edge cases: null and empty texts link with nothing; a text of fewer words than a shingle is one shingle; repeated rows
are one class; null ids are allowed and count as no id in the smallest id of a component; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from berthlake.llm import arrays
from berthlake.llm.components import components
from berthlake.llm.storage import stored

SHINGLE = 5
PERCENT = 75
FREQUENT_SHINGLES = 200_000  # bound of the list of frequent shingles that every task gets: 3.2 MB
FREQUENT_FROM = 8            # sightings from which a shingle is put on it
COUNT_CHUNK = 2_000_000      # shingles counted at once
PAIRS_PER_ROW = 1000          # further pivots are taken while more pairs than this are left and each round halves them
FILTER_BITS = 1 << 22        # of the bitmap that thins out texts before they are shuffled: 512 kB
SUFFIX_CELLS = 32


# ---- the sets ----

def described(shingle: int):
    """Batches of (id, text): per text its id, the size of its set and the set's key; per chunk, the shingles seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = [], 0

        def counts(final: bool):
            nonlocal pending, held
            if pending and (final or held >= COUNT_CHUNK):
                values, n = np.unique(np.concatenate(pending), return_counts=True)
                pending, held = [], 0
                many = n > 1
                if many.any():
                    yield values[many].view(np.int64), n[many]

        def rows(ids, sizes, keys, seen):
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()), pa.array(seen, pa.int64())],
                names=["doc_id", "n", "key", "seen"])

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for first, end, data, offsets in arrays.slices(batch.column(1)):
                sets = arrays.shingle_sets(data, offsets, shingle)
                yield rows(batch.column(0).slice(first, end - first), [len(s) for s in sets],
                           [arrays.set_key(s) for s in sets], [0] * len(sets))
                pending += [s for s in sets if len(s)]
                held += sum(map(len, sets))
                for values, n in counts(False):
                    yield rows(pa.nulls(len(values), id_type), np.zeros(len(values), np.int32), values, n)
        for values, n in counts(True):
            yield rows(pa.nulls(len(values), id_type), np.zeros(len(values), np.int32), values, n)

    return run


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefixes(frequent, shingle: int, percent: int):
    """Batches of (text): the prefix shingles of each class, each class once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, ranks = frequent.value
        seen: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in arrays.slices(batch.column(0)):
                tokens, classes, sizes, places, scores = [], [], [], [], []
                for members in arrays.shingle_sets(data, offsets, shingle):
                    key = arrays.set_key(members)
                    if not len(members) or key in seen:
                        continue
                    if len(seen) < 500_000:
                        seen.add(key)  # spares a few rows; equal classes meet again behind the shuffle
                    n, score = len(members), 0
                    if len(often):
                        at = np.minimum(np.searchsorted(often, members), len(often) - 1)
                        rank = np.where(often[at] == members, ranks[at], 0)
                        if rank.any():
                            members = members[np.lexsort((members, rank))]
                            score = min(int(rank.sum()) // n, 1 << 30)
                    size = prefix_size(n, percent)
                    tokens.append(members[:size])
                    classes.append(np.full(size, key, np.int64))
                    sizes.append(np.full(size, n, np.int32))
                    places.append(np.arange(size, dtype=np.int32))
                    scores.append(np.full(size, score, np.int32))
                if tokens:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in ([t.view(np.int64) for t in tokens], classes, sizes, places, scores)],
                        names=["token", "class", "n", "at", "score"])

    return run


def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, falling score, class): those whose token occurs in another class too, with the token's first class as pivot.

    Only the first row of the group at hand is kept between batches.
    """
    names = ["token", "class", "n", "at"]
    held = None  # the last group's first row, its last class, and whether it was given out
    for batch in batches:
        cols = [batch.column(i).to_numpy() for i in range(4)]
        if held is not None:
            cols = [np.concatenate([[h], c]) for h, c in zip(held[0], cols)]
        token, key = cols[0], cols[1]
        if not len(token):
            continue
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        if held is not None and len(token) > 1 and token[1] == token[0] and key[1] == held[1]:
            fresh[1] = False  # the class before the border
        # rows of the pivot's class after the border would look new only if classes were not sorted
        last_class = key[-1] if len(token) > 1 or held is None else held[1]
        cols = [c[fresh] for c in cols]
        token = cols[0]
        starts = np.ones(len(token), bool)
        starts[1:] = token[1:] != token[:-1]
        first = np.maximum.accumulate(np.where(starts, np.arange(len(token)), 0))
        keep = ~starts
        keep[:-1] |= starts[:-1] & ~starts[1:]
        if held is not None and held[2]:
            keep[0] = False
        given = (not starts[-1]) or (held is not None and held[2] and first[-1] == 0)
        held = ([c[first[-1]] for c in cols], last_class, bool(given))
        if keep.any():
            picked = [c[keep] for c in cols]
            at = first[keep]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(picked, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))),
                 pa.array(cols[1][at], pa.int64()), pa.array(cols[2][at], pa.int32()), pa.array(cols[3][at], pa.int32())],
                names=[*names, "pivot", "pivot_n", "pivot_at"])


# ---- pairs ----

def possible(pairs: DataFrame, percent: int, whole: bool) -> DataFrame:
    """The distinct pairs of (a, b, n_a, n_b, at_a, at_b), one row per common prefix shingle, that can link.

    Linked sets have an overlap of percent / (100 + percent) of the sum of their sizes at least. So few shingles of
    a prefix are not common that both prefixes share a certain number k of them. The i-th common shingle has i - 1
    common ones before it, and the rest of both sets must hold the others. Half of k are asked for, with the room that
    these must have; rows that do not have it are dropped before they are grouped. Where a pair's rows may be incomplete,
    half of that number will do. With ``whole`` they are complete and their places leave out what is common with nobody,
    so the room at the first common shingle decides.
    """
    length = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    overlap = F.expr(f"(({percent} * (n_a + n_b)) + {99 + percent}) div {100 + percent}")

    def surely(n: str):  # common shingles in the prefix
        return F.expr(f"{n} - ({percent} * {n} + 99) div 100 + 1") - (F.col(n) - overlap)

    asked = F.lit(1).cast("bigint")
    if not whole:
        asked = F.greatest(asked, F.ceil(F.least(surely("n_a"), surely("n_b")) / 2))
    room = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= overlap - asked + 1
    grouped = pairs.filter(length & room).groupBy("a", "b", asked.alias("asked")).agg(F.count(F.lit(1)).alias("met"))
    return grouped.filter(F.col("met") >= F.col("asked") / 2).select("a", "b")


def oriented(x: str, y: str) -> list[Column]:
    """a < b of the classes ``x`` and ``y`` with their sizes and places."""
    first = F.col(f"{x}class") < F.col(f"{y}class")

    def pick(name: str, other: bool) -> Column:
        p, q = (y, x) if other else (x, y)
        return F.when(first, F.col(p + name)).otherwise(F.col(q + name))

    return [pick(name, other).alias(f"{label}{'b' if other else 'a'}")
            for name, label in (("class", ""), ("n", "n_"), ("at", "at_")) for other in (False, True)]


def bitmap(spark: SparkSession, keys: DataFrame, column: str):
    """A bounded bitmap of the keys; a set bit may be a chance hit, an unset one never."""
    bit = F.pmod(F.col(column), F.lit(FILTER_BITS)).cast("int")
    rows = keys.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, bit % 64))").alias("bits"))
    got = rows.toArrow()  # FILTER_BITS / 64 rows at most
    cells = np.zeros(FILTER_BITS // 64, np.uint64)
    cells[got["cell"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(cells)


def wanted_texts(shared, shingle: int):
    """Batches of (text): class and text of the wanted classes, each class once per task, with the suffix filter's cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = shared.value, set()
        for batch in batches:
            for first, end, data, offsets in arrays.slices(batch.column(0)):
                sets, picked, keys, counts = arrays.shingle_sets(data, offsets, shingle), [], [], []
                for i, members in enumerate(sets):
                    key = arrays.set_key(members)
                    bit = key % FILTER_BITS
                    if not len(members) or key in seen or not int(cells[bit // 64]) >> (bit % 64) & 1:
                        continue
                    if len(seen) < 500_000:
                        seen.add(key)
                    picked.append(first + i)
                    keys.append(key)
                    counts.append(np.bincount((members >> np.uint64(59)).astype(np.int64), minlength=SUFFIX_CELLS))
                if picked:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), batch.column(0).take(pa.array(picked)),
                         pa.array([c.tolist() for c in counts], pa.list_(pa.int32()))], names=["class", "text", "cells"])

    return run


def confirmed(shingle: int, percent: int):
    """Batches of (a, b, text_a, text_b): pairs that link, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # texts that stand beside each other are often the same pivot
            cache: dict[int, np.ndarray] = {}
            found = []
            keys = [batch.column(k).to_pylist() for k in (0, 1)]
            for i, (a, b) in enumerate(zip(*keys)):
                sets = []
                for key, column in ((a, 2), (b, 3)):
                    if key not in cache:
                        if len(cache) > 2000:
                            cache.clear()
                        cache[key] = arrays.shingle_sets(*arrays.buffer(batch.column(column).slice(i, 1)), shingle)[0]
                    sets.append(cache[key])
                common = len(np.intersect1d(*sets, assume_unique=True))
                if 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common):
                    found.append(i)
            at = pa.array(found, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Suffix filter on the cells of both sets, then the exact comparison."""
    cells = texts.select("class", "cells")
    left = pairs.join(cells.select(F.col("class").alias("a"), F.col("cells").alias("c_a")), "a")
    both = left.join(cells.select(F.col("class").alias("b"), F.col("cells").alias("c_b")), "b")
    # sets of sizes p and q with the distance d have (p + q - d) / 2 shingles in common; cells bound d from below
    total = F.aggregate(F.zip_with("c_a", "c_b", lambda x, y: x + y), F.lit(0), lambda s, x: s + x)
    distance = F.aggregate(F.zip_with("c_a", "c_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    both = both.filter((total - distance) * (100 + percent) >= 2 * percent * total).select("a", "b")
    text = texts.select("class", "text")
    both = both.join(text.select(F.col("class").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(text.select(F.col("class").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(confirmed(shingle, percent), "a bigint, b bigint")


# ---- the operator ----

def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class, component_id, class_size): one row per document."""
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n int, key bigint, seen bigint"
    facts = stored(source.mapInArrow(described(shingle), schema), "sets")
    members = facts.filter("seen = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("key").alias("class"))

    often = (facts.filter("seen > 0").groupBy("key").agg(F.sum("seen").alias("seen"))
             .filter(F.col("seen") >= FREQUENT_FROM).orderBy(F.desc("seen"), "key").limit(FREQUENT_SHINGLES).toArrow())
    values, ranks = often["key"].to_numpy().view(np.uint64), often["seen"].to_numpy()
    order = np.argsort(values)
    frequent = spark.sparkContext.broadcast((values[order], ranks[order]))

    rows = source.select("text").mapInArrow(
        prefixes(frequent, shingle, percent), "token bigint, class bigint, n int, at int, score int")
    rows = rows.repartition("token").sortWithinPartitions("token", F.desc("score"), "class").drop("score")
    shared = stored(rows.mapInArrow(
        shared_only, "token bigint, class bigint, n int, at int, pivot bigint, pivot_n int, pivot_at int"), "shared")

    def meet(pairs: DataFrame, known: DataFrame | None, whole: bool = False) -> tuple[DataFrame, DataFrame]:
        """All pairs tried so far, and the new ones among them that link."""
        pairs = possible(pairs, percent, whole)
        if known is not None:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        wanted = bitmap(spark, pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "class")
        texts = source.select("text").mapInArrow(wanted_texts(wanted, shingle), "class bigint, text string, cells array<int>")
        texts = stored(texts.dropDuplicates(["class"]), "texts")
        linked = stored(verified(pairs, texts, shingle, percent), "linked")
        return pairs if known is None else known.unionByName(pairs), linked

    def merged(labels: DataFrame, linked: DataFrame) -> DataFrame:
        """The components with the new links; those found before stand for all links up to them."""
        return components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(linked), "a", "b")

    def open_rows(labels: DataFrame) -> tuple[DataFrame, float, int]:
        """Shared rows with their component, of shingles that more than one component has; their pairs, and how many they are."""
        named = shared.select("token", "class", "n", "at").join(labels.withColumnRenamed("node", "class"), "class", "left")
        named = named.withColumn("component", F.coalesce("component", "class"))
        # prefix shingles that no other class has leave no room behind a row either: its place counts them as passed
        behind = F.row_number().over(Window.partitionBy("class").orderBy(F.desc("at")))
        named = named.withColumn("at", F.expr(f"n - ({percent} * n + 99) div 100 + 1").cast("int") - behind)
        groups = named.groupBy("token", "component").agg(F.count(F.lit(1)).alias("rows"))
        groups = groups.groupBy("token").agg(
            F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("rows"),
            F.sum(F.col("rows").cast("double") * F.col("rows")).alias("within")).filter("parts > 1")
        rows = stored(named.join(groups.select("token", "rows", "within"), "token"), "open")
        # each row of a group with r rows adds (r - within / r) / 2 pairs of different components
        left = rows.agg(F.sum((F.col("rows") - F.col("within") / F.col("rows")) / 2).alias("pairs"), F.count(F.lit(1)).alias("n")).first()
        return rows.drop("rows", "within"), left["pairs"] or 0.0, left["n"]

    first = shared.filter(F.col("class") != F.col("pivot")).withColumnsRenamed(
        {"class": "x_class", "n": "x_n", "at": "x_at", "pivot": "y_class", "pivot_n": "y_n", "pivot_at": "y_at"})
    tried, linked = meet(first.select(*oriented("x_", "y_")), None)
    labels = components(linked, "a", "b")
    rows, left, n = open_rows(labels)
    side = ("class", "n", "at", "component")
    before, turn = float("inf"), 0
    while left > PAIRS_PER_ROW * n and left < before / 2:
        before, turn = left, turn + 1
        pivot = rows.groupBy("token").agg(F.min_by(F.struct(*side), F.xxhash64("class", F.lit(turn))).alias("p"))
        met = rows.join(pivot, "token").filter(F.col("component") != F.col("p.component")).select(
            *(F.col(c).alias(f"x_{c}") for c in side), *(F.col(f"p.{c}").alias(f"y_{c}") for c in side))
        tried, linked = meet(met.select(*oriented("x_", "y_")), tried)
        labels = merged(labels, linked)
        rows, left, n = open_rows(labels)

    x = rows.select("token", *(F.col(c).alias(f"x_{c}") for c in side))
    y = rows.select("token", *(F.col(c).alias(f"y_{c}") for c in side))
    tried, linked = meet(x.join(y, "token").filter("x_component < y_component").select(*oriented("x_", "y_")), tried, whole=True)
    labels = merged(labels, linked)

    classes = members.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("class_size"))
    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    lowest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "component").select("class", "component_id", "class_size")
    filled = F.col("n_shingles") > 0
    out = members.join(named, "class", "left")
    return out.select(
        "doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), F.when(filled, F.col("class")).alias("class"),
        F.when(filled, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(filled, F.col("class_size")).otherwise(F.lit(1)).cast("bigint").alias("class_size"))


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that with the smallest id; documents without words or without an id all stay.

    A document is an id with its text: where an id stands with several texts, each of them is judged on its own, and of two
    in one component the one with the lower digest stays. Rows that repeat id and text count once, the one whose other
    columns come first in order.
    """
    own = "_document"
    while own in docs.columns:
        own += "_"
    keyed = docs.withColumn(own, F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("digest"))))
    found = join(keyed, shingle, percent, doc_id=own)
    gone = found.filter(F.col("component_id") < F.col("doc_id")).select(F.col("doc_id").alias(own))
    kept = keyed.join(gone, own, "left_anti")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    if not others:
        return kept.select("doc_id", "text").distinct()
    first = kept.groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias(own))
    return first.select(*[c if c in ("doc_id", "text") else F.col(f"{own}.`{c}`").alias(c) for c in docs.columns])
