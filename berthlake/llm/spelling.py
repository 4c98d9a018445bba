"""Spelling variants of words by pivotal grams.

Words are maximal runs of letters; some occurrences lose a letter by a digest of document and run, which plants variants.
Two words are near if one inserted, deleted or replaced code point makes them equal.

1. Runs are counted inside each task and summed by word. The bigrams of a word are ordered rare-first by how many words have
   them; there are at most 90 x 90 of them, as the alphabet has 26 + 64 letters.
2. A word's prefix is its three first grams in that order (with all places of the last one). One edit touches
   at most two neighbouring grams, so of two words that are near, the one whose prefix ends earlier in the order keeps one of
   two disjoint prefix grams, and that gram is in the other's prefix. Dynamic programming over the prefix in text order
   chooses the two disjoint grams, the pivots, with the least words in all.
3. Position limits: the edit lies right of the first pivot or left of the second one, as they are disjoint. In the first
   case both words are equal up to the pivot's end, in the second one from the pivot's start. So each pivot is met by an equi-join
   on that side of the word, which holds gram and place, against the same sides of the other words' prefix grams.
4. Verification: lengths differ by one at most, the prefix ends in the right order, at most two letters are in one word
   alone (by a bitmap of letters, which settles nearly all candidates), and the edit distance is one.

A word's form is its near word of the largest count, if that is at least ``ratio`` times its own. Roots follow forms to the
end by pointer doubling: counts rise by the ratio on the way, so few rounds are needed.

Edge cases: null and empty texts have no words; a null id counts as the empty string; repeated rows count each; a word
without near words is its own root; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from berthlake.llm.storage import stored

# fixed values: letters, the divisor that marks changed runs, least length and count, and how much more frequent a form is
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")  # a-z and U+00C0 to U+00FF in UTF-8, after lower-casing A-Z
CHANGED = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10

GRAM = 2
EDITS = 1
HELD_WORDS = 1 << 17


def counted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (id as text, text): words with their counts in this task, handed on whenever very many are held."""
    total: Counter = Counter()

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        ids, texts = (batch.column(k).cast(pa.large_binary()) for k in (0, 1))
        for own, text in zip(ids, texts):
            start = zlib.crc32(own.as_py() + b":")
            for run, times in Counter(RUN.findall(text.as_py().lower())).items():
                if len(run) < LEAST_LENGTH:
                    continue
                length = len(run) - run.count(b"\xc3")
                digest = zlib.crc32(run, start)
                if digest % CHANGED == 0:
                    letters = run.decode()
                    at = digest % length
                    run = (letters[:at] + letters[at + 1:]).encode()
                    length -= 1
                if length >= LEAST_LENGTH:
                    total[run] += times
            if len(total) >= HELD_WORDS:
                yield given()
                total.clear()
    if total:
        yield given()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words found often enough."""
    read = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = read.mapInArrow(counted_runs, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def pivots(prefix: list[tuple[int, int]], count: int) -> list[int]:
    """Places of ``count`` disjoint grams with the least weight in all, from (place, weight) in text order.

    ``best[k]`` is the cheapest choice of k grams among those seen so far; a gram extends the choices made
    among the grams that end before it.
    """
    seen = [(0, ())] + [None] * count
    history = [list(seen)]
    ends = []
    for at, weight in prefix:
        before = sum(e <= at for e in ends)  # grams that end before this one, a beginning of the list
        for k in range(count, 0, -1):
            base = history[before][k - 1]
            if base is not None:
                taken = (base[0] + weight, base[1] + (at,))
                seen[k] = taken if seen[k] is None else min(seen[k], taken)
        ends.append(at + GRAM)
        history.append(list(seen))
    return list(seen[count][1])


def letters(word: str) -> int:
    """Bitmap of the letters, as a signed integer; letters that share a bit make it coarser."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (bits >> 63 << 64)


def sides(order: dict[str, int], weights: dict[str, int]):
    """Batches of (word, n): letters, prefix end, the sides of the two pivots, and the sides of all prefix grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps, ends, chosen, offered = [], [], [], []
            for word in batch.column(0).to_pylist():
                grams = [word[k: k + GRAM] for k in range(len(word) - GRAM + 1)]
                ranks = [order[g] for g in grams]
                last = sorted(ranks)[GRAM * EDITS]
                prefix = [(k, weights[g]) for k, (g, r) in enumerate(zip(grams, ranks)) if r <= last]
                first, second = pivots(prefix, EDITS + 1)
                maps.append(letters(word))
                ends.append(last)
                chosen.append(["<" + word[: first + GRAM], ">" + word[second:]])
                offered.append([s for k, _ in prefix for s in ("<" + word[: k + GRAM], ">" + word[k:])])
            texts = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(maps, pa.int64()), pa.array(ends, pa.int32()), pa.array(chosen, texts), pa.array(offered, texts)],
                names=["word", "n", "letters", "last", "pivots", "grams"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, m): both directions of every pair of near words, once each."""
    grams = words.select(F.explode(F.expr(f"transform(sequence(1, length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))")).alias("gram"), "word")
    # at most 90 x 90 rows
    rows = sorted((r["c"], r["gram"]) for r in grams.groupBy("gram").agg(F.count_distinct("word").alias("c")).collect())
    order = {gram: k for k, (_, gram) in enumerate(rows)}
    keyed = stored(words.mapInArrow(
        sides(order, {gram: c for c, gram in rows}), "word string, n bigint, letters bigint, last int, pivots array<string>, grams array<string>"), "grams")
    own = keyed.select(F.explode("pivots").alias("side"), "word", "n", "letters", "last")
    others = keyed.select(F.explode("grams").alias("side"), F.col("word").alias("other"), F.col("n").alias("m"),
                          F.col("letters").alias("theirs"), F.col("last").alias("end"))
    met = own.join(others, (own["side"] == others["side"]) & (F.col("last") <= F.col("end"))
                   & (F.bit_count(F.col("letters").bitwiseXOR(F.col("theirs"))) <= 2 * EDITS)
                   & (F.abs(F.length("word") - F.length("other")) <= EDITS) & (F.levenshtein("word", "other", EDITS) == EDITS))
    one, two = F.struct("word", "n"), F.struct(F.col("other").alias("word"), F.col("m").alias("n"))
    pairs = met.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y")).distinct()
    both = F.explode(F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return pairs.select(both.alias("p")).select("p.x.word", "p.x.n", F.col("p.y.word").alias("other"), F.col("p.y.n").alias("m"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: each round doubles the steps followed."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "roots")
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """``word``, ``n``, ``n_near`` (its near words), ``form``, ``form_n`` and ``root`` of every word."""
    words = stored(word_counts(docs, key, text), "words")
    near = near_pairs(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    fits = -F.col("best.less") >= ratio * F.col("n")
    near = stored(near.select("word", "n_near", F.when(fits, F.col("best.other")).alias("form"),
                              F.when(fits, -F.col("best.less")).alias("form_n")), "near")
    ends = roots(near.filter(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
