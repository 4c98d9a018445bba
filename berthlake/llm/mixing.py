"""Mixing sources to target weights by temperature, in DataFrame functions only.

Source s with the token share p(s) gets the weight p(s)**a / sum p**a. The exponent a in [0, 1] is bisected: it is the
smallest at which no source is repeated more often than the limit, or the largest at which the weights still have the
wanted entropy; with both, the larger of the two. Weights times the whole budget are the sources' budgets in tokens.

Budgets become block permutations: a source's documents are passed over in epochs, each a permutation by digest. Full epochs
take every document; the last, partial one takes documents in its order while the budget lasts, so a source exceeds its
budget by less than one document. The epochs of a source are spread evenly over the blocks of the mixture; ``mix_order`` is
the place inside a block.

Without a budget the smallest one is used at which every source is passed over once in full, so that no document is lost and
small sources are repeated. A document counts one token at least. Edge cases: null and empty texts count one token; a
null source is the source ``''``; repeated rows are rows of their own; an empty table gives no rows; added columns
replace input columns of the same names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from berthlake.llm.columns import sets_aside
from berthlake.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1 << 20
SLICE_ROWS = 10_000     # rows of a source whose running sum one task takes
SECTIONS, ROUNDS = 32, 8


def token_count(text: Column) -> Column:
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint"), F.lit(1).cast("bigint"))


def digits(*parts: Column | str) -> Column:
    """The first 52 bits of a digest."""
    texts = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, 13), 16, 10).cast("bigint")


def place(*parts: Column | str) -> Column:
    """A number in [0, 1)."""
    return digits(*parts).cast("double") / float(1 << 52)


def exponent(stats: DataFrame, max_repeats: float | None, entropy: float | None) -> float:
    """Bisection in sections: each round tries 33 exponents in one aggregate over the sources and keeps one section."""
    total = stats.agg(F.sum("tokens")).first()[0]
    if not total or (max_repeats is None and entropy is None):
        return 1.0
    log_share = F.ln(F.col("tokens") / F.lit(float(total)))

    def tried(low: float, high: float) -> list:
        grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
        rows = stats.select(log_share.alias("l"), F.explode(F.array(*map(F.lit, grid))).alias("a"))
        power = F.exp(F.col("a") * F.col("l"))
        found = rows.groupBy("a").agg(
            F.sum(power).alias("z"), F.sum(power * F.col("l")).alias("zl"), F.count(F.lit(1)).alias("n"),
            ((1 - F.col("a")) * (F.max("l") - F.min("l"))).alias("spread"))
        return sorted(found.collect(), key=lambda r: r["a"])  # 33 rows

    def search(low_enough) -> float:
        """The smallest exponent for which ``low_enough`` holds; it holds from some exponent on."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            rows = tried(low, high)
            at = next((i for i, r in enumerate(rows) if low_enough(r)), len(rows) - 1)
            low, high = (rows[at - 1]["a"] if at else rows[0]["a"]), rows[at]["a"]
            if low == high:
                break
        return high

    out = 0.0
    if max_repeats is not None:
        out = search(lambda r: r["spread"] <= math.log(max_repeats) + 1e-12)
    if entropy is not None:  # as a share of the highest
        out = max(out, search(lambda r: math.log(r["z"]) - r["a"] * r["zl"] / r["z"] <= entropy * math.log(max(r["n"], 1)) + 1e-12))
    return out


def source_budgets(sized: DataFrame, budget: int | None, max_repeats: float | None, entropy: float | None) -> DataFrame:
    """(source, rows, tokens, weight, budget): one row per source."""
    stats = stored(sized.groupBy("_source").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("tokens")), "sources")
    a = exponent(stats, max_repeats, entropy)
    sums = stats.agg(F.sum("tokens").alias("t"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(a))).alias("z")).first()
    weight = F.pow(F.col("tokens").cast("double"), F.lit(a)) / F.lit(sums["z"] or 1.0)
    stats = stats.withColumn("weight", weight)
    if budget is None:
        whole = stats.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    else:
        whole = float(budget)
    return stats.withColumn("budget", F.floor(F.col("weight") * F.lit(whole) + 0.5))


@sets_aside("_source", "_tokens", "_budget", "_full", "_rest", "_slices", "_u", "_slice", "_sum", "_first", "_before")
def mix(docs: DataFrame, budget: int | None = None, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: str = "mix", key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of the mixture: the input's columns, with ``n_tokens``, ``epoch``, ``block`` and ``mix_order``."""
    sized = docs.withColumns({"n_tokens": token_count(F.col(text)), "_source": F.coalesce(F.col(source).cast("string"), F.lit(""))})
    budgets = source_budgets(sized.select("_source", "n_tokens"), budget, max_repeats, entropy)
    blocks = F.greatest(F.ceil(F.lit((budgets.agg(F.sum("budget")).first()[0] or 0) / block_tokens)), F.lit(1))
    plan = budgets.select(
        "_source", F.col("tokens").alias("_tokens"), F.col("budget").alias("_budget"), F.expr("budget div tokens").alias("_full"),
        (F.col("budget") % F.col("tokens")).alias("_rest"), F.ceil(F.col("rows") / SLICE_ROWS).alias("_slices"))
    rows = sized.join(plan, "_source")
    rows = rows.withColumn("_u", place(seed, F.col("_full"), F.col(key)))
    rows = rows.withColumn("_slice", F.floor(F.col("_u") * F.col("_slices")))
    # running sums of the partial epoch: inside slices, and over the slices' totals
    totals = rows.groupBy("_source", "_slice").agg(F.sum("n_tokens").alias("_sum"))
    over = Window.partitionBy("_source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("_source", "_slice", F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_source", "_slice").orderBy("_u", F.col(key), "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(firsts, ["_source", "_slice"])
    times = F.col("_full") + (F.col("_first") + F.col("_before") < F.col("_rest")).cast("int")
    rows = rows.withColumn("epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times - 1))))
    u = F.when(F.col("epoch") == F.col("_full"), F.col("_u")).otherwise(place(seed, F.col("epoch"), F.col(key)))
    at = (F.col("epoch") + u) * F.col("_tokens") / F.col("_budget")
    rows = rows.withColumn("block", F.least(F.floor(at * blocks), blocks - 1))
    rows = rows.withColumn("mix_order", digits(seed, F.col("block"), F.col("epoch"), F.col(key)))
    return rows.drop("_source", "_tokens", "_budget", "_full", "_rest", "_slices", "_u", "_slice", "_sum", "_first", "_before")
