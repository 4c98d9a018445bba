"""Windows that stay balanced whatever keys are hot: prefix scans over ranges of (key, order).

A window over (key ORDER BY t) puts all rows of a key into one task. Here every key with more rows than a range holds is cut into
ranges of its order column, the window runs per (key, range), and what has to cross the border of a range is carried over
by a table with one row per range: the scan over the borders, and then each row with what its range is given.

How ranges are found: rows are counted per key and slice of the order column (a column-pruned pass that combines before its
shuffle). A range is a run of slices with ``range_rows`` rows, or a ``MAX_RANGES``-th of the table if that is more. So at most
``MAX_RANGES`` keys can be larger than a range, and all of them together have ``2 * MAX_RANGES`` ranges at most: no hot key is
left out, and the table of borders has a proven bound, whatever the table's size. Ranges steer the layout, never the result.
A single slice is not cut; choose slices as fine as the order column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGE_ROWS = 1_000_000  # rows of one key that make a good task
MAX_RANGES = 16_384     # ranges of the whole table, if it has more rows than so many tasks hold

UNCUT = -1              # the range of all rows of a key that is not cut


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def range_starts(df: DataFrame, keys: Sequence[str], slice_by: Column, range_rows: int = RANGE_ROWS) -> list:
    """(hash, first slices of its ranges) of every key with more rows than a range."""
    sizes = df.groupBy(key_hash(keys).alias("_h"), slice_by.cast("bigint").alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    per_key = Window.partitionBy("_h")
    whole = df.groupBy(key_hash(keys).alias("_h")).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    room = max(range_rows, (whole["rows"] or 0) // MAX_RANGES)
    if (whole["most"] or 0) <= room:
        return []
    large = sizes.groupBy("_h").agg(F.sum("_n").alias("_all")).filter(F.col("_all") > room)  # MAX_RANGES rows at most
    before = F.coalesce(F.sum("_n").over(per_key.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = sizes.join(F.broadcast(large), "_h").withColumn("_range", F.floor(before / room))
    starts = cut.groupBy("_h", "_range").agg(F.min("_t").alias("_t"))
    return starts.groupBy("_h").agg(F.sort_array(F.collect_list("_t")).alias("_starts")).collect()


def with_range(df: DataFrame, keys: Sequence[str], slice_by: Column, starts: list) -> DataFrame:
    """Add ``_range``: the number of the row's range, ``UNCUT`` for keys that are not cut."""
    if not starts:
        return df.withColumn("_range", F.lit(UNCUT))
    table = df.sparkSession.createDataFrame([tuple(r) for r in starts], "_h bigint, _starts array<bigint>")
    at = slice_by.cast("bigint")
    # a null slice sorts first, as in the window
    number = F.greatest(F.size(F.filter("_starts", lambda s: s <= at)) - 1, F.lit(0))
    return (df.withColumn("_h", key_hash(keys)).join(F.broadcast(table), "_h", "left")
            .withColumn("_range", F.when(F.col("_starts").isNull(), UNCUT).when(at.isNull(), 0).otherwise(number))
            .drop("_h", "_starts"))


def carried(df: DataFrame, keys: Sequence[str], summary: Column, scan: Callable) -> DataFrame:
    """Add ``_carry``: ``scan`` over the summaries of all earlier ranges of the key; null in the first one.

    Summaries are combined on the map side; there is one per range, so their table is small by proof.
    """
    borders = df.filter(F.col("_range") != UNCUT).groupBy(*keys, "_range").agg(summary.alias("_summary"))
    earlier = Window.partitionBy(*keys).orderBy("_range")
    borders = borders.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col("_range").alias("_border"), scan(F.col("_summary"), earlier).alias("_carry"))
    same = F.col("_range") == F.col("_border")
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(F.col(f"_key_{i}"))
    return df.join(F.broadcast(borders), same, "left").drop("_border", *[f"_key_{i}" for i in range(len(keys))])


def previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str],
    slice_by: Column,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``_prev``: a struct of ``columns`` of the row before, per key; null on the first row.

    ``order_by`` must be a total order within a key, and ``slice_by`` an integer that does not decrease along it.
    """
    payload = F.struct(*columns)
    starts = range_starts(df, keys, slice_by, range_rows)
    if not starts:
        return df.withColumn("_prev", F.lag(payload).over(Window.partitionBy(*keys).orderBy(*order_by)))
    ranged = with_range(df, keys, slice_by, starts)
    last = F.max_by(payload, F.struct(*order_by))
    ranged = carried(ranged, keys, last, lambda v, earlier: F.lag(v).over(earlier))
    window = Window.partitionBy(*keys, "_range").orderBy(*order_by)
    first = F.row_number().over(window) == 1
    return ranged.withColumn("_prev", F.when(first, F.col("_carry")).otherwise(F.lag(payload).over(window))).drop("_carry", "_range")


def running(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str, kind: str, inclusive: bool, cut: bool,
) -> DataFrame:
    """Add the running ``max`` or ``sum`` of ``value`` along the order; the row itself is in if ``inclusive``.

    ``cut`` says that some keys are cut, by the column ``_range``. Rows that are equal in ``order_by`` may stand in either order.
    """
    whole = {"max": F.max, "sum": F.sum}[kind]
    if not cut:
        inside = Window.partitionBy(*keys).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        return df.withColumn(name, whole(value).over(inside))
    valued = carried(df.withColumn("_value", value), keys, whole("_value"),
                     lambda v, earlier: whole(v).over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy(*keys, "_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    own = whole("_value").over(inside)
    if kind == "max":
        both = F.greatest(own, F.col("_carry"))
    else:
        both = F.coalesce(own, F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0))
    return valued.withColumn(name, both).drop("_carry", "_value")
