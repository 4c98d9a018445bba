"""Windows over ranges against brute force, with one key holding most rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from berthlake.operators import intervals, skew


def make_rows(n=3000):
    rnd = random.Random(7)
    return [("hot" if i % 3 else f"k{rnd.randrange(200)}", i, rnd.randrange(10_000), rnd.randrange(5)) for i in range(n)]


def previous_by_hand(rows):
    want, last = {}, {}
    for k, i, t, v in sorted(rows, key=lambda r: (str(r[0]), r[2], r[1])):
        want[i] = last.get(k)
        last[k] = (v, i)
    return want


def previous_of(out):
    return {r.id: (None if r._prev is None else (r._prev.v, r._prev.id)) for r in out.collect()}


def test_keys_larger_than_a_range_are_cut(spark):
    df = spark.createDataFrame(make_rows(), "k string, id int, t int, v int")
    assert skew.range_starts(df, ["k"], F.col("t"), range_rows=3000) == []
    starts = skew.range_starts(df, ["k"], F.col("t"), range_rows=500)
    assert [r["_h"] for r in starts] == [df.select(F.xxhash64("k").alias("h")).where("k = 'hot'").first().h]
    sizes = skew.with_range(df, ["k"], F.col("t"), starts).groupBy("k", "_range").count().collect()
    hot = [r["count"] for r in sizes if r["k"] == "hot"]
    assert len(hot) == 4 and max(hot) <= 500 + 10 and all(r["_range"] == skew.UNCUT for r in sizes if r["k"] != "hot")


def test_previous_row_across_ranges(spark):
    rows = make_rows() + [(None, 9000 + i, i // 3, i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, id int, t int, v int")
    for range_rows in (1, 7, 50, 10**6):
        assert previous_of(skew.previous_row(df, ["k"], ["t", "id"], ["v", "id"], F.col("t"), range_rows)) == previous_by_hand(rows)


def test_a_thousand_hot_keys_are_all_cut(spark):
    rows = [(f"k{i % 1000}", i, i // 1000 * 7 % 97, i % 5) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k string, id int, t int, v int").cache()
    starts = skew.range_starts(df, ["k"], F.col("t"), range_rows=5)
    assert len(starts) == 1000 and all(len(r["_starts"]) == 4 for r in starts)
    ranged = skew.with_range(df, ["k"], F.col("t"), starts)
    assert ranged.groupBy("k", "_range").count().agg(F.max("count")).first()[0] <= 5
    assert previous_of(skew.previous_row(df, ["k"], ["t", "id"], ["v", "id"], F.col("t"), 5)) == previous_by_hand(rows)
    plan = skew.previous_row(df, ["k"], ["t", "id"], ["v"], F.col("t"), 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in plan and "_range" in plan
    df.unpersist()


def test_the_number_of_ranges_is_bounded_by_the_table(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_RANGES", 10)
    df = spark.createDataFrame(make_rows(), "k string, id int, t int, v int")
    starts = skew.range_starts(df, ["k"], F.col("t"), range_rows=1)
    assert len(starts) == 1 and sum(len(r["_starts"]) for r in starts) <= 20


def test_islands_cover_the_same_time(spark):
    rnd, start = random.Random(3), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        a = start + dt.timedelta(minutes=rnd.randrange(60 * 24 * 40))
        rows.append(("hot" if i % 3 else f"b{rnd.randrange(30)}", a, a + dt.timedelta(minutes=rnd.randrange(0, 300))))
    df = spark.createDataFrame(rows, "berth string, eta timestamp_ntz, etd timestamp_ntz")
    want = set()
    for berth in {r[0] for r in rows}:
        current = None
        for _, a, b in sorted(r for r in rows if r[0] == berth):
            if current and a <= current[1]:
                current[1], current[2] = max(current[1], b), current[2] + 1
            else:
                if current:
                    want.add((berth, *current))
                current = [a, b, 1]
        want.add((berth, *current))
    for options in ({}, {"range_rows": 20}, {"range_rows": 3}):
        got = {(r.berth, r.eta, r.etd, r.interval_count) for r in intervals.interval_islands(df, ["berth"], **options).collect()}
        assert got == want
