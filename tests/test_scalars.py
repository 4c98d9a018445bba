"""Edge cases of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import Row, functions as F

from berthlake.functions import text, time as bt
from berthlake.operators import changes, filters, intervals, series
from berthlake.plans import gold


def values(spark, schema, rows, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expr).collect()]


def test_strict_workload(spark):
    rows = [("1,015 / 960 / 12",), ("10／20｜30",), ("a/2/3",), ("",), (None,), ("7|8",)]
    got = [tuple(r) if r else None for r in values(spark, "v string", rows, text.workload_strict("v"))]
    assert got == [(1015, 960, 12), (10, 20, 30), (None, 2, 3), (None,) * 3, (None,) * 3, (7, 8, None)]


def test_lenient_workload(spark):
    rows = [("10 20",), ("x",), (None,), ("1,015/96a/",), ("5/6/7",)]
    got = [tuple(r) for r in values(spark, "v string", rows, text.workload_lenient("v"))]
    assert got == [(10, 20, 0), (0, 0, 0), (0, 0, 0), (1015, 96, 0), (5, 6, 7)]


def test_ints_and_tokens(spark):
    rows = [(" 1,200 ",), ("12.0",), ("-",), ("-5",), ("99999999999",), (None,)]
    assert values(spark, "v string", rows, text.int_or_null("v")) == [1200, None, None, -5, None, None]
    rows = [(" x\t",), ("nan",), ("None",), ("",), ("　",)]
    assert values(spark, "v string", rows, text.clean_token("v")) == ["x", None, None, None, None]


def test_operational_date(spark):
    rows = [(dt.datetime(2024, 5, 1, 5, 59),), (dt.datetime(2024, 5, 1, 6, 0),)]
    assert values(spark, "v timestamp_ntz", rows, bt.operational_date("v")) == [dt.date(2024, 4, 30), dt.date(2024, 5, 1)]


def test_timestamps(spark):
    rows = [("2026-06-26 10:05",), ("2026/6/2 9:05",), ("2026.06.26 10:05:07",), ("20260626 10:00",), ("-",), (None,)]
    assert values(spark, "v string", rows, bt.parse_ts("v")) == [
        dt.datetime(2026, 6, 26, 10, 5), dt.datetime(2026, 6, 2, 9, 5), dt.datetime(2026, 6, 26, 10, 5, 7),
        dt.datetime(2026, 6, 26, 10, 0), None, None]


def test_keys(spark):
    schema = ("terminal_id string, mother_vessel string, vessel_name string, sun_vessel string, route string, carrier string, "
              "discharge int, loading int, eta_work_date string")
    rows = [
        ("t", "M", "V", "S", "R", "C", 1, 2, "d"), ("t", " ", "V", "S", "R", "C", 1, 2, "d"), ("t", None, "", "S", "R", "C", 1, 2, "d"),
        ("t", None, None, None, "R", "C", 1, 2, "d"), ("t", None, None, None, "", "C", None, 2, None), ("t", None, None, None, None, None, 1, None, "d")]
    assert values(spark, schema, rows, text.gold_key()) == [
        "MV_M_d", "VN_V_d", "SV_S_d", "RT_R_d", "WEAK_C_0_2_UNKNOWN_DATE", "UNKNOWN_1_0_d"]
    assert values(spark, schema, rows, text.gold_key_type()) == [
        "mother_vessel", "vessel_name", "sun_vessel", "route", "weak_carrier_workload", "unknown"]
    assert values(spark, schema, rows[3:4], text.business_key()) == ["t_d"]


def test_hours_covered(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2024, 1, 1, 5, 10))]
    assert values(spark, "a timestamp_ntz, b timestamp_ntz", rows, F.size(bt.hours_covered("a", "b"))) == [6]


def test_stay_limit(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(h, start, start + dt.timedelta(hours=h)) for h in (239.99, 240.0, -1.0, 0.0)]
    df = spark.createDataFrame(rows, "h double, eta timestamp_ntz, etd timestamp_ntz")
    assert {r.h for r in filters.filter_outlier_stays(df).collect()} == {239.99, 0.0}
    assert {r.h for r in filters.filter_outlier_stays(df, non_negative=False).collect()} == {239.99, -1.0, 0.0}


def test_biweek(spark):
    days = [(dt.date(2024, 1, 1),), (dt.date(2024, 12, 23),), (dt.date(2020, 12, 31),)]  # ISO weeks 1, 52, 53
    assert values(spark, "v date", days, bt.biweek("v")) == [1, 26, 26]


def test_islands_touch(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([("b", at(1), at(3)), ("b", at(3), at(5)), ("b", at(6), at(7))], "berth string, eta timestamp_ntz, etd timestamp_ntz")
    got = sorted((r.eta.hour, r.etd.hour, r.interval_count) for r in intervals.interval_islands(df, ["berth"]).collect())
    assert got == [(1, 5, 2), (6, 7, 1)]


@pytest.mark.parametrize("null_safe, detail", [(True, "closing_change"), (False, "else_change")])
def test_null_to_value(spark, null_safe, detail):
    base = dict(gold_key="k", snapshot_id="s", parsed_at=None, terminal_id="t", berth="b", eta=None, etd=None, discharge=1, loading=1, shift=1)
    rows = [Row(**base, closing=None, row_hash="1", snapshot_ts=dt.datetime(2024, 1, 1), bronze_row_id="1"),
            Row(**base, closing=dt.datetime(2024, 1, 1, 10), row_hash="2", snapshot_ts=dt.datetime(2024, 1, 2), bronze_row_id="2")]
    schema = ("gold_key string, snapshot_id string, parsed_at timestamp_ntz, terminal_id string, berth string, eta timestamp_ntz, "
              "etd timestamp_ntz, discharge int, loading int, shift int, closing timestamp_ntz, row_hash string, snapshot_ts timestamp_ntz, bronze_row_id string")
    out = changes.change_history(spark.createDataFrame(rows, schema), null_safe=null_safe).collect()
    assert {(r.change_type, r.change_detail) for r in out} == {("NEW", "new_schedule"), ("CHANGED", detail)}


def test_trend_is_clamped(spark):
    rows = [(0.1, 1.0), (1.3, 1.0), (9.0, 1.0), (1.0, 0.0)]
    assert values(spark, "a double, b double", rows, series.clamp_trend(F.col("a"), F.col("b"))) == [0.5, 1.3, 2.0, 1.0]


def test_year_wrap_and_gap(spark):
    """Lags go by calendar: a missing month falls back, it does not shift the others."""
    rows = [("t", y * 12 + m - 1, m, m, float(100 * y + m)) for y in (1, 2) for m in range(1, 13) if (y, m) != (1, 2)]
    df = spark.createDataFrame(rows, "terminal_id string, idx int, period int, month int, volume double")
    out = {r.idx: r for r in series.trend_features(df).collect()}
    mean = sum(r[4] for r in rows) / len(rows)
    jan, feb, dec = out[2 * 12], out[2 * 12 + 1], out[2 * 12 + 11]
    assert jan.yoy == 101.0 and dec.yoy == 112.0
    assert feb.yoy == pytest.approx(mean * 0.9362)
    assert dec.rolling_yoy == pytest.approx((201 + 112 + 111) / 3)          # t-11 is January of the same year
    assert jan.rolling_yoy == pytest.approx((mean * 0.9362 + 101 + mean * 0.9870) / 3)


def test_month_text(spark):
    columns = ", ".join(f"{c} string" for c in ["year", "month", *gold.MEASURES])
    rows = [("2024", m, *["1,000"] * 10) for m in ("1", "합계", "13", "12")]
    got = gold.monthly_container(spark.createDataFrame(rows, columns)).collect()
    assert sorted((r.month, r.total_container) for r in got) == [(1, 2000.0), (12, 2000.0)]
    assert dict(spark.createDataFrame(rows, columns).dtypes)["month"] == "string"


def test_history_sorts_before_live(spark):
    rows = [("hist_3_2024",), ("3_20240102_10",), ("odd",)]
    assert values(spark, "snapshot_id string", rows, gold.snapshot_time()) == [
        dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 10), None]


def test_zero_padded_never_cuts(spark):
    from pyspark.sql import functions as F

    from berthlake.functions import text

    rows = spark.createDataFrame([(7,), (123,), (12345678901,), (None,)], "n bigint")
    assert [r[0] for r in rows.select(text.zero_padded(F.col("n"), 2)).collect()] == ["07", "123", "12345678901", None]


def test_ensemble_beyond_integers(spark):
    from pyspark.sql import functions as F

    from berthlake.plans.forecast import ensemble

    row = spark.range(1).select(ensemble(F.lit(3e9), F.lit(3e9)), ensemble(F.lit(-5.0), F.lit(1.0))).first()
    assert tuple(row) == (3_000_000_000, 0)
