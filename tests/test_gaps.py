"""Gaps that the given tables do not have: imputation, default shares, filling, and vectors with missing months."""

from berthlake import fixed_values as fv
from berthlake.operators import panel as pn, series
from berthlake.plans import forecast as fc


def test_occupancy_from_the_history_mean(spark):
    ops = spark.createDataFrame([("a", y, p) for y in (2024, 2025, 2026) for p in (1, 2)], "terminal_id string, year int, period int")
    occ = spark.createDataFrame([("a", 2024, 1, 10.0), ("a", 2025, 1, 30.0), ("a", 2026, 2, 70.0)],
                                "terminal_id string, year int, period int, berth_occupancy double")
    out = pn.impute_occupancy(pn.join_occupancy(ops, occ), occ, 2026).collect()
    got = {(r["year"], r["period"]): r["berth_occupancy"] for r in out}
    none = fv.OCCUPANCY_LAST_RESORT  # no earlier year has the second period
    assert got == {(2024, 1): 10.0, (2025, 1): 30.0, (2026, 1): 20.0, (2024, 2): none, (2025, 2): none, (2026, 2): 70.0}


def test_share_of_a_month_without_a_ratio(spark):
    ops = spark.createDataFrame([("a", 2025, m) for m in (1, 4, 13)], "terminal_id string, year int, month int")
    ratios = spark.createDataFrame([(2025, 1, 12.5)], "year int, month int, transship_ratio double")
    got = {r["month"]: r["transship_ratio"] for r in pn.join_transship(ops, ratios).collect()}
    assert got == {1: 12.5, 4: fv.TRANSSHIP_DEFAULTS.get(4, fv.TRANSSHIP_LAST_RESORT), 13: fv.TRANSSHIP_LAST_RESORT}


def test_fill_forward_then_backward(spark):
    values = {"a": [None, None, 3.0, None, 5.0, None], "b": [None, None], "c": [1.0, None]}
    rows = [(t, i, v) for t, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "terminal_id string, idx int, v double")
    got = {(r["terminal_id"], r["idx"]): r["v"] for r in series.forward_backward_fill(df, ["v"], series.by_terminal()).collect()}
    want = {"a": [3.0, 3.0, 3.0, 3.0, 5.0, 5.0], "b": [None, None], "c": [1.0, 1.0]}
    assert got == {(t, i): v for t, vs in want.items() for i, v in enumerate(vs)}


def test_vectors_with_a_missing_month(spark):
    df = spark.createDataFrame([("a", "Flat", 2025 * 12 + 10, [1, None, 3])], "terminal_id string, scenario string, first_idx int, volumes array<int>")
    got = [(r["year"], r["month"], str(r["month_date"]), r["volume"]) for r in fc.forecast_long(df).orderBy("month_date").collect()]
    assert got == [(2025, 11, "2025-11-01", 1), (2026, 1, "2026-01-01", 3)]


def test_row_json_escapes_every_control_character(spark):
    import json

    from berthlake.operators import bronze

    texts = ["plain", 'a"b\\c', "tab\there", "line\r\nnext", *(f"x{chr(i)}y" for i in range(32)), "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = df.select("v", bronze.row_json(bronze.json_names(bronze.F.array(bronze.F.lit("n\t1"))), bronze.F.array("v")).alias("j")).collect()
    for r in got:
        assert r["j"] == json.dumps({"n\t1": r["v"] if r["v"] is not None else float("nan")})


def test_stays_without_a_berth_are_never_busy(spark):
    from berthlake.operators import intervals

    calls = spark.createDataFrame(
        [("t", "1", "2024-04-01 00:00:00", "2024-04-04 00:00:00"), ("t", None, "2024-04-01 00:00:00", "2024-04-11 00:00:00"),
         ("u", None, "2024-04-02 00:00:00", "2024-04-03 00:00:00")], "terminal_id string, berth string, eta string, etd string")
    calls = calls.selectExpr("terminal_id", "berth", "CAST(eta AS timestamp_ntz) AS eta", "CAST(etd AS timestamp_ntz) AS etd")
    got = {r["terminal_id"]: round(r["berth_occupancy"], 6) for r in intervals.berth_occupancy(calls).collect()}
    assert got == {"t": 5.0, "u": 0.0}  # 3 of 2 x 30 days; the berth that nobody knows is there, and empty
