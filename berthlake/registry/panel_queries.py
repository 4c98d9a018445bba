"""Monthly volumes, freight index, panels and the forecast features."""

from __future__ import annotations

from pyspark.sql import functions as F

from berthlake import fixed_values as fv, testbed as tb
from berthlake.functions import time as bt
from berthlake.operators import filters, intervals, panel as pn, series
from berthlake.plans import features as fp, gold
from berthlake.registry import query
from berthlake.session import scratch_path
from berthlake.sinks import tables as sinks
from berthlake.sources import tables

# the training window of the given tables: four full years and half a year
WINDOW = filters.TrainingWindow(
    1997, 2001, 6, (filters.Exclusion("terminal_6", year=1997), filters.Exclusion("terminal_7", before="2000-07-01")))
CUT = 2001
CORRECTIONS = (("terminal_1", 2001, 6, 1.25),)
# added before rounding, so that a sum that differs in the last bit does not flip a tie
EPSILON = "1e-9"


def sql_case(values, key):
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + " END"


BASE_SQL = tb.CALLS_SQL + """,
deduped AS (
  SELECT * FROM calls WHERE is_valid AND eta IS NOT NULL AND etd IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY terminal_id, berth, vessel_name, eta ORDER BY snapshot_id DESC, bronze_row_id DESC) = 1),
base AS (
  SELECT *, coalesce(discharge, 0) + coalesce(loading, 0) AS volume, CAST(year(etd) AS INT) AS year, CAST(month(etd) AS INT) AS month,
    CAST(least(26, greatest(1, (weekofyear(etd) - 1) // 2 + 1)) AS INT) AS biweek
  FROM deduped
  WHERE stay_hours < 240 AND NOT coalesce(regexp_matches(upper(vessel_name), 'STORAGE|DUMMY|공컨|테스트|TEST'), false)
    AND NOT upper(status) IN ('CANCELLED', 'CANCELED')
    AND (year(etd) BETWEEN 1997 AND 2000 OR (year(etd) = 2001 AND month(etd) <= 6))
    AND NOT (terminal_id = 'terminal_6' AND year(etd) = 1997)
    AND NOT (terminal_id = 'terminal_7' AND etd < TIMESTAMP '2000-07-01'))"""


def occupancy_sql(period, denominator):
    return f"""
occ_marked AS (
  SELECT *, CASE WHEN eta <= max(etd) OVER (PARTITION BY terminal_id, year, {period}, berth ORDER BY eta, etd
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM base),
occ_numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY terminal_id, year, {period}, berth ORDER BY eta, etd ROWS UNBOUNDED PRECEDING) AS island
  FROM occ_marked),
occ_islands AS (
  SELECT terminal_id, year, {period} AS period, berth, epoch(max(etd)) - epoch(min(eta)) AS busy
  FROM occ_numbered GROUP BY terminal_id, year, {period}, berth, island),
occ AS (
  SELECT terminal_id, year, period, sum(CASE WHEN berth IS NULL THEN 0 ELSE busy END) / 3600
    / ((count(DISTINCT berth) + max(CASE WHEN berth IS NULL THEN 1 ELSE 0 END)) * {denominator} * 24.0) * 100 AS berth_occupancy
  FROM occ_islands GROUP BY terminal_id, year, period)"""


OCC_SQL = occupancy_sql("month", "day(last_day(make_date(year, period, 1)))")
OCC_BIWEEK_SQL = occupancy_sql("biweek", "14")


def ops_sql(period, per_year, month):
    return f"""
ops AS (
  SELECT terminal_id, year, {period} AS period, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(shift) AS BIGINT) AS shift_count,
    count(vessel_name) AS vessel_count, avg(stay_hours) AS avg_dwell, count(DISTINCT carrier) AS carrier_count,
    count(DISTINCT route) AS route_count, CAST({month} AS INT) AS month,
    CASE WHEN sum(volume) <> 0 THEN sum(shift) / sum(volume) * 100 ELSE 0 END AS shift_ratio,
    CAST(year * {per_year} + {period} - 1 AS INT) AS idx
  FROM base GROUP BY terminal_id, year, {period}),
scaled AS (
  SELECT * REPLACE (
    volume * CASE WHEN terminal_id = 'terminal_1' AND year = 2001 AND period = 6 THEN 1.25 ELSE 1.0 END::DOUBLE AS volume,
    round_even(vessel_count * CASE WHEN terminal_id = 'terminal_1' AND year = 2001 AND period = 6 THEN 1.25 ELSE 1.0 END::DOUBLE, 0) AS vessel_count)
  FROM ops)"""


OPS_SQL = ops_sql("month", 12, "max(month)")
OPS_BIWEEK_SQL = ops_sql("biweek", 26, "floor(quantile_cont(month, 0.5))")
RATIO_SQL = tb.MONTHLY_SQL + """,
ratios AS (
  SELECT year, month, CASE WHEN import_total + export_total + transship_total > 0
    THEN transship_total / (import_total + export_total + transship_total) * 100 ELSE 0 END AS transship_ratio FROM monthly)"""


def index_sql(period):
    return tb.INDEX_SQL + f""",
index_m AS (
  SELECT 'SCFI' AS category, CAST(year(index_date) AS INT) AS year, CAST({period} AS INT) AS period, avg(index_value) AS index_raw
  FROM freight GROUP BY 2, 3),
index_c AS (
  SELECT *, coalesce((index_raw - lag(index_raw) OVER w) / lag(index_raw) OVER w * 100, 0) AS index_mom
  FROM index_m WINDOW w AS (ORDER BY year, period))"""


INDEX_M_SQL = index_sql("month(index_date)")
INDEX_BIWEEK_SQL = index_sql("least(26, greatest(1, (weekofyear(index_date) - 1) // 2 + 1))")
TRANS_DEFAULT = sql_case(fv.TRANSSHIP_DEFAULTS, "month")


def panel_sql(grain):
    per_year, recent = (12, 3) if grain == "month" else (26, 6)
    parts = (OCC_SQL, OPS_SQL, INDEX_M_SQL) if grain == "month" else (OCC_BIWEEK_SQL, OPS_BIWEEK_SQL, INDEX_BIWEEK_SQL)

    def default(shift):
        month = f"((idx + {shift}) % 12 + 1)" if grain == "month" else "month"
        return f"mean_volume * {sql_case(fv.SEASON_WEIGHTS, month)}"

    return f"""{BASE_SQL}, {parts[0]}, {parts[1]}, {RATIO_SQL}, {parts[2]},
occ_mean AS (SELECT terminal_id, period, avg(berth_occupancy) AS occ_mean FROM occ WHERE year < {CUT} GROUP BY 1, 2),
joined AS (
  SELECT s.*, coalesce(o.berth_occupancy, om.occ_mean, 50.0) AS berth_occupancy,
    coalesce(r.transship_ratio, {TRANS_DEFAULT.replace("CASE month", "CASE s.month")}, 64.0) AS transship_ratio,
    i.index_raw AS raw0, i.index_mom AS mom0
  FROM scaled s LEFT JOIN occ o USING (terminal_id, year, period) LEFT JOIN occ_mean om USING (terminal_id, period)
  LEFT JOIN ratios r ON r.year = s.year AND r.month = s.month LEFT JOIN index_c i ON i.year = s.year AND i.period = s.period),
filled AS (
  SELECT *, coalesce(last_value(raw0 IGNORE NULLS) OVER b, first_value(raw0 IGNORE NULLS) OVER a) AS index_raw,
    coalesce(last_value(mom0 IGNORE NULLS) OVER b, first_value(mom0 IGNORE NULLS) OVER a) AS index_mom,
    ({sql_case(fv.SEASON_WEIGHTS, "month")})::DOUBLE AS weight,
    sin(2 * pi() * period / {per_year}) AS season_sin, cos(2 * pi() * period / {per_year}) AS season_cos
  FROM joined WINDOW b AS (PARTITION BY terminal_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY terminal_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lagged AS (
  SELECT *, row_number() OVER (PARTITION BY terminal_id ORDER BY idx) AS time_index,
    avg(volume) OVER (PARTITION BY terminal_id) AS mean_volume,
    max(volume) OVER (PARTITION BY terminal_id ORDER BY idx RANGE BETWEEN {per_year} PRECEDING AND {per_year} PRECEDING) AS v12,
    max(volume) OVER (PARTITION BY terminal_id ORDER BY idx RANGE BETWEEN {per_year - 1} PRECEDING AND {per_year - 1} PRECEDING) AS v11,
    max(volume) OVER (PARTITION BY terminal_id ORDER BY idx RANGE BETWEEN {per_year + 1} PRECEDING AND {per_year + 1} PRECEDING) AS v13
  FROM filled),
yoyed AS (SELECT *, coalesce(v12, {default(0)}) AS yoy FROM lagged),
trended AS (
  SELECT *, CASE WHEN time_index > {recent} AND avg(yoy) OVER p > 0
    THEN greatest(0.5, least(2.0, avg(volume) OVER p / avg(yoy) OVER p)) ELSE 1.0 END AS trend_ratio
  FROM yoyed WINDOW p AS (PARTITION BY terminal_id ORDER BY idx ROWS BETWEEN {recent} PRECEDING AND 1 PRECEDING)),
panel AS (
  SELECT *, yoy * trend_ratio AS lag_adj, (coalesce(v11, {default(1)}) + yoy + coalesce(v13, {default(-1)})) / 3 AS rolling_yoy
  FROM trended)"""


PANEL_SQL, PANEL_BIWEEK_SQL = panel_sql("month"), panel_sql("biweek")


def base(spark, sf):
    return filters.training_calls(tb.calls(spark, sf), WINDOW)


def monthly(spark, sf):
    return gold.monthly_container(tb.silver_monthly(spark, sf))


def index(spark, sf):
    return tables.freight_index(tb.freight_rows(spark, sf))


def panel(spark, sf, grain="month"):
    return fp.feature_panel(
        base(spark, sf), pn.transship_ratio(monthly(spark, sf)), index(spark, sf), grain, CUT,
        CORRECTIONS)


def stored(df, label):
    """A small result that a query reads several times: written once and read back, so the tables behind it are read once."""
    return sinks.write_table(df, scratch_path(df.sparkSession, label))


def rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(F.col(c) + float(EPSILON), digits) for c in columns})


# ------------------------------------------------------------------ filters

@query("filter_outlier_stays", f"""WITH {tb.CALLS_SQL}
SELECT bronze_row_id, terminal_id, eta, etd FROM calls WHERE epoch(etd) - epoch(eta) < 864000 AND epoch(etd) >= epoch(eta)""")
def filter_outlier_stays(spark, sf):
    return filters.filter_outlier_stays(tb.calls(spark, sf)).select("bronze_row_id", "terminal_id", "eta", "etd")


@query("filter_excluded_names", f"""WITH {tb.CALLS_SQL}
SELECT bronze_row_id, vessel_name, status FROM calls
WHERE coalesce(vessel_name, '') NOT LIKE 'dummy%' AND status <> 'canceled'""")
def filter_excluded_names(spark, sf):
    return filters.filter_cancelled(filters.filter_excluded_names(tb.calls(spark, sf))).select(
        "bronze_row_id", "vessel_name", "status")


@query("filter_training_window", f"""WITH {tb.CALLS_SQL}
SELECT bronze_row_id, terminal_id, etd FROM calls
WHERE (year(etd) BETWEEN 1997 AND 2000 OR (year(etd) = 2001 AND month(etd) <= 6))
  AND NOT (terminal_id = 'terminal_6' AND year(etd) = 1997) AND NOT (terminal_id = 'terminal_7' AND etd < TIMESTAMP '2000-07-01')""")
def filter_training_window(spark, sf):
    return filters.filter_training_window(tb.calls(spark, sf), WINDOW).select("bronze_row_id", "terminal_id", "etd")


@query("training_calls", f"WITH {BASE_SQL} SELECT terminal_id, berth, vessel_name, eta, etd, bronze_row_id, volume FROM base")
def training_calls(spark, sf):
    return base(spark, sf).select("terminal_id", "berth", "vessel_name", "eta", "etd", "bronze_row_id", "volume")


# ------------------------------------------------------------------ monthly container volumes

MONTHLY_OUT = ["year", "month", "month_date", *fv.MONTHLY_COLUMNS[1:], "total_container", "import_total", "export_total",
               "transship_total"]
MONTHLY_SELECT = ", ".join("CAST(month_date AS VARCHAR) AS month_date" if c == "month_date" else c for c in MONTHLY_OUT)


@query("gold_monthly_container", f"WITH {tb.MONTHLY_SQL} SELECT {MONTHLY_SELECT} FROM monthly")
def gold_monthly_container(spark, sf):
    return monthly(spark, sf).select(*MONTHLY_OUT)


ML_OUT = ["year", "month", "total_container", "empty_ratio", "transship_ratio", "import_export_ratio",
          "prev_1month_total_container", "prev_12month_total_container", "rolling_3month_avg_total_container",
          "rolling_6month_avg_total_container", "mom_growth_rate", "yoy_growth_rate"]
ML_SQL = tb.MONTHLY_SQL + """,
ml AS (
  SELECT year, month, month_date, total_container, total_empty / nullif(total_container, 0) AS empty_ratio,
    transship_total / nullif(total_container, 0) AS transship_ratio, import_total / nullif(export_total, 0) AS import_export_ratio,
    lag(total_container, 1) OVER w AS prev_1month_total_container, lag(total_container, 12) OVER w AS prev_12month_total_container,
    avg(total_container) OVER (ORDER BY month_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3month_avg_total_container,
    avg(total_container) OVER (ORDER BY month_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rolling_6month_avg_total_container
  FROM monthly WINDOW w AS (ORDER BY month_date))"""
ML_GROWTH = """(total_container - prev_1month_total_container) / nullif(prev_1month_total_container, 0) AS mom_growth_rate,
  (total_container - prev_12month_total_container) / nullif(prev_12month_total_container, 0) AS yoy_growth_rate"""


def ml_round(*names):
    return ", ".join(f"round({n} + 1e-9, 6) AS {n}" for n in names)


def ml(spark, sf):
    return gold.ml_features(monthly(spark, sf))


@query("gold_ml_features", f"""WITH {ML_SQL}, g AS (SELECT *, {ML_GROWTH} FROM ml)
SELECT year, month, total_container, {ml_round(*ML_OUT[3:])} FROM g""")
def gold_ml_features(spark, sf):
    return rounded(ml(spark, sf).select(*ML_OUT), *ML_OUT[3:], digits=6)


@query("lag_features", f"WITH {ML_SQL} SELECT year, month, {', '.join(ML_OUT[6:8])} FROM ml")
def lag_features(spark, sf):
    return ml(spark, sf).select("year", "month", *ML_OUT[6:8])


@query("rolling_avg", f"WITH {ML_SQL} SELECT year, month, {ml_round(*ML_OUT[8:10])} FROM ml")
def rolling_avg(spark, sf):
    return rounded(ml(spark, sf).select("year", "month", *ML_OUT[8:10]), *ML_OUT[8:10], digits=6)


@query("growth_rates", f"WITH {ML_SQL}, g AS (SELECT *, {ML_GROWTH} FROM ml) SELECT year, month, {ml_round(*ML_OUT[10:])} FROM g")
def growth_rates(spark, sf):
    return rounded(ml(spark, sf).select("year", "month", *ML_OUT[10:]), *ML_OUT[10:], digits=6)


def yearly_tables(spark, sf):
    """The silver monthly table stored by year, read back one year at a time (partition pruning)."""
    path = scratch_path(spark, "monthly")
    stored = sinks.write_table(tb.silver_monthly(spark, sf), path, partition_by=("year",))
    years = sorted(int(r[0]) for r in stored.select("year").distinct().collect())  # a row per year
    return {y: stored.filter(F.col("year") == y).drop("year") for y in years}


@query("union_years", f"WITH {tb.MONTHLY_SQL} SELECT {MONTHLY_SELECT} FROM monthly")
def union_years(spark, sf):
    return gold.monthly_container(tables.union_years(yearly_tables(spark, sf))).select(*MONTHLY_OUT)


def monthly_sheets(spark, sf):
    """Sheets of monthly volumes: title, sub-header, twelve months, totals; a few names per year."""
    silver = tb.silver_monthly(spark, sf)
    order = F.coalesce(F.col("month").try_cast("int"), F.lit(13))
    row = F.struct(order.alias("o"), F.array(*fv.MONTHLY_COLUMNS).alias("cells"))
    # thirteen rows per year
    years = silver.groupBy("year").agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["cells"]).alias("body"))
    title = F.array(*[F.lit(f"h{i}") for i in range(11)])
    sub = F.array(*[F.lit("Full") for _ in range(11)])
    before, after = fv.MONTHLY_FILE_NAME.split("{year}")
    exact = F.concat(F.lit(before), F.col("year"), F.lit(after))
    decoy = F.concat(F.lit("z_"), F.col("year"), F.lit("_old.xlsx"))
    short = F.transform("body", lambda r: F.slice(r, 1, 10))
    rows = F.concat(F.array(title, sub), F.col("body"))
    good = years.select(F.when(F.col("year") == "1996", decoy).otherwise(exact).alias("file_name"), rows.alias("rows"))
    stale = years.filter("year <> '1996'").select(decoy.alias("file_name"), F.array(title).alias("rows"))
    odd = years.filter("year = '1997'").select(
        F.regexp_replace(exact, "1997", "1994").alias("file_name"), F.concat(F.array(F.slice(title, 1, 10)), short).alias("rows"))
    return good.unionByName(stale).unionByName(odd).withColumn("error", F.lit(None).cast("string"))


@query("scan_monthly_by_year", f"""WITH {tb.MONTHLY_SQL} SELECT {MONTHLY_SELECT}, NULL::VARCHAR AS error FROM monthly
UNION ALL SELECT 1994, {', '.join(['NULL'] * (len(MONTHLY_OUT) - 1))}, 'unexpected column count: 10'""")
def scan_monthly_by_year(spark, sf):
    found = tables.monthly_sheets(monthly_sheets(spark, sf))
    good = gold.monthly_container(tables.monthly_rows(found)).select(*MONTHLY_OUT)
    bad = found.filter("error IS NOT NULL").select("year", "error")
    return good.unionByName(bad, allowMissingColumns=True)


# ------------------------------------------------------------------ freight index

@query("scan_freight_index", f"WITH {tb.INDEX_SQL} SELECT 'SCFI' AS category, CAST(index_date AS VARCHAR) AS index_date, index_value FROM freight")
def scan_freight_index(spark, sf):
    return index(spark, sf)


@query("monthly_freight_index", f"WITH {INDEX_M_SQL} SELECT category, year, period, round(index_raw + 1e-9, 4) AS index_raw FROM index_m")
def monthly_freight_index(spark, sf):
    return rounded(series.monthly_index(index(spark, sf)), "index_raw")


@query("biweekly_freight_index", f"WITH {INDEX_BIWEEK_SQL} SELECT category, year, period, round(index_raw + 1e-9, 4) AS index_raw FROM index_m")
def biweekly_freight_index(spark, sf):
    return rounded(series.monthly_index(index(spark, sf), "biweek"), "index_raw")


@query("index_mom_pct", f"WITH {INDEX_M_SQL} SELECT year, period, round(index_mom + 1e-9, 6) AS index_mom FROM index_c")
def index_mom_pct(spark, sf):
    out = series.index_change(series.monthly_index(index(spark, sf)))
    return rounded(out.select("year", "period", "index_mom"), "index_mom", digits=6)


# ------------------------------------------------------------------ aggregates per terminal and period

OPS_OUT = ["terminal_id", "year", "period", "month", "idx", "volume", "shift_count", "vessel_count", "carrier_count", "route_count"]
OPS_SELECT = f"SELECT {', '.join(OPS_OUT)}, round(avg_dwell + {EPSILON}, 6) AS avg_dwell, round(shift_ratio + {EPSILON}, 6) AS shift_ratio FROM ops"


@query("monthly_terminal_ops", f"WITH {BASE_SQL}, {OPS_SQL} {OPS_SELECT}")
def monthly_terminal_ops(spark, sf):
    out = pn.terminal_ops(base(spark, sf))
    return rounded(out.select(*OPS_OUT, "avg_dwell", "shift_ratio"), "avg_dwell", "shift_ratio", digits=6)


@query("biweekly_terminal_ops", f"WITH {BASE_SQL}, {OPS_BIWEEK_SQL} {OPS_SELECT}")
def biweekly_terminal_ops(spark, sf):
    out = pn.terminal_ops(base(spark, sf), "biweek")
    return rounded(out.select(*OPS_OUT, "avg_dwell", "shift_ratio"), "avg_dwell", "shift_ratio", digits=6)


@query("scale_partial_month", f"WITH {BASE_SQL}, {OPS_SQL} SELECT terminal_id, year, period, volume, vessel_count FROM scaled")
def scale_partial_month(spark, sf):
    return pn.scale_partial_periods(pn.terminal_ops(base(spark, sf)), CORRECTIONS).select(
        "terminal_id", "year", "period", "volume", "vessel_count")


@query("berth_occupancy", f"""WITH {BASE_SQL}, {OCC_SQL}
SELECT terminal_id, year, period AS month, round(berth_occupancy + 1e-9, 6) AS berth_occupancy FROM occ""")
def berth_occupancy(spark, sf):
    return rounded(intervals.berth_occupancy(base(spark, sf)), "berth_occupancy", digits=6)


@query("berth_occupancy_sliced", f"""WITH {BASE_SQL}, {OCC_SQL}
SELECT terminal_id, year, period AS month, round(berth_occupancy + 1e-9, 6) AS berth_occupancy FROM occ""")
def berth_occupancy_sliced(spark, sf):
    """The layout for hot berths, forced."""
    return rounded(intervals.berth_occupancy(base(spark, sf), range_rows=10), "berth_occupancy", digits=6)


@query("berth_occupancy_biweekly", f"""WITH {BASE_SQL}, {OCC_BIWEEK_SQL}
SELECT terminal_id, year, period AS biweek, round(berth_occupancy + 1e-9, 6) AS berth_occupancy FROM occ""")
def berth_occupancy_biweekly(spark, sf):
    return rounded(intervals.berth_occupancy(base(spark, sf), "biweek"), "berth_occupancy", digits=6)


@query("monthly_transship_ratio", f"WITH {RATIO_SQL} SELECT year, month, round(transship_ratio + 1e-9, 6) AS transship_ratio FROM ratios")
def monthly_transship_ratio(spark, sf):
    return rounded(pn.transship_ratio(monthly(spark, sf)), "transship_ratio", digits=6)


MEANS = ["vessel_count", "avg_dwell", "shift_ratio", "berth_occupancy", "transship_ratio"]


@query("history_means", f"""WITH {PANEL_SQL}
SELECT terminal_id, period, {", ".join(f"round(avg({c}) + 1e-9, 6) AS {c}_mean" for c in MEANS)} FROM panel WHERE year < {CUT} GROUP BY 1, 2""")
def history_means(spark, sf):
    return rounded(series.history_means(panel(spark, sf), MEANS, CUT), *[f"{c}_mean" for c in MEANS], digits=6)


@query("seasonality_index", f"""WITH {BASE_SQL}, {OPS_SQL}
SELECT month, round(avg(volume) / (SELECT avg(volume) FROM scaled) + 1e-9, 6) AS seasonality FROM scaled GROUP BY month""")
def seasonality_index(spark, sf):
    ops = pn.scale_partial_periods(pn.terminal_ops(base(spark, sf)), CORRECTIONS)
    return rounded(series.seasonality_index(ops), "seasonality", digits=6)


@query("rollup_biweek_to_month", f"""WITH {BASE_SQL}, {OPS_BIWEEK_SQL}
SELECT terminal_id, year, CAST({sql_case(fv.BIWEEK_TO_MONTH, "period")} AS INT) AS month, CAST(sum(volume) AS BIGINT) AS volume
FROM ops GROUP BY 1, 2, 3""")
def rollup_biweek_to_month(spark, sf):
    return pn.rollup_biweek_to_month(pn.terminal_ops(base(spark, sf), "biweek"))


# ------------------------------------------------------------------ encodings

@query("cyclical_encoding", """SELECT l_orderkey, l_linenumber, round(sin(2 * pi() * month(l_shipdate) / 12), 9) AS month_sin,
  round(cos(2 * pi() * month(l_shipdate) / 12), 9) AS month_cos, round(sin(2 * pi() * (l_linenumber) / 26), 9) AS biweek_sin FROM lineitem""")
def cyclical_encoding(spark, sf):
    month = F.month("l_shipdate")
    # adding zero turns a rounded -0.0 into 0.0
    r9 = lambda c: F.round(c, 9) + F.lit(0.0)
    return tb.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", r9(bt.season_sin(month, 12)).alias("month_sin"),
        r9(bt.season_cos(month, 12)).alias("month_cos"), r9(bt.season_sin("l_linenumber", 26)).alias("biweek_sin"))


@query("biweek_bucket", """SELECT l_orderkey, l_linenumber, CAST(least(26, greatest(1, (weekofyear(l_shipdate) - 1) // 2 + 1)) AS INT) AS biweek
FROM lineitem""")
def biweek_bucket(spark, sf):
    return tb.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", bt.biweek("l_shipdate").alias("biweek"))


# ------------------------------------------------------------------ joins and windows of the panel

def panel_query(name, columns, grain="month", digits=4):
    """Register a query that shows some columns of the feature panel."""
    exact = {"terminal_id", "year", "period", "month", "idx", "time_index"}
    select = ", ".join(
        "CAST(time_index AS INT) AS time_index" if c == "time_index" else c if c in exact else f"round({c} + {EPSILON}, {digits}) AS {c}"
        for c in ["terminal_id", "year", "period", *columns])
    sql = f"WITH {PANEL_SQL if grain == 'month' else PANEL_BIWEEK_SQL} SELECT {select} FROM panel"

    @query(name, sql)
    def run(spark, sf):
        out = panel(spark, sf, grain).select("terminal_id", "year", "period", *columns)
        return out.withColumns({c: F.round(F.col(c) + float(EPSILON), digits) + F.lit(0.0) for c in columns if c not in exact})

    return run


panel_query("lookup_season_weight", ["weight"])
panel_query("join_freight_index", ["index_raw", "index_mom"])
panel_query("yoy_self_join", ["yoy"])
panel_query("trend_ratio", ["trend_ratio"])
panel_query("trend_ratio_biweekly", ["trend_ratio"], "biweek")
panel_query("lag12_adjusted", ["lag_adj"])
panel_query("rolling_yoy3", ["rolling_yoy"])
panel_query("time_index", ["time_index"])
panel_query("forecast_features", ["month", "volume", "time_index", *fv.FEATURES])
panel_query("forecast_features_biweekly", ["month", "volume", "time_index", *fv.FEATURES], "biweek")


@query("join_ops_occupancy", f"""WITH {BASE_SQL}, {OPS_SQL}, {OCC_SQL}
SELECT ops.terminal_id, ops.year, ops.period, volume, round(berth_occupancy + 1e-9, 6) AS berth_occupancy
FROM ops LEFT JOIN occ USING (terminal_id, year, period)""")
def join_ops_occupancy(spark, sf):
    calls = base(spark, sf)
    occupancy = intervals.berth_occupancy(calls).withColumnRenamed("month", "period")
    out = pn.join_occupancy(pn.terminal_ops(calls), occupancy)
    return rounded(out.select("terminal_id", "year", "period", "volume", "berth_occupancy"), "berth_occupancy", digits=6)


@query("impute_from_history_mean", f"""WITH {BASE_SQL}, {OPS_SQL}, {OCC_SQL},
means AS (SELECT terminal_id, period, avg(berth_occupancy) AS m FROM occ WHERE year < {CUT} GROUP BY 1, 2)
SELECT ops.terminal_id, ops.year, ops.period, round(coalesce(g.berth_occupancy, m.m, 50.0) + 1e-9, 6) AS berth_occupancy
FROM ops LEFT JOIN occ g USING (terminal_id, year, period) LEFT JOIN means m USING (terminal_id, period)""")
def impute_from_history_mean(spark, sf):
    """Occupancy by departure month, joined to the months of operation; where that is missing, the mean of the period, then the constant."""
    calls = base(spark, sf)
    occupancy = intervals.berth_occupancy(calls).withColumnRenamed("month", "period")
    out = pn.impute_occupancy(pn.join_occupancy(pn.terminal_ops(calls), occupancy), occupancy, CUT)
    return rounded(out.select("terminal_id", "year", "period", "berth_occupancy"), "berth_occupancy", digits=6)


@query("join_transship_ratio", f"""WITH {BASE_SQL}, {OPS_SQL}, {RATIO_SQL}
SELECT o.terminal_id, o.year, o.period, round(coalesce(r.transship_ratio, {TRANS_DEFAULT.replace("CASE month", "CASE o.month")}, 64.0) + 1e-9, 6) AS transship_ratio
FROM ops o LEFT JOIN ratios r ON r.year = o.year AND r.month = o.month""")
def join_transship_ratio(spark, sf):
    out = pn.join_transship(pn.terminal_ops(base(spark, sf)), pn.transship_ratio(monthly(spark, sf)))
    return rounded(out.select("terminal_id", "year", "period", "transship_ratio"), "transship_ratio", digits=6)


@query("forward_backward_fill", f"""WITH {BASE_SQL}, {OPS_SQL}, {INDEX_M_SQL},
g AS (SELECT terminal_id, idx, i.index_raw AS v FROM ops LEFT JOIN index_m i USING (year, period))
SELECT terminal_id, idx, round(coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY terminal_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY terminal_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 4) AS v FROM g""")
def forward_backward_fill(spark, sf):
    """The freight index of each month of operation, which ends earlier than the operations do."""
    monthly_index = series.monthly_index(index(spark, sf)).select("year", "period", F.col("index_raw").alias("v"))
    gappy = pn.terminal_ops(base(spark, sf)).join(monthly_index, ["year", "period"], "left").select("terminal_id", "idx", "v")
    return series.forward_backward_fill(gappy, ["v"], series.by_terminal()).withColumn("v", F.round("v", 4))


def adjusted_sql():
    features = fv.OPERATIONAL_FEATURES
    own = [c for c in features if c != "transship_ratio"]
    resort = "CASE feature " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fv.FEATURE_LAST_RESORT.items()) + " END"

    def value_at(back, step):
        return (f"coalesce(max(value) OVER (PARTITION BY terminal_id, feature ORDER BY idx RANGE BETWEEN {back} PRECEDING AND {back} PRECEDING), "
                f"map_extract_value(fb, (idx - {step}) % 12 + 1), {resort})")

    cur = " + ".join(value_at(i, i) for i in (1, 2, 3))
    ago = " + ".join(value_at(12 + i, i) for i in (1, 2, 3))
    long = " UNION ALL ".join(f"SELECT terminal_id, idx, '{c}' AS feature, {c}::DOUBLE AS value FROM panel" for c in features)
    means = " UNION ALL ".join(
        f"SELECT terminal_id, '{c}' AS feature, period, avg({c}) AS m FROM panel WHERE year < {CUT} GROUP BY ALL" for c in own)
    return f"""WITH {PANEL_SQL}, long AS ({long}),
share AS (SELECT month, avg(transship_ratio) AS m FROM ratios WHERE year < {CUT} GROUP BY 1),
means AS ({means} UNION ALL SELECT DISTINCT p.terminal_id, 'transship_ratio', p.period, share.m FROM panel p JOIN share ON share.month = p.month WHERE p.year < {CUT}),
fbs AS (SELECT terminal_id, feature, map(list(period ORDER BY period), list(m ORDER BY period)) AS fb FROM means GROUP BY 1, 2),
v AS (SELECT terminal_id, feature, idx, {value_at(12, 0)} AS yoy, ({cur}) / 3 AS cur, ({ago}) / 3 AS ago FROM long LEFT JOIN fbs USING (terminal_id, feature))
SELECT terminal_id, feature, idx, round(yoy * CASE WHEN ago > 0 THEN greatest(0.5, least(2.0, cur / ago)) ELSE 1.0 END + 1e-9, 4) AS adjusted FROM v"""


@query("trend_adjusted_feature", adjusted_sql())
def trend_adjusted_feature(spark, sf):
    rows = stored(panel(spark, sf), "panel")
    ratios = pn.transship_ratio(monthly(spark, sf))
    out = series.trend_adjusted_feature(
        series.unpivot_features(rows, fv.OPERATIONAL_FEATURES), series.fallback_values(rows, ratios, CUT))
    return rounded(out.select("terminal_id", "feature", "idx", "adjusted"), "adjusted")
