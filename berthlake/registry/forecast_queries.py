"""Models, hold-out check, scenarios and forecast outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from berthlake import fixed_values as fv
from berthlake.operators import panel as pn, series
from berthlake.plans import forecast as fc
from berthlake.registry import panel_queries as pq, query
from berthlake.session import scratch_path
from berthlake.sinks import tables as sinks

HORIZON = fc.Horizon("month", pq.CUT)


def stored_panel(spark, sf, grain="month"):
    """The panel is used many times by the models, so it is written once and read back."""
    return pq.stored(pq.panel(spark, sf, grain), "panel")


def ratios(spark, sf):
    return pn.transship_ratio(pq.monthly(spark, sf))


def index_base(spark, sf):
    return series.monthly_index(pq.index(spark, sf)).groupBy("category").agg(
        F.max_by("index_raw", F.struct("year", "period")).alias("base"))


def run_forecast(spark, sf, steps=None):
    return fc.recursive_forecast(stored_panel(spark, sf), ratios(spark, sf), index_base(spark, sf), HORIZON, steps)


@query("fit_ridge_per_terminal")
def fit_ridge_per_terminal(spark, sf):
    models = fc.fit_ridge(pq.panel(spark, sf))
    return models.select(
        "terminal_id", "n", "intercept", *[F.get("coefficients", F.lit(i)).alias(c) for i, c in enumerate(fc.FEATURES)])


def with_models(spark, sf):
    """Training rows, each with both models of its terminal."""
    rows = fc.complete(stored_panel(spark, sf))
    return rows.join(fc.fit_models(rows), "terminal_id")


@query("fit_gbt")
def fit_gbt(spark, sf):
    """Predictions of the fitted trees on the training rows."""
    return fc.predict(with_models(spark, sf)).select("terminal_id", "idx", "volume", "tree_prediction")


@query("ensemble_predict")
def ensemble_predict(spark, sf):
    return fc.predict(with_models(spark, sf)).select(
        "terminal_id", "idx", "volume", "tree_prediction", "ridge_prediction", "predicted")


def held_out(spark, sf, grain="month"):
    if grain == "month":
        return fc.validate_holdout(stored_panel(spark, sf), ratios(spark, sf), pq.CUT, 2, 4, HORIZON)
    rows = stored_panel(spark, sf, "biweek")
    return fc.validate_holdout(rows, ratios(spark, sf), pq.CUT, 2, 9, fc.Horizon("biweek", pq.CUT))


@query("validate_holdout")
def validate_holdout(spark, sf):
    return pn.regression_metrics(held_out(spark, sf), predicted="score")


@query("validate_holdout_biweekly")
def validate_holdout_biweekly(spark, sf):
    """Two-week steps held out, added up to months before they are scored."""
    return pn.regression_metrics(fc.holdout_by_month(held_out(spark, sf, "biweek")), predicted="score")


@query("recursive_forecast")
def recursive_forecast(spark, sf):
    return run_forecast(spark, sf).select("terminal_id", "scenario", "year", "period", "volume", "index_raw", *fc.FEATURES)


@query("recursive_forecast_biweekly")
def recursive_forecast_biweekly(spark, sf):
    """Two-week steps of every terminal, rolled up to months."""
    rows = stored_panel(spark, sf, "biweek")
    out = fc.recursive_forecast(rows, ratios(spark, sf), index_base(spark, sf), fc.Horizon("biweek", pq.CUT))
    return pn.rollup_biweek_to_month(out, keys=("terminal_id", "scenario", "year"))


@query("forecast_monthly_long")
def forecast_monthly_long(spark, sf):
    return fc.monthly_long(run_forecast(spark, sf))


@query("forecast_summary")
def forecast_summary(spark, sf):
    """Actual part, forecast part and following year of the recursive forecast, per terminal and scenario."""
    rows = stored_panel(spark, sf)
    ahead = fc.recursive_forecast(rows, ratios(spark, sf), index_base(spark, sf), HORIZON)
    return pn.forecast_annual_summary(rows, ahead, pq.CUT)


@query("feature_attribution")
def feature_attribution(spark, sf):
    rows = stored_panel(spark, sf)
    joined = fc.complete(rows).join(fc.fit_ridge(rows), "terminal_id")
    return fc.linear_attribution(joined, ["terminal_id", "year", "period"])


@query("tree_attribution")
def tree_attribution(spark, sf):
    return fc.tree_attribution(with_models(spark, sf), ["terminal_id", "year", "period"])


@query("scenario_attribution")
def scenario_attribution(spark, sf):
    """Attribution of the forecast rows, by the trees and by the linear model."""
    keep = ["terminal_id", "scenario", "year", "period"]
    ahead = pq.stored(run_forecast(spark, sf), "forecast")
    linear = fc.linear_attribution(ahead, keep).withColumnRenamed("attribution", "linear_attribution")
    trees = fc.tree_attribution(ahead, keep).withColumnRenamed("attribution", "tree_attribution")
    return trees.join(linear.drop("feature_value"), [*keep, "feature"])


@query("tree_feature_ranking")
def tree_feature_ranking(spark, sf):
    """Features by the mean absolute attribution of the fitted trees."""
    return fc.feature_ranking(fc.tree_attribution(with_models(spark, sf), ["terminal_id"]))


# ------------------------------------------------------------------ what holds of every model, whatever its numbers

ALPHA = fv.RIDGE_ALPHA


@query("ridge_invariants", f"""WITH {pq.PANEL_SQL}, k AS (SELECT unnest({list(fv.FEATURES)!r}) AS feature)
SELECT terminal_id, feature, count(*) AS n, round(avg(volume) + 1e-9, 4) AS mean_prediction, 0.0::DOUBLE AS gap
FROM panel, k WHERE volume IS NOT NULL GROUP BY 1, 2""")
def ridge_invariants(spark, sf):
    """The mean prediction is the mean volume, and per feature the normal equation leaves no gap."""
    rows = with_models(spark, sf).withColumn("p", fc.ridge_prediction())
    long = rows.select("terminal_id", "p", "volume", F.posexplode(F.arrays_zip(
        F.array(*[F.lit(c) for c in fc.FEATURES]).alias("feature"), fc.feature_array().alias("x"),
        F.col("means").alias("m"), F.col("coefficients").alias("c"))).alias("i", "z"))
    x = F.col("z.x") - F.col("z.m")
    sums = long.groupBy("terminal_id", F.col("z.feature").alias("feature")).agg(
        F.count("*").alias("n"), F.avg("p").alias("mean_prediction"), F.sum(x * (F.col("volume") - F.col("p"))).alias("pull"),
        (F.first("z.c") * ALPHA).alias("penalty"), F.sum(F.abs(x * F.col("volume"))).alias("scale"))
    gap = F.round((F.col("pull") - F.col("penalty")) / (F.col("scale") + 1), 6) + F.lit(0.0)
    return pq.rounded(sums, "mean_prediction").select("terminal_id", "feature", "n", "mean_prediction", gap.alias("gap"))


@query("tree_invariants", f"""WITH {pq.PANEL_SQL}
SELECT terminal_id, idx, 0.0::DOUBLE AS gap, TRUE AS whole FROM panel WHERE volume IS NOT NULL""")
def tree_invariants(spark, sf):
    """Attributions add up to prediction minus mean prediction; the ensemble is the whole part of the mean, not negative."""
    rows = fc.predict(with_models(spark, sf))
    keep = ["terminal_id", "idx", "tree_prediction", "score", "predicted"]
    sums = fc.tree_attribution(rows, keep).groupBy(*keep).agg(F.sum("attribution").alias("total"))
    means = rows.groupBy("terminal_id").agg(F.avg("tree_prediction").alias("mean"))
    gap = F.round(F.col("total") - (F.col("tree_prediction") - F.col("mean")), 6) + F.lit(0.0)
    whole = (F.col("predicted") >= 0) & (F.col("predicted") == F.greatest(F.lit(0.0), F.col("score")).cast("bigint"))
    return sums.join(means, "terminal_id").select("terminal_id", "idx", gap.alias("gap"), whole.alias("whole"))


@query("holdout_invariants", f"""WITH {pq.PANEL_SQL}
SELECT terminal_id, idx, CAST(volume AS DOUBLE) AS volume, TRUE AS scored FROM panel
WHERE year = {pq.CUT} AND month BETWEEN 3 AND 6 AND volume IS NOT NULL""")
def holdout_invariants(spark, sf):
    """Every held-out month of every terminal that has earlier months, and no other, gets a prediction."""
    return held_out(spark, sf).select(
        "terminal_id", "idx", F.col("volume").cast("double").alias("volume"), F.col("score").isNotNull().alias("scored"))


RATES = " UNION ALL ".join(f"SELECT '{n}' AS scenario, {r}::DOUBLE AS rate" for n, r in fv.SCENARIO_STEP.items())


@query("forecast_invariants", f"""WITH {pq.PANEL_SQL}, s AS ({RATES}),
start AS (SELECT arg_max(index_raw, year * 100 + period) AS first_index FROM index_m),
ends AS (SELECT terminal_id, max(idx) AS last_idx, arg_max(index_raw, idx) AS index_last FROM panel GROUP BY 1),
steps AS (SELECT *, last_idx + k AS idx, first_index * (1 + rate * k) AS index_raw,
  CASE WHEN k = 1 THEN index_last ELSE first_index * (1 + rate * (k - 1)) END AS index_before
  FROM ends, s, start, range(1, {fv.MONTH_HORIZON + 1}) r(k))
SELECT t.terminal_id, scenario, CAST(t.idx // 12 AS INT) AS year, CAST(t.idx % 12 + 1 AS INT) AS period,
  round(t.index_raw + 1e-9, 4) AS index_raw, round((t.index_raw - index_before) / index_before * 100 + 1e-9, 4) AS index_mom,
  {pq.sql_case(fv.SEASON_WEIGHTS, "(t.idx % 12 + 1)")}::DOUBLE AS weight,
  round(CAST(ago.volume AS DOUBLE) + 1e-9, 4) AS year_ago, TRUE AS follows
FROM steps t LEFT JOIN panel ago ON ago.terminal_id = t.terminal_id AND ago.idx = t.idx - 12""")
def forecast_invariants(spark, sf):
    """Index, seasonal weight and last year's volume of every forecast row; both models give its volume again."""
    rows = stored_panel(spark, sf)
    ahead = fc.recursive_forecast(rows, ratios(spark, sf), index_base(spark, sf), HORIZON)
    again = fc.predict(ahead.join(fc.fit_ridge(rows).select("terminal_id", "intercept"), "terminal_id"))
    ago = rows.select("terminal_id", (F.col("idx") + 12).alias("idx"), F.col("volume").cast("double").alias("year_ago"))
    out = again.join(ago, ["terminal_id", "idx"], "left").select(
        "terminal_id", "scenario", "year", "period", "index_raw", "index_mom", F.col("weight").cast("double").alias("weight"),
        "year_ago", (F.col("predicted") == F.col("volume")).alias("follows"))
    return out.withColumns({c: F.round(F.col(c) + float(pq.EPSILON), 4) + F.lit(0.0) for c in ["index_raw", "index_mom", "year_ago"]})


LONG_SQL = " UNION ALL ".join(
    f"SELECT terminal_id, '{c}' AS feature, ({c} - avg({c}) OVER (PARTITION BY terminal_id))::DOUBLE AS attribution FROM panel" for c in fv.FEATURES)


@query("feature_ranking", f"""WITH {pq.PANEL_SQL}, long AS ({LONG_SQL})
SELECT terminal_id, feature, round(avg(abs(attribution)), 4) AS mean_abs FROM long GROUP BY 1, 2""")
def feature_ranking(spark, sf):
    """Features by mean absolute distance from their mean (unit coefficients)."""
    rows = pq.panel(spark, sf)
    means = rows.groupBy("terminal_id").agg(F.array(*[F.avg(F.col(c).cast("double")) for c in fv.FEATURES]).alias("means"))
    unit = rows.join(means, "terminal_id").withColumn("coefficients", F.array_repeat(F.lit(1.0), len(fv.FEATURES)))
    return fc.feature_ranking(fc.linear_attribution(unit, ["terminal_id"])).withColumn("mean_abs", F.round("mean_abs", 4))


SCENARIOS = "(VALUES ('Flat', 0.0::DOUBLE), ('Rise', 0.05::DOUBLE), ('Fall', -0.05::DOUBLE)) s(scenario, rate)"


def scenario_sql(steps, size):
    return f"""WITH {pq.INDEX_M_SQL}, last AS (SELECT category, arg_max(index_raw, year * 100 + period) AS base FROM index_m GROUP BY category),
raw AS (SELECT category, scenario, CAST(step AS INT) AS step, base, base * (1 + rate * step * {size}) AS index_raw FROM last, {SCENARIOS}, range(1, {steps + 1}) r(step))
SELECT category, scenario, step, round(index_raw, 4) AS index_raw,
  round((index_raw - coalesce(lag(index_raw) OVER w, base)) / coalesce(lag(index_raw) OVER w, base) * 100, 6) AS index_mom
FROM raw WINDOW w AS (PARTITION BY scenario ORDER BY step)"""


@query("index_scenarios", scenario_sql(fv.MONTH_HORIZON, 1.0))
def index_scenarios(spark, sf):
    out = fc.index_scenarios(series.monthly_index(pq.index(spark, sf)))
    return out.withColumns({"index_raw": F.round("index_raw", 4), "index_mom": F.round("index_mom", 6) + F.lit(0.0)})


@query("index_scenarios_biweekly", scenario_sql(fv.BIWEEK_HORIZON, 0.5))
def index_scenarios_biweekly(spark, sf):
    out = fc.index_scenarios(series.monthly_index(pq.index(spark, sf)), fv.BIWEEK_HORIZON, 0.5)
    return out.withColumns({"index_raw": F.round("index_raw", 4), "index_mom": F.round("index_mom", 6) + F.lit(0.0)})


@query("write_forecast_long", f"""WITH {pq.BASE_SQL}, {pq.OPS_SQL},
f AS (SELECT terminal_id, scenario, idx, CAST(volume AS BIGINT) AS volume FROM ops, {SCENARIOS})
SELECT terminal_id, scenario, CAST(idx // 12 AS INT) AS year, CAST(idx % 12 + 1 AS INT) AS month,
  CAST(make_date(CAST(idx // 12 AS INT), CAST(idx % 12 + 1 AS INT), 1) AS VARCHAR) AS month_date, volume FROM f""")
def write_forecast_long(spark, sf):
    """Vectors of the volumes of every terminal, from its first month on, as rows, stored and read back."""
    ops = pn.terminal_ops(pq.base(spark, sf))
    # a month per entry
    vectors = ops.groupBy("terminal_id").agg(
        F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"), F.map_from_entries(F.collect_list(F.struct("idx", "volume"))).alias("known"))
    vectors = vectors.withColumn("volumes", F.expr("transform(sequence(first_idx, last_idx), i -> try_element_at(known, i))"))
    vectors = vectors.select("*", fc.scenario_rows().alias("s")).select("terminal_id", "s.scenario", "first_idx", "volumes")
    return sinks.write_table(fc.forecast_long(vectors), scratch_path(spark, "forecast"))


@query("forecast_annual_summary", f"""WITH {pq.BASE_SQL}, {pq.OPS_SQL},
a AS (SELECT terminal_id, CAST(sum(volume) AS BIGINT) AS actual_volume FROM ops WHERE year = 2000 AND month <= 6 GROUP BY 1),
f AS (SELECT terminal_id, scenario, year, CAST(floor(volume * (1 + rate)) AS BIGINT) AS volume FROM ops, {SCENARIOS}
  WHERE (year = 2000 AND month > 6) OR year = 2001),
s AS (SELECT terminal_id, scenario, CAST(sum(CASE WHEN year = 2000 THEN volume ELSE 0 END) AS BIGINT) AS forecast_volume,
  CAST(sum(CASE WHEN year = 2001 THEN volume ELSE 0 END) AS BIGINT) AS next_year_volume FROM f GROUP BY 1, 2)
SELECT terminal_id, scenario, actual_volume, forecast_volume, coalesce(actual_volume, 0) + forecast_volume AS base_year_volume, next_year_volume
FROM s LEFT JOIN a USING (terminal_id)""")
def forecast_annual_summary(spark, sf):
    """The second half of 2000 and the year 2001 taken as the forecast."""
    ops = pn.terminal_ops(pq.base(spark, sf))
    actual = ops.filter("month <= 6")
    ahead = ops.filter("(year = 2000 AND month > 6) OR year = 2001").select("*", fc.scenario_rows().alias("s"))
    ahead = ahead.select("terminal_id", "s.scenario", "year", F.floor(F.col("volume") * (1 + F.col("s.rate"))).alias("volume"))
    return pn.forecast_annual_summary(actual, ahead, 2000)


@query("regression_metrics", f"""WITH {pq.PANEL_SQL},
m AS (SELECT terminal_id, count(*) AS n, sum((volume - lag_adj) * (volume - lag_adj)) AS ss_res, var_pop(volume) * count(*) AS ss_tot,
  avg(abs(volume - lag_adj)) AS mae FROM panel GROUP BY 1)
SELECT terminal_id, n, round(CASE WHEN ss_tot > 0 THEN 1 - ss_res / ss_tot END, 6) AS r2, round(mae, 4) AS mae FROM m""")
def regression_metrics(spark, sf):
    """The adjusted lag taken as the prediction."""
    out = pn.regression_metrics(pq.panel(spark, sf), predicted="lag_adj")
    return out.withColumns({"r2": F.round("r2", 6), "mae": F.round("mae", 4)})
