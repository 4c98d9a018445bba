"""Scenario forecasts: a ridge model and boosted trees per terminal, and the step-wise projection as one expression."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from berthlake import fixed_values as fv
from berthlake.functions import text, time as bt
from berthlake.functions.barrier import compute_once
from berthlake.operators.series import PER_YEAR, clamp_trend, fallback_values, history_means, season_weight
from berthlake.plans import boosting, ridge_solver

FEATURES = fv.FEATURES
OPERATIONS = fv.OPERATIONAL_FEATURES

# Terminals whose operational features are not projected but set to their history means.
FLAT_TERMINALS = ("terminal_7",)

_solve = F.pandas_udf(
    ridge_solver.solve_batch,
    T.StructType().add("coefficients", T.ArrayType(T.DoubleType())).add("intercept", T.DoubleType()),
)


# ---------------------------------------------------------------- models

def complete(panel: DataFrame) -> DataFrame:
    return panel.dropna(subset=[*FEATURES, "volume"])


def fit_ridge(panel: DataFrame, alpha: float = fv.RIDGE_ALPHA) -> DataFrame:
    """Coefficients per terminal from one aggregation of centred second moments.

    The moments combine on the map side, so the size of a terminal's history does not matter; only the solve
    of the 11 x 11 system is Python, one row per terminal.
    """
    x = [F.col(c).cast("double") for c in FEATURES]
    y = F.col("volume").cast("double")
    k = len(x)
    moments = complete(panel).groupBy("terminal_id").agg(
        F.count("*").alias("n"),
        F.array(*[F.covar_pop(x[i], x[j]) for i in range(k) for j in range(i, k)]).alias("gram"),
        F.array(*[F.covar_pop(c, y) for c in x]).alias("cross"),
        F.array(*[F.avg(c) for c in x]).alias("means"),
        F.avg(y).alias("target_mean"),
    )
    solved = moments.withColumn(
        "_fit", _solve("n", "gram", "cross", "means", "target_mean", F.lit(float(alpha)))
    )
    return solved.select(
        "terminal_id", "n", F.col("_fit.coefficients").alias("coefficients"),
        F.col("_fit.intercept").alias("intercept"), "means",
    )


def fit_trees(
    panel: DataFrame, l1: float = fv.TREE_L1, l2: float = fv.TREE_L2, trees: int = fv.TREE_COUNT,
    depth: int = fv.TREE_DEPTH, step: float = fv.TREE_STEP,
) -> DataFrame:
    """Boosted trees per terminal, as rows (terminal_id, base, leaves).

    All terminals are fitted in one job, a series per call. What meets in a task is one series: at most 12 or 26
    rows per year, as the panel has one row per terminal and period.
    """
    rows = complete(panel).select(
        "terminal_id", "idx", F.col("volume").cast("double").alias("volume"),
        *[F.col(c).cast("double").alias(c) for c in FEATURES],
    )
    fitter = boosting.fitter(FEATURES, "volume", "idx", trees=trees, depth=depth, step=step, l1=l1, l2=l2)
    return rows.groupBy("terminal_id").applyInPandas(
        fitter, f"terminal_id string, base double, leaves array<{boosting.LEAF_TYPE}>"
    )


def fit_models(panel: DataFrame) -> DataFrame:
    """Both models of each terminal in one row."""
    return fit_ridge(panel).join(fit_trees(panel), "terminal_id")


def feature_array(prefix: str = "") -> Column:
    return F.array(*[F.col(f"{prefix}{c}").cast("double") for c in FEATURES])


def ridge_prediction(values: Column | None = None) -> Column:
    values = feature_array() if values is None else values
    products = F.zip_with("coefficients", values, lambda c, v: c * v)
    return F.aggregate(products, F.col("intercept"), lambda s, p: s + p)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def within(values: Column, side: Column) -> Column:
    """Whether the row lies between the borders that a leaf has for one feature."""
    x = F.get(values, side["feature"])
    return (x >= side["low"]) & (x < side["high"])


def tree_prediction(values: Column | None = None) -> Column:
    """Mean plus the value of the one leaf per tree whose box holds the row."""
    def total(x: Column) -> Column:
        def add(s: Column, leaf: Column) -> Column:
            return s + F.when(F.forall(leaf["box"], lambda side: within(x, side)), leaf["value"]).otherwise(0.0)

        return F.aggregate("leaves", F.col("base"), add)

    return bound(feature_array() if values is None else values, total)


def blend(tree: Column, ridge: Column) -> Column:
    return tree * 0.5 + ridge * 0.5


def ensemble(tree: Column, ridge: Column) -> Column:
    """Mean of both models, cut to a whole number, never negative."""
    return F.greatest(F.lit(0).cast("bigint"), blend(tree, ridge).cast("bigint"))


def predict(rows: DataFrame) -> DataFrame:
    """Rows that carry the features and both models -> both predictions, their mean and the whole number of it."""
    scored = compute_once(rows, tree_prediction=tree_prediction(), ridge_prediction=ridge_prediction())
    tree, ridge = F.col("tree_prediction"), F.col("ridge_prediction")
    return scored.withColumns({"score": blend(tree, ridge), "predicted": ensemble(tree, ridge)})


# ---------------------------------------------------------------- projection state

class Horizon(NamedTuple):
    """What the projection of one grain needs to know."""

    grain: str = "month"
    before_year: int = 2026

    @property
    def per_year(self) -> int:
        return PER_YEAR[self.grain]

    @property
    def recent(self) -> int:
        return 3 if self.grain == "month" else 6


def series_state(panel: DataFrame, ratios: DataFrame, horizon: Horizon) -> DataFrame:
    """One row per terminal: the last two years as maps period index -> value, and the fall-back values.

    The maps are bounded by the filter on the period index (24 or 52 entries), however long the history is.
    """
    ends = panel.groupBy("terminal_id").agg(
        F.max("idx").alias("last_idx"),
        F.avg("volume").alias("mean_volume"),
        F.max_by("index_raw", "idx").alias("index_last"),
    )
    recent = panel.join(ends, "terminal_id").filter(F.col("idx") > F.col("last_idx") - 2 * horizon.per_year)
    maps = recent.groupBy("terminal_id", "last_idx", "mean_volume", "index_last").agg(
        *[
            F.map_from_entries(F.collect_list(F.struct("idx", F.col(c).cast("double").alias("v")))).alias(f"m_{c}")
            for c in ["volume", *OPERATIONS]
        ]
    )
    falls = fallback_values(panel, ratios, horizon.before_year).groupBy("terminal_id").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "fallback"))).alias("fallbacks")
    )
    # the share of flat terminals is their own mean, not the port's
    own = history_means(panel, ["transship_ratio"], horizon.before_year).filter("transship_ratio_mean IS NOT NULL")
    own = own.groupBy("terminal_id").agg(
        F.map_from_entries(F.collect_list(F.struct("period", "transship_ratio_mean"))).alias("own_share")
    )
    return maps.join(falls, "terminal_id", "left").join(own, "terminal_id", "left")


def _recent_mean(value, offset: int, recent: int) -> Column:
    """Mean of value(offset + i, i) for the last ``recent`` periods (a lambda: short generated code)."""
    steps = F.array(*[F.lit(i) for i in range(1, recent + 1)])
    return F.aggregate(steps, F.lit(0.0), lambda s, i: s + value(i + offset, i)) / recent


def projected_operation(feature: str, t: Column, horizon: Horizon, known: Column | None = None) -> Column:
    """Value of an operational feature at period ``t``: last year's value times the recent trend.

    ``known`` maps period index -> value, projected periods included. Flat terminals take the mean of their own
    history for this period of the year.
    """
    per_year, recent = horizon.per_year, horizon.recent
    known = F.col(f"m_{feature}") if known is None else known
    means = F.try_element_at("fallbacks", F.lit(feature))
    last_resort = F.lit(fv.FEATURE_LAST_RESORT[feature])

    def history_mean(step) -> Column:
        return F.coalesce(F.try_element_at(means, bt.period_of_year(t - step, per_year)), last_resort)

    def value(back, step) -> Column:
        return F.coalesce(F.try_element_at(known, (t - back).cast("int")), history_mean(step))

    trend = clamp_trend(_recent_mean(value, 0, recent), _recent_mean(value, per_year, recent))
    flat = history_mean(0)
    if feature == "transship_ratio":
        flat = F.coalesce(
            F.try_element_at("own_share", bt.period_of_year(t, per_year)), F.lit(fv.FLAT_SHARE_LAST_RESORT)
        )
    return F.when(F.col("terminal_id").isin(*FLAT_TERMINALS), flat).otherwise(value(per_year, 0) * trend)


def projected_volume_features(t: Column, horizon: Horizon, known: Column | None = None) -> dict[str, Column]:
    per_year, recent = horizon.per_year, horizon.recent
    known = F.col("m_volume") if known is None else known

    def value(back, season_of) -> Column:
        month = bt.month_of_period(bt.period_of_year(t - season_of, per_year), per_year)
        return F.coalesce(F.try_element_at(known, (t - back).cast("int")), F.col("mean_volume") * season_weight(month))

    year_ago = value(per_year, 0)
    trend = clamp_trend(_recent_mean(value, 0, recent), _recent_mean(value, per_year, recent))
    around = value(per_year - 1, -1) + year_ago + value(per_year + 1, 1)
    return {"lag_adj": year_ago * trend, "rolling_yoy": around / 3}


def _packed(columns: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(name) for name, c in columns.items()])


def _extended(known: Column, t: Column, value: Column) -> Column:
    return F.map_concat(known, F.create_map(t.cast("int"), value.cast("double")))


def _walk(start: dict[str, Column], entry_type: str, steps: int, step) -> Column:
    """Entries of ``steps`` periods, the state going from one to the next; one expression on one row per series.

    ``step(state, k)`` gives the entry and, as a function of the finished entry, the next state.
    """
    def merge(acc: Column, k: Column) -> Column:
        entry, after = step(acc, k)
        return bound(entry, lambda e: _packed({**after(e), "path": F.concat(acc["path"], F.array(e))}))

    zero = _packed({**start, "path": F.array().cast(f"array<{entry_type}>")})
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zero, merge, lambda acc: acc["path"])


def _entry_type(columns: Sequence[str]) -> str:
    return "struct<idx: int, " + ", ".join(f"{c}: double" for c in columns) + ">"


def _operations_state() -> dict[str, Column]:
    return {f"m_{c}": F.col(f"m_{c}") for c in OPERATIONS}


# ---------------------------------------------------------------- hold-out check

def project_operations(state: DataFrame, steps: int, horizon: Horizon) -> DataFrame:
    """Operational features of the next ``steps`` periods, each step using the ones before."""
    def step(acc: Column, k: Column):
        t = F.col("last_idx") + k
        operations = {c: projected_operation(c, t, horizon, acc[f"m_{c}"]).cast("double") for c in OPERATIONS}
        after = lambda e: {f"m_{c}": _extended(acc[f"m_{c}"], t, e[c]) for c in OPERATIONS}
        return _packed({"idx": t.cast("int"), **operations}), after

    path = _walk(_operations_state(), _entry_type(OPERATIONS), steps, step)
    return state.select("terminal_id", F.explode(path).alias("p")).select("terminal_id", "p.*")


def validate_holdout(
    panel: DataFrame, ratios: DataFrame, year: int, train_to_month: int, steps: int, horizon: Horizon
) -> DataFrame:
    """Fit up to a month, predict the following periods with projected operational features.

    Only the ``steps`` periods are held out, by their months; later ones are neither trained on nor scored, as
    nothing is projected for them. Returns the rows with actual and predicted volume; ``regression_metrics`` sums
    them up by ``score``, the mean of both models before it is cut to a whole number.
    """
    before = (F.col("year") < year) | ((F.col("year") == year) & (F.col("month") <= train_to_month))
    last_month = train_to_month + round(steps * 12 / horizon.per_year)
    train = panel.filter(before)
    held = panel.filter((F.col("year") == year) & F.col("month").between(train_to_month + 1, last_month))
    projected = project_operations(series_state(train, ratios, horizon), steps, horizon)
    # terminals with history means keep their actual operational values in the check
    projected = projected.filter(~F.col("terminal_id").isin(*FLAT_TERMINALS)).select(
        "terminal_id", "idx", *[F.col(c).alias(f"_{c}") for c in OPERATIONS]
    )
    rows = complete(held).join(projected, ["terminal_id", "idx"], "left").withColumns(
        {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in OPERATIONS}
    ).drop(*[f"_{c}" for c in OPERATIONS])
    return predict(rows.join(fit_models(train).drop("n", "means"), "terminal_id")).select(
        "terminal_id", "idx", "year", "period", "month", "volume", "tree_prediction", "ridge_prediction", "score",
        "predicted",
    )


def holdout_by_month(held: DataFrame) -> DataFrame:
    """Hold-out rows of two-week periods added up to months, ready for ``regression_metrics``."""
    month = F.try_element_at(text.literal_map(fv.BIWEEK_TO_MONTH), F.col("period"))
    return held.groupBy("terminal_id", "year", month.alias("month")).agg(
        F.sum("volume").alias("volume"), F.sum("score").alias("score"), F.sum("predicted").alias("predicted")
    )


# ---------------------------------------------------------------- scenarios and recursion

def scenario_rows() -> Column:
    return F.explode(
        F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(r).alias("rate")) for n, r in fv.SCENARIO_STEP.items()])
    )


def index_scenarios(monthly_index: DataFrame, steps: int = fv.MONTH_HORIZON, step_size: float = 1.0) -> DataFrame:
    """Future index per scenario, linear in the step, with the percent change to the step before."""
    last = monthly_index.groupBy("category").agg(
        F.max_by("index_raw", F.struct("year", "period")).alias("base")
    )
    rows = last.select("category", "base", scenario_rows().alias("s")).select(
        "category", "base", "s.*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step")
    )
    raw = lambda k: F.col("base") * (1 + F.col("rate") * k * step_size)
    before = F.when(F.col("step") == 1, F.col("base")).otherwise(raw(F.col("step") - 1))
    now = raw(F.col("step"))
    return rows.select(
        "category", "scenario", "step", now.alias("index_raw"), ((now - before) / before * 100).alias("index_mom")
    )


def recursive_forecast(
    panel: DataFrame,
    ratios: DataFrame,
    index_base: DataFrame,
    horizon: Horizon = Horizon(),
    steps: int | None = None,
) -> DataFrame:
    """Forecast per terminal and scenario, one period after the other.

    The state is one row per series; all steps are one expression over it: features from the maps, both models,
    and the prediction put into the maps for the next step. No shuffle, no join and no job per step.
    ``index_base`` has one row: the last index.
    """
    steps = steps or (fv.MONTH_HORIZON if horizon.grain == "month" else fv.BIWEEK_HORIZON)
    step_size = 1.0 if horizon.grain == "month" else 0.5
    per_year = horizon.per_year
    state = (
        series_state(panel, ratios, horizon)
        .join(fit_models(panel).drop("n"), "terminal_id")
        .withColumn("category", F.lit(fv.FREIGHT_CATEGORY))
        .join(index_base.select("category", "base").withColumnRenamed("base", "index_base"), "category")
        .select("*", scenario_rows().alias("s"))
        .select("*", "s.*")
        .drop("s")
    )
    entries = ["index_raw", "predicted", *FEATURES]

    def step(acc: Column, k: Column):
        t = F.col("last_idx") + k
        period = bt.period_of_year(t, per_year)
        raw = F.col("index_base") * (1 + F.col("rate") * k * step_size)
        features = {
            **{c: projected_operation(c, t, horizon, acc[f"m_{c}"]) for c in OPERATIONS},
            **projected_volume_features(t, horizon, acc["m_volume"]),
            "weight": season_weight(bt.month_of_period(period, per_year)),
            "season_sin": bt.season_sin(period, per_year),
            "season_cos": bt.season_cos(period, per_year),
            "index_mom": (raw - acc["index_last"]) / acc["index_last"] * 100,
        }

        def scored(x: Column) -> Column:
            predicted = ensemble(tree_prediction(x), ridge_prediction(x)).cast("double")
            named = {c: F.get(x, F.lit(i)) for i, c in enumerate(FEATURES)}
            return _packed({"idx": t.cast("int"), "index_raw": raw, "predicted": predicted, **named})

        def after(e: Column) -> dict[str, Column]:
            maps = {f"m_{c}": _extended(acc[f"m_{c}"], t, e[c]) for c in OPERATIONS}
            return {"m_volume": _extended(acc["m_volume"], t, e["predicted"]), "index_last": e["index_raw"], **maps}

        return bound(F.array(*[features[c].cast("double") for c in FEATURES]), scored), after

    start = {"m_volume": F.col("m_volume"), "index_last": F.col("index_last").cast("double"), **_operations_state()}
    path = _walk(start, _entry_type(entries), steps, step)
    models = ["coefficients", "means", "base", "leaves"]
    out = state.select("terminal_id", "scenario", *models, F.explode(path).alias("p"))
    return out.select(
        "terminal_id", "scenario", *models,
        bt.period_year("p.idx", per_year).alias("year"), bt.period_of_year("p.idx", per_year).alias("period"),
        F.col("p.predicted").cast("bigint").alias("volume"),
        *[F.col(f"p.{c}").alias(c) for c in ["idx", "index_raw", *FEATURES]],
    )


# ---------------------------------------------------------------- outputs

def monthly_long(forecast: DataFrame) -> DataFrame:
    """terminal, scenario, year, month, date, volume."""
    return forecast.select(
        "terminal_id", "scenario", "year", F.col("period").alias("month"),
        F.make_date("year", "period", F.lit(1)).alias("month_date"), "volume",
    )


def forecast_long(vectors: DataFrame, first: str = "first_idx") -> DataFrame:
    """Volume vectors per terminal and scenario as rows; ``first`` is the month index of a vector's first entry, gaps are null."""
    rows = vectors.select("terminal_id", "scenario", first, F.posexplode("volumes").alias("pos", "volume")).filter(F.col("volume").isNotNull())
    at = F.col("pos") + F.col(first)
    rows = rows.withColumns({"year": bt.period_year(at, 12), "month": bt.period_of_year(at, 12)})
    return rows.select(
        "terminal_id", "scenario", "year", "month",
        F.make_date("year", "month", F.lit(1)).alias("month_date"), F.col("volume").cast("bigint").alias("volume"),
    )


def linear_attribution(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Share of each feature in the linear prediction: coefficient x (value - training mean), long."""
    zipped = F.arrays_zip(
        F.array(*[F.lit(c) for c in FEATURES]).alias("feature"), feature_array().alias("feature_value"),
        F.col("coefficients").alias("c"), F.col("means").alias("m"),
    )
    long = rows.select(*keep, F.explode(zipped).alias("z"))
    return long.select(
        *keep, F.col("z.feature").alias("feature"), F.col("z.feature_value").alias("feature_value"),
        (F.col("z.c") * (F.col("z.feature_value") - F.col("z.m"))).alias("attribution"),
    )


def tree_attribution(rows: DataFrame, keep: Sequence[str], depth: int = fv.TREE_DEPTH) -> DataFrame:
    """Shapley values of the trees along their own paths, long; they add up to prediction minus mean prediction.

    A leaf knows per feature the share of rows that its path keeps. With ``hit`` 1 or 0 for the row being inside,
    the value of feature j in a leaf is value * (hit_j - share_j) * integral over t in [0, 1] of the product over the
    other features of (share + t * (hit - share)). The product has at most ``depth`` - 1 factors, so Gauss-Legendre
    sums over (depth + 1) // 2 places give the integral exactly.
    """
    places, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
    nodes = F.array(*[
        F.struct(F.lit(float((t + 1) / 2)).alias("t"), F.lit(float(w / 2)).alias("w")) for t, w in zip(places, weights)
    ])

    def parts(x: Column) -> Column:
        def of_leaf(leaf: Column) -> Column:
            sides = F.transform(leaf["box"], lambda side: F.struct(
                side["feature"].alias("feature"), side["share"].alias("share"),
                (within(x, side).cast("double") - side["share"]).alias("gap")))

            def of_side(all_sides: Column, own: Column) -> Column:
                def product(node: Column) -> Column:
                    others = F.filter(all_sides, lambda o: o["feature"] != own["feature"])
                    return F.aggregate(others, node["w"], lambda p, o: p * (o["share"] + node["t"] * o["gap"]))

                total = F.aggregate(F.transform(nodes, product), F.lit(0.0), lambda a, b: a + b)
                return F.struct(own["feature"].alias("feature"), (leaf["value"] * own["gap"] * total).alias("part"))

            return bound(sides, lambda every: F.transform(every, lambda own: of_side(every, own)))

        return F.flatten(F.transform("leaves", of_leaf))

    def shares(every: Column) -> Column:
        def of_feature(i: int) -> Column:
            mine = F.filter(every, lambda p: p["feature"] == i)
            return F.aggregate(mine, F.lit(0.0), lambda s, p: s + p["part"])

        return F.array(*[of_feature(i) for i in range(len(FEATURES))])

    values = compute_once(rows, _parts=bound(feature_array(), parts))
    zipped = F.arrays_zip(
        F.array(*[F.lit(c) for c in FEATURES]).alias("feature"), feature_array().alias("feature_value"),
        shares(F.col("_parts")).alias("attribution"),
    )
    long = values.select(*keep, F.explode(zipped).alias("z"))
    return long.select(*keep, "z.feature", "z.feature_value", "z.attribution")


def feature_ranking(attributions: DataFrame, keys: Sequence[str] = ("terminal_id",), top: int | None = None) -> DataFrame:
    """Features by mean absolute attribution."""
    ranked = attributions.groupBy(*keys, "feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"))
    ranked = ranked.orderBy(*keys, F.desc("mean_abs"), "feature")
    return ranked if top is None else ranked.limit(top)
