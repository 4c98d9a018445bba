"""Ridge against the closed form, trees against plain enumeration; hold-out and recursion on the given tables."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest

from berthlake import fixed_values as fv
from berthlake.plans import boosting, forecast as fc
from berthlake.registry import forecast_queries as fq, load_all, panel_queries as pq

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def panel(spark):
    return fq.stored_panel(spark, SF)


def test_ridge_is_the_closed_form(spark, panel):
    data = panel.toPandas()
    models = {r.terminal_id: r for r in fc.fit_ridge(panel).collect()}
    for terminal, rows in data.groupby("terminal_id"):
        x, y = rows[fv.FEATURES].to_numpy(float), rows["volume"].to_numpy(float)
        xc, yc = x - x.mean(0), y - y.mean()
        want = np.linalg.solve(xc.T @ xc + fv.RIDGE_ALPHA * np.eye(x.shape[1]), xc.T @ yc)
        got = models[terminal]
        assert np.allclose(got.coefficients, want, rtol=1e-6, atol=1e-8)
        assert got.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-6)


def test_recursion(spark, panel):
    """Flat index means no change; predictions are whole, not negative, and feed the next year's lag."""
    steps = 14
    out = fc.recursive_forecast(panel, fq.ratios(spark, SF), fq.index_base(spark, SF), fq.HORIZON, steps).toPandas()
    assert (out.groupby(["terminal_id", "scenario"]).size() == steps).all()
    assert (out.volume >= 0).all()
    actual = panel.toPandas()
    one = out[(out.terminal_id == "terminal_2") & (out.scenario == "Flat")].sort_values("idx")
    known = dict(zip(actual[actual.terminal_id == "terminal_2"].idx, actual[actual.terminal_id == "terminal_2"].volume))
    assert one.idx.tolist() == list(range(max(known) + 1, max(known) + 1 + steps))
    for r in one.itertuples():  # the lag by hand, from actual values and earlier predictions
        now = np.mean([known[r.idx - i] for i in (1, 2, 3)])
        ago = np.mean([known[r.idx - 12 - i] for i in (1, 2, 3)])
        trend = min(2.0, max(0.5, now / ago)) if ago > 0 else 1.0
        assert r.lag_adj == pytest.approx(known[r.idx - 12] * trend)
        assert r.rolling_yoy == pytest.approx(np.mean([known[r.idx - k] for k in (11, 12, 13)]))
        known[r.idx] = float(r.volume)
    assert np.allclose(one.index_mom.tolist()[1:], 0)
    rise = out[(out.terminal_id == "terminal_2") & (out.scenario == "Rise")].sort_values("idx").index_raw.tolist()
    assert np.allclose(np.diff(rise), rise[0] / 1.05 * 0.05)


def test_holdout_and_outputs(spark, panel):
    held = fc.validate_holdout(panel, fq.ratios(spark, SF), pq.CUT, 2, 4, fq.HORIZON).toPandas()
    assert set(held.month) == {3, 4, 5, 6} and held.predicted.notna().all()
    # the models are scored before their mean is cut to a whole number
    assert np.allclose(held.score, (held.tree_prediction + held.ridge_prediction) / 2)
    # later months than the projected ones are not scored with their actual values
    early = fc.validate_holdout(panel, fq.ratios(spark, SF), pq.CUT, 2, 2, fq.HORIZON).toPandas()
    assert set(early.month) == {3, 4}


def test_attribution_adds_up(spark, panel):
    rows = fc.complete(panel).join(fc.fit_ridge(panel), "terminal_id")
    total = fc.linear_attribution(rows, ["terminal_id", "idx"]).groupBy("terminal_id", "idx").sum("attribution").toPandas()
    scored = rows.withColumn("p", fc.ridge_prediction()).toPandas()
    scored["p"] -= scored.groupby("terminal_id").p.transform("mean")
    both = total.merge(scored, on=["terminal_id", "idx"])
    assert np.allclose(both["sum(attribution)"], both["p"], atol=1e-6)


def plain_trees(x, y, trees, depth, step, l1, l2):
    """Every split of every node tried on sorted rows; trees as nested tuples."""
    def soft(g):
        return np.sign(g) * max(abs(g) - l1, 0)

    def grow(rows, g, levels):
        total = g[rows].sum()
        best = (1e-6, None)
        for f in range(x.shape[1] if levels else 0):
            values = sorted(set(x[rows, f]))
            everywhere = sorted(set(x[:, f]))
            for low, high in zip(everywhere, everywhere[1:]):
                cut = (low + high) / 2
                left, right = [r for r in rows if x[r, f] < cut], [r for r in rows if x[r, f] >= cut]
                if not left or not right or len(values) < 2:
                    continue
                gain = (soft(g[left].sum()) ** 2 / (len(left) + l2) + soft(g[right].sum()) ** 2 / (len(right) + l2)
                        - soft(total) ** 2 / (len(rows) + l2))
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, (f, cut, left, right))
        if best[1] is None:
            return len(rows), -step * soft(total) / (len(rows) + l2)
        f, cut, left, right = best[1]
        return len(rows), f, cut, grow(left, g, levels - 1), grow(right, g, levels - 1)

    def value(tree, row):
        while len(tree) == 5:
            tree = tree[3] if row[tree[1]] < tree[2] else tree[4]
        return tree[1]

    predicted, out = np.full(len(y), y.mean()), []
    for _ in range(trees):
        out.append(grow(list(range(len(y))), predicted - y, depth))
        predicted = predicted + [value(out[-1], row) for row in x]
    return out, predicted


def leaf_sum(leaves, base, row):
    return base + sum(v for v, box in leaves if all(low <= row[f] < high for f, (low, high, _) in box.items()))


@pytest.mark.parametrize("l1,l2", [(0.0, 0.0), (1.0, 1.0), (40.0, 3.0)])
def test_splits_and_leaves_equal_plain_enumeration(l1, l2):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (24, 3)).astype(float)
    y = 10 * x[:, 0] - 4 * x[:, 1] * (x[:, 2] > 4) + rng.normal(0, 3, 24)
    trees, want = plain_trees(x, y, 6, 3, 0.3, l1, l2)
    base, leaves = boosting.fit(x, y, 6, 3, 0.3, l1, l2)
    assert np.allclose([leaf_sum(leaves, base, row) for row in x], want)

    def plain_leaves(tree):
        return [tree[1]] if len(tree) == 2 else plain_leaves(tree[3]) + plain_leaves(tree[4])

    assert np.allclose([v for v, _ in leaves], [v for t in trees for v in plain_leaves(t)])


def test_penalties_shrink_leaves_to_nothing():
    x, y = np.arange(8.0)[:, None], np.array([1.0, 2, 3, 4, 5, 6, 7, 8])
    assert {v for v, _ in boosting.fit(x, y, 2, 2, 0.1, 1e6, 1.0)[1]} <= {0.0}
    base, leaves = boosting.fit(np.ones((3, 2)), np.array([4.0, 4.0, 4.0]), 2, 2, 0.1, 1.0, 1.0)  # nothing to split
    assert base == 4.0 and all(v == 0 and not box for v, box in leaves)
    assert len(boosting.cut_points(np.arange(1000.0), 16)) <= 15


def test_tree_attribution_equals_all_subsets(spark, panel):
    """Shapley values from the definition: features outside a subset follow both branches, weighted by their rows."""
    rows = panel.filter("terminal_id IN ('terminal_2', 'terminal_7')").toPandas()
    got = fc.tree_attribution(
        fc.complete(panel).join(fc.fit_trees(panel), "terminal_id"), ["terminal_id", "idx"]).toPandas()
    k = len(fv.FEATURES)
    for terminal, own in rows.groupby("terminal_id"):
        own = own.sort_values(["idx", "volume"])
        x, y = own[fv.FEATURES].to_numpy(float), own["volume"].to_numpy(float)
        trees, predicted = plain_trees(x, y, fv.TREE_COUNT, fv.TREE_DEPTH, fv.TREE_STEP, fv.TREE_L1, fv.TREE_L2)

        def expected(tree, row, known):
            if len(tree) == 2:
                return tree[1]
            n, f, cut, left, right = tree
            if f in known:
                return expected(left if row[f] < cut else right, row, known)
            return (left[0] * expected(left, row, known) + right[0] * expected(right, row, known)) / n

        def used(tree):
            return set() if len(tree) == 2 else {tree[1]} | used(tree[3]) | used(tree[4])

        row, idx = x[-1], own["idx"].iloc[-1]
        want = np.zeros(k)
        for tree in trees:
            players = sorted(used(tree))
            for j in players:
                others = [p for p in players if p != j]
                for size in range(len(others) + 1):
                    weight = factorial(size) * factorial(len(players) - size - 1) / factorial(len(players))
                    for subset in combinations(others, size):
                        want[j] += weight * (expected(tree, row, {*subset, j}) - expected(tree, row, set(subset)))
        mine = got[(got.terminal_id == terminal) & (got.idx == idx)].set_index("feature").attribution
        assert np.allclose([mine[c] for c in fv.FEATURES], want, atol=1e-6)


def test_recursion_is_the_step_loop(spark, panel):
    """Each step taken by itself: a panel that already holds the steps before gives the same operational features."""
    ratios = fq.ratios(spark, SF)
    state = fc.series_state(panel, ratios, fq.HORIZON)
    whole = fc.project_operations(state, 6, fq.HORIZON).toPandas().set_index(["terminal_id", "idx"]).sort_index()
    known = {c: state.select("terminal_id", f"m_{c}").toPandas().set_index("terminal_id")[f"m_{c}"].to_dict() for c in fc.OPERATIONS}
    rest = state.select("terminal_id", "last_idx", "fallbacks", "own_share")
    schema = "terminal_id string, " + ", ".join(f"m_{c} map<int, double>" for c in fc.OPERATIONS)
    for k in range(1, 4):
        maps = spark.createDataFrame([(t, *[known[c][t] for c in fc.OPERATIONS]) for t in known["vessel_count"]], schema)
        now = rest.join(maps, "terminal_id")
        one = now.select("terminal_id", (now.last_idx + k).alias("idx"), *[
            fc.projected_operation(c, now.last_idx + k, fq.HORIZON).alias(c) for c in fc.OPERATIONS]).collect()
        for r in one:
            for c in fc.OPERATIONS:
                assert r[c] == pytest.approx(whole.loc[(r.terminal_id, r.idx), c])
                known[c][r.terminal_id] = {**known[c][r.terminal_id], r.idx: float(r[c])}


def test_flat_terminal_takes_its_own_means(spark, panel):
    """Terminal 7 is not projected: means of its own history, also for the share, and the documented constants."""
    cut = panel.filter("terminal_id <> 'terminal_7' OR period <> 9")  # no September in its history
    state = fc.series_state(cut, fq.ratios(spark, SF), fq.HORIZON)
    got = fc.project_operations(state.filter("terminal_id = 'terminal_7'"), 6, fq.HORIZON).toPandas().set_index("idx")
    actual = cut.filter(f"terminal_id = 'terminal_7' AND year < {pq.CUT}").toPandas()
    for idx, r in got.iterrows():
        mine = actual[actual.period == idx % 12 + 1]
        for c in fc.OPERATIONS:
            none = fv.FLAT_SHARE_LAST_RESORT if c == "transship_ratio" else fv.FEATURE_LAST_RESORT[c]
            assert r[c] == pytest.approx(mine[c].astype(float).mean() if len(mine) else none)
    assert any(idx % 12 + 1 == 9 for idx in got.index)
