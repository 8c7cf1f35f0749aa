from datetime import date, timedelta
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.functions import css
from demandloom.operators import diagnostics, evaluate, forecast, linear, runs, series, tuning
from demandloom.operators import forecast_fold as folds
from demandloom.plans import pairs, topdown, total
from demandloom.schemas import EXOG, PAIR

KEY = ["series"]


def naive_innovations(y, x, order, beta, ar, sar, ma, sma, start, s=7):
    """The model written out term by term."""
    p, d, q, sp, sd, sq = order
    a = np.polynomial.polynomial.polymul(
        np.r_[1, -np.array(ar)] if p else [1.0],
        np.r_[1, *[v for c in sar for v in [0] * (s - 1) + [-c]]] if sp else [1.0],
    )
    for lag, times in ((1, d), (s, sd)):
        for _ in range(times):
            a = np.polynomial.polynomial.polymul(a, np.r_[1, [0] * (lag - 1), -1])
    m = np.polynomial.polynomial.polymul(
        np.r_[1, ma] if q else [1.0],
        np.r_[1, *[v for c in sma for v in [0] * (s - 1) + [c]]] if sq else [1.0],
    )
    z = y - x @ np.array(beta)
    e = np.zeros(len(y))
    for t in range(start, len(y)):
        e[t] = sum(a[k] * z[t - k] for k in range(len(a))) - sum(
            m[k] * e[t - k] for k in range(1, len(m)) if t >= k
        )
    return e, z, a, m


def simulate(n, seed=0, phi=0.6, theta=0.4, sphi=0.5, stheta=0.3, beta=(2.0, -1.0)):
    rng = np.random.default_rng(seed)
    e, u = rng.normal(size=n + 200), np.zeros(n + 200)
    for t in range(9, n + 200):
        u[t] = (
            phi * u[t - 1] + sphi * u[t - 7] - phi * sphi * u[t - 8]
            + e[t] + theta * e[t - 1] + stheta * e[t - 7] + theta * stheta * e[t - 8]
        )
    x = np.column_stack([rng.normal(size=n) * 10, rng.uniform(40, 60, n)])
    return u[200:] + x @ np.array(beta), x


def test_division_by_lag_polynomials():
    rng = np.random.default_rng(1)
    for n, step, days, width in ((2, 1, 100, 3), (1, 7, 100, 3), (3, 1, 53, 1), (2, 7, 40, 2), (1, 7, 5, 1)):
        x, c = rng.normal(size=(days, 4, width)), rng.normal(size=(4, n)) * 0.4
        c[1] = 0
        want = x.copy()
        for t in range(days):
            for j in range(1, n + 1):
                if t >= j * step:
                    want[t] -= c[:, [j - 1]] * want[t - j * step]
        assert np.allclose(want, css.divide(c, step, x))


def test_recovers_known_parameters():
    y, x = simulate(3000)
    order = np.array([[1, 0, 1, 1, 0, 1, 0]])
    params, sse, ok, _, lay = css.fit(y[:, None], x[:, None, :], order, np.array([17]))
    assert ok.all()
    assert params[0, lay.at["beta"]] == pytest.approx([2, -1], abs=0.02)
    for name, want in (("ar", 0.6), ("sar", 0.5), ("ma", 0.4), ("sma", 0.3)):
        assert params[0, lay.at[name]] == pytest.approx([want], abs=0.08)
    assert sse[0] / (3000 - 17) == pytest.approx(1.0, abs=0.08)


@pytest.mark.parametrize("order", [(1, 0, 1, 1, 0, 1), (2, 1, 1, 0, 1, 1), (0, 1, 2, 1, 0, 0)])
def test_fit_is_a_minimum_of_the_written_out_sum(order):
    y, x = simulate(300, seed=3)
    orders = np.array([[*order, 0]])
    params, sse, ok, _, lay = css.fit(y[:, None], x[:, None, :], orders, np.array([17]))

    def total(vector):
        parts = [vector[lay.at[n]] for n in ("beta", "ar", "sar", "ma", "sma")]
        return (naive_innovations(y, x, order, *parts, start=17)[0] ** 2).sum()

    assert ok.all() and total(params[0]) == pytest.approx(sse[0], rel=1e-9)
    for i in np.flatnonzero(lay.free(orders)[0]):
        for step in (-1e-2, 1e-2):
            moved = params[0].copy()
            moved[i] += step
            assert total(moved) >= sse[0] * (1 - 1e-6)


def test_lanes_do_not_influence_each_other():
    y, x = simulate(250, seed=5)
    grid = np.array([(p, d, q, 1, 0, 1, 0) for p, d, q in product(range(3), range(2), range(2))])
    lanes = len(grid)
    _, together, *_ = css.fit(
        np.repeat(y[:, None], lanes, 1), np.repeat(x[:, None], lanes, 1), grid, np.full(lanes, 17)
    )
    for i in range(lanes):
        _, alone, *_ = css.fit(y[:, None], x[:, None, :], grid[[i]], np.array([17]))
        assert alone[0] == pytest.approx(together[i], rel=1e-4)


def test_padded_lane_equals_unpadded():
    y, x = simulate(120, seed=6)
    order = np.array([[1, 1, 1, 0, 1, 1, 0]])
    _, want, *_ = css.fit(y[:, None], x[:, None, :], order, np.array([17]))
    yy, xx, pad = tuning.stack_lanes([y, np.zeros(200)], [x.T, np.zeros((2, 200))], 2)
    _, got, *_ = css.fit(yy[:, :1], xx[:, :1], order, pad[:1] + 17)
    assert pad.tolist() == [80, 0] and got[0] == pytest.approx(want[0], rel=1e-9)


def test_forecast_follows_the_written_out_recursion():
    y, x = simulate(200, seed=8)
    order = (2, 1, 1, 1, 1, 1)
    orders = np.array([[*order, 0]])
    params, *_, lay = css.fit(y[:, None], x[:, None, :], orders, np.array([17]))
    x_future = np.ones((15, 2))
    got = css.forecast(y[:, None], x[:, None], x_future[:, None], params, orders, np.array([17]), lay)
    parts = [params[0, lay.at[n]] for n in ("beta", "ar", "sar", "ma", "sma")]
    e, z, a, m = naive_innovations(y, x, order, *parts, start=17)
    z, e = np.r_[z, np.zeros(15)], np.r_[e, np.zeros(15)]
    for t in range(200, 215):
        z[t] = -sum(a[k] * z[t - k] for k in range(1, len(a))) + sum(
            m[k] * e[t - k] for k in range(1, len(m))
        )
    assert got[:, 0] == pytest.approx(z[200:] + x_future @ parts[0])


def test_intercept_and_drift():
    rng = np.random.default_rng(2)
    y = 5.0 + 0.5 * np.arange(300) + rng.normal(size=300) * 0.01
    orders = np.array([[0, 1, 0, 0, 0, 0, 1]])
    params, *_, lay = css.fit(y[:, None], np.zeros((300, 1, 0)), orders, np.array([9]))
    assert params[0, lay.at["const"]] == pytest.approx([0.5], abs=0.01)
    out = css.forecast(y[:, None], np.zeros((300, 1, 0)), np.zeros((10, 1, 0)), params, orders, np.array([9]), lay)
    assert out[:, 0] == pytest.approx(y[-1] + 0.5 * np.arange(1, 11), abs=0.1)


# --- on Spark -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def synthetic(spark):
    """200 days of trend, weekly wave and noise, with four regressors."""
    rng = np.random.default_rng(42)
    wave = 20 * np.sin(2 * np.pi * np.arange(200) / 7)
    y = np.maximum(np.linspace(100, 200, 200) + wave + rng.normal(0, 5, 200), 0)
    rows = [
        (
            "total", date(2017, 1, 1) + timedelta(t), float(y[t]), int(rng.integers(0, 100)),
            float(rng.uniform(40, 60)), float(rng.random() < 0.1), (6 + t) % 7,
        )
        for t in range(200)
    ]
    return spark.createDataFrame(
        rows,
        "series string, date date, total_cashflow double, onpromotion int, oil_price double, "
        "is_holiday double, day_of_week int",
    ).persist()


@pytest.fixture(scope="module")
def packed(synthetic):
    return series.pack_series(synthetic, KEY, "total_cashflow", EXOG).persist()


def future_days(spark, steps=15):
    rows = [("total", date(2017, 7, 20) + timedelta(k), 0.0, 50.0, 0.0, k % 7) for k in range(steps)]
    return spark.createDataFrame(
        rows, "series string, date date, onpromotion double, oil_price double, is_holiday double, day_of_week int"
    )


def one_order(spark, **order):
    """The order as a table, one row per series."""
    base = dict.fromkeys(tuning.ORDER_COLS, 0) | order
    return spark.range(1).select(F.lit("total").alias("series"), *[F.lit(v).alias(k) for k, v in base.items()])


def test_fit_save_and_forecast(spark, packed, tmp_path):
    from demandloom.sources import sinks

    orders = one_order(spark, p=1, q=1, seasonal_p=1, seasonal_q=1)
    model = tuning.fit_orders(packed, orders, KEY, len(EXOG))
    sinks.write_models(model, str(tmp_path), "total", 1)
    saved = sinks.read_models(spark, str(tmp_path), "total", 1)
    row = saved.first()
    assert row.converged and np.isfinite([row.aic, row.bic]).all() and len(row.params) == 8
    asked = series.pack_series(future_days(spark), KEY, None, EXOG)
    out = forecast.forecast_series(saved, packed, asked, KEY, len(EXOG)).orderBy("step").collect()
    assert [r.step for r in out] == list(range(1, 16))
    assert all(100 < r.forecast < 300 for r in out)
    back = sinks.orders_from_json(sinks.orders_json(saved, KEY), KEY).first()
    assert [back[c] for c in tuning.ORDER_COLS] == [1, 0, 1, 1, 0, 1] and back.aic == row.aic


def test_weekly_difference_repeats_the_last_week(spark, synthetic):
    packed = series.pack_series(synthetic, KEY, "total_cashflow", [])
    model = tuning.fit_orders(packed, one_order(spark, seasonal_d=1), KEY, 0)
    asked = series.pack_series(future_days(spark), KEY, None, [])
    out = forecast.forecast_series(model, packed, asked, KEY, 0).orderBy("step").collect()
    last = [r.total_cashflow for r in synthetic.orderBy("date").collect()][-7:]
    assert [r.forecast for r in out] == pytest.approx((last * 3)[:15])


def test_small_grid(packed):
    space = dict.fromkeys(tuning.ORDER_COLS, [0]) | {"p": [0, 1], "q": [1], "seasonal_q": [1]}
    trials = tuning.grid_search(packed, KEY, len(EXOG), space, blocks=2)
    best = tuning.best_trials(trials, KEY).first()
    assert trials.count() == 2 and best.total_trials == 2 and best.successful_trials == 2
    assert np.isfinite(best.aic) and best.trial_id in (0, 1)
    assert best.aic == min(r.aic for r in trials.collect())


def test_blocks_do_not_change_trials(packed):
    space = dict.fromkeys(tuning.ORDER_COLS, [0]) | {"p": [0, 1, 2], "q": [0, 1]}
    one = tuning.grid_search(packed, KEY, len(EXOG), space, blocks=1, partitions=1)
    many = tuning.grid_search(packed, KEY, len(EXOG), space, blocks=4, partitions=4)
    a, b = ({r.trial_id: r.aic for r in t.collect()} for t in (one, many))
    assert a.keys() == b.keys() == set(range(6))
    assert all(a[k] == pytest.approx(b[k], rel=1e-4) for k in a)


def test_grid_order(spark):
    rows = tuning.plan_trials(spark.range(1)).orderBy("trial_id").collect()
    want = list(product(*tuning.SPACE.values()))
    assert [tuple(r[c] for c in tuning.ORDER_COLS) for r in rows] == want and len(want) == 144


def made(spark, rows):
    df = spark.createDataFrame(rows, "series string, trial_id int, aic double, converged boolean")
    extra = {c: F.lit(0) for c in tuning.ORDER_COLS}
    extra |= {"intercept": F.lit(0), "bic": F.lit(1.0), "sigma2": F.lit(1.0), "params": F.array(F.lit(1.0))}
    return df.withColumns(extra | {"p": F.col("trial_id")})


def test_selection_ties_failures_and_fallback(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        ("tie", 3, 5.0, True), ("tie", 1, 5.0, True), ("tie", 2, nan, True), ("tie", 0, -inf, True),
        ("none", 0, nan, True), ("none", 1, None, False),
    ]
    best = {r.series: r for r in tuning.best_trials(made(spark, rows), KEY).collect()}
    assert best["tie"].trial_id == 1 and best["tie"].p == 1
    assert best["none"].trial_id is None and not best["none"].converged
    assert [best["none"][c] for c in tuning.ORDER_COLS] == [1] * 6
    assert (best["none"].total_trials, best["none"].successful_trials) == (2, 1)


def test_short_and_broken_series_fail_quietly(spark):
    rows = [("short", date(2017, 1, 1) + timedelta(t), float(t), 1.0) for t in range(10)]
    rows += [("gap", date(2017, 1, 1) + timedelta(t), float(t % 7), None) for t in range(60)]
    rows += [("flat", date(2017, 1, 1) + timedelta(t), float(t % 5), 0.0) for t in range(60)]
    df = spark.createDataFrame(rows, "series string, date date, y double, x double")
    packed = series.pack_series(df, KEY, "y", ["x"])
    space = dict.fromkeys(tuning.ORDER_COLS, [0]) | {"p": [0, 1]}
    best = {r.series: r for r in tuning.best_trials(tuning.grid_search(packed, KEY, 1, space), KEY).collect()}
    assert best["short"].converged and not best["gap"].converged and best["flat"].converged
    model = tuning.refit_best(packed, tuning.best_trials(tuning.grid_search(packed, KEY, 1, space), KEY), KEY, 1)
    asked = df.groupBy("series").agg(F.date_add(F.max("date"), 1).alias("date")).withColumn("x", F.lit(0.0))
    out = forecast.forecast_series(model, packed, series.pack_series(asked, KEY, None, ["x"]), KEY, 1)
    got = {r.series: r.forecast for r in out.collect()}
    assert got["short"] is not None and got["gap"] is None and got["flat"] is not None


def test_short_series_are_searched_and_refitted(spark):
    """Orders are refused only where no more days than parameters are left."""
    rng = np.random.default_rng(8)
    rows = [(f"n{n}", date(2017, 1, 1) + timedelta(t), float(10 + rng.normal())) for n in (3, 10, 21, 30) for t in range(n)]
    packed = series.pack_series(spark.createDataFrame(rows, "series string, date date, y double"), KEY, "y", [])
    trials = tuning.grid_search(packed, KEY, 0)
    by_series = {r.series: r for r in trials.groupBy("series").agg(F.count("aic").alias("n")).collect()}
    assert by_series["n3"].n < by_series["n10"].n < by_series["n21"].n <= by_series["n30"].n == 144
    best = tuning.best_trials(trials, KEY)
    model = {r.series: r for r in tuning.refit_best(packed, best, KEY, 0).collect()}
    chosen = {r.series: r for r in best.collect()}
    for name in ("n10", "n21", "n30"):
        order = [chosen[name][c] for c in tuning.ORDER_COLS]
        assert model[name].params is not None and model[name].n_obs == int(name[1:])
        assert [model[name][c] for c in tuning.ORDER_COLS] == order
        assert model[name].at_iteration_limit in (True, False)


def test_a_fit_uses_all_days_but_those_of_its_own_lags(spark):
    rows = [("a", date(2017, 1, 1) + timedelta(t), float(t % 5 + t % 3)) for t in range(60)]
    packed = series.pack_series(spark.createDataFrame(rows, "series string, date date, y double"), KEY, "y", [])
    y = np.array([r[2] for r in rows])
    fitted = tuning.fit_orders(packed, {"p": 1}, KEY, 0).first()
    phi = (y[1:] * y[:-1]).sum() / (y[:-1] ** 2).sum()
    assert fitted.params[0] == pytest.approx(phi, rel=1e-6)
    assert fitted.sigma2 == pytest.approx(((y[1:] - phi * y[:-1]) ** 2).mean(), rel=1e-6)


def test_closed_forms_equal_the_kernel(spark):
    """Spark's normal equations against the kernel, on the days the trials share."""
    rng = np.random.default_rng(4)
    y = np.cumsum(rng.normal(size=80)) + 5
    rows = [("a", date(2017, 1, 1) + timedelta(t), float(v)) for t, v in enumerate(y)]
    trials = linear.linear_trials(spark.createDataFrame(rows, "series string, date date, sales double"), KEY).collect()
    assert len(trials) == 16
    for r in trials:
        orders = np.array([[r.p, r.d, 0, r.seasonal_p, r.seasonal_d, 0, 0]])
        params, sse, *_, lay = css.fit(y[:, None], np.zeros((80, 1, 0)), orders, np.array([linear.SKIPPED]))
        assert r.sse == pytest.approx(sse[0], rel=1e-6) and r.n_obs == 80 - linear.SKIPPED
        assert r.params == pytest.approx(params[0][lay.free(orders)[0]], abs=1e-5)


def test_regressions_with_regressors_equal_least_squares(spark):
    """Every order beside four regressors, two series, one of them with a regressor that depends on the others."""
    rng = np.random.default_rng(8)
    rows, own = [], {}
    for name in ("free", "tied"):
        x = rng.normal(size=(90, 4))
        if name == "tied":
            x[:, 3] = 2 * x[:, 0] - x[:, 1]
        y = np.cumsum(rng.normal(size=90)) + x @ [3, -1, 0.5, 2]
        own[name] = y, x
        rows += [(name, date(2017, 1, 1) + timedelta(t), float(y[t]), *map(float, x[t])) for t in range(90)]
    rows += [("short", date(2017, 1, 1) + timedelta(t), 1.0, 0.0, 0.0, 0.0, 0.0) for t in range(12)]
    rows += [("free", date(2019, 1, 1), None, 0.0, 0.0, 0.0, 0.0)]
    days = spark.createDataFrame(rows, "series string, date date, sales double, a double, b double, c double, e double")
    trials = linear.linear_trials(days, KEY, exog=["a", "b", "c", "e"]).collect()
    assert len(trials) == 32 and {r.series for r in trials} == {"free", "tied"}
    for r in trials:
        y, x = own[r.series]
        table = np.column_stack([y, x])
        for lag in linear.difference_steps(r.d, r.seasonal_d):
            table = table[lag:] - table[:-lag]
        lags = [*range(1, r.p + 1), *[7] * r.seasonal_p]
        at = np.arange(len(table) - 75, len(table))
        design = np.column_stack([table[at, 1:], *(table[at - lag, 0] for lag in lags)])
        if r.series == "tied":
            assert r.aic is None
            continue
        want, sse, *_ = np.linalg.lstsq(design, table[at, 0], rcond=None)
        assert r.n_obs == 75 and r.params == pytest.approx(list(want), rel=1e-6, abs=1e-9)
        assert r.sse == pytest.approx(sse[0], rel=1e-7)


def test_two_stage_averages_equal_least_squares(spark):
    """Both regressions by least squares, a known moving average found again, and series that allow none."""
    rng = np.random.default_rng(6)
    shocks = rng.normal(size=1500)
    own = {"short": rng.normal(size=60).cumsum(), "long": np.cumsum(shocks[1:] + 0.6 * shocks[:-1])}
    rows = [(name, date(2010, 1, 1) + timedelta(t), float(v)) for name, y in own.items() for t, v in enumerate(y)]
    rows += [("flat", date(2010, 1, 1) + timedelta(t), 5.0) for t in range(40)]
    rows += [("brief", date(2010, 1, 1) + timedelta(t), float(t * t)) for t in range(16)]
    rows += [("long", date(2020, 1, 1), None)]
    days = spark.createDataFrame(rows, "series string, date date, sales double")
    trials = linear.two_stage_trials(days, KEY, d=1)
    found = trials.collect()
    assert len(found) == 72 and {r.series for r in found} == {"short", "long", "flat"}
    for r in found:
        if r.series == "flat":
            assert r.aic is None
            continue
        z = np.diff(own[r.series])
        at = np.arange(8, len(z))
        lags = np.column_stack([z[at - k] for k in range(1, 9)])
        e = np.zeros(len(z))
        e[at] = z[at] - lags @ np.linalg.lstsq(lags, z[at], rcond=None)[0]
        at = np.arange(15, len(z))
        back = [*((z, k) for k in range(1, r.p + 1)), *[(z, 7)] * r.seasonal_p]
        back += [*((e, k) for k in range(1, r.q + 1)), *[(e, 7)] * r.seasonal_q]
        design = np.column_stack([v[at - k] for v, k in back]) if back else np.zeros((len(at), 0))
        want = np.linalg.lstsq(design, z[at], rcond=None)[0]
        sse = ((z[at] - design @ want) ** 2).sum()
        assert r.n_obs == len(at) and r.params == pytest.approx(list(want), rel=1e-6, abs=1e-9)
        assert r.sse == pytest.approx(sse, rel=1e-9)
        assert r.aic == pytest.approx(2 * (len(back) + 1) + len(at) * (np.log(2 * np.pi * sse / len(at)) + 1))
        if r.series == "long" and (r.p, r.q, r.seasonal_p, r.seasonal_q) == (0, 1, 0, 0):
            assert r.params[0] == pytest.approx(0.6, abs=0.06)
    best = {r.series: r for r in linear.linear_best(trials, KEY, ("p", "q", "seasonal_p", "seasonal_q")).collect()}
    assert best["long"].q > 0 and best["flat"].q is None


def test_two_stage_shuffles_the_days_once(spark):
    schema = "series string, date date, sales double"
    days = spark.createDataFrame([("a", date(2020, 1, 1), 1.0)], schema)
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        plan = linear.two_stage_trials(days, KEY, d=1)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("+- Exchange ") == 1 and plan.count("ReusedExchange") == 1 and "SortMergeJoin" in plan
    assert linear.two_stage_trials(spark.createDataFrame([], schema), KEY).count() == 0


@pytest.mark.parametrize(
    "order", [(0, 0, 0, 0, 0, 0, 0), (2, 1, 1, 1, 1, 1, 0), (1, 0, 2, 0, 1, 1, 1), (0, 2, 0, 2, 0, 2, 1), (3, 0, 0, 0, 0, 0, 1)]
)
def test_folds_equal_the_kernel(spark, order):
    rng = np.random.default_rng(sum(order))
    rows, want = [], {}
    lay = css.Layout(2, order[0], order[2], order[3], order[5], 7)
    for name, n in (("long", 60), ("short", 5), ("none", 0)):
        y, x, ahead = rng.normal(size=n) * 5, rng.normal(size=(2, n)), rng.normal(size=(2, 9))
        params = rng.uniform(-0.4, 0.4, size=int(lay.free(np.array([order]))[0].sum()))
        full = np.zeros((1, lay.size))
        full[lay.free(np.array([order]))] = params
        start = css.warmup(order[0], order[1], order[3], order[4], 7)
        out = css.forecast(y[:, None], x.T[:, None, :], ahead.T[:, None, :], full, np.array([order]), np.array([start]), lay)
        want[name] = out[:, 0]
        dates = [date(2017, 1, 1) + timedelta(t) for t in range(9)]
        rows.append((name, y.tolist(), x.tolist(), dates, ahead.tolist(), list(order), params.tolist()))
    rows.append(("no model", [1.0], [[1.0], [1.0]], dates, ahead.tolist(), None, None))
    kinds = "series string, y array<double>, x array<array<double>>, dates array<date>, x_future array<array<double>>, orders array<int>, params array<double>"
    for r in folds.folded(spark.createDataFrame(rows, kinds), 2, 7).collect():
        assert r.f is None if r.series == "no model" else r.f == pytest.approx(list(want[r.series]), rel=1e-9, abs=1e-9)


def test_differences_follow_level_and_season(spark):
    rng = np.random.default_rng(2)
    noise = rng.normal(size=400)
    made = {
        "noise": (noise, (0, 0)), "walk": (np.cumsum(noise), (1, 0)), "twice": (np.cumsum(np.cumsum(noise)), (2, 0)),
        "season": (noise + 10 * np.sin(np.arange(400) * 2 * np.pi / 7), (0, 1)), "flat": (np.ones(50), (0, 0)), "one": (np.ones(1), (0, 0)),
    }
    packed = spark.createDataFrame([(k, v.tolist()) for k, (v, _) in made.items()] + [("empty", [])], "series string, y array<double>")
    got = {r.series: (r.d, r.seasonal_d) for r in diagnostics.differences(packed, KEY).collect()}
    assert got == {k: v for k, (_, v) in made.items()} | {"empty": (0, 0)}


def test_stepwise_keeps_fixed_differences(spark, packed):
    fixed = packed.select(*KEY).withColumns({"d": F.lit(0), "seasonal_d": F.lit(1)})
    trials = tuning.stepwise_search(packed, KEY, len(EXOG), blocks=4, differences=fixed).collect()
    assert {(r.d, r.seasonal_d) for r in trials} == {(0, 1)} and len(trials) > 4


def test_fits_are_spread_over_the_cores(spark):
    rows = [(f"s{n}", date(2017, 1, 1) + timedelta(t), float(t % 4 + n)) for n in range(150) for t in range(12)]
    packed = series.pack_series(spark.createDataFrame(rows, "series string, date date, y double"), KEY, "y", [])
    fitted = tuning.fit_orders(packed, {"p": 1}, KEY, 0)
    assert fitted.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_stepwise_reaches_a_local_best(packed):
    trials = tuning.stepwise_search(packed, KEY, len(EXOG), blocks=4).collect()
    orders = [tuple(r[n] for n in tuning.STEP_BOUNDS) for r in trials]
    assert len(orders) == len(set(orders)), "no order is fitted twice"
    assert {tuple(t) for t in tuning.STEP_STARTS} <= set(orders)
    assert all(0 <= v <= b for o in orders for v, b in zip(o, tuning.STEP_BOUNDS.values()))
    best = min((r for r in trials if r.aic is not None), key=lambda r: (r.aic, r.trial_id))
    center = np.array([best[n] for n in tuning.STEP_BOUNDS])
    for move in tuning._moves():
        near = tuple(int(v) for v in center + np.array(move))
        if all(0 <= v <= b for v, b in zip(near, tuning.STEP_BOUNDS.values())):
            assert near in orders


def test_error_metrics(spark):
    df = spark.createDataFrame([(10.0, 8.0), (0.0, 3.0), (20.0, 25.0)], "actual double, forecast double")
    row = evaluate.error_metrics(df).first()
    assert row.mae == pytest.approx(10 / 3) and row.rmse == pytest.approx((38 / 3) ** 0.5)
    assert row.mape == pytest.approx((0.2 + 0.25) / 2 * 100)
    assert evaluate.error_metrics(df.where("actual = 0")).first().mape == 0.0


def test_pairing_by_position_stops_at_the_horizon(spark):
    ahead = spark.createDataFrame([(k, float(k)) for k in range(1, 6)], "step int, forecast double")
    real = spark.createDataFrame([(date(2017, 1, 2 * k), 10.0 * k) for k in range(1, 5)], "date date, y double")
    rows = evaluate.pair_with_actuals(ahead, real, "y", [], h=3).orderBy("step").collect()
    assert [(r.forecast, r.actual) for r in rows] == [(1.0, 10.0), (2.0, 20.0), (3.0, 30.0)]


def test_packed_parts(spark):
    rows = [("a", date(2017, 1, n), float(n), "train" if n < 4 else "val") for n in range(1, 6)]
    rows += [("b", date(2017, 1, 1), 1.0, "train")]
    df = spark.createDataFrame(rows, "series string, date date, y double, split string")
    packed = series.pack_series(df, KEY, "y", ["y"])
    train = {r.series: r for r in series.train_part(packed).collect()}
    val = {r.series: r for r in series.validation_part(packed).collect()}
    assert train["a"].y == [1.0, 2.0, 3.0] and val["a"].x == [[4.0, 5.0]] and "b" not in val
    assert train["b"].x == [[1.0]]
    (both,) = series.holdout_rows(packed).collect()
    assert both.y == [1.0, 2.0, 3.0] and both.x == [[1.0, 2.0, 3.0]]
    assert both.x_future == [[4.0, 5.0]] and both.actuals == [4.0, 5.0] and len(both.dates) == 2


# --- plans --------------------------------------------------------------------------------

SPACE = dict.fromkeys(tuning.ORDER_COLS, [1]) | {"d": [0, 1], "seasonal_p": [0, 1]}


@pytest.fixture(scope="module")
def shop(spark):
    """Two stores, two families, 150 days, and a 15-day request with one unknown pair."""
    rng = np.random.default_rng(7)
    sold, asked, n = [], [], 0
    for t in range(165):
        day = date(2017, 1, 1) + timedelta(t)
        for store, family in product((1, 2), ("A", "B")):
            n += 1
            level = 20 * store + 5 * np.sin(2 * np.pi * t / 7) + rng.normal()
            row = (n, day, store, family)
            promo = int(rng.integers(0, 5))
            sold.append((*row, float(level), promo)) if t < 150 else asked.append((*row, promo))
    asked.append((n + 1, date(2017, 6, 1), 9, "A", 0))
    sales = spark.createDataFrame(sold, "id bigint, date date, store_nbr int, family string, sales double, onpromotion bigint")
    request = spark.createDataFrame(asked, "id bigint, date date, store_nbr int, family string, onpromotion bigint")
    days = [date(2017, 1, 1) + timedelta(t) for t in range(165)]
    oil = spark.createDataFrame([(d, 50.0 + d.day if d.weekday() < 5 else None) for d in days], "date date, dcoilwtico double")
    free = spark.createDataFrame([(d, "Holiday", False) for d in days if d.day == 1], "date date, type string, transferred boolean")
    return sales, request, oil, free


def test_top_down_plan(shop):
    sales, request, oil, free = shop
    out = topdown.top_down(sales, request, oil, free, space=SPACE)
    rows = {r.id: r.sales for r in out["submission"].collect()}
    assert len(rows) == request.count() and min(rows.values()) >= 0
    assert rows[max(rows)] == 0.0  # unknown pair
    total_day = out["scored"].where("date = '2017-05-31'").agg(F.sum("sales")).first()[0]
    assert total_day == pytest.approx(120, rel=0.25)
    metrics = out["metrics"].first()
    assert metrics.val_rows == 15 and metrics.mape < 10


def test_history_mode_moves_the_first_step(shop):
    sales, request, oil, free = shop
    full = topdown.top_down(sales, request, oil, free, space=SPACE)["submission"]
    train = topdown.top_down(sales, request, oil, free, space=SPACE, history="train")["submission"]
    a, b = ({r.id: r.sales for r in x.collect()} for x in (full, train))
    assert a.keys() == b.keys() and any(abs(a[k] - b[k]) > 1e-6 for k in a)


def test_pair_plan(shop):
    sales, request, oil, free = shop
    out = pairs.pair_forecasts(sales, request, oil, free, space=SPACE)
    rows = out["forecast"].collect()
    assert len(rows) == request.count()
    known = [r for r in rows if r.store_nbr != 9]
    assert all(abs(r.sales - 20 * r.store_nbr) < 15 for r in known)
    assert [(r.sales, r.basis) for r in rows if r.store_nbr == 9] == [(0.0, "none")]
    assert out["metrics"].count() == 4
    one = pairs.pair_forecasts(
        sales.where("store_nbr = 1 AND family = 'A'"), request.where("store_nbr = 1 AND family = 'A'"),
        oil, free, space=SPACE, blocks=2,
    )["forecast"].collect()
    want = {r.id: r.sales for r in known if (r.store_nbr, r.family) == (1, "A")}
    assert {r.id: r.sales for r in one} == pytest.approx(want, rel=1e-3)


def test_total_plan(shop):
    sales, _, oil, free = shop
    out = total.total_forecast(sales, oil, free)
    rows = out["forecast"].orderBy("date").collect()
    assert out["forecast"].columns == ["date", "predicted_cashflow", "is_holiday", "oil_price"]
    assert [r.date for r in rows] == [date(2017, 5, 31) + timedelta(k) for k in range(15)]
    assert all(r.predicted_cashflow == pytest.approx(120, rel=0.35) for r in rows)
    assert out["metrics"].first().val_rows == 15


def test_floored_count(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (float("nan"),)], "forecast double")
    row = forecast.floored_count(df).first()
    assert (row.forecast_length, row.negative_values_floored) == (3, 1)


def test_checkpoint_needs_a_shared_folder(spark):
    assert runs.checkpointed(spark.range(3)).count() == 3
