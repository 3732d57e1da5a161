"""Fits and filters against plain loops, closed forms and simulated truth."""

import itertools
import math
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from heatline.functions import synthetic
from heatline.operators import autoreg, folds, garch, kalman, metrics, orders, recurrence

SCHEMA = "series string, idx bigint, y double"


def series(spark, **values):
    rows = [(name, i, None if np.isnan(v) else float(v))
            for name, ys in values.items() for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, SCHEMA)


def by_series(df, *columns):
    out = {}
    for r in df.collect():
        out.setdefault(r["series"], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v) for k, v in out.items()}


def seasonal_walk(seed, n, phi, big):
    rng = np.random.default_rng(seed)
    w, y = np.zeros(n), np.zeros(n)
    for t in range(n):
        a = w[t - 1] if t >= 1 else 0
        b = w[t - 12] if t >= 12 else 0
        c = w[t - 13] if t >= 13 else 0
        w[t] = phi * a + big * b - phi * big * c + rng.normal()
        y[t] = (y[t - 12] if t >= 12 else 50) + w[t]
    return y


def css(y, phi, big):
    w = y[12:] - y[:-12]
    e = w[13:] - phi * w[12:-1] - big * w[1:-12] + phi * big * w[:-13]
    return float(e @ e)


# -- seasonal model ------------------------------------------------------------------------------

def test_seasonal_fit_beats_a_grid_and_recovers_the_truth(spark):
    y = {f"s{i}": seasonal_walk(i, 600, phi, big)
         for i, (phi, big) in enumerate([(0.6, -0.4), (-0.3, 0.5), (0.0, 0.0)])}
    for r in autoreg.seasonal_fit(series(spark, **y)).collect():
        ys = y[r.series]
        assert r.css == pytest.approx(css(ys, r.phi, r.seasonal_phi), rel=1e-9)
        grid = np.linspace(-0.95, 0.95, 39)
        assert r.css <= min(css(ys, a, b) for a in grid for b in grid) + 1e-9
        phi, big = [(0.6, -0.4), (-0.3, 0.5), (0.0, 0.0)][int(r.series[1])]
        assert abs(r.phi - phi) < 0.12 and abs(r.seasonal_phi - big) < 0.12
        assert r.aic == pytest.approx(575 * np.log(r.css / 575) + 4)


def test_periodic_series_is_forecast_exactly(spark):
    y = np.tile(np.arange(12.0) ** 2, 8)
    got = by_series(autoreg.seasonal_forecast(series(spark, a=y)), "h", "forecast")["a"]
    assert [f for _, f in got] == pytest.approx([float((i % 12) ** 2) for i in range(24)])


@pytest.mark.parametrize("n,status,steps", [(1, "too_short", 0), (8, "too_short", 0),
                                            (27, "too_short", 0), (28, "ok", 7), (53, "ok", 13)])
def test_short_series(spark, n, status, steps):
    df = series(spark, a=np.random.default_rng(n).normal(size=n))
    fit = autoreg.seasonal_fit(df).first()
    assert (fit.status, fit.n) == (status, n)
    assert autoreg.seasonal_forecast(df).count() == steps


def test_constant_series(spark):
    df = series(spark, a=np.full(60, 7.0))
    fit = autoreg.seasonal_fit(df).first()
    assert (fit.phi, fit.seasonal_phi, fit.css, fit.aic) == (0, 0, 0, None)
    got = by_series(autoreg.seasonal_forecast(df), "h", "forecast")["a"]
    assert [f for _, f in got] == [7.0] * 15


def test_seasonal_forecast_follows_the_recursion(spark):
    y = seasonal_walk(5, 200, 0.5, 0.3)
    df = series(spark, a=y)
    fit = autoreg.seasonal_fit(df).first()
    ys = list(y)
    for _ in range(50):
        w = [ys[i] - ys[i - 12] for i in range(len(ys) - 13, len(ys))]
        step = (fit.phi * w[-1] + fit.seasonal_phi * w[-12] - fit.phi * fit.seasonal_phi * w[-13])
        ys.append(ys[-12] + step)
    got = by_series(autoreg.seasonal_forecast(df), "h", "forecast")["a"]
    assert [h for h, _ in got] == list(range(1, 51))
    assert [f for _, f in got] == pytest.approx(ys[200:])


def test_blocks_of_a_long_horizon_continue_each_other(spark):
    models = spark.createDataFrame(
        [("a", [1.2, -0.3, 0.05], 0.5, [1.0, 2.0, 4.0], 100), ("b", [1.0], 0.0, [7.0], 3)],
        "series string, coef array<double>, const double, tail array<double>, steps bigint")
    one, many = (by_series(recurrence.extend(models, block=b), "h", "forecast") for b in (4096, 7))
    assert [h for h, _ in many["a"]] == list(range(1, 101)) and many["b"] == [
        (1, 7.0), (2, 7.0), (3, 7.0)]
    assert [f for _, f in many["a"]] == pytest.approx([f for _, f in one["a"]])
    ys = [1.0, 2.0, 4.0]
    for _ in range(100):
        ys.append(0.5 + 1.2 * ys[-1] - 0.3 * ys[-2] + 0.05 * ys[-3])
    assert [f for _, f in one["a"]] == pytest.approx(ys[3:])


def test_stationary_option_clips(spark):
    y = np.cumprod(np.full(80, 1.1))
    free, kept = (autoreg.seasonal_fit(series(spark, a=y), stationary=s).first() for s in (0, 1))
    assert abs(free.phi) > 1 and abs(kept.phi) < 1 and abs(kept.seasonal_phi) < 1


def test_slices_do_not_change_the_fit(spark):
    y = seasonal_walk(8, 5000, 0.4, 0.2)        # crosses a slice edge
    fit = autoreg.seasonal_fit(series(spark, a=y)).first()
    assert fit.css == pytest.approx(css(y, fit.phi, fit.seasonal_phi), rel=1e-9)
    assert fit.equations == 5000 - 25


def test_score_holdout(spark):
    y = np.tile(np.arange(1.0, 13.0), 10)
    df = series(spark, a=y).withColumn("step", F.col("idx"))
    got = autoreg.score_holdout(
        df, lambda train, share: autoreg.seasonal_forecast(train, share=share)).first()
    assert (got.n_test, got.mape, got.zero_actuals) == (30, 0.0, 0)
    assert got["corr"] == pytest.approx(1.0)


# -- ARIMA(p, d, 0) ------------------------------------------------------------------------------

def ols(y, p, d):
    z = np.diff(y) if d else np.asarray(y, float)
    x = np.column_stack([np.ones(len(z) - p)] + [z[p - k:len(z) - k] for k in range(1, p + 1)])
    return np.linalg.lstsq(x, z[p:], rcond=None)[0], x, z[p:]


@pytest.mark.parametrize("p,d", [(1, 0), (2, 0), (10, 1)])
def test_ar_fit_equals_least_squares(spark, p, d):
    y = np.cumsum(np.random.default_rng(p).normal(size=300))
    coef, x, z = ols(y, p, d)
    got = autoreg.ar_fit(series(spark, a=y), p, d).first()
    assert [got.const, *got.phi] == pytest.approx(list(coef), abs=1e-6)
    assert got.css == pytest.approx(float(((z - x @ coef) ** 2).sum()), rel=1e-6)


def test_ar_fit_recovers_coefficients(spark):
    rng, y = np.random.default_rng(0), [0.0, 0.0]
    for _ in range(6000):
        y.append(1 + 0.5 * y[-1] - 0.3 * y[-2] + rng.normal())
    got = autoreg.ar_fit(series(spark, a=y), 2, d=0).first()
    assert [got.const, *got.phi] == pytest.approx([1, 0.5, -0.3], abs=0.05)


def test_ar_forecast_follows_the_recursion(spark):
    y = list(np.cumsum(np.random.default_rng(4).normal(0.2, 1, size=200)))
    coef, _, _ = ols(y, 10, 1)
    z, level, want = list(np.diff(y)), y[-1], []
    for _ in range(100):
        z.append(coef[0] + sum(c * z[-k] for k, c in enumerate(coef[1:], 1)))
        level += z[-1]
        want.append(level)
    got = by_series(autoreg.ar_forecast(series(spark, a=y, b=y[::-1]), 10, 100), "h", "forecast")
    assert [f for _, f in got["a"]] == pytest.approx(want, rel=1e-5)
    assert len(got["b"]) == 100


@pytest.mark.parametrize("p,d", [(5, 1), (2, 0)])
def test_walk_forward_refits_on_the_past_only(spark, p, d):
    y = np.cumsum(np.random.default_rng(9).normal(size=120))
    got = dict((i, f) for i, f in by_series(
        autoreg.walk_forward(series(spark, a=y), p, d), "idx", "forecast")["a"])
    for t in range(40, 120, 13):
        coef, _, _ = ols(y[:t], p, d)
        z = np.diff(y[:t]) if d else y[:t]
        step = coef[0] + sum(c * z[-k] for k, c in enumerate(coef[1:], 1))
        assert got[t] == pytest.approx(step + (y[t - 1] if d else 0), rel=1e-5, abs=1e-6)
    assert max(got) == 119


def test_lag_candidates_find_the_period(spark):
    y = 5 + np.sin(np.arange(400) * 2 * np.pi / 7) + np.random.default_rng(1).normal(0, .1, 400)
    fits = autoreg.lag_candidates(series(spark, a=10 * y), 12)
    assert metrics.best_positive(fits, ["series"]).first()["lag"] == 7


# -- order search --------------------------------------------------------------------------------

def test_order_search_scores_all_64(spark):
    got = orders.order_search(series(spark, a=seasonal_walk(3, 500, 0.5, 0.2))).collect()
    names = ("p", "d", "q", "sp", "sd", "sq")
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(
        itertools.product((0, 1), repeat=6))
    assert len({r.n for r in got}) == 1


def test_order_search_finds_moving_average_terms(spark):
    rng = np.random.default_rng(6)
    e = rng.normal(size=4000)
    ma = 10 * (e[1:] + 0.6 * e[:-1])
    ar = np.zeros(4000)
    for t in range(1, 4000):
        ar[t] = 0.7 * ar[t - 1] + 10 * rng.normal()
    got = {r.series: r for r in orders.order_search(series(spark, ma=ma, ar=ar)).where(
        "p + q = 1 and d = 0 and sd = 0 and sp = 0 and sq = 0").where(
        "(series = 'ma' and q = 1) or (series = 'ar' and p = 1)").collect()}
    assert got["ma"].theta == pytest.approx(0.6, abs=0.05)
    assert got["ar"].phi == pytest.approx(0.7, abs=0.05)
    best = {r.series: r for r in orders.best_order(series(spark, ma=ma, ar=ar)).collect()}
    assert (best["ma"].q, best["ma"].d) == (1, 0) and (best["ar"].p, best["ar"].d) == (1, 0)


def test_order_search_without_moving_average_equals_least_squares(spark):
    y = seasonal_walk(12, 700, 0.5, 0.3)
    got = orders.order_search(series(spark, a=y)).where(
        "p=1 and d=0 and q=0 and sp=1 and sd=1 and sq=0").first()
    w = y[12:] - y[:-12]
    start = 4 * 12 + 3 - 12     # rows that every candidate shares, as positions of w
    def err(a, b):
        t = np.arange(start, len(w))
        e = w[t] - a * w[t - 1] - b * w[t - 12] + a * b * w[t - 13]
        return float(e @ e)
    here = err(got.phi, got.seasonal_phi)
    for da, db in itertools.product((-0.01, 0.01), repeat=2):
        assert here <= err(got.phi + da, got.seasonal_phi + db)


# -- metrics -------------------------------------------------------------------------------------

def test_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.5), ("a", 4.0, 6.0), ("a", 0.0, 1.0)],
                               "series string, label double, prediction double")
    got = metrics.evaluate(df, ["series"]).first()
    y, p = np.array([1, 2, 4, 0.0]), np.array([2, 4.5, 6, 1.0])
    r = np.corrcoef(y, p)[0, 1]
    assert got.rmse == pytest.approx(np.sqrt(((p - y) ** 2).mean()))
    assert got.r == pytest.approx(r)
    assert got.t == pytest.approx(r * np.sqrt(2 / (1 - r * r)))
    err = df.agg(metrics.mape(F.col("label"), F.col("prediction")).alias("m"),
                 metrics.zero_actuals(F.col("label")).alias("z")).first()
    assert (err.m, err.z) == (round(np.mean([1, 1.25, 0.5]) * 100, 2), 1)


@pytest.mark.parametrize("r,n,p", [
    (0.5, 10, 0.14111328), (-0.5, 10, 0.14111328), (0.0, 5, 1.0), (1.0, 8, 0.0),
    (0.9, 4, 0.1), (0.3, 2, None), (None, 9, None)])
def test_p_value(spark, r, n, p):
    df = spark.createDataFrame([(r, n)], "r double, n bigint")
    got = df.select(metrics.p_value(F.col("r"), F.col("n"))).first()[0]
    assert got == (None if p is None else pytest.approx(p, rel=1e-4, abs=1e-12))


@pytest.mark.parametrize("r,n", [(0.05, 10_000), (0.02, 700), (-0.4, 25), (0.7, 6)])
def test_p_value_is_the_tail_of_students_t(spark, r, n):
    t, k = abs(r) * np.sqrt((n - 2) / (1 - r * r)), n - 2
    u = (np.arange(2_000_000) + 0.5) / 2_000_000        # substitute x = t / u for the tail
    x = t / u
    log_density = (math.lgamma((k + 1) / 2) - math.lgamma(k / 2) - 0.5 * math.log(k * math.pi)
                   - (k + 1) / 2 * np.log1p(x * x / k))
    want = 2 * np.mean(np.exp(log_density) * t / (u * u))
    got = spark.range(1).select(metrics.p_value(F.lit(r), F.lit(n))).first()[0]
    assert got == pytest.approx(want, rel=1e-5)


@pytest.mark.parametrize("n", [30, 4200])
def test_acf(spark, n):
    y = np.random.default_rng(n).normal(3, 1, n)
    got = dict(by_series(metrics.acf(series(spark, a=y), 5), "lag", "r")["a"])
    d = y - y.mean()
    for k in range(1, 6):
        assert got[k] == pytest.approx((d[k:] * d[:-k]).sum() / (d * d).sum(), abs=1e-9)


# -- Kalman --------------------------------------------------------------------------------------

def textbook(model, values):
    """One filter step at a time, written out in full."""
    x, p, out = model.x0.reshape(-1, 1), model.P0, []
    h = model.H.reshape(1, -1)
    for z in values:
        x, p = model.F @ x, model.F @ p @ model.F.T + model.Q
        out.append((h @ x).item())
        if np.isnan(z):
            continue
        s = (h @ p @ h.T).item() + model.R
        gain = p @ h.T / s
        x = x + gain * (z - out[-1])
        p = (np.eye(len(x)) - gain @ h) @ p
    return np.array(out), x.ravel()


@pytest.mark.parametrize("model", [kalman.acceleration_model(), kalman.velocity_model()])
@pytest.mark.parametrize("width,block", [(16, 1024), (50, 1024), (4096, 1024), (7, 3), (10, 2)])
def test_kalman_in_slices_equals_one_pass(spark, monkeypatch, model, width, block):
    monkeypatch.setattr(folds, "starts", partial(folds.starts, block=block))
    rng = np.random.default_rng(0)
    x = np.linspace(-10, 10, 100)
    long, short = -(x ** 2 + 2 * x - 2) + rng.normal(0, 2, 100), rng.normal(size=7)
    long[[3, 40, 41]] = np.nan
    df = series(spark, long=long, short=short)
    filtered = kalman.kalman_filter(df, model, width=width)
    got = by_series(filtered, "idx", "predicted")
    states = {r.series: r.state for r in kalman.final_states(filtered).collect()}
    for name, values in (("long", long), ("short", short)):
        want, last = textbook(model, values)
        np.testing.assert_allclose([p for _, p in got[name]], want, rtol=1e-7, atol=1e-7)
        np.testing.assert_allclose(states[name], last, rtol=1e-6, atol=1e-7)


def test_kalman_forecast_is_the_repeated_prediction(spark):
    model = kalman.acceleration_model()
    x = np.array([3.0, -2.0, 5.0])
    states = spark.createDataFrame([("a", [float(v) for v in x])], "series string, state array<double>")
    got = by_series(kalman.kalman_forecast(states, model, 50), "h", "forecast")["a"]
    for h, forecast in got:
        assert forecast == pytest.approx((np.linalg.matrix_power(model.F, h) @ x)[0], abs=1e-9)


def test_forecast_refuses_other_models(spark):
    states = spark.createDataFrame([("a", [1.0])], "series string, state array<double>")
    with pytest.raises(ValueError):
        kalman.kalman_forecast(states, kalman.state_model([[0.9]], [1]), 3)


# -- GARCH ---------------------------------------------------------------------------------------

def simulated_returns(n, alpha, beta, seed=1):
    rng = np.random.default_rng(seed)
    v, e = 1.0, np.zeros(n)
    for t in range(n):
        e[t] = np.sqrt(v) * rng.normal()
        v = (1 - alpha - beta) + alpha * e[t] ** 2 + beta * v
    return e


def loop_path(e, s2, alpha, beta):
    v, out, loglik = s2, [], 0.0
    for x in e:
        out.append(v)
        loglik -= 0.5 * (np.log(2 * np.pi * v) + x * x / v)
        v = s2 * (1 - alpha - beta) + alpha * x * x + beta * v
    return out, loglik, v


@pytest.mark.parametrize("width,block", [(16, 1024), (50, 1024), (4096, 1024), (7, 3), (10, 2)])
def test_garch_in_slices_equals_one_pass(spark, monkeypatch, width, block):
    monkeypatch.setattr(folds, "starts", partial(folds.starts, block=block))
    r = simulated_returns(100, 0.1, 0.8)
    df = series(spark, a=r, b=r[:20]).withColumnRenamed("y", "r")
    rows = garch.residuals(df)
    e, s2 = r - r.mean(), r.var()
    want, loglik, after = loop_path(e, s2, 0.2, 0.7)
    got = by_series(garch.garch_path(rows, 0.2, 0.7, width=width), "idx", "variance")
    np.testing.assert_allclose([v for _, v in got["a"]], want, rtol=1e-9)
    assert len(got["b"]) == 20
    point = garch.garch_likelihood(rows, [(0.2, 0.7), (0.0, 0.0)], width=width).where(
        "series = 'a' and beta = 0.7").first()
    assert point.loglik == pytest.approx(loglik) and point.next_variance == pytest.approx(after)


def test_garch_fit_recovers_and_forecast_decays(spark):
    df = series(spark, a=simulated_returns(5000, 0.1, 0.8)).withColumnRenamed("y", "r")
    fits = garch.garch_fit(garch.residuals(df))
    fit = fits.first()
    assert fit.alpha == pytest.approx(0.1, abs=0.05) and fit.beta == pytest.approx(0.8, abs=0.1)
    path = [v for _, v in by_series(garch.garch_forecast(fits, 400), "h", "variance")["a"]]
    assert path[0] == pytest.approx(fit.next_variance)
    assert path[-1] == pytest.approx(fit.s2, rel=1e-3)


def test_constant_prices_give_no_fit(spark):
    rows = garch.residuals(garch.log_returns(series(spark, a=np.full(30, 5.0))))
    assert rows.count() == 29
    assert garch.garch_fit(rows, [(0.1, 0.8)]).count() == 0


# -- synthetic series ----------------------------------------------------------------------------

def test_synthetic_series(spark):
    df = synthetic.linear(spark, 200).unionByName(synthetic.sine(spark, 120)).unionByName(
        synthetic.uniform(spark, 132)).unionByName(synthetic.noisy_parabola(spark, 100))
    got = by_series(df, "idx", "y")
    assert [y for _, y in got["linear"]] == list(range(200))
    assert got["sine"][6][1] == pytest.approx(np.sin(2 * np.pi * 5 * 6 / 120))
    assert all(0 <= y <= 100 for _, y in got["uniform"]) and len(got["uniform"]) == 132
    x = np.linspace(-10, 10, 100)
    noise = np.array([y for _, y in got["parabola"]]) + (x ** 2 + 2 * x - 2)
    assert abs(noise.mean()) < 1 and 1.5 < noise.std() < 2.6


def test_linear_series_is_forecast_exactly(spark):
    got = by_series(autoreg.seasonal_forecast(synthetic.linear(spark, 200)), "h", "forecast")
    assert [f for _, f in got["linear"]] == pytest.approx([200 + i for i in range(50)])


def test_a_group_without_a_positive_aic_keeps_its_row(spark):
    fits = spark.createDataFrame([("a", 1, -5.0), ("a", 2, None), ("b", 1, 3.0), ("b", 2, 2.0)],
                                 "series string, lag int, aic double")
    got = sorted(tuple(r) for r in metrics.best_positive(fits, ["series"]).collect())
    assert got == [("a", None, None), ("b", 2, 2.0)]


@pytest.mark.parametrize("n", [1, 2, 7, 64, 100])
@pytest.mark.parametrize("model", [kalman.velocity_model(), kalman.acceleration_model()])
def test_a_summary_does_what_its_observations_do(model, n):
    rng = np.random.default_rng(n)
    y = rng.normal(size=n)
    y[rng.random(n) < 0.2] = np.nan
    x, p = rng.normal(size=len(model.x0)), model.P0 + np.eye(len(model.x0))
    _, states, last = kalman.advance(model, x, p, y)
    size = len(model.x0)
    start = (np.zeros((size, size)), x, p, np.zeros(size), np.zeros((size, size)))
    _, b, c, _, _ = kalman._combine(start, kalman._summary(model, y))
    assert b == pytest.approx(states[-1], rel=1e-6, abs=1e-9) and c == pytest.approx(last, rel=1e-6, abs=1e-9)


def test_order_search_reads_the_series_once(spark):
    plan = orders.order_search(series(spark, a=seasonal_walk(3, 200, 0.5, 0.2)).repartition(3))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("FlatMapGroupsInPandas") == 3


def test_a_high_level_costs_the_order_search_no_digits(spark):
    y = seasonal_walk(8, 400, 0.4, 0.2)
    low = orders.order_search(series(spark, a=y)).where("d + sd > 0").orderBy("p", "d", "q", "sp", "sd", "sq").collect()
    high = orders.order_search(series(spark, a=y + 1e9)).where("d + sd > 0").orderBy("p", "d", "q", "sp", "sd", "sq").collect()
    for a, b in zip(low, high):
        assert b.aic == pytest.approx(a.aic, rel=1e-5) and (a.status != "ok" or b.phi == pytest.approx(a.phi, abs=1e-4))


def test_order_search_slices_change_nothing(spark):
    rows = series(spark, a=seasonal_walk(5, 600, 0.5, 0.2))
    whole, parts = (orders.lag_products(rows, 51, "series", "idx", "y", width=w).first() for w in (4096, 64))
    assert whole.n == parts.n == 600 - 51 and whole.head == parts.head
    assert np.allclose(whole.products, parts.products, rtol=1e-10)


@pytest.mark.parametrize("width, max_lag", [(16384, None), (64, None), (64, 70), (16, 5)])
def test_all_lags_equal_the_direct_sums(spark, width, max_lag):
    rng = np.random.default_rng(9)
    a, b = np.cumsum(rng.normal(size=700)), rng.normal(1e6, 1, size=130)
    df = series(spark, a=a, b=b, flat=np.full(9, 3.0)).unionByName(
        series(spark, c=a[:50]).withColumn("series", F.lit(None).cast("string")))
    got = {(r.series, r.lag): r.r for r in metrics.acf_all(df.withColumn("idx", F.col("idx") + 5), max_lag, width=width).collect()}
    for name, y in (("a", a), ("b", b), (None, a[:50])):
        d = y - y.mean()
        for k in range(1, min(len(y) - 1, max_lag or len(y)) + 1):
            assert got.pop((name, k)) == pytest.approx((d[k:] @ d[:-k]) / (d @ d), abs=1e-9)
    assert not got


def test_a_long_series_has_all_its_lags(spark):
    y = np.random.default_rng(1).normal(size=100_000)
    got = {r.lag: r.r for r in metrics.acf_all(spark.range(100_000).selectExpr("'a' AS series", "id AS idx").join(
        spark.createDataFrame(list(enumerate(map(float, y))), "idx bigint, y double"), "idx")).collect()}
    d = y - y.mean()
    assert len(got) == 99_999
    for k in (1, 2, 777, 16383, 16384, 16385, 50_000, 99_999):
        assert got[k] == pytest.approx((d[k:] @ d[:-k]) / (d @ d), abs=1e-9)


def one_by_one(model, x, p, values):
    """The filter as it is defined, a value at a time."""
    predicted, states = [], []
    for z in values:
        x, p = model.F @ x, model.F @ p @ model.F.T + model.Q
        predicted.append(model.H @ x)
        if not np.isnan(z):
            gain = p @ model.H / (model.R + model.H @ p @ model.H)
            x = x + gain * (z - predicted[-1])
            keep = np.eye(len(x)) - np.outer(gain, model.H)
            p = keep @ p @ keep.T + model.R * np.outer(gain, gain)
        states.append(x)
    return np.array(predicted), np.array(states), p


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4096])
@pytest.mark.parametrize("model", [kalman.velocity_model(), kalman.acceleration_model()])
def test_blocks_of_a_filter_equal_single_steps(model, n):
    y = np.cumsum(np.random.default_rng(n).normal(size=n)) + 50
    y[::7] = np.nan
    for got, want in zip(kalman.advance(model, model.x0, model.P0, y), one_by_one(model, model.x0, model.P0, y)):
        assert np.allclose(got, want, rtol=1e-8, atol=1e-8)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000])
def test_blocks_of_a_variance_equal_single_steps(n):
    e = np.random.default_rng(n).normal(size=n)
    points = garch.lattice()[::17]
    path, after = garch._recursion(points, e, 1.3, np.linspace(0.5, 2, len(points)))
    alpha, beta = np.array(points).T
    now = np.linspace(0.5, 2, len(points))
    for i in range(n):
        assert np.allclose(path[i], now, rtol=1e-12)
        now = 1.3 * (1 - alpha - beta) + alpha * e[i] ** 2 + beta * now
    assert len(path) == n and np.allclose(after, now, rtol=1e-12)
