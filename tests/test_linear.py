import math

import numpy as np
import pytest

from flowcast.models import linear as ln


def lstsq(columns, y):
    return np.linalg.lstsq(np.column_stack(columns), y, rcond=None)[0]


def noisy(n=500, seed=3):
    rng = np.random.default_rng(seed)
    y = np.zeros(n)
    for t in range(2, n):
        y[t] = 5 + 0.5 * y[t - 1] - 0.3 * y[t - 2] + rng.normal()
    return y


def test_autoregression_equals_least_squares(series):
    y = noisy()
    df = series({"a": y, "b": y[::-1]}, kind="double")
    for key, values in (("a", y), ("b", y[::-1])):
        fit = ln.fit_autoregression(df, ["kind"], "ts_hour", "n").filter(f"kind = '{key}'").first()
        assert fit.d == 0 and fit.n == len(y) - 6
        rows = np.arange(6, len(y))
        best = None
        for p in range(1, 6):
            columns = [np.ones(len(rows))] + [values[rows - k] for k in range(1, p + 1)]
            beta = lstsq(columns, values[rows])
            rss = ((values[rows] - np.column_stack(columns) @ beta) ** 2).sum()
            aic = len(rows) * math.log(rss / len(rows)) + 2 * (p + 2)
            if best is None or aic < best[0]:
                best = (aic, p, beta)
        assert fit.lag_order == best[1] and fit.aic == pytest.approx(best[0])
        assert fit.intercept == pytest.approx(best[2][0])
        assert fit.coef[: best[1]] == pytest.approx(list(best[2][1:]))


def test_forecast_repeats_the_recursion(series):
    y = noisy()
    df = series({"a": y}, kind="double")
    fitted = ln.fit_autoregression(df, ["kind"], "ts_hour", "n")
    fit = fitted.first()
    got = [r.predicted for r in
           ln.forecast_autoregression(fitted, ["kind"], "ts_hour", 10).orderBy("ts_hour").collect()]
    line = list(y)
    for _ in range(10):
        line.append(fit.intercept + sum(w * line[-k] for k, w in enumerate(fit.weights, 1)))
    assert got == pytest.approx([max(0, v) for v in line[-10:]])


def test_known_coefficients_are_recovered(series):
    y = [100.0]
    for _ in range(60):
        y.append(2 + 0.9 * y[-1])
    df = series({"a": y}, kind="double")
    row = ln.ar1_coefficients(df, ["kind"], "ts_hour", "n").first()
    assert (row.slope, row.intercept) == pytest.approx((0.9, 2.0))
    fitted = ln.fit_autoregression(df, ["kind"], "ts_hour", "n")
    nxt = ln.forecast_autoregression(fitted, ["kind"], "ts_hour", 3).orderBy("ts_hour").collect()
    want = y[-1]
    for row in nxt:
        want = 2 + 0.9 * want
        assert row.predicted == pytest.approx(want, rel=1e-5)


def test_trend_is_differenced_and_continued(series):
    df = series({"a": [10 + 3 * i for i in range(80)]}, kind="double")
    fitted = ln.fit_autoregression(df, ["kind"], "ts_hour", "n")
    assert fitted.first().d == 1
    got = [r.predicted for r in
           ln.forecast_autoregression(fitted, ["kind"], "ts_hour", 4).orderBy("ts_hour").collect()]
    assert got == pytest.approx([10 + 3 * i for i in range(80, 84)], rel=1e-5)


def test_daily_cycle_is_differenced_and_repeated(series):
    day = [10 + h % 24 * (2 if h % 24 < 12 else 1) for h in range(24)]
    df = series({"a": day * 10}, kind="double")
    fitted = ln.fit_autoregression(df, ["kind"], "ts_hour", "n", seasonal=(24, 48))
    assert fitted.first().seasonal_d == 1
    got = [r.predicted for r in
           ln.forecast_autoregression(fitted, ["kind"], "ts_hour", 24).orderBy("ts_hour").collect()]
    assert got == pytest.approx(day, abs=1e-6)


def test_short_and_constant_series(series):
    df = series({"short": [4, 6], "flat": [7] * 60, "zero": [0] * 60})
    fitted = ln.fit_autoregression(df, ["kind"], "ts_hour", "n")
    rows = ln.forecast_autoregression(fitted, ["kind"], "ts_hour", 2).collect()
    assert sorted((r.kind, round(r.predicted, 6)) for r in rows) == [
        ("flat", 7.0), ("flat", 7.0), ("short", 5.0), ("short", 5.0), ("zero", 0.0), ("zero", 0.0)]


def test_fourier_recovers_its_own_terms(series):
    hours = np.arange(24 * 21)
    y = (50 + 0.01 * hours + 8 * np.sin(2 * np.pi * hours / 24) + 3 * np.cos(4 * np.pi * hours / 24)
         + 5 * np.cos(2 * np.pi * hours / 168))
    df = series({"a": y[: 24 * 14], "b": y[: 24 * 14] * 2}, kind="double")
    fitted = ln.fit_fourier(df, ["kind"], "ts_hour", "n")
    out = ln.forecast_fourier(fitted, ["kind"], "ts_hour", 168).orderBy("kind", "ts_hour").collect()
    want = list(y[24 * 14:]) + list(y[24 * 14:] * 2)
    assert [r.predicted for r in out] == pytest.approx(want, abs=1e-6)
    assert len(fitted.first().coef) == 16


def test_gram_sums(series):
    df = series({"a": [1, 2, 3]}).selectExpr("*", "n * 2 AS m")
    row = ln.gram_sums(df, ["kind"], {"x": df["n"], "y": df["m"]}).first()
    assert (row.n, row.x_x, row.x_y, row.y_y) == (3, 14.0, 28.0, 56.0)
