import numpy as np
import pytest
from pyspark.sql import functions as F

from flowcast.models import arma as am
from flowcast.models import changepoints as cp
from flowcast.models import linear as ln


def arma_values(seed, n, phi=0.6, theta=0.5, level=50.0):
    r = np.random.default_rng(seed)
    e, y = r.normal(size=n + 200), [0.0]
    for t in range(1, n + 200):
        y.append(phi * y[-1] + e[t] + theta * e[t - 1])
    return (np.array(y[200:]) + level).tolist()


def test_the_terms_of_simulated_series_are_found(series):
    grid = series({"a": arma_values(1, 4000), "b": arma_values(2, 4000, 0.3, -0.4)}, kind="double")
    rows = {r.kind: r for r in am.fit_arma(grid, ["kind"], "ts_hour", "n", 1, 1).collect()}
    assert rows["a"].coef[1:] == pytest.approx([0.6, 0.5], abs=0.06)
    assert rows["b"].coef[1:] == pytest.approx([0.3, -0.4], abs=0.08)
    assert len(rows["a"].history) == len(rows["a"].shocks) == 1


def test_shocks_enter_the_first_steps_only(spark):
    fitted = spark.sql("""SELECT 'a' AS kind, timestamp_ntz'2024-01-01' AS last_ts, array(1D, 0.5D, 2D) AS coef,
        array(10D) AS history, array(3D) AS shocks""")
    out = [r.predicted for r in am.forecast_arma(fitted, ["kind"], "ts_hour", 4).orderBy("ts_hour").collect()]
    assert out == [12.0, 7.0, 4.5, 3.25]


@pytest.mark.parametrize("p,q", [(2, 0), (0, 2), (1, 3)])
def test_orders_of_either_kind(series, p, q):
    fitted = am.fit_arma(series({"a": arma_values(3, 300)}, kind="double"), ["kind"], "ts_hour", "n", p, q)
    assert len(fitted.first().coef) == 1 + p + q
    assert am.forecast_arma(fitted, ["kind"], "ts_hour", 10).count() == 10


def test_short_null_and_keyless_series(series, spark):
    grid = series({"a": [4, 6, 5], None: list(range(60))})
    out = am.forecast_arma(am.fit_arma(grid, ["kind"], "ts_hour", "n"), ["kind"], "ts_hour", 3).collect()
    assert [r.predicted for r in out if r.kind == "a"] == [5.0] * 3
    assert sum(r.kind is None for r in out) == 3
    whole = grid.where("kind IS NULL").select("ts_hour", "n")
    assert am.forecast_arma(am.fit_arma(whole, [], "ts_hour", "n"), [], "ts_hour", 5).count() == 5
    assert am.difference_orders(whole, [], "ts_hour", "n").count() == 1
    assert am.fit_arma(grid.limit(0), ["kind"], "ts_hour", "n").count() == 0


def test_orders_of_differencing(series):
    r = np.random.default_rng(5)
    n = 960
    noise, hour = r.normal(size=n), np.arange(n) % 24
    grid = series({
        "constant": [7.0] * n, "noise": (20 + noise).tolist(), "walk": (100 + np.cumsum(r.normal(size=n))).tolist(),
        "trend": (np.arange(n) * 0.1 + noise).tolist(), "season": (10 * np.sin(hour * 2 * np.pi / 24) + noise).tolist(),
        "twice": np.cumsum(np.cumsum(r.normal(size=n))).tolist()}, kind="double")
    got = {r.kind: (r.seasonal_d, r.d) for r in am.difference_orders(grid, ["kind"], "ts_hour", "n").collect()}
    assert got == {"constant": (0, 0), "noise": (0, 0), "walk": (0, 1), "trend": (0, 1), "season": (1, 0), "twice": (0, 2)}


def test_kpss_is_the_published_formula(series):
    values = arma_values(6, 500)
    d = np.array(values) - np.mean(values)
    lags = int(4 * 5 ** 0.25)
    variance = (d @ d + 2 * sum((1 - j / (lags + 1)) * (d[j:] @ d[:-j]) for j in range(1, lags + 1))) / 500
    expected = (np.cumsum(d) ** 2).sum() / 500 ** 2 / variance
    rows = series({"a": values}, kind="double")
    assert am.kpss(rows, ["kind"], "ts_hour", "n").first().kpss == pytest.approx(expected)


def test_a_bend_is_found_and_followed(series):
    n = 1100
    t = np.arange(n) / (n - 1)
    bent = 5 + 10 * t + 60 * np.maximum(t - cp.places(10)[5], 0)
    grid = series({"bent": bent.tolist(), "straight": (5 + 10 * t).tolist()}, kind="double")
    fitted = cp.fit_changepoints(grid, ["kind"], "ts_hour", "n", penalty=1e-5, sweeps=3000)
    rows = {r.kind: r.coef for r in fitted.collect()}
    assert np.argmax(np.abs(rows["bent"][2:])) == 5 and max(map(abs, rows["straight"][2:])) < 0.5
    ahead = cp.forecast_changepoints(fitted, ["kind"], "ts_hour", 100).where("kind = 'bent'").agg(F.max("predicted")).first()[0]
    end = 1 + 100 / (n - 1)
    assert ahead == pytest.approx(5 + 10 * end + 60 * (end - cp.places(10)[5]), rel=0.02)


def test_segment_sums_give_the_descent_over_rows(series):
    values = arma_values(8, 200)
    t = np.arange(200) / 199
    x = np.column_stack([np.ones(200), t, *[np.maximum(t - c, 0) for c in cp.places(4)]])
    beta = np.zeros(6)
    for _ in range(30):
        for j in range(6):
            pull = x[:, j] @ (np.array(values) - x @ beta + x[:, j] * beta[j])
            if j > 1:
                pull = np.sign(pull) * max(abs(pull) - 0.01 * 200, 0)
            beta[j] = pull / (x[:, j] @ x[:, j])
    grid = series({"a": values}, kind="double")
    assert cp.fit_changepoints(grid, ["kind"], "ts_hour", "n", 4, 0.01, 30).first().coef == pytest.approx(beta.tolist(), abs=1e-6)
    assert cp.fit_changepoints(grid.limit(1), ["kind"], "ts_hour", "n").count() == 1


def test_intervals_cover_as_often_as_they_say(series):
    held, inside, total = 24, 0, 0
    values = {f"s{i}": arma_values(100 + i, 500, 0.7, 0.0) for i in range(60)}
    train = series({k: v[:-held] for k, v in values.items()}, kind="double")
    fitted = ln.fit_autoregression(train, ["kind"], "ts_hour", "n").cache()
    out = am.forecast_intervals(fitted, ln.forecast_autoregression(fitted, ["kind"], "ts_hour", held), ["kind"], "ts_hour", held)
    for r in out.orderBy("ts_hour").collect():
        values[r.kind].append((r.lower, r.upper))
    for v in values.values():
        real, bounds = v[-2 * held:-held], v[-held:]
        inside += sum(a <= y <= b for y, (a, b) in zip(real, bounds))
        total += held
        widths = [b - a for a, b in bounds]
        assert all(y >= x - 1e-9 for x, y in zip(widths, widths[1:]))
    assert 0.91 <= inside / total <= 0.985
