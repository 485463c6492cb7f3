"""The forecast jobs: one forest over all series, and one linear model per series."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcast.functions.calendar import plus
from flowcast.models.forest import (DEPTH, SEED, TREES, fit_forest, forecast_forest,
                                    importance_table, predict_forest)
from flowcast.models.linear import (fit_autoregression, fit_fourier, forecast_autoregression,
                                    forecast_fourier)
from flowcast.operators.features import FEATURES, hourly_features
from flowcast.operators.hourly import hourly_grid, pair
from flowcast.operators.metrics import forecast_metrics
from flowcast.operators.stacking import stack, stack_tagged
from flowcast.operators.windows import last_rows_split
from flowcast.sources.staging import stage


@dataclass
class Forecast:
    """A forecast job. Every table is a DataFrame, and each step runs when first asked for.

    Importances need the fit alone, errors the fit and the scored holdout; only the
    forecast runs the recursion, and is staged, so that reports do not repeat it.
    """

    features: DataFrame
    marks: DataFrame
    keys: tuple
    ts: str
    n: str
    horizon: int
    mape_mode: str
    own_marks: bool
    settings: dict

    def marked(self, rows):
        """``rows`` with the columns of the marks: of their own series, or of all."""
        if not self.own_marks:
            names = self.marks.columns
            return rows.select("*", *[self.marks.select(m).scalar().alias(m) for m in names])
        other = self.marks.select(*[F.col(k).alias("_" + k) for k in self.keys],
                                  *[c for c in self.marks.columns if c not in self.keys])
        same = [F.col(k).eqNullSafe(F.col("_" + k)) for k in self.keys]
        return rows.join(other, same).drop(*["_" + k for k in self.keys])

    def part(self, test):
        """Feature rows of the holdout, or those before it."""
        rows = self.marked(self.features)
        inside = F.col(self.ts) >= F.col("test_start")
        return rows.filter(inside if test else ~inside).select(*self.features.columns)

    @cached_property
    def training(self):
        """Complete rows before the holdout: warm-up rows with NULLs teach nothing."""
        return self.part(False).dropna(subset=FEATURES)

    @cached_property
    def model(self):
        """The fitted forest; None without any training row."""
        if self.training.isEmpty():
            return None
        return fit_forest(self.training, self.n, FEATURES, **self.settings)

    @cached_property
    def scored(self):
        test = self.part(True)
        if self.model is None:
            return test.limit(0).withColumn("predicted", F.lit(0.0))
        return predict_forest(self.model, test.dropna(subset=FEATURES))

    @cached_property
    def forecast(self):
        spark = self.features.sparkSession
        if self.model is None:
            future = self.scored.select(*self.keys, self.ts, "predicted")
        else:
            future = forecast_forest(spark, self.model, self.features, self.keys, self.ts, self.n, self.horizon)
        return stage(forecast_rows(self.part(False), self.scored, future, self.keys, self.ts, self.n, "forest"), "forecast")

    @cached_property
    def metrics(self):
        rows = self.scored.select(*self.keys, F.lit("forest").alias("model"), F.col(self.n).alias("actual"), "predicted")
        return forecast_metrics(rows, "actual", "predicted", [*self.keys, "model"], self.mape_mode)

    @cached_property
    def importance(self):
        spark = self.features.sparkSession
        if self.model is None:
            return spark.createDataFrame([], "feature string, importance double")
        return importance_table(spark, self.model)


def forecast_rows(train, test, future, keys, ts, y, model_name):
    """(keys, ts, model, segment, actual, predicted) over train, test and future."""
    keys = list(keys)

    def part(df, actual, predicted):
        return df.select(*keys, ts, F.lit(model_name).alias("model"),
                         actual.cast("double").alias("actual"),
                         predicted.cast("double").alias("predicted"))

    return stack_tagged({
        "train": part(train, F.col(y), F.lit(None)),
        "test": part(test, F.col(y), F.col("predicted")),
        "future": part(future, F.lit(None), F.col("predicted")),
    }, "segment")


def forecast_job(events, ts, keys=(), horizon=168, holdout_days=30, trees=TREES, depth=DEPTH,
                 seed=SEED, warmup="zero", bounds="global", mape_mode="nonzero",
                 hour="ts_hour", n="n", **forest):
    """Events to a forest, its forecast, errors and importances, each computed on demand.

    The feature rows are staged once: the events are scanned a single time, and all
    training passes read the small hourly table. With ``bounds="series"`` every series has
    marks of its own, so the holdout and the forecast begin where that series ends. ``forest`` goes on to ``fit_forest``.
    Empty input gives empty tables of the same schema and no model.
    """
    keys = tuple(keys)
    features = stage(hourly_features(events, ts, keys, hour, n, warmup, bounds), "features")
    own = bounds == "series" and bool(keys)
    marks = features.groupBy(*(keys if own else ())).agg(
        F.min(hour).alias("first_ts"), F.max(hour).alias("last_ts"))
    marks = marks.select(*(keys if own else ()), "first_ts", plus("last_ts", days=-holdout_days).alias("test_start"),
                         "last_ts", plus("last_ts", hours=1).alias("forecast_start"))
    settings = {"trees": trees, "depth": depth, "seed": seed, **forest}
    return Forecast(features, marks, keys, hour, n, horizon, mape_mode, own, settings)


def linear_forecasts(train, keys, ts, y, horizon=168):
    """{model name: forecast of ``horizon`` steps} for every series at once."""
    return {
        "autoregression": forecast_autoregression(
            fit_autoregression(train, keys, ts, y), keys, ts, horizon),
        "seasonal_autoregression": forecast_autoregression(
            fit_autoregression(train, keys, ts, y, seasonal=(24, 48)), keys, ts, horizon),
        "fourier": forecast_fourier(fit_fourier(train, keys, ts, y), keys, ts, horizon),
    }


def compare_models(events, ts, keys, holdout_hours=168, hour="ts_hour", n="n",
                   bounds="global"):
    """Hold out the last hours of each series and forecast them with every model.

    Returns (keys, ts, actual, predicted, model) rows. The tagged hourly grid is staged
    once for all models.
    """
    keys = list(keys)
    grid = hourly_grid(events, ts, keys, hour, n, bounds)
    tagged = stage(last_rows_split(grid, keys, hour, holdout_hours), "split")
    train = tagged.filter("segment = 'train'").drop("segment")
    test = tagged.filter("segment = 'test'").select(
        *keys, hour, F.col(n).cast("double").alias("actual"))
    parts = [
        pair(test, predicted, keys, hour).withColumn("model", F.lit(name))
        for name, predicted in linear_forecasts(train, keys, hour, n, holdout_hours).items()
    ]
    return stack(*parts)
