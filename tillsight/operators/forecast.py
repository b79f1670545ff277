"""Sales forecasts and their combination."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.scalars import cents, money_sum
from tillsight.operators.joins import restrict_to
from tillsight.session import stage

FORECAST_COLUMNS = ("product_id", "forecast_date", "predicted_sales", "confidence_interval_lower",
                    "confidence_interval_upper", "model_used")


def _ahead(df: DataFrame, last: str, horizon: int) -> DataFrame:
    """Repeat each row for the ``horizon`` days after its ``last`` date."""
    return (df.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
            .withColumn("forecast_date", F.date_add(last, F.col("step"))))


def linear_trend(series: DataFrame, column: str = "revenue", horizon: int = 30,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares line through each series, continued for ``horizon`` days."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("ds")) - 1
    points = (series.filter(F.col(column).isNotNull())
              .select(*keys, "ds", F.col(column).cast("double").alias("y"), place.alias("x")))
    lines = points.groupBy(*keys).agg(
        F.coalesce(F.regr_slope("y", "x"), F.lit(0.0)).alias("slope"),
        F.coalesce(F.regr_intercept("y", "x"), F.avg("y")).alias("start"),
        F.count("*").alias("n"), F.max("ds").alias("last")).filter("n > 0")
    at = F.col("n") + F.col("step") - 1
    return _ahead(lines, "last", horizon).select(
        *keys, "forecast_date", (F.col("start") + F.col("slope") * at).alias("predicted_value"),
        F.lit("Linear Trend").alias("model_type"))


def top_by_revenue(sales: DataFrame, limit: int = 10) -> DataFrame:
    return (sales.groupBy("product_id").agg(money_sum("revenue").alias("revenue"))
            .orderBy(F.col("revenue").desc(), "product_id").limit(limit))


def recent_mean(daily: DataFrame, column: str, size: int, more_than: int,
                keys: Sequence[str]) -> DataFrame:
    """Mean of the last ``size`` days of each series spanning more than ``more_than`` days.

    ``daily`` holds the days with sales, once each.  Days without sales count
    as 0, which needs their number only: no calendar grid is built.  Window and
    totals use the same keys, so the rows are shuffled once.
    """
    last = F.max("ds").over(Window.partitionBy(*keys))
    recent = F.col("ds") > F.date_sub("last", size)
    return (daily.withColumn("last", last)
            .groupBy(*keys)
            .agg((F.coalesce(F.sum(F.when(recent, cents(column))), F.lit(0)) / F.lit(100.0) / size)
                 .alias("moving_avg"),
                 F.max("last").alias("last"),
                 (F.datediff(F.max("ds"), F.min("ds")) + 1).alias("days"))
            .filter(F.col("days") > more_than).drop("days"))


def product_moving_average(sales: DataFrame, top_n: int | None = 10, horizon: int = 30,
                           window: int = 7, more_than: int = 30) -> DataFrame:
    """Flat forecast per product from the mean of its last week.

    All chosen products run in one job; ``top_n=None`` takes every product.
    Only series longer than 30 days qualify, so the window is always 7 days.
    """
    chosen = sales if top_n is None else restrict_to(sales, top_by_revenue(sales, top_n), "product_id")
    daily = (chosen.groupBy("product_id", F.col("order_date").alias("ds"))
             .agg(money_sum("revenue").alias("revenue")))
    means = recent_mean(daily, "revenue", window, more_than, ["product_id"])
    return _ahead(means, "last", horizon).select(
        "product_id", "forecast_date", F.col("moving_avg").alias("predicted_revenue"),
        F.lit("Moving Average").alias("model_type"))


def mean_with_interval(series: DataFrame, column: str = "revenue", size: int = 30, horizon: int = 30,
                       width: float = 1.959963984540054) -> DataFrame:
    """The mean of the last ``size`` days for every day ahead, with ``width`` sample deviations to both sides."""
    ends = series.agg(F.max("ds").alias("last"))
    recent = series.filter(F.col("ds") > F.date_sub(ends.scalar(), size))
    means = recent.agg(F.max("ds").alias("last"), F.avg(F.col(column).cast("double")).alias("m"),
                       F.coalesce(F.stddev_samp(F.col(column).cast("double")), F.lit(0.0)).alias("s")).filter("last IS NOT NULL")
    return _ahead(means, "last", horizon).select(
        "forecast_date", F.col("m").alias("predicted_value"), F.lit("Recent Mean").alias("model_type"),
        (F.col("m") - width * F.col("s")).alias("lower_ci"), (F.col("m") + width * F.col("s")).alias("upper_ci"))


def error_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """MAE, RMSE and R2 in one row."""
    miss = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count(F.lit(1))
    return df.agg(F.avg(F.abs(miss)).alias("mae"), F.sqrt(F.avg(miss * miss)).alias("rmse"),
                  (1 - F.sum(miss * miss) / F.nullif(spread, F.lit(0.0))).alias("r2"))


def holdout_split(features: DataFrame, train_share: float = 0.8) -> tuple[DataFrame, int]:
    """Complete rows, staged, with ``is_train`` for the earliest share; and their number.

    One daily series: the window is bounded by its calendar.
    """
    complete = features.na.drop().withColumn("_at", F.row_number().over(Window.orderBy("ds")))
    staged = stage(complete, "series")
    n = staged.count()
    return staged.withColumn("is_train", F.col("_at") <= int(n * train_share)), n


def random_forest(features: DataFrame, column: str = "revenue", horizon: int = 30, trees: int = 100,
                  max_depth: int = 30, seed: int = 42, need: int = 50) -> tuple[DataFrame, DataFrame]:
    """Forecast from the last feature row, and hold-out errors.

    The same row is scored for every day ahead, so the forecast is flat.
    Trees grow to Spark's limit of 30 levels.  Fewer than ``need`` complete
    rows give no forecast and no errors: two empty frames.
    """
    rows, n = holdout_split(features)
    if n < need:
        spark = features.sparkSession
        return (spark.createDataFrame([], "forecast_date date, predicted_value double, model_type string"),
                spark.createDataFrame([], "mae double, rmse double, r2 double"))
    inputs = [c for c in features.columns if c not in (column, "ds")]
    packed = VectorAssembler(inputCols=inputs, outputCol="x").transform(rows)
    model = RandomForestRegressor(
        featuresCol="x", labelCol=column, numTrees=trees, maxDepth=max_depth,
        featureSubsetStrategy="all", maxMemoryInMB=128, seed=seed).fit(packed.filter("is_train"))
    scored = model.transform(packed)
    errors = error_metrics(scored.filter("not is_train"), column, "prediction")
    last = scored.filter(F.col("_at") == n).select(F.col("ds").alias("last"), "prediction")
    ahead = _ahead(last, "last", horizon).select(
        "forecast_date", F.col("prediction").alias("predicted_value"),
        F.lit("Random Forest").alias("model_type"))
    return ahead, errors


def combine(*forecasts: DataFrame | None) -> DataFrame:
    """Rows of the forecast table from several models.

    If any model brings an interval, models without one get none; only when no
    model has an interval is it set to 20 % around the prediction.
    """
    given = [f for f in forecasts if f is not None]
    if not given:
        raise ValueError("no forecast given")
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), given)
    value = F.col("predicted_value")

    def bound(name: str, share: float) -> Column:
        return F.col(name) if name in rows.columns else value * share

    product = F.col("product_id") if "product_id" in rows.columns else F.lit(1).cast("bigint")
    return rows.select(product.alias("product_id"), "forecast_date", value.alias("predicted_sales"),
                       bound("lower_ci", 0.8).alias("confidence_interval_lower"),
                       bound("upper_ci", 1.2).alias("confidence_interval_upper"),
                       F.col("model_type").alias("model_used"))


def summary(forecasts: DataFrame) -> DataFrame:
    """Mean prediction and days of each model."""
    return forecasts.groupBy("model_used").agg(F.avg("predicted_sales").alias("avg_prediction"),
                                               F.count("*").alias("days"))
