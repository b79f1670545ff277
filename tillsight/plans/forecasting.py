"""Sales forecasts from base to stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tillsight.operators import arima, forecast, series
from tillsight.session import scratch_path, stage
from tillsight.sources import readers, writers


@dataclass
class Forecasting:
    series: DataFrame
    features: DataFrame
    forecasts: DataFrame
    product_forecasts: DataFrame
    forest_errors: DataFrame | None


def _by_category(sales: DataFrame) -> DataFrame:
    """Daily series of the categories; one that ended early goes on at 0."""
    last = sales.agg(F.max("order_date")).scalar()
    ends = sales.select("category").distinct().select("category", last.alias("order_date"),
                                                      *[F.lit(0).alias(c) for c in series.MEASURES])
    measured = sales.select("category", "order_date", *series.MEASURES)
    return series.time_series(measured.unionByName(ends), "daily", keys=["category"])


def run_forecasting(orders: DataFrame, items: DataFrame, products: DataFrame, path: str | None = None,
                    horizon: int = 30, top_n: int = 10, **forest) -> Forecasting:
    """Three models of daily revenue, stored together, and product forecasts.

    ARIMA is fitted by category, each up to the last day of all, and summed.
    """
    sales = stage(series.sales_base(orders, items, products), "sales")
    daily = stage(series.time_series(sales, "daily"), "daily")
    features = series.model_features(daily)
    trained = forecast.random_forest(features, horizon=horizon, **forest)
    # Staged, as an empty result must leave no interval columns behind.
    apart = arima.arima_forecast(_by_category(sales), horizon=horizon, keys=["category"])
    fitted = stage(arima.total_forecast(apart), "arima")
    stored = forecast.combine(None if fitted.isEmpty() else fitted,
                              trained[0] if trained else None,
                              forecast.linear_trend(daily, horizon=horizon))
    path = path or scratch_path(daily.sparkSession, "sales_forecasts")
    writers.replace_table(stored, path)
    return Forecasting(daily, features, readers.read_table(daily.sparkSession, path),
                       forecast.product_moving_average(sales, top_n, horizon),
                       trained[1] if trained else None)
