"""Sales series: daily base, calendar grids, lags, rolling windows, decomposition.

Series are keyed by optional columns.  A series holds one row per calendar day
(or week or month), so a window over one series is bounded by its calendar.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tillsight.functions.scalars import REALISED_STATUSES, cents, is_realised, money_sum, period_start
from tillsight.operators.joins import calendar_fill

MEASURES = ("quantity_sold", "revenue", "order_count", "unique_customers")
_STEP = {"daily": "1 day", "weekly": "7 days", "monthly": "1 month"}


def sales_base(orders: DataFrame, items: DataFrame, products: DataFrame,
               statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Sales of each product on each day.

    Two distinct counts are needed.  Orders are first made one row per
    (day, product, order, customer), where the join has already placed them,
    and then one row per (day, product, customer); nothing is expanded.
    """
    sold = orders.filter(is_realised(statuses=statuses)).select("order_id", "customer_id", "order_date")
    lines = items.select("order_id", "product_id", "quantity", "total_price").join(sold, "order_id")
    per_order = lines.groupBy("order_date", "product_id", "order_id", "customer_id").agg(
        F.sum(F.col("quantity").cast("bigint")).alias("q"), F.sum(cents("total_price")).alias("c"))
    per_customer = per_order.groupBy("order_date", "product_id", "customer_id").agg(
        F.sum("q").alias("q"), F.sum("c").alias("c"), F.count("*").alias("n"))
    totals = per_customer.groupBy("order_date", "product_id").agg(
        F.sum("q").alias("quantity_sold"),
        (F.sum("c") / F.lit(100.0)).alias("revenue"),
        F.sum("n").alias("order_count"),
        F.count("customer_id").alias("unique_customers"))
    named = products.select("product_id", "product_name", "category", "subcategory", "brand", "price")
    return (totals.join(named, "product_id")
            .select("order_date", "product_id", "product_name", "category", "subcategory", "brand",
                    "price", *MEASURES))


def time_series(sales: DataFrame, level: str = "daily", keys: Sequence[str] = (),
                fill: bool = True) -> DataFrame:
    """Totals per day, week (from Monday) or month on a gap-free grid as ``ds``.

    Distinct counts are summed over products, as in the daily product rows.
    """
    totals = sales.groupBy(*keys, period_start("order_date", level).alias("ds")).agg(
        F.sum("quantity_sold").alias("quantity_sold"), money_sum("revenue").alias("revenue"),
        F.sum("order_count").alias("order_count"), F.sum("unique_customers").alias("unique_customers"))
    return calendar_fill(totals, "ds", MEASURES, _STEP[level], keys) if fill else totals


def _ordered(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("ds")


def calendar_features(df: DataFrame) -> DataFrame:
    """Calendar numbers of ``ds`` and their yearly and monthly cycles."""
    ds = F.col("ds")
    turn = lambda fn, c, size: fn(F.lit(2 * math.pi) * F.col(c) / size)
    return (df.withColumns({"year": F.year(ds), "month": F.month(ds), "day": F.dayofmonth(ds),
                            "day_of_week": F.weekday(ds), "quarter": F.quarter(ds),
                            "is_weekend": (F.weekday(ds) >= 5).cast("int")})
            .withColumns({"sin_month": turn(F.sin, "month", 12), "cos_month": turn(F.cos, "month", 12),
                          "sin_day": turn(F.sin, "day", 31), "cos_day": turn(F.cos, "day", 31)}))


def lag_features(df: DataFrame, keys: Sequence[str] = (), lags: Sequence[int] = (1, 7, 14, 30)) -> DataFrame:
    """Revenue and quantity of earlier rows."""
    w = _ordered(keys)
    return df.select("*", *[
        F.lag(source, n).over(w).alias(f"{name}_lag_{n}")
        for n in lags for source, name in (("revenue", "revenue"), ("quantity_sold", "quantity"))])


def _full(w: WindowSpec, size: int, value: Column) -> Column:
    """``value`` where the trailing window already holds ``size`` rows."""
    return F.when(F.count(F.lit(1)).over(w) == size, value)


def rolling_mean(column: str, size: int, keys: Sequence[str] = (), order: str = "ds") -> Column:
    """Mean of a money or count column over the last ``size`` rows."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(size - 1), 0)
    return _full(w, size, F.sum(cents(column)).over(w) / F.lit(100.0) / size)


def rolling_features(df: DataFrame, keys: Sequence[str] = (), sizes: Sequence[int] = (7, 14, 30)) -> DataFrame:
    """Trailing means and standard deviations, null until the window is full."""
    out = []
    for n in sizes:
        w = _ordered(keys).rowsBetween(-(n - 1), 0)
        out += [rolling_mean("revenue", n, keys).alias(f"revenue_rolling_mean_{n}"),
                _full(w, n, F.stddev_samp("revenue").over(w)).alias(f"revenue_rolling_std_{n}"),
                rolling_mean("quantity_sold", n, keys).alias(f"quantity_rolling_mean_{n}")]
    return df.select("*", *out)


def model_features(ts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Calendar, lag and rolling features of a daily series."""
    return rolling_features(lag_features(calendar_features(ts), keys), keys)


def decompose(df: DataFrame, column: str = "revenue", period: int = 30, keys: Sequence[str] = (),
              more_than: int = 365) -> DataFrame:
    """Additive trend, seasonal part and residual of series longer than ``more_than`` rows.

    The trend is a centred average over ``period`` rows, half weight at both
    ends for an even period; the seasonal part is the mean detrended value at
    each position of the period, centred on 0.
    """
    half = period // 2
    w = _ordered(keys)
    around = w.rowsBetween(-half, half)
    value = F.col("_cents")
    total = F.sum(value).over(around)
    if period % 2 == 0:
        total = total - (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
    complete = F.count(F.lit(1)).over(around) == 2 * half + 1
    long_enough = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > more_than
    base = (df.withColumn("_cents", cents(F.coalesce(column, F.lit(0))))
            .withColumn("_enough", long_enough)
            .withColumn("position", (F.row_number().over(w) - 1) % period)
            .withColumn("trend", F.when(complete, total / 100.0 / period))
            .filter("_enough")
            .withColumn("_off", F.col("_cents") / 100.0 - F.col("trend")))
    means = base.groupBy(*keys, "position").agg(F.avg("_off").alias("_mean"))
    season = means.select(*keys, "position", (
        F.col("_mean") - F.avg("_mean").over(Window.partitionBy(*keys))).alias("seasonal"))
    return (base.join(season, [*keys, "position"])
            .withColumn("residual", F.col("_off") - F.col("seasonal"))
            .drop("_cents", "_enough", "_off"))
