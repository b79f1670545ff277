"""Dashboard and report figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.ranks import exact_quantiles
from tillsight.functions.scalars import (
    REALISED_STATUSES, AsOf, as_of_col, cents, flag, full_name, is_realised, last_days, last_months,
    money_avg, money_sum, period_start, risk_band)
from tillsight.session import stage

# Look-back of each trend period.
TREND_SPAN = {"daily": ("days", 30), "weekly": ("days", 84), "monthly": ("months", 12)}

# Advice printed in every summary.
STANDING_ADVICE = (
    "Focus retention efforts on high-risk churn customers",
    "Expand marketing for top-performing product categories",
    "Implement personalized recommendations for medium-risk customers",
    "Monitor customer acquisition cost vs lifetime value ratios",
)


def _change(months: DataFrame, value: str, *extra: Column) -> DataFrame:
    """One row: change in % between the two latest months of a monthly table.

    The monthly table holds one row per calendar month, so the sorted list is
    short.  A missing or zero previous month gives 0.
    """
    held = F.collect_list(F.when(F.col("month").isNotNull(), F.struct("month", F.col(value).alias("v"))))
    latest = F.sort_array(held, asc=False)
    current, previous = F.get(latest, F.lit(0))["v"], F.get(latest, F.lit(1))["v"]
    change = (current - previous) / F.nullif(previous, F.lit(0).cast("double")) * 100
    return months.agg(*extra, F.coalesce(change, F.lit(0.0)).alias("growth_rate"))


def month_growth(df: DataFrame, date_col: str, value: Column) -> DataFrame:
    """Growth of an aggregate between the two latest months that have rows."""
    months = df.groupBy(period_start(date_col, "monthly").alias("month")).agg(
        value.cast("double").alias("_v"))
    return _change(months, "_v")


def revenue_growth(orders: DataFrame, statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    return month_growth(orders.filter(is_realised(statuses=statuses)), "order_date",
                        money_sum("total_amount"))


def customer_growth(customers: DataFrame, as_of: Column, months: int = 2) -> DataFrame:
    """Growth of new registrations, looking back ``months`` months."""
    recent = last_months(customers, "registration_date", as_of, months)
    return month_growth(recent, "registration_date", F.count("*"))


def kpis(orders: DataFrame, customers: DataFrame,
         statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Revenue, customers, orders, order value and growth from one scan of orders."""
    months = (orders.filter(is_realised(statuses=statuses))
              .groupBy(period_start("order_date", "monthly").alias("month"))
              .agg(F.sum(cents("total_amount")).alias("cents"),
                   F.count("total_amount").alias("priced"),
                   F.count("*").alias("n"),
                   money_sum("total_amount").alias("revenue")))
    total = F.sum("cents") / F.lit(100.0)
    known = customers.agg(F.count_distinct("customer_id"))
    summed = _change(
        months, "revenue",
        F.coalesce(total, F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_orders"),
        F.coalesce(total / F.nullif(F.sum("priced"), F.lit(0)), F.lit(0.0)).alias("avg_order_value"))
    return summed.select("total_revenue", known.scalar().alias("total_customers"), "total_orders",
                         "avg_order_value", F.col("growth_rate").alias("monthly_growth_rate"))


def sales_trends(orders: DataFrame, period: str = "daily", as_of: AsOf = None,
                 lookback: int | None = None,
                 statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Revenue and order count per day, week or month; other periods mean month."""
    level = period if period in TREND_SPAN else "monthly"
    unit, span = TREND_SPAN[level]
    if lookback is not None:
        span = lookback
    recent = (last_days if unit == "days" else last_months)(orders, "order_date", as_of, span)
    return (recent.filter(is_realised(statuses=statuses))
            .groupBy(period_start("order_date", level).alias("date"))
            .agg(money_sum("total_amount").alias("revenue"), F.count("*").alias("order_count"))
            .orderBy("date"))


def product_ranking(orders: DataFrame, items: DataFrame, products: DataFrame,
                    as_of: AsOf = None, days: int | None = None, limit: int | None = None,
                    statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Sales of each product, best first.

    Lines are totalled by product before product attributes are joined.
    """
    sold = orders
    if days is not None:
        sold = last_days(sold, "order_date", as_of, days)
    sold = sold.filter(is_realised(statuses=statuses)).select("order_id")
    totals = (items.select("order_id", "product_id", "quantity", "unit_price", "total_price")
              .join(sold, "order_id")
              .groupBy("product_id")
              .agg(F.sum(F.col("quantity").cast("bigint")).alias("total_sold"),
                   money_sum("total_price").alias("total_revenue"),
                   F.count_distinct("order_id").alias("unique_orders"),
                   money_avg("unit_price").alias("avg_price")))
    named = products.select("product_id", "product_name", "category", "brand")
    ranked = named.join(totals, "product_id").orderBy(
        F.col("total_revenue").desc_nulls_first(), "product_id")
    return ranked if limit is None else ranked.limit(limit)


def segment_rollup(segments: DataFrame) -> DataFrame:
    """Customers, mean lifetime value and mean churn risk of each segment."""
    return (segments.groupBy("segment_name")
            .agg(F.count("*").alias("customer_count"),
                 money_avg("clv_prediction").alias("avg_clv"),
                 F.avg("churn_probability").alias("avg_churn_risk"))
            .select("segment_name", "customer_count", F.coalesce("avg_clv", F.lit(0.0)).alias("avg_clv"),
                    F.coalesce("avg_churn_risk", F.lit(0.0)).alias("avg_churn_risk"))
            .orderBy(F.col("customer_count").desc(), "segment_name"))


def forecast_rollup(forecasts: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Forecasts up to ``days`` ahead by date and model."""
    return (forecasts.filter(F.col("forecast_date") <= F.date_add(as_of, days))
            .groupBy("forecast_date", "model_used")
            .agg(F.sum("predicted_sales").alias("predicted_revenue"),
                 F.avg("confidence_interval_lower").alias("lower_bound"),
                 F.avg("confidence_interval_upper").alias("upper_bound"))
            .orderBy("forecast_date", "model_used"))


def high_risk_customers(customers: DataFrame, segments: DataFrame, orders: DataFrame,
                        above: float = 0.7, limit: int = 20) -> DataFrame:
    """Customers most likely to leave, with last order and spend (any status).

    The short list is cut first; only its customers' orders are totalled.
    """
    risky = segments.filter(F.col("churn_probability") > above)
    listed = (customers.select("customer_id", "email", "first_name", "last_name")
              .join(risky.select("customer_id", "churn_probability", "clv_prediction", "segment_name"),
                    "customer_id")
              .orderBy(F.col("churn_probability").desc(), F.col("clv_prediction").desc_nulls_first(),
                       "customer_id")
              .limit(limit))
    # At most ``limit`` rows, read twice below.
    listed = stage(listed, "listed")
    spent = (orders.join(listed.select("customer_id"), "customer_id", "left_semi")
             .groupBy("customer_id")
             .agg(F.max("order_date").alias("last_order_date"),
                  money_sum("total_amount").alias("total_spent")))
    return (listed.join(spent, "customer_id", "left")
            .select("customer_id", "email", full_name("first_name", "last_name").alias("name"),
                    "churn_probability",
                    F.coalesce("clv_prediction", F.lit(0.0)).alias("clv_prediction"),
                    F.col("segment_name").alias("segment"), "last_order_date",
                    F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"))
            .orderBy(F.col("churn_probability").desc(), F.col("clv_prediction").desc(), "customer_id"))


def recent_revenue(orders: DataFrame, as_of: AsOf = None, days: int = 30,
                   statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    return (last_days(orders, "order_date", as_of, days).filter(is_realised(statuses=statuses))
            .agg(F.coalesce(money_sum("total_amount"), F.lit(0.0)).alias("revenue")))


def top_products(orders: DataFrame, items: DataFrame, products: DataFrame, as_of: AsOf = None,
                 days: int = 30, limit: int = 5) -> DataFrame:
    ranked = product_ranking(orders, items, products, as_of, days, limit)
    return ranked.select("product_id", "product_name", F.col("total_revenue").alias("revenue"))


def churn_band_counts(segments: DataFrame) -> DataFrame:
    """Customers in each report band, one row."""
    band = risk_band("churn_probability")
    count = lambda name: F.coalesce(F.sum(flag(band == name).cast("bigint")), F.lit(0)).alias(name)
    return (segments.filter(F.col("churn_probability").isNotNull())
            .agg(count("high_risk"), count("medium_risk"), count("low_risk")))


def exec_summary(orders: DataFrame, items: DataFrame, products: DataFrame, customers: DataFrame,
                 segments: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One row with the report figures, the top products and the advice."""
    today = as_of_col(as_of, orders, "order_date")
    best = top_products(orders, items, products, as_of)
    # Five rows: their order and list are cheap.
    place = F.row_number().over(Window.orderBy(F.col("revenue").desc(), "product_id"))
    listed = best.select(F.struct(place.alias("place"), "product_id", "product_name", "revenue").alias("p"))
    return churn_band_counts(segments).select(
        recent_revenue(orders, as_of).scalar().alias("monthly_revenue"),
        customer_growth(customers, today).scalar().alias("customer_growth"),
        listed.agg(F.sort_array(F.collect_list("p"))).scalar().alias("top_products"),
        "high_risk", "medium_risk", "low_risk",
        F.array(*[F.lit(a) for a in STANDING_ADVICE]).alias("recommendations"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
            .orderBy(F.col("count").desc(), column))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins between the ends; the last bin is closed."""
    # The column alone is written once; ends and counts read that copy.
    df = stage(df.select(F.col(column)), "histogram")
    ends = df.agg(F.struct(F.min(column).cast("double").alias("lo"),
                           F.max(column).cast("double").alias("hi")).alias("ends"))
    e = F.col("e")
    flat = e["lo"] == e["hi"]
    low = F.when(flat, e["lo"] - 0.5).otherwise(e["lo"])
    high = F.when(flat, e["hi"] + 0.5).otherwise(e["hi"])
    placed = (df.filter(F.col(column).isNotNull())
              .select(F.col(column).cast("double").alias("x"), ends.scalar().alias("e"))
              .select(F.least(F.floor((F.col("x") - low) / (high - low) * bins) + 1, F.lit(bins)).alias("bin"))
              .groupBy("bin").agg(F.count("*").alias("count")))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"), ends.scalar().alias("e"))
    width = (high - low) / bins
    return (grid.join(placed, "bin", "left")
            .select("bin", (low + width * (F.col("bin") - 1)).alias("bin_start"),
                    F.coalesce("count", F.lit(0)).alias("count")).orderBy("bin"))


def box_stats(df: DataFrame, by: str, column: str) -> DataFrame:
    """Exact minimum, quartiles and maximum of a column for each group."""
    found = exact_quantiles(df, [column], (0.0, 0.25, 0.5, 0.75, 1.0), by=by)
    names = ("min", "q1", "median", "q3", "max")
    return found.select(F.col("group").alias(by), *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(names)])
