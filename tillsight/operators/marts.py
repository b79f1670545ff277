"""Summary tables built after cleaning.

Order amounts are taken once per order line, as the joined table has them; pass
``order_grain=True`` to count each order once.  Lines are first reduced to one
row per order, so neither a hot order nor a hot customer meets a join with all
its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.scalars import latest, money_avg, money_sum, round_half_even


def lines_per_order(items: DataFrame) -> DataFrame:
    """Number of lines and items of each order."""
    return items.groupBy("order_id").agg(F.count("*").alias("n_lines"),
                                         F.sum(F.col("quantity").cast("bigint")).alias("n_items"))


def customer_summary(orders: DataFrame, items: DataFrame, order_grain: bool = False) -> DataFrame:
    """Orders, spend, dates and recency of each customer with order lines."""
    weight = F.lit(1) if order_grain else F.col("n_lines")
    sold = (orders.filter(F.col("customer_id").isNotNull())
            .select("order_id", "customer_id", "order_date", "total_amount")
            .join(lines_per_order(items), "order_id"))
    totals = sold.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        round_half_even(F.coalesce(money_sum("total_amount", weight), F.lit(0.0))).alias("total_spent"),
        round_half_even(money_avg("total_amount", weight)).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.coalesce(F.sum("n_items"), F.lit(0)).alias("total_items"))
    return totals.withColumns({
        "recency_days": F.datediff(latest(orders, "order_date"), "last_order_date"),
        "frequency": F.col("total_orders"),
        "monetary": F.col("total_spent")})


def product_performance(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Quantity, revenue and orders of each product, whatever the order status."""
    lines = (items.filter(F.col("product_id").isNotNull())
             .select("order_id", "product_id", "quantity", "total_price")
             .join(orders.select("order_id"), "order_id"))
    return lines.groupBy("product_id").agg(
        F.coalesce(F.sum(F.col("quantity").cast("bigint")), F.lit(0)).alias("total_quantity_sold"),
        round_half_even(F.coalesce(money_sum("total_price"), F.lit(0.0))).alias("total_revenue"),
        F.count_distinct("order_id").alias("unique_orders"))


def monthly_sales(orders: DataFrame) -> DataFrame:
    """Orders, revenue and customers of each month, whatever the order status."""
    day = F.col("order_date")
    return (orders.filter(day.isNotNull())
            .groupBy(F.year(day).alias("order_year"), F.month(day).alias("order_month"))
            .agg(F.count("order_id").alias("total_orders"),
                 round_half_even(F.coalesce(money_sum("total_amount"), F.lit(0.0))).alias("total_revenue"),
                 F.count_distinct("customer_id").alias("unique_customers")))
