"""The joins between the retail tables, row for row.

Inner joins are left to Catalyst and AQE, which splits a hot key on either
side.  A left outer join cannot split a hot key on its right side, so where
that side may be skewed it is written as inner join plus unmatched rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.scalars import REALISED_STATUSES, is_realised

# Statuses that enter the churn figures.
CHURN_STATUSES = ("Completed", "Delivered", "Returned", "Cancelled")


def left_join_many(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join where one key may own a large share of ``right``.

    The keys of ``right`` are made distinct before they meet ``left`` for the
    unmatched part, and the matched part is an inner join.
    """
    matched = left.join(right, key)
    unmatched = left.join(right.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def orders_with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Inner join of orders and their lines, no status filter."""
    return orders.join(items, "order_id")


def realised_order_lines(customers: DataFrame, orders: DataFrame, items: DataFrame,
                         statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Customers and their orders of the given statuses; orders without lines stay."""
    sold = customers.join(orders.filter(is_realised(statuses=statuses)), "customer_id")
    return left_join_many(sold, items, "order_id")


def churn_order_lines(customers: DataFrame, orders: DataFrame, items: DataFrame,
                      products: DataFrame, statuses: Sequence[str] = CHURN_STATUSES) -> DataFrame:
    """As above with product columns, for sold, returned and cancelled orders."""
    lines = items.join(products, "product_id", "left")
    return realised_order_lines(customers, orders, lines, statuses)


def product_order_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, lines and products, inner."""
    return orders.join(items, "order_id").join(products, "product_id")


def scored_customer_orders(customers: DataFrame, segments: DataFrame, orders: DataFrame,
                           above: float) -> DataFrame:
    """Customers scored above a threshold with all their orders, if any."""
    risky = segments.filter(F.col("churn_probability") > above)
    return left_join_many(customers.join(risky, "customer_id"), orders, "customer_id")


def overlay_scores(segments: DataFrame, scores: DataFrame) -> DataFrame:
    """Replace ``churn_probability`` where a new score exists, keep it elsewhere."""
    fresh = scores.select("customer_id", F.col("churn_probability").alias("_new"))
    merged = segments.join(fresh, "customer_id", "left")
    return merged.select(*[
        F.coalesce("_new", c).alias(c) if c == "churn_probability" else F.col(c)
        for c in segments.columns])


def restrict_to(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in the short list ``wanted`` (a top-n)."""
    return df.join(wanted.select(key), key, "left_semi")


def calendar_fill(df: DataFrame, date_col: str, zero: Sequence[str], step: str = "1 day",
                  keys: Sequence[str] = (), longest: int = 36_525) -> DataFrame:
    """Put each series on a gap-free grid between its own ends, gaps as 0.

    A series that spans more than ``longest`` days, which one mistyped date is
    enough for, is refused.
    """
    spans = df.groupBy(*keys).agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    end = F.when(F.datediff("_hi", "_lo") <= longest, F.col("_hi")).otherwise(F.raise_error(F.concat(
        F.lit("series too long: "), F.col("_lo").cast("string"), F.lit(" to "), F.col("_hi").cast("string"))).cast("date"))
    grid = spans.select(*keys, F.explode(
        F.sequence(F.col("_lo"), end, F.expr(f"interval {step}"))).alias(date_col))
    filled = grid.join(df, [*keys, date_col], "left")
    return filled.select(*[
        F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) if c in zero else F.col(c)
        for c in df.columns])
