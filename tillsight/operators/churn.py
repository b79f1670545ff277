"""Churn figures, labels and features of customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.ranks import rank_first
from tillsight.functions.scalars import (
    AsOf, as_of_col, flag, int_ratio, is_realised, money_avg, money_sum, ratio)
from tillsight.operators.clusters import fill_with_median
from tillsight.operators.joins import CHURN_STATUSES
from tillsight.operators.marts import lines_per_order
from tillsight.operators.rfm import quintile_scores
from tillsight.session import stage

# Model inputs in order; the two text columns follow encoded.
NUMERIC_FEATURES = (
    "age", "total_orders", "total_spent", "avg_order_value", "days_since_last_order",
    "customer_lifetime_days", "total_items", "categories_purchased", "active_months",
    "avg_discount", "return_rate", "cancel_rate", "recency_score", "frequency_score",
    "monetary_score", "avg_days_between_orders", "spending_trend", "diversity_score",
    "tenure_days", "engagement_ratio", "purchase_intensity")
TEXT_FEATURES = ("gender", "country")
FEATURES = NUMERIC_FEATURES + tuple(f"{c}_encoded" for c in TEXT_FEATURES)


def churn_base(customers: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame,
               as_of: AsOf = None, statuses: Sequence[str] = CHURN_STATUSES) -> DataFrame:
    """Order figures of every customer with a sold, returned or cancelled order.

    Amounts, returns and cancellations count once per order line.  Lines are
    reduced to orders first, which leaves distinct months as the only distinct
    count; distinct categories take a narrow pass of their own.
    """
    placed = (orders.filter(is_realised(statuses=statuses))
              .select("order_id", "customer_id", "order_date", "total_amount", "discount_amount",
                      "order_status"))
    sold = (placed.join(lines_per_order(items), "order_id", "left")
            .withColumn("w", F.coalesce("n_lines", F.lit(1).cast("bigint"))))
    with_status = lambda s: F.coalesce(
        F.sum(F.when(F.col("order_status") == s, F.col("w"))), F.lit(0))
    totals = sold.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        money_sum("total_amount", "w").alias("total_spent"),
        money_avg("total_amount", "w").alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("n_items").alias("total_items"),
        F.count_distinct(F.trunc("order_date", "month")).alias("active_months"),
        money_avg("discount_amount", "w").alias("avg_discount"),
        with_status("Returned").alias("return_count"),
        with_status("Cancelled").alias("cancel_count"))
    categories = (items.select("order_id", "product_id")
                  .join(products.select("product_id", "category"), "product_id")
                  .join(placed.select("order_id", "customer_id"), "order_id")
                  .groupBy("customer_id")
                  .agg(F.count_distinct("category").alias("categories_purchased")))
    wanted = ["customer_id", "age", "gender", "country", "registration_date"]
    known = customers.select(*[c for c in wanted if c in customers.columns])
    joined = (known.join(totals.filter(F.col("total_orders") > 0), "customer_id")
              .join(categories, "customer_id", "left")
              .withColumn("categories_purchased", F.coalesce("categories_purchased", F.lit(0))))
    return derived_rates(joined, as_of_col(as_of, orders, "order_date"))


def derived_rates(df: DataFrame, today: Column) -> DataFrame:
    """Day spans and rates from the customer totals; orders per month is integer division."""
    return df.withColumns({
        "days_since_last_order": F.datediff(today, "last_order_date"),
        "customer_lifetime_days": F.datediff("last_order_date", "first_order_date"),
        "calculated_aov": ratio("total_spent", "total_orders"),
        "orders_per_month": int_ratio("total_orders", "active_months"),
        "return_rate": ratio("return_count", "total_orders"),
        "cancel_rate": ratio("cancel_count", "total_orders")})


def churn_labels(df: DataFrame, days: int = 90, returns: float = 0.2, cancels: float = 0.1,
                 engagement: float = 0.5, min_score: int = 2) -> DataFrame:
    """Four 0/1 signs, their sum and the label; an unknown value is no sign."""
    signs = {"is_churned": F.col("days_since_last_order") > days,
             "high_return_rate": F.col("return_rate") > returns,
             "high_cancel_rate": F.col("cancel_rate") > cancels,
             "low_engagement": F.col("orders_per_month") < engagement}
    marked = df.withColumns({name: flag(c) for name, c in signs.items()})
    total = sum((F.col(name) for name in signs), F.lit(0))
    return (marked.withColumn("churn_risk_score", total)
            .withColumn("churn_label", (F.col("churn_risk_score") >= min_score).cast("int")))


def churn_features(df: DataFrame, today: Column, duplicates: str = "raise") -> DataFrame:
    """Scores and behaviour ratios; the input is staged because edges and rows both read it."""
    staged = stage(df, "churn")
    scored = quintile_scores(staged, "days_since_last_order", "total_orders", "total_spent", duplicates)
    lifetime, orders = F.col("customer_lifetime_days"), F.col("total_orders")
    return (scored.withColumns({
        "avg_days_between_orders": ratio(lifetime, orders),
        "spending_trend": ratio("total_spent", lifetime + 1),
        "diversity_score": ratio("categories_purchased", orders),
        "tenure_days": F.datediff(today, "registration_date")})
        .withColumn("tenure_months", F.col("tenure_days") / 30)
        .withColumns({
            "engagement_ratio": F.col("active_months") / F.nullif(F.col("tenure_months") + 1, F.lit(0.0)),
            "purchase_intensity": ratio(orders, F.col("tenure_days") + 1)}))


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>_encoded``: position of the value in sorted order, from 0; null is 'Unknown'."""
    value = F.coalesce(F.col(column), F.lit("Unknown"))
    labels = stage(df.select(value.alias("_value")).distinct(), "labels")
    coded = rank_first(labels, [F.col("_value").asc()], "_place")
    return (df.withColumn("_value", value)
            .join(coded.select("_value", (F.col("_place") - 1).cast("int").alias(f"{column}_encoded")),
                  "_value").drop("_value"))


def feature_matrix(features: DataFrame) -> DataFrame:
    """Customer, the 23 model inputs (medians for nulls, text encoded) and the label."""
    filled = fill_with_median(features, NUMERIC_FEATURES)
    for column in TEXT_FEATURES:
        filled = label_encode(filled, column)
    return filled.select("customer_id", *FEATURES, "churn_label")


def stratified_split(df: DataFrame, label: str = "churn_label", id_col: str = "customer_id",
                     train_share: float = 0.8, folds: int = 5) -> DataFrame:
    """Add ``is_train`` and, for training rows, ``fold``; each label is divided alike.

    Rows are placed by a hash of their key, so the split repeats on every run.
    """
    hashed = df.withColumn("_hash", F.md5(F.col(id_col).cast("string")))
    ranked = rank_first(hashed, [F.col("_hash").asc(), F.col(id_col).asc()], "_place", by=[label])
    sizes = df.groupBy(F.col(label).alias("_label")).agg(F.floor(F.count("*") * F.lit(train_share)).alias("_cut"))
    known = ranked.join(sizes, F.col(label).eqNullSafe(F.col("_label")))
    return (known.withColumn("is_train", F.col("_place") <= F.col("_cut"))
            .withColumn("fold", F.when(F.col("is_train"), ((F.col("_place") - 1) % folds).cast("int")))
            .drop("_hash", "_place", "_label", "_cut"))


def churn_insights(scored: DataFrame) -> DataFrame:
    """One row: high-risk customers, churned against active averages, advice."""
    high = F.col("churn_risk_category") == "High Risk"
    by_label = lambda c, v: F.avg(F.when(F.col("churn_label") == v, F.col(c)))
    facts = scored.agg(
        F.coalesce(F.sum(flag(high).cast("bigint")), F.lit(0)).alias("high_risk_count"),
        F.coalesce(money_sum(F.when(high, F.col("total_spent"))), F.lit(0.0)).alias("high_risk_revenue_at_stake"),
        by_label("days_since_last_order", 1).alias("avg_days_since_last_order_churned"),
        by_label("days_since_last_order", 0).alias("avg_days_since_last_order_active"),
        by_label("total_orders", 1).alias("avg_orders_churned"),
        by_label("total_orders", 0).alias("avg_orders_active"))
    count, stake = F.col("high_risk_count"), F.col("high_risk_revenue_at_stake")
    advice = F.array(
        F.when(count > 0, F.concat(F.lit("Immediate attention needed for "), count.cast("string"),
                                   F.lit(" high-risk customers"))),
        F.when(count > 0, F.concat(F.lit("Potential revenue loss: $"), F.format_number(stake, 2))),
        F.when(F.col("avg_days_since_last_order_churned") > 60,
               F.lit("Implement re-engagement campaigns for customers inactive >60 days")),
        F.when(F.col("avg_orders_churned") < 3,
               F.lit("Focus on increasing purchase frequency for new customers")))
    return facts.withColumn("recommendations", F.array_compact(advice))
