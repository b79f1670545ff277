"""Customer segmentation: recency, frequency, monetary value and lifetime value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tillsight.functions.ranks import (
    QUINTILES, check_edges, column_quantiles, rank_edges, rank_first, score)
from tillsight.functions.scalars import (
    REALISED_STATUSES, is_realised, latest, money_avg, money_sum, round_half_even, to_col)
from tillsight.operators.marts import lines_per_order
from tillsight.session import stage

# Segment of each three-digit score, read top to bottom.  A score
# listed twice belongs to the first segment; all others are "Lost".
SEGMENT_SCORES = {
    "Champions": ("555", "554", "544", "545", "454", "455", "445"),
    "Loyal Customers": ("543", "444", "435", "355", "354", "345", "344", "335"),
    "Potential Loyalists": ("553", "551", "552", "541", "542", "533", "532", "531", "452", "451"),
    "New Customers": ("512", "511", "422", "421", "412", "411", "311"),
    "At Risk": ("155", "154", "144", "214", "215", "115", "114"),
    "Cannot Lose Them": ("155", "254", "245"),
    "Hibernating": ("331", "321", "231", "241", "251"),
}
OTHER_SEGMENT = "Lost"


def segment_base(customers: DataFrame, orders: DataFrame, items: DataFrame,
                 statuses: Sequence[str] = REALISED_STATUSES, order_grain: bool = False) -> DataFrame:
    """Order totals of every customer with at least one realised order.

    Amounts count once per order line (an order without lines counts once)
    unless ``order_grain``.  Lines are reduced to orders and orders to
    customers before customer attributes are joined.
    """
    weight = F.lit(1) if order_grain else F.coalesce("n_lines", F.lit(1))
    sold = (orders.filter(is_realised(statuses=statuses))
            .select("order_id", "customer_id", "order_date", "total_amount")
            .join(lines_per_order(items), "order_id", "left"))
    totals = sold.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        money_sum("total_amount", weight).alias("total_spent"),
        money_avg("total_amount", weight).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("n_items").alias("total_items_purchased"))
    wanted = [c for c in ("customer_id", "email", "first_name", "last_name", "country", "age",
                          "registration_date") if c in customers.columns]
    return customers.select(*wanted).join(totals.filter(F.col("total_orders") > 0), "customer_id")


def quintile_scores(df: DataFrame, recency: str, frequency: str, monetary: str,
                    duplicates: str = "raise") -> DataFrame:
    """Scores 1..5 for three measures of one row per customer.

    Recency and money are cut at their quintiles, frequency at the quintiles
    of its rank (ties by customer).  Equal edges raise, as no bin would remain
    between them; ``duplicates="drop"`` merges such bins instead.
    """
    rows = df.count()
    cuts = column_quantiles(df, [recency, monetary], QUINTILES)
    r_edges = check_edges(cuts[recency], recency, duplicates)
    m_edges = check_edges(cuts[monetary], monetary, duplicates)
    f_edges = check_edges(rank_edges(rows), frequency, duplicates)
    ranked = rank_first(df, [F.col(frequency).asc(), F.col("customer_id").asc()], "_rank")
    return ranked.withColumns({
        "recency_score": score(recency, r_edges, descending=True),
        "frequency_score": score("_rank", f_edges),
        "monetary_score": score(monetary, m_edges)}).drop("_rank")


def rfm_scores(base: DataFrame, duplicates: str = "raise") -> DataFrame:
    """Recency, frequency, monetary value, their scores and the three-digit code.

    The base is staged, as edges and scores both read it.
    """
    staged = stage(base, "rfm")
    measured = staged.withColumns({
        "recency": F.datediff(latest(staged, "last_order_date"), "last_order_date"),
        "frequency": F.col("total_orders"),
        "monetary": F.col("total_spent")})
    scored = quintile_scores(measured, "recency", "frequency", "monetary", duplicates)
    return scored.withColumn("rfm_score", F.concat(*[
        F.col(c).cast("string") for c in ("recency_score", "frequency_score", "monetary_score")]))


def segment_of(code: str | Column) -> Column:
    """Segment name of a three-digit score."""
    code, label = to_col(code), None
    for name, codes in SEGMENT_SCORES.items():
        label = (F if label is None else label).when(code.isin(*codes), name)
    return label.otherwise(OTHER_SEGMENT)


def rfm_labels(scored: DataFrame) -> DataFrame:
    return scored.withColumn("rfm_segment", segment_of("rfm_score"))


def clv(df: DataFrame) -> DataFrame:
    """Order value x orders per day x mean customer lifespan."""
    span = F.coalesce(F.datediff("last_order_date", "first_order_date"), F.lit(0))
    lived = df.withColumn("customer_lifespan_days", span)
    mean_span = lived.agg(F.sum(F.col("customer_lifespan_days").cast("bigint")).cast("double")
                          / F.nullif(F.count("*"), F.lit(0)))
    per_day = F.col("total_orders") / (F.col("customer_lifespan_days") + 1)
    return (lived.withColumn("purchase_frequency", per_day)
            .withColumn("predicted_clv", round_half_even(
                F.col("avg_order_value") * F.col("purchase_frequency") * mean_span.scalar())))


def segment_profile(df: DataFrame, by: str = "rfm_segment") -> DataFrame:
    """Size and mean figures of each segment or cluster, two decimals."""
    mean = lambda c, name: round_half_even(F.avg(c)).alias(name)
    return df.groupBy(by).agg(
        F.count("customer_id").alias("customer_count"),
        mean("recency", "avg_recency"), mean("frequency", "avg_frequency"),
        round_half_even(money_avg("monetary")).alias("avg_monetary"),
        mean("avg_order_value", "avg_order_value"), mean("age", "avg_age"))


def segments_table(df: DataFrame, placeholder_seed: int | None = None) -> DataFrame:
    """The stored segment rows.

    ``churn_probability`` stays null until scores are overlaid; with a seed it
    holds random placeholders between .1 and .9.
    """
    p = (F.lit(None).cast("double") if placeholder_seed is None
         else F.rand(placeholder_seed) * 0.8 + 0.1)
    cluster = (F.col("kmeans_cluster") if "kmeans_cluster" in df.columns
               else F.lit(None).cast("int").alias("kmeans_cluster"))
    return df.select("customer_id", F.col("rfm_segment").alias("segment_name"), "rfm_score",
                     "recency_score", "frequency_score", "monetary_score",
                     F.col("predicted_clv").alias("clv_prediction"), cluster,
                     p.alias("churn_probability"))
