"""Ranks, quintiles, RFM segments, lifetime value and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.catalog.base import even, labelled, msum, query, segment_base
from tillsight.functions.ranks import column_quantiles, rank_first
from tillsight.functions.scalars import money_sum
from tillsight.operators import clusters, rfm
from tillsight.plans import segmentation as plan
from tillsight.session import stage
from tillsight.sources.star import Star


@query("w6_rank_first", """
    SELECT customer_id, total_orders, row_number() OVER (ORDER BY total_orders, customer_id) AS place
    FROM r_segment_base""")
def w6(t: Star) -> DataFrame:
    counts = segment_base(t).select("customer_id", "total_orders")
    return rank_first(counts, [F.col("total_orders").asc(), F.col("customer_id").asc()], "place")


@query("w7_qcut_scores", "SELECT customer_id, recency_score, frequency_score, monetary_score FROM r_rfm")
def w7(t: Star) -> DataFrame:
    return rfm.rfm_scores(segment_base(t)).select(
        "customer_id", "recency_score", "frequency_score", "monetary_score")


@query("w9_global_scalars", f"""
    SELECT MAX(last_order_date) AS latest, {even('AVG(customer_lifespan_days)', 6)} AS mean_lifespan,
           quantile_cont(total_spent, 0.5) AS median_spent, quantile_cont(CAST(age AS DOUBLE), 0.5) AS median_age
    FROM r_clv""")
def w9(t: Star) -> DataFrame:
    """Latest date, mean lifespan and exact medians in one row."""
    base = stage(segment_base(t), "scalars")
    medians = column_quantiles(base, ["total_spent", "age"], (0.5,))
    span = F.datediff("last_order_date", "first_order_date")
    return base.agg(
        F.max("last_order_date").alias("latest"),
        (F.rint(F.avg(span) * 1e6) / 1e6).alias("mean_lifespan"),
        F.lit(medians["total_spent"][0]).alias("median_spent"),
        F.lit(medians["age"][0]).alias("median_age"))


@query("seg_rfm_scores", """
    SELECT customer_id, recency, frequency, monetary, recency_score, frequency_score, monetary_score,
           rfm_score FROM r_rfm""")
def seg_rfm_scores(t: Star) -> DataFrame:
    return rfm.rfm_scores(segment_base(t)).select(
        "customer_id", "recency", "frequency", "monetary", "recency_score", "frequency_score",
        "monetary_score", "rfm_score")


@query("seg_rfm_labels", "SELECT customer_id, rfm_score, rfm_segment FROM r_rfm")
def seg_rfm_labels(t: Star) -> DataFrame:
    return labelled(t).select("customer_id", "rfm_score", "rfm_segment")


@query("seg_clv", """
    SELECT customer_id, customer_lifespan_days, purchase_frequency, predicted_clv FROM r_clv""")
def seg_clv(t: Star) -> DataFrame:
    return rfm.clv(labelled(t)).select(
        "customer_id", "customer_lifespan_days", "purchase_frequency", "predicted_clv")


@query("seg_write", "SELECT * EXCLUDE (churn_probability), CAST(NULL AS DOUBLE) AS churn_probability FROM r_segments")
def seg_write(t: Star) -> DataFrame:
    return plan.store_segments(rfm.clv(labelled(t))).drop("kmeans_cluster")


@query("seg_kmeans")
def seg_kmeans(t: Star) -> DataFrame:
    found, quality = clusters.cluster_customers(rfm.rfm_scores(segment_base(t)), k=4)
    return found.select("customer_id", "kmeans_cluster", F.lit(quality).alias("silhouette"))


@query("seg_choose_k")
def seg_choose_k(t: Star) -> DataFrame:
    features = clusters.standardised(rfm.rfm_scores(segment_base(t)))
    return t.spark.createDataFrame(clusters.score_k(features), "k int, cost double, silhouette double")


@query("a18_cluster_profile")
def a18_cluster_profile(t: Star) -> DataFrame:
    found, _ = clusters.cluster_customers(rfm.rfm_scores(segment_base(t)), k=4)
    return rfm.segment_profile(found, "kmeans_cluster")


@query("seg_full_run")
def seg_full_run(t: Star) -> DataFrame:
    """All segmentation steps; returns the stored segment rows."""
    return plan.run_segmentation(t.customers, t.orders, t.order_items).segments


@query("seg_kmeans_check", "SELECT COUNT(*) AS customers, COUNT(*) AS clustered, TRUE AS ids_fit FROM r_rfm")
def seg_kmeans_check(t: Star) -> DataFrame:
    """Every customer is in one of the four clusters."""
    found, _ = clusters.cluster_customers(labelled(t), k=4)
    c = F.col("kmeans_cluster")
    return found.agg(F.count_distinct("customer_id").alias("customers"), F.count(c).alias("clustered"),
                     ((F.min(c) >= 0) & (F.max(c) < 4)).alias("ids_fit"))


@query("seg_choose_k_check", "SELECT CAST(unnest(generate_series(2, 10)) AS INTEGER) AS k, TRUE AS cost_fits, TRUE AS silhouette_fits")
def seg_choose_k_check(t: Star) -> DataFrame:
    """Two to ten clusters, each with a cost and a silhouette."""
    return seg_choose_k(t).select("k", (F.col("cost") > 0).alias("cost_fits"),
                                  F.col("silhouette").between(-1, 1).alias("silhouette_fits"))


@query("a18_cluster_profile_check", f"""
    SELECT CAST(4 AS BIGINT) AS clusters, COUNT(*) AS customers, {even(msum('monetary'), 0)} AS spent, TRUE AS means_fit FROM r_rfm""")
def a18_cluster_profile_check(t: Star) -> DataFrame:
    """Four clusters share all customers and what they spent; means lie between the extremes."""
    base = rfm.rfm_scores(segment_base(t))
    ends = base.agg(F.struct(F.min("recency").alias("a"), F.max("recency").alias("b"), F.min("frequency").alias("c"),
                             F.max("frequency").alias("d"))).scalar()
    found = a18_cluster_profile(t).withColumn("e", ends)
    fits = F.col("avg_recency").between(F.col("e.a"), F.col("e.b")) & F.col("avg_frequency").between(F.col("e.c"), F.col("e.d"))
    # Means have two decimals, so a cluster's total is right to half a cent for each customer.
    total = F.sum(F.col("avg_monetary") * F.col("customer_count"))
    exact = base.agg(money_sum("monetary")).scalar()
    n = F.sum("customer_count")
    return found.agg(F.count("*").alias("clusters"), n.alias("customers"),
                     F.when(F.abs(total - exact) <= n * 0.005 + 0.01, F.rint(exact)).alias("spent"), F.bool_and(fits).alias("means_fit"))


@query("seg_full_run_check", """
    SELECT customer_id, segment_name, rfm_score, recency_score, frequency_score, monetary_score, clv_prediction, TRUE AS clustered
    FROM r_segments""")
def seg_full_run_check(t: Star) -> DataFrame:
    """The stored segments of the whole run; the cluster, which depends on the fit, is one of two to ten."""
    return seg_full_run(t).select("customer_id", "segment_name", "rfm_score", "recency_score", "frequency_score", "monetary_score",
                                  "clv_prediction", F.col("kmeans_cluster").between(0, 9).alias("clustered"))
