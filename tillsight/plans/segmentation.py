"""Customer segmentation from base to stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillsight.operators import clusters, rfm
from tillsight.session import scratch_path, stage
from tillsight.sources import readers, writers


@dataclass
class Segmentation:
    customers: DataFrame
    rfm_profile: DataFrame
    cluster_profile: DataFrame
    segments: DataFrame
    silhouette: float


def store_segments(df: DataFrame, path: str | None = None, placeholder_seed: int | None = None) -> DataFrame:
    """Replace the segment table and read it back."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "customer_segments")
    writers.replace_table(rfm.segments_table(df, placeholder_seed), path)
    return readers.read_table(spark, path)


def run_segmentation(customers: DataFrame, orders: DataFrame, items: DataFrame, path: str | None = None,
                     k: int | None = None, **kmeans) -> Segmentation:
    """Scores, labels, clusters, lifetime value, profiles and the stored table."""
    labelled = rfm.rfm_labels(rfm.rfm_scores(rfm.segment_base(customers, orders, items)))
    clustered, quality = clusters.cluster_customers(labelled, k=k, **kmeans)
    valued = stage(rfm.clv(clustered), "segmentation")
    return Segmentation(valued, rfm.segment_profile(valued, "rfm_segment"),
                        rfm.segment_profile(valued, "kmeans_cluster"),
                        store_segments(valued, path), quality)
