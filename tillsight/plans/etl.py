"""Extract, validate, clean, summarise, load."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.functions.scalars import AsOf
from tillsight.operators import clean, marts, quality
from tillsight.session import stage
from tillsight.sources import readers, writers

log = logging.getLogger(__name__)


def run_etl(spark: SparkSession, in_dir: str, out_dir: str, as_of: AsOf = None) -> DataFrame | None:
    """Read the raw files, write cleaned tables, summaries and the check log.

    Returns the quality report, or None when no raw file was found.
    """
    raw = readers.read_raw_csv(spark, in_dir)
    if not raw:
        log.error("no raw tables found in %s", in_dir)
        return None
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    report = stage(quality.quality_report(raw, today), "quality")
    # Staged once: every summary and export below reads the cleaned rows.
    rows = {name: df.drop(quality.BAD_VALUES) for name, df in raw.items()}
    cleaned = {name: stage(df, name) for name, df in clean.clean(rows, as_of).items()}
    writers.load_tables({**cleaned, **summaries(cleaned), "data_quality_logs": report}, f"{out_dir}/tables")
    writers.write_processed_csv(cleaned, f"{out_dir}/processed")
    return report


def summaries(cleaned: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The three summary tables; needs orders and their lines."""
    if not {"orders", "order_items"} <= cleaned.keys():
        return {}
    orders, items = cleaned["orders"], cleaned["order_items"]
    return {"customer_summary": marts.customer_summary(orders, items),
            "product_performance": marts.product_performance(orders, items),
            "monthly_sales": marts.monthly_sales(orders)}
