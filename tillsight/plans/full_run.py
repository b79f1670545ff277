"""Command-line run of the stages: etl, analytics, reports or all of them."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tillsight.functions.scalars import AsOf, as_of_col
from tillsight.operators import alerts, metrics
from tillsight.plans.churn import run_churn
from tillsight.plans.etl import run_etl
from tillsight.plans.forecasting import run_forecasting
from tillsight.plans.segmentation import run_segmentation
from tillsight.session import clear_scratch, tune_sales
from tillsight.sources import readers, writers

MODES = ("full", "etl", "analytics", "reports")


def run_analytics(spark: SparkSession, out_dir: str, as_of: AsOf = None, k: int | None = None, **options) -> dict:
    """Segmentation, forecasts, then churn, whose scores go into the segments."""
    tables = readers.read_parquet_tables(
        spark, f"{out_dir}/tables", ("customers", "products", "orders", "order_items"))
    customers, products = tables["customers"], tables["products"]
    orders, items = tables["orders"], tables["order_items"]
    segments_path = f"{out_dir}/tables/customer_segments"
    return {
        "segmentation": run_segmentation(customers, orders, items, segments_path, k=k),
        "forecasting": run_forecasting(orders, items, products, f"{out_dir}/tables/sales_forecasts"),
        "churn": run_churn(customers, orders, items, products, as_of, segments_path,
                           f"{out_dir}/tables/customer_churn_predictions", **options)}


def run_reports(spark: SparkSession, out_dir: str, as_of: AsOf = None) -> DataFrame:
    """Export sheets, store fired alerts, return the summary row."""
    t = readers.read_parquet_tables(spark, f"{out_dir}/tables", (
        "customers", "products", "orders", "order_items", "customer_segments"))
    today = as_of_col(as_of, t["orders"], "order_date")
    summary = metrics.exec_summary(t["orders"], t["order_items"], t["products"], t["customers"],
                                   t["customer_segments"], today)
    writers.export_sheets({
        "Top Products": metrics.top_products(t["orders"], t["order_items"], t["products"], today),
        "Customer Segments": readers.segments_scan(t["customer_segments"], 1000),
        "Daily Sales": metrics.sales_trends(t["orders"], "daily", today, 90),
        "Product Performance": metrics.product_ranking(t["orders"], t["order_items"], t["products"])
        .drop("unique_orders")}, f"{out_dir}/reports/detailed_analytics")
    writers.export_sheets({"executive_summary": summary}, f"{out_dir}/reports", "json")
    alerts.emit_alerts(alerts.run_alerts(t["orders"], t["customer_segments"], today),
                       f"{out_dir}/tables/alerts")
    return summary


def run(spark: SparkSession, in_dir: str, out_dir: str, as_of: AsOf = None, mode: str = "full",
        k: int | None = None, **options) -> dict:
    """Run one stage or all; returns what each stage made."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}, choose from {MODES}")
    tune_sales(spark)
    made = {}
    if mode in ("full", "etl"):
        made["quality"] = run_etl(spark, in_dir, out_dir, as_of)
    if mode in ("full", "analytics"):
        made |= run_analytics(spark, out_dir, as_of, k, **options)
    if mode in ("full", "reports"):
        made["summary"] = run_reports(spark, out_dir, as_of)
    return made


def main() -> None:
    parser = argparse.ArgumentParser(description="Retail analytics run")
    parser.add_argument("in_dir")
    parser.add_argument("out_dir")
    parser.add_argument("--mode", choices=MODES, default="full")
    parser.add_argument("--as-of", help="reference date, YYYY-MM-DD")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tillsight").getOrCreate()
    try:
        run(spark, args.in_dir, args.out_dir, args.as_of, args.mode)
    finally:
        clear_scratch(spark)


if __name__ == "__main__":
    main()
