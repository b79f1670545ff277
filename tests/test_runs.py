"""Whole runs, files, streams and scans."""

import datetime as dt
import re

import pytest
from pyspark.errors import AnalysisException

from __spark_entry__ import queries
from tillsight import session
from tillsight.catalog.etl import _column_counts, _raw_shape
from tillsight.operators import metrics
from tillsight.plans import full_run
from tillsight.sources import readers, writers
from tillsight.sources.star import Star
from tillsight.streaming import live

FOLDER = "/root/testdata/sf0.001"


def test_full_run(spark, tmp_path):
    raw, out = f"{tmp_path}/raw", f"{tmp_path}/out"
    for name, df in _raw_shape(Star(spark, FOLDER)).items():
        writers.write_csv(df, f"{raw}/{name}.csv")
    made = full_run.run(spark, raw, out, as_of="2001-08-01", k=3, chosen=("Random Forest",), folds=2, trees=10)
    tables = {p.name for p in (tmp_path / "out" / "tables").iterdir()}
    assert {"customers", "products", "orders", "order_items", "marketing_campaigns", "customer_segments",
            "sales_forecasts", "data_quality_logs", "customer_summary", "product_performance",
            "monthly_sales", "alerts"} <= tables
    assert made["quality"].count() > 0
    segments = readers.read_table(spark, f"{out}/tables/customer_segments")
    assert segments.filter("churn_probability is null").count() == 0
    assert segments.filter("kmeans_cluster is null").count() == 0
    assert readers.read_table(spark, f"{out}/tables/sales_forecasts").count() == 90
    assert made["summary"].first().monthly_revenue > 0
    sheets = {p.name for p in (tmp_path / "out" / "reports" / "detailed_analytics").iterdir()}
    assert sheets == {"Top Products", "Customer Segments", "Daily Sales", "Product Performance"}
    with pytest.raises(AnalysisException):
        full_run.run(spark, raw, out, as_of="2001-08-01", mode="etl")


def test_missing_raw_files(spark, tmp_path):
    writers.write_csv(_raw_shape(Star(spark, FOLDER))["products"], f"{tmp_path}/products.csv")
    assert set(readers.read_raw_csv(spark, str(tmp_path))) == {"products"}
    assert full_run.run(spark, f"{tmp_path}/none", f"{tmp_path}/out", mode="etl") == {"quality": None}
    assert readers.read_catalog_table(spark, "no_such_table") is None


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.scratch_path(spark, "x").startswith(named)


def test_tune_leaves_choices_alone(spark):
    session.tune(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def _scan_rows(df):
    """Rows that left the file scans of an executed frame."""
    df.collect()

    def walk(node):
        yield node
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            yield from walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    return [n.metrics().apply("numOutputRows").value() for n in walk(plan)
            if n.getClass().getSimpleName() == "FileSourceScanExec"]


@pytest.mark.parametrize("as_of", [None, "2001-08-01"])
def test_date_bound_skips_row_groups(spark, tmp_path, as_of):
    source = Star(spark, "/root/testdata/sf0.01").orders.drop("order_date_ts")
    (source.orderBy("order_date").coalesce(1).write.option("parquet.block.row.count.limit", 1000)
     .parquet(f"{tmp_path}/orders"))
    orders = readers.read_parquet_tables(spark, str(tmp_path), ["orders"])["orders"]
    rows = _scan_rows(metrics.recent_revenue(orders, as_of))
    assert rows and min(rows) < 5000


def test_timestamp_bound_reaches_the_scan(spark):
    plan = (metrics.recent_revenue(Star(spark, FOLDER).orders, "2001-08-01")
            ._jdf.queryExecution().executedPlan().toString())
    assert "GreaterThanOrEqual(o_orderdate,2001-07-02T00:00)" in plan


def test_scan_reads_only_needed_columns(spark):
    star = Star(spark, FOLDER)
    plan = (metrics.product_ranking(star.orders, star.order_items, star.products, limit=10)
            ._jdf.queryExecution().executedPlan().toString())
    assert "l_shipdate" not in plan and "l_tax" not in plan and "o_totalprice" not in plan
    assert "TakeOrderedAndProject" in plan


def test_revenue_watch_raises_alert(spark, tmp_path):
    days = [(i, dt.datetime(2024, 1, 1 + d, 12), 1, "purchase", v, "") for i, (d, v) in
            enumerate([(0, 100.0), (1, 100.0), (2, 100.0), (3, 10.0)])]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(days, schema).write.parquet(f"{tmp_path}/in/events.parquet")
    stream = Star(spark, f"{tmp_path}/in").event_stream()
    live.watch_revenue(stream, f"{tmp_path}/days", f"{tmp_path}/alerts", f"{tmp_path}/state",
                       once=True).awaitTermination()
    fired = spark.read.parquet(f"{tmp_path}/alerts").collect()
    assert len(fired) == 1 and "$10.00 is 30% below recent average $70.00" in fired[0].message


def test_updates_keep_the_newest_row(spark, tmp_path):
    events = lambda n, v: [(n, dt.datetime(2024, 1, 1, 12, n), 1, "purchase", v, "")]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    folder = f"{tmp_path}/in"
    for n, v in ((1, 10.0), (2, 5.0)):
        spark.createDataFrame(events(n, v), schema).write.mode("append").parquet(f"{folder}/events.parquet")
        windows = live.trend_windows(Star(spark, folder).event_stream(), "1 hour")
        live.write_updates(windows, f"{tmp_path}/rows", f"{tmp_path}/state", ["window_start"], once=True).awaitTermination()
    got = live.current(spark, f"{tmp_path}/rows").collect()
    assert [(r.revenue, r.order_count) for r in got] == [(15.0, 2)]


SALES = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_late_events_count(spark, tmp_path):
    """Three batches out of order give the windows and days of one."""
    folder = f"{tmp_path}/in"
    times = [dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 13)]
    for n, at in enumerate(times):
        spark.createDataFrame([(n, at, 1, "purchase", 1.0 + n, "")], SALES).write.mode("append").parquet(
            f"{folder}/events.parquet")
        stream = Star(spark, folder).event_stream()
        live.write_updates(live.trend_windows(stream), f"{tmp_path}/hours", f"{tmp_path}/a", ["window_start"],
                           once=True).awaitTermination()
        live.watch_revenue(stream, f"{tmp_path}/days", f"{tmp_path}/alerts", f"{tmp_path}/b", once=True).awaitTermination()
    hours = {(r.window_start, r.revenue) for r in live.current(spark, f"{tmp_path}/hours").collect()}
    assert hours == {(at, 1.0 + n) for n, at in enumerate(times)}
    days = {(r.order_date, r.daily_revenue) for r in live.current(spark, f"{tmp_path}/days").collect()}
    assert days == {(dt.date(2024, 1, 2), 1.0), (dt.date(2024, 1, 1), 5.0)}
    assert len([p for p in (tmp_path / "days").iterdir() if p.name.startswith("batch=")]) <= 2


def test_days_follow_the_session_time_zone(spark, tmp_path):
    folder = f"{tmp_path}/in"
    rows = [(n, dt.datetime(2024, 1, 2, hour), 1, "purchase", 1.0, "") for n, hour in enumerate((12, 20))]
    spark.createDataFrame(rows, SALES).write.parquet(f"{folder}/events.parquet")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        live.watch_revenue(Star(spark, folder).event_stream(), f"{tmp_path}/days", f"{tmp_path}/alerts",
                           f"{tmp_path}/state", once=True).awaitTermination()
        got = live.current(spark, f"{tmp_path}/days").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.order_date, r.daily_revenue) for r in got] == [(dt.date(2024, 1, 2), 2.0)]


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "order_items.csv").write_text(
        "order_item_id,product_id,order_id,quantity,unit_price,total_price\n1,20,300,x,1.50,3.00\n")
    row = readers.read_raw_csv(spark, str(tmp_path), ["order_items"])["order_items"].first()
    assert (row.product_id, row.order_id, row.quantity, row.bad_values) == (20, 300, None, 1)


def test_short_series_give_empty_forecasts(spark):
    from tillsight.operators import forecast
    series = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, 2.0)], "ds date, revenue double, x double")
    ahead, errors = forecast.random_forest(series)
    assert ahead.count() == 0 and errors.count() == 0


@pytest.mark.parametrize("name", ["a2_product_performance", "a5_sales_base"])
def test_lines_are_shuffled_in_small_parts(spark, name):
    """A task would hold an eighth of all lines here, if shuffles began with the session's eight parts."""
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = queries()[name](fresh, FOLDER)._jdf.queryExecution().executedPlan().toString()
    parts = [int(n) for n in re.findall(r"hashpartitioning\(.*?, (\d+)\), ENSURE", plan)]
    assert parts and min(parts) >= session.PARTITIONS
    assert fresh.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == session.PART_SIZE
    chosen = spark.newSession()
    chosen.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "50")
    chosen.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    session.tune_sales(chosen)
    assert chosen.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "50"
    assert chosen.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"


def test_columns_are_counted_apart(spark):
    """Several distinct counts in one pass would expand every row once per column."""
    rows = spark.createDataFrame([(1, "a", 0.0), (1, None, -0.0), (2, "a", None), (2, "", float("nan"))],
                                 "k long, t string, x double")
    counted = _column_counts("toy", rows, ["k", "t", "x"])
    assert {tuple(r) for r in counted.collect()} == {
        ("toy", "k", 4, 4, 2), ("toy", "t", 4, 3, 2), ("toy", "x", 4, 3, 2)}
    assert {tuple(r) for r in _column_counts("none", rows.limit(0), ["t"]).collect()} == {("none", "t", 0, 0, 0)}
    written = queries()["snk_csv"](spark, FOLDER)
    assert "Expand" not in written._jdf.queryExecution().executedPlan().toString()
