"""Hand-worked cases of the easily mistaken rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillsight.functions import ranks, scalars as fn
from tillsight.operators import alerts, churn, clean, forecast, joins, marts, metrics, quality, rfm, series


def d(text):
    return dt.date.fromisoformat(text)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture(scope="module")
def shop(spark):
    orders = spark.createDataFrame(
        [(1, 1, d("2024-01-01"), 100.0, "Completed"), (2, 1, d("2024-01-31"), 50.0, "Delivered"),
         (3, 2, d("2024-01-31"), 20.0, "Completed"), (4, 3, d("2024-01-15"), 70.0, "Cancelled")],
        "order_id long, customer_id long, order_date date, total_amount double, order_status string")
    items = spark.createDataFrame(
        [(1, 10, 1, 60.0), (1, 11, 2, 40.0), (2, 10, 3, 50.0)],
        "order_id long, product_id long, quantity int, total_price double")
    customers = spark.createDataFrame([(1, 30), (2, 40), (3, 50)], "customer_id long, age int")
    return customers, orders, items


def test_customer_summary_counts_amounts_per_line(shop):
    _, orders, items = shop
    fan = marts.customer_summary(orders, items).collect()
    assert len(fan) == 1
    row = fan[0]
    assert (row.total_orders, row.total_spent, row.avg_order_value, row.total_items) == (2, 250.0, 83.33, 6)
    assert row.recency_days == 0
    grain = marts.customer_summary(orders, items, order_grain=True).first()
    assert (grain.total_spent, grain.avg_order_value) == (150.0, 75.0)


def test_segment_base_keeps_orders_without_lines(shop):
    customers, orders, items = shop
    rows = {r.customer_id: r for r in rfm.segment_base(customers, orders, items).collect()}
    assert set(rows) == {1, 2}
    assert (rows[2].total_orders, rows[2].total_spent, rows[2].total_items_purchased) == (1, 20.0, None)


def test_left_join_keeps_unmatched_rows(shop):
    customers, orders, items = shop
    lines = joins.realised_order_lines(customers, orders, items)
    assert sorted(values(lines, "order_id", "quantity"), key=str) == sorted(
        [(1, 1), (1, 2), (2, 3), (3, None)], key=str)


def test_quantile_bins(spark):
    df = spark.range(1, 8).select(F.col("id").cast("double").alias("x"))
    edges = ranks.column_quantiles(df, ["x"], ranks.QUINTILES)["x"]
    scored = df.select("x", ranks.score("x", edges).alias("s")).orderBy("x")
    assert [r.s for r in scored.collect()] == [1, 1, 2, 3, 4, 5, 5]


def test_equal_edges_raise_or_collapse(spark):
    df = spark.createDataFrame([(0.0,)] * 4 + [(1.0,)], "x double")
    edges = ranks.column_quantiles(df, ["x"], ranks.QUINTILES)["x"]
    with pytest.raises(ValueError):
        ranks.check_edges(edges, "x")
    assert len(ranks.check_edges(edges, "x", duplicates="drop")) < 6


def test_risk_bands(spark):
    p = spark.createDataFrame([(0.0,), (0.3,), (0.7,), (1.0,)], "p double")
    assert [r[0] for r in p.select(fn.risk_category("p")).collect()] == [
        None, "Low Risk", "Medium Risk", "High Risk"]
    q = spark.createDataFrame([(0.4,), (0.7,), (0.71,), (0.39,), (None,)], "churn_probability double")
    assert tuple(metrics.churn_band_counts(q).first()) == (1, 2, 1)


def test_segment_names(spark):
    codes = spark.createDataFrame([("555",), ("155",), ("254",), ("333",), ("111",), ("512",)], "c string")
    assert [r[0] for r in codes.select(rfm.segment_of("c")).collect()] == [
        "Champions", "At Risk", "Cannot Lose Them", "Lost", "Lost", "New Customers"]


def test_half_even_rounding(spark):
    x = spark.createDataFrame([(v,) for v in (2.675, 0.125, 0.135, 2.5, 1.005, -0.125)], "x double")
    got = [r[0] for r in x.select(fn.round_half_even("x")).collect()]
    assert got == [2.68, 0.12, 0.14, 2.5, 1.0, -0.12]


def test_clean_customers(spark):
    raw = spark.createDataFrame(
        [("a@b", 30, "2024-01-01"), ("abc", -1, "2024-01-01"), (None, 130, None), ("c@d", 130, None),
         ("e@f", None, None)], "email string, age int, registration_date string")
    counts = {r.check_type: r.error_count for r in
              quality.rule_counts("customers", raw, F.current_date()).collect()}
    assert counts == {"invalid_emails": 2, "invalid_ages": 3}
    assert sorted(values(clean.clean_customers(raw), "email", "age")) == [
        ("a@b", 30), ("c@d", None), ("e@f", None)]


def test_clean_products(spark):
    raw = spark.createDataFrame(
        [(10.0, 4.0, -5), (0.0, 1.0, 3), (-1.0, 1.0, 1), (5.0, 2.0, None), (None, 1.0, 1)],
        "price double, cost double, stock_quantity int")
    got = sorted(values(clean.clean_products(raw), "price", "profit_margin", "stock_quantity"), key=str)
    assert got == sorted([(10.0, 60.0, 0), (0.0, None, 3), (5.0, 60.0, None)], key=str)


def test_clean_orders_drops_the_future(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", 5.0), ("2024-01-07", 5.0), ("2999-01-01", 5.0), ("2024-01-02", -1.0)],
        "order_date string, total_amount double")
    got = sorted(values(clean.clean_orders(raw), "order_date", "order_day_of_week", "order_quarter"))
    assert got == [(d("2024-01-01"), 0, 1), (d("2024-01-07"), 6, 1)]


def test_campaign_durations(spark):
    # First rows of a published campaign list and their durations.
    rows = [(1, "2025-08-07", "2025-10-29", 6384.42, 83), (2, "2024-12-26", "2025-02-03", 43998.46, 39),
            (3, "2025-06-07", "2025-08-20", 49879.36, 74), (4, "2025-07-28", "2025-09-06", 3897.94, 40)]
    raw = spark.createDataFrame([r[:4] for r in rows] + [(5, "2025-01-01", "2025-01-02", -1.0)],
                                "campaign_id long, start_date string, end_date string, budget double")
    got = dict(values(clean.clean_campaigns(raw), "campaign_id", "duration_days"))
    assert got == {r[0]: r[4] for r in rows}


def test_duplicates_treat_nulls_alike(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert quality.duplicate_count(df).first()[0] == 2
    assert df.dropDuplicates().count() == 2


def test_quality_report_covers_all_checks(spark):
    t = {"products": spark.createDataFrame([(1, "x", -1.0, -2), (1, "x", -1.0, -2)],
                                           "product_id int, product_name string, price double, stock_quantity int")}
    got = {r.check_type: (r.status, r.error_count) for r in
           quality.quality_report(t, F.current_date()).collect()}
    assert got["negative_prices"] == ("failed", 2) and got["duplicate_count"] == ("failed", 1)
    assert got["null_count:price"] == ("passed", 0) and got["total_records"][1] == 0


def test_growth_needs_no_adjacent_months(spark):
    frame = lambda rows: spark.createDataFrame(
        [(d(x), v, "Completed") for x, v in rows], "order_date date, total_amount double, order_status string")
    growth = lambda rows: metrics.revenue_growth(frame(rows)).first()[0]
    assert growth([("2024-01-05", 100.0), ("2024-03-05", 150.0)]) == 50.0
    assert growth([("2024-01-05", 100.0)]) == 0.0
    assert growth([("2024-01-05", 0.0), ("2024-02-05", 10.0)]) == 0.0


@pytest.mark.parametrize("revenue, fires", [([100, 100, 60], True), ([100, 100, 62], False),
                                            ([100, 10], False), ([], False)])
def test_revenue_alert(spark, revenue, fires):
    daily = spark.createDataFrame([(d("2024-01-01") + dt.timedelta(i), float(v)) for i, v in enumerate(revenue)],
                                  "order_date date, daily_revenue double")
    assert alerts.revenue_alert(daily).first().is_alert is fires


def test_lifetime_value(spark):
    base = spark.createDataFrame(
        [(1, 2, 75.0, d("2024-01-01"), d("2024-01-31")), (2, 1, 20.0, d("2024-01-31"), d("2024-01-31"))],
        "customer_id long, total_orders long, avg_order_value double, first_order_date date, last_order_date date")
    assert dict(values(rfm.clv(base), "customer_id", "predicted_clv")) == {1: 72.58, 2: 300.0}


def test_churn_signs(spark):
    df = spark.createDataFrame([(90, 1.5, 0.0, 1), (91, 0.2, 0.2, 1), (91, None, None, None)],
                               "days_since_last_order int, return_rate double, cancel_rate double, "
                               "orders_per_month int")
    got = values(churn.churn_labels(df), "is_churned", "high_return_rate", "high_cancel_rate",
                 "low_engagement", "churn_label")
    assert got == [(0, 1, 0, 0, 0), (1, 0, 1, 0, 1), (1, 0, 0, 0, 0)]


def _series(spark, numbers):
    return spark.createDataFrame([(d("2024-01-01") + dt.timedelta(i), float(v)) for i, v in enumerate(numbers)],
                                 "ds date, revenue double")


def test_linear_trend(spark):
    got = forecast.linear_trend(_series(spark, [1, 3, 5]), horizon=2).orderBy("forecast_date")
    assert [round(v, 9) for _, v in values(got, "forecast_date", "predicted_value")] == [7.0, 9.0]
    assert got.first().forecast_date == d("2024-01-04")


def test_moving_average_needs_31_days(spark):
    sales = spark.createDataFrame(
        [(1, d("2024-01-01") + dt.timedelta(i), float(i - 17)) for i in range(31) if i != 5]
        + [(2, d("2024-01-01") + dt.timedelta(i), 5.0) for i in range(30)],
        "product_id long, order_date date, revenue double")
    got = forecast.product_moving_average(sales).collect()
    assert len(got) == 30 and {r.product_id for r in got} == {1}
    assert {r.predicted_revenue for r in got} == {10.0}
    assert min(r.forecast_date for r in got) == d("2024-02-01")


def test_combined_intervals(spark):
    plain = spark.createDataFrame([(d("2024-01-01"), 10.0, "Linear Trend")],
                                  "forecast_date date, predicted_value double, model_type string")
    bounded = spark.createDataFrame([(d("2024-01-01"), 10.0, "ARIMA", 9.0, 11.0)],
                                    "forecast_date date, predicted_value double, model_type string, "
                                    "lower_ci double, upper_ci double")
    pick = ("model_used", "confidence_interval_lower", "confidence_interval_upper", "product_id")
    assert values(forecast.combine(plain, None), *pick) == [("Linear Trend", 8.0, 12.0, 1)]
    assert sorted(values(forecast.combine(bounded, plain), *pick)) == [
        ("ARIMA", 9.0, 11.0, 1), ("Linear Trend", None, None, 1)]


def test_overlay_keeps_old_scores(spark):
    old = spark.createDataFrame([(1, 0.5), (2, 0.6)], "customer_id long, churn_probability double")
    new = spark.createDataFrame([(1, 0.9)], "customer_id long, churn_probability double")
    assert sorted(values(joins.overlay_scores(old, new), "customer_id", "churn_probability")) == [(1, 0.9), (2, 0.6)]


def test_calendar_features(spark):
    df = spark.createDataFrame([(d("2024-01-01"),), (d("2024-01-07"),)], "ds date")
    assert values(series.calendar_features(df), "day_of_week", "is_weekend") == [(0, 0), (6, 1)]


def test_calendar_fill_by_key(spark):
    df = spark.createDataFrame([("a", d("2024-01-01"), 1.0), ("a", d("2024-01-03"), 2.0), ("b", d("2024-01-09"), 3.0)],
                               "k string, ds date, revenue double")
    got = sorted(values(joins.calendar_fill(df, "ds", ["revenue"], keys=["k"]), "k", "ds", "revenue"))
    assert got == [("a", d("2024-01-01"), 1.0), ("a", d("2024-01-02"), 0.0), ("a", d("2024-01-03"), 2.0),
                   ("b", d("2024-01-09"), 3.0)]


def test_decomposition_of_a_pure_cycle(spark):
    cycle = [100 + (i % 30) for i in range(400)]
    got = series.decompose(_series(spark, cycle)).filter("trend is not null").collect()
    assert len(got) == 370
    assert all(abs(r.trend - 114.5) < 1e-9 and abs(r.residual) < 1e-9 for r in got)
    assert all(abs(r.seasonal - (r.position - 14.5)) < 1e-9 for r in got)
    assert series.decompose(_series(spark, cycle[:365])).count() == 0


def test_display_formats(spark):
    df = spark.createDataFrame([(1234567.5, 0.256), (-1234.4, 1.0), (-0.2, 0.0)], "x double, p double")
    assert [r[0] for r in df.select(fn.format_currency("x")).collect()] == ["$1,234,568", "-$1,234", "$0"]
    assert [r[0] for r in df.select(fn.format_percent("p")).collect()] == ["25.6%", "100.0%", "0.0%"]


def test_names_print_missing_parts(spark):
    df = spark.createDataFrame([("Ann", None)], "a string, b string")
    assert df.select(fn.full_name("a", "b")).first()[0] == "Ann None"


def test_unknown_period_means_months(shop):
    _, orders, _ = shop
    assert values(metrics.sales_trends(orders, "yearly"), "date", "revenue", "order_count") == [
        (d("2024-01-01"), 170.0, 3)]


def test_weekly_grid_starts_on_mondays(spark):
    sales = spark.createDataFrame([(d("2024-01-07"), 1, 2.0, 1, 1), (d("2024-01-16"), 2, 4.0, 1, 1)],
                                  "order_date date, quantity_sold long, revenue double, order_count long, "
                                  "unique_customers long")
    got = values(series.time_series(sales, "weekly").orderBy("ds"), "ds", "revenue")
    assert got == [(d("2024-01-01"), 2.0), (d("2024-01-08"), 0.0), (d("2024-01-15"), 4.0)]


def test_row_deltas_read_each_table_once(spark, tmp_path):
    rows = [(1, 5.0, 2.0, 1), (1, 5.0, 2.0, 1), (2, -1.0, 2.0, 1), (3, None, 2.0, 1), (4, 5.0, 2.0, -3)]
    spark.createDataFrame(rows, "product_id long, price double, cost double, stock_quantity int").write.parquet(f"{tmp_path}/p")
    spark.createDataFrame([(1,), (1,), (2,)], "x int").write.parquet(f"{tmp_path}/other")
    raw = {"products": spark.read.parquet(f"{tmp_path}/p"), "other": spark.read.parquet(f"{tmp_path}/other")}
    found = clean.row_deltas(raw)
    assert sorted(values(found, "table_name", "rows_in", "rows_out")) == [("other", 3, 2), ("products", 5, 2)]
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    assert {n: df.count() for n, df in clean.clean(raw).items()} == {"products": 2, "other": 2}
