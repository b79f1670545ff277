"""Top-n and calendar joins, predicates and projections, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.catalog.base import (
    REALISED, churn, even, labelled, msum, query, rounded, scores)
from tillsight.functions import scalars as fn
from tillsight.operators import churn as churn_ops, forecast, joins, series
from tillsight.sources.star import Star

_TODAY = "(SELECT d FROM r_today)"


def _sales(t: Star) -> DataFrame:
    return series.sales_base(t.orders, t.order_items, t.products)


@query("j7_join_isin_topn", f"""
    WITH t AS (SELECT product_id, {msum('revenue')} AS r FROM r_sales_base GROUP BY 1
               ORDER BY r DESC, product_id LIMIT 10)
    SELECT product_id, order_date, quantity_sold, revenue FROM r_sales_base
    WHERE product_id IN (SELECT product_id FROM t)""")
def j7_join(t: Star) -> DataFrame:
    sales = _sales(t).select("product_id", "order_date", "quantity_sold", "revenue")
    return joins.restrict_to(sales, forecast.top_by_revenue(sales, 10), "product_id")


@query("j8_join_calendar_fill", "SELECT * FROM r_daily")
def j8_join(t: Star) -> DataFrame:
    return series.time_series(_sales(t), "daily")


# -- predicates and projections ----------------------------------------------


@query("p1_realised_filter", f"SELECT order_id, order_status, total_amount FROM r_orders WHERE {REALISED}")
def p1(t: Star) -> DataFrame:
    return t.orders.filter(fn.is_realised()).select("order_id", "order_status", "total_amount")


@query("p2_relative_date_filter", f"""
    SELECT 'days 7' AS span, COUNT(*) AS n FROM r_orders WHERE order_date >= {_TODAY} - 7
    UNION ALL SELECT 'days 30', COUNT(*) FROM r_orders WHERE order_date >= {_TODAY} - 30
    UNION ALL SELECT 'days 90', COUNT(*) FROM r_orders WHERE order_date >= {_TODAY} - 90
    UNION ALL SELECT 'days 84', COUNT(*) FROM r_orders WHERE order_date >= {_TODAY} - 84
    UNION ALL SELECT 'months 2', COUNT(*) FROM r_orders WHERE order_date >= {_TODAY} - INTERVAL 2 MONTH
    UNION ALL SELECT 'months 12', COUNT(*) FROM r_orders WHERE order_date >= {_TODAY} - INTERVAL 12 MONTH""")
def p2(t: Star) -> DataFrame:
    """Six spans counted in one scan."""
    day, today = F.col("order_date"), fn.latest(t.orders, "order_date")
    spans = [("days", 7), ("days", 30), ("days", 90), ("days", 84), ("months", 2), ("months", 12)]
    since = lambda unit, n: F.date_sub("today", n) if unit == "days" else F.add_months("today", -n)
    rows = t.orders.select("order_date", today.alias("today"))
    counted = rows.agg(*[F.sum((day >= since(u, n)).cast("bigint")).alias(f"{u} {n}") for u, n in spans])
    cells = [F.struct(F.lit(f"{u} {n}").alias("span"), F.coalesce(f"{u} {n}", F.lit(0)).alias("n")) for u, n in spans]
    return counted.select(F.inline(F.array(*cells)))


def _category_trend(t: Star) -> DataFrame:
    """Linear forecasts of each category's daily revenue."""
    daily = series.time_series(_sales(t), "daily", keys=["category"])
    return forecast.linear_trend(daily, keys=["category"])


CATEGORY_TREND = f"""
    WITH s AS (SELECT category, order_date AS ds, {msum('revenue')} AS revenue FROM r_sales_base GROUP BY 1, 2),
    g AS (SELECT category, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
          FROM s GROUP BY 1),
    f AS (SELECT category, ds, coalesce(revenue, 0) AS y,
                 row_number() OVER (PARTITION BY category ORDER BY ds) - 1 AS x
          FROM g LEFT JOIN s USING (category, ds)),
    l AS (SELECT category, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, COUNT(*) AS n, max(ds) AS last
          FROM f GROUP BY 1),
    p AS (SELECT category, CAST(last + CAST(h AS INTEGER) AS DATE) AS forecast_date, a + b * (n + h - 1) AS v
          FROM l, (SELECT unnest(generate_series(1, 30)) AS h))"""


@query("p3_forecast_horizon_filter", f"""{CATEGORY_TREND}
    SELECT category, forecast_date, {even('v', 4)} AS predicted_value FROM p
    WHERE forecast_date <= {_TODAY} + 14""")
def p3(t: Star) -> DataFrame:
    ahead = _category_trend(t).select("category", "forecast_date", "predicted_value")
    near = F.col("forecast_date") <= F.date_add(fn.latest(t.orders, "order_date"), 14)
    return rounded(ahead.filter(near), 4, "predicted_value")


@query("p4_having", f"""
    SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders FROM r_orders WHERE {REALISED}
    GROUP BY 1 HAVING COUNT(DISTINCT order_id) > 5""")
def p4(t: Star) -> DataFrame:
    return (t.orders.filter(fn.is_realised()).groupBy("customer_id")
            .agg(F.count_distinct("order_id").alias("total_orders")).filter("total_orders > 5"))


@query("p5_not_null_filter", """
    SELECT c.customer_id, s.churn_probability FROM r_customers c LEFT JOIN r_scores s USING (customer_id)
    WHERE s.churn_probability IS NOT NULL""")
def p5(t: Star) -> DataFrame:
    return (t.customers.join(scores(t), "customer_id", "left")
            .filter(F.col("churn_probability").isNotNull()).select("customer_id", "churn_probability"))


@query("p6_risk_category", """
    SELECT customer_id, CASE WHEN churn_probability > 0 AND churn_probability <= 0.3 THEN 'Low Risk'
             WHEN churn_probability > 0.3 AND churn_probability <= 0.7 THEN 'Medium Risk'
             WHEN churn_probability > 0.7 AND churn_probability <= 1 THEN 'High Risk' END AS category
    FROM r_scores""")
def p6(t: Star) -> DataFrame:
    return scores(t).select("customer_id", fn.risk_category("churn_probability").alias("category"))


@query("p7_risk_band", """
    SELECT customer_id, CASE WHEN churn_probability > 0.7 THEN 'high_risk'
             WHEN churn_probability BETWEEN 0.4 AND 0.7 THEN 'medium_risk'
             WHEN churn_probability < 0.4 THEN 'low_risk' END AS band
    FROM r_scores""")
def p7(t: Star) -> DataFrame:
    return scores(t).select("customer_id", fn.risk_band("churn_probability").alias("band"))


@query("p8_risk_class", """
    SELECT customer_id, CASE WHEN churn_probability > 0.8 THEN 'risk-high'
             WHEN churn_probability > 0.6 THEN 'risk-medium' ELSE 'risk-low' END AS risk_class
    FROM r_scores""")
def p8(t: Star) -> DataFrame:
    return scores(t).select("customer_id", fn.risk_class("churn_probability").alias("risk_class"))


@query("p9_alert_threshold", """
    SELECT customer_id, churn_probability, churn_probability > 0.8 AS alerting
    FROM r_scores WHERE churn_probability > 0.7""")
def p9(t: Star) -> DataFrame:
    p = F.col("churn_probability")
    return scores(t).filter(p > 0.7).select("customer_id", "churn_probability", (p > 0.8).alias("alerting"))


@query("p10_churn_flags", """
    SELECT customer_id, is_churned, high_return_rate, high_cancel_rate, low_engagement,
           churn_risk_score, churn_label FROM r_churn_labels""")
def p10(t: Star) -> DataFrame:
    return churn_ops.churn_labels(churn(t)).select(
        "customer_id", "is_churned", "high_return_rate", "high_cancel_rate", "low_engagement",
        "churn_risk_score", "churn_label")


@query("p11_rfm_label", "SELECT customer_id, rfm_score, rfm_segment FROM r_rfm")
def p11(t: Star) -> DataFrame:
    return labelled(t).select("customer_id", "rfm_score", "rfm_segment")


@query("p12_derived_rates", """
    SELECT customer_id, calculated_aov, orders_per_month, return_rate, cancel_rate FROM r_churn_base""")
def p12(t: Star) -> DataFrame:
    return churn(t).select("customer_id", "calculated_aov", "orders_per_month", "return_rate", "cancel_rate")


@query("p13_select_rename", """
    SELECT product_id AS id, product_name AS name, brand AS maker FROM r_products""")
def p13(t: Star) -> DataFrame:
    return t.products.select(F.col("product_id").alias("id"), F.col("product_name").alias("name"),
                             F.col("brand").alias("maker"))


@query("p14_string_building", """
    SELECT customer_id, first_name || ' ' || last_name AS name,
           CAST(age AS VARCHAR) || gender AS code FROM r_customers""")
def p14(t: Star) -> DataFrame:
    return t.customers.select("customer_id", fn.full_name("first_name", "last_name").alias("name"),
                              F.concat(F.col("age").cast("string"), "gender").alias("code"))


@query("p15_default_fallback", f"""
    SELECT customer_id, coalesce(churn_probability, 0) AS churn_probability,
           coalesce(strftime(registration_date, '%Y-%m-%d'), 'N/A') AS registered
    FROM r_registered LEFT JOIN r_scores USING (customer_id)""")
def p15(t: Star) -> DataFrame:
    return t.registered.join(scores(t), "customer_id", "left").select(
        "customer_id", F.coalesce("churn_probability", F.lit(0.0)).alias("churn_probability"),
        F.coalesce(fn.iso_date("registration_date"), F.lit("N/A")).alias("registered"))


@query("p16_display_formatting", f"""
    SELECT customer_id, '$' || format('{{:,}}', CAST(round({msum('total_amount')}) AS BIGINT)) AS spent,
           format('{{:,}}', SUM(order_id)::BIGINT) AS number,
           format('{{:.1f}}%', round(CAST(COUNT(*) FILTER (NOT {REALISED}) AS DOUBLE) / COUNT(*) * 100, 1)) AS risk
    FROM r_orders GROUP BY 1""")
def p16(t: Star) -> DataFrame:
    """Amounts, counts and shares as they are printed."""
    spent = t.orders.groupBy("customer_id").agg(
        fn.money_sum("total_amount").alias("spent"), F.sum("order_id").alias("number"))
    return spent.join(scores(t), "customer_id").select(
        "customer_id", fn.format_currency("spent").alias("spent"), fn.format_count("number").alias("number"),
        fn.format_percent("churn_probability").alias("risk"))


# -- sorts, limits and set operations ----------------------------------------


@query("s1_order_by", f"""
    SELECT order_date, {msum('total_amount')} AS revenue FROM r_orders GROUP BY 1
    ORDER BY revenue DESC, order_date""")
def s1(t: Star) -> DataFrame:
    return (t.orders.groupBy("order_date").agg(fn.money_sum("total_amount").alias("revenue"))
            .orderBy(F.col("revenue").desc_nulls_first(), "order_date"))


@query("s2_top_k", """
    SELECT order_id, total_amount FROM r_orders ORDER BY total_amount DESC, order_id LIMIT 50""")
def s2(t: Star) -> DataFrame:
    return (t.orders.select("order_id", "total_amount")
            .orderBy(F.col("total_amount").desc_nulls_first(), "order_id").limit(50))


@query("s3_head_last_row", """
    SELECT customer_id, max_by(order_id, (order_date, order_id)) AS last_order_id,
           max_by(total_amount, (order_date, order_id)) AS last_amount
    FROM r_orders GROUP BY 1""")
def s3(t: Star) -> DataFrame:
    newest = F.struct("order_date", "order_id")
    return t.orders.groupBy("customer_id").agg(
        F.max_by("order_id", newest).alias("last_order_id"),
        F.max_by("total_amount", newest).alias("last_amount"))


@query("s4_union_all", f"""
    SELECT order_date AS ds, {msum('total_amount')} AS amount, COUNT(*) AS n FROM r_orders GROUP BY 1
    UNION ALL SELECT registration_date, NULL, COUNT(*) FROM r_registered
              WHERE registration_date IS NOT NULL GROUP BY 1""")
def s4(t: Star) -> DataFrame:
    sold = t.orders.groupBy(F.col("order_date").alias("ds")).agg(
        fn.money_sum("total_amount").alias("amount"), F.count("*").alias("n"))
    joined = (t.registered.filter(F.col("registration_date").isNotNull())
              .groupBy(F.col("registration_date").alias("ds")).agg(F.count("*").alias("n")))
    return sold.unionByName(joined, allowMissingColumns=True)


@query("s5_distinct", "SELECT DISTINCT customer_id, payment_method, order_status FROM r_orders")
def s5(t: Star) -> DataFrame:
    return t.orders.select("customer_id", "payment_method", "order_status").dropDuplicates()
