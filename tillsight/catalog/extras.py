"""Analyses that go beyond the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillsight.catalog.base import REALISED, even, msum, query, rounded
from tillsight.operators import alerts, extras
from tillsight.sources.star import Star


def _profit(by: str) -> str:
    return f"""
        SELECT {by}, revenue, cost, {even('revenue - cost', 4)} AS profit,
               {even('(revenue - cost) / nullif(revenue, 0) * 100', 4)} AS margin
        FROM (SELECT p.{by}, {msum('i.total_price')} AS revenue, {msum('i.quantity * coalesce(p.cost, 0)')} AS cost
              FROM r_items i JOIN r_orders o ON i.order_id = o.order_id JOIN r_products p ON i.product_id = p.product_id
              WHERE o.{REALISED} GROUP BY 1)"""


@query("ex_profitability", _profit("product_id"))
def ex_profitability(t: Star) -> DataFrame:
    return rounded(extras.profitability(t.orders, t.order_items, t.products), 4, "profit", "margin")


@query("ex_profitability_by_category", _profit("category"))
def ex_profitability_by_category(t: Star) -> DataFrame:
    return rounded(extras.profitability(t.orders, t.order_items, t.products, "category"), 4, "profit", "margin")


@query("ex_campaign_roi", f"""
    SELECT campaign_type, target_segment, COUNT(*) AS campaigns, {msum('budget')} AS budget,
           {even('SUM(budget * roi) / SUM(budget)', 8)} AS roi,
           {even('SUM(budget * conversion_rate) / SUM(budget)', 8)} AS conversion_rate
    FROM r_campaigns WHERE budget > 0 GROUP BY 1, 2""")
def ex_campaign_roi(t: Star) -> DataFrame:
    return rounded(extras.campaign_roi(t.campaigns), 8, "roi", "conversion_rate")


@query("ex_anomaly", f"""
    WITH d AS (SELECT order_date, {msum('total_amount')} AS daily_revenue FROM r_orders WHERE {REALISED} GROUP BY 1),
    z AS (SELECT *, CASE WHEN COUNT(*) OVER w = 30 THEN
                 (daily_revenue - AVG(daily_revenue) OVER w) / stddev_samp(daily_revenue) OVER w END AS z
          FROM d WINDOW w AS (ORDER BY order_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    SELECT order_date, daily_revenue, {even('z', 5)} AS z_score, coalesce(abs(z) > 2, FALSE) AS is_anomaly FROM z""")
def ex_anomaly(t: Star) -> DataFrame:
    return rounded(extras.revenue_anomalies(alerts.daily_revenue(t.orders, days=None)), 5, "z_score")


@query("ex_inventory", f"""
    WITH d AS (SELECT i.product_id, o.order_date, SUM(i.quantity) AS q FROM r_items i JOIN r_orders o ON i.order_id = o.order_id
               WHERE o.{REALISED} GROUP BY 1, 2),
    g AS (SELECT product_id, unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS day FROM d GROUP BY 1),
    s AS (SELECT g.product_id, COUNT(*) AS days, AVG(coalesce(q, 0)) AS m, coalesce(stddev_samp(coalesce(q, 0)), 0) AS v
          FROM g LEFT JOIN d ON g.product_id = d.product_id AND g.day = d.order_date GROUP BY 1)
    SELECT s.product_id, days, {even('m', 6)} AS daily_demand, {even('v', 6)} AS demand_deviation,
           {even('1.65 * sqrt(7) * v', 5)} AS safety_stock, {even('m * 7 + 1.65 * sqrt(7) * v', 5)} AS reorder_point,
           p.stock_quantity, p.stock_quantity <= m * 7 + 1.65 * sqrt(7) * v AS reorder
    FROM s JOIN r_products p ON s.product_id = p.product_id""")
def ex_inventory(t: Star) -> DataFrame:
    found = extras.reorder_points(t.orders, t.order_items, t.products)
    return rounded(rounded(found, 6, "daily_demand", "demand_deviation"), 5, "safety_stock", "reorder_point")


@query("ex_journey", """
    WITH a AS (SELECT user_id, min(ts) AS at FROM events WHERE event_type = 'view' GROUP BY 1),
    b AS (SELECT user_id, min(ts) AS at FROM events JOIN a USING (user_id) WHERE event_type = 'click' AND ts >= a.at GROUP BY 1),
    c AS (SELECT user_id, min(ts) AS at FROM events JOIN b USING (user_id) WHERE event_type = 'purchase' AND ts >= b.at GROUP BY 1)
    SELECT CAST(1 AS INTEGER) AS place, 'view' AS step, COUNT(*) AS users FROM a
    UNION ALL SELECT 2, 'click', COUNT(*) FROM b UNION ALL SELECT 3, 'purchase', COUNT(*) FROM c""")
def ex_journey(t: Star) -> DataFrame:
    return extras.journeys(t.events())


@query("ex_stats", f"""
    WITH g AS (SELECT avg(total_amount) FILTER (order_status = 'Completed') AS m1,
                      var_samp(total_amount) FILTER (order_status = 'Completed') AS v1,
                      COUNT(total_amount) FILTER (order_status = 'Completed') AS n1,
                      avg(total_amount) FILTER (order_status = 'Delivered') AS m2,
                      var_samp(total_amount) FILTER (order_status = 'Delivered') AS v2,
                      COUNT(total_amount) FILTER (order_status = 'Delivered') AS n2,
                      corr(total_amount, discount_amount) AS r FROM r_orders)
    SELECT {even('r', 8)} AS correlation, {even('(m1 - m2) / sqrt(v1 / n1 + v2 / n2)', 6)} AS t,
           {even('pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1))', 3)}
           AS degrees_of_freedom FROM g""")
def ex_stats(t: Star) -> DataFrame:
    test = extras.welch_test(t.orders, "order_status", "total_amount", "Completed", "Delivered")
    r = extras.correlation(t.orders, "total_amount", "discount_amount").scalar()
    return rounded(rounded(rounded(test.withColumn("correlation", r), 8, "correlation"), 6, "t"), 3, "degrees_of_freedom")


@query("ex_price_elasticity", f"""
    SELECT product_id, COUNT(*) AS lines, CASE WHEN COUNT(*) >= 10 THEN
           {even('regr_slope(ln(CAST(quantity AS DOUBLE)), ln(CAST(unit_price AS DOUBLE)))', 5)} END AS elasticity
    FROM r_items WHERE quantity > 0 AND unit_price > 0 GROUP BY 1""")
def ex_price_elasticity(t: Star) -> DataFrame:
    return rounded(extras.price_elasticity(t.order_items), 5, "elasticity")
