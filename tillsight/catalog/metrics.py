"""Dashboard and report aggregates, growth windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.catalog.base import (
    REALISED, big, churn, even, labelled, mavg, msum, query, rounded, scores, segments)
from tillsight.functions.scalars import latest, risk_category
from tillsight.operators import churn as churn_ops, forecast, metrics, rfm, series
from tillsight.catalog.relational import CATEGORY_TREND, _category_trend, _sales
from tillsight.session import stage
from tillsight.sources.star import Star

_TODAY = "(SELECT d FROM r_today)"
_MONTH = "CAST(date_trunc('month', order_date) AS DATE)"


def _growth(months: str, value: str) -> str:
    """Change between the two latest months of a (month, value) query."""
    return f"""coalesce((SELECT (cur - prev) / NULLIF(prev, 0) * 100 FROM
        (SELECT CAST({value} AS DOUBLE) AS cur, CAST(lag({value}) OVER (ORDER BY month) AS DOUBLE) AS prev, month
         FROM (SELECT * FROM ({months}) ORDER BY month DESC LIMIT 2)) ORDER BY month DESC LIMIT 1), 0)"""


_REVENUE_MONTHS = (f"SELECT {_MONTH} AS month, {msum('total_amount')} AS revenue FROM r_orders "
                   f"WHERE {REALISED} GROUP BY 1")
_NEW_CUSTOMERS = (f"SELECT CAST(date_trunc('month', registration_date) AS DATE) AS month, COUNT(*) AS n "
                  f"FROM r_registered WHERE registration_date >= {{today}} - INTERVAL 2 MONTH GROUP BY 1")
# A day on which two whole months of registrations lie behind.
_BUSY_DAY = "1995-05-20"


@query("w1_revenue_growth", f"SELECT {_growth(_REVENUE_MONTHS, 'revenue')} AS growth_rate")
def w1(t: Star) -> DataFrame:
    return metrics.revenue_growth(t.orders)


@query("w2_customer_growth", f"""
    SELECT {_growth(_NEW_CUSTOMERS.format(today=f"DATE '{_BUSY_DAY}'"), 'n')} AS growth_rate""")
def w2(t: Star) -> DataFrame:
    return metrics.customer_growth(t.registered, F.lit(_BUSY_DAY).cast("date"))


# -- bases -------------------------------------------------------------------


@query("a4_segment_base", "SELECT * FROM r_segment_base")
def a4(t: Star) -> DataFrame:
    return rfm.segment_base(t.customers, t.orders, t.order_items)


@query("a4_segment_base_order_grain", f"""
    SELECT c.*  EXCLUDE (city, gender), g.* EXCLUDE (customer_id) FROM r_customers c JOIN
      (SELECT o.customer_id, COUNT(*) AS total_orders, {msum('o.total_amount')} AS total_spent,
              {mavg('o.total_amount')} AS avg_order_value, MIN(o.order_date) AS first_order_date,
              MAX(o.order_date) AS last_order_date, {big('SUM(i.q)')} AS total_items_purchased
       FROM r_orders o LEFT JOIN (SELECT order_id, SUM(quantity) AS q FROM r_items GROUP BY 1) i
            USING (order_id) WHERE o.{REALISED} GROUP BY 1) g ON c.customer_id = g.customer_id""")
def a4_order_grain(t: Star) -> DataFrame:
    return rfm.segment_base(t.customers, t.orders, t.order_items, order_grain=True)


@query("a5_sales_base", "SELECT * FROM r_sales_base")
def a5(t: Star) -> DataFrame:
    return _sales(t)


@query("a6_churn_base", "SELECT * FROM r_churn_base")
def a6(t: Star) -> DataFrame:
    return churn(t)


# -- dashboard ---------------------------------------------------------------


@query("a7_kpis", f"""
    SELECT {msum('total_amount')} AS total_revenue,
           (SELECT COUNT(DISTINCT customer_id) FROM r_customers) AS total_customers,
           COUNT(*) AS total_orders, {mavg('total_amount')} AS avg_order_value,
           {_growth(_REVENUE_MONTHS, 'revenue')} AS monthly_growth_rate
    FROM r_orders WHERE {REALISED}""")
def a7(t: Star) -> DataFrame:
    return metrics.kpis(t.orders, t.customers)


def _trend_sql(unit: str, span: str) -> str:
    return f"""SELECT CAST(date_trunc('{unit}', order_date) AS DATE) AS date,
                      {msum('total_amount')} AS revenue, COUNT(*) AS order_count
               FROM r_orders WHERE {REALISED} AND order_date >= {_TODAY} - INTERVAL {span} GROUP BY 1"""


@query("a8_sales_trends", f"""
    SELECT 'daily' AS period, * FROM ({_trend_sql('day', '30 DAY')})
    UNION ALL SELECT 'weekly', * FROM ({_trend_sql('week', '84 DAY')})
    UNION ALL SELECT 'monthly', * FROM ({_trend_sql('month', '12 MONTH')})""")
def a8(t: Star) -> DataFrame:
    parts = [metrics.sales_trends(t.orders, p).withColumn("period", F.lit(p))
             for p in ("daily", "weekly", "monthly")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("a8b_daily_sales_90", _trend_sql("day", "90 DAY"))
def a8b(t: Star) -> DataFrame:
    return metrics.sales_trends(t.orders, "daily", lookback=90)


def _ranking_sql(where: str = "", limit: str = "") -> str:
    return f"""SELECT p.product_id, p.product_name, p.category, p.brand,
                      {big('SUM(i.quantity)')} AS total_sold, {msum('i.total_price')} AS total_revenue,
                      COUNT(DISTINCT i.order_id) AS unique_orders, {mavg('i.unit_price')} AS avg_price
               FROM r_products p JOIN r_items i ON p.product_id = i.product_id
                    JOIN r_orders o ON i.order_id = o.order_id
               WHERE o.{REALISED} {where} GROUP BY ALL
               ORDER BY total_revenue DESC, p.product_id {limit}"""


@query("a9_product_perf_topn", _ranking_sql(limit="LIMIT 10"))
def a9(t: Star) -> DataFrame:
    return metrics.product_ranking(t.orders, t.order_items, t.products, limit=10)


@query("a10_product_perf_all", f"SELECT * EXCLUDE (unique_orders) FROM ({_ranking_sql()})")
def a10(t: Star) -> DataFrame:
    return metrics.product_ranking(t.orders, t.order_items, t.products).drop("unique_orders")


@query("a11_segment_rollup", f"""
    SELECT segment_name, COUNT(*) AS customer_count, {mavg('clv_prediction')} AS avg_clv,
           {even('AVG(churn_probability)', 6)} AS avg_churn_risk
    FROM r_segments GROUP BY 1""")
def a11(t: Star) -> DataFrame:
    return rounded(metrics.segment_rollup(segments(t)), 6, "avg_churn_risk")


@query("a12_forecast_rollup", f"""{CATEGORY_TREND}
    SELECT forecast_date, 'Linear Trend' AS model_used, {even('SUM(v)', 3)} AS predicted_revenue,
           {even('AVG(v * 0.8)', 3)} AS lower_bound, {even('AVG(v * 1.2)', 3)} AS upper_bound
    FROM p WHERE forecast_date <= {_TODAY} + 30 GROUP BY 1""")
def a12(t: Star) -> DataFrame:
    stored = forecast.combine(_category_trend(t).drop("category"))
    ahead = metrics.forecast_rollup(stored, latest(t.orders, "order_date"), 30)
    return rounded(ahead, 3, "predicted_revenue", "lower_bound", "upper_bound")


@query("a13_high_risk_customers", f"""
    SELECT c.customer_id, c.email, c.first_name || ' ' || c.last_name AS name, s.churn_probability,
           coalesce(s.clv_prediction, 0) AS clv_prediction, s.segment_name AS segment,
           MAX(o.order_date) AS last_order_date, coalesce({msum('o.total_amount')}, 0) AS total_spent
    FROM r_customers c JOIN r_segments s ON c.customer_id = s.customer_id
         LEFT JOIN r_orders o ON c.customer_id = o.customer_id
    WHERE s.churn_probability > 0.7
    GROUP BY ALL ORDER BY churn_probability DESC, clv_prediction DESC, c.customer_id LIMIT 20""")
def a13(t: Star) -> DataFrame:
    return metrics.high_risk_customers(t.customers, segments(t), t.orders)


_REVENUE_30 = (f"SELECT coalesce({msum('total_amount')}, 0) AS revenue FROM r_orders WHERE {REALISED} "
               f"AND order_date >= {_TODAY} - 30")


@query("a14_revenue_30d", _REVENUE_30)
def a14(t: Star) -> DataFrame:
    return metrics.recent_revenue(t.orders)


_TOP_30 = f"""SELECT product_id, product_name, total_revenue AS revenue
              FROM ({_ranking_sql(f'AND o.order_date >= {_TODAY} - 30', 'LIMIT 5')})"""


@query("a15_top_products_30d", _TOP_30)
def a15(t: Star) -> DataFrame:
    return metrics.top_products(t.orders, t.order_items, t.products)


_BANDS = """SELECT COUNT(CASE WHEN churn_probability > 0.7 THEN 1 END) AS high_risk,
                   COUNT(CASE WHEN churn_probability BETWEEN 0.4 AND 0.7 THEN 1 END) AS medium_risk,
                   COUNT(CASE WHEN churn_probability < 0.4 THEN 1 END) AS low_risk
            FROM r_segments WHERE churn_probability IS NOT NULL"""


@query("a16_churn_band_counts", _BANDS)
def a16(t: Star) -> DataFrame:
    return metrics.churn_band_counts(segments(t))


_ADVICE = "; ".join(metrics.STANDING_ADVICE)


@query("a17_exec_summary", f"""
    SELECT ({_REVENUE_30}) AS monthly_revenue,
           {_growth(_NEW_CUSTOMERS.format(today=_TODAY), 'n')} AS customer_growth,
           (SELECT string_agg(product_id || ' ' || product_name || ' ' || CAST(CAST(revenue AS DECIMAL(18,2)) AS VARCHAR),
                              '; ' ORDER BY revenue DESC, product_id) FROM ({_TOP_30})) AS top_products,
           b.*, '{_ADVICE}' AS recommendations
    FROM ({_BANDS}) b""")
def a17(t: Star) -> DataFrame:
    """The summary row, with its lists printed as text."""
    row = metrics.exec_summary(t.orders, t.order_items, t.products, t.registered, segments(t))
    line = lambda p: F.concat_ws(" ", p["product_id"].cast("string"), p["product_name"],
                                 p["revenue"].cast("decimal(18,2)").cast("string"))
    return (row.withColumn("top_products", F.array_join(F.transform("top_products", line), "; "))
            .withColumn("recommendations", F.array_join("recommendations", "; ")))


@query("a18_rfm_profile", f"""
    SELECT rfm_segment, COUNT(customer_id) AS customer_count, {even('AVG(recency)')} AS avg_recency,
           {even('AVG(frequency)')} AS avg_frequency, {even(mavg('monetary'))} AS avg_monetary,
           {even('AVG(avg_order_value)')} AS avg_order_value, {even('AVG(age)')} AS avg_age
    FROM r_rfm GROUP BY 1""")
def a18(t: Star) -> DataFrame:
    return rfm.segment_profile(labelled(t), "rfm_segment")


@query("a19_churn_insights", f"""
    WITH s AS (SELECT * FROM r_churn_labels JOIN r_scores USING (customer_id)),
    f AS (SELECT COUNT(*) FILTER (churn_probability > 0.7 AND churn_probability <= 1) AS high_risk_count,
                 coalesce(CAST(SUM(CAST(total_spent AS DECIMAL(18,2)))
                               FILTER (churn_probability > 0.7 AND churn_probability <= 1) AS DOUBLE), 0)
                 AS high_risk_revenue_at_stake,
                 {even('AVG(days_since_last_order) FILTER (churn_label = 1)', 6)}
                      AS avg_days_since_last_order_churned,
                 {even('AVG(days_since_last_order) FILTER (churn_label = 0)', 6)}
                      AS avg_days_since_last_order_active,
                 {even('AVG(total_orders) FILTER (churn_label = 1)', 6)} AS avg_orders_churned,
                 {even('AVG(total_orders) FILTER (churn_label = 0)', 6)} AS avg_orders_active FROM s)
    SELECT *, concat_ws('; ',
        CASE WHEN high_risk_count > 0
             THEN 'Immediate attention needed for ' || high_risk_count || ' high-risk customers' END,
        CASE WHEN high_risk_count > 0
             THEN 'Potential revenue loss: $' || format('{{:,.2f}}', high_risk_revenue_at_stake) END,
        CASE WHEN avg_days_since_last_order_churned > 60
             THEN 'Implement re-engagement campaigns for customers inactive >60 days' END,
        CASE WHEN avg_orders_churned < 3
             THEN 'Focus on increasing purchase frequency for new customers' END) AS recommendations
    FROM f""")
def a19(t: Star) -> DataFrame:
    labels = churn_ops.churn_labels(churn(t)).join(scores(t), "customer_id")
    found = churn_ops.churn_insights(
        labels.withColumn("churn_risk_category", risk_category("churn_probability")))
    return rounded(found, 6, "avg_days_since_last_order_churned", "avg_days_since_last_order_active",
                   "avg_orders_churned", "avg_orders_active").withColumn(
        "recommendations", F.array_join("recommendations", "; "))


@query("a20_revenue_by_product_rank", f"""
    SELECT product_id, {msum('revenue')} AS revenue FROM r_sales_base GROUP BY 1
    ORDER BY revenue DESC, product_id LIMIT 10""")
def a20(t: Star) -> DataFrame:
    return forecast.top_by_revenue(_sales(t), 10)


def _bucket_sql(level: str, unit: str, step: str) -> str:
    return f"""
      SELECT '{level}' AS level, g.ds, coalesce(q, 0) AS quantity_sold, coalesce(r, 0) AS revenue,
             coalesce(o, 0) AS order_count, coalesce(u, 0) AS unique_customers
      FROM (SELECT CAST(unnest(generate_series(
                     CAST(date_trunc('{unit}', min(order_date)) AS DATE),
                     CAST(date_trunc('{unit}', max(order_date)) AS DATE), INTERVAL {step})) AS DATE) AS ds
            FROM r_sales_base) g
      LEFT JOIN (SELECT CAST(date_trunc('{unit}', order_date) AS DATE) AS ds,
                        {big('SUM(quantity_sold)')} AS q, {msum('revenue')} AS r,
                        {big('SUM(order_count)')} AS o, {big('SUM(unique_customers)')} AS u
                 FROM r_sales_base GROUP BY 1) t ON g.ds = t.ds"""


@query("a21_ts_bucket", " UNION ALL ".join([
    _bucket_sql("daily", "day", "1 DAY"), _bucket_sql("weekly", "week", "7 DAY"),
    _bucket_sql("monthly", "month", "1 MONTH")]))
def a21(t: Star) -> DataFrame:
    # Weeks and months add up the staged days.
    days = series.time_series(_sales(t), "daily", fill=False).withColumnRenamed("ds", "order_date")
    days = stage(days, "days")
    parts = [series.time_series(days, p).withColumn("level", F.lit(p))
             for p in ("daily", "weekly", "monthly")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("a22_value_counts", """
    SELECT order_status AS value, COUNT(*) AS count, 'order_status' AS of FROM r_orders GROUP BY 1
    UNION ALL SELECT rfm_segment, COUNT(*), 'rfm_segment' FROM r_rfm GROUP BY 1
    UNION ALL SELECT CAST(churn_label AS VARCHAR), COUNT(*), 'churn_label' FROM r_churn_labels GROUP BY 1""")
def a22(t: Star) -> DataFrame:
    sources = {"order_status": t.orders, "rfm_segment": labelled(t),
               "churn_label": churn_ops.churn_labels(churn(t))}
    out = None
    for column, df in sources.items():
        counts = metrics.value_counts(df, column).select(
            F.col(column).cast("string").alias("value"), "count", F.lit(column).alias("of"))
        out = counts if out is None else out.unionByName(counts)
    return out


def _histogram_sql(table: str, column: str, of: str) -> str:
    return f"""
      SELECT '{of}' AS of, b.bin, e.lo + (e.hi - e.lo) / 30 * (b.bin - 1) AS bin_start,
             coalesce(c.n, 0) AS count
      FROM (SELECT unnest(generate_series(1, 30)) AS bin) b,
           (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {table}) e
      LEFT JOIN (SELECT least(floor(({column} - lo) / (hi - lo) * 30) + 1, 30) AS bin, COUNT(*) AS n
                 FROM {table}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) GROUP BY 1) c
           ON c.bin = b.bin"""


@query("a23_histogram", f"""{_histogram_sql('r_daily', 'revenue', 'revenue')}
    UNION ALL {_histogram_sql('r_scores', 'churn_probability', 'churn_probability')}""")
def a23(t: Star) -> DataFrame:
    daily = series.time_series(_sales(t), "daily")
    parts = [metrics.histogram(df, c).withColumn("of", F.lit(c))
             for df, c in ((daily, "revenue"), (scores(t), "churn_probability"))]
    return parts[0].unionByName(parts[1])


@query("a24_box_stats", f"""
    SELECT rfm_segment, q[1] AS min, {even('q[2]', 4)} AS q1, {even('q[3]', 4)} AS median,
           {even('q[4]', 4)} AS q3, q[5] AS max
    FROM (SELECT rfm_segment, quantile_cont(predicted_clv, [0, 0.25, 0.5, 0.75, 1]) AS q
          FROM r_clv GROUP BY 1)""")
def a24(t: Star) -> DataFrame:
    return rounded(metrics.box_stats(rfm.clv(labelled(t)), "rfm_segment", "predicted_clv"),
                   4, "q1", "median", "q3")
