"""Alerts and live figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.catalog.base import REALISED, msum, query, scores
from tillsight.operators import alerts
from tillsight.session import scratch_path
from tillsight.sources.star import Star
from tillsight.streaming import live

def _week_sql(share: float = 0.7) -> str:
    return f"""
    d AS (SELECT order_date, {msum('total_amount')} AS r FROM r_orders
          WHERE {REALISED} AND order_date >= (SELECT d FROM r_today) - 7 GROUP BY 1),
    m AS (SELECT *, CASE WHEN COUNT(*) OVER w = 3 THEN
                 CAST(SUM(CAST(r AS DECIMAL(18,2))) OVER w AS DOUBLE) / 3 END AS a
          FROM d WINDOW w AS (ORDER BY order_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
    l AS (SELECT max(order_date) AS latest_date, max_by(r, order_date) AS latest_revenue,
                 max_by(a, order_date) AS moving_avg, COUNT(*) AS days FROM m),
    v AS (SELECT 'Revenue Anomaly' AS alert_type, latest_date, latest_revenue, moving_avg,
                 coalesce(days >= 3 AND latest_revenue < moving_avg * CAST({share} AS DOUBLE), FALSE) AS is_alert
          FROM l),
    rev AS (SELECT *, CASE WHEN is_alert THEN 'Revenue Alert: Daily revenue $' || format('{{:,.2f}}', latest_revenue)
                 || ' is 30% below recent average $' || format('{{:,.2f}}', moving_avg) END AS message FROM v)"""


@query("al_revenue_anomaly", f"WITH {_week_sql()} SELECT * FROM rev")
def al_revenue_anomaly(t: Star) -> DataFrame:
    return alerts.revenue_alert(alerts.daily_revenue(t.orders))


def _churn_sql(above: float, more_than: int) -> str:
    return f"""
    chn AS (SELECT 'High Churn Risk' AS alert_type, COUNT(*) AS high_risk_count, COUNT(*) > {more_than} AS is_alert,
                 CASE WHEN COUNT(*) > {more_than}
                      THEN 'Churn Alert: ' || COUNT(*) || ' customers have >{above:.0%} churn probability' END AS message
          FROM r_scores WHERE churn_probability > {above})"""


@query("al_churn", f"WITH {_churn_sql(0.8, 50)} SELECT * FROM chn")
def al_churn(t: Star) -> DataFrame:
    return alerts.churn_alert(scores(t))


_FIRED = """SELECT alert_type, message FROM rev WHERE is_alert
            UNION ALL SELECT alert_type, message FROM chn WHERE is_alert"""


@query("al_emit", f"WITH {_week_sql()}, {_churn_sql(0.3, 50)} {_FIRED}")
def al_emit(t: Star) -> DataFrame:
    """Fired alerts appended to a table; a low bar makes the churn alert fire."""
    path = scratch_path(t.spark, "alerts")
    checks = (alerts.revenue_alert(alerts.daily_revenue(t.orders)),
              alerts.churn_alert(scores(t), above=0.3))
    for check in checks:
        alerts.emit_alerts(check.filter("is_alert").select("alert_type", "message"), path)
    return t.spark.read.parquet(path).select("alert_type", "message")


@query("al_run", f"WITH {_week_sql(2.0)}, {_churn_sql(0.8, 5)} {_FIRED}")
def al_run(t: Star) -> DataFrame:
    """Both checks, with bounds that they exceed."""
    return alerts.run_alerts(t.orders, scores(t), share=2.0, more_than=5)


@query("st_live_kpis", f"""
    SELECT COUNT(*) AS total_events, COUNT(*) FILTER (event_type = 'purchase') AS total_orders,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE) AS total_revenue
    FROM events""")
def st_live_kpis(t: Star) -> DataFrame:
    path = scratch_path(t.spark, "live_kpis")
    totals = live.kpi_totals(t.event_stream())
    live.write_updates(totals, f"{path}/rows", f"{path}/state", once=True).awaitTermination()
    return live.current(t.spark, f"{path}/rows")


@query("st_live_trend", f"""
    SELECT date_trunc('hour', ts) AS window_start, {msum('value')} AS revenue, COUNT(*) AS order_count
    FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def st_live_trend(t: Star) -> DataFrame:
    path = scratch_path(t.spark, "live_trend")
    windows = live.trend_windows(t.event_stream(), "1 hour")
    live.write_updates(windows, f"{path}/rows", f"{path}/state", ["window_start"], once=True,
                       part=live.by_day("window_start")).awaitTermination()
    found = live.current(t.spark, f"{path}/rows")
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("st_closed_windows", f"""
    WITH w AS (SELECT CAST(ts AS DATE) AS day, {msum('value')} AS revenue, COUNT(*) AS order_count
               FROM events WHERE event_type = 'purchase' GROUP BY 1)
    SELECT * FROM w WHERE day + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def st_closed_windows(t: Star) -> DataFrame:
    """Daily windows the watermark has passed, appended to files."""
    path = scratch_path(t.spark, "closed")
    windows = live.trend_windows(t.event_stream(), "1 day", late="1 hour")
    live.append_closed_windows(windows, f"{path}/rows", f"{path}/state", once=True).awaitTermination()
    return t.spark.read.parquet(f"{path}/rows").select(
        F.to_date("window_start").alias("day"), "revenue", "order_count")


@query("st_revenue_watch", f"""
    SELECT CAST(ts AS DATE) AS order_date, {msum('value')} AS daily_revenue
    FROM events WHERE event_type = 'purchase' GROUP BY 1""")
def st_revenue_watch(t: Star) -> DataFrame:
    """Daily revenue kept by the stream that checks it after every batch."""
    path = scratch_path(t.spark, "watch")
    live.watch_revenue(t.event_stream(), f"{path}/days", f"{path}/alerts", f"{path}/state",
                       once=True).awaitTermination()
    return live.current(t.spark, f"{path}/days")
