"""Threshold alerts."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillsight.functions.scalars import (
    REALISED_STATUSES, AsOf, is_realised, last_days, money_sum)
from tillsight.operators.series import rolling_mean
from tillsight.session import stage

log = logging.getLogger(__name__)


def daily_revenue(orders: DataFrame, as_of: AsOf = None, days: int | None = 7,
                  statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Realised revenue of the last days that have orders; of all days for ``days=None``."""
    recent = orders if days is None else last_days(orders, "order_date", as_of, days)
    return (recent.filter(is_realised(statuses=statuses))
            .groupBy("order_date").agg(money_sum("total_amount").alias("daily_revenue")))


def with_moving_average(daily: DataFrame, size: int = 3) -> DataFrame:
    """Trailing mean over days with orders (a handful of rows)."""
    return daily.withColumn("moving_avg", rolling_mean("daily_revenue", size, order="order_date"))


def revenue_alert(daily: DataFrame, share: float = 0.7, size: int = 3) -> DataFrame:
    """One row: is the latest day below a share of the moving average that includes it?"""
    last = lambda c: F.max_by(c, "order_date").alias(c)
    state = with_moving_average(daily, size).agg(
        F.count("*").alias("days"), F.max("order_date").alias("latest_date"),
        last("daily_revenue"), last("moving_avg"))
    alert = F.coalesce((F.col("days") >= size)
                       & (F.col("daily_revenue") < F.col("moving_avg") * share), F.lit(False))
    text = F.concat(F.lit("Revenue Alert: Daily revenue $"), F.format_number("daily_revenue", 2),
                    F.lit(" is 30% below recent average $"), F.format_number("moving_avg", 2))
    return state.select(F.lit("Revenue Anomaly").alias("alert_type"), "latest_date",
                        F.col("daily_revenue").alias("latest_revenue"), "moving_avg",
                        alert.alias("is_alert"), F.when(alert, text).alias("message"))


def churn_alert(segments: DataFrame, above: float = 0.8, more_than: int = 50) -> DataFrame:
    """One row: are more than ``more_than`` customers above the probability?"""
    counted = segments.filter(F.col("churn_probability") > above).agg(
        F.count("*").alias("high_risk_count"))
    alert = F.col("high_risk_count") > more_than
    text = F.concat(F.lit("Churn Alert: "), F.col("high_risk_count").cast("string"),
                    F.lit(f" customers have >{above:.0%} churn probability"))
    return counted.select(F.lit("High Churn Risk").alias("alert_type"), "high_risk_count",
                          alert.alias("is_alert"), F.when(alert, text).alias("message"))


def run_alerts(orders: DataFrame, segments: DataFrame, as_of: AsOf = None, share: float = 0.7,
               more_than: int = 50) -> DataFrame:
    """(alert_type, message) of every alert that fires."""
    checks = (revenue_alert(daily_revenue(orders, as_of), share),
              churn_alert(segments, more_than=more_than))
    rows = [c.filter("is_alert").select("alert_type", "message") for c in checks]
    return rows[0].unionByName(rows[1])


def emit_alerts(alerts: DataFrame, path: str) -> None:
    """Append fired alerts to a table and log how many of each type there were."""
    fired = stage(alerts.withColumn("raised_at", F.current_timestamp()), "alerts")
    fired.write.mode("append").parquet(path)
    for row in fired.groupBy("alert_type").agg(F.count("*").alias("n")).toLocalIterator():
        log.warning("ALERT [%s]: %d written to %s", row["alert_type"], row["n"], path)
