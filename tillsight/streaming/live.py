"""Live figures over an event stream.

After every micro-batch the newest row of every key is merged into a versioned
table (``sources.versions``).  The table is split into parts that follow from
the keys, such as days, and a batch rewrites only the parts that it touches, so
what is written follows the batch and not what is stored.  A batch that is
retried counts once, and readers meet the state after one batch or the next.

Totals, windows and days are kept without a watermark: an event counts however
late it comes, at the price of one state row per window.  Only
``append_closed_windows`` closes windows by a watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillsight.functions.scalars import flag, last_days, money_sum
from tillsight.operators.alerts import revenue_alert
from tillsight.sources import versions

SALE = "purchase"


def kpi_totals(events: DataFrame) -> DataFrame:
    """Running totals over all events: one state row, summed map-side first."""
    sale = F.col("event_type") == SALE
    return events.groupBy().agg(
        F.count("*").alias("total_events"),
        F.coalesce(F.sum(flag(sale).cast("bigint")), F.lit(0)).alias("total_orders"),
        F.coalesce(money_sum(F.when(sale, F.col("value"))), F.lit(0.0)).alias("total_revenue"))


def trend_windows(events: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Sales per tumbling window; with ``late`` windows are closed by that watermark."""
    watched = events.withWatermark("ts", late) if late and events.isStreaming else events
    return (watched.filter(F.col("event_type") == SALE)
            .groupBy(F.window("ts", width))
            .agg(money_sum("value").alias("revenue"), F.count("*").alias("order_count"))
            .select(F.col("window.start").alias("window_start"), "revenue", "order_count"))


def daily_sales(events: DataFrame) -> DataFrame:
    """Sales per day, as the session's time zone reads the event time."""
    return (events.filter(F.col("event_type") == SALE).groupBy(F.to_date("ts").alias("order_date"))
            .agg(money_sum("value").alias("daily_revenue")))


def _start(df: DataFrame, checkpoint: str, mode: str, each, once: bool) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 minutes")).start()


def by_day(c: str) -> Column:
    """The part of a table that holds a window's or an event's day."""
    return F.date_format(c, "yyyy-MM-dd")


def _store(batch: DataFrame, tag: tuple[str, int], path: str, keys: Sequence[str], part: Column | None) -> None:
    if keys:
        versions.merge(batch, path, keys, F.lit("all") if part is None else part, tag=tag)
    else:
        versions.replace(batch, path, tag=tag)


def write_updates(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), mode: str = "update",
                  once: bool = False, part: Column | None = None) -> StreamingQuery:
    """Keep the newest row of every key; without keys the rows of the last batch.

    ``part`` splits the table; it must follow from the keys.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            _store(held, (checkpoint, batch_id), path, keys, part)
        finally:
            held.unpersist()

    return _start(df, checkpoint, mode, each, once)


def append_closed_windows(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append windows to a file sink once the watermark has passed them."""
    writer = (df.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 minutes")).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every key."""
    if versions.current(spark, path) is None:
        raise FileNotFoundError(f"no batch stored below {path}")
    return versions.read(spark, path)


def watch_revenue(events: DataFrame, path: str, alerts_path: str, checkpoint: str,
                  once: bool = False, days: int = 7) -> StreamingQuery:
    """After every micro-batch, check the last days against their moving average.

    The check reads the stored days, one row each, which are split by month.  A
    batch without changes raises nothing.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            _store(held, (checkpoint, batch_id), path, ["order_date"], F.date_format("order_date", "yyyy-MM"))
            if held.isEmpty():
                return
            recent = last_days(current(held.sparkSession, path), "order_date", None, days)
            fired = revenue_alert(recent).filter("is_alert")
            fired.write.mode("overwrite").parquet(f"{alerts_path}/batch={batch_id}")
        finally:
            held.unpersist()

    return _start(daily_sales(events), checkpoint, "update", each, once)
