"""Revenue attributed to the campaigns that ran when it was earned.

Orders shrink to revenue by day and campaigns to two rows, the day one begins and the day after it ended.  Along the days
a running sum of these gives the weight of all campaigns then, a day's rate is its revenue for one unit of weight, and a
campaign gets its weight times the rates from its first day to its last: the difference of two prefix sums.  No order
meets a campaign, so neither a long campaign nor a busy day multiplies rows.  All sums are whole numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.scalars import REALISED_STATUSES, cents, is_realised

# Parts of a cent in a rate, and of a dollar in the result: what is lost to whole numbers stays below one part in 10**6
# for weights up to 10**9 over ten thousand days.
RATE, MICRO = 10**15, 10**6


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def _div(a: Column, b: Column) -> Column:
    """Whole division of decimals; the dividend is a multiple, so no digit is rounded."""
    return _whole((a - a % b) / b)


def running_campaigns(campaigns: DataFrame, weight: str | None = None) -> DataFrame:
    """Campaigns with both dates, in order, and a weight above zero: (campaign_id, ..., first, until, _w)."""
    share = F.lit(1).cast("long") if weight is None else cents(weight)
    return (campaigns.withColumns({"_first": F.col("start_date"), "_until": F.date_add("end_date", 1), "_w": share})
            .filter((F.col("_first") < F.col("_until")) & (F.col("_w") > 0)))


def timeline(campaigns: DataFrame, orders: DataFrame, by: Sequence[str] = (), weight: str | None = None,
             statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """One row per day on which revenue was earned or a campaign began or had ended.

    (by, day, cents, running, weight, rate, before): ``running`` campaigns with their ``weight`` on this day, ``rate`` for
    one unit, and the sum of all rates ``before`` it.  A table bounded by the calendar, for each value of ``by``.
    """
    ran = running_campaigns(campaigns, weight)
    zero = F.lit(0).cast("long")
    edges = ran.select(*by, F.explode(F.array(
        F.struct(F.col("_first").alias("day"), F.lit(1).cast("long").alias("n"), F.col("_w").alias("w")),
        F.struct(F.col("_until").alias("day"), F.lit(-1).cast("long").alias("n"), (-F.col("_w")).alias("w")))).alias("e"))
    edges = edges.select(*by, "e.day", zero.alias("cents"), "e.n", "e.w")
    earned = orders.filter(is_realised(statuses=statuses)).select(
        *by, F.col("order_date").alias("day"), cents("total_amount").alias("cents"), zero.alias("n"), zero.alias("w"))
    days = edges.unionByName(earned.filter("day IS NOT NULL")).groupBy(*by, "day").agg(
        F.coalesce(F.sum("cents"), F.lit(0)).alias("cents"), F.sum("n").alias("n"), F.sum(_whole(F.col("w"))).alias("w"))
    along = Window.partitionBy(*by).orderBy("day")
    days = days.withColumns({"running": F.sum("n").over(along), "weight": _whole(F.sum("w").over(along))})
    rate = F.when(F.col("weight") > 0, _div(_whole(F.col("cents")) * F.lit(RATE).cast("decimal(38,0)"), F.col("weight")))
    days = days.withColumn("rate", F.coalesce(rate, F.lit(0).cast("decimal(38,0)")))
    earlier = F.sum("rate").over(along.rowsBetween(Window.unboundedPreceding, -1))
    return days.select(*by, "day", "cents", "running", "weight", "rate",
                       _whole(F.coalesce(earlier, F.lit(0).cast("decimal(38,0)"))).alias("before"))


def campaign_revenue(campaigns: DataFrame, orders: DataFrame, by: Sequence[str] = (), weight: str | None = None,
                     statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Every campaign with ``attributed_revenue``: its share of each day's revenue, equal or by ``weight`` (a money column).

    ``by`` names columns that orders and campaigns must share, such as a segment.  A campaign that ended before it began,
    lacks a date or has no weight gets 0.  Revenue on days without a campaign is attributed to none.
    """
    days = timeline(campaigns, orders, by, weight, statuses)
    out = campaigns.withColumns({"_first": F.col("start_date"), "_until": F.date_add("end_date", 1),
                                 "_w": F.lit(1).cast("long") if weight is None else cents(weight)})
    for edge in ("_first", "_until"):
        at = days.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("day").alias("_day"), F.col("before").alias(f"_b{edge}"))
        same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
        out = out.join(at, [F.col(edge) == F.col("_day"), *same], "left").drop("_day", *[f"_k_{c}" for c in by])
    counts = (F.col("_first") < F.col("_until")) & (F.col("_w") > 0)
    earned = _whole(F.col("_w")) * (F.col("_b_until") - F.col("_b_first"))
    unit = RATE * 100 // MICRO
    micro = _div(_whole(earned + unit // 2), F.lit(unit).cast("decimal(38,0)")).cast("long")
    found = F.coalesce(F.when(counts, micro), F.lit(0).cast("long")) / F.lit(float(MICRO))
    return out.select(*campaigns.columns, found.alias("attributed_revenue"))


def order_shares(orders: DataFrame, campaigns: DataFrame, by: Sequence[str] = (),
                 statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """(order_id, revenue, campaigns, revenue_per_campaign) of each sold order; null where no campaign ran."""
    days = timeline(campaigns, orders, by, None, statuses).select(
        *[F.col(c).alias(f"_k_{c}") for c in by], F.col("day").alias("_day"), "running")
    sold = orders.filter(is_realised(statuses=statuses))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    met = sold.join(days, [F.col("order_date") == F.col("_day"), *same], "left")
    running = F.coalesce("running", F.lit(0))
    return met.select("order_id", F.col("total_amount").alias("revenue"), running.alias("campaigns"),
                      (F.col("total_amount") / F.nullif(running, F.lit(0))).alias("revenue_per_campaign"))


def attributed_roi(found: DataFrame, by: Sequence[str] = ("campaign_type", "target_segment")) -> DataFrame:
    """Budget, attributed revenue and return on the budget of each kind of campaign."""
    budget = F.sum(F.when(F.col("budget") > 0, cents("budget")).otherwise(0)) / 100.0
    earned = F.sum(F.rint(F.col("attributed_revenue") * MICRO).cast("long")) / float(MICRO)
    return found.groupBy(*by).agg(F.count("*").alias("campaigns"), budget.alias("budget"), earned.alias("attributed_revenue")).withColumn(
        "attributed_roi", (F.col("attributed_revenue") - F.col("budget")) / F.nullif(F.col("budget"), F.lit(0.0)))
