"""Profitability, campaigns, anomalies, stock, journeys, tests and elasticities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tillsight.functions.scalars import REALISED_STATUSES, cents, is_realised


def profitability(orders: DataFrame, items: DataFrame, products: DataFrame, by: str = "product_id",
                  statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Revenue, cost, profit and margin (% of revenue) by product or category.

    Lines are totalled by product before product attributes are joined.
    """
    sold = orders.filter(is_realised(statuses=statuses)).select("order_id")
    totals = (items.select("order_id", "product_id", "quantity", "total_price").join(sold, "order_id")
              .groupBy("product_id").agg(F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
                                         F.sum(cents("total_price")).alias("cents")))
    priced = totals.join(products.select("product_id", "category", F.coalesce(cents("cost"), F.lit(0)).alias("unit")),
                         "product_id")
    cost = F.sum(F.col("quantity") * F.col("unit"))
    summed = priced.groupBy(by).agg(F.sum("cents").alias("r"), cost.alias("c"))
    return summed.select(by, (F.col("r") / 100.0).alias("revenue"), (F.col("c") / 100.0).alias("cost"),
                         ((F.col("r") - F.col("c")) / 100.0).alias("profit"),
                         ((F.col("r") - F.col("c")) / F.nullif(F.col("r"), F.lit(0)) * 100).alias("margin"))


def campaign_roi(campaigns: DataFrame, by: Sequence[str] = ("campaign_type", "target_segment")) -> DataFrame:
    """Budget, and return and conversion weighted by budget, of each kind of campaign."""
    paid = campaigns.filter(F.col("budget") > 0).withColumn("_b", cents("budget"))
    weighted = lambda c: F.sum(F.col("_b").cast("double") * F.col(c)) / F.sum(F.when(F.col(c).isNotNull(), F.col("_b")))
    return paid.groupBy(*by).agg(F.count("*").alias("campaigns"), (F.sum("_b") / 100.0).alias("budget"),
                                 weighted("roi").alias("roi"), weighted("conversion_rate").alias("conversion_rate"))


def revenue_anomalies(daily: DataFrame, size: int = 30, beyond: float = 2.0) -> DataFrame:
    """Z-score of each day against the ``size`` days with orders before it.

    ``daily`` holds (order_date, daily_revenue), one row per day.  A day whose
    window is not full, or does not vary, has no score.
    """
    before = Window.orderBy("order_date").rowsBetween(-size, -1)
    mean, spread = F.avg("daily_revenue").over(before), F.stddev_samp("daily_revenue").over(before)
    full = F.count("daily_revenue").over(before) == size
    z = F.when(full & (spread > 0), (F.col("daily_revenue") - mean) / spread)
    return daily.select("order_date", "daily_revenue", z.alias("z_score")).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > beyond, F.lit(False)))


def reorder_points(orders: DataFrame, items: DataFrame, products: DataFrame, lead_days: int = 7, service: float = 1.65,
                   statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """Mean and deviation of daily demand, safety stock and reorder point of each product.

    Days without sales between a product's first and last one count as 0; only
    their number is needed.
    """
    sold = orders.filter(is_realised(statuses=statuses)).select("order_id", "order_date")
    daily = (items.select("order_id", "product_id", "quantity").join(sold, "order_id")
             .groupBy("product_id", "order_date").agg(F.sum(F.col("quantity").cast("bigint")).alias("q")))
    sums = daily.groupBy("product_id").agg(
        F.sum("q").alias("s"), F.sum(F.col("q") * F.col("q")).alias("ss"),
        (F.datediff(F.max("order_date"), F.min("order_date")) + 1).alias("days"))
    mean = F.col("s") / F.col("days")
    spread = F.when(F.col("days") > 1, F.sqrt(F.greatest(
        F.lit(0.0), (F.col("ss") - F.col("s") * mean) / (F.col("days") - 1)))).otherwise(F.lit(0.0))
    out = sums.select("product_id", F.col("days").cast("bigint").alias("days"), mean.alias("daily_demand"),
                      spread.alias("demand_deviation"))
    out = out.withColumn("safety_stock", service * F.sqrt(F.lit(float(lead_days))) * F.col("demand_deviation"))
    out = out.withColumn("reorder_point", F.col("daily_demand") * lead_days + F.col("safety_stock"))
    stock = products.select("product_id", "stock_quantity")
    return out.join(stock, "product_id").withColumn(
        "reorder", F.coalesce(F.col("stock_quantity") <= F.col("reorder_point"), F.lit(False)))


def journeys(events: DataFrame, steps: Sequence[str] = ("view", "click", "purchase"), bucket: str = "hour") -> DataFrame:
    """(place, step, users): users who did the steps in this order, up to each step.

    A user's events are folded by bucket of time into what they make of each
    number of steps done before: an array with one entry per number.  The
    arrays of a user are then applied in the order of time.  One scan; a user
    with very many events is spread over buckets, and meets one task with an
    array for each of them only.
    """
    if len(set(steps)) != len(steps):
        raise ValueError("a step may occur once")
    n = len(steps)
    place = F.coalesce(*[F.when(F.col("event_type") == s, i) for i, s in enumerate(steps)])
    seen = (events.filter(F.col("event_type").isin(*steps) & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
            .select("user_id", F.date_trunc(bucket, "ts").alias("bucket"), F.struct("ts", place.alias("step")).alias("e"))
            .groupBy("user_id", "bucket").agg(F.sort_array(F.collect_set("e")).alias("events")))
    # Events of one time count in the order of the steps.
    onward = lambda done, e: F.transform(done, lambda d: F.when(d == e["step"], d + 1).otherwise(d))
    made = F.aggregate("events", F.sequence(F.lit(0), F.lit(n)), onward)
    folded = (seen.select("user_id", F.struct("bucket", made.alias("made")).alias("b")).groupBy("user_id")
              .agg(F.sort_array(F.collect_list("b")).alias("b")))
    done = folded.select(F.aggregate("b", F.lit(0), lambda d, b: F.get(b["made"], d)).alias("done"))
    counts = done.agg(*[F.count_if(F.col("done") > i).alias(f"n{i}") for i in range(n)])
    rows = [F.struct(F.lit(i + 1).alias("place"), F.lit(s).alias("step"), F.col(f"n{i}").alias("users")) for i, s in enumerate(steps)]
    return counts.select(F.inline(F.array(*rows)))


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("correlation"))


def welch_test(df: DataFrame, group: str, value: str, first: str, second: str) -> DataFrame:
    """Welch's t and its degrees of freedom for the means of two groups, one row."""
    x = F.col(value).cast("double")
    of = lambda name: F.when(F.col(group) == name, x)
    m = df.agg(*[f(of(g)).alias(f"{n}{i}") for i, g in ((1, first), (2, second))
                 for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))])
    share = lambda i: F.col(f"v{i}") / F.col(f"n{i}")
    both = share(1) + share(2)
    return m.select(((F.col("m1") - F.col("m2")) / F.sqrt(both)).alias("t"),
                    (both * both / (share(1) * share(1) / (F.col("n1") - 1)
                                    + share(2) * share(2) / (F.col("n2") - 1))).alias("degrees_of_freedom"))


def price_elasticity(items: DataFrame, least: int = 10) -> DataFrame:
    """Slope of log quantity over log price of each product, over its lines; null below ``least`` lines."""
    lines = items.filter((F.col("quantity") > 0) & (F.col("unit_price") > 0)).select(
        "product_id", F.log(F.col("quantity").cast("double")).alias("q"), F.log(F.col("unit_price").cast("double")).alias("p"))
    return lines.groupBy("product_id").agg(
        F.count("*").alias("lines"), F.when(F.count("*") >= least, F.regr_slope("q", "p")).alias("elasticity"))
