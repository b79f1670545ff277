"""Ranks, running totals and exact quantiles that do not need one big task.

Rows are range-partitioned on the full sort key, written once with their partition number, and totals per partition -
one row for each - are turned into offsets.  The path is the same for every size.  Callers include a unique column in
the sort key, so a hot value is spread over many partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.functions.scalars import to_col
from tillsight.session import stage

# A partition of a ranking holds about this many rows at most.
PART_ROWS = 250_000

# Quintile probabilities as numpy's linspace(0, 1, 6) gives them.
QUINTILES = (0.0, 0.2, 0.4, 0.6000000000000001, 0.8, 1.0)


def _range_partitioned(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-df.count() // PART_ROWS))
    placed = df.repartitionByRange(parts, *order)
    return stage(placed.withColumn("_part", F.spark_partition_id()), "ranges")


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, str],
                   by: Sequence[str] = ()) -> DataFrame:
    """Add running sums of integer columns in the given order.

    ``totals`` maps each new column to the column it sums.  ``by`` names
    grouping columns; sums restart for each group.  ``df`` is read three times
    (count, range sample, rows), so callers stage what is costly to compute.
    """
    order = list(order)
    placed = _range_partitioned(df, [F.col(c).asc() for c in by] + order)
    sums = placed.groupBy("_part", *by).agg(*[F.sum(s).alias(f"_o_{n}") for n, s in totals.items()])
    # One row per partition and group: a bounded table.
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *by, *[
        F.coalesce(F.sum(f"_o_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals])
    within = (Window.partitionBy("_part", *by).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = placed.select("*", *[F.sum(s).over(within).alias(f"_l_{n}") for n, s in totals.items()])
    if not by:
        # One row per partition; with groups the size is left to Catalyst's check.
        offsets = F.broadcast(offsets)
    same = [local[c].eqNullSafe(offsets[c]) for c in ("_part", *by)]
    return (local.join(offsets, same)
            .select(*[local[c] for c in df.columns], *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in totals]))


def rank_first(df: DataFrame, order: Sequence[Column], name: str, by: Sequence[str] = ()) -> DataFrame:
    """1-based position in the given order (restarting per ``by`` group)."""
    ranked = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, {name: "_one"}, by=by)
    return ranked.drop("_one")


def _positions(n: int, probs: Sequence[float]) -> list[tuple[int, int, float]]:
    spots = []
    for q in probs:
        at = (n - 1) * q
        low = math.floor(at)
        spots.append((low, min(math.ceil(at), n - 1), at - low))
    return spots


def rank_edges(n: int, probs: Sequence[float] = QUINTILES) -> list[float]:
    """Quantile edges of the ranks 1..n."""
    return [(low + 1) + (high - low) * part for low, high, part in _positions(n, probs)]


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    by: str | None = None) -> DataFrame:
    """(group, column, quantiles): linearly interpolated, one array entry per probability, nulls left out.

    ``group`` is null when ``by`` is not given.  Columns of nulls only, and
    groups with nulls only, have no row.
    """
    group = F.lit(None).cast("string") if by is None else F.col(by).cast("string")
    # (group, column, value) -> count; copies of a value collapse map-side.
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in columns]))
    counts = (df.select(group.alias("group"), cells.alias("_x")).select("group", "_x.column", "_x._v")
              .filter(F.col("_v").isNotNull())
              .groupBy("group", "column", "_v").agg(F.count("*").alias("_n")))
    counts = stage(counts, "counts")
    up_to = running_totals(counts, [F.col("_v").asc()], {"_upto": "_n"}, by=["group", "column"])
    sizes = counts.groupBy(F.col("group").alias("_g"), F.col("column").alias("_c")).agg(F.sum("_n").alias("_all"))
    known = up_to.join(sizes, F.col("group").eqNullSafe(F.col("_g")) & (F.col("column") == F.col("_c")))
    holds = lambda at: (F.col("_upto") - F.col("_n") <= at) & (at < F.col("_upto"))
    spots = []
    for i, q in enumerate(probs):
        at = (F.col("_all") - 1) * F.lit(float(q))
        low, high = F.floor(at), F.least(F.ceil(at), F.col("_all") - 1)
        spots.append(F.when(holds(low) | holds(high), F.struct(
            F.lit(i).alias("i"), (at - low).alias("part"), F.when(holds(low), F.col("_v")).alias("low"),
            F.when(holds(high), F.col("_v")).alias("high"))))
    # A value is kept for the probabilities it serves: two values for each at most.
    hit = known.select("group", "column", F.explode(F.array_compact(F.array(*spots))).alias("s"))
    ends = hit.groupBy("group", "column", "s.i").agg(
        F.max("s.low").alias("low"), F.max("s.high").alias("high"), F.max("s.part").alias("part"))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    listed = ends.groupBy("group", "column").agg(F.sort_array(F.collect_list(F.struct("i", value.alias("q")))).alias("_q"))
    return listed.select("group", "column", F.transform("_q", lambda x: x["q"]).alias("quantiles"))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """The quantiles of whole columns: one row for each column reaches the driver."""
    return {r["column"]: list(r["quantiles"]) for r in exact_quantiles(df, columns, probs).collect()}


def check_edges(edges: Sequence[float], name: str, duplicates: str = "raise") -> list[float]:
    """Quantile edges must rise; equal ones raise or, on request, collapse."""
    unique = sorted(set(edges))
    if len(unique) != len(edges):
        if duplicates != "drop":
            raise ValueError(f"quantile edges of {name} are not unique: {list(edges)}")
        return unique
    return list(edges)


def score(c: str | Column, edges: Sequence[float], descending: bool = False) -> Column:
    """Bin number 1..k of ``c``; bins are closed on the right."""
    value = to_col(c).cast("double")
    inner = list(edges)[1:-1]
    number = F.lit(1)
    for edge in inner:
        number = number + F.when(value > F.lit(float(edge)), 1).otherwise(0)
    if descending:
        number = F.lit(len(inner) + 2) - number
    return F.when(value.isNotNull(), number).cast("int")
