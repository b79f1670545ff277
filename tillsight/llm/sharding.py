"""Shards of nearly equal size by sampled splitters.

Rows are ordered by a hash of their text, then of their id, so equal texts lie together and even a group that holds a
third of all rows can be cut.  Size-weighted samples of the keys are drawn, their quantiles become range boundaries,
and every row is put into its range by binary search.  Ranges that turn out overfull are sampled again, more densely,
and subdivided.  The number of ranges follows the bytes, so that a task orders ``RANGE_BYTES`` or so; from 16 TB on, where
there are ``MOST_RANGES``, it orders more.  Exact sums of bytes and rows by range, added up over the ranges, give each row
its place in the whole order; the shard follows from the bytes before it.

Shards differ by little more than the largest document.  Equal texts share a shard, unless their group is larger than
1/``WHOLE`` of a shard: such groups are cut where the shard is full.

Defined results: a null text has size 1 and forms a group with other null texts; rows without id are placed like
others; repeated rows are placed each; an empty table gives an empty result.  Other columns are carried along unread;
columns that are already called shard or slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.llm.tables import utf8_size
from tillsight.session import stage, tune

RANGES = 1024  # at least; boundaries that reach the driver: one fewer
MOST_RANGES = 1 << 16
RANGE_BYTES = 256 << 20  # a task orders one range
DRAWS = 32  # samples expected for each range
WHOLE = 256
_LEAST = -(1 << 63)


def _drawn(rows: DataFrame, total: int, draws: int) -> DataFrame:
    """Key samples: each row as often as its share of the bytes asks for, rounded by a hash."""
    luck = F.pmod(F.xxhash64("t", "h", F.lit(draws)), F.lit(1 << 20)) / float(1 << 20)
    times = F.floor(F.col("size") * (draws / max(total, 1)) + luck)
    return rows.select("h", "t", times.alias("times")).filter("times > 0")


def _quantiles(drawn: DataFrame, parts: int) -> list[tuple[int, int]]:
    """Keys at the quantiles of the samples; ``parts`` of them at most."""
    upto = Window.orderBy("h", "t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    step = F.floor(F.sum("times").over(upto) * parts / F.sum("times").over(whole))
    steps = drawn.groupBy("h", "t").agg(F.sum("times").alias("times")).withColumn("step", step)
    firsts = steps.groupBy("step").agg(F.min(F.struct("h", "t")).alias("k"))
    return [(r["k"]["h"], r["k"]["t"]) for r in firsts.filter("step > 0").collect()]


def _snapped(keys: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted boundaries; one that alone cuts a group of equal texts moves to its start."""
    keys = sorted(set(keys))
    often = {}
    for h, _ in keys:
        often[h] = often.get(h, 0) + 1
    return sorted({(h, t if often[h] > 1 else _LEAST) for h, t in keys})


def _range(keys: list[tuple[int, int]]) -> Column:
    """Number of boundaries at or below the row's key, by binary search in constant arrays."""
    if not keys:
        return F.lit(0)
    hs, ts = (F.split(F.lit(",".join(str(k[i]) for k in keys)), ",").cast("array<bigint>") for i in (0, 1))
    jumps = F.lit(",".join(str(1 << i) for i in reversed(range(len(keys).bit_length()))))

    def step(found: Column, jump: Column) -> Column:
        at = found + jump - 1
        h, t = F.get(hs, at), F.get(ts, at)
        below = (h < F.col("h")) | ((h == F.col("h")) & (t <= F.col("t")))
        return F.when(F.coalesce(below, F.lit(False)), found + jump).otherwise(found)

    return F.aggregate(F.split(jumps, ",").cast("array<int>"), F.lit(0), step)


def shards(docs: DataFrame, count: int = 8, id_col: str = "doc_id", text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or the columns ``keep`` of it) with shard (0 to ``count`` - 1) and slot (gapless from 0 in a shard)."""
    tune(docs.sparkSession)
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), utf8_size(docs[text_col]).alias("bytes"),
                       F.xxhash64(docs[text_col]).alias("h"), F.xxhash64(docs[id_col].cast("string")).alias("t"))
    rows = rows.withColumn("size", F.col("bytes") + 1).drop("bytes")
    # Ranges are found on the keys alone, written once; the rows themselves are read again for the last step.
    keys = stage(rows.select("h", "t", "size"), "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return docs.select(*[c for c in keep if c not in ("shard", "slot")],
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).limit(0)

    place = _range(_boundaries(keys, total)).alias("range")
    placed = rows.select("*", place)
    sums = keys.select("size", place).groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range: a table of bounded size.
    offsets = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy("range").orderBy("h", "t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("range", "h")
    order = (placed.withColumn("upto", F.sum("size").over(inside)).withColumn("at", F.count("*").over(inside))
             .withColumn("group_bytes", F.sum("size").over(group)).withColumn("group_upto", F.max("upto").over(group))
             .join(F.broadcast(offsets), "range"))
    cut = F.col("group_bytes") > total / count / WHOLE
    middle = (F.col("bytes_before") + F.when(cut, F.col("upto") - F.col("size") / 2)
              .otherwise(F.col("group_upto") - F.col("group_bytes") / 2))
    shard = F.least(F.floor(middle * count / total), F.lit(count - 1)).cast("int")
    order = stage(order.select("row", shard.alias("shard"), (F.col("rows_before") + F.col("at") - 1).alias("place")),
                  "ordered")
    first = order.groupBy("shard").agg(F.min("place").alias("first"))  # one row for each shard
    kept = [F.col("row").getField(c).alias(c) for c in keep if c not in ("shard", "slot")]
    return order.join(F.broadcast(first), "shard").select(*kept, "shard", (F.col("place") - F.col("first")).alias("slot"))


def _boundaries(rows: DataFrame, total: int) -> list[tuple[int, int]]:
    """Range boundaries from sampled keys; ranges that turn out overfull are subdivided."""
    ranges = min(MOST_RANGES, max(RANGES, total // RANGE_BYTES))
    keys = _quantiles(_drawn(rows, total, ranges * DRAWS), ranges)
    bounds = _snapped(keys)
    full = 4 * total / ranges
    sized = rows.select("h", "t", "size", _range(bounds).alias("range"))
    over = sized.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).filter(
        (F.col("bytes") > full) & (F.col("n") > 1))
    over = [(r["range"], r["bytes"]) for r in over.collect()]  # fewer than ranges / 4
    if not over:
        return bounds
    inside = sized.filter(F.col("range").isin([r for r, _ in over]))
    weight = sum(b for _, b in over)
    parts = min(ranges, -(-weight * ranges // total) * 2)
    return _snapped(keys + _quantiles(_drawn(inside, weight, parts * DRAWS), parts))
