"""Product recommendations from purchases by implicit-feedback factorisation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillsight.functions.ranks import rank_first
from tillsight.functions.scalars import REALISED_STATUSES, is_realised
from tillsight.session import discard, shuffles_dropped, stage

# Numbers in a block of customers and of products, and products that are scored at once.
USERS, ITEMS, STRIP = 2048, 1 << 16, 4096
# Purchases in a block of the factorisation, and those whose factors are multiplied at once.
PURCHASES, SOME = 1_500_000, 1 << 16
# Blocks of products that a scoring task holds.
HELD = 32

# Rows that meet in a block: what is fixed there (kind 0), and what comes from other blocks.
_PACKED = "to int, kind int, source int, a binary, b binary, c binary, d binary"
_FACTORS = "block int, features binary, gram binary"


@dataclass
class Factors:
    """(id, features) of customers and of products."""

    rank: int
    userFactors: DataFrame
    itemFactors: DataFrame


@dataclass
class Recommender:
    """The factors, the numbers that stand for customers and products in them, and who bought what."""

    model: Factors
    customers: DataFrame
    products: DataFrame
    bought: DataFrame


def purchases(orders: DataFrame, items: DataFrame, statuses: Sequence[str] = REALISED_STATUSES) -> DataFrame:
    """(customer_id, product_id, orders): in how many sold orders a customer took a product.

    Lines are reduced to (order, product) and then to (customer, product), both map-side first.
    """
    sold = orders.filter(is_realised(statuses=statuses)).select("order_id", "customer_id")
    lines = items.select("order_id", "product_id").distinct()
    return lines.join(sold, "order_id").groupBy("customer_id", "product_id").agg(F.count("*").alias("orders"))


def _numbers(df: DataFrame, column: str, name: str) -> DataFrame:
    """Ids of any type as 0, 1, ...: the factorisation takes 32-bit numbers."""
    ranked = rank_first(df.select(column).distinct(), [F.col(column)], name)
    return stage(ranked.withColumn(name, (F.col(name) - 1).cast("int")), name)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(c.split() for c in schema.split(", ")))
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], names=list(names))


def _gather(rows: DataFrame, blocks: int) -> DataFrame:
    """Rows of a block in one partition, what is fixed first and then by source."""
    return rows.repartitionById(blocks, F.col("to")).sortWithinPartitions("to", "kind", "source")


def _cells(bought: DataFrame, own: str, other: str, size: int, other_size: int, blocks: int) -> DataFrame:
    """Purchases of each block of ``own`` numbers packed in a row (kind 0), and the ``other`` numbers it needs (kind 1).

    Kind 0 holds how many purchases each number has, the places of the others among those needed, and the orders.  Kind 1
    lies where the others are: ``to`` is their block, ``source`` the block that needs them.
    """
    flat = bought.select((F.col(own) / size).cast("int").alias("to"), F.col(own).alias("own"), F.col(other).alias("other"),
                         F.col("orders").cast("float").alias("orders"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [tuple(c.to_numpy() for c in b.columns) for b in batches if len(b)]
        if not read:
            return
        to, mine, others, orders = (np.concatenate(x) for x in zip(*read))
        for block in np.unique(to):
            at = slice(*np.searchsorted(to, [block, block + 1]))
            needed, places = np.unique(others[at], return_inverse=True)
            counts = np.bincount(mine[at] - block * size).astype(np.int32)
            yield _table([(block, 0, -1, counts.tobytes(), places.astype(np.int32).tobytes(), orders[at].tobytes(), None)], _PACKED)
            where = needed // other_size
            for k in np.unique(where):
                yield _table([(k, 1, block, (needed[where == k] - k * other_size).tobytes(), None, None, None)], _PACKED)

    near = flat.repartitionById(blocks, F.col("to")).sortWithinPartitions("to", "own", "other")
    return stage(near.mapInArrow(pack, _PACKED), f"cells{own}")


def _solved(factors: np.ndarray, counts: np.ndarray, places: np.ndarray, orders: np.ndarray, gram: np.ndarray,
            penalty: float, alpha: float) -> np.ndarray:
    """Factors of the numbers that have ``counts`` purchases each, from those of what they bought (at ``places``).

    Confidence is 1 + ``alpha`` x orders, and the penalty counts once for each purchase.  Numbers with as many purchases
    as each other are solved together.
    """
    rank = factors.shape[1]
    first, out = np.cumsum(counts) - counts, np.zeros((len(counts), rank), np.float32)
    for n in np.unique(counts[counts > 0]):
        alike = np.flatnonzero(counts == n)
        step = max(1, SOME // n)
        for group in (alike[k:k + step] for k in range(0, len(alike), step)):
            a, b, bought = np.tile(gram, (len(group), 1, 1)), np.zeros((len(group), rank)), np.zeros(len(group))
            for at in range(0, n, SOME):
                of = first[group][:, None] + np.arange(at, min(n, at + SOME))
                y, sure = factors[places[of]].astype(np.float64), alpha * np.abs(orders[of]).astype(np.float64)
                liked = orders[of] > 0
                a += (y * sure[..., None]).transpose(0, 2, 1) @ y
                b += (np.where(liked, 1 + sure, 0)[:, None, :] @ y)[:, 0]
                bought += liked.sum(axis=1)
            a += (penalty * bought)[:, None, None] * np.eye(rank)
            out[group] = np.linalg.solve(a, b[..., None])[..., 0]
    return out


def _factor_row(block: int, factors: np.ndarray) -> pa.RecordBatch:
    wide = factors.astype(np.float64)
    return _table([(block, factors.tobytes(), (wide.T @ wide).tobytes())], _FACTORS)


def _half_round(cells: DataFrame, factors: DataFrame, rank: int, blocks: int, penalty: float, alpha: float) -> DataFrame:
    """Factors of one side from those of the other: each block gets the factors it needs, once for each number."""
    gram = sum(np.frombuffer(r.gram).reshape(rank, rank) for r in factors.select("gram").collect())
    none = [F.lit(None).cast("binary").alias(c) for c in "bcd"]
    held = factors.select(F.col("block").alias("to"), F.lit(0).alias("kind"), F.lit(-1).alias("source"), F.col("features").alias("a"), *none)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for to, kind, source, a in zip(*(batch.column(c) for c in range(4))):
                if kind.as_py() == 0:
                    own = np.frombuffer(a.as_buffer(), np.float32).reshape(-1, rank)
                else:
                    some = own[np.frombuffer(a.as_buffer(), np.int32)]
                    yield _table([(source.as_py(), 1, to.as_py(), some.tobytes(), None, None, None)], _PACKED)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cell, found = None, None, []

        def done() -> Iterator[pa.RecordBatch]:
            if block is not None:
                yield _factor_row(block, _solved(np.concatenate(found).reshape(-1, rank), *cell, gram, penalty, alpha))

        for batch in batches:
            for to, kind, a, b, c in zip(*(batch.column(c) for c in (0, 1, 3, 4, 5))):
                if kind.as_py() == 0:
                    yield from done()
                    block, found = to.as_py(), []
                    cell = [np.frombuffer(x.as_buffer(), t) for x, t in ((a, np.int32), (b, np.int32), (c, np.float32))]
                else:
                    found.append(np.frombuffer(a.as_buffer(), np.float32))
        yield from done()

    sent = _gather(held.unionByName(cells.filter("kind = 1")), blocks).mapInArrow(send, _PACKED)
    return stage(_gather(cells.filter("kind = 0").unionByName(sent), blocks).mapInArrow(solve, _FACTORS), "factors")


def _first_factors(customers: int, products: int, size: int, rank: int, seed: int, penalty: float, alpha: float, blocks: int,
                   spark: SparkSession) -> DataFrame:
    """Spark's own random start: it depends on the numbers alone, so one made-up purchase for each is enough."""
    each = spark.range(max(customers, products)).select(
        (F.col("id") % customers).cast("int").alias("_u"), (F.col("id") % products).cast("int").alias("_i"), F.lit(1.0).cast("float").alias("orders"))
    als = ALS(userCol="_u", itemCol="_i", ratingCol="orders", implicitPrefs=True, rank=rank, maxIter=0, regParam=penalty,
              alpha=alpha, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, factors in zip(batch.column(0), batch.column(2)):
                yield _factor_row(block.as_py(), factors.values.to_numpy().reshape(-1, rank))

    return stage(_blocks(als.fit(each).userFactors, size).mapInArrow(pack, _FACTORS), "factors")


def _by_id(factors: DataFrame, size: int, rank: int) -> DataFrame:
    """(id, features), as Spark's models have them."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, features in zip(batch.column(0), batch.column(1)):
                values = np.frombuffer(features.as_buffer(), np.float32)
                ids = np.arange(len(values) // rank, dtype=np.int32) + block.as_py() * size
                listed = pa.ListArray.from_arrays(np.arange(0, len(values) + 1, rank, dtype=np.int32), pa.array(values))
                yield pa.RecordBatch.from_arrays([pa.array(ids), listed], names=["id", "features"])

    return factors.select("block", "features").mapInArrow(unpack, "id int, features array<float>")


def train(found: DataFrame, rank: int = 16, rounds: int = 10, penalty: float = 0.05, alpha: float = 20.0,
          seed: int = 42) -> Recommender:
    """Alternating least squares over blocks of customers and products; more orders mean more confidence.

    The steps are those of Spark's ALS from its random start, and so are the factors but for rounding.  Spark keeps the
    shuffles of all rounds on disk; here each half round is staged, and its shuffle and the factors before it are deleted.
    """
    spark = found.sparkSession
    with shuffles_dropped(spark):
        found = stage(found.filter("customer_id IS NOT NULL AND product_id IS NOT NULL"), "purchases")
        customers, products = _numbers(found, "customer_id", "_u"), _numbers(found, "product_id", "_i")
        bought = stage(found.join(customers, "customer_id").join(products, "product_id").select("_u", "_i", "orders"), "bought")
        discard(found)
        users, items = customers.count(), products.count()
        blocks = max(1, min(users, items, -(-bought.count() // PURCHASES)))
        user_size, item_size = -(-users // blocks), -(-items // blocks)
        of_users = _cells(bought, "_u", "_i", user_size, item_size, blocks)
        of_items = _cells(bought, "_i", "_u", item_size, user_size, blocks)
        start = int(spark.conf.get("spark.sql.shuffle.partitions"))
        by_user, by_item = _first_factors(users, items, user_size, rank, seed, penalty, alpha, start, spark), None
        for _ in range(rounds):
            before, by_item = by_item, _half_round(of_items, by_user, rank, blocks, penalty, alpha)
            if before is not None:
                discard(before)
            before, by_user = by_user, _half_round(of_users, by_item, rank, blocks, penalty, alpha)
            discard(before)
        for cells in (of_users, of_items):
            discard(cells)
    return Recommender(Factors(rank, _by_id(by_user, user_size, rank), _by_id(by_item, item_size, rank)), customers, products, bought)


def _blocks(factors: DataFrame, size: int) -> DataFrame:
    """(block, ids, factors): blocks of ``size`` numbers, factors as one flat list in the order of the ids."""
    listed = factors.groupBy(F.floor(F.col("id") / size).cast("int").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("id", "features"))).alias("l"))
    return listed.select("block", F.col("l.id").alias("ids"), F.flatten("l.features").alias("factors"))


def _best(users: np.ndarray, ids: np.ndarray, items: np.ndarray, had: np.ndarray, top: int,
          kept: tuple[np.ndarray, ...] | None = None) -> tuple[np.ndarray, ...]:
    """(user's place, item, score) of the ``top`` items of each user, the lesser id on a tie.

    ``had`` holds (user's place, item) pairs that are left out; ``kept`` is what other items have given.  Items are looked
    at in strips, those with the longest factors first; of a strip only scores count that reach the lowest score a user has
    kept so far, and users whose factors are too short to reach it with any item of the strip are not scored.
    """
    lowest = np.full(len(users), np.finfo(np.float32).min, np.float32)
    if kept is None:
        kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32))
    last = np.arange(len(kept[0])) - np.searchsorted(kept[0], kept[0]) == top - 1
    lowest[kept[0][last]] = kept[2][last]
    length = np.linalg.norm(items, axis=1)
    order = np.argsort(-length, kind="stable")
    place = np.minimum(np.searchsorted(ids, had[1]), len(ids) - 1)
    known = ids[place] == had[1]
    who, spot = had[0][known], np.argsort(order)[place[known]]
    who, spot = (x[np.argsort(spot, kind="stable")] for x in (who, spot))
    # A little more than the greatest score for an item of length 1, for rounding.
    reach = np.linalg.norm(users, axis=1) * np.float32(1.0001)
    line = np.zeros(len(users), np.int64)
    for at in range(0, len(ids), STRIP):
        live = np.flatnonzero(reach * length[order[at]] >= lowest)
        if not len(live):
            break
        some = order[at:at + STRIP]
        scores = users[live] @ items[some].T
        line[:] = -1
        line[live] = np.arange(len(live))
        own = slice(*np.searchsorted(spot, [at, at + len(some)]))
        scored = line[who[own]] >= 0
        scores[line[who[own][scored]], spot[own][scored] - at] = -np.inf
        if not at and not len(kept[0]) and len(some) > top:
            lowest[live] = np.maximum(lowest[live], np.partition(scores, -top, axis=1)[:, -top])
        row, column = np.divmod(np.flatnonzero(scores >= lowest[live][:, None]), len(some))
        row, item, score = (np.concatenate(x) for x in zip(kept, (live[row], ids[some[column]], scores[row, column])))
        by = np.lexsort((item, -score, row))
        row, item, score = row[by], item[by], score[by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        full = place == top - 1
        lowest[row[full]] = score[full]
        kept = tuple(x[place < top] for x in (row, item, score))
    return kept


def recommend(made: Recommender, top: int = 10) -> DataFrame:
    """(customer_id, place, product_id, score): the ``top`` products that each customer has not bought.

    Every customer is scored with every product, block by block.  What a customer has is left out before the best are
    chosen, and a task keeps the best of a block of customers while it meets the blocks of products, up to ``HELD`` of
    them: for each customer it hands on ``top`` rows, however long the histories are.
    Only customers with nearly everything get fewer than ``top``.
    """
    spark, rank = made.bought.sparkSession, made.model.rank
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*batch.columns):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0].as_py()], pa.int32()), *(pa.array([x.values.to_numpy().tobytes()], pa.binary()) for x in row[1:])],
                    names=batch.schema.names)

    with shuffles_dropped(spark):
        had = made.bought.groupBy(F.floor(F.col("_u") / USERS).cast("int").alias("block")).agg(
            F.collect_list("_u").alias("u"), F.collect_list("_i").alias("i"))
        listed = _blocks(made.model.userFactors, USERS).join(had, "block").select("block", "ids", "factors", "u", "i")
        users = stage(listed.repartition(parts, "block").mapInArrow(
            pack, "block int, ids binary, factors binary, u binary, i binary"), "users").repartition(parts, "block")
        items = stage(_blocks(made.model.itemFactors, ITEMS).mapInArrow(pack, "block int, ids binary, factors binary"), "items").select(
            F.col("ids").alias("item_ids"), F.col("factors").alias("item_factors"))
    held = max(1, -(-items.count() // HELD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, None

        def best() -> Iterator[pa.RecordBatch]:
            if now is not None:
                row, item, score = kept
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row].astype(np.int32)), pa.array(item.astype(np.int32)), pa.array(score)], names=["_u", "_i", "score"])

        for batch in batches:
            for k in range(len(batch)):
                block = batch.column(0)[k].as_py()
                read = lambda c, t=np.int32: np.frombuffer(batch.column(c)[k].as_buffer(), t)
                if block != now:
                    yield from best()
                    now, kept, ids = block, None, read(1)
                    users, u, i = read(2, np.float32).reshape(-1, rank), read(3), read(4)
                    had = np.stack([np.searchsorted(ids, u), i.astype(np.int64)])
                kept = _best(users, read(5).astype(np.int64), read(6, np.float32).reshape(-1, rank), had, top, kept)
        yield from best()

    pairs = users.crossJoin(items.coalesce(held)).select("block", "ids", "factors", "u", "i", "item_ids", "item_factors")
    new = pairs.mapInArrow(run, "_u int, _i int, score float")
    place = F.row_number().over(Window.partitionBy("_u").orderBy(F.col("score").desc(), "_i"))
    best = new.withColumn("place", place).filter(F.col("place") <= top)
    return (best.join(made.customers, "_u").join(made.products, "_i")
            .select("customer_id", "place", "product_id", F.col("score").cast("double").alias("score")))
