"""k-means clusters of customers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tillsight.functions.ranks import column_quantiles
from tillsight.session import spread, stage

# The columns that are clustered.
CLUSTER_FEATURES = ("recency", "frequency", "monetary", "avg_order_value",
                    "total_items_purchased", "age")


def fill_with_median(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace nulls by the exact column median; only columns with nulls are ranked."""
    columns = list(columns)
    gaps = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns]).first()
    holed = [c for c in columns if gaps[c] < gaps["_rows"]]
    if not holed:
        return df.withColumns({c: F.col(c).cast("double") for c in columns})
    fill = {c: found[0] for c, found in column_quantiles(df, holed, (0.5,)).items()}
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(fill.get(c))) for c in columns})


def standardised(df: DataFrame, columns: Iterable[str] = CLUSTER_FEATURES, id_col: str = "customer_id") -> DataFrame:
    """(id, features) with median-filled, standardised features, written once.

    Every k-means pass reads this narrow table.
    """
    columns = list(columns)
    filled = fill_with_median(df.select(id_col, *columns), columns)
    packed = VectorAssembler(inputCols=columns, outputCol="raw").transform(filled)
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="features").fit(packed)
    return stage(spread(scaler.transform(packed).select(id_col, "features"), id_col), "features")


@contextmanager
def in_memory(df: DataFrame):
    """Hold ``df`` for several passes; lost blocks are read again from its source."""
    if df.is_cached:
        yield df
        return
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


@dataclass
class Clusters:
    """Centres of one fit and its training cost."""

    centers: np.ndarray
    cost: float = 0.0
    done: bool = False

    def transform(self, features: DataFrame) -> DataFrame:
        """Add ``prediction``: the nearest centre."""
        centers = self.centers

        @F.arrow_udf("int")
        def nearest(x: pa.Array) -> pa.Array:
            return pa.array(_distances(_matrix(x), centers).argmin(axis=1).astype(np.int32))

        return features.withColumn("prediction", nearest(vector_to_array("features")))


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres, without the rows' own squares: enough to compare."""
    return (centers * centers).sum(axis=1) - 2 * (x @ centers.T)


def _sums(rows: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, list]:
    """(cluster, rows, cost, sums of the inputs) by fit: one pass over the rows serves every fit."""
    width = next(iter(centers.values())).shape[1]
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {f: np.zeros((len(c), width + 2)) for f, c in centers.items()}
        for batch in batches:
            x = _matrix(batch.column(0))
            own = (x * x).sum(axis=1)
            wide = np.column_stack((np.ones(len(x)), own, x))
            for f, c in centers.items():
                d = _distances(x, c)
                near = d.argmin(axis=1)
                wide[:, 1] = np.maximum(own + d[np.arange(len(x)), near], 0)
                held[f] += (near == np.arange(len(c))[:, None]).astype(float) @ wide
        fit = np.repeat(np.array(list(held), np.int32), [len(h) for h in held.values()])
        cluster = np.concatenate([np.arange(len(h), dtype=np.int32) for h in held.values()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(fit), pa.array(cluster), *[pa.array(v) for v in np.concatenate(list(held.values())).T.copy()]],
            names=["fit", "cluster", "n", "cost", *names])

    parts = rows.mapInArrow(run, f"fit int, cluster int, n double, cost double, {', '.join(f'{n} double' for n in names)}")
    found: dict[int, list] = {f: [] for f in centers}
    for r in parts.groupBy("fit", "cluster").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *names)]).collect():
        found[r["fit"]].append((r["cluster"], r["n"], r["cost"], np.array(r[4:])))
    return found


def fit_kmeans(features: DataFrame, ks: Sequence[int], seed: int = 42, n_init: int = 10, parallelism: int = 8,
               rounds: int = 300, tolerance: float = 1e-4) -> list[Clusters]:
    """For each k the best of ``n_init`` starts by training cost.

    Spark's k-means|| chooses the centres of each start.  The rounds that follow are those of Spark's ``KMeans`` - a centre
    without rows stays, a fit ends when no centre moves further than ``tolerance`` - but all fits take theirs in the same
    pass, so passes are as many as the longest fit has rounds.
    """
    def start(task: tuple[int, int]) -> Clusters:
        k, number = task
        return Clusters(np.array(KMeans(k=k, seed=seed + number, maxIter=0).fit(features).clusterCenters()))

    tasks = [(k, number) for k in ks for number in range(n_init)]
    with in_memory(features):
        with ThreadPool(min(parallelism, len(tasks))) as pool:
            fits = pool.map(start, tasks, chunksize=1)
        with in_memory(features.select(vector_to_array("features").alias("x"))) as rows:
            for _ in range(rounds):
                running = {i: f.centers for i, f in enumerate(fits) if not f.done}
                if not running:
                    break
                for i, sums in _sums(rows, running).items():
                    fits[i] = _moved(fits[i], sums, tolerance)
    return [min(fits[i:i + n_init], key=lambda f: f.cost) for i in range(0, len(tasks), n_init)]


def _moved(fit: Clusters, sums: list, tolerance: float) -> Clusters:
    """The fit after a round, with the cost of the centres before it."""
    centers = fit.centers.copy()
    for cluster, n, _, total in sums:
        if n > 0:
            centers[cluster] = total / n
    moved = ((centers - fit.centers) ** 2).sum(axis=1)
    return Clusters(centers, sum(cost for _, _, cost, _ in sums), bool((moved <= tolerance * tolerance).all()))


def silhouette(clustered: DataFrame) -> float:
    return ClusteringEvaluator(predictionCol="prediction", featuresCol="features").evaluate(clustered)


def score_k(features: DataFrame, max_k: int = 10, seed: int = 42, n_init: int = 10,
            parallelism: int = 8) -> list[tuple[int, float, float]]:
    """(k, training cost, silhouette) for k = 2..max_k."""
    ks = range(2, max_k + 1)
    with in_memory(features):
        best = fit_kmeans(features, ks, seed, n_init, parallelism)
        return [(k, m.cost, silhouette(m.transform(features))) for k, m in zip(ks, best)]


def choose_k(features: DataFrame, max_k: int = 10, seed: int = 42, n_init: int = 10,
             parallelism: int = 8) -> int:
    """The number of clusters with the best silhouette."""
    return max(score_k(features, max_k, seed, n_init, parallelism), key=lambda r: r[2])[0]


def cluster_customers(df: DataFrame, k: int | None = None, max_k: int = 10, seed: int = 42,
                      n_init: int = 10, parallelism: int = 8) -> tuple[DataFrame, float]:
    """Add ``kmeans_cluster``; also returns the silhouette."""
    features = standardised(df)
    if k is None:
        k = choose_k(features, max_k, seed, n_init, parallelism)
    found = fit_kmeans(features, [k], seed, n_init, parallelism)[0].transform(features)
    labels = found.select("customer_id", F.col("prediction").alias("kmeans_cluster"))
    return df.join(labels, "customer_id"), silhouette(found)
