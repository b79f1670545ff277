"""Range-partitioned ranks and quantiles agree with numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillsight.functions import ranks
from tillsight.operators import churn, churn_models, rfm

RNG = np.random.default_rng(7)
N = 3000


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows share one value."""
    hot = np.where(RNG.random(N) < 0.34, 5, RNG.integers(0, 40, N))
    pdf = pd.DataFrame({"customer_id": np.arange(N), "n": hot, "x": np.round(RNG.gamma(2, 900, N), 2),
                        "days": RNG.integers(0, 900, N), "g": RNG.choice(["a", "b", "c"], N)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return df.repartition(16), pdf


def test_exact_quantiles(rows):
    df, pdf = rows
    got = ranks.column_quantiles(df, ["x", "n"], ranks.QUINTILES)
    assert np.allclose(got["x"], np.quantile(pdf["x"].dropna(), ranks.QUINTILES), rtol=1e-12)
    assert np.allclose(got["n"], np.quantile(pdf["n"], ranks.QUINTILES), rtol=1e-12)


def test_exact_quantiles_by_group(rows):
    df, pdf = rows
    got = {r.group: r.quantiles for r in ranks.exact_quantiles(df, ["x"], (0, 0.25, 0.5, 1), by="g").collect()}
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g], np.quantile(part["x"].dropna(), (0, 0.25, 0.5, 1)), rtol=1e-12)


def test_quantiles_of_many_groups(spark):
    df = spark.range(9000).select((F.col("id") % 1500).alias("g"), F.col("id").cast("double").alias("x"))
    got = ranks.exact_quantiles(df, ["x"], (0.0, 0.5, 1.0), by="g").collect()
    assert len(got) == 1500
    assert all(r.quantiles == [int(r.group), int(r.group) + 3750.0, int(r.group) + 7500.0] for r in got)


def test_rank_first(rows):
    df, pdf = rows
    got = ranks.rank_first(df, [F.col("n").asc(), F.col("customer_id").asc()], "r")
    got = got.select("customer_id", "r").toPandas().sort_values("customer_id")["r"].to_numpy()
    assert np.array_equal(got, pdf["n"].rank(method="first").astype(int).to_numpy())


def test_rank_within_groups(rows):
    df, pdf = rows
    got = ranks.rank_first(df, [F.col("n").asc(), F.col("customer_id").asc()], "r", by=["g"])
    got = got.select("customer_id", "r").toPandas().sort_values("customer_id")["r"].to_numpy()
    assert np.array_equal(got, pdf.groupby("g")["n"].rank(method="first").astype(int).to_numpy())


def test_quintiles_equal_pandas_qcut(rows):
    df, pdf = rows
    full = df.fillna(1.0, ["x"])
    pdf = pdf.assign(x=pdf["x"].fillna(1.0))
    got = (rfm.quintile_scores(full, "days", "n", "x", duplicates="drop")
           .toPandas().sort_values("customer_id"))
    days = pd.qcut(pdf["days"], 5, labels=[5, 4, 3, 2, 1]).astype(int)
    rank = pd.qcut(pdf["n"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert np.array_equal(got["recency_score"].to_numpy(), days.to_numpy())
    assert np.array_equal(got["frequency_score"].to_numpy(), rank.to_numpy())
    assert set(got["monetary_score"]) <= {1, 2, 3, 4, 5}


def test_auc_by_brute_force(rows, spark):
    _, pdf = rows
    part = pdf.head(400)
    label = (part["days"] + RNG.integers(-300, 300, 400) > 450).astype(int)
    scored = spark.createDataFrame(pd.DataFrame({"label": label, "score": part["n"].astype(float)}))
    pos, neg = part["n"][label == 1].to_numpy(), part["n"][label == 0].to_numpy()
    pairs = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    got = churn_models.exact_auc(scored).first()[0]
    assert abs(got - pairs / (len(pos) * len(neg))) < 1e-12
    assert abs(churn_models.roc_auc(scored.select(
        F.col("label").cast("double"), F.col("score").alias("rawPrediction"))) - got) < 1e-9
    roc = churn_models.roc_points(scored).orderBy("threshold").collect()
    assert (roc[0].fpr, roc[0].tpr) == (1.0, 1.0) and len(roc) == part["n"].nunique()


def test_split_is_stratified(rows):
    df, pdf = rows
    marked = df.select("customer_id", (F.col("n") == 5).cast("int").alias("churn_label"))
    got = churn.stratified_split(marked).toPandas()
    for label, part in got.groupby("churn_label"):
        assert part["is_train"].sum() == int(len(part) * 0.8)
        folds = part.loc[part["is_train"], "fold"].value_counts()
        assert len(folds) == 5 and folds.max() - folds.min() <= 1
    assert got.loc[~got["is_train"], "fold"].isna().all()
