"""Churn classifiers, their quality and scoring."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tillsight.functions.ranks import running_totals
from tillsight.functions.scalars import risk_category
from tillsight.operators.churn import FEATURES, stratified_split
from tillsight.session import spread, stage

RANDOM_FOREST, GRADIENT_BOOSTING, LOGISTIC = (
    "Random Forest", "Gradient Boosting", "Logistic Regression")


def estimators(train_rows: int, seed: int = 42, trees: int = 100, max_depth: int = 30,
               rounds: int = 100) -> dict[str, Estimator]:
    """The three classifiers.

    Trees of the forest grow to Spark's limit of 30 levels; each row's node is
    kept between levels, so that a level costs the same at any depth and the
    trees are those found without it.  Boosting uses depth 3 and rate .1; the
    logistic penalty is 1/n, a unit penalty on the summed loss.
    """
    return {
        RANDOM_FOREST: RandomForestClassifier(numTrees=trees, maxDepth=max_depth, seed=seed, cacheNodeIds=True),
        GRADIENT_BOOSTING: GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.1, seed=seed),
        LOGISTIC: LogisticRegression(maxIter=1000, regParam=1.0 / max(train_rows, 1),
                                     standardization=False)}


@dataclass
class TrainingData:
    """Staged (customer_id, label, features, is_train, fold) rows and the scaler."""

    rows: DataFrame
    train_rows: int
    scaler: StandardScalerModel

    @property
    def train(self) -> DataFrame:
        return self.rows.filter("is_train")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter("not is_train")

    def view(self, df: DataFrame, name: str) -> DataFrame:
        """Features as the named model sees them: scaled for logistic regression."""
        if name != LOGISTIC:
            return df
        return self.scaler.transform(df).drop("features").withColumnRenamed("scaled", "features")


def training_data(matrix: DataFrame) -> TrainingData:
    """Split, pack and stage a feature matrix; scale by its training rows."""
    parted = stratified_split(stage(matrix, "matrix"))
    packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(parted)
    rows = packed.select(
        "customer_id", F.col("churn_label").cast("double").alias("label"), "features", "is_train", "fold")
    rows = stage(spread(rows, "customer_id"), "training")
    train = rows.filter("is_train")
    scaler = StandardScaler(withMean=True, inputCol="features", outputCol="scaled").fit(train)
    return TrainingData(rows, train.count(), scaler)


def train_models(data: TrainingData, chosen: tuple[str, ...] | None = None, parallelism: int = 3,
                 **options) -> dict[str, Model]:
    """Fit the classifiers on the training rows, several at a time."""
    made = estimators(data.train_rows, **options)
    names = list(chosen or made)
    with ThreadPool(min(parallelism, len(names))) as pool:
        fitted = pool.map(lambda n: made[n].fit(data.view(data.train, n)), names)
    return dict(zip(names, fitted))


def roc_auc(predictions: DataFrame) -> float:
    return BinaryClassificationEvaluator(numBins=0).evaluate(predictions)


def test_auc(data: TrainingData, models: Mapping[str, Model]) -> DataFrame:
    """ROC AUC of each model on the held-out rows."""
    found = [(n, roc_auc(m.transform(data.view(data.test, n)))) for n, m in models.items()]
    return data.rows.sparkSession.createDataFrame(found, "model string, auc double")


def cross_validate(data: TrainingData, chosen: tuple[str, ...] | None = None, folds: int = 5,
                   parallelism: int = 5, **options) -> DataFrame:
    """Mean and population deviation of the AUC over folds of the unscaled training rows."""
    made = estimators(data.train_rows, **options)
    names = list(chosen or made)

    def one(task: tuple[str, int]) -> float:
        name, fold = task
        model = made[name].fit(data.train.filter(F.col("fold") != fold))
        return roc_auc(model.transform(data.train.filter(F.col("fold") == fold)))

    tasks = [(n, k) for n in names for k in range(folds)]
    with ThreadPool(parallelism) as pool:
        scores = dict(zip(tasks, pool.map(one, tasks, chunksize=1)))
    rows = []
    for n in names:
        values = [scores[(n, k)] for k in range(folds)]
        rows.append((n, fmean(values), pstdev(values)))
    return data.rows.sparkSession.createDataFrame(rows, "model string, cv_mean double, cv_std double")


def feature_importance(data: TrainingData, models: Mapping[str, Model], top: int | None = None) -> DataFrame:
    """Importance (trees) or absolute coefficient of each input, largest first."""
    rows = []
    for name, model in models.items():
        weights = model.coefficients if name == LOGISTIC else model.featureImportances
        ranked = sorted(zip(FEATURES, (abs(float(v)) for v in weights.toArray())), key=lambda r: -r[1])
        rows += [(name, i + 1, f, v) for i, (f, v) in enumerate(ranked[:top])]
    return data.rows.sparkSession.createDataFrame(
        rows, "model string, place int, feature string, importance double")


def score_customers(data: TrainingData, models: Mapping[str, Model],
                    name: str = RANDOM_FOREST) -> DataFrame:
    """Churn probability and risk category of every customer; unknown names mean random forest."""
    name = name if name in models else RANDOM_FOREST
    scored = models[name].transform(data.view(data.rows, name))
    return (scored.select("customer_id", vector_to_array("probability")[1].alias("churn_probability"))
            .withColumn("churn_risk_category", risk_category("churn_probability")))


def _score_counts(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives at each distinct score, written once."""
    counts = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(label) == 1).cast("bigint")).alias("pos"),
        F.sum((F.col(label) != 1).cast("bigint")).alias("neg"))
    return stage(counts, "scores")


def _score_totals(counts: DataFrame) -> DataFrame:
    """Positives and negatives at and above each distinct score."""
    return running_totals(counts, [F.col("threshold").desc()], {"tp": "pos", "fp": "neg"})


def roc_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at every distinct score."""
    counts = _score_counts(scored, label, score)
    ends = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("e"))
    e = F.col("e")
    return (_score_totals(counts).withColumn("e", ends.scalar())
            .select("threshold", (F.col("fp") / F.nullif(e["n"], F.lit(0))).alias("fpr"),
                    (F.col("tp") / F.nullif(e["p"], F.lit(0))).alias("tpr")))


def exact_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Share of (positive, negative) pairs ranked rightly, ties counting half.

    Summed over distinct scores: negatives below times positives here.
    """
    totals = _score_totals(_score_counts(scored, label, score))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    # Twice the pairs where the positive scores higher, plus the ties once.
    pairs = F.sum(wide("neg") * (wide("tp") * 2 - wide("pos")))
    return totals.agg((pairs.cast("double") / 2
                       / F.nullif(F.sum("pos").cast("double") * F.sum("neg").cast("double"), F.lit(0.0)))
                      .alias("auc"))
