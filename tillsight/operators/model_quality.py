"""Choosing among classifiers, inputs by category, and models that outlive their session."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.operators.churn import NUMERIC_FEATURES, TEXT_FEATURES
from tillsight.operators.churn_models import LOGISTIC, TrainingData
from tillsight.sources import versions


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(class, support, precision, recall, f1), one row per class that is a label or a prediction.

    Rows shrink to the cells of the confusion matrix; a share without cases is 0.
    """
    cells = scored.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p")).agg(
        F.count("*").alias("n")).filter("l IS NOT NULL AND p IS NOT NULL")
    none = F.lit(0).cast("long")
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("l").alias("class"), F.col("n").alias("support"), none.alias("given"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(none).alias("hit")),
        F.struct(F.col("p").alias("class"), none.alias("support"), F.col("n").alias("given"), none.alias("hit")))).alias("s"))
    sums = sides.select("s.*").groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "given", "hit")])
    share = lambda a, b: F.coalesce(a.cast("double") / F.nullif(b, none), F.lit(0.0))
    hit, support, given = F.col("hit"), F.col("support"), F.col("given")
    return sums.select("class", "support", share(hit, given).alias("precision"), share(hit, support).alias("recall"),
                       share(2 * hit, support + given).alias("f1"))


def weighted_metrics(report: DataFrame) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by support."""
    total = F.nullif(F.sum("support"), F.lit(0).cast("long"))
    mean = lambda c: F.sum(F.col("support") * F.col(c)) / total
    # Recall weighted by support is the share of hits.
    return report.agg(F.sum("support").alias("rows"), mean("recall").alias("accuracy"), mean("precision").alias("precision"),
                      mean("recall").alias("recall"), mean("f1").alias("f1"))


def compare_models(data: TrainingData, models: Mapping[str, Model]) -> DataFrame:
    """Weighted metrics of each model on the held-out rows; ``chosen`` marks the best F1, the first by name on a tie."""
    parts = None
    for name, model in models.items():
        row = weighted_metrics(classification_report(model.transform(data.view(data.test, name)))).select(F.lit(name).alias("model"), "*")
        parts = row if parts is None else parts.unionByName(row)
    found = data.rows.sparkSession.createDataFrame(parts.collect(), parts.schema)  # one row for each model
    best = found.agg(F.min_by("model", F.struct(-F.col("f1"), F.col("model")))).scalar()
    return found.withColumn("chosen", F.col("model") == best)


def best_model(compared: DataFrame) -> str:
    return compared.filter("chosen").first()["model"]


def one_hot(columns: Sequence[str] = TEXT_FEATURES, out: str = "category") -> list[Estimator]:
    """Stages that make one sparse vector of text columns: a slot for each value, in sorted order, and one for null or unknown."""
    numbers, slots = [f"_{c}_number" for c in columns], [f"_{c}_slot" for c in columns]
    return [StringIndexer(inputCols=list(columns), outputCols=numbers, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=numbers, outputCols=slots, dropLast=False),
            VectorAssembler(inputCols=slots, outputCol=out)]


def one_hot_pipeline(classifier: Estimator, numbers: Sequence[str] = NUMERIC_FEATURES,
                     text: Sequence[str] = TEXT_FEATURES, scale: bool = False) -> Pipeline:
    """Medians for missing numbers, one-hot categories, and the classifier: one model from table columns to scores.

    Scaling keeps zeros (no centring), so vectors stay sparse.
    """
    filled = [f"_{c}_filled" for c in numbers]
    stages = [Imputer(inputCols=list(numbers), outputCols=filled, strategy="median"), *one_hot(text, "_category"),
              VectorAssembler(inputCols=[*filled, "_category"], outputCol="_inputs" if scale else "features")]
    if scale:
        stages.append(StandardScaler(withMean=False, inputCol="_inputs", outputCol="features"))
    return Pipeline(stages=[*stages, classifier])


def numeric_inputs(features: DataFrame, numbers: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """The features with numbers as doubles, as the pipeline takes them."""
    return features.withColumns({c: F.col(c).cast("double") for c in numbers})


def packed_model(data: TrainingData, model: Model, name: str) -> PipelineModel:
    """A trained classifier with what it needs before it: scores vectors in column ``features``."""
    if name != LOGISTIC:
        return PipelineModel(stages=[model])
    return PipelineModel(stages=[data.scaler, model.copy({model.featuresCol: data.scaler.getOutputCol()})])


def store_model(spark: SparkSession, model: PipelineModel, path: str) -> None:
    """Save a model as the current version; the one before stays readable until then."""
    folder = f"rows-{uuid.uuid4().hex}"
    model.write().save(f"{path.rstrip('/')}/{folder}")
    versions.commit_folder(spark, path, folder)


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """The current model, in any session that reaches the path."""
    return PipelineModel.load(versions.whole_folder(spark, path))
