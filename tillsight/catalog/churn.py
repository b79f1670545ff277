"""Churn figures, features, split, models and scores."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.catalog import base
from tillsight.catalog.base import even, query, rounded, scores, segments
from tillsight.functions.scalars import latest
from tillsight.operators import churn, churn_models as models, model_quality
from tillsight.operators.clusters import fill_with_median
from tillsight.plans import churn as plan
from tillsight.session import scratch_path, stage
from tillsight.sources import readers, writers
from tillsight.sources.star import Star

_FILLED = ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM r_churn_features)) AS {c}"
    for c in churn.NUMERIC_FEATURES)
_CODED = ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'Unknown')) - 1 AS INTEGER) AS {c}_encoded"
    for c in churn.TEXT_FEATURES)
base.TABLES["r_churn_matrix"] = (
    f"SELECT customer_id, {_FILLED}, {_CODED}, churn_label FROM r_churn_features")
base.TABLES["r_churn_split"] = """
    WITH k AS (SELECT customer_id, churn_label,
                      row_number() OVER (PARTITION BY churn_label
                                         ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) AS place,
                      floor(CAST(COUNT(*) OVER (PARTITION BY churn_label) AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS cut
               FROM r_churn_labels)
    SELECT customer_id, churn_label, place <= cut AS is_train,
           CASE WHEN place <= cut THEN CAST((place - 1) % 5 AS INTEGER) END AS fold FROM k"""


def _labels(t: Star) -> DataFrame:
    return churn.churn_labels(base.churn(t))


def _features(t: Star) -> DataFrame:
    return churn.churn_features(_labels(t), latest(t.orders, "order_date"))


def _matrix(t: Star) -> DataFrame:
    return churn.feature_matrix(_features(t))


def _data(t: Star) -> models.TrainingData:
    return models.training_data(_matrix(t))


_ALL = (models.RANDOM_FOREST, models.GRADIENT_BOOSTING, models.LOGISTIC)


@query("ch_base", "SELECT * FROM r_churn_base")
def ch_base(t: Star) -> DataFrame:
    return base.churn(t)


@query("ch_labels", """
    SELECT customer_id, is_churned, high_return_rate, high_cancel_rate, low_engagement,
           churn_risk_score, churn_label FROM r_churn_labels""")
def ch_labels(t: Star) -> DataFrame:
    return _labels(t).select("customer_id", "is_churned", "high_return_rate", "high_cancel_rate",
                             "low_engagement", "churn_risk_score", "churn_label")


_MADE = ["recency_score", "frequency_score", "monetary_score", "avg_days_between_orders", "spending_trend",
         "diversity_score", "tenure_days", "tenure_months", "engagement_ratio", "purchase_intensity"]


@query("ch_features", f"SELECT customer_id, {', '.join(_MADE)} FROM r_churn_features")
def ch_features(t: Star) -> DataFrame:
    return _features(t).select("customer_id", *_MADE)


@query("ch_median_fill", f"SELECT customer_id, {', '.join(churn.NUMERIC_FEATURES)} FROM r_churn_matrix")
def ch_median_fill(t: Star) -> DataFrame:
    filled = fill_with_median(_features(t), churn.NUMERIC_FEATURES)
    return filled.select("customer_id", *churn.NUMERIC_FEATURES)


@query("ch_label_encode", """
    SELECT customer_id, gender, country,
           CAST(dense_rank() OVER (ORDER BY coalesce(gender, 'Unknown')) - 1 AS INTEGER) AS gender_encoded,
           CAST(dense_rank() OVER (ORDER BY coalesce(country, 'Unknown')) - 1 AS INTEGER) AS country_encoded
    FROM r_customers""")
def ch_label_encode(t: Star) -> DataFrame:
    coded = t.customers.select("customer_id", "gender", "country")
    for column in churn.TEXT_FEATURES:
        coded = churn.label_encode(coded, column)
    return coded


@query("ch_feature_matrix", "SELECT * FROM r_churn_matrix")
def ch_feature_matrix(t: Star) -> DataFrame:
    return _matrix(t)


@query("ch_split", "SELECT * FROM r_churn_split")
def ch_split(t: Star) -> DataFrame:
    return churn.stratified_split(_labels(t).select("customer_id", "churn_label"))


_SCALED = churn.FEATURES


@query("ch_scale", f"""
    WITH j AS (SELECT * EXCLUDE (churn_label) FROM r_churn_matrix JOIN r_churn_split USING (customer_id)),
    s AS (SELECT {', '.join(f'AVG({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in _SCALED)}
          FROM j WHERE is_train)
    SELECT customer_id, {', '.join(f"{even(f'CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0 END', 6)} AS {c}" for c in _SCALED)} FROM j, s""")
def ch_scale(t: Star) -> DataFrame:
    """All standardised inputs of every customer; a constant input is 0."""
    data = _data(t)
    vector = vector_to_array(F.col("scaled"))
    place = {c: churn.FEATURES.index(c) for c in _SCALED}
    scaled = data.scaler.transform(data.rows).select(
        "customer_id", *[vector[i].alias(c) for c, i in place.items()])
    return rounded(scaled, 6, *_SCALED)


def _scored(t: Star, name: str) -> DataFrame:
    data = _data(t)
    return models.score_customers(data, models.train_models(data, (name,)), name)


@query("ch_random_forest")
def ch_random_forest(t: Star) -> DataFrame:
    return _scored(t, models.RANDOM_FOREST)


@query("ch_gradient_boosting")
def ch_gradient_boosting(t: Star) -> DataFrame:
    return _scored(t, models.GRADIENT_BOOSTING)


@query("ch_logistic")
def ch_logistic(t: Star) -> DataFrame:
    return _scored(t, models.LOGISTIC)


@query("ch_model_auc")
def ch_model_auc(t: Star) -> DataFrame:
    data = _data(t)
    return models.test_auc(data, models.train_models(data, _ALL))


# Labels ranked by days since the last order: a score with many ties.
_COUNTS = """SELECT CAST(days_since_last_order AS DOUBLE) AS threshold,
                    SUM(churn_label) AS pos, SUM(1 - churn_label) AS neg
             FROM r_churn_labels GROUP BY 1"""


def _by_days(t: Star) -> DataFrame:
    return _labels(t).select(F.col("churn_label").alias("label"),
                             F.col("days_since_last_order").cast("double").alias("score"))


@query("ch_auc", f"""
    WITH c AS ({_COUNTS}),
    s AS (SELECT *, SUM(neg) OVER (ORDER BY threshold) - neg AS below FROM c)
    SELECT CAST(SUM(CAST(pos AS DOUBLE) * below + CAST(pos AS DOUBLE) * neg / 2) AS DOUBLE)
           / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)) AS auc FROM s""")
def ch_auc(t: Star) -> DataFrame:
    return models.exact_auc(_by_days(t))


@query("ch_roc_points", f"""
    WITH c AS ({_COUNTS}),
    s AS (SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp FROM c WINDOW w AS (ORDER BY threshold DESC))
    SELECT threshold, CAST(fp AS DOUBLE) / (SELECT SUM(neg) FROM c) AS fpr,
           CAST(tp AS DOUBLE) / (SELECT SUM(pos) FROM c) AS tpr FROM s""")
def ch_roc_points(t: Star) -> DataFrame:
    return models.roc_points(_by_days(t))


@query("ch_cross_val")
def ch_cross_val(t: Star) -> DataFrame:
    return models.cross_validate(_data(t))


@query("ch_importance")
def ch_importance(t: Star) -> DataFrame:
    data = _data(t)
    return models.feature_importance(data, models.train_models(data, _ALL), top=10)


@query("ch_score")
def ch_score(t: Star) -> DataFrame:
    """An unknown model name falls back to the random forest."""
    data = _data(t)
    return models.score_customers(data, models.train_models(data, (models.RANDOM_FOREST,)), "No Such Model")


@query("ch_write", """
    SELECT customer_id, segment_name, clv_prediction, churn_probability / 2 AS churn_probability
    FROM r_segments""")
def ch_write(t: Star) -> DataFrame:
    """Scores laid over the stored segment table, which is read and replaced."""
    path = scratch_path(t.spark, "customer_segments")
    stored = segments(t).withColumn("churn_probability", F.lit(None).cast("double"))
    writers.create_table(stored, path)
    fresh = scores(t).withColumn("churn_probability", F.col("churn_probability") / 2)
    plan.store_scores(t.spark, fresh, path, scratch_path(t.spark, "churn_predictions"))
    return readers.read_table(t.spark, path).select(
        "customer_id", "segment_name", "clv_prediction", "churn_probability")


@query("ch_write_without_segments", "SELECT * FROM r_scores")
def ch_write_without_segments(t: Star) -> DataFrame:
    """Without a segment table the scores get a table of their own."""
    fallback = scratch_path(t.spark, "churn_predictions")
    written = plan.store_scores(t.spark, scores(t), scratch_path(t.spark, "missing"), fallback)
    return readers.read_table(t.spark, written)


@query("ch_insights")
def ch_insights(t: Star) -> DataFrame:
    scored = _labels(t).join(_scored(t, models.RANDOM_FOREST), "customer_id")
    return churn.churn_insights(scored).withColumn(
        "recommendations", F.array_join("recommendations", "; "))


@query("ch_full_run")
def ch_full_run(t: Star) -> DataFrame:
    """All churn steps: three models, five folds; returns the scored customers."""
    run = plan.run_churn(t.registered, t.orders, t.order_items, t.products)
    return run.scored.select("customer_id", "churn_label", "churn_probability", "churn_risk_category")


_SCORED_ONCE = """
    SELECT COUNT(*) AS customers, COUNT(*) AS scored_once, COUNT(*) AS in_range, COUNT(*) AS category_fits
    FROM r_churn_labels"""


def _fits() -> Column:
    """Whether the category follows from the probability."""
    p = F.col("churn_probability")
    band = F.when((p > 0) & (p <= 0.3), "Low Risk").when((p > 0.3) & (p <= 0.7), "Medium Risk").when((p > 0.7) & (p <= 1), "High Risk")
    return F.col("churn_risk_category").eqNullSafe(band)


def _score_check(scored: DataFrame) -> DataFrame:
    """Every customer is scored once, between 0 and 1, and the category follows from the probability."""
    return scored.agg(F.count("*").alias("customers"), F.count_distinct("customer_id").alias("scored_once"),
                      F.count_if(F.col("churn_probability").between(0, 1)).alias("in_range"),
                      F.count_if(_fits()).alias("category_fits"))


@query("ch_logistic_check", _SCORED_ONCE)
def ch_logistic_check(t: Star) -> DataFrame:
    return _score_check(_scored(t, models.LOGISTIC))


@query("ch_random_forest_check", _SCORED_ONCE)
def ch_random_forest_check(t: Star) -> DataFrame:
    return _score_check(_scored(t, models.RANDOM_FOREST))


@query("ch_gradient_boosting_check", _SCORED_ONCE)
def ch_gradient_boosting_check(t: Star) -> DataFrame:
    return _score_check(_scored(t, models.GRADIENT_BOOSTING))


@query("ch_score_check", _SCORED_ONCE)
def ch_score_check(t: Star) -> DataFrame:
    return _score_check(ch_score(t))


@query("ch_cross_val_check", f"""
    SELECT unnest({list(_ALL)!r}) AS model, TRUE AS better_than_chance, TRUE AS spread_fits""")
def ch_cross_val_check(t: Star) -> DataFrame:
    """Three models, each above chance in the mean of five folds."""
    return ch_cross_val(t).select("model", F.col("cv_mean").between(0.5, 1).alias("better_than_chance"),
                                  F.col("cv_std").between(0, 0.5).alias("spread_fits"))


_MEANS = [f"avg_{m}_{g}" for m in ("days_since_last_order", "orders") for g in ("churned", "active")]


@query("ch_insights_check", f"""
    SELECT TRUE AS count_fits, TRUE AS stake_fits, {', '.join(
        f"{even(f'AVG({c}) FILTER (churn_label = {v})', 6)} AS avg_{m}_{g}"
        for m, c in (('days_since_last_order', 'days_since_last_order'), ('orders', 'total_orders'))
        for g, v in (('churned', 1), ('active', 0)))} FROM r_churn_labels""")
def ch_insights_check(t: Star) -> DataFrame:
    """Means by label; the high-risk customers are some of all, and what they spent is part of the whole."""
    everyone = _labels(t).agg(F.count("*").alias("n"), F.sum("total_spent").alias("spent"))
    found = ch_insights(t).select("high_risk_count", "high_risk_revenue_at_stake", *_MEANS)
    whole = everyone.select(F.struct("n", "spent")).scalar()
    out = found.withColumn("w", whole).select(
        F.col("high_risk_count").between(0, F.col("w.n")).alias("count_fits"),
        F.col("high_risk_revenue_at_stake").between(0, F.col("w.spent") + 0.01).alias("stake_fits"), *_MEANS)
    return rounded(out, 6, *_MEANS)


@query("ch_full_run_check", "SELECT customer_id, churn_label, TRUE AS in_range, TRUE AS category_fits FROM r_churn_labels")
def ch_full_run_check(t: Star) -> DataFrame:
    """The whole run leaves every customer with its label, a probability and the category that follows."""
    return ch_full_run(t).select("customer_id", "churn_label", F.col("churn_probability").between(0, 1).alias("in_range"),
                                 _fits().alias("category_fits"))


# -- choice of a model -------------------------------------------------------

_CLASSES = """
    WITH s AS (SELECT churn_label AS l, CAST(churn_probability > 0.5 AS INTEGER) AS p FROM r_churn_labels JOIN r_scores USING (customer_id)),
    k AS (SELECT l AS c FROM s UNION SELECT p FROM s),
    n AS (SELECT c, (SELECT COUNT(*) FROM s WHERE l = c) AS support, (SELECT COUNT(*) FROM s WHERE p = c) AS given,
                 (SELECT COUNT(*) FROM s WHERE l = c AND p = c) AS hit FROM k),
    r AS (SELECT CAST(c AS DOUBLE) AS class, support, coalesce(hit / nullif(CAST(given AS DOUBLE), 0), 0) AS precision,
                 coalesce(hit / nullif(CAST(support AS DOUBLE), 0), 0) AS recall,
                 coalesce(2 * hit / nullif(CAST(support + given AS DOUBLE), 0), 0) AS f1 FROM n)"""


def _report(t: Star) -> DataFrame:
    given = _labels(t).join(scores(t), "customer_id").select(
        "churn_label", (F.col("churn_probability") > 0.5).cast("int").alias("prediction"))
    return model_quality.classification_report(given, "churn_label")


@query("ch_class_report", f"""{_CLASSES}
    SELECT class, support, {even('precision', 8)} AS precision, {even('recall', 8)} AS recall, {even('f1', 8)} AS f1 FROM r""")
def ch_class_report(t: Star) -> DataFrame:
    """Precision, recall and F1 of each class, for given scores."""
    return rounded(_report(t), 8, "precision", "recall", "f1")


@query("ch_weighted_metrics", f"""{_CLASSES}
    SELECT CAST(SUM(support) AS BIGINT) AS rows, {', '.join(
        f"{even(f'SUM(support * {c}) / SUM(support)', 8)} AS {n}" for n, c in
        (('accuracy', 'recall'), ('precision', 'precision'), ('recall', 'recall'), ('f1', 'f1')))} FROM r""")
def ch_weighted_metrics(t: Star) -> DataFrame:
    return rounded(model_quality.weighted_metrics(_report(t)), 8, "accuracy", "precision", "recall", "f1")


@query("ch_model_choice")
def ch_model_choice(t: Star) -> DataFrame:
    """Weighted metrics of the three classifiers on held-out customers, the best by F1 marked."""
    data = _data(t)
    return model_quality.compare_models(data, models.train_models(data))


@query("ch_model_choice_check", f"""
    SELECT COUNT(*) AS models, CAST(1 AS BIGINT) AS chosen, TRUE AS best, TRUE AS in_range,
           CAST((SELECT COUNT(*) FROM r_churn_split WHERE NOT is_train) AS BIGINT) AS held_out
    FROM (SELECT unnest({list(_ALL)!r}))""")
def ch_model_choice_check(t: Star) -> DataFrame:
    found = ch_model_choice(t)
    return found.agg(
        F.count("*").alias("models"), F.count_if("chosen").alias("chosen"),
        (F.max("f1") == F.max(F.when(F.col("chosen"), F.col("f1")))).alias("best"),
        F.bool_and(F.least("accuracy", "precision", "recall", "f1").between(0, 1)
                   & F.greatest("accuracy", "precision", "recall", "f1").between(0, 1)).alias("in_range"),
        F.max("rows").alias("held_out"))


@query("ch_one_hot", """
    WITH g AS (SELECT gender, dense_rank() OVER (ORDER BY gender) - 1 AS i FROM (SELECT DISTINCT gender FROM r_customers WHERE gender IS NOT NULL)),
    c AS (SELECT country, dense_rank() OVER (ORDER BY country) - 1 AS i FROM (SELECT DISTINCT country FROM r_customers WHERE country IS NOT NULL)),
    n AS (SELECT (SELECT COUNT(*) FROM g) AS g, (SELECT COUNT(*) FROM c) AS c)
    SELECT customer_id, CAST(n.g + n.c + 2 AS INTEGER) AS width,
           coalesce(g.i, n.g) || ' ' || (n.g + 1 + coalesce(c.i, n.c)) AS slots
    FROM r_customers LEFT JOIN g USING (gender) LEFT JOIN c USING (country), n""")
def ch_one_hot(t: Star) -> DataFrame:
    """The sparse category vector of every customer, as its width and the slots that are 1."""
    coded = Pipeline(stages=model_quality.one_hot()).fit(t.customers).transform(t.customers)
    values = vector_to_array("category")
    ones = F.filter(F.transform(values, lambda v, i: F.when(v == 1, i)), lambda i: i.isNotNull())
    return coded.select("customer_id", F.size(values).alias("width"), F.array_join(ones.cast("array<string>"), " ").alias("slots"))


@query("ch_model_store_check", """
    SELECT COUNT(*) AS customers, COUNT(*) AS equal_scores FROM r_churn_labels""")
def ch_model_store_check(t: Star) -> DataFrame:
    """A one-hot logistic model saved, loaded and applied again gives every customer the same probability."""
    features = model_quality.numeric_inputs(stage(_features(t), "features"))
    labelled = features.withColumn("label", F.col("churn_label").cast("double"))
    made = model_quality.one_hot_pipeline(LogisticRegression(maxIter=20, regParam=0.01), scale=True).fit(labelled)
    path = scratch_path(t.spark, "model")
    model_quality.store_model(t.spark, made, path)
    again = model_quality.load_model(t.spark, path)
    score = lambda m, name: m.transform(features).select("customer_id", vector_to_array("probability")[1].alias(name))
    both = score(made, "a").join(score(again, "b"), "customer_id")
    return both.agg(F.count("*").alias("customers"), F.count_if(F.col("a") == F.col("b")).alias("equal_scores"))


@query("ch_importance_check", f"""
    SELECT '{models.LOGISTIC}' AS model, CAST({len(churn.FEATURES)} AS BIGINT) AS features, CAST(0 AS BIGINT) AS negative,
           CAST(0 AS BIGINT) AS out_of_order""")
def ch_importance_check(t: Star) -> DataFrame:
    """One importance per input, none negative, largest first."""
    data = _data(t)
    found = models.feature_importance(data, models.train_models(data, (models.LOGISTIC,)))
    after = F.lead("importance").over(Window.partitionBy("model").orderBy("place"))
    return found.withColumn("after", after).groupBy("model").agg(
        F.count_distinct("feature").alias("features"), F.count_if(F.col("importance") < 0).alias("negative"),
        F.count_if(F.col("after") > F.col("importance")).alias("out_of_order"))
