"""Invariants of fitted models."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tillsight.operators import arima, churn, churn_models as models, clusters, forecast, model_quality as quality, rfm, series
from tillsight.functions.scalars import latest
from tillsight.sources.star import Star

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, FOLDER)


@pytest.fixture(scope="module")
def data(star):
    base = churn.churn_base(star.registered, star.orders, star.order_items, star.products)
    labelled = churn.churn_labels(base)
    return models.training_data(churn.feature_matrix(
        churn.churn_features(labelled, latest(star.orders, "order_date"))))


@pytest.fixture(scope="module")
def fitted(data):
    return models.train_models(data, trees=20, rounds=10)


def test_scores_are_probabilities(data, fitted):
    for name in fitted:
        rows = models.score_customers(data, fitted, name).collect()
        assert len(rows) == data.rows.count()
        assert all(0 <= r.churn_probability <= 1 for r in rows)


def test_unknown_model_is_the_forest(data, fitted):
    a = models.score_customers(data, fitted, "nothing").collect()
    b = models.score_customers(data, fitted, models.RANDOM_FOREST).collect()
    assert sorted(a) == sorted(b)


def test_auc_beats_chance(data, fitted):
    # The label is a function of the inputs, so the held-out rows are told apart well.
    assert all(r.auc > 0.6 for r in models.test_auc(data, fitted).collect())


def test_training_is_spread(data, star):
    assert data.rows.rdd.getNumPartitions() > 1
    scored = rfm.rfm_scores(rfm.segment_base(star.customers, star.orders, star.order_items))
    assert clusters.standardised(scored).rdd.getNumPartitions() > 1


def test_cross_validation(data):
    rows = models.cross_validate(data, (models.RANDOM_FOREST, models.LOGISTIC), trees=10).collect()
    assert len(rows) == 2 and all(0.5 < r.cv_mean <= 1 and r.cv_std >= 0 for r in rows)


def test_forest_keeps_node_ids(data):
    # Without them every level of every tree walks each row from the root again.
    kept = models.estimators(data.train_rows, trees=5)[models.RANDOM_FOREST]
    assert kept.getCacheNodeIds()
    walked = kept.copy({kept.cacheNodeIds: False})
    assert kept.fit(data.train).toDebugString.split("\n")[1:] == walked.fit(data.train).toDebugString.split("\n")[1:]


def test_importance(data, fitted):
    rows = models.feature_importance(data, fitted).collect()
    assert len(rows) == 3 * len(churn.FEATURES)
    for name in (models.RANDOM_FOREST, models.GRADIENT_BOOSTING):
        own = [r.importance for r in rows if r.model == name]
        assert abs(sum(own) - 1) < 1e-9 and own == sorted(own, reverse=True)


def test_clusters(star):
    scored = rfm.rfm_scores(rfm.segment_base(star.customers, star.orders, star.order_items))
    found, quality = clusters.cluster_customers(scored, k=3, n_init=3)
    assert found.count() == scored.count() and -1 <= quality <= 1
    assert found.select("kmeans_cluster").distinct().count() == 3
    features = clusters.standardised(scored)
    tried = clusters.score_k(features, max_k=4, n_init=2)
    assert [k for k, _, _ in tried] == [2, 3, 4]
    assert tried[0][1] > tried[2][1]
    assert clusters.choose_k(features, max_k=4, n_init=2) == max(tried, key=lambda r: r[2])[0]


def test_fits_share_their_passes(spark, monkeypatch):
    # Same centres as Spark's own fits, in as many passes as the longest of them has rounds.
    rows = [(i, Vectors.dense([i % 4 * 5 + i * 37 % 11 / 10, i % 3 * 4 + i * 17 % 13 / 10])) for i in range(300)]
    features = spark.createDataFrame(rows, ["customer_id", "features"]).repartition(2, "customer_id").persist()
    features.count()
    own = {(k, s): KMeans(k=k, seed=42 + s, maxIter=300).fit(features) for k in (2, 5) for s in range(3)}
    passes, once = [], clusters._sums
    monkeypatch.setattr(clusters, "_sums", lambda *a: passes.append(1) or once(*a))
    for k, found in zip((2, 5), clusters.fit_kmeans(features, (2, 5), n_init=3)):
        best = min((own[k, s] for s in range(3)), key=lambda m: m.summary.trainingCost)
        assert found.cost == pytest.approx(best.summary.trainingCost, rel=1e-9)
        assert np.allclose(found.centers, np.array(best.clusterCenters()))
        same = found.transform(features).join(best.transform(features).select("customer_id", F.col("prediction").alias("p")), "customer_id")
        assert same.filter("prediction <> p").count() == 0
    assert len(passes) == max(m.summary.numIter for m in own.values())
    features.unpersist()


def test_forest_forecast_is_flat(star):
    daily = series.time_series(series.sales_base(star.orders, star.order_items, star.products))
    ahead, errors = forecast.random_forest(series.model_features(daily), trees=10, max_depth=4)
    rows = ahead.orderBy("forecast_date").collect()
    assert len(rows) == 30 and len({r.predicted_value for r in rows}) == 1
    assert rows[0].forecast_date == daily.agg({"ds": "max"}).first()[0] + dt.timedelta(1)
    e = errors.first()
    assert 0 <= e.mae <= e.rmse and e.r2 <= 1


def test_forest_needs_fifty_rows(star):
    daily = series.time_series(series.sales_base(star.orders, star.order_items, star.products))
    short = series.model_features(daily.orderBy("ds").limit(79))
    ahead, errors = forecast.random_forest(short)
    assert ahead.isEmpty() and errors.isEmpty()


def test_projection_formula():
    mean, error = arima.project(10.0, 0.5, 0.2, 1.0, 0.5 * 2 + 0.2 * 1, 2)
    assert np.allclose(mean, [11.2, 11.8]) and np.allclose(error**2, [1.0, 3.89])


def test_fit_recovers_parameters():
    rng = np.random.default_rng(3)
    e = rng.normal(0, 2, 6000)
    w = np.zeros(6000)
    for i in range(1, 6000):
        w[i] = 0.6 * w[i - 1] + e[i] - 0.3 * e[i - 1]
    phi, theta, variance, _ = arima.fit_arma11(w)
    assert abs(phi - 0.6) < 0.08 and abs(theta + 0.3) < 0.08 and abs(variance - 4) < 0.3


def test_arima_by_key(spark):
    start = dt.date(2024, 1, 1)
    rng = np.random.default_rng(1)
    rows = [(k, start + dt.timedelta(i), float(100 + rng.normal())) for k in ("a", "b") for i in range(60)]
    rows += [("flat", start + dt.timedelta(i), 5.0) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, ds date, revenue double")
    got = arima.arima_forecast(df, keys=["k"], horizon=5).collect()
    assert sorted({r.k for r in got}) == ["a", "b"] and len(got) == 10
    assert all(r.lower_ci < r.predicted_value < r.upper_ci for r in got)
    assert min(r.forecast_date for r in got) == dt.date(2024, 3, 1)


def test_report_by_hand(spark):
    cells = [(0, 0, 50), (0, 1, 10), (1, 0, 5), (1, 1, 30), (2, 0, 5), (None, 0, 3)]
    rows = [(a, b) for a, b, n in cells for _ in range(n)]
    report = quality.classification_report(spark.createDataFrame(rows, "label int, prediction int"))
    by_class = {r["class"]: r for r in report.collect()}
    assert (by_class[0].support, by_class[0].precision, by_class[0].recall) == (60, 50 / 60, 50 / 60)
    assert (by_class[1].support, by_class[1].precision, by_class[1].recall, by_class[1].f1) == (35, 0.75, 30 / 35, 60 / 75)
    assert (by_class[2].support, by_class[2].precision, by_class[2].recall, by_class[2].f1) == (5, 0, 0, 0)
    r = quality.weighted_metrics(report).first()
    assert r.rows == 100 and r.accuracy == pytest.approx(0.8) and r.recall == r.accuracy
    assert r.precision == pytest.approx(0.6 * 50 / 60 + 0.35 * 0.75) and r.f1 == pytest.approx(0.6 * 50 / 60 + 0.35 * 0.8)


def test_report_agrees_with_sparks_evaluator(data, fitted):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    for r in quality.compare_models(data, fitted).collect():
        scored = fitted[r.model].transform(data.view(data.test, r.model))
        for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
            assert r[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(scored))


def test_the_best_f1_is_chosen(data, fitted):
    found = quality.compare_models(data, fitted)
    rows = found.collect()
    best = max(r.f1 for r in rows)
    assert quality.best_model(found) == min(r.model for r in rows if r.f1 == best)


def test_categories_get_slots(spark):
    rows = [(1, "b", "x"), (2, "a", None), (3, None, "x"), (4, "a", "y")]
    seen = spark.createDataFrame(rows, "id int, gender string, country string")
    model = Pipeline(stages=quality.one_hot()).fit(seen)
    out = {r.id: (r.category.size, sorted(r.category.indices.tolist())) for r in model.transform(seen).collect()}
    assert out == {1: (6, [1, 3]), 2: (6, [0, 5]), 3: (6, [2, 3]), 4: (6, [0, 4])}
    new = model.transform(spark.createDataFrame([(9, "zzz", "y")], seen.schema)).first().category
    assert sorted(new.indices.tolist()) == [2, 4]


def test_stored_models_score_alike_in_another_session(spark, data, fitted, tmp_path):
    path = f"{tmp_path}/model"
    rows = data.rows.select("customer_id", "features")
    place = f"{tmp_path}/rows"
    rows.write.parquet(place)
    other = spark.newSession()
    with pytest.raises(FileNotFoundError):
        quality.load_model(other, path)
    for name, model in fitted.items():
        quality.store_model(spark, quality.packed_model(data, model, name), path)
        loaded = quality.load_model(other, path)
        again = {r.customer_id: r.probability for r in loaded.transform(other.read.parquet(place)).collect()}
        first = {r.customer_id: r.churn_probability for r in models.score_customers(data, fitted, name).collect()}
        assert {k: float(p[1]) for k, p in again.items()} == first


def test_a_mean_with_its_interval(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(40)]
    df = spark.createDataFrame([(d, 1000.0 if i < 10 else float(10 + i % 2)) for i, d in enumerate(days)], "ds date, revenue double")
    out = forecast.mean_with_interval(df, horizon=3).orderBy("forecast_date").collect()
    spread = 1.959963984540054 * np.std([10, 11] * 15, ddof=1)
    assert [r.forecast_date for r in out] == [days[-1] + dt.timedelta(i) for i in (1, 2, 3)]
    assert all((r.predicted_value, r.lower_ci, r.upper_ci) == pytest.approx((10.5, 10.5 - spread, 10.5 + spread)) for r in out)
    assert forecast.mean_with_interval(df.limit(0)).count() == 0


def test_total_of_separate_forecasts(spark):
    rows = [(k, dt.date(2024, 1, 1), v, "ARIMA", v - arima.Z95 * s, v + arima.Z95 * s) for k, v, s in (("a", 10.0, 3.0), ("b", 5.0, 4.0))]
    found = spark.createDataFrame(rows, "k string, forecast_date date, predicted_value double, model_type string, lower_ci double, upper_ci double")
    r = arima.total_forecast(found).first()
    assert (r.predicted_value, r.lower_ci, r.upper_ci) == pytest.approx((15, 15 - arima.Z95 * 5, 15 + arima.Z95 * 5))


def test_full_run_fits_arima_by_category(spark):
    """A category that ended early goes on at zero, so all are forecast for the same days."""
    from tillsight.plans import forecasting
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(i), i, c, 1, float(10 + (i * 7 + len(c)) % 5), 1, 1)
            for c, n in (("aa", 60), ("b", 40)) for i in range(n)]
    sales = spark.createDataFrame(
        rows, "order_date date, product_id long, category string, quantity_sold long, revenue double, order_count long, unique_customers long")
    apart = forecasting._by_category(sales)
    ends = {r["category"]: r["max(ds)"] for r in apart.groupBy("category").agg({"ds": "max"}).collect()}
    assert ends == {c: dt.date(2024, 2, 29) for c in ("aa", "b")}
    plan = arima.arima_forecast(apart, keys=["category"])._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas [category" in plan
