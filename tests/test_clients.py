import itertools
import threading
from datetime import datetime
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, NaiveBayes
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from daybook.operators import attributes, clients, models, segments


def test_prepare_matrix(table):
    df = table("client_id string, user_type string, trade_tenure_months double, trade_value double, v int",
               ("a", "Business", 1.6, None, 1), ("a", "Business", 9.0, 9.0, 2), ("b", None, 1.0, 1.0, 1), ("c", "Personal", 1.0, 1.0, 1),
               ("d", "Business", 1.0, 1.0, 1))
    rows = clients.prepare_matrix(df, user_type="Business", outliers=["d"], order=["v"]).collect()
    assert [(r.client_id, r.trade_tenure_months, r.trade_value) for r in rows] == [("a", 2.0, 0.0)]


def test_log_scale_has_mean_0_and_sd_1(table):
    df = table("id int, a double, b double", (1, 1.0, 5.0), (2, 10.0, 5.0), (3, 0.0, 5.0), (4, -3.0, 5.0), (5, None, 5.0))
    scaled = clients.log_scale(df, ["a", "b"])
    row = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.avg("b"), F.stddev_pop("b")).first()
    assert list(row) == pytest.approx([0, 1, 0, 0], abs=1e-9)


def test_rfmt_simple_keeps_first_and_nulls(table):
    df = table("client_id int, last_purchase_date date, purchase_count int, total_spent double, tenure int, v int",
               (1, None, 2, None, 3, 1), (1, None, 9, 9.0, 9, 2))
    row = clients.rfmt_simple(df, "2024-01-01", ["v"]).first()
    assert tuple(row) == (1, None, 2, 0.0, 3)


def test_segments_are_named_by_value(table):
    df = table("c int, v double", (0, 5.0), (0, 7.0), (1, 100.0), (2, 1.0))
    got = {r.c: r.segment for r in segments.label_segments(df, "c", "v").collect()}
    assert got == {2: "Low Value Individual", 0: "Mid Value Individual", 1: "High Value Individual"}


def test_kmeans_and_elbow(spark):
    rows = [(i, 10.0 * (i % 3) + i * 0.001, float(i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    labelled, centers = segments.kmeans_segments(df, ["x", "y"], 3)
    assert sorted(r["count"] for r in labelled.groupBy("cluster").count().collect()) == [30, 30, 30]
    assert centers.count() == 6
    costs = [r.sse for r in segments.elbow(df, ["x", "y"], range(1, 4)).orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2]


def test_errors_of_given_centroids(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (5.0, 5.0)], "x double, y double")
    found = segments.squared_errors(df, ["x", "y"], {1: [[0, 0]], 2: [[0, 0], [5, 5]]})
    assert dict(map(tuple, found.collect())) == {1: 51.0, 2: 1.0}
    assert dict(map(tuple, segments.squared_errors(df.limit(0), ["x", "y"], {1: [[0, 0]]}).collect())) == {1: 0.0}
    assert df.select(segments.nearest(["x", "y"], [[5, 5], [1, 0], [1, 0]])["cluster"]).collect() == [(1,), (1,), (0,)]


def test_coreset_stands_for_all_rows(spark):
    df = spark.range(40_000).selectExpr("double(id % 4) * 10 + rand(1) as x", "if(id = 7, 1000D, rand(2)) as y")
    points = segments.coreset(df, ["x", "y"], 2000)
    assert 1500 < points.count() < 2500
    assert points.where("y > 900").count() == 1  # a far row is not lost
    assert points.agg({"_weight": "sum"}).first()[0] == pytest.approx(40_000, rel=0.1)
    near = {r.k: r.sse for r in segments.elbow(df, ["x", "y"], range(1, 6), size=2000).collect()}
    whole = {r.k: r.sse for r in segments.elbow(df, ["x", "y"], range(1, 6), size=100_000).collect()}
    for k in (1, 2, 5):
        assert near[k] == pytest.approx(whole[k], rel=0.25)


def test_client_attributes(table):
    labels = table("client_id int, c string", (1, "x"), (2, "y"), (3, "z"))
    demo = table("client_id int, company_website string, used_referral_code string, date_of_incorporation string, created timestamp",
                 (1, "https://a.com/", "COMX1", "01/01/2020", datetime(2024, 1, 1)), (2, "a.com", "X", "not a date", datetime(2024, 1, 7)))
    got = {r.client_id: r for r in attributes.client_attributes(labels, demo, "2024-01-01").collect()}
    assert (got[1].has_website, got[1].is_referred, got[1].age, got[1].created_dayofweek) == ("has website", "referred", 4.0, 0)
    assert (got[2].has_website, got[2].is_referred, got[2].age, got[2].created_dayofweek) == ("does not have website", "not referred", None, 6)
    assert got[3].is_referred == "not referred"


def test_impute_and_encode_with_training_codes(table):
    df = table("id int, s string, n double", (1, "b", 1.0), (2, "a", None), (3, None, 4.0), (4, "b", 2.0))
    full = attributes.impute(df, ["s"], ["n"])
    assert {r.id: (r.s, r.n) for r in full.collect()} == {1: ("b", 1.0), 2: ("a", 2.0), 3: ("b", 4.0), 4: ("b", 2.0)}
    codes = attributes.class_codes(full, ["s"])
    new = table("id int, s string", (1, "a"), (2, "b"), (3, "unseen"))
    assert {r.id: r.s for r in attributes.label_encode(new, ["s"], codes).collect()} == {1: 0, 2: 1, 3: None}


def test_hold_out_is_stable(spark):
    df = spark.range(3000)
    _, held = attributes.hold_out(df, "id")
    again = attributes.hold_out(df.repartition(5), "id")[1]
    assert {r.id for r in held.collect()} == {r.id for r in again.collect()}
    assert 0.28 < held.count() / 3000 < 0.38


def test_votes(table):
    votes = table("id int, model string, prediction int, probabilities array<double>",
                  (1, "a", 0, [0.6, 0.4]), (1, "b", 1, [0.1, 0.9]), (2, "a", 1, [0.5, 0.5]), (2, "b", 0, [0.5, 0.5]))
    hard = {r.id: r.prediction for r in models.hard_vote(votes, "id", {"a": 1, "b": 1}).collect()}
    assert hard == {1: 0, 2: 0}  # ties go to the smaller class
    soft = {r.id: r.prediction for r in models.soft_vote(votes, "id", {"a": 2, "b": 4}).collect()}
    assert soft == {1: 1, 2: 0}


def test_evaluate(table):
    df = table("y int, p int", (0, 0), (0, 1), (1, 1), (1, 1), (2, 0))
    report = {r["class"]: (r.precision, r.recall, r.support) for r in models.class_report(df, "y", "p").collect()}
    assert report == {0: (0.5, 0.5, 2), 1: (pytest.approx(2 / 3), 1.0, 2), 2: (0.0, 0.0, 1)}
    row = models.summary_metrics(df, "y", "p").first()
    assert row.accuracy == 0.6 and row.weighted_f1 == pytest.approx((0.5 * 2 + 0.8 * 2) / 5)


def client_rows(spark, start, n):
    rows = [(i, float(i % 10), "low" if i % 10 < 5 else "high", "x" if i % 10 < 5 else "y") for i in range(start, start + n)]
    return spark.createDataFrame(rows, "id int, income double, cluster string, region string")


def test_train_compare_vote(spark):
    train, test = client_rows(spark, 0, 200).withColumn("y", F.col("cluster") == "high"), client_rows(spark, 200, 50)
    train, test = (d.withColumn("y", (F.col("cluster") == "high").cast("int")) for d in (train, test))
    kinds = {"tree": DecisionTreeClassifier(seed=1), "bayes": NaiveBayes(modelType="gaussian")}
    scores, fitted = models.train_classifiers(train, test, ["income"], "y", kinds)
    assert scores.count() == 4 and scores.where("accuracy < 0.9").count() == 0
    predicted = fitted[("tree", False)].transform(models.with_features(test, ["income"]))
    votes = models.model_votes(predicted, "id", "tree")
    assert models.hard_vote(votes, "id", {"tree": 1}).count() == 50


def class_rows(spark, n=90):
    """Whole numbers as features and three classes; the arrays, and the same rows in three tasks."""
    draw = np.random.default_rng(5)
    x = draw.integers(0, [9, 6], (n, 2)).astype(float)
    y = (x[:, 0] + 2 * x[:, 1] + draw.integers(0, 5, n)).astype(int) // 8 % 3
    rows = [(Vectors.dense(a), float(b)) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(rows, ["features", "label"]).repartition(3)


def test_ridge_is_least_squares_with_a_penalty(spark):
    x, y, rows = class_rows(spark)
    model = models.classifiers()["ridge"].fit(rows)
    signs = 2.0 * (y[:, None] == np.arange(3)) - 1
    centred = x - x.mean(0)
    weights = np.linalg.solve(centred.T @ centred + np.eye(2), centred.T @ (signs - signs.mean(0)))
    values = centred @ weights + signs.mean(0)
    found = {(*r.features, r.label): (r.rawPrediction.toArray(), r.prediction) for r in model.transform(rows).collect()}
    for row, label, expected in zip(x, y, values):
        raw, prediction = found[(*row, label)]
        assert raw == pytest.approx(expected, abs=1e-9) and prediction == expected.argmax()


def boosted_by_hand(x, y, rounds, depth, rate=0.1):
    """Probabilities after boosting with one tree per class and round, every split tried."""
    classes = y.max() + 1
    scores = np.tile(np.log(np.bincount(y) / len(y)), (len(y), 1))
    cuts = [(f, (a + b) / 2) for f in range(x.shape[1]) for a, b in itertools.pairwise(np.unique(x[:, f]))]

    def steps(rows, lacking, depth):
        best = (1e-15, None)
        for f, cut in cuts if depth else ():
            left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
            if len(left) and len(right):
                gain = len(left) * len(right) / len(rows) * (lacking[left].mean() - lacking[right].mean()) ** 2
                best = (gain, (left, right)) if gain > best[0] * (1 + 1e-9) else best
        if best[1]:
            return [s for side in best[1] for s in steps(side, lacking, depth - 1)]
        curved = (np.abs(lacking[rows]) * (1 - np.abs(lacking[rows]))).sum()
        return [(rows, (classes - 1) / classes * lacking[rows].sum() / curved)]

    def shares():
        grown = np.exp(scores)
        return grown / grown.sum(1, keepdims=True)

    for _ in range(rounds):
        lacking = (y[:, None] == np.arange(classes)) - shares()
        for k in range(classes):
            for rows, step in steps(np.arange(len(y)), lacking[:, k], depth):
                scores[rows, k] += rate * step
    return shares()


def test_boosting_grows_a_tree_per_class_and_round(spark, tmp_path):
    x, y, rows = class_rows(spark)
    model = models.classifiers(boosting_rounds=7)["gradient_boosting"].fit(rows)
    expected = {(*a, b): p for a, b, p in zip(x, y, boosted_by_hand(x, y, 7, 3))}
    model.write().save(str(tmp_path / "boosted"))
    for fitted in (model, type(model).load(str(tmp_path / "boosted"))):
        found = fitted.transform(rows).collect()
        assert len(found) == len(x)
        for r in found:
            assert r.probability.toArray() == pytest.approx(expected[(*r.features, r.label)], abs=1e-9)
            assert r.prediction == r.probability.toArray().argmax()


def test_learners_refuse_rows_without_class(spark):
    rows = spark.createDataFrame([(Vectors.dense([1.0]), 0.0), (Vectors.dense([2.0]), None)], ["features", "label"])
    for name in ("ridge", "gradient_boosting"):
        with pytest.raises(ValueError):
            models.classifiers()[name].fit(rows)


def test_boosting_leaves_out_classes_that_do_not_occur(spark):
    rows = spark.createDataFrame([(Vectors.dense([float(i)]), 3.0 if i > 4 else 1.0) for i in range(10)], ["features", "label"])
    found = models.classifiers(boosting_rounds=2)["gradient_boosting"].fit(rows).transform(rows)
    assert found.where("prediction <> label").count() == 0
    assert [r.probability[0] + r.probability[2] for r in found.collect()] == [0.0] * 10


def test_classifiers_are_fitted_side_by_side(spark):
    met = threading.Barrier(2)

    class Waiting(DecisionTreeClassifier):
        def fit(self, dataset, params=None):
            met.wait(60)
            return super().fit(dataset, params)

    train, test = (client_rows(spark, a, 40).withColumn("y", (F.col("cluster") == "high").cast("int")) for a in (0, 40))
    scores, fitted = models.train_classifiers(train, test, ["income"], "y", {"a": Waiting(seed=1), "b": Waiting(seed=1)}, (False,))
    assert [tuple(r) for r in scores.collect()] == [("a", False, 1.0, 1.0), ("b", False, 1.0, 1.0)] and list(fitted) == [("a", False), ("b", False)]


def test_saved_model_scores_with_training_statistics(spark, tmp_path):
    path = str(tmp_path / "model")
    models.fit_save(client_rows(spark, 0, 200), models.scoring_pipeline(["region"], ["income"], "cluster", DecisionTreeClassifier(seed=1)), path)
    new = spark.createDataFrame([(1, 1.0, "x"), (2, 9.0, "y"), (3, None, "unseen")], "id int, income double, region string")
    got = {r.id: r.predicted_cluster for r in models.score_clients(path, new, "cluster").collect()}
    assert got[1] == "low" and got[2] == "high" and got[3] in ("low", "high")


def test_model_rows_are_built_once(spark):
    from daybook.plans import client_queries

    rows = [(i, i % 3, None if i % 5 == 0 else float(i * 400), "AB"[i % 2]) for i in range(1, 41)]
    customer = spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string")
    pages = spark.createDataFrame([(1, "http://a.example.org")], "page_id long, url string")
    train, test = client_queries.model_rows(SimpleNamespace(spark=spark, customer=customer, pages=pages))
    for part in (train, test):  # each model plans and reads stored rows
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan
    assert train.count() + test.count() == 40 and train.columns[3:] == client_queries.MODEL_COLUMNS
    assert {r.country for r in train.union(test).collect()} == {0, 1, 2}


def test_classifier_query_uses_the_defaults(monkeypatch):
    from daybook.plans import client_queries

    monkeypatch.setattr(client_queries, "model_rows", lambda t: ("train", "test"))
    monkeypatch.setattr(client_queries.models, "train_classifiers", lambda *a, **k: [(a, k)])
    assert client_queries.train_classifiers(None) == (("train", "test", client_queries.MODEL_COLUMNS, "predicted_cluster"), {})


def test_elbow_is_fitted_in_few_tasks(spark, monkeypatch):
    tasks = []

    class Watched(segments.KMeans):
        def fit(self, dataset, params=None):
            tasks.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset, params)

    monkeypatch.setattr(segments, "KMeans", Watched)
    df = spark.range(400).selectExpr("double(id % 3 * 10) AS x", "double(id % 7) AS y").repartition(40)
    assert [r.k for r in segments.elbow(df, ["x", "y"], range(1, 4)).orderBy("k").collect()] == [1, 2, 3]
    assert len(tasks) == 2 and max(tasks) <= 8
