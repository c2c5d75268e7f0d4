"""Purged split, least squares, metrics, promotion, scoring and labels."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.operators import modelling, predictions
from tickflow.operators.modelling import TreeSpec
from tickflow.plans import scoring, training
from tickflow.session import scratch_path
from tickflow.spec import BarSpec

T0 = datetime(2024, 3, 5)


def gold_rows(spark, n=200, products=("A-USD", "B-USD"), label=None, seed=41):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        for p in products:
            t = T0 + timedelta(minutes=i)
            rv = [rng.lognormvariate(-7, 0.4) for _ in range(4)]
            y = label(rv) if label else rng.lognormvariate(-7, 0.4)
            flow = [rng.random() for _ in range(3)]
            imb = None if i % 11 == 3 else rng.triangular(-1, 1)
            rows.append(
                (p, t, t + timedelta(minutes=5), *rv, *flow, imb, 5, 1.0, 2.0, imb, 300, y, 300, T0)
            )
    return spark.createDataFrame(rows, schemas.GOLD)


def test_split_purges_straddling_rows(spark):
    rows = gold_rows(spark)
    train, test, cut = modelling.time_split(rows)
    assert cut == T0 + timedelta(minutes=160)
    a = train.agg(F.max("label_ts"), F.countDistinct("product_id"), F.count("*")).first()
    b = test.agg(F.min("as_of_ts"), F.countDistinct("product_id"), F.count("*")).first()
    assert a[0] <= cut <= b[0] and a[1] == b[1] == 2
    assert a[2] + b[2] < rows.count()


def test_least_squares_recovers_the_line(spark):
    beta = (0.2, -0.1, 0.6, 0.25)
    rows = gold_rows(spark, 500, label=lambda rv: sum(b * x for b, x in zip(beta, rv)) + 3e-4)
    got = modelling.har_coefficients(modelling.fit_har(rows))
    for name, want in zip((*schemas.HAR_FEATURES, "intercept"), (*beta, 3e-4)):
        assert abs(got[name] - want) < 1e-8


def test_least_squares_equals_numpy_and_moments(spark):
    rows = gold_rows(spark, 300).cache()
    got = modelling.har_coefficients(modelling.fit_har(rows))
    data = rows.select(*schemas.HAR_FEATURES, schemas.LABEL).toPandas().to_numpy()
    x = np.column_stack([data[:, :4], np.ones(len(data))])
    want, *_ = np.linalg.lstsq(x, data[:, 4], rcond=None)
    assert np.allclose([got[c] for c in (*schemas.HAR_FEATURES, "intercept")], want, atol=1e-8)
    m = modelling.har_moments(rows).first()
    assert math.isclose(m["s_rv_1m_rv_5m"], float(data[:, 0] @ data[:, 1]), rel_tol=1e-9)


def test_metrics(spark):
    df = spark.createDataFrame(
        [("A-B", 1.0, 1.0), ("A-B", 2.0, 2.0), ("C", 3.0, 5.0)],
        "product_id string, label_rv_5m double, m double",
    )
    metrics = modelling.evaluate(df, ["m"])
    got = {r.product_id: (r.n, r.mae, r.rmse) for r in metrics.collect()}
    assert math.isclose(got[None][1], 2 / 3) and math.isclose(got[None][2], math.sqrt(4 / 3))
    assert got["A-B"] == (2, 0.0, 0.0) and got["C"] == (1, 2.0, 2.0)
    names = {r.metric for r in modelling.metric_names(metrics).collect()}
    assert names == {"m_mae", "m_rmse", "m_mae_A_B", "m_mae_C"}


def test_skill_is_null_on_a_perfect_baseline(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 1.0, 2.0)], "product_id string, label_rv_5m double, persistence double, m double"
    )
    skills = modelling.model_skill(modelling.evaluate(df, ["persistence", "m"]))
    assert all(r.skill is None for r in skills.collect())


@pytest.mark.parametrize(
    "skill, versions, status, version",
    [
        (0.1, ["1", "10", "9"], "promoted", 11),
        (0.0, ["1"], "promoted", 2),
        (-0.1, ["1"], "rejected", None),
        (-0.1, [], "promoted", 1),
        (None, ["1"], "rejected", None),
    ],
)
def test_promotion(spark, skill, versions, status, version):
    skills = spark.createDataFrame([("trees", skill)], "model string, skill double")
    registry = spark.createDataFrame([(v,) for v in versions], "version string")
    row = modelling.promotion(skills, registry, "trees").first()
    assert (row.status, row.version) == (status, version)
    assert row.reason == ("skill_gate" if versions else "bootstrap")


@pytest.fixture(scope="module")
def run(spark):
    noisy = lambda rv: 0.6 * rv[1] + 0.4 * rv[3]
    rows = gold_rows(spark, 200, label=noisy)
    registry = spark.createDataFrame([("4",)], "version string")
    return training.train(rows, registry, BarSpec(), TreeSpec(trees=12, learning_rate=0.3)), rows


def test_training_run(run):
    outcome, _ = run
    assert outcome.status == "promoted"
    assert outcome.decision.first().version == 5
    assert outcome.metrics.count() == 9  # three models: overall and two products
    counts = {r.n for r in outcome.metrics.where("product_id IS NULL").collect()}
    assert len(counts) == 1  # identical test rows
    record = outcome.record.first()
    assert '"trees": "12"' in record.params and record.status == "promoted"


def test_importances(spark, run):
    found = modelling.importances(run[0].trees, spark).collect()
    assert len(found) == len(modelling.TREE_INPUTS)
    assert {found[0].feature, found[1].feature} == {"rv_5m", "rv_60m"}
    assert math.isclose(sum(r.importance for r in found), 1.0, rel_tol=1e-9)


def test_too_few_rows(spark):
    registry = spark.createDataFrame([], "version string")
    assert training.train(gold_rows(spark, 20), registry).status == "insufficient_data"


def test_scoring_is_idempotent_and_skips_low_coverage(spark, run):
    outcome, rows = run
    features = rows.withColumn(
        "bar_count_5m", F.when(F.col("product_id") == "A-USD", 249).otherwise(250).cast("long")
    )
    target = scoring.prediction_table(scratch_path(spark, "t-preds"))
    target.publish(spark.createDataFrame([], schemas.PREDICTION))
    now = F.lit(T0).cast("timestamp_ntz")
    twice = features.unionByName(features)
    sent = [
        scoring.score_new(spark, rows, outcome.trees, "5", target, now).count()
        for rows in (twice, features)
    ]
    stored = target.read(spark)
    assert stored.count() == 200 and sent == [200, 0]
    row = stored.orderBy("as_of_ts").first()
    assert row.product_id == "B-USD" and row.model_version == "5"
    assert row.label_ts - row.as_of_ts == timedelta(minutes=5)
    assert '"rv_5m"' in row.features and row.pred_rv > 0


def test_labels_and_accuracy(spark):
    rows = [("A", T0 + timedelta(minutes=m), float(m)) for m in range(0, 20)]
    features = spark.createDataFrame(
        rows, "product_id string, as_of_ts timestamp_ntz, rv_5m double"
    ).withColumn("bar_count_5m", F.lit(300))
    preds = predictions.prediction_rows(features, F.col("rv_5m") + 4, F.lit("v"))
    labeled = predictions.label_join(preds, features.unionByName(features))
    found = {r.as_of_ts.minute: r.label_rv for r in labeled.collect()}
    assert found[3] == 8.0 and found[14] == 19.0 and found[15] is None
    now = F.lit(T0 + timedelta(minutes=19)).cast("timestamp_ntz")
    a = predictions.accuracy(labeled, now, minutes=10).first()
    # as_of > now - 10 min leaves minutes 10..14; errors are 1 and 5.
    assert (a.n_labeled, a.model_mae, a.persistence_mae, a.skill_vs_persistence) == (5, 1, 5, 0.8)
    series = predictions.rolling_accuracy(labeled, 3, BarSpec(chunk_steps=65)).count()
    assert series == 15
    assert predictions.latest_per_product(preds).first().as_of_ts == T0 + timedelta(minutes=19)


def test_rolling_windows_longer_than_a_chunk(spark):
    rows = [("A", T0 + timedelta(minutes=m), float(m * m % 97), 0.0, 1.0) for m in range(400)]
    labeled = spark.createDataFrame(
        rows, "product_id string, as_of_ts timestamp_ntz, pred_rv double, label_rv double, "
        "pred_persistence double"
    )
    got = predictions.rolling_accuracy(labeled, 300, BarSpec(chunk_steps=70)).collect()
    errors = [r[2] for r in rows]
    for r in got:
        m = int((r.as_of_ts - T0).total_seconds()) // 60
        own = errors[max(m - 299, 0) : m + 1]
        assert math.isclose(r.model_mae, sum(own) / len(own))
    assert len(got) == 400


def test_first_write_wins_inside_a_batch(spark):
    rows = spark.createDataFrame(
        [("A", T0, 1.0), ("A", T0, 2.0), ("B", T0, 3.0)],
        "product_id string, as_of_ts timestamp_ntz, pred_rv double",
    )
    got = predictions.only_new(rows, rows.where("product_id = 'B'")).collect()
    assert [(r.product_id, r.pred_rv) for r in got] == [("A", 1.0)]


def test_the_first_label_wins_and_late_features_label_once(spark):
    start = datetime(2024, 3, 5, 23, 40)
    at = lambda m: start + timedelta(minutes=m)
    made = spark.createDataFrame([("A", at(m)) for m in range(30)], "product_id string, as_of_ts timestamp_ntz")
    feature = lambda rows: spark.createDataFrame(
        [("A", at(m), v) for m, v in rows], "product_id string, as_of_ts timestamp_ntz, rv_5m double"
    )
    store = scoring.label_table(scratch_path(spark, "t-labels"))
    now = lambda h: F.lit(f"2024-03-06 0{h}:00:00").cast("timestamp_ntz")
    assert scoring.label_new(spark, made, feature([(5, 1.0), (6, 2.0), (7, None)]), store, now(1)).count() == 2
    assert scoring.label_new(spark, made, feature([(5, 9.0), (6, 2.0)]), store, now(2)).count() == 0
    assert scoring.label_new(spark, made, feature([(7, 3.0), (29, 4.0), (99, 5.0)]), store, now(3)).count() == 2
    assert scoring.label_new(spark, made, feature([]), store, now(4)).count() == 0
    rows = {r.as_of_ts: (r.label_rv, r.labeled_at.hour) for r in store.read(spark).collect()}
    assert rows == {at(0): (1.0, 1), at(1): (2.0, 1), at(2): (3.0, 3), at(24): (4.0, 3)}
    shown = predictions.with_labels(made, store.read(spark)).where("label_rv IS NOT NULL")
    assert shown.count() == 4


def test_the_first_arrival_wins_and_old_days_stay_closed(spark):
    rows = spark.createDataFrame(
        [("A", T0, 9.0, 1), ("A", T0, 2.0, 2), ("B", T0, 5.0, 3)],
        "product_id string, as_of_ts timestamp_ntz, pred_rv double, seq long",
    )
    known = rows.where("product_id = 'B'")
    by_arrival = predictions.only_new(rows, known, F.col("seq")).collect()
    assert [(r.product_id, r.pred_rv) for r in by_arrival] == [("A", 9.0)]
    assert [r.pred_rv for r in predictions.only_new(rows, known).collect()] == [2.0]
    keys = rows.select("product_id", "as_of_ts")
    assert predictions.only_new(keys, keys.limit(0)).count() == 2
    table = scoring.prediction_table(scratch_path(spark, "t-known"))
    wide = rows.select("product_id", "as_of_ts", "pred_rv", *[
        F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.PREDICTION.fields[2:] if f.name != "pred_rv"
    ])
    table.publish(wide.unionByName(wide.withColumn("as_of_ts", F.col("as_of_ts") + F.make_dt_interval(F.lit(9)))))
    found = scoring.on_days_of(table.read(spark), rows)
    assert "PartitionFilters: [isnotnull(as_of_date" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 3
