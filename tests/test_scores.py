import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import ref, rows_of
from tidewatch.functions import columns as fc
from tidewatch.plans import attribution as at
from tidewatch.plans import evaluation as ev
from tidewatch.plans import scoring as sc
from tidewatch.settings import Settings

SETTINGS = Settings()
SCORED = "dealer_code string, true_label int, predicted_label int, churn_probability double, dataset string"


def scored(spark, n=300):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        p = round(rng.random(), 2)
        rows.append((str(i), int(rng.random() < p), int(p >= 0.5), p, "test" if i % 3 == 0 else "train"))
    return spark.createDataFrame(rows, SCORED), rows


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.00005, 0.3, 0.30001, 0.7, 0.70001, 1.0)], "p double")
    p = fc.clamp_score(F.col("p"), 1e-4)
    got = rows_of(df.select(p.alias("p"), fc.risk_band(p).alias("b")))
    assert got == [(0.0, "Low Risk"), (0.0, "Low Risk"), (0.3, "Low Risk"), (0.30001, "Medium Risk"),
                   (0.7, "Medium Risk"), (0.70001, "High Risk"), (1.0, "High Risk")]


def test_exact_seven_tenths_is_high_risk_but_medium_band(spark):
    frame = spark.createDataFrame([("a", 1, 0.7), ("b", 1, 0.69999)], "dealer_code string, predicted_churn int, churn_probability double")
    results = sc.prediction_results(frame, ref("2024-05-31"), SETTINGS)
    assert rows_of(sc.high_risk(results, SETTINGS).select("dealer_code", "risk_category")) == [("a", "Medium Risk")]
    assert results.first()["prediction_timestamp"] == "2024-05-31 00:00:00"


def test_auc_and_curve_against_pair_counting(spark):
    df, rows = scored(spark)
    got = dict(rows_of(ev.roc_auc(df)))
    for side in ("train", "test"):
        pos = [r[3] for r in rows if r[4] == side and r[1] == 1]
        neg = [r[3] for r in rows if r[4] == side and r[1] == 0]
        wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
        assert got[side] == pytest.approx(wins / len(pos) / len(neg), abs=1e-12)
        curve = {r["threshold"]: (r["fpr"], r["tpr"]) for r in ev.roc_curve(df).filter(F.col("dataset") == side).collect()}
        assert curve.pop(None) == (0.0, 0.0)
        for t, (fpr, tpr) in curve.items():
            assert fpr == pytest.approx(sum(x >= t for x in neg) / len(neg))
            assert tpr == pytest.approx(sum(x >= t for x in pos) / len(pos))


def test_report_with_an_absent_class(spark):
    df = spark.createDataFrame([("a", 0, 0, 0.1, "x"), ("b", 0, 1, 0.9, "x")], SCORED)
    got = {r["label"]: r for r in ev.class_report(df).collect()}
    assert (got["0"]["precision"], got["0"]["recall"], got["1"]["precision"], got["1"]["recall"]) == (1.0, 0.5, 0.0, 0.0)
    assert got["accuracy"]["f1_score"] == 0.5 and got["weighted avg"]["recall"] == 0.5
    assert rows_of(ev.roc_auc(df)) == [("x", None)]
    cells = {(r[1], r[2]): r[3] for r in rows_of(ev.confusion_matrix(df))}
    assert cells == {(0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 0}


def test_spark_evaluators_agree(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    df, _ = scored(spark)
    one = df.withColumn("dataset", F.lit("all"))
    ours = {r["metric"]: r["value"] for r in ev.metrics_long(one).collect()}
    typed = one.select(F.col("true_label").cast("double"), F.col("predicted_label").cast("double"), "churn_probability")
    for name, spark_name in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1_score", "f1")):
        theirs = MulticlassClassificationEvaluator(labelCol="true_label", predictionCol="predicted_label", metricName=spark_name).evaluate(typed)
        assert ours[name] == pytest.approx(theirs, abs=1e-9)
    auc = BinaryClassificationEvaluator(labelCol="true_label", rawPredictionCol="churn_probability", numBins=0).evaluate(typed)
    assert ours["roc_auc"] == pytest.approx(auc, abs=1e-9)


def test_error_statistics(spark):
    df, rows = scored(spark)
    errors = ev.prediction_errors(ev.prediction_summary_vs_truth(df, SETTINGS))
    stats = ev.error_statistics(errors).first()
    wrong = [r for r in rows if r[1] != r[2]]
    assert stats["n_errors"] == len(wrong) == errors.count()
    assert stats["n_false_positive"] == sum(r[2] for r in wrong)
    assert stats["median_confidence"] == pytest.approx(np.median([r[3] for r in wrong]))


def contributions(spark):
    rows = [("a", 1, [("x", 1.0, 0.5), ("y", 2.0, -0.7), ("z", 3.0, 0.1), ("w", 0.0, 0.0)]),
            ("b", 0, [("x", 1.0, -0.5), ("y", 2.0, -0.5), ("z", 3.0, 0.2), ("w", 0.0, 0.0)])]
    return spark.createDataFrame(
        rows, "dealer_code string, predicted_churn int, contributions array<struct<feature:string,value:double,contribution:double>>")


def test_explanations_are_ordered(spark):
    explained = at.explanations(contributions(spark), Settings(top_features=2))
    # A collected Python dict loses the order of a map; its entries keep it.
    entries = explained.withColumns({c: F.map_entries(c) for c in at.MAP_COLUMNS})
    got = {r["dealer_code"]: r for r in entries.collect()}
    a = got["a"]
    assert [tuple(e) for e in a["positive_features"]] == [("x", 0.5), ("z", 0.1)]
    assert [tuple(e) for e in a["negative_features"]] == [("y", -0.7)]
    assert [tuple(e) for e in a["top_features"]] == [("y", 0.7), ("x", 0.5)]
    assert a["total_positive_impact"] == pytest.approx(0.6) and a["net_impact"] == pytest.approx(-0.1)
    assert [tuple(e) for e in got["b"]["top_features"]] == [("x", 0.5), ("y", 0.5)]


def test_json_maps_survive(spark):
    explained = at.explanations(contributions(spark), SETTINGS)
    back = at.maps_from_json(at.maps_to_json(explained))
    assert {r["dealer_code"]: r["positive_features"] for r in back.collect()} == {
        r["dealer_code"]: r["positive_features"] for r in explained.collect()}


def test_drivers_and_global(spark):
    explained = at.explanations(contributions(spark), SETTINGS)
    got = [(r["feature"], r["count"]) for r in at.churn_drivers(explained).collect()]
    assert got == [("x", 1), ("z", 2)]
    assert rows_of(at.global_attribution(contributions(spark), SETTINGS))[0] == ("y", pytest.approx(0.6))
    top = rows_of(at.top_contributions(contributions(spark), 1), "dealer_code")
    assert [(r[0], r[1], r[2]) for r in top] == [("a", 1, "y"), ("b", 1, "x")]


def test_run_stamp_crosses_midnight(spark):
    df = spark.sql("select timestamp'2024-05-31 18:29:00' a, timestamp'2024-05-31 18:30:00' b")
    got = df.select(sc.run_stamp(F.col("a"), "Asia/Kolkata"), sc.run_stamp(F.col("b"), "Asia/Kolkata")).first()
    assert [str(v) for v in got] == ["2024-05-31", "2024-06-01"]


def test_top_features_are_those_of_a_full_sort(spark):
    """Also where zeros, unknown values or values that are no numbers are among the first."""
    nan = float("nan")
    rows = {"many": [0.5, -3.0, 0.0, 2.0, -0.5, 0.0], "few": [0.0, 0.0, -1.0, 0.0, -0.0, 0.0],
            "none": [0.0] * 6, "odd": [nan, None, 0.0, 1.0, nan, nan], "nans": [nan, nan, nan, nan, 0.0, 0.0]}
    names = list("fedcba")
    table = [(k, [(f, 1.0, c) for f, c in zip(names, v)]) for k, v in rows.items()]
    schema = "dealer_code string, contributions array<struct<feature string, value double, contribution double>>"
    got = at.explanations(spark.createDataFrame(table, schema), Settings(top_features=3)).select(
        "dealer_code", F.map_keys("top_features").alias("top")).collect()
    rank = lambda c: (-2.0, 0.0) if c is None else (1.0, 0.0) if c != c else (0.0, -abs(c))
    want = {k: [f for _, f in sorted((rank(c), f) for f, c in zip(names, v))][:3] for k, v in rows.items()}
    assert {r["dealer_code"]: r["top"] for r in got} == want
