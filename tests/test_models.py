import itertools
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import ref, rows_of
from tidewatch.operators import prepare as pp
from tidewatch.plans import jobs
from tidewatch.plans import training as tr
from tidewatch.plans import trees
from tidewatch.settings import RANDOM_SPACE, Settings
from tidewatch.sources import versions

SETTINGS = Settings(cv_folds=2, search_draws=2)
NAMES = ["f0", "f1", "f2", "f3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 4)).round(3)
    noise = rng.normal(size=300) * 0.3
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 0) + noise > 0.4).astype(int)
    rows = [(str(i), *map(float, x[i]), int(y[i])) for i in range(300)]
    schema = "dealer_code string, f0 double, f1 double, f2 double, f3 double, churn_status int"
    return pp.with_split(spark.createDataFrame(rows, schema), SETTINGS).repartition(3).cache()


@pytest.fixture(scope="module")
def model(data):
    return tr.fit_model(data.filter("dataset = 'train'"), NAMES, SETTINGS, {"n_estimators": 5, "max_depth": 4})


def test_defaults_are_overridden():
    given = tr.spec(Settings(), {"gamma": 0.1, "min_child_weight": 3})
    assert (given.value("gamma"), given.value("min_child_weight"), given.value("subsample"), given.value("max_depth")) == (0.1, 3, 0.8, 6)
    assert (given.value("reg_lambda"), given.seed) == (1.0, Settings().seed)


def test_draws_are_distinct_and_repeatable():
    a = tr.draw_points(RANDOM_SPACE, 20, 42)
    assert a == tr.draw_points(RANDOM_SPACE, 20, 42) and len({str(p) for p in a}) == 20
    assert len(tr.grid_points({"a": [1, 2], "b": [3, 4, 5]})) == 6


def test_weight_balances_the_classes(data):
    sums = {r[0]: r[1] for r in tr.weighted(data).groupBy("churn_status").agg(F.sum("_weight")).collect()}
    assert sums[0] == pytest.approx(sums[1])


def test_scores_and_importances(spark, data, model):
    scored = tr.score(model, data, NAMES)
    assert scored.columns == ["dealer_code", "churn_status", "dataset", "predicted_churn", "churn_probability"]
    row = scored.agg(F.min("churn_probability"), F.max("churn_probability"), F.count("*")).first()
    assert 0 <= row[0] < row[1] <= 1 and row[2] == 300
    imp = tr.importances(spark, model, NAMES)
    assert [r["feature"] for r in imp.collect()][0] in ("f0", "f1") and imp.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert tr.importance_cut(imp, 0.75).count() == 1


def test_contributions_add_up_to_the_log_odds(spark, data, model):
    scored = tr.score(model, data, NAMES, keep=NAMES)
    parts, base = trees.tree_contributions(model, scored, NAMES)
    rows = parts.select("churn_probability", F.aggregate("contributions", F.lit(0.0), lambda a, e: a + e["contribution"]).alias("s")).collect()
    for r in rows:
        log_odds = np.log(r["churn_probability"] / (1 - r["churn_probability"]))
        assert r["s"] + base == pytest.approx(log_odds, abs=1e-8)


def test_contributions_equal_shapley_values_by_enumeration(spark, data, model):
    leaves = trees.read_leaves(model)

    def value(x, known):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for f, lo, hi, z in zip(leaf.features, leaf.lower, leaf.upper, leaf.share):
                part *= float(lo < x[f] <= hi) if f in known else z
            total += part
        return total

    x = np.array([[r[n] for n in NAMES] for r in data.orderBy("dealer_code").limit(6).collect()])
    got = trees.contributions_of(leaves, x)
    for row, phi in zip(x, got):
        for i in range(4):
            others = [j for j in range(4) if j != i]
            want = sum(
                factorial(k) * factorial(3 - k) / factorial(4) * (value(row, {*s, i}) - value(row, set(s)))
                for k in range(4) for s in itertools.combinations(others, k)
            )
            assert phi[i] == pytest.approx(want, abs=1e-10)


def test_folds_hold_every_class_evenly(spark, data):
    rows = tr.with_folds(data, Settings(cv_folds=5)).groupBy("churn_status", "_fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in rows if r["churn_status"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_search_keeps_base_parameters(spark, data):
    train = data.filter("dataset = 'train'")
    found = tr.grid_search(train, NAMES, SETTINGS, {"n_estimators": [1, 4], "max_depth": [3]})
    assert found.best_score == max(s for _, s in found.scores) and len(found.scores) == 2
    assert found.frame(spark).count() == 2
    space = {**RANDOM_SPACE, "n_estimators": [2], "max_depth": [2, 3]}
    model, chosen = tr.train_tuned(train, NAMES, SETTINGS, space, {"n_estimators": [2], "max_depth": [2]})
    assert chosen["max_depth"] == 2 and {"gamma", "min_child_weight"} <= set(chosen)
    assert len(model.trees) == 2 and max(len(t.feature) for t in model.trees) <= 7


def test_full_spaces_share_fits():
    from tidewatch.settings import GRID_SPACE

    grid = tr.grid_points(GRID_SPACE)
    assert (len(grid), len(tr.ensembles(grid))) == (48, 24)


def test_model_and_state_persist(spark, data, model, tmp_path):
    codes = spark.createDataFrame([("a", 0), (None, 1)], "territory_code string, territory_code_encoded int")
    codes.write.parquet(str(tmp_path / "codes"))
    state = pp.PrepState({"zone": []}, str(tmp_path / "codes"), NAMES)
    path = tr.save_model(model, state, str(tmp_path / "m"))
    loaded, back = tr.load_model(spark, path)
    assert (back.categories, back.features) == (state.categories, state.features)
    assert sorted(rows_of(back.codes(spark)), key=str) == sorted(rows_of(codes), key=str)
    a = rows_of(tr.score(model, data, NAMES), "dealer_code")
    assert a == rows_of(tr.score(loaded, data, NAMES), "dealer_code")


def test_failed_save_leaves_the_old_pair(spark, data, model, tmp_path, monkeypatch):
    spark.createDataFrame([("a", 0)], "territory_code string, territory_code_encoded int").write.parquet(str(tmp_path / "codes"))
    state = pp.PrepState({"zone": []}, str(tmp_path / "codes"), NAMES)
    path = tr.save_model(model, state, str(tmp_path / "m"))
    other = model.first(2)
    monkeypatch.setattr(pp.PrepState, "save", lambda *a: (_ for _ in ()).throw(RuntimeError("disk full")))
    with pytest.raises(RuntimeError):
        tr.save_model(other, state, path)
    monkeypatch.undo()
    loaded, _ = tr.load_model(spark, path)
    assert len(loaded.trees) == 5 and len(versions.folders(spark, path)) == 2
    tr.save_model(other, state, path)
    assert len(tr.load_model(spark, path)[0].trees) == 2
    versions.prune(spark, path, keep=1)
    assert len(versions.folders(spark, path)) == 1 and len(tr.load_model(spark, path)[0].trees) == 2
    with pytest.raises(FileNotFoundError):
        tr.load_model(spark, str(tmp_path / "none"))


def test_daily_job_can_run_again(spark, tmp_path):
    """The day twice, and once with a failing second table: each account is read once, with the rows of the last whole run."""
    from checks.queries import Inputs
    from tests.conftest import SF_SMALL

    x = Inputs(spark, SF_SMALL)
    out, small = str(tmp_path / "daily"), {"n_estimators": 2, "max_depth": 2}
    for _ in range(2):
        jobs.daily_job(spark, x.catalog, x.settings, out, ref("2001-06-30"), small)
    n = x.stored_features.filter("last_billed_days <= 365").count()
    predictions = jobs.read_daily(spark, out, "predictions")
    assert predictions.count() == predictions.select("dealer_code").distinct().count() == n
    assert [str(r[0]) for r in predictions.select("run_date").distinct().collect()] == ["2001-06-30"]
    with pytest.raises(Exception):
        broken = {"explanations": predictions.limit(1), "predictions": predictions.withColumn("x", F.raise_error(F.lit("no")))}
        versions.publish_day(spark, out, "2001-06-30", broken)
    assert jobs.read_daily(spark, out, "explanations").count() == n == jobs.read_daily(spark, out, "predictions").count()
    versions.publish_day(spark, out, "2001-07-01", {"explanations": predictions.limit(1).select("dealer_code"),
                                                    "predictions": predictions.limit(2).withColumn("new", F.lit(1))})
    both = jobs.read_daily(spark, out, "predictions")
    assert both.count() == n + 2 and both.where("new = 1").count() == 2


def test_training_and_scoring_jobs(spark, tmp_path):
    """Quick training on the smallest data set, saved, loaded again and used."""
    import dataclasses

    from checks.queries import Inputs
    from tests.conftest import SF_SMALL

    x = Inputs(spark, SF_SMALL)
    settings = dataclasses.replace(x.settings, cv_folds=2, search_draws=1)
    spaces = ({"n_estimators": [2], "max_depth": [2]}, {"n_estimators": [2], "max_depth": [3]})
    trained, paths = jobs.run_training(spark, x.stored_features, settings, str(tmp_path), spaces=spaces)
    metrics = spark.read.option("header", "true").csv(paths["metrics"])
    assert {r["metric"] for r in metrics.collect()} == {"accuracy", "precision", "recall", "f1_score", "roc_auc"}
    assert spark.read.option("header", "true").csv(paths["importances"]).count() == len(trained.state.features)
    for name in ("class_report", "confusion_matrix", "class_distribution", "roc_curve"):
        assert spark.read.option("header", "true").csv(paths[name]).count() > 0
    explained = spark.read.option("header", "true").csv(paths["explanations"])
    assert explained.where("base_value IS NULL").count() == 0 and explained.count() > 0
    as_of = ref("2001-06-30")
    saved, summary = jobs.run_scoring(spark, x.stored_features, paths["model"], settings, str(tmp_path / "p"), as_of)
    recent = x.stored_features.filter("last_billed_days <= 365").count()
    assert saved.count() == recent == summary.first()["n_accounts"]
    one = saved.first()["dealer_code"]
    listed, _ = jobs.run_scoring(spark, x.stored_features, paths["model"], settings, str(tmp_path / "q"), as_of, [one, "none"])
    assert [r["dealer_code"] for r in listed.collect()] == [one]
    assert set(trained.state.features) <= set(listed.columns)
