"""The user-level jobs: train, score, explain, and the daily run of all three."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import prepare as pp
from tidewatch.plans import attribution as at
from tidewatch.plans import evaluation as ev
from tidewatch.plans import scoring as sc
from tidewatch.plans import training as tr
from tidewatch.plans import trees
from tidewatch.plans.boosting import Booster
from tidewatch.plans.features import build_features
from tidewatch.session import job_folder, stage
from tidewatch.settings import Settings
from tidewatch.sources import sinks, versions
from tidewatch.sources.tables import Catalog


@dataclass(frozen=True)
class Trained:
    """A fitted model with what is needed to use it."""

    model: Booster
    state: pp.PrepState
    params: dict
    prepared: DataFrame  # key, features, target, dataset


def prepare(features: DataFrame, settings: Settings) -> tuple[DataFrame, pp.PrepState]:
    """Prepared rows with their split, written once because training reads them often; the features are read several times."""
    state = pp.fit_preparation(features, settings)
    split = pp.with_split(pp.prepare_training(features, state, settings), settings, stored=True)
    return stage(split, "prepared"), state


def _train_rows(prepared: DataFrame) -> DataFrame:
    return prepared.filter(F.col("dataset") == "train")


def train_quick(features: DataFrame, settings: Settings, params: Mapping[str, float] | None = None) -> Trained:
    """One fit with the given or default parameters."""
    prepared, state = prepare(features, settings)
    model = tr.fit_model(_train_rows(prepared), state.features, settings, params)
    return Trained(model, state, dict(params or {}), prepared)


def train_tuned(
    features: DataFrame,
    settings: Settings,
    random_space: Mapping[str, Sequence] = tr.RANDOM_SPACE,
    grid_space: Mapping[str, Sequence] = tr.GRID_SPACE,
    resume: str | None = None,
) -> Trained:
    """Random search, grid search and the final fit; ``resume`` keeps the scores for a driver that starts again."""
    prepared, state = prepare(features, settings)
    model, chosen = tr.train_tuned(_train_rows(prepared), state.features, settings, random_space, grid_space, resume)
    return Trained(model, state, chosen, prepared)


def scored_truth(trained: Trained) -> DataFrame:
    """Train and test rows with label and prediction."""
    return tr.with_truth(tr.score(trained.model, trained.prepared, trained.state.features))


def evaluate(trained: Trained) -> DataFrame:
    """Long metrics table of the train and test rows."""
    return ev.metrics_long(scored_truth(trained))


def evaluation_tables(trained: Trained) -> dict[str, DataFrame]:
    """Everything a trained model is judged by; rows are scored once."""
    truth = stage(scored_truth(trained), "truth")
    return {
        "metrics": ev.metrics_long(truth),
        "class_report": ev.class_report(truth),
        "confusion_matrix": ev.confusion_matrix(truth),
        "class_distribution": ev.class_distribution(truth, "true_label"),
        "roc_curve": ev.roc_curve(truth),
    }


def score_all(
    features: DataFrame,
    model: Booster,
    state: pp.PrepState,
    as_of: Column,
    settings: Settings,
    *,
    include_features: bool = False,
) -> DataFrame:
    """Prediction table of all recent accounts."""
    ready = pp.prepare_scoring(features, state, settings)
    keep = state.features if include_features else ()
    return sc.prediction_results(tr.score(model, ready, state.features, keep), as_of, settings)


def score_accounts(
    features: DataFrame,
    codes: Sequence[str],
    model: Booster,
    state: pp.PrepState,
    as_of: Column,
    settings: Settings,
) -> DataFrame:
    """Prediction table of the listed accounts, with their features."""
    listed = sc.for_accounts(features, codes)
    return score_all(listed, model, state, as_of, settings, include_features=True)


def contributions(spark: SparkSession, trained: Trained, rows: DataFrame) -> tuple[DataFrame, float]:
    """Contributions of prepared rows, with the prediction beside them."""
    names = trained.state.features
    scored = tr.score(trained.model, rows, names, keep=names)
    return trees.tree_contributions(trained.model, scored, names)


def explain_all(
    spark: SparkSession, trained: Trained, settings: Settings, dataset: str | None = "test"
) -> tuple[DataFrame, DataFrame]:
    """Explanations and churn drivers of the test rows, or of all rows.

    ``base_value`` is the log-odds that an account's contributions start from.  The explanations are written
    once, because attribution is the dearest step and both results read it.
    """
    rows = trained.prepared
    if dataset:
        rows = rows.filter(F.col("dataset") == dataset)
    parts, base = contributions(spark, trained, rows)
    explained = stage(at.explanations(parts, settings).withColumn("base_value", F.lit(base)), "explained")
    return explained, at.churn_drivers(explained)


def run_training(
    spark: SparkSession,
    features: DataFrame,
    settings: Settings,
    out: str,
    *,
    params: Mapping[str, float] | None = None,
    spaces: tuple[Mapping[str, Sequence], Mapping[str, Sequence]] | None = None,
) -> tuple[Trained, dict[str, str]]:
    """Train (searching the two spaces when given), evaluate, explain and save everything."""
    features = stage(features, "features")
    trained = (
        train_tuned(features, settings, *spaces, resume=f"{out}/search") if spaces else train_quick(features, settings, params)
    )
    explained, drivers = explain_all(spark, trained, settings)
    paths = {
        "model": tr.save_model(trained.model, trained.state, f"{out}/fitted"),
        **{name: sinks.write_csv(df, f"{out}/{name}") for name, df in evaluation_tables(trained).items()},
        "importances": sinks.save_importances(
            tr.importances(spark, trained.model, trained.state.features), f"{out}/importances"
        ),
        "explanations": sinks.save_explanations(explained, f"{out}/explanations"),
        "drivers": sinks.write_csv(drivers, f"{out}/drivers"),
    }
    return trained, paths


def run_scoring(
    spark: SparkSession,
    features: DataFrame,
    fitted: str,
    settings: Settings,
    out: str,
    as_of: Column,
    codes: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Score with a saved model, write the predictions, and return them with their summary.

    With ``codes`` only those accounts are scored, and their features kept.
    """
    model, state = tr.load_model(spark, fitted)
    if codes is None:
        results = score_all(features, model, state, as_of, settings)
    else:
        results = score_accounts(features, codes, model, state, as_of, settings)
    saved = spark.read.schema(results.schema).option("header", "true").csv(
        sinks.save_predictions(results, out)
    )
    return saved, sc.prediction_summary(saved)


DAILY_TABLES = ("explanations", "predictions")


def daily_job(
    spark: SparkSession,
    catalog: Catalog,
    settings: Settings,
    out: str,
    as_of: Column,
    params: Mapping[str, float] | None = None,
) -> str:
    """Features, training, explanations and predictions, added to two tables as the rows of the day of ``as_of``.

    The day becomes visible with both tables or not at all, and a day that runs again replaces its rows
    (:func:`read_daily`).  Everything staged on the way is removed when both are written.
    """
    with job_folder(spark, "daily-job"):
        day = spark.range(1).select(F.date_format(as_of, "yyyy-MM-dd")).first()[0]
        versions.publish_day(spark, out, day, _daily_tables(spark, catalog, settings, as_of, params))
    versions.prune_day(spark, out, list(DAILY_TABLES), day, keep=2)
    return out


def read_daily(spark: SparkSession, out: str, name: str) -> DataFrame:
    """One of the two daily tables, each complete day once."""
    return versions.read_days(spark, out, name)


def _daily_tables(
    spark: SparkSession, catalog: Catalog, settings: Settings, as_of: Column, params: Mapping[str, float] | None
) -> dict[str, DataFrame]:
    features = stage(build_features(catalog, settings), "features")
    trained = train_quick(features, settings, params)
    explained, _ = explain_all(spark, trained, settings, dataset=None)
    stamped = at.maps_to_json(explained).withColumn(
        "created_at", sc.run_stamp(as_of, settings.stamp_zone)
    )
    results = score_all(features, trained.model, trained.state, as_of, settings)
    return {"explanations": stamped, "predictions": sc.with_territory(results, catalog["customer_master"])}
