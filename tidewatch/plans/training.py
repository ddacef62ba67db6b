"""Boosted-tree training, the two parameter searches, and model persistence."""

from __future__ import annotations

import hashlib
import json
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import name_sql
from tidewatch.operators.prepare import KEY, TARGET, PrepState, with_class_rank
from tidewatch.plans import boosting
from tidewatch.plans.boosting import Binned, Booster, Spec
from tidewatch.plans.evaluation import class_weight
from tidewatch.settings import GRID_SPACE, RANDOM_SPACE, TREE_DEFAULTS, Settings
from tidewatch.sources import versions

WEIGHT = "_weight"
FOLD = "_fold"
SIZE = "n_estimators"
# Models grown in the same passes: a task holds one set of sums for each.
MODELS_AT_ONCE = 10

Params = Mapping[str, float]


def spec(settings: Settings, params: Params | None = None, held_out: int = -2) -> Spec:
    """What to fit: the defaults overridden by ``params``."""
    unknown = set(params or {}) - set(boosting.DEFAULTS)
    if unknown:
        raise ValueError(f"unknown parameters {sorted(unknown)}")
    return Spec({**TREE_DEFAULTS, **(params or {})}, held_out, settings.seed)


def weighted(df: DataFrame) -> DataFrame:
    """Weight positives by negatives over positives (a scalar subquery); 1 where one class is missing."""
    weight = class_weight(df, TARGET).select("positive_weight").scalar()
    return df.withColumn(WEIGHT, F.when((F.col(TARGET) == 1) & (weight > 0), weight).otherwise(F.lit(1.0)))


def fit_model(train: DataFrame, features: Sequence[str], settings: Settings, params: Params | None = None) -> Booster:
    """One weighted fit on prepared rows."""
    binned = boosting.bin_rows(weighted(train), features, KEY, TARGET, WEIGHT)
    return boosting.fit(binned, [spec(settings, params)])[0]


# -- search ----------------------------------------------------------------------------

def draw_points(space: Mapping[str, Sequence], n: int, seed: int) -> list[dict]:
    """n different points of a parameter space, drawn with a seed."""
    names = list(space)
    size = 1
    for name in names:
        size *= len(space[name])
    points = []
    for index in random.Random(seed).sample(range(size), min(n, size)):
        point = {}
        for name in names:
            index, k = divmod(index, len(space[name]))
            point[name] = space[name][k]
        points.append(point)
    return points


def grid_points(space: Mapping[str, Sequence]) -> list[dict]:
    """All points of a parameter space."""
    return [dict(zip(space, values)) for values in product(*space.values())]


def point_text(point: Params) -> str:
    return json.dumps(dict(sorted(point.items())))


@dataclass(frozen=True)
class SearchResult:
    """Best point, its score, the score of every point, and how many fits they took."""

    best: dict
    best_score: float
    scores: list[tuple[dict, float]]
    n_fits: int = 0

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per point, best first."""
        rows = [(point_text(p), float(s)) for p, s in self.scores]
        return spark.createDataFrame(rows, "params string, f1 double").orderBy(F.col("f1").desc(), "params")


def with_folds(train: DataFrame, settings: Settings) -> DataFrame:
    """Add the number of the fold that holds a row out."""
    ranked = with_class_rank(train, settings.seed + 1)
    return ranked.withColumn(FOLD, (F.col("_rank") % settings.cv_folds).cast("int")).drop("_rank", "_size")


@dataclass(frozen=True)
class Ensemble:
    """Points that differ only in their number of trees: the smaller ones are the first trees of the largest."""

    params: dict
    sizes: tuple[int, ...]


def ensembles(points: Sequence[Params], base: Params | None = None) -> list[Ensemble]:
    """The fits that a list of points needs, in the order of the points."""
    sizes: dict[str, set[int]] = {}
    rest: dict[str, dict] = {}
    for point in points:
        whole = {**TREE_DEFAULTS, **(base or {}), **point}
        n = int(whole.pop(SIZE))
        sizes.setdefault(point_text(whole), set()).add(n)
        rest[point_text(whole)] = whole
    return [Ensemble(rest[k], tuple(sorted(v))) for k, v in sizes.items()]


def fold_scores(binned: Binned, some: Sequence[Ensemble], settings: Settings) -> dict[tuple[int, int], float]:
    """(ensemble, number of trees) -> mean held-out f1 of the positive class; all folds of all ensembles grow together."""
    tasks = [(e, k) for e in range(len(some)) for k in range(settings.cv_folds)]
    models = boosting.fit(binned, [spec(settings, {**some[e].params, SIZE: some[e].sizes[-1]}, k) for e, k in tasks])
    judged = boosting.held_out_outcomes(binned, [(m, k, some[e].sizes) for m, (e, k) in zip(models, tasks)])
    total = {(e, n): 0.0 for e, one in enumerate(some) for n in one.sizes}
    for r in judged.collect():  # one row per model and size
        if r["tp"]:
            total[tasks[r["model"]][0], r["n_trees"]] += 2 * r["tp"] / (2 * r["tp"] + r["fp"] + r["fn"])
    return {k: v / settings.cv_folds for k, v in total.items()}


def search(
    train: DataFrame,
    features: Sequence[str],
    points: Sequence[Params],
    settings: Settings,
    base: Params | None = None,
    resume: str | None = None,
) -> SearchResult:
    """Cross-validated f1 of the positive class for every point.

    Folds take turns within each class in the order of the account's hash: they never change between runs and
    every class is spread over them to within one row.  Rows are binned and stored once for all fits (bin bounds see all
    training rows, labels do not matter for them).  The weight is carried by every fit.  Points that differ only in their
    number of trees share one fit per fold.  With a ``resume`` folder, scores are stored there after every group of
    fits, and a search that starts again on the same rows and settings goes on from them.
    """
    spark = train.sparkSession
    binned = boosting.bin_rows(with_folds(weighted(train), settings), features, KEY, TARGET, WEIGHT, FOLD)
    marks = boosting.content(binned) if resume else ()
    name = hashlib.sha256(json.dumps([list(features), settings.cv_folds, settings.seed, *marks]).encode()).hexdigest()
    known: dict[tuple[str, int], float] = {}
    if resume and versions.exists(spark, resume):
        for r in spark.read.parquet(resume).where(F.col("search") == name).collect():
            known[r["params"], r["n_trees"]] = r["f1"]

    todo = [e for e in ensembles(points, base) if any((point_text(e.params), n) not in known for n in e.sizes)]
    step = max(1, MODELS_AT_ONCE // settings.cv_folds)
    for at in range(0, len(todo), step):
        some = todo[at:at + step]
        fresh = {(point_text(some[e].params), n): f1 for (e, n), f1 in fold_scores(binned, some, settings).items()}
        known.update(fresh)
        if resume:
            rows = [(name, p, n, f1) for (p, n), f1 in fresh.items()]
            spark.createDataFrame(rows, "search string, params string, n_trees int, f1 double").coalesce(1).write.mode("append").parquet(resume)

    scores = []
    for point in points:
        whole = {**TREE_DEFAULTS, **(base or {}), **point}
        n = int(whole.pop(SIZE))
        scores.append((dict(point), known[point_text(whole), n]))
    best, score = max(scores, key=lambda x: x[1])
    return SearchResult(best, score, scores, len(todo) * settings.cv_folds)


def random_search(
    train: DataFrame, features: Sequence[str], settings: Settings, space: Mapping[str, Sequence] = RANDOM_SPACE,
    resume: str | None = None,
) -> SearchResult:
    """Search over seeded draws of the random space."""
    return search(train, features, draw_points(space, settings.search_draws, settings.seed), settings, resume=resume)


def grid_search(
    train: DataFrame, features: Sequence[str], settings: Settings, space: Mapping[str, Sequence] = GRID_SPACE,
    base: Params | None = None, resume: str | None = None,
) -> SearchResult:
    """Search over the whole grid; parameters of ``base`` outside the grid stay set."""
    return search(train, features, grid_points(space), settings, base, resume)


def train_tuned(
    train: DataFrame,
    features: Sequence[str],
    settings: Settings,
    random_space: Mapping[str, Sequence] = RANDOM_SPACE,
    grid_space: Mapping[str, Sequence] = GRID_SPACE,
    resume: str | None = None,
) -> tuple[Booster, dict]:
    """Random search, grid search around it, and the final fit with everything chosen."""
    coarse = random_search(train, features, settings, random_space, resume).best
    fine = grid_search(train, features, settings, grid_space, coarse, resume).best
    chosen = {**coarse, **fine}
    return fit_model(train, features, settings, chosen), chosen


# -- model output --------------------------------------------------------------------------

def importances(spark: SparkSession, model: Booster, features: Sequence[str]) -> DataFrame:
    """One row per feature, most important first (as many rows as model features)."""
    rows = list(zip(features, model.importances().tolist()))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def importance_cut(imp: DataFrame, share: float) -> DataFrame:
    """Features at or above a percentile of the importances."""
    bound = imp.agg(F.percentile("importance", F.lit(share)).alias("b")).scalar()
    return imp.filter(F.col("importance") >= bound)


def score(
    model: Booster,
    prepared: DataFrame,
    features: Sequence[str],
    keep: Sequence[str] = (TARGET, "dataset"),
) -> DataFrame:
    """Class and probability per account: a map over partitions, no shuffle.

    Columns named in ``keep`` pass through where present.
    """
    kept = [KEY, *[c for c in keep if c in prepared.columns]]
    values = ", ".join(f"CAST({name_sql(f)} AS DOUBLE)" for f in features)
    source = prepared.select(*[F.col(name_sql(c)) for c in kept], F.expr(f"array({values})").alias("_x"))
    width = len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            p = 1 / (1 + np.exp(-model.margins(x)))
            columns = [*batch.columns[:-1], pa.array((p >= 0.5).astype(np.int32)), pa.array(p)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "predicted_churn", "churn_probability"])

    schema = T.StructType([*source.schema.fields[:-1], T.StructField("predicted_churn", T.IntegerType()),
                           T.StructField("churn_probability", T.DoubleType())])
    return source.mapInArrow(run, schema)


def with_truth(scored: DataFrame) -> DataFrame:
    """Scored rows in the shape the evaluation functions read."""
    return scored.withColumnsRenamed({TARGET: "true_label", "predicted_churn": "predicted_label"})


def save_model(model: Booster, state: PrepState, path: str) -> str:
    """Model and preparation state as a new version below one path.

    Readers see the version once both are written; a failure on the way leaves them with the one before.
    """
    spark = SparkSession.getActiveSession()
    with versions.publishing(spark, path) as folder:
        model.frame(spark).coalesce(1).write.parquet(f"{folder}/nodes")
        state.save(spark, f"{folder}/state")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[Booster, PrepState]:
    """The last version that :func:`save_model` completed."""
    folder = versions.latest(spark, path)
    state = PrepState.load(spark, f"{folder}/state")
    return boosting.from_nodes(spark.read.parquet(f"{folder}/nodes"), state.features), state
