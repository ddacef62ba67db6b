"""Model input: encodings, coercion, split and the fitted preparation state."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import (
    finite_or_zero_sql,
    hash_place,
    level_sql,
    name_sql,
    text_sql,
)
from tidewatch.operators.ranked import running_totals
from tidewatch.session import stage, work_dir
from tidewatch.settings import Settings

KEY = "dealer_code"
TARGET = "churn_status"
ONE_HOT = ("zone", "region_name")
NOT_FEATURES = ("last_billed_days", "severity")
# Code of a value outside the dictionary where the settings allow one.
OUTSIDE = -1


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class PrepState:
    """What fitting remembers: columns as one JSON row, and the territory dictionary as a stored table."""

    categories: dict[str, list[str]]
    codes_path: str
    features: list[str]

    def codes(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("territory_code string, territory_code_encoded int").parquet(self.codes_path)

    def save(self, spark: SparkSession, path: str) -> str:
        """Writes the state below a path, with its own copy of the dictionary."""
        self.codes(spark).write.mode("overwrite").parquet(f"{path}/codes")
        text = json.dumps({"categories": self.categories, "features": self.features})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/columns")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "PrepState":
        columns = json.loads(spark.read.text(f"{path}/columns", wholetext=True).first()[0])
        return PrepState(columns["categories"], f"{path}/codes", columns["features"])


# -- single steps --------------------------------------------------------------------

def recent_accounts(df: DataFrame, settings: Settings) -> DataFrame:
    """Accounts billed within the configured number of days."""
    return df.filter(F.col("last_billed_days") <= settings.recent_days)


def with_severity(df: DataFrame, settings: Settings) -> DataFrame:
    """Days since the last invoice over the benchmark, 4 decimals."""
    return df.withColumn(
        "severity", F.bround(F.col("last_billed_days") / F.lit(settings.severity_days), 4)
    )


def _flag(column: str, value: str) -> Column:
    """1 where the column has the value, else 0; null is 0."""
    return F.coalesce(_c(column) == value, F.lit(False)).cast("int")


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Replace a text column by one 0/1 column per known value."""
    flags = [_flag(column, v).alias(f"{column}_{v}") for v in values]
    return df.select(*[_c(c) for c in df.columns if c != column], *flags)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Dictionary of a text column: each distinct value with its sorted position; null, if there is one, comes last.

    The values are dealt by range and stored; a position is a value's rank inside its part plus the sizes of
    the parts before, so no task sorts all values.
    """
    values = df.select(_c(column).alias("value")).distinct()
    parts = stage(
        values.filter("value IS NOT NULL").repartitionByRange("value").select("value", F.spark_partition_id().alias("part")),
        f"{column}-values",
    )
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    known = parts.withColumn("rank", inside).join(offsets, "part").select(
        F.col("value").alias(column), (F.col("rank") + F.col("offset")).cast("int").alias(f"{column}_encoded"))
    total = parts.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar()
    return known.union(values.filter("value IS NULL").select("value", total))


def label_encode(df: DataFrame, column: str, codes: DataFrame, settings: Settings) -> DataFrame:
    """Replace a text column by its dictionary position.

    A value outside the dictionary fails the job, or gets :data:`OUTSIDE` unless ``unseen_codes`` is ``error``.
    """
    target = f"{column}_encoded"
    unseen = F.concat(F.lit(f"unseen {column}: "), F.coalesce(_c(column), F.lit("null")))
    missing = F.raise_error(unseen).cast("int") if settings.unseen_codes == "error" else F.lit(OUTSIDE)
    found = codes.select(_c(column).alias("_value"), _c(target).alias("_code"))
    out = df.join(found, _c(column).eqNullSafe(F.col("_value")), "left")
    return out.withColumn(target, F.coalesce("_code", missing)).drop(column, "_value", "_code")


def align_schema(df: DataFrame, features: Sequence[str], key: str = KEY) -> DataFrame:
    """Exactly the given feature columns, in order; absent ones are 0, others dropped."""
    have = set(df.columns)
    return df.selectExpr(
        key, *[name_sql(f) if f in have else f"0D AS {name_sql(f)}" for f in features]
    )


# -- fitted preparation ----------------------------------------------------------------

def category_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values of the category columns, in one pass.

    These become column names and code positions of the model, so their number
    is bounded by the width of the model, not by the rows.
    """
    row = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns]).first()
    return {c: list(row[c]) for c in columns}


def _with_code(df: DataFrame, codes: DataFrame, settings: Settings) -> DataFrame:
    """The territory as its dictionary position; Spark picks the join by the dictionary's size."""
    if "territory_code" not in df.columns:
        return df
    return label_encode(df, "territory_code", codes, settings)


def _encoded(
    df: DataFrame, categories: Mapping[str, Sequence[str]], settings: Settings
) -> dict[str, str]:
    """Name -> SQL text of every model feature a frame yields, in column order.

    All encodings land in one projection, however many columns there are.
    """
    out: dict[str, str] = {}
    for field in df.schema.fields:
        name, column = field.name, name_sql(field.name)
        if name in (KEY, TARGET, *NOT_FEATURES):
            continue
        if name == "dealer_club_category":
            out[name] = level_sql(column, settings.model_levels)
        elif name in ONE_HOT:
            out.update({f"{name}_{v}": f"coalesce({column} = {text_sql(v)}, false)" for v in categories[name]})
        elif isinstance(field.dataType, T.StringType):
            out[name] = f"try_cast(trim({column}) AS DOUBLE)"
        else:
            out[name] = column
    return {n: f"{finite_or_zero_sql(text)} AS {name_sql(n)}" for n, text in out.items()}


def fit_preparation(features: DataFrame, settings: Settings) -> PrepState:
    """Read the category values and store the territory dictionary of the recent accounts."""
    recent = recent_accounts(features, settings)
    path = work_dir(features.sparkSession, "codes")
    if "territory_code" in features.columns:
        label_codes(recent, "territory_code").write.parquet(path)
    state = PrepState(category_values(recent, list(ONE_HOT)), path, [])
    rows = _with_code(recent, state.codes(features.sparkSession), settings)
    return replace(state, features=list(_encoded(rows, state.categories, settings)))


def prepare_training(features: DataFrame, state: PrepState, settings: Settings) -> DataFrame:
    """Recent accounts, encoded, numeric, without gaps, with a 0/1 target.

    The days since the last invoice and the severity derived from them tell
    the label, so neither is a feature.
    """
    rows = _with_code(recent_accounts(features, settings), state.codes(features.sparkSession), settings)
    columns = _encoded(rows, state.categories, settings)
    target = f"CASE {TARGET} WHEN 'Active' THEN 0 WHEN 'Churned' THEN 1 END AS {TARGET}"
    return rows.selectExpr(KEY, *[columns[f] for f in state.features], target)


def prepare_scoring(features: DataFrame, state: PrepState, settings: Settings) -> DataFrame:
    """Same encodings for scoring: the fitted feature list, absent features as 0."""
    rows = _with_code(recent_accounts(features, settings), state.codes(features.sparkSession), settings)
    columns = _encoded(rows, state.categories, settings)
    return rows.selectExpr(KEY, *[columns.get(f, f"0D AS {name_sql(f)}") for f in state.features])


# -- split -----------------------------------------------------------------------------

def _class_marks(key: str, target: str, seed: int) -> dict[str, Column]:
    label = F.coalesce(_c(target).cast("string"), F.lit(""))  # rows without a label are a class of their own
    return {"_place": hash_place(_c(key), seed), "_class": label}


def _class_ranks(rows: DataFrame) -> DataFrame:
    """Rank of every place in its class and the class's size."""
    return running_totals(rows, ["_class"], "_place", {"n": F.count(F.lit(1))}).select(
        "_class", "_place", F.col("before_n").alias("_rank"), F.col("all_n").alias("_size"))


def with_class_rank(df: DataFrame, seed: int, key: str = KEY, target: str = TARGET) -> DataFrame:
    """Add ``_rank``, a row's place in its class by a hash of the key, and ``_size``, the class's rows.

    The rows are stored first, because they are read for ranking and again for the result; no task sees a whole class.
    """
    rows = stage(df.withColumns(_class_marks(key, target, seed)), "to-rank")
    return rows.join(_class_ranks(rows), ["_class", "_place"]).drop("_place", "_class")


def with_split(df: DataFrame, settings: Settings, key: str = KEY, target: str = TARGET, stored: bool = False) -> DataFrame:
    """Mark each row ``train`` or ``test``: the first rows of every class by the key's hash are the test rows.

    Every class gives its share to within half a row, and a rerun gives the same rows.  Ranks grow with the places, so a class's
    last test place (one value a class) tells its test rows, and only key and class of the rows are ranked.  The rows
    are stored first, unless ``stored`` says that they come from a stored table and may be read twice.
    """
    marks = _class_marks(key, target, settings.seed)
    rows = df if stored else stage(df, "to-split")
    ranked = _class_ranks(rows.select(*[c.alias(n) for n, c in marks.items()]))
    test = F.col("_rank") < F.round(F.lit(settings.test_share) * F.col("_size"))
    last = ranked.filter(test).groupBy("_class").agg(F.max("_place").alias("_last"))
    lasts = last.agg(F.map_from_entries(F.collect_list(F.struct("_class", "_last"))).alias("lasts")).scalar()
    is_test = marks["_place"] <= F.try_element_at(lasts, marks["_class"])
    return rows.withColumn("dataset", F.when(is_test, "test").otherwise("train"))


def split_counts(split: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows and share per class and side, to check the stratification."""
    sides = split.groupBy(target).agg(
        F.count_if(F.col("dataset") == "train").alias("n_train"),
        F.count_if(F.col("dataset") == "test").alias("n_test"),
    )
    return sides.withColumn("test_share", F.col("n_test") / (F.col("n_train") + F.col("n_test")))


def split_union(split: DataFrame) -> DataFrame:
    """Train and test rows put together again."""
    train = split.filter(F.col("dataset") == "train")
    return train.unionByName(split.filter(F.col("dataset") == "test"))
