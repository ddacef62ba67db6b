"""Mergeable column profiles: what is sketched once per load date is never scanned again.

A profile row holds, for a load date and column, exact counts and bounds and two sketches: HyperLogLog for the number of different
values (standard error 0.8 per cent; a profile states 3 per cent) and KLL for quantiles (a value's rank is within 1 per cent of the one asked for).  Sketches of dates
merge into that of all of them without reading the rows.  The exact profiles of :mod:`tidewatch.operators.profile` stay the default.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.profile import numeric_columns
from tidewatch.sources import versions

LOG_SLOTS = 14
QUANTILE_SIZE = 1000
DISTINCT_ERROR, RANK_ERROR = 0.03, 0.01
PROFILE = "profile"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def sketch_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: its name, type, n_rows, null_count, min_value, max_value and the two sketches, in one pass."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    columns, numeric = list(columns or kinds), set(numeric_columns(df))
    parts = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        number = _c(c).cast("double")
        parts += [F.count(_c(c)).alias(f"n{i}"), F.hll_sketch_agg(_c(c).cast("string"), LOG_SLOTS).alias(f"d{i}")]
        if c in numeric:
            parts += [F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}"), F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias(f"q{i}")]
    none = F.lit(None)
    rows = [F.struct(
        F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"), F.col("n").alias("n_rows"),
        (F.col("n") - F.col(f"n{i}")).alias("null_count"),
        (F.col(f"lo{i}") if c in numeric else none.cast("double")).alias("min_value"),
        (F.col(f"hi{i}") if c in numeric else none.cast("double")).alias("max_value"),
        F.col(f"d{i}").alias("distinct_sketch"),
        (F.col(f"q{i}") if c in numeric else none.cast("binary")).alias("quantile_sketch")) for i, c in enumerate(columns)]
    return df.agg(*parts).select(F.inline(F.array(*rows)))


def merged_profile(sketches: DataFrame, shares: Mapping[str, float] | None = None) -> DataFrame:
    """One row per column from the sketches of any parts: counts, bounds, distinct_values and quantiles (q1, median, q3)."""
    shares = shares or {"q1": 0.25, "median": 0.5, "q3": 0.75}
    whole = sketches.groupBy("column_name", "data_type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("null_count").alias("null_count"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.kll_merge_agg_double("quantile_sketch").alias("_q"))
    some = (F.col("n_rows") > F.col("null_count")) & F.col("min_value").isNotNull()
    return whole.select(
        "column_name", "data_type", "n_rows", "null_count", "min_value", "max_value", "distinct_values",
        *[F.when(some, F.kll_sketch_get_quantile_double("_q", F.lit(r))).alias(name) for name, r in shares.items()])


def add_day(spark: SparkSession, root: str, day: str, df: DataFrame, columns: Sequence[str] | None = None) -> str:
    """Stores the profile of one load date's rows; a date that is loaded again replaces its own."""
    return versions.publish_day(spark, root, day, {PROFILE: sketch_profile(df, columns)})


def read_profile(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The merged profile of the load dates from ``first`` to ``last``."""
    rows = versions.read_days(spark, root, PROFILE)
    day = F.col(versions.RUN_DATE).cast("string")
    if first:
        rows = rows.where(day >= first)
    if last:
        rows = rows.where(day <= last)
    return merged_profile(rows.drop(versions.RUN_DATE))
