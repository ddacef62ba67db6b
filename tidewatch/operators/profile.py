"""Profiling, summaries, outliers and missing-value handling for any frame."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.columns import moment_or_null, number_or_null
from tidewatch.operators.ranked import quantiles


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def require_columns(df: DataFrame, required: Sequence[str], name: str = "frame") -> DataFrame:
    """Fail early when a needed column is absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def group_summary(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per group, 2 decimals."""
    parts = []
    for c in columns:
        parts += [
            F.count(_c(c)).alias(f"{c}_count"),
            F.round(F.avg(_c(c)), 2).alias(f"{c}_mean"),
            F.round(F.stddev_samp(_c(c)), 2).alias(f"{c}_std"),
            F.round(F.min(_c(c)), 2).alias(f"{c}_min"),
            F.round(F.max(_c(c)), 2).alias(f"{c}_max"),
        ]
    return df.filter(_c(group).isNotNull()).groupBy(group).agg(*parts)


def null_masks(columns: Sequence[str]) -> list[Column]:
    """One bit per column that is null, 63 columns a number."""
    masks = []
    for a in range(0, len(columns), 63):
        bits = [F.when(_c(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(columns[a:a + 63])]
        masks.append(reduce(lambda x, y: x.bitwiseOR(y), bits))
    return masks


def fingerprint(df: DataFrame) -> DataFrame:
    """``_f1`` and ``_f2``, 128 bits that tell rows apart, and the null masks ``_m0``, ``_m1``, ...

    Hashes pass over nulls, so the masks are hashed as well: a value and a null may not trade places unseen.
    """
    masks = null_masks(df.columns)
    columns = [_c(c) for c in df.columns]
    return df.select(F.xxhash64(*masks, *columns).alias("_f1"), F.xxhash64(F.lit(7), *reversed(columns), *masks).alias("_f2"),
                     *[m.alias(f"_m{k}") for k, m in enumerate(masks)])


def quality_report(df: DataFrame) -> DataFrame:
    """Row count, column count, repeated rows, and one row per column with its nulls.

    One pass over fingerprints: equal ones are counted map-side, so a row that repeats very often costs one row per
    task, and what is shuffled does not grow with the width of a row but for a bit a column.
    """
    prints = fingerprint(df)
    grouped = prints.groupBy(*prints.columns).agg(F.count(F.lit(1)).alias("_n"))
    nulls = [F.col(f"_m{i // 63}").bitwiseAND(F.lit(1 << (i % 63))) != 0 for i in range(len(df.columns))]
    stats = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_rows"),
        *[F.coalesce(F.sum(F.when(null, F.col("_n")).otherwise(0)), F.lit(0)).alias(f"_null_{i}") for i, null in enumerate(nulls)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"_null_{i}").alias("null_count"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return stats.select(
        F.inline(rows), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "duplicate_rows"
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type, nulls, distinct values and numeric range of every column.

    The distinct counts come from one long frame of (column, value), counted
    map-side: a single shuffle, instead of one copy of the data per distinct.
    """
    fields = df.schema.fields
    numeric = set(numeric_columns(df))
    pairs = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                _c(f.name).cast("string").alias("value"),
                (_c(f.name).cast("double") if f.name in numeric else F.lit(None).cast("double")).alias("number"),
            )
            for i, f in enumerate(fields)
        ]
    )
    counted = (
        df.select(F.inline(pairs)).groupBy("i", "value").agg(
            F.count(F.lit(1)).alias("n"), F.min("number").alias("lo"), F.max("number").alias("hi")
        )
    )
    stats = counted.groupBy("i").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("unique_values"),
        F.min("lo").alias("min_value"),
        F.max("hi").alias("max_value"),
    )
    names = F.array(*[F.lit(f.name) for f in fields])
    kinds = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    return stats.select(
        names[F.col("i")].alias("column_name"),
        kinds[F.col("i")].alias("data_type"),
        "null_count",
        "unique_values",
        "min_value",
        "max_value",
    )


def iqr_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> DataFrame:
    """Lower and upper fence per column from exact quartiles."""
    long = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), _c(c).cast("double").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    q = quantiles(long, ["column_name"], "value", {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * threshold
    return q.select(
        "column_name",
        (F.col("q1") - spread).alias("lower_bound"),
        (F.col("q3") + spread).alias("upper_bound"),
    )


def iqr_outliers(
    df: DataFrame, key: str, columns: Sequence[str], threshold: float = 1.5
) -> DataFrame:
    """(key, column, value) of every value outside its column's fences.

    Bounds travel to the rows as a scalar map of one entry per column.
    """
    numeric = [c for c in columns if c in numeric_columns(df)]
    bounds = iqr_bounds(df, numeric, threshold)
    table = bounds.agg(
        F.map_from_entries(
            F.collect_list(F.struct("column_name", F.struct("lower_bound", "upper_bound")))
        ).alias("m")
    ).scalar()
    long = df.withColumn("_bounds", table).select(
        _c(key).alias(key),
        "_bounds",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), _c(c).cast("double").alias("value"))
                    for c in numeric
                ]
            )
        ),
    )
    fence = F.try_element_at("_bounds", F.col("column_name"))
    return long.filter(
        (F.col("value") < fence["lower_bound"]) | (F.col("value") > fence["upper_bound"])
    ).select(key, "column_name", "value")


# -- missing values ------------------------------------------------------------------

def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without nulls in the given (or all) columns."""
    return df.dropna(subset=list(columns) if columns else None)


def fill_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric nulls get the column mean; text nulls the most frequent value.

    Of equally frequent values the smallest is taken; a column without any
    value gets ``Unknown``.
    """
    numeric = set(numeric_columns(df))
    texts = [c for c in columns if c not in numeric]
    fills = {}
    means = [c for c in columns if c in numeric]
    if means:
        table = df.agg(*[F.avg(_c(c)).alias(c) for c in means]).select(F.struct(*[_c(c) for c in means]).alias("m"))
        value = table.scalar()
        for c in means:
            fills[c] = F.coalesce(_c(c).cast("double"), value.getField(c))
    for c in texts:
        counts = df.filter(_c(c).isNotNull()).groupBy(_c(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        # min over (-count, value): most frequent first, then smallest.
        mode = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("best")).select("best.v").scalar()
        fills[c] = F.coalesce(_c(c), mode, F.lit("Unknown"))
    return df.withColumns(fills)


# -- coercion ------------------------------------------------------------------------

def coerce_numeric(df: DataFrame, columns: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Text to number; what is not a number becomes ``fill``."""
    def conv(c: str) -> Column:
        v = number_or_null(_c(c))
        return v if fill is None else F.coalesce(v, F.lit(fill))

    return df.withColumns({c: conv(c) for c in columns})


def coerce_dates(df: DataFrame, columns: Sequence[str], pattern: str | None = None) -> DataFrame:
    """Text to timestamp; what does not parse becomes null.  Absent columns are skipped."""
    return df.withColumns({c: moment_or_null(_c(c), pattern) for c in columns if c in df.columns})
