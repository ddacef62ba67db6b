"""Writers.  Errors are raised to the caller; nothing is swallowed."""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import MAP_COLUMNS, maps_to_json
from tidewatch.sources.tables import quoted

MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


def _writer(df: DataFrame, fmt: str, mode: str, partition_by: Sequence[str]):
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; use one of {MODES}")
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer


def write_table(
    df: DataFrame,
    name: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    merge_schema: bool = True,
) -> str:
    """Write a catalog table and return its name.

    Appending with ``merge_schema`` goes by column name: columns that the table lacks are added to it first,
    and columns that the rows lack are null.
    """
    spark = df.sparkSession
    if mode == "append" and merge_schema and spark.catalog.tableExists(quoted(name)):
        have = spark.table(quoted(name)).schema
        new = [f for f in df.schema if f.name not in have.names]
        if new:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {quoted(name)} ADD COLUMNS ({added})")
        fields = spark.table(quoted(name)).schema
        df = df.select(*[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
        ])
    _writer(df, fmt, mode, partition_by).saveAsTable(quoted(name))
    return name


def write_path(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> str:
    """Write files below a path and return the path."""
    _writer(df, fmt, mode, partition_by).save(path)
    return path


def _moment_suffix(now: dt.datetime | None) -> str:
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_table_at(df: DataFrame, name: str, *, now: dt.datetime | None = None, **options) -> str:
    """Versioned table ``{name}_{YYYYmmdd_HHMMSS}``; returns the full name."""
    return write_table(df, f"{name}_{_moment_suffix(now)}", **options)


def write_table_unique(df: DataFrame, name: str, **options) -> str:
    """Versioned table ``{name}_{8 hex digits}``; returns the full name."""
    return write_table(df, f"{name}_{uuid.uuid4().hex[:8]}", **options)


def write_feature_set(
    df: DataFrame, model: str, version: str, *, now: dt.datetime | None = None, **options
) -> str:
    """Feature set table ``{model}_features_{version}_{moment}``."""
    return write_table_at(df, f"{model}_features_{version}", now=now, **options)


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Append files whose schema may have gained columns."""
    return write_path(df, path, mode="append", partition_by=partition_by)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read such files with the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV files with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path


def save_predictions(results: DataFrame, path: str) -> str:
    """Prediction table as CSV."""
    return write_csv(results, path)


def save_metrics(metrics: DataFrame, path: str) -> str:
    """Long metrics table as CSV."""
    return write_csv(metrics, path)


def save_importances(importances: DataFrame, path: str) -> str:
    """Feature importances as CSV."""
    return write_csv(importances, path)


def save_explanations(explained: DataFrame, path: str) -> str:
    """Explanations as CSV; the maps become JSON text."""
    flat = maps_to_json(explained) if set(MAP_COLUMNS) <= set(explained.columns) else explained
    return write_csv(flat, path)


def save_bundle(frames: dict[str, DataFrame], folder: str, now: dt.datetime | None = None) -> dict[str, str]:
    """Several result frames below one time-stamped folder."""
    suffix = _moment_suffix(now)
    return {
        name: write_csv(df, f"{folder.rstrip('/')}/{name}_{suffix}") for name, df in frames.items()
    }
