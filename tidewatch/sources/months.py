"""Sales lines stored by invoice month, so that account windows prune whole months before the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions.columns import month_of
from tidewatch.sources.sinks import write_path

MONTH = "invoice_month"


def store_by_month(sales: DataFrame, path: str) -> StructType:
    """Write lines into one folder per invoice month and return the schema to read them with.

    Rows are rebalanced by month: small months come as one file, a month that holds a large share of all lines is split.
    Lines without a date have a folder of their own, which no window reaches.
    """
    lines = sales.withColumn(MONTH, month_of(F.to_date("invoice_date")))
    write_path(lines.hint("rebalance", MONTH), path, partition_by=[MONTH])
    return lines.schema


def window_months(windows: DataFrame) -> list[dt.date]:
    """The months that any account window reaches; their number is bounded by the calendar months of the data."""
    first, last = month_of(F.col("threshold_start_date")), month_of(F.col("threshold_end_date"))
    reached = F.expr("sequence(first, last, INTERVAL 1 MONTH)")
    found = windows.select(first.cast("date").alias("first"), last.cast("date").alias("last")).where("first <= last").distinct()
    return [r[0] for r in found.select(F.explode(reached).alias("month")).distinct().orderBy("month").collect()]


def read_months(spark: SparkSession, path: str, schema: StructType, months: list[dt.date]) -> DataFrame:
    """Stored lines of the given months; the folders of other months are not listed for the scan."""
    lines = spark.read.schema(schema).parquet(path)
    wanted = F.col(MONTH).isin(months) if months else F.lit(False)
    return lines.where(wanted).drop(MONTH)
