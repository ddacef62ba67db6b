"""Lifecycle kept up to date from daily deltas of sales lines.

The state is a table of account, sales month and closing moment with the sum, the latest invoice and the number of lines.  A
line closes when the reference moment reaches it; references lie on the last day of a month, so lines of other days close
with their month's last day and only lines of a last day keep their own moment.  Merging a delta reads the delta and the
state, never the sales history.

Inactive runs and windows are worked out again for touched accounts only, unless the reference, the axis of months or the accounts in scope
have changed.  Every delta makes a new version of the state, complete or invisible, and a delta
whose name the state knows is not merged twice.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import month_from_text
from tidewatch.operators import lifecycle as lc
from tidewatch.settings import Settings
from tidewatch.sources import versions
from tidewatch.sources.tables import in_scope

KEYS = ("dealer_code", "month", "closes")


def delta_months(lines: DataFrame) -> DataFrame:
    """The state's rows of some valid sales lines; lines without account or moment count for nothing."""
    moment = lines.schema["invoice_date"].dataType
    last = F.last_day("invoice_date")
    closes = F.when(F.to_date("invoice_date") == last, F.col("invoice_date")).otherwise(last.cast(moment))
    return (
        lines.filter(F.col("dealer_code").isNotNull() & F.col("invoice_date").isNotNull())
        .groupBy("dealer_code", month_from_text(F.col("period")).alias("month"), closes.alias("closes"))
        .agg(F.coalesce(F.sum("ndp_value"), F.lit(0.0)).alias("ndp_value"), F.max("invoice_date").alias("last_in_month"),
             F.count(F.lit(1)).alias("n_lines"))
    )


def merged(parts: Sequence[DataFrame]) -> DataFrame:
    """State rows of several parts put together."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy(*KEYS).agg(F.sum("ndp_value").alias("ndp_value"), F.max("last_in_month").alias("last_in_month"),
                                    F.sum("n_lines").alias("n_lines"))


def closed_months(state: DataFrame, reference: Column) -> DataFrame:
    """What :func:`tidewatch.operators.lifecycle.account_months` makes of the lines up to the reference."""
    return state.filter(F.col("closes") <= reference).groupBy("dealer_code", "month").agg(
        F.sum("ndp_value").alias("ndp_value"), F.max("last_in_month").alias("last_in_month"))


def _reference(state: DataFrame, accounts: DataFrame, settings: Settings) -> DataFrame:
    """One row: the reference moment and a print of the accounts in scope."""
    known = in_scope(state, accounts).withColumnRenamed("last_in_month", "invoice_date")
    point = lc.reference_point(known).select("reference_date")
    if settings.reference:
        given = F.lit(settings.reference).cast(point.schema["reference_date"].dataType)
        point = point.select(given.alias("reference_date"))
    scope = accounts.agg(F.bit_xor(F.xxhash64("dealer_code")).alias("scope"), F.count(F.lit(1)).alias("n_scope"))
    return point.select("reference_date", scope.select("scope").scalar().alias("scope"), scope.select("n_scope").scalar().alias("n_scope"))


def apply_delta(
    spark: SparkSession, path: str, lines: DataFrame, accounts: DataFrame, settings: Settings, name: str
) -> str:
    """Merges valid sales lines into the state below ``path`` and brings the windows up to date; returns the version's folder.

    ``name`` tells the delta; one that has been merged is left alone.
    """
    before = versions.committed(spark, path)
    old = before[-1] if before else None
    names = []
    if old:
        names = [r["name"] for r in spark.read.parquet(f"{old}/deltas").collect()]  # one row per delta
        if name in names:
            return old
    with versions.publishing(spark, path) as folder:
        def put(df: DataFrame, part: str) -> DataFrame:
            df.write.parquet(f"{folder}/{part}")
            return spark.read.parquet(f"{folder}/{part}")

        fresh = put(delta_months(lines), "delta")
        state = put(merged([spark.read.parquet(f"{old}/months"), fresh]) if old else fresh, "months")
        point = put(_reference(state, accounts, settings), "reference")
        now = point.first()
        moment = now["reference_date"]
        if settings.reference and moment is not None and point.where("last_day(reference_date) <> to_date(reference_date)").first():
            raise ValueError("the state needs a reference on the last day of a month")
        reference = point.select("reference_date").scalar()
        months = in_scope(closed_months(state, reference), accounts)
        axis = put(months.filter(F.col("month").isNotNull()).select("month").distinct(), "axis")
        whole_axis = lc.month_axis(axis)

        kept = None
        if old:
            same_axis = (axis.exceptAll(spark.read.parquet(f"{old}/axis")).isEmpty()
                         and spark.read.parquet(f"{old}/axis").exceptAll(axis).isEmpty())
            if same_axis and spark.read.parquet(f"{old}/reference").first() == now:
                touched = fresh.filter(F.col("closes") <= reference).select("dealer_code").distinct()
                kept = spark.read.parquet(f"{old}/windows").join(touched, "dealer_code", "left_anti")
                months = months.join(touched, "dealer_code", "left_semi")
        windows = lc.account_lifecycle(months, reference, settings, whole_axis)
        put(windows.withColumn("worked_out", F.lit(name)) if kept is None
            else windows.withColumn("worked_out", F.lit(name)).unionByName(kept), "windows")
        put(spark.createDataFrame([(n,) for n in [*names, name]], "name string").coalesce(1), "deltas")
    return folder


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The last complete state: account, month, closing moment and their sums."""
    return spark.read.parquet(f"{versions.latest(spark, path)}/months")


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows of the last complete state, as :func:`tidewatch.operators.lifecycle.account_lifecycle` gives them."""
    return spark.read.parquet(f"{versions.latest(spark, path)}/windows").drop("worked_out")
