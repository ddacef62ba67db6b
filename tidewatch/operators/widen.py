"""Relative months and the wide one-row-per-account feature table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import left_join_all
from tidewatch.settings import PIVOT_MEASURES, Settings

MONTH_KEY = ("dealer_code", "month")


def with_relative_month(monthly: DataFrame, settings: Settings) -> DataFrame:
    """Months back from the account's own latest month (1 = latest).

    Windows reach at most one month beyond the configured number; that month is left out.  An older one
    means that the window rule was not applied, and fails the job.
    """
    latest = F.max("month").over(Window.partitionBy("dealer_code"))
    back = F.months_between(latest, F.col("month")).cast("int") + 1
    limit = settings.relative_months
    too_old = F.raise_error(F.concat(F.lit("month outside the window: "), F.col("month").cast("string")))
    return monthly.withColumn("rel_month", back).filter(
        F.when(F.col("rel_month") > limit + 1, too_old.cast("boolean")).otherwise(F.col("rel_month") <= limit)
    )


def relative_month(monthly: DataFrame, settings: Settings) -> DataFrame:
    """:func:`with_relative_month` with the label ``cm-<n>``."""
    return with_relative_month(monthly, settings).withColumn(
        "cm_label", F.concat(F.lit("cm-"), F.col("rel_month").cast("string"))
    )


def monthly_wide(monthly: DataFrame, *month_features: DataFrame) -> DataFrame:
    """Monthly sales with all other monthly features of the same account and month."""
    return left_join_all(monthly, month_features, MONTH_KEY)


def month_maps(wide: DataFrame, measures: Sequence[str] = PIVOT_MEASURES) -> DataFrame:
    """One row per account with its months in a map ``{relative month: measures}``.

    An account has at most one row per relative month, so the map is small; a
    second row for the same month fails the job.  It costs one aggregate
    whatever the number of measures.
    """
    rows = F.struct(*[F.col(f"`{m}`").alias(m) for m in measures])
    return wide.groupBy("dealer_code").agg(
        F.map_from_entries(F.collect_list(F.struct("rel_month", rows))).alias("by_month")
    )


def unfold(
    maps: DataFrame, settings: Settings, measures: Sequence[str] = PIVOT_MEASURES
) -> DataFrame:
    """Replace the month map by columns named ``{measure}_cm-{n}``."""
    others = [f"`{c}`" for c in maps.columns if c != "by_month"]
    columns = [
        f"try_element_at(by_month, {n}).`{m}` AS `{m}_cm-{n}`"
        for m in measures
        for n in range(1, settings.relative_months + 1)
    ]
    return maps.selectExpr(*others, *columns)


def feature_pivot(
    wide: DataFrame, settings: Settings, measures: Sequence[str] = PIVOT_MEASURES
) -> DataFrame:
    """One row per account, one column per measure and relative month."""
    return unfold(month_maps(wide, measures), settings, measures)


def account_features(
    maps: DataFrame,
    accounts: DataFrame,
    intervals: DataFrame,
    movements: DataFrame,
    territories: DataFrame,
    lifecycle: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Widened measures with the account, territory and label columns.

    The joins run on the folded rows; the columns are unfolded last.
    """
    out = maps.join(
        accounts.select("dealer_code", "territory_code", "dealer_club_category", "dealership_age"),
        "dealer_code",
        "left",
    )
    out = left_join_all(out, [intervals, movements], ["dealer_code"])
    out = out.join(
        territories.select("zone", "territory_code", "region_name", "dealer_count"),
        "territory_code",
        "left",
    )
    out = out.join(
        lifecycle.select("dealer_code", "last_billed_days", "churn_status"), "dealer_code", "left"
    )
    return unfold(out, settings)
