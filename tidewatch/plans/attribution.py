"""Explanations from additive contributions.

A contribution row keeps an account's contributions together as one array of
``(feature, value, contribution)`` with one entry per model feature.  All
per-account results are therefore plain projections without any shuffle; only
the statistics over all accounts aggregate, combined map-side by feature.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import MAP_COLUMNS, maps_to_json  # noqa: F401  (part of this module's interface)
from tidewatch.settings import Settings


def linear_contributions(df: DataFrame, coefficients: Mapping[str, float]) -> DataFrame:
    """Exact additive contributions of a linear score: coefficient x (value - mean).

    The means are one row, read as a scalar subquery.
    """
    means = df.agg(F.struct(*[F.avg(f).alias(f) for f in coefficients]).alias("m")).scalar()
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            (F.lit(w) * (F.col(f) - F.col("_m").getField(f))).alias("contribution"),
        )
        for f, w in coefficients.items()
    ]
    keep = [c for c in ("predicted_churn", "churn_probability") if c in df.columns]
    return df.withColumn("_m", means).select(
        "dealer_code", *keep, F.array(*entries).alias("contributions")
    )


def _as_map(items: Column) -> Column:
    return F.map_from_arrays(items.getField("feature"), items.getField("contribution"))


def _ordered(items: Column, key) -> Column:
    """Entries ordered by a key, then feature name; natural order of a struct."""
    return F.array_sort(
        F.transform(
            items,
            lambda x: F.struct(key(x).alias("k"), x["feature"].alias("feature"), x["contribution"].alias("contribution")),
        )
    )


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x["contribution"])


def explanations(contributions: DataFrame, settings: Settings) -> DataFrame:
    """Ordered positive, negative and top-n maps with their sums per account.

    The top-n map holds absolute values; the sign is in the other two maps.
    """
    items = F.col("contributions")
    positive = F.filter(items, lambda x: x["contribution"] > 0)
    negative = F.filter(items, lambda x: x["contribution"] < 0)
    n = settings.top_features
    ordered = contributions.select(
        "*",
        _ordered(positive, lambda x: -x["contribution"]).alias("_positive"),
        _ordered(negative, lambda x: x["contribution"]).alias("_negative"),
        F.filter(items, lambda x: x["contribution"].isNull()).alias("_unknown"),
    )
    # The first n of all are among the first n of each sign, and neither, where these are fewer (nulls go first).
    signed = F.concat(F.slice("_positive", 1, n), F.slice("_negative", 1, n))
    without = F.filter(items, lambda x: x["contribution"] == 0)
    numbers = F.filter(signed, lambda x: ~F.isnan(x["contribution"]))  # the others go last
    rest = F.when(F.size(numbers) < n, without).otherwise(F.slice(without, 1, 0))
    absolute = F.concat(*[
        F.transform(a, lambda x: F.struct(x["feature"].alias("feature"), F.abs(x["contribution"]).alias("contribution")))
        for a in (signed, rest, F.col("_unknown"))])
    top = F.slice(_ordered(absolute, lambda x: -x["contribution"]), 1, n)
    return ordered.select(
        "dealer_code",
        *[c for c in ("predicted_churn",) if c in contributions.columns],
        _as_map(F.col("_positive")).alias("positive_features"),
        _as_map(F.col("_negative")).alias("negative_features"),
        _as_map(top).alias("top_features"),
        _total(positive).alias("total_positive_impact"),
        _total(negative).alias("total_negative_impact"),
        _total(items).alias("net_impact"),
    )


def maps_from_json(stored: DataFrame) -> DataFrame:
    """The three maps read back from JSON text."""
    return stored.withColumns({c: F.from_json(c, "map<string,double>") for c in MAP_COLUMNS})


def long_contributions(contributions: DataFrame) -> DataFrame:
    """One row per account and feature."""
    return contributions.select("dealer_code", F.inline("contributions"))


def global_attribution(contributions: DataFrame, settings: Settings) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        long_contributions(contributions)
        .groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
        .orderBy(F.col("mean_abs_contribution").desc(), "feature")
        .limit(settings.top_global_features)
    )


def top_contributions(contributions: DataFrame, n: int) -> DataFrame:
    """Each account's n strongest features with value and contribution."""
    ranked = F.array_sort(
        F.transform(
            "contributions",
            lambda x: F.struct(
                (-F.abs(x["contribution"])).alias("k"),
                x["feature"].alias("feature"),
                x["value"].alias("value"),
                x["contribution"].alias("contribution"),
            ),
        )
    )
    return contributions.select("dealer_code", F.posexplode(F.slice(ranked, 1, n)).alias("pos", "x")).select(
        "dealer_code",
        (F.col("pos") + 1).alias("rank"),
        "x.feature",
        "x.value",
        "x.contribution",
        F.abs("x.contribution").alias("abs_contribution"),
    )


def churn_drivers(explained: DataFrame, n: int = 10) -> DataFrame:
    """Features by the sum of their positive contributions over all accounts."""
    return (
        explained.select(F.explode("positive_features").alias("feature", "impact"))
        .groupBy("feature")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("impact").alias("mean_impact"),
            F.max("impact").alias("max_impact"),
            F.sum("impact").alias("total_impact"),
        )
        .orderBy(F.col("total_impact").desc(), "feature")
        .limit(n)
    )
