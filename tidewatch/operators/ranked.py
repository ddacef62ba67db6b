"""Exact ordered statistics without a global sort in one task.

A running total over all rows of a table cannot use one ordered window: without
a partition it runs in a single task.  Here equal values are first counted
(map-side), the distinct values are cut into ranges at approximate quantiles,
the ranges' totals are accumulated (one row per range), and the running total
inside each range is added to its range's offset.  The approximation decides
only where the cuts are; the results are exact for any data, and a value that
holds a third of all rows is a single counted row.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import stage

STEPS_KEPT = 1000


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    sums: Mapping[str, Column],
    *,
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Per distinct value: the sums, the sums over all values before it, and those over all values.

    ``sums`` maps a name to an aggregate.  The result has ``by``, ``value``, the
    names, and ``before_<name>`` and ``all_<name>`` for each.  ``by`` has few groups, such as data
    sets or column names; null values are left out.  The counted values are written once, so the input is
    read once; there are as many ranges as shuffle partitions unless given.
    """
    counted = stage(
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(*[c.alias(n) for n, c in sums.items()]),
        "counted",
    )
    ranges = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = counted.groupBy(*by).agg(F.percentile_approx(value, steps, max(STEPS_KEPT, 4 * ranges)).alias("_cuts"))
    placed = _join_by(counted, cuts, by).withColumn(
        "_range", F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    ).drop("_cuts")

    def order(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    totals = placed.groupBy(*by, "_range").agg(*[F.sum(n).alias(n) for n in sums])
    earlier = Window.partitionBy(*by).orderBy(order("_range")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    group = Window.partitionBy(*by)
    offsets = totals.select(
        *by, "_range",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(n).over(group).alias(f"all_{n}") for n in sums],
    )
    inside = Window.partitionBy(*by, "_range").orderBy(order(value)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return placed.join(offsets, [*by, "_range"]).select(
        *by,
        value,
        *sums,
        *[
            (F.col(f"_off_{n}") + F.coalesce(F.sum(n).over(inside), F.lit(0))).alias(f"before_{n}")
            for n in sums
        ],
        *[f"all_{n}" for n in sums],
    )


def _join_by(df: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach per-group values; without groups, a one-row scalar subquery."""
    if by:
        return df.join(small, list(by), "left")
    return df.withColumn("_cuts", small.select("_cuts").scalar())


def quantiles(
    df: DataFrame, by: Sequence[str], value: str, shares: Mapping[str, float]
) -> DataFrame:
    """Exact quantiles per group with linear interpolation between neighbours."""
    ranked = running_totals(df, by, value, {"n": F.count(F.lit(1))})

    def at(position: Column) -> Column:
        covered = (F.col("before_n") <= position) & (position < F.col("before_n") + F.col("n"))
        return F.max(F.when(covered, F.col(value)))

    def position(share: float) -> Column:
        return (F.col("all_n") - 1) * F.lit(share)

    parts = []
    for name, share in shares.items():
        parts += [
            at(F.floor(position(share))).alias(f"_{name}_lo"),
            at(F.ceil(position(share))).alias(f"_{name}_hi"),
            F.max(position(share) - F.floor(position(share))).alias(f"_{name}_part"),
        ]
    wide = ranked.groupBy(*by).agg(*parts)
    return wide.select(
        *by,
        *[
            (
                F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")
            ).alias(n)
            for n in shares
        ],
    )
