"""Join helpers."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def checked_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "left", *, unique_right: bool = False
) -> DataFrame:
    """Join that first verifies the key exists on both sides.

    With ``unique_right`` a right key that occurs twice fails the job at run
    time; the count rides along as one aggregate, with no driver round trip.
    """
    for side, df in (("left", left), ("right", right)):
        if on not in df.columns:
            raise ValueError(f"join key {on!r} is missing on the {side} side; it has {df.columns}")
    if unique_right:
        right = assert_unique(right, [on])
    return left.join(right, on, how)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass rows through; a key that occurs more than once fails the job.

    Grouping on the key combines map-side, so a key that repeats very often is
    reduced before the shuffle and never gathered in one place.
    """
    others = [c for c in df.columns if c not in keys]
    message = F.concat(
        F.lit("duplicate key "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    )
    packed = (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min(F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(1)).alias("_row"),
        )
        .filter(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True))
    )
    fields = [F.col("_row").getField(c).alias(c) for c in others]
    return packed.select(*keys, *fields)


def salted_lookup(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    spread_by: Column,
    copies: int | None = None,
    how: str = "left",
) -> DataFrame:
    """Look up ``dim`` (one row per key) for facts whose keys are few and hot.

    The facts of one key are spread over ``copies`` partitions (a quarter of the shuffle
    partitions unless given) by a hash of ``spread_by`` and every row of ``dim`` is repeated that often.  Use it where
    the key has low cardinality, such as a category and a month: such a group
    can hold a large share of all rows, while ``dim`` is tiny.
    """
    salt = "_salt"
    copies = copies or max(2, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    salted = facts.withColumn(salt, F.pmod(F.xxhash64(spread_by), F.lit(copies)).cast("int"))
    repeated = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return salted.join(repeated, [*keys, salt], how).drop(salt)


def left_join_all(base: DataFrame, others: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Chain of left joins on the same key; the sides stay co-partitioned."""
    return reduce(lambda acc, df: acc.join(df, list(on), "left"), others, base)
