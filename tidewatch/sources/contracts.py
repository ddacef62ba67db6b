"""Schema contracts: save a schema beside text data, restore and compare it."""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_contract(df: DataFrame, path: str) -> str:
    """Write the frame's schema as one JSON text."""
    spark = df.sparkSession
    spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)
    return path


def load_contract(spark: SparkSession, path: str) -> T.StructType:
    """Read a schema written by :func:`save_contract`."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return T.StructType.fromJson(json.loads(text))


def restore(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Cast the columns the contract names; values that do not fit become null.

    Columns the contract does not name pass through.
    """
    wanted = {f.name: f.dataType for f in contract.fields}
    return df.select(
        *[
            F.col(f"`{c}`").try_cast(wanted[c]).alias(c) if c in wanted else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def type_summary(schema: T.StructType) -> dict[str, int]:
    """Number of columns per type."""
    return dict(Counter(f.dataType.simpleString() for f in schema.fields))


def matches(df: DataFrame, contract: T.StructType) -> bool:
    """Whether every contract column is present with its type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return all(have.get(f.name) == f.dataType for f in contract.fields)


def contract_diff(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns that differ from the contract, with how many values would not cast.

    One aggregate over the frame; absent columns report no values.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    names = [n for n in [*want, *[c for c in have if c not in want]] if have.get(n) != want.get(n)]
    checks = []
    for i, n in enumerate(names):
        c = F.col(f"`{n}`")
        both = n in have and n in want
        bad = c.isNotNull() & c.try_cast(want[n]).isNull() if both else F.lit(False)
        present = F.count(c) if n in have else F.count(F.lit(None))
        checks += [F.count_if(bad).alias(f"_bad_{i}"), present.alias(f"_n_{i}")]
    rows = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.lit(want[n].simpleString() if n in want else None).cast("string").alias("expected"),
            F.lit(have[n].simpleString() if n in have else None).cast("string").alias("actual"),
            F.col(f"_n_{i}").alias("n_values"),
            F.col(f"_bad_{i}").alias("n_not_castable"),
        )
        for i, n in enumerate(names)
    ]
    if not rows:
        return df.sparkSession.createDataFrame(
            [], "column_name string, expected string, actual string, n_values bigint, n_not_castable bigint"
        )
    return df.agg(*checks).select(F.inline(F.array(*rows)))


def save_csv_with_contract(df: DataFrame, path: str, contract_path: str) -> tuple[str, str]:
    """CSV with header, and its schema beside it."""
    df.write.mode("overwrite").option("header", "true").csv(path)
    return path, save_contract(df, contract_path)


def save_dataset(df: DataFrame, path: str, table: str | None = None) -> dict[str, str]:
    """CSV at ``{path}.csv``, its schema at ``{path}_schema``, and optionally a table."""
    from tidewatch.sources.sinks import write_table

    csv, contract = save_csv_with_contract(df, f"{path}.csv", f"{path}_schema")
    out = {"csv": csv, "contract": contract}
    if table:
        out["table"] = write_table(df, table)
    return out


def load_csv(spark: SparkSession, path: str, contract_path: str | None = None) -> DataFrame:
    """CSV with its saved schema; without one the types are inferred by a first pass."""
    reader = spark.read.option("header", "true")
    if contract_path is None:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(load_contract(spark, contract_path)).csv(path)


def load_table(spark: SparkSession, name: str, contract_path: str | None = None) -> DataFrame:
    """Named table, cast to its saved schema when one is given."""
    from tidewatch.sources.tables import read_table

    df = read_table(spark, name)
    return restore(df, load_contract(spark, contract_path)) if contract_path else df
