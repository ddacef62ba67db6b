"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidewatch.session import tune

# The white space of every text contract, as Spark SQL text.
SPACE_CHARS = r"' \t\n\u000b\u000c\r'"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def tuned(spark: SparkSession) -> SparkSession:
    """Library settings, and Arrow batches small enough for a worker of a few hundred MB."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "250")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` does just that on ASCII text and is much faster than ``translate``."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, even if body uses it per array element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict | Iterable[dict]]],
                schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose worker is made once per task and returns one column list per output field.

    A worker may return several such dictionaries, to keep what it hands over small, and may have a ``close``
    that is called at the end of its task.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        work = make()
        try:
            for batch in batches:
                made = work(batch)
                for out in [made] if isinstance(made, dict) else made:
                    columns = [out[f.name] for f in arrow]
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                         for c, f in zip(columns, arrow)], schema=arrow)
        finally:
            getattr(work, "close", lambda: None)()

    return df.mapInArrow(run, schema)


def crc_mod(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo parts (null: 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def hash_place(*keys: str) -> Column:
    """32 bits of the keys' hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 32))


def sample_by_hash(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most n different rows: those with the smallest hashes of their keys (doc_id by default; ties by all columns).

    Different hashes are counted first, so that only those below a cut, some 2n of any table, are ordered.  Keys that many
    different rows share would take a common place: a sample of rows whose ids may be null or repeated needs the text as well.
    """
    place = hash_place(*keys or ["doc_id"])
    several = df.select(F.approx_count_distinct(place)).first()[0]
    cut = min(1.0, 2.0 * n / max(1, several))
    return df.where(place < F.lit(int(cut * (1 << 32)))).dropDuplicates().orderBy(place, *df.columns).limit(n)


def look_up(rows: DataFrame, side: DataFrame, keys: list[str], weight: Column, total: Column | int, spread: Column) -> DataFrame:
    """``rows`` left-joined with ``side`` (one row per key), dealing out keys that many rows share.

    ``weight`` bounds the rows of a key and ``total`` their sum, so fewer than 1000 keys weigh more than a thousandth of it:
    these are broadcast, and their rows are spread by ``spread`` instead of meeting in one task.
    """
    names = [c for c in side.columns if c not in keys]
    heavy = side.where(weight * 1000 > total).select(*keys, F.struct(*names).alias("_hot"))
    marked = rows.join(F.broadcast(heavy), keys, "left")
    place = F.when(F.col("_hot").isNotNull(), 1 + F.pmod(F.xxhash64(spread), F.lit(1 << 20))).otherwise(F.lit(0))
    usual = side.where(~(weight * 1000 > total)).select(*keys, F.lit(0).cast("bigint").alias("_place"), F.struct(*names).alias("_cold"))
    out = marked.withColumn("_place", place.cast("bigint")).join(usual, [*keys, "_place"], "left")
    found = F.coalesce("_hot", "_cold")
    return out.select(*rows.columns, *[found[n].alias(n) for n in names])
