"""Views that give the provided tables the shape of the engine's source tables.

The same statements serve Spark and DuckDB; ``duck`` swaps the few spellings
in which the two dialects differ.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidewatch.settings import Settings

SETTINGS = Settings(min_window_end=dt.date(1996, 2, 1))

VIEWS = {
    "customer_master": """
        SELECT CAST(c_custkey AS STRING) AS dealer_code,
               CASE WHEN c_acctbal >= 0 THEN 'Z001' ELSE 'Z002' END AS dealer_group,
               CAST(c_nationkey AS STRING) AS territory_code,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'NS' WHEN 'BUILDING' THEN 'Starter'
                    WHEN 'FURNITURE' THEN 'Blue Club' WHEN 'HOUSEHOLD' THEN 'Diamond Club'
                    ELSE 'Unmapped Club' END AS dealer_club_category,
               date_add(DATE '1985-01-01', CAST(c_custkey % 3650 AS INT)) AS creation_date
        FROM customer""",
    "sales_data": """
        SELECT CAST(o.o_custkey AS STRING) AS dealer_code, o.o_orderdate AS invoice_date,
               substr(CAST(o.o_orderdate AS STRING),1,7) AS period,
               l.l_extendedprice * (1 - l.l_discount) AS ndp_value,
               concat(CAST(o.o_orderkey AS STRING), '.0') AS invoice_number,
               l.l_quantity AS volume,
               CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'X' END AS indicator_cancel,
               CASE WHEN o.o_orderpriority = '5-LOW' THEN 'S1' ELSE 'F2' END AS invoice_type
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""",
    "claims_data": """
        SELECT CAST(o.o_custkey AS STRING) AS DealerCode,
               CAST(l.l_orderkey * 10 + l.l_linenumber AS STRING) AS ClaimNo,
               l.l_shipdate AS ClaimDate,
               CASE WHEN l.l_linestatus = 'F' THEN 'Inspection Accepted' ELSE 'Open' END AS ClaimStatus
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'""",
    "visits_flat": """
        SELECT CAST(o.o_custkey AS STRING) AS dealerCode, CAST(l.l_orderkey AS STRING) AS _id,
               l.l_shipdate AS updatedAt, l.l_linestatus = 'F' AS completed
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'A'""",
    "monthly_club_mapping": """
        SELECT dealer_code, period, sas_amount,
               CASE WHEN sas_amount < 50000 THEN 'Non Starter' WHEN sas_amount < 120000 THEN 'Starter'
                    WHEN sas_amount < 200000 THEN 'Blue Club' WHEN sas_amount < 350000 THEN 'Gold Plus Club'
                    ELSE 'Legacy Club' END AS dealer_club
        FROM (SELECT CAST(o_custkey AS STRING) AS dealer_code,
                     substr(CAST(o_orderdate + INTERVAL '1' MONTH AS STRING),1,7) AS period,
                     SUM(o_totalprice) AS sas_amount
              FROM orders GROUP BY 1, 2) m""",
    "customer_financial": """
        SELECT dealer_code, period, SUM(v) AS exposure,
               SUM(CASE WHEN st = 'F' THEN v ELSE 0 END) AS collection,
               SUM(CASE WHEN st <> 'F' THEN v ELSE 0 END) AS outstanding,
               SUM(CASE WHEN d < 30 THEN v ELSE 0 END) AS outstanding_0_30,
               SUM(CASE WHEN d >= 30 AND d < 45 THEN v ELSE 0 END) AS outstanding_30_45,
               SUM(CASE WHEN d >= 45 AND d < 60 THEN v ELSE 0 END) AS outstanding_45_60,
               SUM(CASE WHEN d >= 60 THEN v ELSE 0 END) AS `outstanding_60+`
        FROM (SELECT CAST(o.o_custkey AS STRING) AS dealer_code,
                     replace(substr(CAST(o.o_orderdate AS STRING),1,7),'-','') AS period,
                     o.o_orderstatus AS st, l.l_extendedprice AS v,
                     datediff(CAST(l.l_shipdate AS DATE), CAST(o.o_orderdate AS DATE)) AS d
              FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) x
        GROUP BY 1, 2""",
    "credit_note": """
        SELECT CAST(o.o_custkey AS STRING) AS dealer_code, substr(CAST(l.l_shipdate AS STRING),1,7) AS period,
               l.l_extendedprice * l.l_discount AS note_value
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'""",
    "orders_online": """
        SELECT CAST(o_custkey AS STRING) AS Dealercode, CAST(o_orderkey AS STRING) AS products_invoiceNumber
        FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH')""",
    "territory_master": """
        SELECT CAST(n.n_nationkey AS STRING) AS territory_code, r.r_name AS zone, n.n_name AS region_name,
               COUNT(c.c_custkey) AS dealer_count
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
             LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey
        GROUP BY 1, 2, 3""",
    "product_master": """
        SELECT CAST(p_partkey AS STRING) AS product_code, p_name AS product_name, p_brand AS brand,
               p_type AS product_type, p_size AS size, p_retailprice AS list_price
        FROM part""",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class Tables(Mapping[str, DataFrame]):
    """The provided tables, each opened when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._open = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._open[name]

    def __iter__(self):
        return iter(BASE_TABLES)

    def __len__(self):
        return len(BASE_TABLES)


class Views(Mapping[str, DataFrame]):
    """Source-shaped views over them; no session-wide names are registered."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]):
        self._spark, self._tables, self._made = spark, tables, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            text, used = VIEWS[name], {}
            for t in BASE_TABLES:
                text, hits = re.subn(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
                if hits:
                    used[t] = self._tables[t]
            self._made[name] = self._spark.sql(text, **used)
        return self._made[name]

    def __iter__(self):
        return iter(VIEWS)

    def __len__(self):
        return len(VIEWS)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def raw_catalog(spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, Tables(spark, sf_dir))


def duck(text: str) -> str:
    """DuckDB spelling of a view."""
    text = text.replace("`", '"').replace("AS STRING", "AS VARCHAR")
    text = text.replace("date_add(DATE '1985-01-01', CAST(c_custkey % 3650 AS INT))",
                        "DATE '1985-01-01' + CAST(c_custkey % 3650 AS INT)")
    return re.sub(r"datediff\((CAST\([^)]*\)), (CAST\([^)]*\))\)", r"date_diff('day', \2, \1)", text)
