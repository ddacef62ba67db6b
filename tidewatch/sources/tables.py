"""Reading the source tables and restricting them to the accounts in scope."""

from __future__ import annotations

from typing import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.settings import Settings

SALES_COLUMNS = (
    "dealer_code",
    "invoice_date",
    "period",
    "ndp_value",
    "invoice_number",
    "volume",
    "indicator_cancel",
    "invoice_type",
)

# Fact table -> name of its account column.  The claims, visits and order
# systems spell the account key differently.
ACCOUNT_KEYS = {
    "claims_data": "DealerCode",
    "visits_flat": "dealerCode",
    "monthly_club_mapping": "dealer_code",
    "credit_note": "dealer_code",
    "customer_financial": "dealer_code",
    "orders_online": "Dealercode",
}


def quoted(name: str) -> str:
    """Quote every part of a dotted table name."""
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Named table with optional projection and a positive row limit."""
    return project(spark.read.table(quoted(name)), columns, limit, order_by)


def project(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Projection and limit of :func:`read_table` for any frame."""
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(limit) if limit and limit > 0 else df


def load_accounts(master: DataFrame, settings: Settings) -> DataFrame:
    """Account master rows of the configured group."""
    return master.filter(F.col("dealer_group") == settings.group).withColumn(
        "dealer_code", F.col("dealer_code").cast("string")
    )


def keyed(df: DataFrame, key: str = "dealer_code") -> DataFrame:
    """Rows with the account key named ``dealer_code`` and typed as text."""
    return df.withColumnRenamed(key, "dealer_code").withColumn(
        "dealer_code", F.col("dealer_code").cast("string")
    )


def in_scope(df: DataFrame, accounts: DataFrame) -> DataFrame:
    """Rows whose account is in scope.

    A semi join: Spark sends the key list to every task when it measures it to
    be small, and otherwise shuffles, splitting a hot account's partition.
    """
    return df.join(accounts.select("dealer_code"), "dealer_code", "left_semi")


def restrict_to_accounts(df: DataFrame, accounts: DataFrame, key: str = "dealer_code") -> DataFrame:
    """Fact rows of the accounts in scope, with the key named ``dealer_code``."""
    return in_scope(keyed(df, key), accounts)


def valid_sales(sales: DataFrame, settings: Settings) -> DataFrame:
    """The eight sales columns, without cancelled lines and excluded types.

    A null invoice type fails ``NOT IN`` and is dropped.
    """
    return (
        sales.select(*SALES_COLUMNS)
        .filter(F.col("indicator_cancel").isNull())
        .filter(~F.col("invoice_type").isin(*settings.excluded_types))
        .withColumns(
            {
                "ndp_value": F.nanvl(F.col("ndp_value").cast("double"), F.lit(None).cast("double")),
                "volume": F.nanvl(F.col("volume").cast("double"), F.lit(None).cast("double")),
            }
        )
    )


def load_sales(sales: DataFrame, accounts: DataFrame, settings: Settings) -> DataFrame:
    """Valid sales lines of the accounts in scope."""
    return restrict_to_accounts(valid_sales(sales, settings), accounts)


class Catalog(Mapping[str, DataFrame]):
    """All source tables by name, restricted to the accounts in scope.

    A table's plan is made when it is first asked for, so tables that no
    operator uses are never opened.  Dimensions pass through unfiltered.
    """

    def __init__(self, raw: Mapping[str, DataFrame], settings: Settings):
        self._raw = raw
        self._settings = settings
        self._made: dict[str, DataFrame] = {}

    def _make(self, name: str) -> DataFrame:
        table = self._raw[name]
        if name == "customer_master":
            return load_accounts(table, self._settings)
        if name == "sales_data":
            return load_sales(table, self["customer_master"], self._settings)
        if name in ACCOUNT_KEYS:
            table = restrict_to_accounts(table, self["customer_master"], ACCOUNT_KEYS[name])
        if name == "orders_online":
            table = table.select("dealer_code", "products_invoiceNumber")
        return table

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def unrestricted(self, name: str) -> DataFrame:
        """A fact table of all accounts, for operators that reduce it first.

        At scale the account list is too long to send to every task.  Then it
        is cheaper to aggregate by account and restrict the result, because
        the raw rows never have to be shuffled for the restriction.
        """
        if name == "sales_data":
            return valid_sales(keyed(self._raw[name]), self._settings)
        return keyed(self._raw[name], ACCOUNT_KEYS[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self._raw)

    def __len__(self) -> int:
        return len(self._raw)


def load_catalog(raw: Mapping[str, DataFrame], settings: Settings) -> Catalog:
    """Catalog over given frames."""
    return Catalog(raw, settings)


def read_catalog(spark: SparkSession, names: Mapping[str, str], settings: Settings) -> Catalog:
    """:func:`load_catalog` over named tables: ``{logical name: table name}``."""
    return load_catalog({k: read_table(spark, v) for k, v in names.items()}, settings)
