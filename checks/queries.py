"""The registered queries: one callable per key, all over the whole given tables."""

from __future__ import annotations

import dataclasses
import uuid
from typing import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import SETTINGS, raw_catalog, tables
from checks.shapes import shaped, shaped_by_name
from tidewatch.functions import columns as fc
from tidewatch.operators import joins, prepare as pp, profile as pf
from tidewatch.operators import lifecycle as lc
from tidewatch.operators import measures as ms
from tidewatch.operators import sketches
from tidewatch.operators import widen as wd
from tidewatch.plans import attribution as at
from tidewatch.plans import evaluation as ev
from tidewatch.plans import features as ft
from tidewatch.plans import incremental
from tidewatch.plans import jobs
from tidewatch.plans import scoring as sc
from tidewatch.plans import training as tr
from tidewatch.session import stage, tune, work_dir
from tidewatch.settings import PIVOT_MEASURES
from tidewatch.sources import contracts, months, sinks, versions
from tidewatch.sources import tables as tb

Query = Callable[[SparkSession, str], DataFrame]

SHAPES: dict[str, str] = {}
QUERIES: dict[str, Query] = {}


def query(shape: str | None = None, name: str | None = None):
    """Register a query; with a shape its result is SQL-checked."""

    def register(fn: Callable[["Inputs"], DataFrame]):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(Inputs(tune(spark), sf_dir))
            return shaped(out, shape) if shape else out

        QUERIES[key] = run
        if shape:
            SHAPES[key] = shape
        return fn

    return register


class Inputs:
    """Source frames and common intermediate frames of one query call."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.settings = SETTINGS
        self._memo: dict[str, object] = {}

    def _once(self, label: str, make):
        if label not in self._memo:
            self._memo[label] = make()
        return self._memo[label]

    @property
    def base(self):
        return self._once("base", lambda: tables(self.spark, self.sf_dir))

    @property
    def raw(self):
        return self._once("raw", lambda: raw_catalog(self.spark, self.sf_dir))

    @property
    def catalog(self):
        return self._once("catalog", lambda: tb.load_catalog(self.raw, self.settings))

    @property
    def accounts(self):
        return self.catalog["customer_master"]

    @property
    def sales(self):
        return self.catalog["sales_data"]

    @property
    def reference(self):
        return lc.reference_value(self.sales)

    @property
    def closed(self):
        return lc.closed_month_sales(self.sales, self.reference)

    @property
    def life(self):
        """Lifecycle frames, lazy."""
        return self._once("life", lambda: ft.build_lifecycle(self.catalog, self.settings))

    @property
    def staged_life(self):
        """Lifecycle frames with the small results written once."""
        return self._once("staged", lambda: ft.build_lifecycle(self.catalog, self.settings, stage))

    @property
    def monthly(self):
        """Monthly sales, written once."""
        return self._once("monthly", lambda: ms.monthly_sales(
            stage(ms.monthly_totals(self.staged_life.window_sales), "totals"), self.accounts))

    @property
    def clubs(self):
        return ms.club_month_shift(self.catalog["monthly_club_mapping"], self.staged_life.reference)

    @property
    def wide(self):
        monthly = ft.build_monthly(self.catalog, self.staged_life, stage)
        return ft.build_monthly_wide(self.catalog, monthly, self.settings)

    @property
    def features(self):
        return self._once("features", lambda: ft.build_features(self.catalog, self.settings))

    @property
    def stored_features(self):
        """The feature table written once, for steps that read it several times."""
        return self._once("stored", lambda: stage(self.features, "features"))

    @property
    def profiles(self):
        """Account windows with master and territory columns."""
        places = self.raw["territory_master"].select("territory_code", "zone", "region_name")
        return self.life.windows.join(
            self.accounts.select("dealer_code", "territory_code", "dealer_club_category"),
            "dealer_code", "left",
        ).join(places, "territory_code", "left")

    @property
    def recent(self):
        return pp.recent_accounts(self.life.windows, self.settings)

    @property
    def formula(self):
        """Formula scores with their split."""
        return self._once("formula", lambda: pp.with_split(self.by_formula, self.settings, target="true_label"))

    @property
    def by_formula(self):
        """Recent accounts scored by a fixed formula, with label and h."""
        h = fc.hash_bucket(F.col("dealer_code"), self.settings.seed) / F.lit(10000)
        z = F.lit(0.02) * (F.col("last_billed_days") - 90) + F.lit(3.0) * (F.col("h") - F.lit(0.5))
        return (
            self.recent.withColumn("h", h)
            .withColumn("churn_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
            .select(
                "dealer_code", "last_billed_days", "h", "churn_probability",
                fc.class_code(F.col("churn_status")).alias("true_label"),
                sc.classify(F.col("churn_probability")).alias("predicted_label"),
            )
        )

    @property
    def results(self):
        scored = self.by_formula.select(
            "dealer_code", F.col("predicted_label").alias("predicted_churn"), "churn_probability"
        )
        return sc.prediction_results(scored, self.reference, self.settings)

    @property
    def linear(self):
        rows = self.by_formula.withColumnRenamed("predicted_label", "predicted_churn")
        return at.linear_contributions(rows, {"last_billed_days": 0.02, "h": 3.0})


# -- sources and sinks ---------------------------------------------------------------

@query("o_orderkey:i o_custkey:i o_totalprice:d")
def scan_project_limit(x: Inputs):
    return tb.project(x.base["orders"], ["o_orderkey", "o_custkey", "o_totalprice"], 20, ["o_orderkey"])


@query("dealer_code:s dealer_group:s territory_code:s dealer_club_category:s creation_date:t")
def load_accounts(x: Inputs):
    return x.accounts


@query("dealer_code:s invoice_date:t period:s ndp_value:d invoice_number:s volume:d indicator_cancel:s invoice_type:s")
def load_sales(x: Inputs):
    return x.sales


@query("table_name:s dealer_code:s n_rows:i")
def load_restricted(x: Inputs):
    parts = [
        x.catalog[t].groupBy("dealer_code").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(t).alias("table_name"), "dealer_code", "n_rows")
        for t in tb.ACCOUNT_KEYS
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dealer_code:s month:s total_sales:d total_invoices:i total_units:d")
def write_roundtrip(x: Inputs):
    totals = ms.monthly_totals(x.life.window_sales).withColumn("month", fc.month_text(F.col("month")))
    path = sinks.write_path(totals, work_dir(x.spark, "roundtrip"), partition_by=["month"])
    return x.spark.read.schema(totals.schema).parquet(path)


@query("dealer_code:s churn_status:s severity:r")
def append_evolve(x: Inputs):
    path = work_dir(x.spark, "evolve")
    first = x.life.windows.select("dealer_code", "churn_status")
    sinks.append_evolving(first, path)
    second = pp.with_severity(x.recent, x.settings).select("dealer_code", "churn_status", "severity")
    sinks.append_evolving(second, path)
    return sinks.read_evolving(x.spark, path)


@query("dealer_code:s last_billed_days:i churn_status:s threshold_end_date:t severity:r")
def csv_schema_roundtrip(x: Inputs):
    frame = pp.with_severity(x.life.windows, x.settings).select(
        "dealer_code", "last_billed_days", "churn_status", "threshold_end_date", "severity"
    )
    path = work_dir(x.spark, "csv")
    contracts.save_csv_with_contract(frame, f"{path}/data", f"{path}/contract")
    return contracts.load_csv(x.spark, f"{path}/data", f"{path}/contract")


def _as_text(x: Inputs) -> tuple[DataFrame, DataFrame]:
    """Orders, and the same as text with a few values spoiled and one column gone."""
    typed = x.base["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    text = typed.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", "unknown")
        .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_totalprice",
        F.lit(1).alias("extra"),
    )
    return typed, text


@query("o_orderkey:i o_custkey:i o_totalprice:d extra:i")
def schema_cast(x: Inputs):
    typed, text = _as_text(x)
    return contracts.restore(text, typed.schema)


@query("column_name:s expected:s actual:s n_values:i n_not_castable:i")
def schema_diff(x: Inputs):
    typed, text = _as_text(x)
    return contracts.contract_diff(text, typed.schema)


# -- lifecycle -----------------------------------------------------------------------

@query("max_invoice_date:t reference_date:t")
def reference_date(x: Inputs):
    return lc.reference_point(x.sales)


@query("dealer_code:s invoice_date:t period:s ndp_value:d invoice_number:s volume:d")
def closed_month_sales(x: Inputs):
    return x.closed


@query("dealer_code:s month:m ndp_value:d no_sales_flag:i")
def activity_grid(x: Inputs):
    return lc.activity_grid(lc.account_months(x.closed))


@query("dealer_code:s last_invoice_date:t last_billed_days:i churn_status:s")
def churn_label(x: Inputs):
    return lc.churn_label(x.closed, x.reference, x.settings)


@query("dealer_code:s max_no_sales_streak:i max_streak_start_period:m")
def no_sales_streak(x: Inputs):
    return lc.no_sales_streak(lc.account_months(x.closed))


WINDOW_SHAPE = (
    "dealer_code:s last_invoice_date:t last_billed_days:i churn_status:s max_no_sales_streak:i "
    "max_streak_start_period:m threshold_start_date:t threshold_end_date:t"
)


@query(WINDOW_SHAPE)
def account_windows(x: Inputs):
    return x.life.windows


@query(WINDOW_SHAPE)
def lifecycle_incremental(x: Inputs):
    """Windows after three deltas: early lines, most others, and late ones of any date; the second comes twice."""
    sales, path = x.catalog.unrestricted("sales_data"), work_dir(x.spark, "lifecycle")
    late = F.pmod(F.xxhash64("invoice_number", "dealer_code"), F.lit(10)) == 0
    early = F.coalesce(F.year("invoice_date") < 1996, F.lit(False))
    deltas = {"early": early & ~late, "most": ~early & ~late, "again": ~early & ~late, "late": late}
    for name, condition in deltas.items():
        incremental.apply_delta(x.spark, path, sales.where(condition), x.accounts, x.settings, name.replace("again", "most"))
    return incremental.read_windows(x.spark, path)


@query("dealer_code:s invoice_date:t period:s ndp_value:d invoice_number:s volume:d churn_status:s "
       "last_billed_days:i threshold_start_date:t threshold_end_date:t")
def account_window_sales(x: Inputs):
    return x.life.window_sales


@query("dealer_code:s invoice_date:t period:s ndp_value:d invoice_number:s volume:d churn_status:s "
       "last_billed_days:i threshold_start_date:t threshold_end_date:t")
def window_sales_by_month(x: Inputs):
    """Window sales from lines stored by month: only months that some window reaches are read."""
    path = work_dir(x.spark, "sales-months")
    schema = months.store_by_month(x.staged_life.closed, path)
    windows = x.staged_life.windows
    return lc.account_window_sales(months.read_months(x.spark, path, schema, months.window_months(windows)), windows)


@query("dealer_code:s avg_days_between_purchase:d")
def purchase_interval(x: Inputs):
    return lc.purchase_interval(x.life.window_days)


@query("dealer_code:s dealership_age:i")
def account_age(x: Inputs):
    return ms.account_age(x.accounts, lc.as_of_date(x.reference, x.settings))


# -- monthly measures ----------------------------------------------------------------

MONTHLY_SHAPE = (
    "dealer_code:s month:m total_sales:d total_invoices:i total_units:d avg_invoices:d avg_sales:d "
    "avg_units_purchased:d territory_code:s dealer_club_category:s"
)


@query(MONTHLY_SHAPE)
def monthly_sales(x: Inputs):
    return x.monthly


PEER_COLUMNS = " ".join(f"{n}:d" for g in ms.PEER_MEANS.values() for n in g.values())


@query(f"dealer_code:s month:m {PEER_COLUMNS}")
def peer_means(x: Inputs):
    return ms.with_peer_means(x.monthly)


@query("dealer_code:s period:s month:m sas_amount:d dealer_club:s")
def club_month_shift(x: Inputs):
    return ms.club_month_shift(x.catalog["monthly_club_mapping"], x.reference)


@query("dealer_code:s month:m sas_amount:d rotation:r terrwise_rotation:r dealerclub_wise_rotation:r")
def rotation(x: Inputs):
    return ms.with_rotation(x.monthly, x.clubs)


@query("dealer_code:s Demoted:i Promoted:i no_change:i")
def club_movement(x: Inputs):
    return ms.club_movement(
        ms.club_month_shift(x.catalog["monthly_club_mapping"], x.reference), x.settings
    )


@query("dealer_code:s month:m " + " ".join(f"{c}:d" for c in ms.BALANCES))
def financial_month(x: Inputs):
    return ms.financial_month(x.catalog["customer_financial"])


@query("dealer_code:s month:m total_credit_note_value:d avg_credit_note_value:d")
def credit_notes(x: Inputs):
    return ms.credit_notes(x.catalog["credit_note"])


@query("dealer_code:s month:m offline:i online:i total_orders:i")
def order_channel(x: Inputs):
    return ms.order_channel(x.sales, x.catalog["orders_online"])


@query("dealer_code:s month:m unique_claims:i settled_claims:i active_claims:i")
def claim_counts(x: Inputs):
    return ms.claim_counts(x.catalog["claims_data"], x.settings)


@query("dealer_code:s month:m visit_count:i")
def visit_counts(x: Inputs):
    return ms.visit_counts(x.catalog["visits_flat"])


@query("level:s group_key:s month:m change_sales:r")
def mom_change(x: Inputs):
    own = x.monthly.select("dealer_code", "month", F.col("avg_sales").alias("sales"))
    frames = [("account", "dealer_code", own)]
    for level, group in (("territory", "territory_code"), ("club", "dealer_club_category")):
        frames.append((level, group, ms.group_means(x.monthly, group, {"total_sales": "sales"})))
    parts = [
        ms.change_from_previous(df, group, "month", ["sales"], "change_").select(
            F.lit(level).alias("level"), F.col(group).alias("group_key"), "month", "change_sales"
        )
        for level, group, df in frames
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("territory_code:s total:d " + " ".join(f"{s.lower()}:d {s.lower()}_share:d" for s in SEGMENTS))
def market_share(x: Inputs):
    balances = x.base["customer"].select(
        F.col("c_nationkey").cast("string").alias("territory_code"),
        *[
            F.when(F.col("c_mktsegment") == s, F.col("c_acctbal").cast("string")).otherwise("n/a").alias(s.lower())
            for s in SEGMENTS
        ],
    )
    return ms.market_share(balances, "territory_code", [s.lower() for s in SEGMENTS])


# -- wide table ----------------------------------------------------------------------

@query("dealer_code:s month:m cm_label:s total_sales:d")
def relative_month(x: Inputs):
    return wd.relative_month(x.monthly, x.settings)


COUNT_MEASURES = (
    "total_invoices", "offline", "online", "total_orders", "unique_claims",
    "settled_claims", "active_claims", "visit_count",
)


def kind_of(measure: str) -> str:
    return "i" if measure in COUNT_MEASURES else "r" if "rotation" in measure else "d"


@query("dealer_code:s month:m " + " ".join(f"{m}:{kind_of(m)}" for m in PIVOT_MEASURES))
def monthly_wide(x: Inputs):
    return x.wide


PIVOT_SHAPE = " ".join(f"{m}_cm-{n}:{kind_of(m)}" for m in PIVOT_MEASURES for n in range(1, 13))


@query(f"dealer_code:s {PIVOT_SHAPE}")
def feature_pivot(x: Inputs):
    return wd.feature_pivot(wd.with_relative_month(x.wide, x.settings), x.settings)


FEATURE_TAIL = (
    "territory_code:s dealer_club_category:s dealership_age:i avg_days_between_purchase:d Demoted:i "
    "Promoted:i no_change:i zone:s region_name:s dealer_count:i last_billed_days:i churn_status:s"
)


@query(f"dealer_code:s {PIVOT_SHAPE} {FEATURE_TAIL}")
def account_features(x: Inputs):
    return x.features


# -- joins ---------------------------------------------------------------------------

def _checked(how: str):
    @query("dealer_code:s territory_code:s churn_status:s", name=f"checked_join_{how}")
    def run(x: Inputs):
        # Masters of one group on the left, labels of all accounts that bought on the right.
        sales = tb.valid_sales(x.raw["sales_data"], x.settings)
        reference = lc.reference_value(sales)
        labels = lc.churn_label(lc.closed_month_sales(sales, reference), reference, x.settings)
        left = x.accounts.select("dealer_code", "territory_code")
        return joins.checked_join(left, labels.select("dealer_code", "churn_status"), "dealer_code", how,
                                  unique_right=True)


for _how in ("left", "inner", "right", "outer"):
    _checked(_how)


# -- preparation ---------------------------------------------------------------------

@query("dealer_code:s last_billed_days:i churn_status:s")
def recent_accounts(x: Inputs):
    return x.recent


@query("dealer_code:s last_billed_days:i severity:r")
def severity(x: Inputs):
    return pp.with_severity(x.life.windows, x.settings)


@query()
def one_hot(x: Inputs):
    rows = pp.recent_accounts(x.profiles, x.settings).select("dealer_code", "zone", "region_name")
    found = pp.category_values(rows, ["zone", "region_name"])
    for c in ("zone", "region_name"):
        rows = pp.one_hot(rows, c, found[c])
    return rows.select("dealer_code", *[F.col(f"`{c}`").cast("bigint").alias(c) for c in rows.columns[1:]])


@query("dealer_code:s territory_code_encoded:i")
def label_encode(x: Inputs):
    rows = pp.recent_accounts(x.profiles, x.settings).select("dealer_code", "territory_code")
    return pp.label_encode(rows, "territory_code", pp.label_codes(rows, "territory_code"), x.settings)


@query()
def encode_features(x: Inputs):
    state = pp.fit_preparation(x.stored_features, x.settings)
    return shaped_by_name(pp.prepare_training(x.stored_features, state, x.settings))


@query()
def prepare_scoring(x: Inputs):
    state = pp.fit_preparation(x.stored_features, x.settings)
    return shaped_by_name(pp.prepare_scoring(x.stored_features, state, x.settings))


@query("dealer_code:s last_billed_days:d not_in_input:d max_no_sales_streak:d")
def align_schema(x: Inputs):
    return pp.align_schema(x.recent, ["last_billed_days", "not_in_input", "max_no_sales_streak"])


def _gappy(x: Inputs) -> DataFrame:
    """Orders with missing prices and priorities."""
    return x.base["orders"].select(
        "o_orderkey",
        F.when(F.col("o_totalprice") < 300000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
    )


@query("o_orderkey:i price:d priority:s")
def impute_mean_mode(x: Inputs):
    return pf.fill_nulls(_gappy(x), ["price", "priority"])


@query("o_orderkey:i price:d priority:s")
def drop_nulls(x: Inputs):
    return pf.drop_nulls(_gappy(x), ["price"])


@query("p_partkey:i price_text:d brand_text:d p_type:d")
def coerce_numeric(x: Inputs):
    part = x.base["part"].select(
        "p_partkey",
        F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.col("p_retailprice").cast("string")).alias("price_text"),
        F.replace("p_brand", F.lit("Brand#"), F.lit(" ")).alias("brand_text"),
        "p_type",
    )
    return pf.coerce_numeric(part, ["price_text", "brand_text", "p_type"])


@query("o_orderkey:i day_text:t compact_text:t")
def coerce_dates(x: Inputs):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = x.base["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "2024-13-01").otherwise(day).alias("day_text"),
        F.when(F.col("o_orderstatus") == "F", "not a day").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("compact_text"),
    )
    return pf.coerce_dates(pf.coerce_dates(orders, ["day_text", "absent"]), ["compact_text"], "yyyyMMdd")


@query("true_label:i n_train:i n_test:i test_share:r")
def stratified_split(x: Inputs):
    return pp.split_counts(x.formula, "true_label")


@query("dealer_code:s dataset:s true_label:i")
def split_union(x: Inputs):
    return pp.split_union(x.formula)


# -- profiling -----------------------------------------------------------------------

@query("l_returnflag:s " + " ".join(
    f"{c}_{s}:{'i' if s == 'count' else 'd'}"
    for c in ("l_quantity", "l_extendedprice") for s in ("count", "mean", "std", "min", "max")))
def group_summary(x: Inputs):
    return pf.group_summary(x.base["lineitem"], "l_returnflag", ["l_quantity", "l_extendedprice"])


@query("column_name:s data_type:s null_count:i n_rows:i n_columns:i duplicate_rows:i")
def quality_report(x: Inputs):
    return pf.quality_report(x.raw["sales_data"])


@query("column_name:s data_type:s null_count:i unique_values:i min_value:d max_value:d")
def column_profile(x: Inputs):
    return pf.column_profile(x.raw["sales_data"])


def _sales_by_year(x: Inputs) -> DataFrame:
    """All sales lines, written once in a folder for each invoice year, so that a year is read without the others."""
    path, sales = work_dir(x.spark, "sales-by-year"), x.raw["sales_data"]
    by_year = sales.withColumn("_year", F.year("invoice_date"))
    by_year.write.partitionBy("_year").parquet(path)
    return x.spark.read.schema(by_year.schema).parquet(path)


def _daily_profile(x: Inputs, sales: DataFrame) -> DataFrame:
    """Sketches of the sales lines of every invoice year, stored as load dates and merged."""
    root = work_dir(x.spark, "profile")
    years = [r[0] for r in sales.select("_year").distinct().orderBy("_year").collect()]
    for year in years:
        part = sales.where(F.col("_year").eqNullSafe(F.lit(year))).drop("_year")
        sketches.add_day(x.spark, root, f"{year or 1:04}-12-31", part)
    return sketches.read_profile(x.spark, root)


@query()
def profile_sketch(x: Inputs):
    return _daily_profile(x, _sales_by_year(x))


@query("column_name:s within:i")
def profile_sketch_check(x: Inputs):
    """Counts and bounds equal the exact profile; different values and quartiles lie within the stated errors of the exact ones."""
    by_year = _sales_by_year(x)
    sales, merged = by_year.drop("_year"), stage(_daily_profile(x, by_year), "merged-profile")
    exact = pf.column_profile(sales).withColumnsRenamed({"null_count": "nulls", "min_value": "low", "max_value": "high"}).drop("data_type")
    both = merged.join(exact, "column_name", "full")
    equal = F.col("null_count").eqNullSafe(F.col("nulls")) & F.col("min_value").eqNullSafe(F.col("low")) & F.col("max_value").eqNullSafe(F.col("high"))
    near = F.abs(F.col("distinct_values") - F.col("unique_values")) <= sketches.DISTINCT_ERROR * F.col("unique_values")
    numbers = pf.numeric_columns(sales)
    asked = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = {r["column_name"]: r for r in merged.where(F.col("column_name").isin(numbers)).collect()}  # one row per column
    ranks = sales.agg(*[
        (F.count_if(F.col(c) < found[c][q]) / F.count(c) <= r + sketches.RANK_ERROR).alias(f"{c} {q} low") for c in numbers for q, r in asked.items()
    ] + [(F.count_if(F.col(c) <= found[c][q]) / F.count(c) >= r - sketches.RANK_ERROR).alias(f"{c} {q} high") for c in numbers for q, r in asked.items()]).first()
    good = [c for c in numbers if all(ranks[f"{c} {q} {side}"] for q in asked for side in ("low", "high"))]
    ranked = ~F.col("column_name").isin(numbers) | F.col("column_name").isin(good)
    return both.select("column_name", F.coalesce((equal & near & ranked).cast("int"), F.lit(0)).alias("within"))


@query("account_month:s column_name:s value:d")
def iqr_outliers(x: Inputs):
    keyed = x.monthly.withColumn(
        "account_month", F.concat_ws("/", "dealer_code", fc.month_text(F.col("month")))
    )
    return pf.iqr_outliers(keyed, "account_month", ["total_sales", "total_invoices", "total_units"])


# -- evaluation ----------------------------------------------------------------------

@query("n_negative:i n_positive:i positive_weight:r")
def class_weight(x: Inputs):
    return ev.class_weight(x.formula, "true_label")


@query("churn_status:s n:i percent:r")
def class_distribution(x: Inputs):
    return ev.class_distribution(x.life.windows, "churn_status")


@query("dataset:s true_label:i predicted_label:i n:i")
def confusion_matrix(x: Inputs):
    return ev.confusion_matrix(x.formula)


@query("dataset:s accuracy:r precision:r recall:r f1_score:r")
def weighted_metrics(x: Inputs):
    return ev.weighted_metrics(x.formula)


@query("dataset:s label:s precision:r recall:r f1_score:r support:i")
def class_report(x: Inputs):
    return ev.class_report(x.formula)


@query("dataset:s roc_auc:r")
def roc_auc(x: Inputs):
    return ev.roc_auc(x.formula)


@query("dataset:s threshold:r fpr:r tpr:r")
def roc_curve(x: Inputs):
    return ev.roc_curve(x.formula)


@query("dataset:s metric:s value:r")
def metrics_long(x: Inputs):
    return ev.metrics_long(x.formula)


@query("dealer_code:s true_label:i predicted_label:i confidence_score:r error_kind:s n_errors:i "
       "n_false_positive:i n_false_negative:i mean_confidence:r std_confidence:r min_confidence:r "
       "q1_confidence:r median_confidence:r q3_confidence:r max_confidence:r")
def prediction_errors(x: Inputs):
    errors = ev.prediction_errors(ev.prediction_summary_vs_truth(x.formula, x.settings))
    stats = ev.error_statistics(errors)
    packed = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return errors.withColumn("s", packed).select("*", "s.*")


@query("feature:s importance:r")
def importance_cut(x: Inputs):
    filled = x.wide.agg(*[F.count(F.col(f"`{m}`")).alias(m) for m in PIVOT_MEASURES], F.count(F.lit(1)).alias("n"))
    imp = filled.select(
        F.inline(F.array(*[
            F.struct(F.lit(m).alias("feature"), (F.col(f"`{m}`") / F.col("n")).alias("importance"))
            for m in PIVOT_MEASURES
        ]))
    )
    return tr.importance_cut(imp, x.settings.importance_percentile)


# -- scoring -------------------------------------------------------------------------

RESULT_SHAPE = (
    "dealer_code:s predicted_churn:i churn_probability:r prediction_label:s risk_category:s "
    "prediction_timestamp:s"
)


@query(RESULT_SHAPE)
def score_bands(x: Inputs):
    return x.results


@query(RESULT_SHAPE)
def high_risk(x: Inputs):
    return sc.high_risk(x.results, x.settings)


@query(RESULT_SHAPE)
def top_risk(x: Inputs):
    return sc.top_risk(x.results, 10)


ASKED_FOR = ("3", "17", "100", "512", "1002", "no such account")


@query(RESULT_SHAPE + " last_billed_days:i h:r")
def score_subset(x: Inputs):
    rows = sc.for_accounts(x.formula, ASKED_FOR).select(
        "dealer_code", F.col("predicted_label").alias("predicted_churn"), "churn_probability",
        "last_billed_days", "h",
    )
    return sc.prediction_results(rows, x.reference, x.settings)


@query(RESULT_SHAPE)
def point_lookup(x: Inputs):
    return sc.lookup(x.results, "1002")


@query("n_accounts:i n_churn:i churn_rate:r n_low:i n_medium:i n_high:i low_share:r medium_share:r "
       "high_share:r mean_probability:r median_probability:r max_probability:r min_probability:r")
def prediction_summary(x: Inputs):
    return sc.prediction_summary(x.results)


@query(RESULT_SHAPE + " territory_code:s")
def predictions_with_territory(x: Inputs):
    return sc.with_territory(x.results, x.accounts)


@query("o_orderkey:i created_at:t")
def run_stamp(x: Inputs):
    late = F.when(F.col("o_orderstatus") == "P", F.expr("INTERVAL '18:45' HOUR TO MINUTE")).otherwise(
        F.expr("INTERVAL '18:15' HOUR TO MINUTE")
    )
    moment = (F.col("o_orderdate") + late).cast("timestamp")
    return x.base["orders"].select(
        "o_orderkey", sc.run_stamp(moment, x.settings.stamp_zone).alias("created_at")
    )


# -- attribution ---------------------------------------------------------------------

@query("dealer_code:s feature:s value:r contribution:r")
def linear_contributions(x: Inputs):
    return at.long_contributions(x.linear)


@query("dealer_code:s predicted_churn:i n_positive:i n_negative:i first_top:s total_positive_impact:r "
       "total_negative_impact:r net_impact:r")
def explanations(x: Inputs):
    return at.explanations(x.linear, x.settings).select(
        "*",
        F.size("positive_features").alias("n_positive"),
        F.size("negative_features").alias("n_negative"),
        F.map_keys("top_features")[0].alias("first_top"),
    )


@query("dealer_code:s kind:s position:i feature:s impact:r")
def explanations_json(x: Inputs):
    stored = at.maps_to_json(at.explanations(x.linear, x.settings))
    loaded = at.maps_from_json(stored)
    maps = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("impacts")) for c in at.MAP_COLUMNS])
    kinds = loaded.select("dealer_code", F.explode(maps).alias("m")).select("dealer_code", "m.kind", "m.impacts")
    return kinds.select("dealer_code", "kind", F.posexplode("impacts").alias("position", "feature", "impact"))


@query("feature:s mean_abs_contribution:r")
def global_attribution(x: Inputs):
    return at.global_attribution(x.linear, x.settings)


@query("dealer_code:s rank:i feature:s value:r contribution:r abs_contribution:r")
def top_contributions(x: Inputs):
    return at.top_contributions(x.linear, x.settings.top_features)


@query("feature:s count:i mean_impact:r max_impact:r total_impact:d")
def churn_drivers(x: Inputs):
    return at.churn_drivers(at.explanations(x.linear, x.settings), 10)


# -- models ------------------------------------------------------------------------------

_TRAINED: dict[tuple[str, str], jobs.Trained] = {}


def trained(x: Inputs) -> jobs.Trained:
    """The default model of a session and data folder, fitted once; its rows and state are stored tables."""
    key = (x.spark.sparkContext.applicationId, x.sf_dir)
    if key not in _TRAINED:
        _TRAINED[key] = jobs.train_quick(x.stored_features, x.settings)
    return _TRAINED[key]


@query()
def train_gbt(x: Inputs):
    """The default fit, evaluated on train and test rows."""
    return jobs.evaluate(trained(x))


@query()
def train_quick(x: Inputs):
    """The default fit, as test metrics in one row."""
    return ev.test_summary(jobs.scored_truth(trained(x)))


@query()
def feature_importance(x: Inputs):
    t = trained(x)
    return tr.importances(x.spark, t.model, t.state.features)


@query()
def score_accounts(x: Inputs):
    t = trained(x)
    ready = pp.prepare_scoring(x.stored_features, t.state, x.settings)
    return tr.score(t.model, ready, t.state.features)


@query()
def score_all(x: Inputs):
    t = trained(x)
    return jobs.score_all(x.stored_features, t.model, t.state, x.reference, x.settings)


@query()
def tree_contributions(x: Inputs):
    t = trained(x)
    return at.long_contributions(jobs.contributions(x.spark, t, t.prepared)[0])


@query()
def explain_all(x: Inputs):
    return at.maps_to_json(jobs.explain_all(x.spark, trained(x), x.settings)[0])


def _daily(x: Inputs) -> DataFrame:
    out = work_dir(x.spark, "daily")
    jobs.daily_job(x.spark, x.catalog, x.settings, out, x.reference)
    predictions = jobs.read_daily(x.spark, out, "predictions")
    explained = jobs.read_daily(x.spark, out, "explanations").drop("predicted_churn", "run_date")
    return predictions.join(explained, "dealer_code", "left")


@query()
def daily_job(x: Inputs):
    return _daily(x)


# -- properties of the model queries, checked over their whole results ----------------------

def _class_of(p):
    return (F.col(p) >= 0.5).cast("int")


# Least area under the curve of the default model on test rows that counts as having learned.
AUC_FLOOR = 0.7


def _recomputed(x: Inputs) -> DataFrame:
    """dataset, metric, value from the scored rows, by their definitions and not by the evaluation plans.

    The area is Spark ML's, over all different scores.
    """
    scored = stage(jobs.scored_truth(trained(x)), "truth").select("dataset", "true_label", "predicted_label", "churn_probability")
    hit = F.col("true_label") == F.col("predicted_label")
    classes = scored.withColumn("c", F.explode(F.array(F.lit(0), F.lit(1)))).groupBy("dataset", "c").agg(
        F.count_if(hit & (F.col("true_label") == F.col("c"))).alias("tp"), F.count_if(F.col("predicted_label") == F.col("c")).alias("said"),
        F.count_if(F.col("true_label") == F.col("c")).alias("true"), F.count(F.lit(1)).alias("n"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    precision, recall = share(F.col("tp"), F.col("said")), share(F.col("tp"), F.col("true"))
    f1 = share(2.0 * precision * recall, precision + recall)
    per = classes.groupBy("dataset").agg(
        *[F.sum(v * F.col("true") / F.col("n")).alias(k) for k, v in (("precision", precision), ("recall", recall), ("f1_score", f1))],
        F.sum(F.col("tp") / F.col("n")).alias("accuracy"))
    judge = BinaryClassificationEvaluator(rawPredictionCol="churn_probability", labelCol="true_label", numBins=0)
    areas = [(d, judge.evaluate(scored.where(F.col("dataset") == d))) for d in ("train", "test")]
    area = x.spark.createDataFrame(areas, "dataset string, roc_auc double")
    names = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    return per.join(area, "dataset").unpivot(["dataset"], names, "metric", "again")


@query("dataset:s metric:s equal:i learned:i")
def train_gbt_check(x: Inputs):
    """Every metric equals its recomputation; the areas are above the floor."""
    both = jobs.evaluate(trained(x)).join(_recomputed(x), ["dataset", "metric"], "full")
    learned = (F.col("metric") != "roc_auc") | (F.col("value") >= AUC_FLOOR)
    return both.select("dataset", "metric", (F.abs(F.col("value") - F.col("again")) < 1e-9).cast("int").alias("equal"),
                       learned.cast("int").alias("learned"))


@query("metric:s equal:i learned:i")
def train_quick_check(x: Inputs):
    """The one row of test metrics against their recomputation."""
    row = ev.test_summary(jobs.scored_truth(trained(x))).unpivot(
        [], ["accuracy", "precision", "recall", "f1_score", "roc_auc"], "metric", "value")
    again = _recomputed(x).where("dataset = 'test'").drop("dataset")
    learned = (F.col("metric") != "roc_auc") | (F.col("value") >= AUC_FLOOR)
    return row.join(again, "metric", "full").select(
        "metric", (F.abs(F.col("value") - F.col("again")) < 1e-9).cast("int").alias("equal"), learned.cast("int").alias("learned"))


# -- searches over small documented spaces; the job uses the whole ones --------------------------

SEARCH = dataclasses.replace(SETTINGS, cv_folds=3, search_draws=4)
SMALL_RANDOM = {"n_estimators": [3, 6], "max_depth": [2, 3], "learning_rate": [0.1, 0.3], "subsample": [0.8, 1.0],
                "colsample": [0.6, 1.0], "gamma": [0.0, 0.2], "min_child_weight": [1, 5]}
SMALL_GRID = {"n_estimators": [2, 4, 8], "max_depth": [2], "learning_rate": [0.1, 0.3]}


def _search_rows(x: Inputs) -> tuple[DataFrame, list[str]]:
    prepared, state = x._once("prepared", lambda: jobs.prepare(x.stored_features, x.settings))
    return prepared.where("dataset = 'train'"), state.features


@query()
def random_search(x: Inputs):
    """Cross-validated f1 of seeded draws from SMALL_RANDOM."""
    return tr.random_search(*_search_rows(x), SEARCH, SMALL_RANDOM).frame(x.spark)


@query()
def grid_search(x: Inputs):
    """Cross-validated f1 of all points of SMALL_GRID; three numbers of trees share one fit."""
    return tr.grid_search(*_search_rows(x), SEARCH, SMALL_GRID).frame(x.spark)


@query("params:s in_range:i")
def random_search_check(x: Inputs):
    out = random_search(x)
    return out.select("params", F.col("f1").between(0, 1).cast("int").alias("in_range"))


@query("params:s equal:i")
def grid_search_check(x: Inputs):
    """The score of every point equals that of a search of its own, whose fit has no more trees than the point asks for."""
    rows, names = _search_rows(x)
    out = tr.grid_search(rows, names, SEARCH, SMALL_GRID).frame(x.spark)
    alone = []
    for n in SMALL_GRID["n_estimators"]:
        found = tr.grid_search(rows, names, SEARCH, {**SMALL_GRID, "n_estimators": [n]})
        alone += [(tr.point_text(p), s) for p, s in found.scores]
    return out.join(x.spark.createDataFrame(alone, "params string, again double"), "params", "full").select(
        "params", (F.abs(F.col("f1") - F.col("again")) < 1e-12).cast("int").alias("equal"))


@query("dealer_code:s equal:i")
def score_loaded_check(x: Inputs):
    """A model saved, saved again and loaded scores every account as before."""
    t = trained(x)
    path = work_dir(x.spark, "model")
    for _ in range(2):
        tr.save_model(t.model, t.state, path)
    model, state = tr.load_model(x.spark, path)
    ready = pp.prepare_scoring(x.stored_features, state, x.settings)
    before = tr.score(t.model, pp.prepare_scoring(x.stored_features, t.state, x.settings), t.state.features)
    after = tr.score(model, ready, state.features).withColumnRenamed("churn_probability", "again").drop("predicted_churn")
    return before.join(after, "dealer_code", "full").select(
        "dealer_code", F.coalesce((F.col("churn_probability") == F.col("again")).cast("int"), F.lit(0)).alias("equal"))


@query("dealer_code:s predicted_churn:i churn_probability:r risk_category:s")
def prediction_csv_roundtrip(x: Inputs):
    """Predictions through the CSV sink of a time-stamped bundle."""
    paths = sinks.save_bundle({"predictions": x.results}, work_dir(x.spark, "bundle"))
    back = x.spark.read.schema(x.results.schema).option("header", "true").csv(paths["predictions"])
    return back.select("dealer_code", "predicted_churn", "churn_probability", "risk_category")


@query("dealer_code:s n_rows:i n_days:i")
def daily_rerun_check(x: Inputs):
    """A day published twice and a failed third time is read once."""
    root = work_dir(x.spark, "days")
    rows = x.results
    versions.publish_day(x.spark, root, "2001-01-01", {"predictions": rows})
    versions.publish_day(x.spark, root, "2001-01-02", {"predictions": rows.limit(3)})
    versions.publish_day(x.spark, root, "2001-01-02", {"predictions": rows})
    try:
        broken = rows.withColumn("churn_probability", F.raise_error(F.lit("sink failed")))
        versions.publish_day(x.spark, root, "2001-01-01", {"predictions": rows.limit(1), "explanations": broken})
    except Exception:  # noqa: BLE001  (the failure is the case under test)
        pass
    back = versions.read_days(x.spark, root, "predictions")
    return back.groupBy("dealer_code").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("run_date").alias("n_days"))


@query("total:r negative:i repeated:i")
def feature_importance_check(x: Inputs):
    t = trained(x)
    imp = tr.importances(x.spark, t.model, t.state.features)
    return imp.agg(F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("negative"),
                   (F.count(F.lit(1)) - F.count_distinct("feature")).alias("repeated"))


@query("dealer_code:s class_follows:i")
def score_accounts_check(x: Inputs):
    t = trained(x)
    ready = pp.prepare_scoring(x.stored_features, t.state, x.settings)
    scored = tr.score(t.model, ready, t.state.features)
    return scored.select("dealer_code", (F.col("predicted_churn") == _class_of("churn_probability")).cast("int").alias("class_follows"))


@query("dealer_code:s label:s band:s")
def score_all_check(x: Inputs):
    """Label and band against plain CASE expressions over the returned probability."""
    t = trained(x)
    out = jobs.score_all(x.stored_features, t.model, t.state, x.reference, x.settings)
    label = F.expr("CASE predicted_churn WHEN 1 THEN 'Churned' ELSE 'Active' END")
    band = F.expr("""CASE WHEN churn_probability <= 0.3 THEN 'Low Risk' WHEN churn_probability <= 0.7 THEN 'Medium Risk'
                          ELSE 'High Risk' END""")
    return out.select("dealer_code", F.when(F.col("prediction_label") == label, "right").otherwise("wrong").alias("label"),
                      F.when(F.col("risk_category") == band, "right").otherwise("wrong").alias("band"))


@query("dealer_code:s adds_up:i")
def tree_contributions_check(x: Inputs):
    t = trained(x)
    parts, base = jobs.contributions(x.spark, t, t.prepared)
    total = F.aggregate("contributions", F.lit(base), lambda a, e: a + e["contribution"])
    odds = F.log(F.col("churn_probability") / (1 - F.col("churn_probability")))
    return parts.select("dealer_code", (F.abs(total - odds) < 1e-6).cast("int").alias("adds_up"))


@query("dealer_code:s n_top:i has_base:i")
def explain_all_check(x: Inputs):
    explained, _ = jobs.explain_all(x.spark, trained(x), x.settings)
    return explained.select("dealer_code", F.size("top_features").between(1, x.settings.top_features).cast("int").alias("n_top"),
                            F.col("base_value").isNotNull().cast("int").alias("has_base"))


@query("dealer_code:s explained:i")
def daily_job_check(x: Inputs):
    return _daily(x).select("dealer_code", F.col("base_value").isNotNull().cast("int").alias("explained"))


@query("dealer_code:s churn_status:s severity:r")
def append_evolve_table(x: Inputs):
    """A catalog table that gains a column with its second append, in a folder of its own."""
    name = f"evolve_{uuid.uuid4().hex}"
    first = x.life.windows.select("dealer_code", "churn_status")
    sinks.write_table(first, name)
    second = pp.with_severity(x.recent, x.settings).select("severity", "churn_status", "dealer_code")
    sinks.write_table(second, name, mode="append")
    return x.spark.table(name)
