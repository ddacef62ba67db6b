import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.fixtures import SETTINGS, raw_catalog
from tests.conftest import SF_SMALL
from tests.helpers import rows_of
from tidewatch.session import work_dir
from tidewatch.settings import Settings
from tidewatch.sources import contracts, sinks
from tidewatch.sources import tables as tb

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([("a", 1, 2.5), ("b", None, None)], "k string, n int, v double")


def test_tables_round_trip_and_versions(spark, frame):
    sinks.write_table(frame, "default.t_plain", partition_by=["k"])
    assert rows_of(tb.read_table(spark, "default.t_plain", ["n", "k"]), "k") == [(1, "a"), (None, "b")]
    assert tb.read_table(spark, "default.t_plain", limit=1).count() == 1
    assert tb.read_table(spark, "default.t_plain", limit=0).count() == 2
    stamped = sinks.write_table_at(frame, "default.t", now=NOW)
    assert stamped == "default.t_20240506_070809" and spark.table(stamped).count() == 2
    unique = sinks.write_table_unique(frame, "default.t")
    assert len(unique.rsplit("_", 1)[1]) == 8 and spark.table(unique).count() == 2
    assert sinks.write_feature_set(frame, "m", "v1", now=NOW) == "m_features_v1_20240506_070809"
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_table(frame, "default.t_plain", mode="error")
    sinks.write_table(frame, "default.t_plain", mode="ignore")
    with pytest.raises(ValueError, match="write mode"):
        sinks.write_table(frame, "default.t_plain", mode="replace")


def test_appends_gain_columns(spark, frame, tmp_path):
    path = str(tmp_path / "grow")
    sinks.append_evolving(frame, path)
    sinks.append_evolving(frame.withColumn("extra", F.lit("x")), path)
    got = sinks.read_evolving(spark, path)
    assert sorted(got.columns) == ["extra", "k", "n", "v"] and got.count() == 4
    assert got.filter("extra is null").count() == 2


def test_csv_with_and_without_contract(spark, tmp_path):
    frame = spark.createDataFrame([("007", 1, 2.5, dt.date(2024, 1, 2)), ("b", None, None, None)], "k string, n int, v double, d date")
    path, contract = contracts.save_csv_with_contract(frame, str(tmp_path / "c"), str(tmp_path / "s"))
    back = contracts.load_csv(spark, path, contract)
    assert back.dtypes == frame.dtypes and rows_of(back, "k") == rows_of(frame, "k")
    assert contracts.load_csv(spark, path).columns == frame.columns


def test_dataset_with_table(spark, frame, tmp_path):
    out = contracts.save_dataset(frame, str(tmp_path / "set"), "default.t_set")
    assert rows_of(contracts.load_csv(spark, out["csv"], out["contract"]), "k") == rows_of(frame, "k")
    text = contracts.load_table(spark, "default.t_set", out["contract"])
    assert contracts.matches(text, frame.schema) and text.count() == 2


def test_contract_demo_frame(spark, tmp_path):
    demo = spark.createDataFrame(
        [("D001", "NS", 30, "Active", 1.5, 10), ("D002", "STARTER", 60, "Churned", 2.7, 20), ("D003", "BLUE CLUB", 90, "Active", 3.2, 15)],
        "dealer_code string, dealer_club_category string, last_billed_days int, churn_status string, numeric_feature double, dealer_count int",
    )
    contract = contracts.load_contract(spark, contracts.save_contract(demo, str(tmp_path / "s")))
    assert contracts.type_summary(contract) == {"string": 3, "int": 2, "double": 1}
    text = demo.select(*[F.col(c).cast("string") for c in demo.columns])
    assert not contracts.matches(text, contract)
    diff = {r["column_name"]: r for r in contracts.contract_diff(text, contract).collect()}
    assert set(diff) == {"last_billed_days", "numeric_feature", "dealer_count"} and diff["dealer_count"]["n_values"] == 3
    restored = contracts.restore(text, contract)
    assert contracts.matches(restored, contract) and rows_of(restored) == rows_of(demo)
    assert contracts.contract_diff(restored, contract).count() == 0


def test_result_sinks(spark, frame, tmp_path):
    for save in (sinks.save_predictions, sinks.save_metrics, sinks.save_importances, sinks.save_explanations):
        assert spark.read.option("header", "true").csv(save(frame, str(tmp_path / save.__name__))).count() == 2
    paths = sinks.save_bundle({"p": frame}, str(tmp_path / "b"), NOW)
    assert paths["p"].endswith("p_20240506_070809")


def test_work_folder_is_the_sessions(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_sales_filters(spark):
    odd = spark.createDataFrame(
        [("a", 1.0, None, "F2"), ("a", 2.0, "X", "F2"), ("a", 3.0, None, "S1"), ("a", 4.0, None, None), ("z", 5.0, None, "F2")],
        "dealer_code string, ndp_value double, indicator_cancel string, invoice_type string",
    )
    full = odd.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("invoice_date", "timestamp_ntz"), ("period", "string"), ("invoice_number", "string"), ("volume", "double"))])
    master = spark.createDataFrame([("a", "Z001"), ("z", "Z002")], "dealer_code string, dealer_group string")
    accounts = tb.load_accounts(master, Settings())
    assert rows_of(tb.load_sales(full, accounts, Settings()).select("ndp_value")) == [(1.0,)]


def test_catalog_is_lazy_and_complete(spark):
    catalog = tb.load_catalog(raw_catalog(spark, SF_SMALL), SETTINGS)
    assert {"product_master", "territory_master", "orders_online"} <= set(catalog)
    assert catalog["orders_online"].columns == ["dealer_code", "products_invoiceNumber"]
    scope = catalog["customer_master"].select("dealer_code")
    for name in tb.ACCOUNT_KEYS:
        assert catalog[name].join(scope, "dealer_code", "left_anti").count() == 0


def test_named_tables_make_a_catalog(spark):
    raw = raw_catalog(spark, SF_SMALL)
    names = {n: f"default.src_{n}" for n in ("customer_master", "sales_data", "credit_note")}
    for name, table in names.items():
        sinks.write_table(raw[name], table)
    got = tb.read_catalog(spark, names, SETTINGS)
    want = tb.load_catalog({n: raw[n] for n in names}, SETTINGS)
    for name in names:
        assert got[name].count() == want[name].count() > 0
