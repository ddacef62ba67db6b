"""One account with most of the rows: results stay exact and the work is split."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import SALES_SCHEMA, rows_of
from tidewatch.operators import lifecycle as lc
from tidewatch.operators import measures as ms

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def lines(spark):
    """60,000 lines, a third of them of one account."""
    rng = random.Random(1)
    start = dt.datetime(2023, 1, 1)
    rows = []
    for i in range(60_000):
        account = "hot" if i % 3 == 0 else f"a{rng.randint(0, 400)}"
        when = start + dt.timedelta(days=rng.randint(0, 500), hours=rng.choice((0, 0, 9)))
        rows.append((account, when, when.strftime("%Y-%m"), float(rng.randint(1, 9)), f"{rng.randint(0, 9000)}.0", 1.0, None, "F2"))
    return spark.createDataFrame(rows, SALES_SCHEMA).repartition(6).cache(), rows


def windows_of(spark, rows):
    accounts = sorted({r[0] for r in rows})
    return spark.createDataFrame(
        [(a, dt.date(2023, 3, 1), dt.date(2024, 3, 1)) for a in accounts],
        "dealer_code string, threshold_start_date date, threshold_end_date date",
    )


def test_hot_account_is_split_and_exact(spark, lines, no_broadcast):
    frame, rows = lines
    totals = ms.monthly_totals(lc.account_window_sales(frame, windows_of(spark, rows)))
    got = {(r[0], r[1]): tuple(r[2:]) for r in totals.collect()}
    want = {}
    low, high = dt.datetime(2023, 3, 1), dt.datetime(2024, 3, 1)
    for account, when, period, value, invoice, volume, *_ in rows:
        if low <= when <= high:
            key = (account, dt.date.fromisoformat(period + "-01"))
            sums = want.setdefault(key, [0.0, set(), 0.0])
            sums[0] += value
            sums[1].add(invoice)
            sums[2] += volume
    assert got == {k: (v[0], len(v[1]), v[2]) for k, v in want.items()}
    assert "skew=true" in totals._jdf.queryExecution().executedPlan().toString()


def test_interval_of_hot_account_orders_days_not_lines(spark, lines, no_broadcast):
    frame, rows = lines
    days = lc.within_windows(lc.day_lines(frame), windows_of(spark, rows), "first_at")
    assert days.filter("dealer_code = 'hot'").count() <= 2 * 367
    got = dict(rows_of(lc.purchase_interval(days)))
    low, high = dt.datetime(2023, 3, 1), dt.datetime(2024, 3, 1)
    moments = sorted(r[1] for r in rows if r[0] == "hot" and low <= r[1] <= high)
    gaps = [(b - a).days for a, b in zip(moments, moments[1:])]
    assert got["hot"] == pytest.approx(sum(gaps) / len(gaps))


def test_group_of_null_invoices_is_reduced_before_the_shuffle(spark, no_broadcast):
    rows = [("hot", dt.datetime(2023, 5, 1), "2023-05", 1.0, None, 1.0, None, "F2")] * 5000
    rows += [("b", dt.datetime(2023, 4, 1), "2023-04", 1.0, None, 1.0, None, "F2"),
             ("b", dt.datetime(2023, 4, 1), "2023-04", 1.0, "7.0", 1.0, None, "F2")]
    sales = spark.createDataFrame(rows, SALES_SCHEMA)
    orders = spark.createDataFrame([("b", "7")], "dealer_code string, products_invoiceNumber string")
    got = ms.order_channel(sales, orders)
    assert rows_of(got) == [("b", dt.date(2023, 4, 1), 1, 1, 2)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_peers_of_a_hot_territory(spark, no_broadcast):
    monthly = spark.range(30_000).select(
        F.col("id").cast("string").alias("dealer_code"), F.lit(dt.date(2024, 1, 1)).alias("month"),
        F.col("id").cast("double").alias("total_sales"), F.lit(1).alias("total_invoices"), F.lit(1.0).alias("total_units"),
        F.when(F.col("id") < 20_000, "t").otherwise(F.col("id").cast("string")).alias("territory_code"),
        F.lit("c").alias("dealer_club_category"),
    )
    out = ms.with_peer_means(monthly)
    name = "avg_sales_of_dealers_in_same_territory"
    assert out.count() == 30_000
    assert out.filter("territory_code = 't'").agg(F.min(name), F.max(name)).first() == (9999.5, 9999.5)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
