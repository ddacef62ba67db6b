import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests.helpers import day, ref, rows_of, sales_frame
from tidewatch.functions import columns as fc
from tidewatch.operators import measures as ms
from tidewatch.operators import widen as wd
from tidewatch.settings import Settings

SETTINGS = Settings()
JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


def test_totals_count_distinct_invoices_and_treat_null_sums_as_zero(spark):
    sales = sales_frame(spark, [("a", "2024-01-01", 5.0, "1"), ("a", "2024-01-02", None, "1"),
                                ("a", "2024-02-02", None, None)])
    got = rows_of(ms.monthly_totals(sales), "month")
    assert got == [("a", JAN, 5.0, 1, 2.0), ("a", FEB, 0.0, 0, 1.0)]


def test_peer_means_leave_out_null_groups(spark):
    monthly = spark.createDataFrame(
        [("a", JAN, 10.0, 1, 1.0, "t", None), ("b", JAN, 20.0, 3, 1.0, "t", "c"), ("c", JAN, 90.0, 3, 1.0, None, "c")],
        "dealer_code string, month date, total_sales double, total_invoices bigint, total_units double, "
        "territory_code string, dealer_club_category string",
    )
    got = ms.with_peer_means(monthly).select(
        "dealer_code", "avg_sales_of_dealers_in_same_territory", "avg_sales_of_dealers_in_same_dealer_club_category"
    )
    assert rows_of(got, "dealer_code") == [("a", 15.0, None), ("b", 15.0, 55.0), ("c", None, 55.0)]


def test_ratio_by_zero(spark):
    df = spark.createDataFrame([(6.0, 3.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, None)], "n double, d double")
    got = [r[0] for r in df.select(fc.float_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [2.0, math.inf, -math.inf, None, None]


def test_rotation_mean_keeps_infinity_and_skips_null(spark):
    monthly = spark.createDataFrame(
        [("a", JAN, 10.0, "t", "x"), ("b", JAN, 5.0, "t", "y"), ("c", JAN, 0.0, "u", "y")],
        "dealer_code string, month date, total_sales double, territory_code string, dealer_club_category string",
    )
    plan = spark.createDataFrame([("a", JAN, 5.0), ("b", JAN, 0.0), ("c", JAN, 0.0)],
                                 "dealer_code string, month date, sas_amount double")
    got = rows_of(ms.with_rotation(monthly, plan).select(
        "dealer_code", "rotation", "terrwise_rotation", "dealerclub_wise_rotation"), "dealer_code")
    assert got == [("a", 2.0, math.inf, 2.0), ("b", math.inf, math.inf, math.inf), ("c", None, None, math.inf)]


def test_club_movement_rules(spark):
    rows = [
        ("up", "2024-02", "Starter"), ("up", "2024-03", "Blue Club"), ("up", "2024-04", "Blue Club"),
        ("down", "2024-02", "Blue Club"), ("down", "2024-03", "Non Starter"),
        ("odd", "2024-02", "Mystery"), ("odd", "2024-03", "Starter"), ("odd", "2024-04", "Mystery"),
        ("single", "2024-02", "Starter"),
    ]
    clubs = spark.createDataFrame([(a, p, 1.0, c) for a, p, c in rows],
                                  "dealer_code string, period string, sas_amount double, dealer_club string")
    shifted = ms.club_month_shift(clubs, ref("2024-03-31"))
    assert {r[0] for r in shifted.select("month").distinct().collect()} == {JAN, FEB, MAR}
    got = {r[0]: r[1:] for r in rows_of(ms.club_movement(shifted, SETTINGS))}
    # columns: Demoted, Promoted, no_change; unknown current = no change, unknown previous = not counted
    assert got == {"up": (0, 1, 1), "down": (1, 0, 0), "odd": (0, 0, 1)}


def test_club_month_after_reference_is_dropped(spark):
    clubs = spark.createDataFrame([("a", "2024-05", 1.0, "Starter"), ("a", "2024-04", 1.0, "Starter")],
                                  "dealer_code string, period string, sas_amount double, dealer_club string")
    assert rows_of(ms.club_month_shift(clubs, ref("2024-03-31")).select("month")) == [(MAR,)]


def test_order_channel_counts_each_invoice_once(spark):
    sales = sales_frame(spark, [
        ("a", "2024-01-05", 1.0, "123.0"), ("a", "2024-01-05", 1.0, "123.0"),
        ("b", "2024-02-05", 1.0, "123.0"),          # same invoice elsewhere, later: not counted
        ("b", "2024-02-05", 1.0, "77.0"),
        ("a", "2024-02-01", 1.0, None), ("b", "2024-02-01", 1.0, None),  # null invoices collapse to one
    ])
    orders = spark.createDataFrame([("a", "123"), ("a", "123"), ("a", "77")],
                                   "dealer_code string, products_invoiceNumber string")
    got = rows_of(ms.order_channel(sales, orders), "dealer_code", "month")
    assert got == [("a", JAN, 0, 1, 1), ("a", FEB, 1, 0, 1), ("b", FEB, 1, 0, 1)]


def test_claims_settle_once_and_keep_nulls(spark):
    claims = spark.createDataFrame(
        [("a", "1", day("2024-01-05"), "Inspection Accepted"), ("a", "1", day("2024-02-05"), "Inspection Accepted"),
         ("a", "2", day("2024-02-06"), None), ("a", "3", day("2024-01-07"), "Open")],
        "dealer_code string, ClaimNo string, ClaimDate timestamp_ntz, ClaimStatus string",
    )
    got = rows_of(ms.claim_counts(claims, SETTINGS), "month")
    assert got == [("a", JAN, 2, 1, 1), ("a", FEB, 2, None, None)]


def test_visits_need_completion(spark):
    visits = spark.createDataFrame(
        [("a", "1", day("2024-01-05"), True), ("a", "1", day("2024-01-06"), True), ("a", "2", day("2024-01-06"), None),
         ("a", "3", day("2024-01-06"), False)],
        "dealer_code string, _id string, updatedAt timestamp_ntz, completed boolean",
    )
    assert rows_of(ms.visit_counts(visits)) == [("a", JAN, 1)]


def test_relative_month_skips_labels_and_drops_the_thirteenth(spark):
    months = [dt.date(2023, m, 1) for m in range(1, 13)] + [JAN]
    monthly = spark.createDataFrame(
        [("a", m, 1.0) for m in months] + [("b", JAN, 1.0), ("b", MAR, 2.0)],
        "dealer_code string, month date, total_sales double",
    )
    got = rows_of(wd.relative_month(monthly, SETTINGS).select("dealer_code", "month", "cm_label"), "dealer_code", "month")
    assert [r[2] for r in got if r[0] == "a"] == [f"cm-{n}" for n in range(12, 0, -1)]
    assert [r[2] for r in got if r[0] == "b"] == ["cm-3", "cm-1"]


def test_pivot_unpivots_to_its_input(spark):
    rows = [("a", 1, 10.0, 2), ("a", 3, 30.0, None), ("b", 12, 5.0, 1)]
    wide = spark.createDataFrame(rows, "dealer_code string, rel_month int, total_sales double, online bigint")
    got = wd.feature_pivot(wide, SETTINGS, ["total_sales", "online"])
    assert len(got.columns) == 25
    back = [(r["dealer_code"], n, r[f"total_sales_cm-{n}"], r[f"online_cm-{n}"])
            for r in got.collect() for n in range(1, 13)
            if r[f"total_sales_cm-{n}"] is not None]
    assert sorted(back) == rows


def test_pivot_fails_on_a_repeated_month(spark):
    wide = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0)], "dealer_code string, rel_month int, total_sales double")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY|[Dd]uplicate"):
        wd.feature_pivot(wide, SETTINGS, ["total_sales"]).collect()


def test_age_in_365_day_years(spark):
    df = spark.createDataFrame([("a", dt.date(2023, 1, 1))], "dealer_code string, creation_date date")
    got = ms.account_age(df, F.lit(dt.date(2024, 1, 1))).first()["dealership_age"]
    assert got == 1
    assert ms.account_age(df, F.lit(dt.date(2023, 12, 31))).first()["dealership_age"] == 0


def test_market_share_ignores_text(spark):
    df = spark.createDataFrame([("t", "10", "x"), ("t", "5", "5"), ("u", None, "n/a")], "territory string, a string, b string")
    got = rows_of(ms.market_share(df, "territory", ["a", "b"]), "territory")
    assert got == [("t", 15.0, 5.0, 20.0, 75.0, 25.0), ("u", 0.0, 0.0, 0.0, None, None)]


def test_change_from_previous(spark):
    df = spark.createDataFrame([("a", JAN, 2.0), ("a", FEB, 3.0), ("a", MAR, 0.0)], "g string, month date, v double")
    got = [r[0] for r in ms.change_from_previous(df, "g", "month", ["v"], "d_").orderBy("month").select("d_v").collect()]
    assert got == [None, 0.5, -1.0]
