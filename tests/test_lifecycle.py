import datetime as dt

import pytest
from tests.helpers import day, ref, rows_of, sales_frame
from tidewatch.operators import lifecycle as lc
from tidewatch.settings import Settings

SETTINGS = Settings(min_window_end=dt.date(2022, 12, 1))


def streaks(spark, rows):
    out = lc.no_sales_streak(lc.account_months(sales_frame(spark, rows)))
    return {r[0]: (r[1], r[2]) for r in rows_of(out)}


def month_day(m):
    return f"2023-{m:02d}-10"


def test_reference_is_last_day_of_previous_month(spark):
    sales = sales_frame(spark, [("a", "2024-03-15", 1.0), ("a", "2024-01-02", 1.0)])
    assert rows_of(lc.reference_point(sales)) == [(day("2024-03-15"), day("2024-02-29"))]


def test_reference_keeps_time_of_day(spark):
    sales = sales_frame(spark, [("a", "2024-03-15 10:30:00", 1.0)])
    assert rows_of(lc.reference_point(sales))[0][1] == day("2024-02-29 10:30:00")


def test_streak_tie_keeps_the_earlier_run(spark):
    full = [("z", month_day(m), 1.0) for m in range(1, 9)]
    got = streaks(spark, full + [("a", month_day(m), 1.0) for m in (1, 4, 5, 8)])
    assert got["a"] == (2, dt.date(2023, 2, 1))
    assert got["z"] == (0, None)


def test_streak_leading_and_trailing_gap(spark):
    full = [("z", month_day(m), 1.0) for m in range(1, 9)]
    got = streaks(spark, full + [("lead", month_day(m), 1.0) for m in (5, 7, 8)]
                  + [("tail", month_day(m), 1.0) for m in (1, 2, 4)])
    assert got["lead"] == (4, dt.date(2023, 1, 1))
    assert got["tail"] == (4, dt.date(2023, 5, 1))


def test_rows_are_ordered_without_the_month_axis(spark):
    months = lc.account_months(sales_frame(spark, [("a", month_day(m), 1.0) for m in (1, 4)] + [("b", month_day(2), 1.0)]))
    plan = lc.no_sales_streak(months)._jdf.queryExecution().optimizedPlan()
    windows = [line for line in plan.toString().splitlines() if "axis#" in line and "max(axis" not in line and "array_sort" not in line]
    assert windows == []


def test_month_nobody_sold_in_is_no_gap(spark):
    got = streaks(spark, [("a", month_day(1), 1.0), ("a", month_day(3), 1.0), ("b", month_day(3), 1.0)])
    assert got == {"a": (0, None), "b": (1, dt.date(2023, 1, 1))}


def test_null_values_still_count_as_a_sale(spark):
    got = streaks(spark, [("a", month_day(1), None), ("b", month_day(1), 1.0), ("b", month_day(2), 1.0)])
    assert got["a"] == (1, dt.date(2023, 2, 1))


def test_grid_matches_streak_axis(spark):
    sales = sales_frame(spark, [("a", month_day(1), 2.0), ("b", month_day(2), None), ("b", month_day(2), 3.0)])
    got = rows_of(lc.activity_grid(lc.account_months(sales)), "dealer_code", "month")
    jan, feb = dt.date(2023, 1, 1), dt.date(2023, 2, 1)
    assert got == [("a", jan, 2.0, 0), ("a", feb, 0.0, 1), ("b", jan, 0.0, 1), ("b", feb, 3.0, 0)]


def test_streak_agrees_with_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [("z", month_day(m), 1.0) for m in range(1, 13)]
    months = {}
    for i in range(40):
        chosen = sorted(rng.sample(range(1, 13), rng.randint(1, 11)))
        months[f"a{i}"] = chosen
        rows += [(f"a{i}", month_day(m), 1.0) for m in chosen]
    got = streaks(spark, rows)
    for account, chosen in months.items():
        best, start, run, run_start = 0, None, 0, None
        for m in range(1, 13):
            if m in chosen:
                run = 0
            else:
                run_start = m if run == 0 else run_start
                run += 1
                if run > best:
                    best, start = run, dt.date(2023, run_start, 1)
        assert got[account] == (best, start)


@pytest.mark.parametrize(
    "status,start,expected",
    [
        ("Active", None, dt.date(2024, 5, 31)),
        ("Active", dt.date(2023, 5, 1), dt.date(2024, 5, 31)),
        ("Active", dt.date(2024, 1, 1), dt.date(2024, 1, 1)),
        ("Churned", dt.date(2023, 9, 1), dt.date(2023, 9, 1)),
        ("Churned", None, None),
        ("Churned", dt.date(2022, 12, 1), None),
    ],
)
def test_window_end_rule(spark, status, start, expected):
    labelled = spark.createDataFrame(
        [("a", status, start)], "dealer_code string, churn_status string, max_streak_start_period date"
    )
    got = rows_of(lc.with_windows(labelled, ref("2024-05-31"), SETTINGS).select("threshold_end_date"))
    assert got == ([(expected,)] if expected else [])


def test_window_ends_are_cut_to_month_start_and_inclusive(spark):
    sales = sales_frame(
        spark,
        [("a", "2023-05-01", 1.0), ("a", "2023-04-30", 2.0), ("a", "2024-05-01", 3.0), ("a", "2024-05-02", 4.0)],
    )
    windows = spark.createDataFrame(
        [("a", dt.date(2023, 5, 31), dt.date(2024, 5, 31))],
        "dealer_code string, threshold_start_date date, threshold_end_date date",
    )
    got = lc.account_window_sales(sales, windows).select("ndp_value")
    assert sorted(r[0] for r in got.collect()) == [1.0, 3.0]


def test_label_boundary_at_ninety_days(spark):
    sales = sales_frame(spark, [("a", "2024-03-02", 1.0), ("b", "2024-03-01", 1.0)])
    got = rows_of(lc.churn_label(sales, ref("2024-05-31"), SETTINGS).select(
        "dealer_code", "last_billed_days", "churn_status"), "dealer_code")
    assert got == [("a", 90, "Active"), ("b", 91, "Churned")]


def test_purchase_interval_equals_line_by_line_mean(spark):
    moments = ["2024-01-01 10:00:00", "2024-01-01 12:00:00", "2024-01-03 09:00:00", "2024-01-03 09:00:00",
               "2024-01-10 23:00:00"]
    sales = sales_frame(spark, [("a", m, 1.0) for m in moments] + [("b", moments[0], 1.0)])
    ordered = sorted(day(m) for m in moments)
    gaps = [(y - x).days for x, y in zip(ordered, ordered[1:])]
    got = dict(rows_of(lc.purchase_interval(lc.day_lines(sales))))
    assert got == {"a": sum(gaps) / len(gaps), "b": None}


def test_day_rows_may_be_cut_by_windows(spark):
    """Reducing to days before the window join gives the mean of the lines inside."""
    moments = ["2023-04-30 23:00:00", "2023-05-01 00:00:00", "2023-05-01 06:00:00", "2023-05-09 05:00:00",
               "2024-05-01 00:00:00", "2024-05-01 00:00:00", "2024-05-01 00:00:01", "2024-05-02 00:00:00"]
    sales = sales_frame(spark, [("a", m, 1.0) for m in moments])
    windows = spark.createDataFrame(
        [("a", dt.date(2023, 5, 31), dt.date(2024, 5, 31))],
        "dealer_code string, threshold_start_date date, threshold_end_date date",
    )
    inside = [day(m) for m in moments[1:6]]
    gaps = [(y - x).days for x, y in zip(inside, inside[1:])]
    early = lc.purchase_interval(lc.within_windows(lc.day_lines(sales), windows, "first_at"))
    late = lc.purchase_interval(lc.day_lines(lc.account_window_sales(sales, windows)))
    assert rows_of(early) == rows_of(late) == [("a", sum(gaps) / len(gaps))]
