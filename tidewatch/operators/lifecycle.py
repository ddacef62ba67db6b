"""Account lifecycle: reference date, label, inactive run, window, window sales.

The raw sales lines are reduced to one row per account and month before
anything is ordered or windowed, so the largest ordered group is the number of
calendar months in the data, whatever share of the lines one account owns.
Scalars (reference date, month axis) are scalar subqueries: one lazy plan, no
driver round trip, no cross join, and the date bound reaches the file scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import month_from_text, month_of, previous_month_end, whole_days
from tidewatch.settings import Settings


# -- scalars -------------------------------------------------------------------

def reference_point(sales: DataFrame) -> DataFrame:
    """One row: latest invoice moment and the end of the month before it."""
    newest = sales.agg(F.max("invoice_date").alias("max_invoice_date"))
    return newest.withColumn("reference_date", previous_month_end(F.col("max_invoice_date")))


def reference_value(sales: DataFrame) -> Column:
    """The reference moment as a scalar subquery, usable in any expression."""
    return reference_point(sales).select("reference_date").scalar()


def as_of_date(reference: Column, settings: Settings) -> Column:
    """Run date: the configured one, else the reference date."""
    return F.lit(settings.as_of) if settings.as_of else F.to_date(reference)


def month_axis(months: DataFrame) -> Column:
    """Sorted array of the months in which anyone bought.

    Its length is bounded by the number of calendar months in the data.
    """
    return months.agg(F.array_sort(F.collect_set("month")).alias("axis")).scalar()


# -- account level ---------------------------------------------------------------

def closed_month_sales(sales: DataFrame, reference: Column) -> DataFrame:
    """Lines up to the reference moment."""
    return sales.filter(F.col("invoice_date") <= reference)


def latest_invoices(sales: DataFrame) -> DataFrame:
    """Latest invoice moment per account."""
    return (
        sales.filter(F.col("dealer_code").isNotNull())
        .groupBy("dealer_code")
        .agg(F.max("invoice_date").alias("invoice_date"))
    )


def account_months(closed: DataFrame) -> DataFrame:
    """One row per account and month with sales: value and latest invoice.

    This is what the grid, the inactive run and the label are computed from.
    """
    return (
        closed.filter(F.col("dealer_code").isNotNull())
        .groupBy("dealer_code", month_from_text(F.col("period")).alias("month"))
        .agg(
            F.coalesce(F.sum("ndp_value"), F.lit(0.0)).alias("ndp_value"),
            F.max("invoice_date").alias("last_in_month"),
        )
    )


def activity_grid(months: DataFrame) -> DataFrame:
    """Every account for every month, with value 0 and flag 1 where absent.

    Each account gathers its own months in a map (at most one entry per
    calendar month) and unfolds the month axis over it: no cross join and no
    join of grid and facts.
    """
    per_account = (
        months.filter(F.col("month").isNotNull())
        .groupBy("dealer_code")
        .agg(F.map_from_entries(F.collect_list(F.struct("month", "ndp_value"))).alias("by_month"))
    )
    return (
        per_account.withColumn("month", F.explode(month_axis(months)))
        .withColumn("value", F.try_element_at(F.col("by_month"), F.col("month")))
        .select(
            "dealer_code",
            "month",
            F.coalesce("value", F.lit(0.0)).alias("ndp_value"),
            F.col("value").isNull().cast("int").alias("no_sales_flag"),
        )
    )


def churn_label(closed: DataFrame, reference: Column, settings: Settings) -> DataFrame:
    """Latest invoice, whole days since, and the at-risk label per account."""
    last = latest_invoices(closed).withColumnRenamed("invoice_date", "last_invoice_date")
    return _label(last, reference, settings)


def _label(last: DataFrame, reference: Column, settings: Settings) -> DataFrame:
    days = whole_days(reference, F.col("last_invoice_date"))
    status = F.when(F.col("last_billed_days") > settings.churn_days, "Churned").otherwise("Active")
    return last.withColumn("last_billed_days", days).withColumn("churn_status", status)


def _activity(months: DataFrame, axis: Column | None = None) -> DataFrame:
    """Latest invoice and longest inactive run per account, from account months and all accounts' axis.

    A run of missing months shows as a jump between the axis positions of two
    consecutive active months; the runs before the first and after the last
    active month are jumps too.  Of equally long runs the earliest wins.
    """
    # The axis is one value for all rows: kept out of them, it does not widen what is sorted.
    axis = month_axis(months) if axis is None else axis
    indexed = months.withColumn("idx", F.array_position(axis, F.col("month")))
    # Months that are null carry a latest invoice but no axis position.
    by_account = Window.partitionBy("dealer_code").orderBy(F.col("idx").asc_nulls_first())
    previous = F.coalesce(F.lag("idx").over(by_account), F.lit(0))
    runs = indexed.withColumn("gap", F.col("idx") - previous - 1).withColumn(
        "inner_run", F.struct(F.col("gap"), (-(previous + 1)).alias("order"))
    )
    rolled = runs.groupBy("dealer_code").agg(
        F.max("last_in_month").alias("last_invoice_date"),
        F.max(F.when(F.col("idx").isNotNull(), F.col("inner_run"))).alias("inner_run"),
        F.coalesce(F.max("idx"), F.lit(0)).alias("last_idx"),
    )
    tail = F.struct(
        (F.size(axis) - F.col("last_idx")).alias("gap"), (-(F.col("last_idx") + 1)).alias("order")
    )
    best = F.greatest(F.coalesce("inner_run", tail), tail)
    return rolled.withColumn("best", best).select(
        "dealer_code",
        "last_invoice_date",
        F.col("best.gap").cast("int").alias("max_no_sales_streak"),
        F.when(F.col("best.gap") > 0, F.try_element_at(axis, (-F.col("best.order")).cast("int"))).alias(
            "max_streak_start_period"
        ),
    )


def no_sales_streak(months: DataFrame) -> DataFrame:
    """Longest run of months without sales and the month it starts in."""
    return _activity(months).select("dealer_code", "max_no_sales_streak", "max_streak_start_period")


def account_lifecycle(months: DataFrame, reference: Column, settings: Settings, axis: Column | None = None) -> DataFrame:
    """Label, inactive run and analysis window of every account; ``axis`` is given where ``months`` has some accounts only."""
    labelled = _label(_activity(months, axis), reference, settings)
    return with_windows(labelled, reference, settings)


def with_windows(labelled: DataFrame, reference: Column, settings: Settings) -> DataFrame:
    """Window end rule, full-history filter and window start.

    Active accounts whose longest run is absent or began at least a year ago
    are followed up to the reference date; all others up to the run's start.
    """
    ref_day = F.to_date(reference)
    start = F.col("max_streak_start_period")
    long_ago = start.isNull() | (start <= F.add_months(ref_day, -12))
    end = F.when((F.col("churn_status") == "Active") & long_ago, ref_day).otherwise(start)
    return (
        labelled.withColumn("threshold_end_date", end)
        .filter(F.col("threshold_end_date") > F.lit(settings.min_window_end))
        .withColumn(
            "threshold_start_date",
            F.add_months(F.col("threshold_end_date"), -settings.window_months),
        )
    )


# -- window sales ------------------------------------------------------------------

def within_windows(df: DataFrame, windows: DataFrame, moment: str) -> DataFrame:
    """Rows whose moment lies inside their account's window.

    Both window ends are cut to the first of their month before the
    comparison, and both are inclusive.  ``windows`` has one row per account;
    a hot account's partition of ``df`` is split by AQE.
    """
    lower = month_of(F.col("threshold_start_date")).cast("timestamp_ntz")
    upper = month_of(F.col("threshold_end_date")).cast("timestamp_ntz")
    return df.join(windows, "dealer_code").filter(
        F.col(moment).cast("timestamp_ntz").between(lower, upper)
    )


def window_ends(windows: DataFrame) -> tuple | None:
    """First and last moment that any window of a stored table reaches: two values for the scan's filter."""
    lower, upper = month_of(F.col("threshold_start_date")), month_of(F.col("threshold_end_date"))
    row = windows.agg(F.min(lower.cast("date")).alias("low"), F.max(upper.cast("date")).alias("high")).first()
    return None if row.low is None else (row.low, row.high)


def account_window_sales(closed: DataFrame, windows: DataFrame) -> DataFrame:
    """Sales lines inside the account's window, with the account's lifecycle columns."""
    return within_windows(closed, windows, "invoice_date")


def day_lines(sales: DataFrame) -> DataFrame:
    """Lines of one account and day as one row: first and last moment, and count.

    Lines at midnight form a row of their own.  As windows begin and end at a
    midnight, every row lies completely inside or outside of a window, so this
    reduction may come before the window join.
    """
    day = F.to_date("invoice_date")
    midnight = F.col("invoice_date").cast("timestamp_ntz") == day.cast("timestamp_ntz")
    return sales.groupBy("dealer_code", day.alias("day"), midnight.alias("at_midnight")).agg(
        F.min("invoice_date").alias("first_at"),
        F.max("invoice_date").alias("last_at"),
        F.count(F.lit(1)).alias("lines"),
    )


def purchase_interval(days: DataFrame) -> DataFrame:
    """Mean whole days between consecutive sales lines of an account.

    Input are day rows (see :func:`day_lines`): lines of one day are under 24
    hours apart and count as zero-day gaps.  The ordered group is bounded by
    twice the days in a window, however many lines an account has.
    """
    by_account = Window.partitionBy("dealer_code").orderBy("first_at")
    gaps = days.withColumn(
        "gap_days", whole_days(F.col("first_at"), F.lag("last_at").over(by_account))
    )
    rolled = gaps.groupBy("dealer_code").agg(
        F.coalesce(F.sum("gap_days"), F.lit(0)).cast("double").alias("total"),
        (F.sum("lines") - 1).alias("pairs"),
    )
    return rolled.select(
        "dealer_code", F.try_divide("total", "pairs").alias("avg_days_between_purchase")
    )
