"""Monthly measures per account from the seven fact tables.

Every fact table is reduced by account and month with map-side combining
before it is shuffled.  Where a row per invoice or claim has to be picked, it is
picked by a ``min`` over a struct, not by a window: the group of null invoices
may be large, and a minimum never gathers a group.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.columns import (
    age_in_years,
    claim_state,
    float_ratio,
    invoice_key,
    level_of,
    month_from_text,
    month_of,
    movement,
)
from tidewatch.operators.joins import salted_lookup
from tidewatch.settings import Settings
from tidewatch.sources.tables import in_scope

# Group column -> {measure: name of its mean over the group's accounts}
PEER_MEANS = {
    "territory_code": {
        "total_sales": "avg_sales_of_dealers_in_same_territory",
        "total_invoices": "avg_orders_of_dealers_in_same_territory",
        "total_units": "avg_units_of_dealers_in_same_territory",
    },
    "dealer_club_category": {
        "total_sales": "avg_sales_of_dealers_in_same_dealer_club_category",
        "total_invoices": "avg_orders_of_dealers_in_dealer_club_category",
        "total_units": "avg_units_of_dealers_in_dealer_club_category",
    },
}
ROTATION_MEANS = {
    "territory_code": {"rotation": "terrwise_rotation"},
    "dealer_club_category": {"rotation": "dealerclub_wise_rotation"},
}


def account_age(accounts: DataFrame, as_of: Column) -> DataFrame:
    """Account master with the age in 365-day years."""
    return accounts.withColumn("dealership_age", age_in_years(F.to_date("creation_date"), as_of))


# -- sales -------------------------------------------------------------------

def monthly_totals(window_sales: DataFrame) -> DataFrame:
    """Value, distinct invoices and units by account and month.

    Spark plans the single distinct as two levels keyed by the invoice, so a
    hot account's month is spread over the cluster.
    """
    return (
        window_sales.withColumn("month", month_from_text(F.col("period")))
        .filter(F.col("dealer_code").isNotNull() & F.col("month").isNotNull())
        .groupBy("dealer_code", "month")
        .agg(
            F.coalesce(F.sum("ndp_value"), F.lit(0.0)).alias("total_sales"),
            F.countDistinct("invoice_number").alias("total_invoices"),
            F.coalesce(F.sum("volume"), F.lit(0.0)).alias("total_units"),
        )
    )


def month_count(totals: DataFrame) -> Column:
    """Number of months in which any account sold (a scalar subquery)."""
    return totals.agg(F.countDistinct("month").alias("n")).scalar()


def with_groups(totals: DataFrame, accounts: DataFrame) -> DataFrame:
    """Monthly totals with the account's territory and club."""
    groups = accounts.select("dealer_code", "territory_code", "dealer_club_category")
    return totals.join(groups, "dealer_code", "left")


def with_month_averages(monthly: DataFrame) -> DataFrame:
    """Each total over the number of months in which any account sold."""
    n = month_count(monthly)
    return monthly.withColumns(
        {
            "avg_invoices": F.col("total_invoices") / n,
            "avg_sales": F.col("total_sales") / n,
            "avg_units_purchased": F.col("total_units") / n,
        }
    )


def monthly_sales(totals: DataFrame, accounts: DataFrame) -> DataFrame:
    """Monthly totals with both of the above."""
    return with_groups(with_month_averages(totals), accounts)


def group_means(monthly: DataFrame, group: str, means: Mapping[str, str]) -> DataFrame:
    """Mean of each measure per group and month; null groups are left out.

    ``means`` maps a measure to the name of its mean.
    """
    return (
        monthly.filter(F.col(group).isNotNull())
        .groupBy(group, "month")
        .agg(*[F.avg(measure).alias(name) for measure, name in means.items()])
    )


def with_group_means(monthly: DataFrame, groups: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Add the means of the account's groups in the same month.

    A territory or club may hold a third of all accounts: the means are
    pre-aggregated and looked up with a salted key, never windowed.
    """
    out = monthly
    for group, means in groups.items():
        table = group_means(monthly, group, means)
        out = salted_lookup(out, table, [group, "month"], F.col("dealer_code"))
    return out


def with_peer_means(monthly: DataFrame) -> DataFrame:
    """Sales, order and unit means of the account's territory and club."""
    return with_group_means(monthly, PEER_MEANS)


# -- stock plan and club ---------------------------------------------------------

def club_month_shift(club_mapping: DataFrame, reference: Column) -> DataFrame:
    """Club mapping moved to the month it describes, up to the reference month.

    The source reports a month late.
    """
    shifted = F.add_months(month_from_text(F.col("period")), -1)
    return club_mapping.withColumn("month", shifted).filter(
        F.col("month") <= month_of(F.to_date(reference))
    )


def add_rotation(monthly: DataFrame, shifted_clubs: DataFrame) -> DataFrame:
    """Stock plan of the month and sales over stock plan."""
    plan = shifted_clubs.select(
        "dealer_code", "month", F.col("sas_amount").cast("double").alias("sas_amount")
    )
    return monthly.join(plan, ["dealer_code", "month"], "left").withColumn(
        "rotation", float_ratio(F.col("total_sales"), F.col("sas_amount"))
    )


def with_rotation(monthly: DataFrame, shifted_clubs: DataFrame) -> DataFrame:
    """Rotation with its territory and club means."""
    return with_group_means(add_rotation(monthly, shifted_clubs), ROTATION_MEANS)


def with_peers_and_rotation_means(monthly: DataFrame) -> DataFrame:
    """All group means with one aggregate and one lookup per group."""
    both = {g: {**PEER_MEANS[g], **ROTATION_MEANS[g]} for g in PEER_MEANS}
    return with_group_means(monthly, both)


def club_moves(shifted_clubs: DataFrame, settings: Settings) -> DataFrame:
    """Movement of every account month against the account's previous month.

    The mapping has one row per account and month, so a window holds at most
    as many rows as there are calendar months.
    """
    by_account = Window.partitionBy("dealer_code").orderBy("month")
    levels = settings.movement_levels
    return shifted_clubs.withColumn("prev_dealer_club", F.lag("dealer_club").over(by_account)).withColumn(
        "club_movement",
        movement(
            level_of(F.col("prev_dealer_club"), levels),
            level_of(F.col("dealer_club"), levels),
            settings.unmoved_label,
        ),
    )


def club_movement(shifted_clubs: DataFrame, settings: Settings) -> DataFrame:
    """Counts of demotions, promotions and unchanged months per account.

    Accounts without any counted month have no row.
    """
    moves = club_moves(shifted_clubs, settings).filter(F.col("club_movement").isNotNull())
    return moves.groupBy("dealer_code").agg(
        *[
            F.count_if(F.col("club_movement") == label).alias(label)
            for label in ("Demoted", "Promoted", settings.unmoved_label)
        ]
    )


# -- money owed and credited -------------------------------------------------------

BALANCES = (
    "exposure",
    "collection",
    "outstanding",
    "outstanding_0_30",
    "outstanding_30_45",
    "outstanding_45_60",
    "outstanding_60+",
)


def financial_month(financial: DataFrame) -> DataFrame:
    """Balances with the ``yyyyMM`` month parsed; numbers become doubles."""
    return financial.select(
        "dealer_code",
        month_from_text(F.col("period"), dashed=False).alias("month"),
        *[F.col(f"`{c}`").cast("double").alias(c) for c in BALANCES],
    )


def credit_notes(notes: DataFrame) -> DataFrame:
    """Sum and mean credit note value by account and month."""
    return (
        notes.withColumn("month", month_from_text(F.col("period")))
        .filter(F.col("dealer_code").isNotNull() & F.col("month").isNotNull())
        .groupBy("dealer_code", "month")
        .agg(
            F.coalesce(F.sum("note_value"), F.lit(0.0)).alias("total_credit_note_value"),
            F.avg("note_value").alias("avg_credit_note_value"),
        )
    )


# -- orders, claims, visits ---------------------------------------------------------

def order_channel(
    sales: DataFrame, online_orders: DataFrame, accounts: DataFrame | None = None
) -> DataFrame:
    """Online and offline invoices by account and month.

    Each invoice number counts once, in its earliest month (then lowest
    account); it is online when the order system knows it for that account.
    Input are all loaded sales, not only the windows.  When the sales still
    hold accounts out of scope, pass ``accounts``: they are left out after the
    lines have been reduced to invoices.
    """
    # Lines are first hashed down to one row per invoice and account (a date is
    # a fixed-width buffer); only that smaller set is sorted for the struct.
    per_account = sales.groupBy(
        invoice_key(F.col("invoice_number")).alias("invoice_number"), "dealer_code"
    ).agg(F.min(month_from_text(F.col("period"))).alias("month"))
    if accounts is not None:
        per_account = in_scope(per_account, accounts)
    invoices = (
        per_account.groupBy("invoice_number")
        .agg(F.min(F.struct("month", "dealer_code")).alias("first"))
        .select("invoice_number", "first.month", "first.dealer_code")
        .filter(F.col("dealer_code").isNotNull() & F.col("month").isNotNull())
    )
    known = (
        online_orders.select(
            "dealer_code", F.col("products_invoiceNumber").cast("string").alias("invoice_number")
        )
        .distinct()
        .withColumn("is_online", F.lit(True))
    )
    flagged = invoices.join(known, ["dealer_code", "invoice_number"], "left")
    return (
        flagged.groupBy("dealer_code", "month")
        .agg(
            F.count_if(F.col("is_online").isNull()).alias("offline"),
            F.count_if(F.col("is_online").isNotNull()).alias("online"),
        )
        .withColumn("total_orders", F.col("offline") + F.col("online"))
    )


def claim_counts(
    claims: DataFrame, settings: Settings, accounts: DataFrame | None = None
) -> DataFrame:
    """Distinct, settled and still active claims by account and month.

    A settled claim number counts once overall, at its earliest claim date
    (then lowest account).  Months without a settled claim keep a null for
    both the settled and the active count.  ``accounts`` as in
    :func:`order_channel`.
    """
    known = claims.filter(F.col("dealer_code").isNotNull() & F.col("ClaimDate").isNotNull())
    totals = known.groupBy("dealer_code", month_of(F.col("ClaimDate")).alias("month")).agg(
        F.countDistinct("ClaimNo").alias("unique_claims")
    )
    state = claim_state(F.col("ClaimStatus"), settings.settled_statuses)
    per_account = (
        known.filter(state == "Settled")
        .groupBy("ClaimNo", "dealer_code")
        .agg(F.min("ClaimDate").alias("ClaimDate"))
    )
    if accounts is not None:
        per_account = in_scope(per_account, accounts)
    settled = (
        per_account.groupBy("ClaimNo")
        .agg(F.min(F.struct("ClaimDate", "dealer_code")).alias("first"))
        .groupBy("first.dealer_code", month_of(F.col("first.ClaimDate")).alias("month"))
        .agg(F.count("ClaimNo").alias("settled_claims"))
    )
    return totals.join(settled, ["dealer_code", "month"], "left").withColumn(
        "active_claims", F.col("unique_claims") - F.col("settled_claims")
    )


def visit_counts(visits: DataFrame) -> DataFrame:
    """Distinct completed visits by account and month."""
    return (
        visits.filter(F.coalesce(F.col("completed"), F.lit(False)))
        .withColumn("month", month_of(F.col("updatedAt")))
        .filter(F.col("dealer_code").isNotNull() & F.col("month").isNotNull())
        .groupBy("dealer_code", "month")
        .agg(F.countDistinct("_id").alias("visit_count"))
    )


# -- optional measures ----------------------------------------------------------------

def change_from_previous(
    df: DataFrame, group: str, order: str, measures: Sequence[str], prefix: str
) -> DataFrame:
    """Relative change of each measure against the group's previous row.

    ``df`` has one row per group and month.
    """
    window = Window.partitionBy(group).orderBy(order)
    return df.select(
        "*",
        *[
            (F.try_divide(F.col(m), F.lag(m).over(window)) - 1).alias(f"{prefix}{m}")
            for m in measures
        ],
    )


def market_share(df: DataFrame, territory: str, companies: Sequence[str]) -> DataFrame:
    """Each company's percentage of its territory's total.

    Values that are not numbers are ignored.
    """
    sums = df.filter(F.col(territory).isNotNull()).groupBy(territory).agg(
        *[
            F.coalesce(F.sum(F.trim(F.col(c).cast("string")).try_cast("double")), F.lit(0.0)).alias(c)
            for c in companies
        ]
    )
    total = sum((F.col(c) for c in companies[1:]), F.col(companies[0]))
    return sums.withColumn("total", total).withColumns(
        {f"{c}_share": F.try_divide(F.col(c), F.col("total")) * 100 for c in companies}
    )
