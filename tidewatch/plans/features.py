"""The feature build: source tables to one wide row per account.

Raw fact rows are reduced by account before they are restricted to the accounts
in scope, because the account list of a large master cannot be sent to every
task.  The only join that meets raw rows is the one of sales lines and account
windows.

A few small results are read by several later steps: the reference date (one
row), the account months, the account windows (one row per account) and the
monthly sales (at most 13 rows per account).  ``build_*`` writes each of them
once through ``stage`` so that the sales lines are scanned a fixed number of
times; pass ``keep_lazy`` to get a single lazy plan instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import lifecycle as lc
from tidewatch.operators import measures as ms
from tidewatch.operators import widen as wd
from tidewatch.session import stage as write_and_reread
from tidewatch.settings import Settings
from tidewatch.sources.tables import Catalog, in_scope

Stage = Callable[[DataFrame, str], DataFrame]


def keep_lazy(df: DataFrame, label: str) -> DataFrame:
    """A stage that does nothing."""
    return df


@dataclass(frozen=True)
class Lifecycle:
    """The frames of the lifecycle step."""

    reference: Column
    closed: DataFrame  # valid lines of all accounts up to the reference
    windows: DataFrame  # accounts in scope with a complete window
    ends: tuple | None = None  # first and last moment of all windows, where these are stored

    @property
    def in_range(self) -> DataFrame:
        """Lines that some window may hold; stored windows bound the scan by date."""
        if self.ends is None:
            return self.closed
        return self.closed.filter(F.col("invoice_date").between(*[F.lit(e).cast("timestamp_ntz") for e in self.ends]))

    @property
    def window_sales(self) -> DataFrame:
        return lc.account_window_sales(self.in_range, self.windows)

    @property
    def window_days(self) -> DataFrame:
        return lc.within_windows(lc.day_lines(self.in_range), self.windows, "first_at")


def build_lifecycle(catalog: Catalog, settings: Settings, stage: Stage = keep_lazy) -> Lifecycle:
    """Reference date, account windows and window sales."""
    sales, accounts = catalog.unrestricted("sales_data"), catalog["customer_master"]
    if settings.reference:
        reference = F.lit(settings.reference).cast("timestamp_ntz")
    else:
        point = lc.reference_point(in_scope(lc.latest_invoices(sales), accounts))
        reference = stage(point, "reference").select("reference_date").scalar()
    closed = lc.closed_month_sales(sales, reference)
    months = stage(in_scope(lc.account_months(closed), accounts), "months")
    windows = stage(lc.account_lifecycle(months, reference, settings), "windows")
    return Lifecycle(reference, closed, windows, None if stage is keep_lazy else lc.window_ends(windows))


def build_monthly(catalog: Catalog, life: Lifecycle, stage: Stage = keep_lazy) -> DataFrame:
    """Monthly sales and rotation of the windows, with averages and group means.

    The rows are written before the means, which read them once per group.
    """
    clubs = ms.club_month_shift(catalog.unrestricted("monthly_club_mapping"), life.reference)
    grouped = ms.with_groups(ms.monthly_totals(life.window_sales), catalog["customer_master"])
    monthly = stage(ms.add_rotation(grouped, clubs), "monthly")
    return ms.with_peers_and_rotation_means(ms.with_month_averages(monthly))


def build_monthly_wide(catalog: Catalog, monthly: DataFrame, settings: Settings) -> DataFrame:
    """All monthly features on (account, month).

    ``monthly`` has the accounts in scope only, so the left joins restrict the
    other facts; only the two that count something once over all accounts need
    the account list itself.
    """
    accounts = catalog["customer_master"]
    return wd.monthly_wide(
        monthly,
        ms.financial_month(catalog.unrestricted("customer_financial")),
        ms.credit_notes(catalog.unrestricted("credit_note")),
        ms.order_channel(
            catalog.unrestricted("sales_data"), catalog.unrestricted("orders_online"), accounts
        ),
        ms.claim_counts(catalog.unrestricted("claims_data"), settings, accounts),
        ms.visit_counts(catalog.unrestricted("visits_flat")),
    )


def build_features(
    catalog: Catalog, settings: Settings, stage: Stage = write_and_reread
) -> DataFrame:
    """The wide feature table of every account with sales in its window."""
    life = build_lifecycle(catalog, settings, stage)
    monthly = build_monthly(catalog, life, stage)
    wide = build_monthly_wide(catalog, monthly, settings)
    maps = wd.month_maps(wd.with_relative_month(wide, settings))
    as_of = lc.as_of_date(life.reference, settings)
    clubs = ms.club_month_shift(catalog.unrestricted("monthly_club_mapping"), life.reference)
    return wd.account_features(
        maps,
        ms.account_age(catalog["customer_master"], as_of),
        lc.purchase_interval(life.window_days),
        ms.club_movement(clubs, settings),
        catalog["territory_master"],
        life.windows,
        settings,
    )
