"""Scalar expressions.  All of them stay inside generated JVM code."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# -- SQL text ------------------------------------------------------------------
# Projections of several hundred columns are written as SQL text: one parser
# call per column instead of a Python-to-JVM call per operator.

def name_sql(name: str) -> str:
    """Quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    """Quoted text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def finite_or_zero_sql(value: str) -> str:
    """SQL text: null, NaN and infinite numbers as 0."""
    number = f"CAST({value} AS DOUBLE)"
    return f"coalesce(CASE WHEN abs({number}) < DOUBLE('infinity') THEN {number} END, 0D)"


def level_sql(value: str, levels: Mapping[str, int]) -> str:
    """SQL text of :func:`level_of` with folded case."""
    pairs = ", ".join(f"{text_sql(name)}, {level}" for name, level in levels.items())
    return f"try_element_at(map({pairs}), upper(trim({value})))"


# -- months and dates --------------------------------------------------------

def month_of(moment: Column) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(moment, "MM")


def month_from_text(text: Column, *, dashed: bool = True) -> Column:
    """Month start from ``yyyy-MM`` text, or from ``yyyyMM`` when not dashed.

    Null stays null.  Text that is not exactly such a month fails the job.
    """
    text = text.cast("string")
    pattern = r"^[0-9]{4}-[0-9]{2}$" if dashed else r"^[0-9]{6}$"
    year, month = F.substring(text, 1, 4), F.substring(text, 6 if dashed else 5, 2)
    wrong = F.raise_error(F.concat(F.lit("not a month: "), text)).cast("date")
    return F.when(text.rlike(pattern), F.make_date(year.cast("int"), month.cast("int"), F.lit(1))).when(
        text.isNotNull(), wrong
    )


def month_text(month: Column) -> Column:
    """Month start rendered as ``yyyy-MM``."""
    return F.date_format(month, "yyyy-MM")


def whole_days(later: Column, earlier: Column) -> Column:
    """Complete 24-hour days from ``earlier`` to ``later``."""
    return F.timestamp_diff("DAY", earlier, later).cast("int")


def age_in_years(created: Column, as_of: Column) -> Column:
    """Age in 365-day years, rounded down."""
    return F.floor(F.datediff(as_of, created) / F.lit(365)).cast("int")


def previous_month_end(moment: Column) -> Column:
    """Same time of day on the last day of the month before ``moment``."""
    return moment - F.make_dt_interval(F.dayofmonth(moment))


# -- cleaning ----------------------------------------------------------------

def invoice_key(invoice: Column) -> Column:
    """Invoice number without a decimal suffix (``123.0`` -> ``123``)."""
    return F.substring_index(invoice.cast("string"), ".", 1)


def number_or_null(value: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    return F.trim(value.cast("string")).try_cast("double")


def moment_or_null(value: Column, pattern: str | None = None) -> Column:
    """Text to timestamp; anything that does not parse becomes null."""
    text = value.cast("string")
    return F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)


# -- measures ----------------------------------------------------------------

def float_ratio(num: Column, den: Column) -> Column:
    """Division with IEEE meaning for a zero divisor, except that 0/0 is null.

    A null result is skipped by ``avg`` while an infinity is kept, which is how
    a mean over a floating point column with missing values behaves.
    """
    inf = float("inf")
    on_zero = F.when(num > 0, F.lit(inf)).when(num < 0, F.lit(-inf))
    return F.when(den == 0, on_zero).otherwise(num / F.nullif(den, F.lit(0.0)))


def level_of(name: Column, levels: Mapping[str, int], *, fold_case: bool = False) -> Column:
    """Rank of an ordered category; null when the name is not in the map."""
    key = F.upper(F.trim(name)) if fold_case else name
    table = F.create_map(*[F.lit(x) for pair in levels.items() for x in pair])
    return F.try_element_at(table, key)


def movement(previous: Column, current: Column, unmoved_label: str = "no_change") -> Column:
    """Direction of a level change; null when the previous level is unknown."""
    return (
        F.when(previous.isNull(), F.lit(None).cast("string"))
        .when(current > previous, F.lit("Promoted"))
        .when(current < previous, F.lit("Demoted"))
        .otherwise(F.lit(unmoved_label))
    )


def claim_state(status: Column, settled: Sequence[str]) -> Column:
    """``Settled`` for the listed states, ``Active`` for all others and null."""
    return F.when(status.isin(*settled), F.lit("Settled")).otherwise(F.lit("Active"))


# -- scores ------------------------------------------------------------------

def clamp_score(probability: Column, floor: float) -> Column:
    """Tiny probabilities become 0; the rest is rounded half-even to 5 places."""
    return F.when(probability < floor, F.lit(0.0)).otherwise(F.bround(probability, 5))


def risk_band(probability: Column) -> Column:
    """Band of a clamped probability: [0, .3], (.3, .7], (.7, 1]."""
    return (
        F.when((probability < 0) | (probability > 1), F.lit(None).cast("string"))
        .when(probability <= 0.3, F.lit("Low Risk"))
        .when(probability <= 0.7, F.lit("Medium Risk"))
        .when(probability <= 1.0, F.lit("High Risk"))
    )


def class_label(code: Column) -> Column:
    """0/1 to the class name; other codes give null."""
    return F.when(code == 0, F.lit("Active")).when(code == 1, F.lit("Churned"))


def class_code(label: Column) -> Column:
    """Class name to 0/1; other names give null."""
    return F.when(label == "Active", F.lit(0)).when(label == "Churned", F.lit(1))


def hash_bucket(key: Column, seed: int, buckets: int = 10_000) -> Column:
    """Stable bucket number of a key, the same in every run and engine."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)


def hash_place(key: Column, seed: int) -> Column:
    """Stable 60-bit number of a key, the same in every run and engine."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


# -- explanation maps ----------------------------------------------------------

MAP_COLUMNS = ("positive_features", "negative_features", "top_features")


def maps_to_json(explained: DataFrame) -> DataFrame:
    """The three maps of an explanation as JSON text, for text-only sinks."""
    return explained.withColumns({c: F.to_json(c) for c in MAP_COLUMNS})
