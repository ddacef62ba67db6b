"""Prediction tables from scores: bands, top lists, lookups, summaries."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import clamp_score, class_label, name_sql, risk_band
from tidewatch.settings import Settings


def classify(probability: Column, threshold: float = 0.5) -> Column:
    """1 at or above the threshold, else 0."""
    return (probability >= threshold).cast("int")


def prediction_results(scored: DataFrame, as_of: Column, settings: Settings) -> DataFrame:
    """Clamped probability, label, band and stamp per account.

    ``scored`` has ``dealer_code``, ``predicted_churn`` and ``churn_probability``;
    further columns (the features, when asked for) follow unchanged.
    """
    main = ("dealer_code", "predicted_churn", "churn_probability")
    rest = [name_sql(c) for c in scored.columns if c not in main]
    p = clamp_score(F.col("churn_probability"), settings.confidence_floor)
    return scored.withColumn("churn_probability", p).select(
        *main,
        class_label(F.col("predicted_churn")).alias("prediction_label"),
        risk_band(F.col("churn_probability")).alias("risk_category"),
        F.date_format(as_of, "yyyy-MM-dd HH:mm:ss").alias("prediction_timestamp"),
        *rest,
    )


def high_risk(results: DataFrame, settings: Settings) -> DataFrame:
    """Accounts at or above the high-risk threshold, riskiest first."""
    return results.filter(F.col("churn_probability") >= settings.high_risk_threshold).orderBy(
        F.col("churn_probability").desc(), "dealer_code"
    )


def top_risk(results: DataFrame, n: int = 10) -> DataFrame:
    """The n riskiest accounts; each task keeps only its own n."""
    return results.orderBy(F.col("churn_probability").desc(), "dealer_code").limit(n)


def for_accounts(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Rows of the listed accounts (a user's list; it reaches the scan)."""
    return df.filter(F.col("dealer_code").isin(*[str(c) for c in codes]))


def lookup(df: DataFrame, code: str) -> DataFrame:
    """The row of one account, or no row."""
    return df.filter(F.col("dealer_code") == str(code)).limit(1)


def prediction_summary(results: DataFrame) -> DataFrame:
    """Totals, band shares and probability statistics, one row.

    The probability has 5 decimals, hence at most 100,001 distinct values,
    which is what the exact median keeps.
    """
    n = F.count(F.lit(1))
    p = F.col("churn_probability")

    def band(name: str) -> Column:
        return F.count_if(F.col("risk_category") == name)

    return results.agg(
        n.alias("n_accounts"),
        F.sum("predicted_churn").alias("n_churn"),
        (F.sum("predicted_churn") * 100.0 / n).alias("churn_rate"),
        band("Low Risk").alias("n_low"),
        band("Medium Risk").alias("n_medium"),
        band("High Risk").alias("n_high"),
        (band("Low Risk") * 100.0 / n).alias("low_share"),
        (band("Medium Risk") * 100.0 / n).alias("medium_share"),
        (band("High Risk") * 100.0 / n).alias("high_share"),
        F.avg(p).alias("mean_probability"),
        F.percentile(p, F.lit(0.5)).alias("median_probability"),
        F.max(p).alias("max_probability"),
        F.min(p).alias("min_probability"),
    )


def with_territory(results: DataFrame, accounts: DataFrame) -> DataFrame:
    """Predictions with the account's territory."""
    return results.join(accounts.select("dealer_code", "territory_code"), "dealer_code", "left")


def run_stamp(moment: Column, zone: str) -> Column:
    """Calendar date of a UTC moment in a named zone."""
    return F.to_date(F.from_utc_timestamp(moment, zone))
