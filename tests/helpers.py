"""Small frames for hand-written cases."""

import datetime as dt

from pyspark.sql import functions as F

SALES_SCHEMA = (
    "dealer_code string, invoice_date timestamp_ntz, period string, ndp_value double, "
    "invoice_number string, volume double, indicator_cancel string, invoice_type string"
)


def day(text):
    return dt.datetime.fromisoformat(text)


def sales_frame(spark, rows):
    """rows: (account, day text, value[, invoice number])"""
    full = []
    for i, row in enumerate(rows):
        account, when, value, *rest = row
        invoice = rest[0] if rest else f"{i}.0"
        moment = day(when)
        full.append((account, moment, moment.strftime("%Y-%m"), value, invoice, 1.0, None, "F2"))
    return spark.createDataFrame(full, SALES_SCHEMA)


def ref(text):
    return F.lit(day(text)).cast("timestamp_ntz")


def rows_of(df, *order):
    df = df.orderBy(*order) if order else df
    return [tuple(r) for r in df.collect()]
