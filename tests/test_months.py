"""Sales lines stored by month: windows prune months, and results stay those of the unpruned join."""

import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import rows_of, sales_frame
from tidewatch.operators import lifecycle as lc
from tidewatch.sources import months

WINDOW_SCHEMA = "dealer_code string, threshold_start_date date, threshold_end_date date"


def lines(spark):
    rows = [("a", "2023-01-31T10:00", 1.0), ("a", "2023-03-01", 2.0), ("a", "2023-03-15", 3.0), ("a", "2023-05-01", 4.0),
            ("a", "2023-05-01T00:01", 5.0), ("b", "2023-03-02", 6.0), ("b", "2023-09-30", 7.0), ("c", "2023-12-01", 8.0)]
    dateless = sales_frame(spark, [("a", "2023-04-01", 9.0)]).withColumn("invoice_date", F.lit(None).cast("timestamp_ntz"))
    return sales_frame(spark, rows).unionByName(dateless)


def test_windows_prune_months_and_keep_every_line(spark, tmp_path):
    sales, path = lines(spark), str(tmp_path / "months")
    windows = spark.createDataFrame(
        [("a", dt.date(2023, 3, 20), dt.date(2023, 5, 9)), ("b", dt.date(2023, 9, 1), dt.date(2023, 9, 30))], WINDOW_SCHEMA)
    reached = months.window_months(windows)
    assert reached == [dt.date(2023, 3, 1), dt.date(2023, 4, 1), dt.date(2023, 5, 1), dt.date(2023, 9, 1)]
    stored = months.read_months(spark, path, months.store_by_month(sales, path), reached)
    assert stored.columns == sales.columns
    plan = stored._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "invoice_month" in filters
    folders = {r[0].split("invoice_month=")[1].split("/")[0] for r in stored.select(F.input_file_name()).distinct().collect()}
    assert folders == {"2023-03-01", "2023-05-01", "2023-09-01"}
    got = rows_of(lc.account_window_sales(stored, windows).select("ndp_value"), "ndp_value")
    assert got == rows_of(lc.account_window_sales(sales, windows).select("ndp_value"), "ndp_value") == [(2.0,), (3.0,), (4.0,)]


def test_no_window_reads_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    schema = months.store_by_month(lines(spark), path)
    windows = spark.createDataFrame([("a", None, dt.date(2023, 5, 1)), ("b", dt.date(2023, 5, 1), dt.date(2023, 1, 1))], WINDOW_SCHEMA)
    assert months.window_months(windows) == []
    assert months.read_months(spark, path, schema, []).count() == 0


def test_empty_sales(spark, tmp_path):
    path = str(tmp_path / "empty")
    schema = months.store_by_month(lines(spark).limit(0), path)
    assert months.read_months(spark, path, schema, [dt.date(2023, 1, 1)]).count() == 0
