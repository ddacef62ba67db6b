"""Strict month text, the work folder, and tables that gain columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from tidewatch import session
from tidewatch.functions.columns import month_from_text
from tidewatch.sources import sinks


@pytest.mark.parametrize("dashed, good, bad", [
    (True, "2024-01", ["202401", "2024-1", "2024-01-01", "", " 2024-01", "2024-13"]),
    (False, "202401", ["2024-01", "20240199", "2024", "", "202413"]),
])
def test_month_text_is_exact(spark, dashed, good, bad):
    def parsed(values):
        df = spark.createDataFrame([(v,) for v in values], "t string")
        return [r[0] for r in df.select(month_from_text(F.col("t"), dashed=dashed)).collect()]

    assert parsed([good, None]) == [dt.date(2024, 1, 1), None]
    for text in bad:
        with pytest.raises(Exception, match="not a month|Invalid value|DATETIME"):
            parsed([text])


class Elsewhere:
    """A session whose tasks run on other machines and which names no shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "local-cluster[2,1,1024]"
        applicationId = "elsewhere"


class Here(Elsewhere):
    class sparkContext(Elsewhere.sparkContext):  # noqa: N801
        master = "local[2]"


def test_a_cluster_needs_a_named_work_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Elsewhere(), "x")
    assert session.work_dir(Here(), "x").startswith(session.work_root(Here()) + "/x-")
    assert session.work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_job_removes_what_it_staged(spark):
    with session.job_folder(spark, "job") as path:
        frame = session.stage(spark.range(5), "numbers")
        assert frame.inputFiles()[0].split("file://")[-1].startswith(path) and frame.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FileNotFound|does not exist"):
        spark.read.parquet(path).count()
    assert not session.work_dir(spark, "after").startswith(path)


def test_appending_to_a_table_adds_columns_by_name(spark):
    name = "default.t_evolving"
    sinks.write_table(spark.createDataFrame([("a", 1)], "k string, n int"), name)
    sinks.write_table(spark.createDataFrame([(2.5, "b")], "score double, k string"), name, mode="append")
    sinks.write_table(spark.createDataFrame([("c", 3)], "k string, n int"), name, mode="append")
    assert spark.table(name).columns == ["k", "n", "score"]
    assert rows_of(spark.table(name), "k") == [("a", 1, None), ("b", None, 2.5), ("c", 3, None)]
    with pytest.raises(Exception):
        sinks.write_table(spark.range(1), name, mode="append", merge_schema=False)
