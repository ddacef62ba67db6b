"""Sales lines that are read several times are written once."""

import datetime as dt

from checks import queries as q


def test_sales_of_a_year_are_read_without_the_others(spark, tmp_path):
    days = [dt.datetime(1995, 2, 1), dt.datetime(1996, 3, 1), dt.datetime(1996, 3, 2), None]
    orders = [(k, k, day, "1-URGENT", "F", 1.0) for k, day in enumerate(days)]
    lines = [(k % 4, 1, 1.0, 2.0, 0.1, "R", "F", days[0]) for k in range(9)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string, "
                          "o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    x = q.Inputs(spark, str(tmp_path))
    stored, raw = q._sales_by_year(x), x.raw["sales_data"]
    assert stored.drop("_year").dtypes == raw.dtypes
    assert sorted(map(str, stored.drop("_year").collect())) == sorted(map(str, raw.collect()))
    assert {f.split("_year=")[1].split("/")[0] for f in stored.inputFiles()} == {"1995", "1996", "__HIVE_DEFAULT_PARTITION__"}
    assert stored.where("_year IS NULL").count() == 2
    profile = {r["column_name"]: r for r in q._daily_profile(x, stored).collect()}
    assert profile["volume"]["n_rows"] == 9 and profile["invoice_date"]["null_count"] == 2
