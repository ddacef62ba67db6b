"""Sketched profiles against exact ones, and merged parts against the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import sketches as sk


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = [(str(int(k)), float(v), int(k) if k % 7 else None, f"2024-01-{1 + i % 3:02}")
            for i, (k, v) in enumerate(zip(rng.integers(0, 4000, 20_000), rng.exponential(10, 20_000)))]
    return spark.createDataFrame(rows, "name string, v double, n int, day string").repartition(6)


def rank_of(values, q):
    return (values < q).mean(), (values <= q).mean()


def test_profile_is_within_its_stated_errors(spark, frame, tmp_path):
    root = str(tmp_path / "profile")
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        sk.add_day(spark, root, day, frame.where(F.col("day") == day), ["name", "v", "n"])
    sk.add_day(spark, root, "2024-01-02", frame.where("day = '2024-01-02'"), ["name", "v", "n"])  # loaded again
    merged = {r["column_name"]: r for r in sk.read_profile(spark, root).collect()}
    whole = {r["column_name"]: r for r in sk.merged_profile(sk.sketch_profile(frame, ["name", "v", "n"])).collect()}
    table = frame.toPandas()
    for c in ("name", "v", "n"):
        values, got = table[c].dropna(), merged[c]
        assert (got["n_rows"], got["null_count"]) == (20_000, int(table[c].isna().sum()))
        assert abs(got["distinct_values"] - values.nunique()) <= sk.DISTINCT_ERROR * values.nunique()
        assert got["distinct_values"] == whole[c]["distinct_values"]  # the union of sketches is the sketch of the union
        if c != "name":
            assert (got["min_value"], got["max_value"]) == (values.min(), values.max())
            for name, share in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
                for one in (got, whole[c]):
                    low, high = rank_of(values.to_numpy(), one[name])
                    assert low - sk.RANK_ERROR <= share <= high + sk.RANK_ERROR
    assert merged["name"]["median"] is None
    one = {r["column_name"]: r for r in sk.read_profile(spark, root, "2024-01-02", "2024-01-02").collect()}
    assert one["v"]["n_rows"] == int((table["day"] == "2024-01-02").sum())


def test_columns_of_nulls_and_empty_frames(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "a double, b string")
    rows = {r["column_name"]: r for r in sk.merged_profile(sk.sketch_profile(df).union(sk.sketch_profile(df.limit(0)))).collect()}
    assert (rows["a"]["n_rows"], rows["a"]["null_count"], rows["a"]["distinct_values"], rows["a"]["median"]) == (2, 2, 0, None)
    assert (rows["b"]["null_count"], rows["b"]["distinct_values"]) == (2, 0)
