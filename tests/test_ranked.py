import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from tidewatch.operators import profile as pf
from tidewatch.operators.ranked import quantiles, running_totals


def values(kind):
    rng = random.Random(5)
    if kind == "spread":
        return [rng.random() for _ in range(700)]
    if kind == "hot":
        return [0.25] * 400 + [rng.random() for _ in range(300)]
    if kind == "tiny range":
        return [1e-9 * rng.randint(0, 60) for _ in range(500)]
    return [3.0]


@pytest.mark.parametrize("kind", ["spread", "hot", "tiny range", "single"])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_are_exact(spark, kind, descending):
    data = values(kind)
    df = spark.createDataFrame([(v,) for v in data], "v double").repartition(3)
    got = running_totals(df, [], "v", {"n": F.count(F.lit(1))}, descending=descending)
    assert {r["all_n"] for r in got.collect()} == {df.where("v IS NOT NULL").count()}
    for v, n, before, _ in rows_of(got):
        assert n == data.count(v)
        assert before == sum(1 for x in data if (x > v if descending else x < v))


@pytest.mark.parametrize("kind", ["spread", "hot", "tiny range", "single"])
def test_quantiles_interpolate(spark, kind):
    data = values(kind)
    df = spark.createDataFrame([("g", v) for v in data] + [("h", 1.0), ("h", 2.0), ("h", None)], "g string, v double")
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", {"q1": 0.25, "m": 0.5, "q9": 0.9}).collect()}
    for name, share in (("q1", 0.25), ("m", 0.5), ("q9", 0.9)):
        assert got["g"][name] == pytest.approx(np.quantile(data, share), abs=1e-12)
    assert got["h"]["m"] == 1.5


def test_iqr_outliers(spark):
    df = spark.createDataFrame([(i, float(v), "t") for i, v in enumerate([1, 2, 3, 4, 100])], "k int, v double, t string")
    assert rows_of(pf.iqr_outliers(df, "k", ["v", "t"])) == [(4, "v", 100.0)]
