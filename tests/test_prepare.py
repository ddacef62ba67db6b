import pytest
from pyspark.sql import functions as F

from tests.helpers import day, rows_of
from tidewatch.functions import columns as fc
from tidewatch.operators import joins, prepare as pp, profile as pf
from tidewatch.settings import MODEL_LEVELS, Settings

SETTINGS = Settings()


def features(spark):
    return spark.createDataFrame(
        [("a", 10, " starter ", "N", "r1", "T2", 1.0, "Active", "5"),
         ("b", 400, "NS", "S", "r1", "T1", 1.0, "Churned", "6"),
         ("c", 365, "Non Starter", "S", None, "T10", float("inf"), "Churned", "x"),
         ("d", 300, None, None, "r2", "T2", None, "Churned", None)],
        "dealer_code string, last_billed_days int, dealer_club_category string, zone string, region_name string, "
        "territory_code string, rotation double, churn_status string, note string",
    )


def test_model_levels_fold_case_and_blank(spark):
    df = spark.createDataFrame([(" starter ",), ("Non Starter",), (None,), ("ns",)], "c string")
    got = [r[0] for r in df.select(fc.level_of(F.col("c"), MODEL_LEVELS, fold_case=True)).collect()]
    assert got == [1, None, None, 0]


def test_training_preparation(spark):
    df = features(spark)
    state = pp.fit_preparation(df, SETTINGS)
    assert rows_of(state.codes(spark), "territory_code_encoded") == [("T10", 0), ("T2", 1)]
    assert state.categories == {"zone": ["N", "S"], "region_name": ["r1", "r2"]}
    got = {r["dealer_code"]: r.asDict() for r in pp.prepare_training(df, state, SETTINGS).collect()}
    assert set(got) == {"a", "c", "d"}
    assert got["a"]["dealer_club_category"] == 1 and got["a"]["churn_status"] == 0
    assert (got["a"]["zone_N"], got["a"]["zone_S"]) == (1, 0)
    assert (got["d"]["zone_N"], got["d"]["zone_S"], got["d"]["region_name_r2"]) == (0, 0, 1)
    assert got["c"]["rotation"] == 0.0 and got["c"]["note"] == 0.0 and got["c"]["territory_code_encoded"] == 0
    assert "last_billed_days" not in got["a"] and "severity" not in got["a"]


def test_scoring_aligns_and_rejects_unseen_codes(spark):
    df = features(spark)
    state = pp.fit_preparation(df, SETTINGS)
    ready = pp.prepare_scoring(df.drop("note"), state, SETTINGS)
    assert ready.columns == ["dealer_code", *state.features]
    assert {r["note"] for r in ready.collect()} == {0.0}
    unseen = df.withColumn("territory_code", F.lit("T99"))
    with pytest.raises(Exception, match="unseen territory_code: T99"):
        pp.prepare_scoring(unseen, state, SETTINGS).collect()
    lenient = Settings(unseen_codes="outside")
    assert {r["territory_code_encoded"] for r in pp.prepare_scoring(unseen, state, lenient).collect()} == {-1.0}


def test_missing_territory_gets_the_last_code(spark):
    df = features(spark)
    some = df.withColumn("territory_code", F.when(F.col("dealer_code") != "a", F.col("territory_code")))
    state = pp.fit_preparation(some, SETTINGS)
    known = state.codes(spark).count() - 1
    for ready in (pp.prepare_training(some, state, SETTINGS), pp.prepare_scoring(some, state, SETTINGS)):
        got = {r["dealer_code"]: r["territory_code_encoded"] for r in ready.collect()}
        assert got["a"] == known and all(v < known for k, v in got.items() if k != "a")
    full = pp.fit_preparation(df, SETTINGS)
    with pytest.raises(Exception, match="unseen territory_code: null"):
        pp.prepare_scoring(some, full, SETTINGS).collect()
    lenient = Settings(unseen_codes="outside")
    assert -1.0 in {r["territory_code_encoded"] for r in pp.prepare_scoring(some, full, lenient).collect()}


def test_state_survives_saving(spark, tmp_path):
    state = pp.fit_preparation(features(spark), SETTINGS)
    state.save(spark, str(tmp_path / "state"))
    loaded = pp.PrepState.load(spark, str(tmp_path / "state"))
    assert (loaded.categories, loaded.features) == (state.categories, state.features)
    assert rows_of(loaded.codes(spark), "territory_code") == rows_of(state.codes(spark), "territory_code")


def test_label_codes_are_sorted_positions(spark):
    values = ["b", "aa", "ab", "a", "zz", "z", "10", "9", "é"]
    df = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "c string")
    got = dict(rows_of(pp.label_codes(df, "c")))
    assert got == {v: i for i, v in enumerate(sorted(values))} | {None: len(values)}


def test_label_encode_policy(spark):
    df = spark.createDataFrame([("x",), ("y",)], "c string")
    codes = pp.label_codes(df.filter("c = 'x'"), "c")
    with pytest.raises(Exception, match="unseen c: y"):
        pp.label_encode(df, "c", codes, SETTINGS).collect()
    assert sorted(r[0] for r in pp.label_encode(df, "c", codes, Settings(unseen_codes="outside")).collect()) == [-1, 0]


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(4000).selectExpr("cast(id as string) as dealer_code", "if(id < 13, 1, if(id < 20, null, 0)) as churn_status")
    split = pp.with_split(df, SETTINGS)
    sides = {(r[0], r[1]): r[2] for r in split.groupBy("churn_status", "dataset").count().collect()}
    assert sum(sides.values()) == 4000
    for label, n in ((1, 13), (None, 7), (0, 3980)):
        assert sides[label, "test"] == round(0.2 * n) and sides[label, "train"] == n - round(0.2 * n)
    assert pp.split_union(split).exceptAll(split).count() == 0
    again = pp.with_split(df.repartition(3), SETTINGS)
    assert split.exceptAll(again).count() == 0


def test_stored_rows_are_split_alike_without_being_written_again(spark, monkeypatch):
    df = spark.createDataFrame([(str(i // 2), i % 3 if i % 3 < 2 else None, "x" * 50) for i in range(300)],
                               "dealer_code string, churn_status int, wide string")
    ranked = pp.with_class_rank(df, SETTINGS.seed)
    test = F.col("_rank") < F.round(F.lit(SETTINGS.test_share) * F.col("_size"))
    by_rank = ranked.select("dealer_code", "churn_status", F.when(test, "test").otherwise("train").alias("dataset"))
    written = []
    monkeypatch.setattr(pp, "stage", lambda rows, label: written.append(label) or rows)
    split = pp.with_split(df, SETTINGS, stored=True)
    assert written == [] and split.columns == [*df.columns, "dataset"]
    assert sorted(map(str, split.drop("wide").collect())) == sorted(map(str, by_rank.collect()))


def test_coercion(spark):
    df = spark.createDataFrame([("12",), ("x",), ("",), (None,), (" 3.5 ",)], "t string")
    assert [r[0] for r in pf.coerce_numeric(df, ["t"]).collect()] == [12.0, 0.0, 0.0, 0.0, 3.5]
    assert [r[0] for r in pf.coerce_numeric(df, ["t"], None).collect()] == [12.0, None, None, None, 3.5]
    dates = spark.createDataFrame([("2024-13-01",), ("2024-02-03",), (None,)], "t string")
    got = [r[0] for r in pf.coerce_dates(dates, ["t", "absent"]).collect()]
    assert got == [None, day("2024-02-03"), None]


def test_fill_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, "b", None), (2, None, "a", None), (3, 3.0, "a", None), (4, None, None, None), (5, None, "b", None)],
                               "id int, n double, t string, e string")
    got = rows_of(pf.fill_nulls(df, ["n", "t", "e"]), "id")
    assert [r[1] for r in got] == [1.0, 2.0, 3.0, 2.0, 2.0]
    assert got[3][2] == "a" and {r[3] for r in got} == {"Unknown"}


def test_quality_and_profile(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, None)], "n int, t string")
    quality = {r["column_name"]: r for r in pf.quality_report(df).collect()}
    assert quality["n"]["null_count"] == 1 and quality["t"]["null_count"] == 2
    assert quality["n"]["duplicate_rows"] == 1 and quality["n"]["n_rows"] == 4
    profile = {r["column_name"]: r for r in pf.column_profile(df).collect()}
    assert (profile["n"]["unique_values"], profile["n"]["min_value"], profile["n"]["max_value"]) == (2, 1.0, 2.0)
    assert (profile["t"]["unique_values"], profile["t"]["min_value"]) == (1, None)


def test_quality_report_by_fingerprint(spark):
    """Repeats and nulls of a wide frame against groups of whole rows; only fingerprints are shuffled."""
    import random

    rng = random.Random(3)
    names = [f"c{k}" for k in range(70)]
    rows = [tuple(rng.choice([None, "x", "y"]) if k in (0, 1, 68, 69) else "same" for k in range(70)) for _ in range(300)]
    rows += [(None, "x", *["same"] * 66, "x", None), ("x", None, *["same"] * 66, None, "x")] * 2
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {r["column_name"]: r for r in pf.quality_report(df).collect()}
    for k, name in enumerate(names):
        assert got[name]["null_count"] == sum(r[k] is None for r in rows)
    one = got["c0"]
    assert (one["n_rows"], one["n_columns"], one["duplicate_rows"]) == (304, 70, 304 - len(set(rows)))
    text = pf.quality_report(df)._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Exchange" in line:
            assert "c0" not in line and "c69" not in line
    numbers = spark.createDataFrame([(0.0, float("nan")), (-0.0, float("nan")), (1.0, None)], "a double, b double")
    assert pf.quality_report(numbers).first()["duplicate_rows"] == 1
    assert pf.quality_report(numbers.limit(0)).first()["n_rows"] == 0


def test_required_columns(spark):
    df = spark.range(1)
    assert pf.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="lacks columns"):
        pf.require_columns(df, ["id", "nope"])


def test_checked_join(spark):
    a = spark.createDataFrame([(1, "l")], "k int, l string")
    b = spark.createDataFrame([(1, "r"), (1, "s")], "k int, r string")
    with pytest.raises(ValueError, match="missing on the right"):
        joins.checked_join(a, b.withColumnRenamed("k", "q"), "k")
    assert joins.checked_join(a, b, "k").count() == 2
    with pytest.raises(Exception, match="duplicate key 1"):
        joins.checked_join(a, b, "k", unique_right=True).collect()


def test_salted_lookup_equals_plain_join(spark):
    facts = spark.range(500).selectExpr("id", "if(id < 400, 'hot', cast(id as string)) as k")
    dim = spark.createDataFrame([("hot", 1), ("450", 2)], "k string, v int")
    got = joins.salted_lookup(facts, dim, ["k"], F.col("id"))
    assert got.exceptAll(facts.join(dim, "k", "left").select(*got.columns)).count() == 0
    assert got.count() == 500
