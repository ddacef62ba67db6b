"""The lifecycle state after deltas against a full rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows_of
from tidewatch.operators import lifecycle as lc
from tidewatch.plans import incremental as inc
from tidewatch.settings import Settings
from tidewatch.sources import versions
from tidewatch.sources.tables import in_scope

LINES = "dealer_code string, invoice_date string, period string, ndp_value double"


def lines(spark, rows):
    return spark.createDataFrame(rows, LINES).withColumn("invoice_date", F.to_timestamp_ntz("invoice_date"))


def sales(seed, n=400):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        y, m = rng.choice([2021, 2022, 2023]), rng.randint(1, 12)
        d = rng.choice([1, 15, 27, 28, 30 if m != 2 else 28])
        if rng.random() < 0.2:
            d = {2: 28, 4: 30, 6: 30, 9: 30, 11: 30}.get(m, 31)  # the last day, at many hours
        rows.append((rng.choice(["a", "b", "c", "d", "e", None, "out"]), f"{y}-{m:02}-{d:02} {rng.randint(0, 23):02}:30:00",
                     f"{y}-{m:02}" if rng.random() < 0.95 else None, float(rng.randint(1, 900))))
    return rows + [("a", None, "2022-01", 5.0)]


def rebuilt(df, accounts, settings):
    reference = lc.reference_value(in_scope(lc.latest_invoices(df), accounts))
    months = in_scope(lc.account_months(lc.closed_month_sales(df, reference)), accounts)
    return months, lc.account_lifecycle(months, reference, settings)


@pytest.fixture(scope="module")
def accounts(spark):
    return spark.createDataFrame([(c,) for c in "abcdef"], "dealer_code string")


def test_state_after_deltas_equals_a_rebuild(spark, accounts, tmp_path):
    settings, path = Settings(), str(tmp_path / "state")
    rows = sales(1)
    rng = random.Random(2)
    rng.shuffle(rows)
    parts = [rows[:150], rows[150:151], rows[151:300], [], rows[300:]]
    so_far = []
    for k, part in enumerate(parts):
        so_far += part
        folder = inc.apply_delta(spark, path, lines(spark, part), accounts, settings, f"day {k}")
        assert inc.apply_delta(spark, path, lines(spark, part), accounts, settings, f"day {k}") == folder  # not merged twice
        months, windows = rebuilt(lines(spark, so_far), accounts, settings)
        assert rows_of(inc.read_windows(spark, path).select(windows.columns), "dealer_code") == rows_of(windows, "dealer_code")
        reference = spark.read.parquet(f"{folder}/reference").select("reference_date").scalar()
        got = in_scope(inc.closed_months(inc.read_state(spark, path), reference), accounts)
        key = lambda r: (r[0], str(r[1]))
        assert sorted(map(tuple, got.select(months.columns).collect()), key=key) == sorted(map(tuple, months.collect()), key=key)
    assert inc.read_state(spark, path).agg(F.sum("n_lines")).first()[0] == sum(r[0] is not None and r[1] is not None for r in rows)


def test_only_touched_accounts_are_worked_out_again(spark, accounts, tmp_path):
    settings, path = Settings(), str(tmp_path / "state")
    first = [(c, f"2023-{m:02}-10 00:00:00", f"2023-{m:02}", 1.0) for c in "abc" for m in range(1, 9)]
    inc.apply_delta(spark, path, lines(spark, first), accounts, settings, "one")
    late = [("b", "2023-03-11 00:00:00", "2023-03", 2.0), ("c", "2023-08-12 00:00:00", "2023-08", 2.0)]  # the second is not closed yet
    folder = inc.apply_delta(spark, path, lines(spark, late), accounts, settings, "two")
    by = {r["dealer_code"]: r["worked_out"] for r in spark.read.parquet(f"{folder}/windows").collect()}
    assert by == {"a": "one", "b": "two", "c": "one"}
    folder = inc.apply_delta(spark, path, lines(spark, [("a", "2023-09-02 00:00:00", "2023-09", 1.0)]), accounts, settings, "three")
    assert {r["worked_out"] for r in spark.read.parquet(f"{folder}/windows").collect()} == {"three"}  # a new reference
    more = accounts.union(spark.createDataFrame([("z",)], "dealer_code string"))
    folder = inc.apply_delta(spark, path, lines(spark, []), more, settings, "four")
    assert {r["worked_out"] for r in spark.read.parquet(f"{folder}/windows").collect()} == {"four"}  # other accounts


def test_failed_delta_changes_nothing(spark, accounts, tmp_path):
    settings, path = Settings(), str(tmp_path / "state")
    good = lines(spark, [("a", "2023-01-10 00:00:00", "2023-01", 1.0), ("a", "2023-03-10 00:00:00", "2023-03", 1.0)])
    folder = inc.apply_delta(spark, path, good, accounts, settings, "one")
    with pytest.raises(Exception):
        inc.apply_delta(spark, path, good.withColumn("ndp_value", F.raise_error(F.lit("no")).cast("double")), accounts, settings, "two")
    assert versions.latest(spark, path) == folder and inc.read_state(spark, path).count() == 2
    odd = Settings(reference="2023-02-10")
    with pytest.raises(ValueError):
        inc.apply_delta(spark, path, good, accounts, odd, "three")
