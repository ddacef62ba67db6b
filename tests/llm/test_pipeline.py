"""The pipeline against brute force, its shape, and the queries against SQL."""

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.helpers import crawl, stored
from tests.llm.test_text_operators import check_packing
from tidewatch.llm.oracles import ORACLES
from tidewatch.llm.queries import QUERIES
from tools.compare import TABLES, normal


def expected(rows, items):
    """doc_id -> text after the four filtering stages; rows: (doc_id, text, host)."""
    verdicts = brute.quality(rows)
    kept = [(i, t, h) for (i, t, h), v in zip(rows, verdicts) if v[-1]]
    lines = [(r[0], r[3]) for r in brute.line_dedup([(i, t) for i, t, _ in kept])]
    first = {}
    for row, v in zip(lines, brute.near_dup(lines)):
        if v[3]:
            first.setdefault(row, row)
    clean = [v[0] for v in brute.contamination(list(first), items) if not v[-1]]
    return [(i, t) for i, t in first if i in set(clean)]


@pytest.fixture(scope="module")
def crawl_dir(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("crawl"), crawl())


@pytest.mark.parametrize("source", ["given", "crawl"])
def test_pipeline_equals_brute_force(spark, source, crawl_dir):
    sf_dir = SF_SMALL if source == "given" else crawl_dir
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = expected([tuple(r) for r in docs], items)
    assert 0 < len(want) < len(docs)
    used, least = check_packing(want, corpus_pipeline.run(spark, sf_dir).collect())
    assert used <= least + 2


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF_SMALL)
        assert out.dtypes == docs.dtypes, name
        assert step(spark, docs.where("false"), SF_SMALL).collect() == [], name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dup", "decontamination", "packing"]


def test_every_operator_has_its_query():
    names = list(entry_points.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, key):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got, want = QUERIES[key](spark, SF_SMALL).toPandas(), duck.sql(ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert normal(got).equals(normal(want))
    duck.close()


@pytest.mark.parametrize("key", ["op5_quality_crf", "op6_packing", "op8_secrets", "op10_language_id", "op1_near_dup"])
def test_queries_run_on_odd_tables(spark, key, crawl_dir):
    n = spark.read.parquet(f"{crawl_dir}/documents.parquet").count()
    assert QUERIES[key](spark, crawl_dir).count() >= n


def test_the_tokenizer_is_the_public_one():
    assert Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)).get_vocab_size() == 49408
