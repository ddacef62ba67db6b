"""Near-duplicates, lines and substrings against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.helpers import crawl, frame, same, words
from tidewatch.llm import line_dedup, near_dup, substring_dedup
from tidewatch.llm.components import components


@pytest.fixture(scope="module")
def rows():
    return crawl()


def test_near_duplicates_equal_brute_force(spark, rows):
    got = near_dup.near_duplicates(frame(spark, rows)).collect()
    same(got, brute.near_dup(rows))


def test_near_duplicates_without_ids_and_of_nothing(spark):
    got = near_dup.near_duplicates(frame(spark, [(None, "a b c d e f"), (None, None), (7, "A b c d e f"), (None, "z")])).collect()
    same(got, [(None, 2, 7, True), (None, 0, None, True), (7, 2, 7, True), (None, 1, None, True)])
    assert near_dup.near_duplicates(frame(spark, [])).collect() == []


def test_near_duplicates_that_share_ids(spark):
    rng = random.Random(31)
    base = [words(rng, 120) for _ in range(14)]
    near = [w[:50] + ["other"] + w[51:] for w in base]
    data = [(1, base[k]) for k in range(12)] + [(1, near[12]), (2, base[12]), (1, base[0])]
    data += [(10 + k, near[k]) for k in range(12)] + [(3, base[13]), (3, near[13]), (0, near[5][1:])]
    data = [(i, " ".join(w)) for i, w in data]
    same(near_dup.near_duplicates(frame(spark, data)).collect(), brute.near_dup(data))
    got = corpus_pipeline.drop_near_duplicates(spark, frame(spark, data), None).select("doc_id", "text").collect()
    same(got, {row for row, verdict in zip(data, brute.near_dup(data)) if verdict[3]})


def test_links_that_the_stars_miss_are_found(spark, monkeypatch):
    """A chain: neighbours are alike, the smallest document is like its neighbour only."""
    rng = random.Random(1)
    w = words(rng, 300)
    rows = [(k, " ".join(w[12 * k:12 * k + 160])) for k in range(12)]
    rows += [(100 + k, " ".join(w[:80] + words(rng, 30) + w[110:160])) for k in range(30)]
    want = brute.near_dup(rows)
    assert len({r[2] for r in want}) > 3
    same(near_dup.near_duplicates(frame(spark, rows)).collect(), want)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 400)  # buckets in many blocks
    same(near_dup.near_duplicates(frame(spark, rows)).collect(), want)


def test_block_links_cover_every_pair_of_labels(spark):
    import pandas as pd

    sets = [np.arange(k, k + 20, dtype=np.uint64) for k in (0, 1, 2, 100, 101, 500)]
    pdf = pd.DataFrame({"node": range(6), "label": [0, 0, 2, 3, 4, 5], "shingles": [s.tobytes() for s in sets]})
    found = {frozenset((int(pdf.label[a]), int(pdf.label[b]))) for a, b in near_dup._block_links(pdf).to_numpy()}
    assert found == {frozenset((0, 2)), frozenset((3, 4))}


def test_densified_sketches_agree_as_often_as_sets_do():
    rng = np.random.default_rng(2)
    sketcher = near_dup.Sketcher(bands=160, rows=1)
    shares = []
    for _ in range(200):
        s = np.sort(rng.integers(0, 1 << 63, 8, dtype=np.uint64))
        shares.append((sketcher.band_keys(s) == sketcher.band_keys(s[:6])).mean())
    assert abs(np.mean(shares) - 0.75) < 0.04


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (101, 100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("batches, fan_in", [(4, 2), (7, 3), (1, 2)])
def test_lines_equal_brute_force(spark, rows, batches, fan_in):
    more = rows + [(None, rows[40][1]), (None, None), (-(1 << 63), rows[41][1]), ((1 << 63) - 1, rows[41][1])]
    out = line_dedup.dedup_lines(frame(spark, more), batches, fan_in)
    same(out.select("doc_id", "n_lines", "n_dropped", "text").collect(), brute.line_dedup(more))
    assert set(out.columns) == set(frame(spark, []).columns) | {"n_dropped"}


def test_lines_of_nothing_and_runs_hold_each_key_once(spark, rows):
    assert line_dedup.dedup_lines(frame(spark, [])).collect() == []
    keys = line_dedup.line_keys(frame(spark, rows), 4)
    runs = line_dedup.build_runs(keys, 4, 2, 3)
    assert len(runs) == 1  # four batches are compacted twice
    total = runs[0].groupBy("h1", "h2").count().where("count > 1").count()
    assert total == 0 and runs[0].count() == keys.select("h1", "h2").distinct().count()


def test_substrings_equal_brute_force(spark, rows):
    more = rows + [(None, rows[41][1]), (None, None)]
    out = substring_dedup.dedup_substrings(frame(spark, more))
    same(out.select("doc_id", "n_words", "n_removed", "text").collect(), brute.substring_dedup(more))
    assert substring_dedup.dedup_substrings(frame(spark, [])).collect() == []


def test_substrings_of_rows_that_share_an_id(spark):
    rng = random.Random(21)
    passage = " ".join(words(rng, 60))
    texts = [" ".join(words(rng, 70)) for _ in range(6)]  # unique at the places where others hold the passage
    data = [(1, texts[0] + " " + texts[1]), (1, passage + " " + texts[2]), (2, passage), (2, texts[3] + " " + texts[4]),
            (None, texts[5] + " " + passage), (None, texts[5][::-1]), (None, None), (1, None)]
    got = substring_dedup.dedup_substrings(frame(spark, data))
    same(got.select("doc_id", "n_words", "n_removed", "text").collect(), brute.substring_dedup(data))


def test_matches_at_every_pair_of_offsets(spark):
    rng = random.Random(4)
    common = words(rng, 35, "klmnop")
    rows = [(k, " ".join(words(rng, k) + common + words(rng, 40 - k))) for k in range(22)]
    rows += [(100, " ".join(common[:34] + words(rng, 10))), (101, " ".join(common * 2))]
    out = substring_dedup.dedup_substrings(frame(spark, rows))
    same(out.select("doc_id", "n_words", "n_removed", "text").collect(), brute.substring_dedup(rows))


def test_the_cover_has_every_difference():
    p, c = substring_dedup.PERIOD, substring_dedup.COVER
    assert {(a - b) % p for a in c for b in c} == set(range(p))


def test_window_hashes_do_not_depend_on_the_place():
    h = np.random.default_rng(0).integers(0, 1 << 63, 500, dtype=np.uint64)
    roller = substring_dedup.Roller(substring_dedup._BASES[0])
    assert (roller.windows(h, 35)[100:200] == roller.windows(h[100:234], 35)).all()
