"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches of descending doc_id.  Each batch is reduced to one row per line key (128-bit hash,
number of documents, largest doc_id).  It is anti-joined with the keys that the runs have settled (already in
``min_docs`` documents; their holder has a larger doc_id than anything still to come), and what is left is
written as a new sorted run of level 0.  Two runs of a level are merged into one of the next.  At the end the
runs give, for every key found often enough, the one document that keeps its lines; the others lose them.

All work is DataFrame operations.  A line's key is the line stripped of white space with A-Z lower-cased.

Edge cases: null or empty text is one empty line and stays (as an empty text); a key counts once per doc_id, so repeated rows of a
document count once and each loses the same lines; rows without doc_id neither count nor lose lines; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE_CHARS, ascii_lower
from tidewatch.session import stage

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FAN_IN = 2
KEY = ["h1", "h2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _key(line: Column) -> Column:
    return ascii_lower(F.call_function("btrim", line, F.expr(SPACE_CHARS)))


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(0x5EED), key).alias("h2"))


def line_keys(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h1, h2, batch): the distinct long line keys of every row; batch 0 has the largest doc_ids."""
    ends = docs.agg(F.struct(*[f("doc_id").cast("double").alias(n) for n, f in (("top", F.max), ("low", F.min))])).scalar()
    share = (ends.top - F.col("doc_id").cast("double")) / (ends.top - ends.low + 1)
    batch = F.least(F.floor(share * batches).cast("int"), F.lit(batches - 1))
    keys = F.filter(F.transform(_lines(F.col("text")), _key), lambda k: F.length(k) >= min_chars)
    return (docs.where("doc_id IS NOT NULL")
            .select("doc_id", F.explode(F.array_distinct(F.transform(keys, _hash))).alias("k"))
            .select("doc_id", "k.h1", "k.h2", batch.alias("batch")))


def _sorted_run(run: DataFrame, label: str) -> DataFrame:
    return stage(run.sortWithinPartitions(*KEY), label)


def _merged(runs: list[DataFrame]) -> DataFrame:
    """One row per key of several runs: documents add up, the largest holder stays."""
    out = runs[0]
    for run in runs[1:]:
        out = out.union(run)
    return out.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"))


def build_runs(keys: DataFrame, batches: int = BATCHES, fan_in: int = FAN_IN,
               min_docs: int = MIN_DOCS) -> list[DataFrame]:
    """Adds every batch to the levels; returns the runs that remain (at most fan_in - 1 per level)."""
    levels: list[list[DataFrame]] = []
    for b in range(batches):
        fresh = (keys.where(F.col("batch") == b).groupBy(*KEY)
                 .agg(F.countDistinct("doc_id").alias("n_docs"), F.max("doc_id").alias("holder")))
        for run in [r for level in levels for r in level]:
            fresh = fresh.join(run.where(F.col("n_docs") >= min_docs).select(*KEY), KEY, "left_anti")
        run, depth = _sorted_run(fresh, f"run-{b}"), 0
        while True:
            if depth == len(levels):
                levels.append([])
            levels[depth].append(run)
            if len(levels[depth]) < fan_in:
                break
            run, levels[depth] = _sorted_run(_merged(levels[depth]), f"level-{depth + 1}"), []
            depth += 1
    return [r for level in levels for r in level]


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fan_in: int = FAN_IN, min_docs: int = MIN_DOCS,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the text of the lines that stay, plus n_lines and n_dropped (replaced if present)."""
    keys = stage(line_keys(docs, batches, min_chars), "line-keys")
    runs = build_runs(keys, batches, fan_in, min_docs)
    repeated = _merged(runs).where(F.col("n_docs") >= min_docs)
    lost = (keys.join(repeated, KEY).where("doc_id <> holder")
            .groupBy(F.col("doc_id").alias("lost_id")).agg(F.collect_set(F.struct(*KEY)).alias("lost")))
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    out = docs.alias("d").join(lost.alias("l"), F.col("d.doc_id") == F.col("l.lost_id"), "left")
    lines, keys_lost = _lines(F.col("d.text")), F.col("l.lost")
    kept = F.filter(lines, lambda x: (F.length(_key(x)) < min_chars) | ~F.array_contains(keys_lost, _hash(_key(x))))
    kept = F.when(keys_lost.isNull(), lines).otherwise(kept)
    # The other columns travel in a struct, so none of them can clash with a name used here.
    out = out.select(F.struct(*[F.col(f"d.`{c}`") for c in rest]).alias("d"),
                     F.size(lines).cast("bigint").alias("n_lines"), kept.alias("lines"))
    return out.select(*[F.col("d")[c].alias(c) for c in rest], F.array_join("lines", "\n").alias("text"), "n_lines",
                      (F.col("n_lines") - F.size("lines")).alias("n_dropped"))
