"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidate edges.

1. Every text becomes the set of its hashed 5-word shingles.  One permutation of the hash values is cut into
   bins; the least value of each bin is the sketch; an empty bin copies the first filled bin along a fixed
   random walk of its own (optimal densification).  40 bands of 4 bins give bucket keys.
2. Texts with equal sets form a class with one representative, so copies meet no further step.
3. In each bucket all members are linked to the smallest one: n - 1 edges, never n * (n - 1) / 2.  Edges are
   confirmed on full sets, and confirmed ones give a first labelling by connected components.
4. A star can miss a link between two members that are both unlike its hub.  Buckets whose other members still carry different
   labels are therefore settled exactly: their sets are compared within blocks of bounded size, and only links
   between different labels leave a task (at most one per member and label).
5. Components of all confirmed links give the result.

At the threshold 0.75 a pair shares no bucket with probability (1 - 0.75^4)^40 = 2.5e-7.

Edge cases: null, empty and blank texts have no shingles and are linked with nothing; with fewer than five words the whole
sequence is the one shingle; repeated rows form one class and carry the same component; rows without doc_id
get the component of their class, if another row of it has a doc_id, else null, and are kept; rows of different
text that share a doc_id are judged each by its text: classes are named by a hash of doc_id and text of one of their rows,
and a component by the least doc_id of its rows once it is complete.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches
from tidewatch.llm.components import components
from tidewatch.session import stage

WORDS = 5
SIMILAR = 75  # per cent
BANDS, ROWS = 40, 4
BLOCK_SHINGLES = 2_000_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)


def _scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], dtype=np.uint64)
    n = len(h) - WORDS + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        mixed += _scramble(h[k:k + n]) * _MIX[k]
    return np.unique(_scramble(mixed))


class Sketcher:
    """Band keys of a shingle set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 5):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        walks = np.random.default_rng(seed).random((self.bins, self.bins))
        self.walk = np.argsort(walks, axis=1)
        self.salt = _scramble(np.arange(1, self.bins + 1, dtype=np.uint64) * _MIX[0]).reshape(bands, rows)

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        place = ((shingles >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])  # sets are sorted, and so are places
        sketch, filled = np.zeros(self.bins, dtype=np.uint64), np.zeros(self.bins, dtype=bool)
        sketch[place[first]], filled[place[first]] = shingles[first], True
        empty = np.flatnonzero(~filled)
        if len(empty):
            walk = self.walk[empty]
            sketch[empty] = sketch[walk[np.arange(len(empty)), filled[walk].argmax(axis=1)]]
        mixed = _scramble(sketch.reshape(self.bands, self.rows) + self.salt) * self.salt
        return _scramble(mixed.sum(axis=1, dtype=np.uint64)).view(np.int64)


def _set_hash(shingles: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype=np.int64)
    return int(digest[0]), int(digest[1])


def row_hash() -> Column:
    """What tells the rows of ``docs`` apart, but for copies."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row hash, n_shingles, set hash (h1, h2) and band keys of every row."""

    def make():
        sketcher = Sketcher()

        def work(batch):
            n, h1, h2, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text)
                a, b = _set_hash(s)
                n.append(len(s)), h1.append(a), h2.append(b)
                bands.append(sketcher.band_keys(s) if len(s) else [])
            return {"doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_shingles": n, "h1": h1, "h2": h2,
                    "bands": bands}

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text", row_hash().alias("row")), make,
                       "doc_id bigint, row bigint, n_shingles bigint, h1 bigint, h2 bigint, bands array<bigint>")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its shingle set as bytes, for ``nodes`` (node, h1, h2); one row per node and set."""
    rows = (docs.select(row_hash().alias("node"), "text").join(nodes, "node")
            .withColumn("t", F.xxhash64("text")).dropDuplicates(["node", "h1", "h2", "t"]))

    def make():
        def work(batch):
            out = {"node": [], "shingles": []}
            columns = (batch.column(c).to_pylist() for c in ("node", "text", "h1", "h2"))
            for node, text, h1, h2 in zip(*columns):
                s = shingle_set(text)
                if _set_hash(s) == (h1, h2):
                    out["node"].append(node), out["shingles"].append(s.tobytes())
            return out

        return work

    return map_batches(rows.select("node", "text", "h1", "h2"), make, "node bigint, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    rows = (pairs.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a"))

    def make():
        def work(batch):
            out = {"a": [], "b": []}
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b"))
            for a, b, x, y in zip(*columns):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= SIMILAR * (len(x) + len(y) - both):
                    out["a"].append(a), out["b"].append(b)
            return out

        return work

    return map_batches(rows.select("a", "b", "set_a", "set_b"), make, "a bigint, b bigint")


def _block_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between differently labelled members of a block, one per member and other label."""
    pdf = pdf.drop_duplicates("node").sort_values("node")
    nodes, labels = pdf["node"].to_numpy(), pdf["label"].to_numpy().copy()
    sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
    sizes = np.array([len(s) for s in sets])
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    flags = np.zeros(len(distinct), dtype=np.int32)
    values, counts = np.unique(labels, return_counts=True)
    most = values[counts.argmax()]
    found = []
    for k in np.flatnonzero(labels != most):  # every pair of two labels has a member outside the largest one
        own = ids[starts[k]:starts[k] + sizes[k]]
        flags[own] = 1
        both = np.add.reduceat(flags[ids], starts)
        flags[own] = 0
        like = 100 * both >= SIMILAR * (sizes + sizes[k] - both)
        for other in np.unique(labels[like]):
            if other != labels[k]:
                found.append((nodes[k], nodes[np.flatnonzero(like & (labels == other))[0]]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _rest(members: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that the stars of unsettled buckets may have missed.  ``members``: key, node, n_shingles, hub."""
    named = (members.where("node <> hub").join(labels, "node", "left")
             .select("key", "node", "n_shingles", F.coalesce("component", "node").alias("label")))
    open_keys = (named.groupBy("key")
                 .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum("n_shingles").alias("work"),
                      F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node")),
                               F.bit_xor(F.xxhash64(F.lit(3), "node"))).alias("who"))
                 .where("low < high"))
    # The same members often meet in many bands: one of these buckets is enough.
    open_keys = (open_keys.groupBy("who").agg(F.min("key").alias("key"), F.max("work").alias("work"))
                 .select("key", F.ceil(F.col("work") / BLOCK_SHINGLES).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts"))
    rows = (named.join(open_keys, "key").select("key", "node", "label", part.alias("p"),
                                                F.explode(F.expr("sequence(0, parts - 1)")).alias("q")))
    rows = rows.select("key", "node", "label", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"))
    rows = rows.join(sets, "node").select("key", "i", "j", "node", "label", "shingles")
    return rows.groupBy("key", "i", "j").applyInPandas(_block_links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text)."""
    return judged_rows(docs).drop("row")


def judged_rows(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` plus row, the ``row_hash`` by which rows that share a doc_id are told apart."""
    signed = stage(signatures(docs), "signatures")
    classes = (signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h1", "h2")
               .agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")))
    rows = classes.select("node", "h1", "h2", "n_shingles", F.explode("bands").alias("key"))
    stars = rows.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = stage(rows.join(stars, "key"), "members")
    sets = stage(_sets(docs, members.select("node", "h1", "h2").distinct()), "sets")

    hubs = members.where("node = hub").select("key", F.col("n_shingles").alias("hub_n"))
    pairs = (members.where("node <> hub").join(hubs, "key")
             .where(f"100 * least(n_shingles, hub_n) >= {SIMILAR} * greatest(n_shingles, hub_n)")
             .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    links = stage(_confirmed(pairs, sets), "links")
    labels = components(links)
    more = stage(_rest(members, labels, sets), "more-links")
    named = components(links.union(more))

    leaders = (named.join(classes.select("node", "least"), "node").groupBy("component")
               .agg(F.min("least").alias("leader")))
    named = named.join(leaders, "component").select("node", "leader")
    found = (classes.select("h1", "h2", "node", "least").join(named, "node", "left")
             .select("h1", "h2", F.coalesce("leader", "least").alias("component")))
    out = signed.drop("bands").join(found, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "row", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
