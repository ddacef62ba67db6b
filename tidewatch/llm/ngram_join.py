"""Jaccard join on word n-grams by partitioning the token universe.

A pair of sets with sizes r and s and similarity 0.8 or more differs in at most (r + s) / 9 shingles.  The universe of
shingle hashes is cut into segments; if a pair differs in at most H places, then among segments whose *values* sum to
H + 1 there is one with value v in which the pair differs in less than v places (pigeonhole).

1. Sizes fall into bands; a set meets its own band and, as the smaller partner, the next one.  Each band has its own number
   of segments.
2. An equal subset has value 1: its hash is one key.  In the first ``wide`` segments of a band, a subset of two or more
   shingles is indexed with its one-deletion neighbourhood as well and has value 2.  ``plan`` allocates: it picks the
   number of segments and of wide ones with the least expected cost of keys and of candidates under keys of few shingles.
3. A set emits the keys of its non-empty segments in order until their values reach what its largest partner asks for;
   empty subsets, which most sets share, are skipped.  Of a pair, the set that stops first guarantees the common key.  A
   set that runs out of segments also emits its empty ones (and a last common key, if even these do not suffice), so two of
   these meet as well.
4. Under each key the members are linked to the smallest one.  Where sizes, and parities of the shingles in small
   parts of the universe, do not rule a link out, it is verified on full sets.  Keys whose members still carry different labels are
   settled exactly: their differently labelled members meet as pairs, or under keys of many in blocks of bounded size, and
   take the same way.  Links between equally labelled sets add nothing to a component.

No key holds a third of all rows even if one group of copies does: copies in a task emit once, and near copies are
spread over as many keys as they have segments.

Edge cases: null, empty and blank texts have no shingles and are linked with nothing; with fewer than five words the whole
sequence is the one shingle; very long texts only have more segments (keys grow with a quarter of the shingles); repeated
rows and ties form one class; rows without doc_id link like others, but a component is named by the least doc_id that is
not null; rows of different text may share a doc_id; an empty table gives an empty result; other columns of the input,
whatever their names, are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import exp, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches
from tidewatch.llm.components import components
from tidewatch.llm.near_dup import shingle_set
from tidewatch.session import job_folder, stage, work_dir, write_once

SIMILAR = 80  # per cent
# Expected further candidates under a key of one shingle, and of two, in keys.
LIST_COST = (8.0, 1.0)
FEW = 64
BLOCK_MEMBERS, BLOCK_SHINGLES = 4096, 1_000_000
HUB_PART = 2_000
# Bits of the bitmap of wanted rows, 4 MB at most.
BITMAP = 1 << 25

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def largest_partner(n: int) -> int:
    return 100 * n // SIMILAR


def most_apart(r: int, s: int) -> int:
    """The most places in which similar sets of these sizes differ."""
    return (r + s) * (100 - SIMILAR) // (100 + SIMILAR)


@lru_cache(maxsize=None)
def _upper(band: int) -> int:
    """The largest size of a band; a set's partners lie in its own band and the two beside it."""
    return 1 if band == 0 else max(_upper(band - 1) + 1, largest_partner(_upper(band - 1)))


def band_of(n: int) -> int:
    band = 0
    while _upper(band) < n:
        band += 1
    return band


def needed(n: int, band: int) -> int:
    """The value a set of n shingles must reach in the segments of a band."""
    return most_apart(n, max(n, min(largest_partner(n), _upper(band)))) + 1


@lru_cache(maxsize=None)
def plan(band: int) -> tuple[int, int]:
    """(segments, wide ones) of a band: the cheapest by expected keys and candidates for its middle size."""
    high = _upper(band)
    low = _upper(band - 1) + 1 if band else 1
    n = (low + high) / 2
    need = needed(high, band)
    if need == 1:
        return 1, 0
    best = (float("inf"), need + 1, 0)
    for m in sorted({int(x) for x in np.linspace(max(1, need // 2), 1.4 * need + 8, 60)}):
        each = n / m
        p0, p1, p2 = exp(-each), each * exp(-each), each ** 2 / 2 * exp(-each)
        if m == 1:
            p0 = p1 = p2 = 0.0
        for wide in range(min(m, 8) + 1):
            narrow = (need - wide * (2 - 2 * p0 - p1)) / (1 - p0)  # segments, empty ones included
            if narrow < 0 or wide + narrow + 3 * sqrt(m * p0 * (1 - p0)) > m:
                continue
            keys = wide * (1 + each) + narrow * (1 - p0)
            lists = (wide + narrow) * (LIST_COST[0] * p1 + LIST_COST[1] * p2) + wide * LIST_COST[0] * 2 * p2
            best = min(best, (keys + lists, m, wide))
    return best[1:]


@lru_cache(maxsize=256)
def _salts(band: int) -> np.ndarray:
    return _spread(np.arange(plan(band)[0] + 1, dtype=np.uint64) * _ODD + np.uint64(band + 1))


def _segment_keys(shingles: np.ndarray, sums: np.ndarray, mixed: np.ndarray, band: int) -> list[np.ndarray]:
    """Keys of a sorted set in a band; ``sums`` are the running sums of ``mixed``, from 0."""
    m, wide = plan(band)
    need = needed(len(shingles), band)
    place = ((shingles >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    edges = np.concatenate(([0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]))
    starts, stops = edges[:-1], edges[1:]
    filled = place[starts]
    value = 1 + ((filled < wide) & (stops - starts >= 2))
    reached = np.cumsum(value)
    salt = _salts(band)
    used = int(np.searchsorted(reached, need)) + 1
    out = []
    if used > len(filled):
        holes = np.setdiff1d(np.arange(m), filled)
        out.append(_spread(salt[holes]))
        if reached[-1] + len(holes) < need:
            out.append(_spread(salt[m:]))
        used = len(filled)
    subset = sums[stops[:used]] - sums[starts[:used]] + salt[filled[:used]]
    out.append(_spread(subset))
    for k in np.flatnonzero(value[:min(used, wide)] == 2):
        out.append(_spread(subset[k] - mixed[starts[k]:stops[k]]))
    return out


def join_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of a set: any set of similarity 0.8 or more has one of them."""
    n = len(shingles)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    mixed = _spread(shingles * _ODD)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mixed, out=sums[1:])
    band = band_of(n)
    keys = _segment_keys(shingles, sums, mixed, band)
    if largest_partner(n) > _upper(band):
        keys += _segment_keys(shingles, sums, mixed, band + 1)
    return np.concatenate(keys).view(np.int64)


def _class_name(shingles: np.ndarray) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64).item()


def _row() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text")


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row hash, n_shingles, node (the set's 64-bit hash), sketch and keys; a set that its task has met has no keys again."""

    def make():
        met: set[int] = set()

        def work(batch):
            sizes, nodes, sketches, keys, ends = [], [], [], [], [0]
            for text in batch.column("text").to_pylist():
                s = shingle_set(text)
                node = _class_name(s)
                sizes.append(len(s)), nodes.append(node), sketches.append(sketch(s).tobytes())
                if node not in met:
                    met.add(node)
                    keys.append(join_keys(s))
                    ends.append(ends[-1] + len(keys[-1]))
                else:
                    ends.append(ends[-1])
            values = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))
            return {"doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_shingles": sizes, "node": nodes, "sketch": sketches,
                    "keys": lists}

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text", _row().alias("row")), make,
                       "doc_id bigint, row bigint, n_shingles bigint, node bigint, sketch binary, keys array<bigint>")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """row and text of the rows whose hash ``wanted`` (stored) has, and of few others; equal rows once.

    A bitmap of fixed size keeps nearly all other texts from moving; where most rows are wanted, all texts move once.
    """
    place = F.pmod("row", F.lit(BITMAP)) + 1
    bitmap = (wanted.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
              .repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))
    rows = docs.select(_row().alias("row"), "text").withColumns({"bucket": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place)})
    of_eight = F.conv(F.hex(F.expr("substring(bits, int(bit div 8) + 1, 1)")), 16, 10).cast("int")
    return (rows.join(F.broadcast(bitmap), "bucket").where(of_eight.bitwiseAND(F.expr("shiftleft(1, int(bit % 8))")) != 0)
            .select("row", "text").dropDuplicates(["row"]))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """The join's condition on sorted sets."""
    if SIMILAR * max(len(x), len(y)) > 100 * min(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= SIMILAR * (len(x) + len(y) - both)


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b; stored) whose full sets are similar.  A hub with many members is dealt to several tasks, with copies of its text.

    Texts go straight to where they are compared, being smaller than sets; a hub comes before its members.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_PART).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.coalesce("parts", F.lit(1))).cast("int")
    members = pairs.join(parts.where("parts > 1"), "a", "left").select("a", part.alias("part"), F.col("b").alias("node"))
    hubs = parts.select("a", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("a").alias("node"))
    wanted = stage(members.union(hubs).join(classes.select("node", "row"), "node"), "join-wanted")
    rows = (_texts(docs, wanted).join(wanted, "row").select("a", "part", "node", "text")
            .repartition("a", "part").sortWithinPartitions("a", "part", F.col("node") != F.col("a")))

    def make():
        hub, of_hub = None, None

        def work(batch):
            nonlocal hub, of_hub
            out = {"a": [], "b": []}
            for a, part, node, text in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "node", "text"))):
                s = shingle_set(text)
                if _class_name(s) != node:
                    continue
                if node == a:
                    hub, of_hub = (a, part), s
                elif hub == (a, part) and similar(of_hub, s):
                    out["a"].append(a), out["b"].append(node)
            return out

        return work

    return map_batches(rows, make, "a bigint, b bigint")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Bits: is the number of shingles in a part of the universe odd?  Sets differ in no fewer places than sketches.

    There are as many parts as shingles, rounded up to a power of two, so that few differences cancel out.
    """
    parts = 1 << min(16, max(6, (len(shingles) - 1).bit_length()))
    counts = np.bincount((shingles & np.uint64(parts - 1)).astype(np.int64), minlength=parts)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def _folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """The sketches of as many bytes, over fewer and larger parts."""
    while sketches.shape[-1] > width:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def _may_be_similar(n_a: np.ndarray, n_b: np.ndarray, sketch_a: np.ndarray, sketch_b: np.ndarray) -> np.ndarray:
    """False where sizes or sketches rule a link out."""
    width = min(sketch_a.shape[-1], sketch_b.shape[-1])
    apart = np.bitwise_count(_folded(sketch_a, width) ^ _folded(sketch_b, width)).sum(axis=-1, dtype=np.int64)
    fits = SIMILAR * np.maximum(n_a, n_b) <= 100 * np.minimum(n_a, n_b)
    return fits & (apart * (100 + SIMILAR) <= (n_a + n_b) * (100 - SIMILAR))


def _possible(n_a: np.ndarray, n_b: np.ndarray, sketches_a: list[bytes], sketches_b: list[bytes]) -> np.ndarray:
    """``_may_be_similar`` for pairs whose sketches have different widths."""
    out = np.zeros(len(n_a), dtype=bool)
    fits = np.flatnonzero(SIMILAR * np.maximum(n_a, n_b) <= 100 * np.minimum(n_a, n_b))
    widths = np.array([(len(sketches_a[k]), len(sketches_b[k])) for k in fits], dtype=np.int64).reshape(-1, 2)
    for w in np.unique(widths, axis=0):
        of_w = fits[(widths == w).all(axis=1)]
        x, y = (np.frombuffer(b"".join(some[k] for k in of_w), np.uint8).reshape(len(of_w), -1) for some in (sketches_a, sketches_b))
        out[of_w] = _may_be_similar(n_a[of_w], n_b[of_w], x, y)
    return out


def settle(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links that join differently labelled members of a block: never more than it has labels.

    Sizes and sketches rule most pairs out at once; the rest is verified on full sets, until both labels are known to be one.
    """
    pdf = pdf.drop_duplicates("node")
    pdf = pdf.assign(set=pdf["text"].map(shingle_set)).drop(columns="text")
    pdf = pdf[pdf["set"].map(_class_name) == pdf["node"]].assign(n=pdf["set"].map(len)).sort_values(["n", "node"])
    nodes, n = pdf["node"].to_numpy(), pdf["n"].to_numpy()
    if not len(nodes):
        return pd.DataFrame([], columns=["a", "b"], dtype="int64")
    label = np.unique(pdf["label"].to_numpy(), return_inverse=True)[1]
    # Larger sets have wider sketches, and a partner's is up to twice as wide: per width, those up to twice as wide are folded.
    sketches = pdf["set"].map(sketch)
    widths, folded = sketches.map(len).to_numpy(), {}
    for w in np.unique(widths):
        first, last = np.searchsorted(widths, w), np.searchsorted(widths, 2 * w, side="right")
        folded[w] = first, np.stack([_folded(x, w) for x in sketches.iloc[first:last]])
    ids = np.unique(np.concatenate(pdf["set"].to_list()), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(n)])
    flags = np.zeros(int(ids.max()) + 1, dtype=bool)
    ends = np.searchsorted(n, 100 * n // SIMILAR, side="right")
    found = []
    for k in range(len(nodes)):
        others = np.arange(k + 1, ends[k])
        others = others[label[others] != label[k]]
        first, of_width = folded[widths[k]]
        others = others[_may_be_similar(n[others], n[k], of_width[others - first], of_width[k - first])]
        own = ids[starts[k]:starts[k + 1]]
        flags[own] = True
        while len(others):
            other, others = others[0], others[1:]
            both = int(np.count_nonzero(flags[ids[starts[other]:starts[other + 1]]]))
            if 100 * both >= SIMILAR * (n[other] + n[k] - both):
                found.append((nodes[k], nodes[other]))
                label[label == label[other]] = label[k]
                others = others[label[others] != label[k]]
        flags[own] = False
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _sketched(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that sizes and sketches allow to be similar."""
    narrow = classes.select("node", "n", "sketch")
    rows = pairs.join(narrow.toDF("b", "n_b", "sketch_b"), "b").join(narrow.toDF("a", "n_a", "sketch_a"), "a")

    def make():
        def work(batch):
            kept = pa.array(_possible(*(batch.column(c).to_numpy() for c in ("n_a", "n_b")),
                                      *(batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b"))))
            return {"a": batch.column("a").filter(kept), "b": batch.column("b").filter(kept)}

        return work

    return map_batches(rows.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b"), make, "a bigint, b bigint")


def _open_members(members: DataFrame, pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """key, hub, node, label and size (members) of keys whose members carry different labels.  ``members``: key, hub, node;
    ``pairs``: their different (hub, node) as (a, b)."""
    plain = labels.withColumnRenamed("component", "label")
    named = (pairs.toDF("hub", "node").join(plain, "node", "left").withColumn("mine", F.coalesce("label", "node")).drop("label")
             .join(plain.withColumnRenamed("node", "hub"), "hub", "left")
             .where(F.col("mine") != F.coalesce("label", "hub")).select("hub", "node"))
    open_keys = stage(members.join(named, ["hub", "node"]).select("key", "hub").distinct(), "open-keys")
    rows = (members.join(open_keys.select("key"), "key", "left_semi").select("key", "hub", "node")
            .union(open_keys.select("key", "hub", F.col("hub").alias("node"))))
    rows = stage(rows, "open-rows")
    # The same members often meet under many keys: one of these is enough.
    keys = (rows.groupBy("key")
            .agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("node")).alias("x"),
                 F.bit_xor(F.xxhash64(F.lit(3), "node")).alias("y"))
            .groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key", "size"))
    return (rows.join(keys, "key").join(plain, "node", "left")
            .select("key", "hub", "node", F.coalesce("label", "node").alias("label"), "size"))


def _rest(docs: DataFrame, members: DataFrame, pairs: DataFrame, labels: DataFrame, classes: DataFrame,
          places: dict[str, str]) -> DataFrame:
    """Links that the stars may have missed between differently labelled members of a key.

    Members of a short key meet as pairs.  Those of long ones meet by hub, because near copies share a hub under most of their
    keys, in blocks of bounded size that hold the texts.  Both are written one after the other, so that only one of them
    has texts in shuffle files at a time.
    """
    rows = stage(_open_members(members, pairs, labels).join(classes.select("node", "n", "row"), "node"), "open")
    few = rows.where(f"size <= {FEW}").select("key", "node", "label", "n")
    fits = f"{SIMILAR} * greatest(n, other_n) <= 100 * least(n, other_n)"
    met = (few.join(few.toDF("key", "other", "other_label", "other_n"), "key").where(f"node < other AND label <> other_label AND {fits}")
           .select(F.col("node").alias("a"), F.col("other").alias("b")).distinct())
    short = write_once(_verified(docs, classes, stage(_sketched(met, classes), "close")), places["short"])

    many = stage(rows.where(f"size > {FEW}").select("hub", "node", "label", "n", "row").distinct(), "many")
    parts = many.groupBy("hub").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
                                    .cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    dealt = many.join(parts, "hub").select("hub", "node", "label", "row", part.alias("p"),
                                           F.explode(F.expr("sequence(0, parts - 1)")).alias("q"))
    dealt = (_texts(docs, many).join(dealt, "row")
             .select("hub", "node", "label", "text", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j")))
    return short.union(write_once(dealt.groupBy("hub", "i", "j").applyInPandas(settle, "a bigint, b bigint"), places["long"]))


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    places = {label: work_dir(spark, f"join-{label}") for label in ("members", "rows", "links", "short", "long")}
    with job_folder(spark, "join-keys"):  # the keys are the largest table: they go once members have met
        keyed = stage(signatures(docs), "keys")
        within = Window.partitionBy("key").orderBy("node")
        met = (keyed.select(F.explode("keys").alias("key"), "node")
               .select("key", "node", F.lag("node").over(within).alias("before"),
                       F.first("node").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("hub"))
               .where("node <> hub AND node <> before").select("key", "hub", "node"))
        members = write_once(met, places["members"])
        signed = write_once(keyed.drop("keys"), places["rows"])
    pairs = stage(members.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "join-pairs")
    classes = stage(signed.groupBy("node").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"),
                                               F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "join-classes")
    # Texts are read again for those sets only that sizes and sketches leave.
    with job_folder(spark, "join-stars"):
        close = stage(_sketched(pairs, classes), "join-close")
        links = write_once(_verified(docs, classes, close), places["links"])
    labels = components(links)
    with job_folder(spark, "join-open"):
        more = _rest(docs, members, pairs, labels, classes, places)
    named = components(links.union(more))
    leaders = (named.join(classes.select("node", "least"), "node").groupBy("component")
               .agg(F.min("least").alias("leader")))
    leaders = named.join(leaders, "component").select("node", "leader")
    named = classes.select("node", "least").join(leaders, "node", "left").select("node", F.coalesce("leader", "least").alias("component_id"))
    linked = signed.where("n_shingles > 0").select("doc_id", "n_shingles", "node").join(named, "node")
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.select("doc_id", "n_shingles", "component_id").union(alone)
