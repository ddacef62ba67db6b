"""Trie of conversation prefixes, rolled up in bands of depths.

1. Turns are dealt by range of (conv_id, turn, role, text) and numbered inside ranges plus the counts of earlier ones.
2. Conversations are rebuilt: the first turns of the conversation that starts their hundred, then their own further turns.
3. A node is a distinct prefix.  Its name is the XOR of hashes (two of 64 bits) of its turns with their places, a running
   value that chunks of long conversations compute apart.
4. Depths are cut into bands of fixed height.  Every node adds its own leaf and savings to its ancestors inside its band
   only; then the completed totals of the band's top nodes are added to the ancestors in the next band above, and so on.
   A node meets at most ``height`` ancestors, and the height grows with the deepest node so that there are at most
   ROUNDS + 1 rounds.

Counts, sums and minima combine before they are shuffled; a parent of very many nodes is looked up by broadcast (fewer than
1000 parents can have more than a thousandth of all nodes).  Ids of conversations that end in one node are joined to
texts of at most 4096 ids, and the texts hashed as a stream.

Edge cases: null role or text is empty; a null turn comes first; equal turn numbers are ordered by role, then text, and
repeated rows are turns of their own; rows without conv_id belong to no conversation and are left out; empty and very long
texts are turns like others; a conversation all of whose turns fall away ends in the root; an empty table has no nodes;
other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import look_up
from tidewatch.session import stage

HUNDRED = 100
HEADS = 6  # a conversation takes fewer turns than this from the one that starts its hundred
HEIGHT = 8
ROUNDS = 32
CHUNK = 4096
IDS_AT_ONCE = 4096


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, at (1, 2, ...), two hashes of role and text, n_chars of the text, and n_turns of the conversation."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = ("conv_id", "turn", "role", "text")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # Hash the one twice in unlike ways, so that equal values of both are as unlikely as of 128 bits.
    dealt = stage(dealt.select("conv_id", F.monotonically_increasing_id().alias("place"), F.xxhash64("role", "text").alias("h1"),
                               F.xxhash64(F.lit(17), "text", F.reverse("text"), "role").alias("h2"),
                               F.length("text").cast("bigint").alias("n_chars"))
                  .withColumn("range", F.shiftright("place", 33)), "turns")
    counts = dealt.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
                            F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"))
    inside = Window.partitionBy("conv_id", "range").orderBy("place")
    return (dealt.withColumn("at", F.row_number().over(inside).cast("bigint")).join(offsets, ["conv_id", "range"])
            .select("conv_id", (F.col("at") + F.col("offset")).alias("at"), "h1", "h2", "n_chars", "n_turns"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, h1, h2, n_chars) of the rebuilt turns, and (conv_id, n) of all conversations, turnless ones too."""
    heads = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    base = F.col("conv_id") - F.col("conv_id") % HUNDRED
    known = turns.where("at = 1").select("conv_id", "n_turns")
    convs = known.select("conv_id", "n_turns", heads.alias("heads"), base.alias("base"))
    bases = known.where(F.col("conv_id") % HUNDRED == 0).select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_turns", F.lit(0))))
    convs = stage(convs.select("conv_id", "base", "heads", "taken", "n_turns"), "conversations")

    total = convs.agg(F.sum("n_turns")).scalar()
    own = look_up(turns.drop("n_turns"), convs.drop("base"), ["conv_id"], F.col("n_turns"), total, F.col("at"))
    own = own.where("at > heads").select("conv_id", (F.col("at") - F.col("heads") + F.col("taken")).alias("depth"), "h1", "h2", "n_chars")
    first = (turns.where((F.col("conv_id") % HUNDRED == 0) & (F.col("at") < HEADS))
             .select(F.col("conv_id").alias("base"), "at", "h1", "h2", "n_chars"))
    shared = (convs.where("heads > 0").join(first, "base").where("at <= heads")  # below 200 conversations of five turns
              .select("conv_id", F.col("at").alias("depth"), "h1", "h2", "n_chars"))
    length = F.col("taken") + F.greatest(F.col("n_turns") - F.col("heads"), F.lit(0))
    return own.union(shared), convs.select("conv_id", length.alias("n"))


def _key(a: Column | str, b: Column | str) -> Column:
    return F.struct(F.col(a).alias("a") if isinstance(a, str) else a.alias("a"),
                    F.col(b).alias("b") if isinstance(b, str) else b.alias("b"))


def _root() -> Column:
    return _key(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))


def paths(turns: DataFrame, height: int, deepest: int, chunk: int = CHUNK) -> DataFrame:
    """conv_id, depth, key, parent, n_chars, ``inside`` (keys of the band from its top to the node) and, for the top node of
    a lower band, ``above`` (keys of the band above)."""
    chunk = height * max(1, chunk // height)
    rows = turns.select("conv_id", "depth", "n_chars", F.xxhash64("depth", "h1").alias("x1"), F.xxhash64("h2", "depth").alias("x2"),
                        F.floor(F.col("depth") / chunk).alias("chunk"))
    if deepest >= chunk:
        rows = stage(rows, "deep-turns")
        sums = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
        earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("conv_id", "chunk", *[F.coalesce(F.bit_xor(s).over(earlier), F.lit(0)).alias(s) for s in ("s1", "s2")])
        # The top node of a chunk's first band also closes the chunk before, where its ancestors are.
        home = F.when((F.col("depth") % chunk == 0), F.array(F.col("chunk") - 1, F.col("chunk"))).otherwise(F.array("chunk"))
        rows = rows.withColumn("chunk", F.explode(home)).join(sums, ["conv_id", "chunk"], "left").fillna(0, ["s1", "s2"])
    else:
        rows = rows.withColumns({"s1": F.lit(0).cast("bigint"), "s2": F.lit(0).cast("bigint")})
    order = Window.partitionBy("conv_id", "chunk").orderBy("depth")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({k: F.col(s).bitwiseXOR(F.bit_xor(x).over(so_far)) for k, s, x in (("k1", "s1", "x1"), ("k2", "s2", "x2"))})
    rows = rows.withColumn("near", F.collect_list(_key("k1", "k2")).over(order.rowsBetween(-height, Window.currentRow)))
    place = F.col("depth") % height
    top = F.when(F.col("depth") < height, F.array(_root())).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    inside = F.concat(top, F.slice("near", -F.least(place + 1, F.size("near")).cast("int"), (place + 1).cast("int")))
    over = F.concat(F.when(F.col("depth") == height, F.array(_root())).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>")),
                    F.slice("near", 1, F.size("near") - 1))
    closing = (place == 0) & (F.floor(F.col("depth") / chunk) != F.col("chunk"))
    opening = (F.col("depth") % chunk == 0) & ~closing
    return rows.select(
        "conv_id", "depth", _key("k1", "k2").alias("key"), "n_chars",
        _key(F.col("k1").bitwiseXOR(F.col("x1")), F.col("k2").bitwiseXOR(F.col("x2"))).alias("parent"),
        F.when(~closing, inside).alias("inside"), F.when((place == 0) & ~opening, over).alias("above"), closing.alias("closing"))


def _digests(ends: DataFrame) -> DataFrame:
    """key and ends_sha256 of the nodes in which conversations end; ``ends``: key, conv_id."""
    some = (ends.groupBy("key", F.floor(F.col("conv_id") / IDS_AT_ONCE).alias("piece"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")))

    def run(batches):
        key, digest = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if key != (a, b):
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (a, b), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _rows(out)
        if key is not None:
            yield _rows([(*key, digest.hexdigest())])

    def _rows(out):
        columns = list(zip(*out)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                                          names=["a", "b", "ends_sha256"])

    pieces = some.select("key.a", "key.b", "piece", "ids").repartition("a", "b").sortWithinPartitions("a", "b", "piece")
    done = pieces.select("a", "b", "ids").mapInArrow(run, "a bigint, b bigint, ends_sha256 string")
    return done.select(_key("a", "b").alias("key"), "ends_sha256")


def rolled_up(nodes: DataFrame, height: int, deepest: int) -> DataFrame:
    """key, n_leaves and saved_tokens of whole subtrees.

    ``nodes``: key, depth, leaf, saved, inside, above.  Each round completes a band and hands the totals of its top nodes up.
    """
    done, handed = None, None
    for band in range(deepest // height, -1, -1):
        here = nodes.where(F.floor(F.col("depth") / height) == band)
        parts = here.select(F.explode("inside").alias("key"), "leaf", "saved")
        if handed is not None:
            parts = parts.union(handed)
        totals = stage(parts.groupBy("key").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), "band")
        handed = (nodes.where(F.col("depth") == band * height).select("key", "above").join(totals, "key")
                  .select(F.explode("above").alias("key"), "n_leaves", "saved_tokens"))
        done = totals if done is None else done.union(totals)
    return done


def prefix_nodes(conversations: DataFrame, height: int = HEIGHT, rounds: int = ROUNDS, chunk: int = CHUNK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(stage(numbered(conversations), "numbered"))
    turns, convs = stage(turns, "rebuilt"), stage(convs, "lengths")
    deepest = convs.agg(F.max("n")).first()[0] or 0
    height = max(height, -(-deepest // rounds))
    walked = stage(paths(turns, height, deepest, chunk), "paths")

    # The root is the empty prefix of all conversations.
    members = (walked.where("NOT closing").select("key", "conv_id", "depth")
               .union(convs.select(_root(), "conv_id", F.lit(0).cast("bigint"))))
    found = members.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("depth").alias("depth"))
    found = stage(found, "found")
    own = walked.where("NOT closing").select("conv_id", "depth", "parent", "n_chars", "inside")
    above = walked.where("above IS NOT NULL").select("conv_id", "depth", "above")
    nodes = found.join(own, ["conv_id", "depth"], "left").join(above, ["conv_id", "depth"], "left")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stage(nodes.select(
        "key", "conv_id", "depth", "parent", "n_convs", "n_children",
        (F.col("n_children") == 0).cast("bigint").alias("leaf"),
        ((F.col("n_convs") - 1) * F.coalesce("n_chars", F.lit(0))).alias("saved"),
        F.when(F.col("depth") == 0, F.array("key")).otherwise(F.col("inside")).alias("inside"), "above"), "nodes")

    totals = rolled_up(nodes, height, deepest)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    named = look_up(nodes.select("key", "parent"), parents.where("n_children > 0"), ["parent"], F.col("n_children"),
                    nodes.agg(F.count(F.lit(1))).scalar(), F.col("key")).select("key", "parent_conv_id")
    last = walked.where("NOT closing").select("conv_id", "key", F.col("depth").alias("n")).join(convs, ["conv_id", "n"])
    ends = last.select("key", "conv_id").union(convs.where("n = 0").select(_root(), "conv_id"))
    out = nodes.join(totals, "key").join(named, "key").join(_digests(ends), "key", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
