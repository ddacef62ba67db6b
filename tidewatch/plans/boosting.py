"""Second-order boosted trees for a binary class, grown on histograms.

Rows are binned once and stored in blocks, whose columns are arrays and whose bins are one byte per feature, so that tasks
get them without work for each row.  A pass over them makes, for every model that is being grown, the
gradient and hessian sums of each (node, feature, bin) in Arrow batches, one set of arrays per task; these meet by
(model, block of features), where they are added up and each node's best split is chosen, so the driver sees one row per
node and block.  Nodes of at most ``NODE_ROWS`` rows are finished instead: their rows meet in one group of bounded size, whose
task grows all that is left below them (the division of work of Panda et al., PLANET, 2009), so a tree takes a pass per level of
large nodes and one more.  All models of a call (folds, search points) take their next step in the same pass.  Every ``STORE_AFTER`` trees the rows are stored again with their margins,
so a pass evaluates few trees and its plan has no history.

With more than ``NODE_ROWS`` rows, gradients and hessians are rounded to a power of two so small that every sum of them is
exact (2^-30 for two million rows of weight 2).  Then sums depend neither on tasks nor on an order, equal splits tie exactly, and what the cells
of a column's commonest bin add up to is what its other cells lack of the node's total, so these cells are not visited.

Parameters: ``gamma`` is the least loss reduction of a split (without the factor one half), ``min_child_weight`` the least
hessian sum of a child, ``colsample`` the share of columns drawn for each tree, ``subsample`` the share of rows drawn for each tree
by a hash of the row, ``reg_lambda`` the squared penalty of leaf values.  A leaf's value is -G / (H + lambda) times
the learning rate; margins start at 0 and the probability is 1 / (1 + exp(-margin)).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.columns import name_sql
from tidewatch.session import stage

BINS = 32
CUT_ACCURACY = 10_000
# Below the number of groups from which Spark sorts instead of hashing (128).
CUT_BLOCKS = 100
FEATURES_AT_ONCE = 64
NODE_ROWS = 10_000
STORE_AFTER = 10
# Rows that make a task of their own worth while, and bytes of bins in one at most.
TASK_ROWS, TASK_BYTES = 5_000, 1 << 26
BLOCK_ROWS = 1_000
LEAST_GAIN = 1e-6

DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 1.0, "colsample": 1.0, "gamma": 0.0,
            "min_child_weight": 1.0, "reg_lambda": 1.0}

# A block's columns are the bytes of arrays, those of bins packed; margins are empty before the first tree is stored.
KINDS = {"place": "<i8", "fold": "<i4", "y": "<f8", "w": "<f8", "bins": "u1", "margins": "<f8"}
PACKING = "zstd"
BLOCK = "n bigint, " + ", ".join(f"{c} binary" for c in KINDS)


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays; leaves have feature -1 and are their own children."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # scaled by the learning rate
    cover: np.ndarray  # hessian sum
    gain: np.ndarray

    @cached_property
    def depth(self) -> int:
        """Steps to the deepest leaf."""
        steps, here = 0, np.array([0])
        while (here := here[self.feature[here] >= 0]).size:
            steps, here = steps + 1, np.concatenate([self.left[here], self.right[here]])
        return steps

    def reach(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The node in which each row of x ends; ``bounds`` are the trees' bins or thresholds."""
        node, flat, rows = np.zeros(len(x), dtype=np.int32), x.reshape(-1), np.arange(len(x)) * x.shape[1]
        feature, children = np.maximum(self.feature, 0), np.stack([self.right, self.left], axis=1).reshape(-1)
        for _ in range(self.depth):
            left = flat.take(rows + feature.take(node)) <= bounds.take(node)
            node = children.take(2 * node + left)
        return node

    def values(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.reach(x, self.threshold)]


@dataclass(frozen=True)
class Booster:
    """A fitted model."""

    features: tuple[str, ...]
    trees: tuple[Tree, ...]

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for tree in self.trees:
            out += tree.values(x)
        return out

    def first(self, n: int) -> Booster:
        """The model after its first n trees: what a fit with n_estimators = n returns."""
        return Booster(self.features, self.trees[:n])

    def importances(self) -> np.ndarray:
        """Loss reductions by feature, as shares."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / total.sum() if total.sum() > 0 else total

    def node_rows(self) -> Iterator[tuple]:
        for t, tree in enumerate(self.trees):
            for k in range(len(tree.feature)):
                yield (t, k, *(getattr(tree, c)[k].item() for c in COLUMNS))

    def frame(self, spark: SparkSession) -> DataFrame:
        """The node table, from which ``from_nodes`` makes the model again."""
        return spark.createDataFrame(list(self.node_rows()), NODE)


COLUMNS = ("feature", "bin", "threshold", "left", "right", "value", "cover", "gain")
NODE = ("tree int, node int, feature int, bin int, threshold double, left int, right int, value double, cover double, "
        "gain double")


NODE_KINDS = (pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())


def _tree(rows: Sequence[tuple]) -> Tree:
    kinds = (np.int32, np.int32, np.float64, np.int32, np.int32, np.float64, np.float64, np.float64)
    return Tree(*(np.array(c, dtype=k) for c, k in zip(zip(*rows), kinds)))


def from_nodes(nodes: DataFrame, features: Sequence[str]) -> Booster:
    """A model from its node table (as many rows as the model has nodes)."""
    trees: dict[int, list[tuple]] = {}
    for row in nodes.orderBy("tree", "node").collect():
        trees.setdefault(row["tree"], []).append(tuple(row[c] for c in COLUMNS))
    return Booster(tuple(features), tuple(_tree(trees[t]) for t in sorted(trees)))


# -- binned rows -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Binned:
    """Stored blocks of rows of one byte per feature, and the bins' upper bounds by feature."""

    rows: DataFrame  # one record per block
    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]


def find_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> tuple[np.ndarray, ...]:
    """Upper bounds of all bins but the last of every feature: its distinct quantiles (31 numbers a feature at most).

    Features meet in blocks, so that no task merges the summaries of all.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    size = max(1, -(-len(features) // CUT_BLOCKS))
    texts = [f"CAST({name_sql(f)} AS DOUBLE)" for f in features]
    blocks = [texts[a:a + size] + ["CAST(NULL AS DOUBLE)"] * (size - len(texts[a:a + size])) for a in range(0, len(texts), size)]
    structs = ", ".join(f"struct({b} AS block, {', '.join(f'{t} AS c{k}' for k, t in enumerate(block))})" for b, block in enumerate(blocks))
    if not blocks:
        return ()
    found = df.select(F.expr(f"inline(array({structs}))")).groupBy("block").agg(
        *[F.percentile_approx(f"c{k}", shares, CUT_ACCURACY).alias(f"c{k}") for k in range(size)])
    rows = {r["block"]: r[1:] for r in found.collect()}
    cuts = [c for b in range(len(blocks)) for c in rows.get(b, [None] * size)][:len(features)]
    return tuple(np.unique(np.asarray(c if c is not None else [], dtype=np.float64)) for c in cuts)


def bin_rows(df: DataFrame, features: Sequence[str], key: str, target: str, weight: str, fold: str | None = None,
             bins: int = BINS) -> Binned:
    """Bins and stores rows: key, features, target (0/1), weight and, for a search, the fold that holds a row out."""
    cuts = find_cuts(df, features, bins)
    values = ", ".join(f"CAST({name_sql(f)} AS DOUBLE)" for f in features)
    source = df.select(F.xxhash64(key).alias("place"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"),
                       F.col(target).cast("double").alias("y"), F.col(weight).cast("double").alias("w"),
                       F.expr(f"array({values})").alias("x"))
    width, n = len(features), df.count()

    # Every pass reads these rows, so they are dealt evenly over the cores; small tables need fewer tasks.
    tasks = max(min(df.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS)), -(-n * width // TASK_BYTES), 1)
    step = max(1, min(BLOCK_ROWS, n // (16 * tasks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            binned = np.empty(x.shape, dtype=np.uint8)
            for k, cut in enumerate(cuts):
                binned[:, k] = np.searchsorted(cut, x[:, k])
            columns = {c: batch.column(c).to_numpy() for c in ("place", "fold", "y", "w")}
            yield _packed([
                {**{c: v[a:a + step] for c, v in columns.items()}, "bins": binned[a:a + step], "margins": np.empty(0)}
                for a in range(0, batch.num_rows, step)])

    return Binned(stage(source.mapInArrow(run, BLOCK).repartition(tasks), "binned"), tuple(features), cuts)


def _packed(blocks: Sequence[Mapping[str, np.ndarray]]) -> pa.RecordBatch:
    columns = [pa.array([len(b["place"]) for b in blocks], pa.int64())]
    for c, kind in KINDS.items():
        parts = [np.ascontiguousarray(b[c], dtype=kind).tobytes() for b in blocks]
        columns.append(pa.array([pa.compress(p, PACKING, asbytes=True) for p in parts] if c == "bins" else parts, pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["n", *KINDS])


def _blocks(batches: Iterator[pa.RecordBatch], width: int, models: int) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of every block; margins by row and model."""
    for batch in batches:
        for k, n in enumerate(batch.column("n").to_pylist()):
            parts = {c: batch.column(c)[k].as_buffer() for c in KINDS}
            parts["bins"] = pa.decompress(parts["bins"], n * width, PACKING)
            block = {c: np.frombuffer(parts[c], dtype=kind) for c, kind in KINDS.items()}
            margins = block["margins"].reshape(n, models) if len(block["margins"]) else np.zeros((n, models))
            yield {**block, "bins": block["bins"].reshape(n, width), "margins": margins}


def content(binned: Binned) -> tuple[int, int]:
    """Number of rows, and a mark of place, fold, target and bins of all rows in whatever blocks and order."""
    width = len(binned.features)
    odd = np.random.default_rng(width).integers(0, 2**63, width + 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mark = 0, np.uint64(0)
        for b in _blocks(batches, width, 1):
            one = _mixed(b["bins"].astype(np.uint64) @ odd[:width] + b["fold"].astype(np.int64).view(np.uint64) * odd[-2])
            one = _mixed(one ^ _mixed(b["place"].view(np.uint64)) + b["y"].view(np.uint64) * odd[-1])
            n, mark = n + len(one), mark ^ np.bitwise_xor.reduce(one)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([int(np.int64(mark.view(np.int64)))], pa.int64())], names=["n", "mark"])

    found = binned.rows.select("n", *KINDS).mapInArrow(run, "n bigint, mark bigint")
    return tuple(found.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.bit_xor("mark"), F.lit(0))).first())


def _binary(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    x = np.ascontiguousarray(x)
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])


def _raw(values: pa.Array) -> np.ndarray:
    """The bytes of binary values without nulls, one after the other."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    _, ends, data = values.buffers()
    if not len(values) or data is None:
        return np.empty(0, dtype=np.uint8)
    ends = np.frombuffer(ends, dtype=kind)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]]


# -- growing -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Spec:
    """What one model of a call is to be: parameters, the fold it must not see, the seed of its draws."""

    params: Mapping[str, float]
    held_out: int = -2
    seed: int = 42

    def value(self, name: str) -> float:
        return {**DEFAULTS, **self.params}[name]


Node = list  # feature, bin, threshold, left, right, value, cover, gain


def _leaf(k: int, g: float, h: float, params: Mapping[str, float]) -> Node:
    return [-1, 0, 0.0, k, k, -g / (h + params["reg_lambda"]) * params["learning_rate"], h, 0.0]


def split_nodes(nodes: list[Node], frontier: Sequence[int], splits: Mapping[int, tuple], params: Mapping[str, float]) -> list[tuple[int, int]]:
    """Applies the best splits (by slot of the frontier); returns (node, rows) of the new nodes."""
    least, following = max(params["gamma"], LEAST_GAIN), []
    for slot, node in enumerate(frontier):
        if slot not in splits:  # no row was drawn
            continue
        gain, feature, at, g_left, h_left, n_left, g, h, n = splits[slot]
        nodes[node] = _leaf(node, g, h, params)
        if gain > least:
            nodes[node][0], nodes[node][1], nodes[node][7] = feature, at, gain
            nodes[node][3], nodes[node][4] = len(nodes), len(nodes) + 1
            for a, b, c in ((g_left, h_left, n_left), (g - g_left, h - h_left, n - n_left)):
                following.append((len(nodes), int(c)))
                nodes.append(_leaf(len(nodes), a, b, params))
    return following


@dataclass
class _Growing:
    """A model on its way: finished trees, and the nodes of the tree in work."""

    spec: Spec
    width: int
    n_rows: int
    trees: list[Tree] = field(default_factory=list)
    stored: int = 0
    nodes: list[Node] = field(default_factory=list)
    large: list[int] = field(default_factory=list)  # to be split by a pass over all rows
    small: dict[int, int] = field(default_factory=dict)  # to be finished in a task: node -> level
    level: int = 0
    columns: np.ndarray | None = None

    def __post_init__(self):
        self.params = {**DEFAULTS, **self.spec.params}
        self._start()

    def _start(self) -> None:
        share = float(self.params["colsample"])
        n = max(1, int(share * self.width + 0.5)) if share < 1 else self.width
        draw = np.random.default_rng([self.spec.seed, len(self.trees)])
        self.columns = np.sort(draw.permutation(self.width)[:n])
        self.nodes, self.level, self.large, self.small = [_leaf(0, 0.0, 0.0, self.params)], 0, [], {}
        self._file([(0, self.n_rows)])

    def _file(self, fresh: Sequence[tuple[int, int]]) -> None:
        for node, rows in fresh:
            if self.level < self.params["max_depth"]:
                if rows <= NODE_ROWS:
                    self.small[node] = self.level
                else:
                    self.large.append(node)

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.params["n_estimators"]

    def take(self, splits: Mapping[int, tuple]) -> None:
        """Applies the best splits of the large nodes."""
        frontier, self.large = self.large, []
        self.level += 1
        self._file(split_nodes(self.nodes, frontier, splits, self.params))

    def graft(self, parts: Mapping[int, list[tuple]]) -> None:
        """Puts grown parts below the small nodes: node -> its nodes in order, the first being the node itself."""
        for node in self.small:
            names = {}
            for k, row in enumerate(parts.get(node, ())):
                names[k] = node if k == 0 else len(self.nodes)
                if k:
                    self.nodes.append(None)
                self.nodes[names[k]] = list(row)
            for k in names.values():
                self.nodes[k][3], self.nodes[k][4] = names[self.nodes[k][3]], names[self.nodes[k][4]]
        self.small = {}

    def close(self, cuts: Sequence[np.ndarray]) -> None:
        """Ends the tree if nothing of it is left to grow."""
        if not self.large and not self.small:
            for row in self.nodes:
                if row[0] >= 0:
                    row[2] = float(cuts[row[0]][row[1]])
            self.trees.append(_tree(self.nodes))
            self._start()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _scatter(x: np.ndarray) -> np.ndarray:
    """64-bit numbers to shares of the unit interval."""
    return _mixed(x) / 2.0**64


def _salt(seed: int, tree: int) -> np.uint64:
    return np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)


def best_splits(sums: np.ndarray, columns: np.ndarray, params: Mapping[str, float]) -> list[tuple]:
    """(gain, feature, bin, G left, H left, rows left, G, H, rows) of every node.

    ``sums``: (node, feature, bin, gradient or hessian or rows).  Ties go to the lower feature, then the lower bin.  A node
    without an allowed split has a gain of minus infinity.
    """
    penalty, least = params["reg_lambda"], params["min_child_weight"]
    run = np.cumsum(sums, axis=2)
    total = run[:, :, -1:, :]
    g, h, n = run[..., 0], run[..., 1], run[..., 2]
    g_right, h_right = total[..., 0] - g, total[..., 1] - h
    gain = g**2 / (h + penalty) + g_right**2 / (h_right + penalty) - total[..., 0]**2 / (total[..., 1] + penalty)
    gain = np.where((h >= least) & (h_right >= least) & (n > 0) & (n < total[..., 2]), gain, -np.inf)[:, :, :-1]
    best = gain.reshape(len(sums), -1).argmax(axis=1)
    out = []
    for node, place in enumerate(best.tolist()):
        f, at = divmod(place, gain.shape[2])
        out.append((float(gain[node, f, at]), int(columns[f]), at, *run[node, f, at].tolist(), *total[node, 0, 0].tolist()))
    return out


class _Sums:
    """Gradient, hessian and rows of every (node, feature, bin) of rows that are added batch by batch.

    Where sums are exact, the cells of a column's commonest bin (of the first rows) are filled in at the end.
    """

    def __init__(self, nodes: int, width: int, exact: bool):
        self.width, self.exact = width, exact
        self.cells, self.totals = np.zeros((3, nodes * width * BINS)), np.zeros((3, nodes))
        self.common: np.ndarray | None = None

    def add(self, slot: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        """``slot``: the rows' nodes; ``x`` has the drawn columns."""
        if self.exact:
            order = np.argsort(slot, kind="stable")  # a block's cells lie together
            slot, x, g, h = slot[order], x if slot[order[0]] == slot[order[-1]] else x[order], g[order], h[order]
            if self.common is None:
                self.common = np.array([np.bincount(c).argmax() for c in x[:256].T], dtype=x.dtype)
            self.totals += [np.bincount(slot, v, self.totals.shape[1]) for v in (g, h, np.ones(len(slot)))]
        for a in range(0, len(slot), 4096):
            part = slice(a, a + 4096)
            if self.exact:
                self._rare(slot[part], x[part], g[part], h[part])
            else:
                cell = ((slot[part, None] * self.width + np.arange(self.width)) * BINS + x[part]).ravel()
                self._count(cell, np.repeat(g[part], self.width), np.repeat(h[part], self.width), 0, self.cells.shape[1])

    def _rare(self, slot: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray) -> None:
        """Adds the cells outside the commonest bins of rows in the order of their nodes."""
        at = np.flatnonzero(x != self.common)
        row = at // self.width
        first, last = int(slot[0]), int(slot[-1]) + 1
        base = (slot - first - np.arange(len(slot))) * (self.width * BINS)
        cell = at * BINS + base.take(row) + x.reshape(-1).take(at)
        self._count(cell, g.take(row), h.take(row), first * self.width * BINS, last * self.width * BINS)

    def _count(self, cell: np.ndarray, g: np.ndarray, h: np.ndarray, a: int, b: int) -> None:
        self.cells[0, a:b] += np.bincount(cell, g, b - a)
        self.cells[1, a:b] += np.bincount(cell, h, b - a)
        self.cells[2, a:b] += np.bincount(cell, minlength=b - a)

    def result(self) -> np.ndarray:
        """(node, feature, bin, gradient or hessian or rows)"""
        shaped = self.cells.reshape(3, -1, self.width, BINS)
        if self.common is not None:
            shaped[:, :, np.arange(self.width), self.common] = self.totals[:, :, None] - shaped.sum(axis=3)
            self.common = None
        return shaped.transpose(1, 2, 3, 0)


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, params: Mapping[str, float], level: int,
         exact: bool = False) -> list[Node]:
    """All that is left of a tree below a node with these rows; ``x`` has the drawn columns."""
    nodes, frontier, slot = [_leaf(0, 0.0, 0.0, params)], [0], np.zeros(len(x), dtype=np.int64)
    while frontier and level < params["max_depth"]:
        sums = _Sums(len(frontier), len(columns), exact)
        if len(x):
            sums.add(slot, x, g, h)
        splits = dict(enumerate(best_splits(sums.result(), columns, params)))
        following = [node for node, _ in split_nodes(nodes, frontier, splits, params)]
        inner = np.array([nodes[k][0] >= 0 for k in frontier])
        kept = inner[slot]
        x, g, h, slot = x[kept], g[kept], h[kept], slot[kept]
        first = np.cumsum(inner) * 2 - 2  # the left child's slot
        column = np.searchsorted(columns, [max(nodes[k][0], 0) for k in frontier])
        right = x[np.arange(len(x)), column[slot]] > np.array([nodes[k][1] for k in frontier])[slot]
        slot, frontier, level = first[slot] + right, following, level + 1
    return nodes


def _rounding(total: float) -> float:
    """The power of two whose fractions add up exactly over rows of this total weight (their sums need less than 53 bits)."""
    return 2.0 ** (52 - np.ceil(np.log2(max(total, 1.0)))) if np.isfinite(total) else 0.0


def _gradients(block: Mapping[str, np.ndarray], work: Sequence[tuple], scale: float):
    """(work, bins, place, slot, g, h) of the rows that take part, for every model in work; a scale rounds to its fractions."""
    place, fold, y, w, bins, margins = (block[c] for c in KINDS)
    for one in work:
        m, trees, tree, slots, held_out, subsample, salt = one[:7]
        slot = slots[tree.reach(bins, tree.bin)]
        taken = (slot >= 0) & (fold != held_out)
        if subsample < 1:
            taken &= _scatter(place.view(np.uint64) ^ salt) < subsample
        at = np.flatnonzero(taken)
        if not len(at):
            continue
        x, slot = bins if len(at) == len(bins) else bins[at], slot[at]
        margin = margins[at, m].copy()
        for t in trees:
            margin += t.value[t.reach(x, t.bin)]
        p = 1 / (1 + np.exp(-margin))
        g, h = w[at] * (p - y[at]), np.maximum(w[at] * p * (1 - p), 1e-16)
        if scale:
            g, h = np.rint(g * scale) / scale, np.maximum(np.rint(h * scale), 1) / scale
        yield one, x, place[at], slot, g, h


def _drawn(x: np.ndarray, columns: np.ndarray) -> np.ndarray:
    return x if len(columns) == x.shape[1] else x[:, columns]


def _work(growing: Sequence[_Growing], nodes_of) -> list[tuple]:
    """What tasks need to know of the models that have such nodes."""
    out = []
    for m, one in enumerate(growing):
        nodes = [] if one.done else list(nodes_of(one))
        if nodes:
            slots = np.full(len(one.nodes), -1)
            slots[nodes] = np.arange(len(nodes))
            out.append((m, one.trees[one.stored:], _tree(one.nodes), slots, one.spec.held_out, float(one.params["subsample"]),
                        _salt(one.spec.seed, len(one.trees)), one.columns, nodes))
    return out


def _pass(rows: DataFrame, growing: Sequence[_Growing], width: int, scale: float) -> None:
    """Splits the large nodes of all models."""
    models, work = len(growing), _work(growing, lambda one: one.large)
    params, columns = [one.params for one in growing], [one.columns for one in growing]

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, _Sums] = {}
        for block in _blocks(batches, width, models):
            for one, x, _, slot, g, h in _gradients(block, work, scale):
                m, chosen, nodes = one[0], one[7], one[8]
                if m not in found:
                    found[m] = _Sums(len(nodes), len(chosen), scale > 0)
                found[m].add(slot, _drawn(x, chosen), g, h)
        part, out = TaskContext.get().partitionId(), []
        for m, one in found.items():
            sums = one.result()
            for block, a in enumerate(range(0, len(columns[m]), FEATURES_AT_ONCE)):
                out.append((m, block, part, np.ascontiguousarray(sums[:, a:a + FEATURES_AT_ONCE]).tobytes()))
        names = ("model", "block", "part", "sums")
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, kinds)], names=names)

    names = ["model", "slot", "gain", "feature", "bin", "g_left", "h_left", "n_left", "g", "h", "n"]

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        m, block = key
        some = columns[m][block * FEATURES_AT_ONCE:(block + 1) * FEATURES_AT_ONCE]
        # In the order of tasks, so that a rerun adds up the same way.
        sums = sum(np.frombuffer(b, dtype=np.float64) for b in pdf.sort_values("part")["sums"])
        splits = best_splits(sums.reshape(-1, len(some), BINS, 3), some, params[m])
        return pd.DataFrame([(m, slot, *s) for slot, s in enumerate(splits)], columns=names)

    chosen = rows.mapInArrow(histograms, "model int, block int, part int, sums binary").groupBy("model", "block").applyInPandas(
        choose, "model int, slot int, gain double, feature int, bin int, " + ", ".join(f"{c} double" for c in names[5:]))
    best: dict[int, dict[int, tuple]] = {}
    for r in chosen.collect():
        one, here = tuple(r)[2:], best.setdefault(r["model"], {})
        if r["slot"] not in here or (-one[0], one[1]) < (-here[r["slot"]][0], here[r["slot"]][1]):
            here[r["slot"]] = one
    for m, *_ in work:
        growing[m].take(best.get(m, {}))


def _finish(rows: DataFrame, growing: Sequence[_Growing], width: int, scale: float) -> None:
    """Grows what is left below the small nodes of models that have no large ones."""
    models, work = len(growing), _work(growing, lambda one: () if one.large else one.small)
    params, columns = [one.params for one in growing], [one.columns for one in growing]
    levels = [dict(one.small) for one in growing]
    grown = pa.schema([("model", pa.int32()), ("node", pa.int32()), ("k", pa.int32()), *zip(COLUMNS, NODE_KINDS)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, width, models):
            for one, x, place, slot, g, h in _gradients(block, work, scale):
                m, chosen, nodes = one[0], one[7], np.array(one[8], dtype=np.int32)
                kept = _binary(_drawn(x, chosen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), m, dtype=np.int32)), pa.array(nodes[slot]), pa.array(place), pa.array(g), pa.array(h), kept],
                    names=["model", "node", "place", "g", "h", "x"])

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        m, node = (k.as_py() for k in key)
        place, g, h = (table.column(c).to_numpy() for c in ("place", "g", "h"))
        x = np.concatenate([_raw(c) for c in table.column("x").chunks]).reshape(len(g), -1)
        if not scale:  # sums do not depend on the order of arrival
            order = np.lexsort((h, g, place))
            x, g, h = x[order], g[order], h[order]
        nodes = grow(x, g, h, columns[m], params[m], levels[m][node], scale > 0)
        return pa.Table.from_pylist([dict(zip(grown.names, (m, node, k, *row))) for k, row in enumerate(nodes)], grown)

    dealt = rows.mapInArrow(deal, "model int, node int, place bigint, g double, h double, x binary")
    below = dealt.groupBy("model", "node").applyInArrow(finish, "model int, node int, k int, " + NODE.split(", ", 2)[2])
    parts: dict[int, dict[int, list]] = {}
    for r in sorted(below.collect(), key=lambda r: r["k"]):
        parts.setdefault(r["model"], {}).setdefault(r["node"], []).append(tuple(r[c] for c in COLUMNS))
    for m, *_ in work:
        growing[m].graft(parts.get(m, {}))


def _stored(rows: DataFrame, growing: Sequence[_Growing], width: int) -> DataFrame:
    """The rows with their margins after all finished trees."""
    models, fresh = len(growing), [one.trees[one.stored:] for one in growing]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, width, models):
            margins = block["margins"].copy()
            for m, trees in enumerate(fresh):
                for t in trees:
                    margins[:, m] += t.value[t.reach(block["bins"], t.bin)]
            yield _packed([{**block, "margins": margins}])

    out = stage(rows.mapInArrow(run, BLOCK), "margins")
    for one in growing:
        one.stored = len(one.trees)
    return out


def _weight(rows: DataFrame, width: int) -> tuple[int, float]:
    """Number of rows and their total weight."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(len(b["w"]), float(np.abs(b["w"]).sum())) for b in _blocks(batches, width, 1)]
        n, total = map(sum, zip(*found)) if found else (0, 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.float64())], names=["n", "total"])

    found = rows.mapInArrow(run, "n bigint, total double").agg(F.sum("n"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0.0


def fit(binned: Binned, specs: Sequence[Spec]) -> list[Booster]:
    """One model per spec, all grown in the same passes over the stored rows."""
    rows, width = binned.rows, len(binned.features)
    if not width:
        raise ValueError("a model needs features")
    n, total = _weight(rows, width)
    scale = _rounding(total) if n > NODE_ROWS else 0.0
    growing = [_Growing(s, width, n) for s in specs]
    while not all(one.done for one in growing):
        active = [one for one in growing if not one.done]
        if any(one.large for one in active):
            _pass(rows, growing, width, scale)
        if any(one.small and not one.large for one in active):
            _finish(rows, growing, width, scale)
        for one in active:
            one.close(binned.cuts)
        if any(len(one.trees) - one.stored >= STORE_AFTER for one in growing if not one.done):
            rows = _stored(rows, growing, width)
    return [Booster(binned.features, tuple(one.trees)) for one in growing]


def held_out_outcomes(binned: Binned, models: Sequence[tuple[Booster, int, Sequence[int]]]) -> DataFrame:
    """model, n_trees, tp, fp, fn of held-out rows; ``models``: (model, its held-out fold, numbers of trees to judge it at).

    The smaller ensembles are the first trees of the larger one, so one fit serves all its numbers of trees.
    """
    width = len(binned.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for block in _blocks(batches, width, 1):
            bins, fold, y = block["bins"], block["fold"], block["y"]
            for m, (model, held_out, sizes) in enumerate(models):
                at = np.flatnonzero(fold == held_out)
                x, margin, truth = bins[at], np.zeros(len(at)), y[at] == 1
                for n, tree in enumerate(model.trees, 1):
                    margin += tree.value[tree.reach(x, tree.bin)]
                    if n in sizes:
                        said = margin >= 0
                        counts = np.array([(said & truth).sum(), (said & ~truth).sum(), (~said & truth).sum()])
                        total[m, n] = total.get((m, n), 0) + counts
        out = [(m, n, *map(int, c)) for (m, n), c in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out)) or [[]] * 5],
                                         names=["model", "n_trees", "tp", "fp", "fn"])

    counts = binned.rows.mapInArrow(run, "model bigint, n_trees bigint, tp bigint, fp bigint, fn bigint")
    return counts.groupBy("model", "n_trees").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
