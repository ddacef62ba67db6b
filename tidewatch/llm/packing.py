"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.  Pieces are dealt by hash into
blocks of about ``block_pieces``, and each is first packed by best fit.  A block that needs more bins than the sum of its
pieces asks for is evolved on several islands, which start from that packing.  A chromosome is a set of bins.
Crossover injects whole well-filled bins of one parent into the other, removes the bins that hold the same
pieces, and best-fits the displaced pieces, largest first.  After each epoch an island's elite also goes to the
next island.  The best island of a block wins; its well-filled sequences are final and the pieces of the
others are dealt again into fewer blocks and packed once more, so what a block border wastes is small.

A task holds one block: its size is a parameter, not a function of the data.  Texts never leave the first step.

Edge cases: a null text is an empty one; an empty text is the end token alone; repeated rows are packed each;
an empty table gives an empty result.  Rows without doc_id are packed like others.  A very long text is cut into many pieces and
encoded a megabyte at a time; pieces of equal length (ties) go in the order of their ids.  Other columns of the input, whatever
their names, are not read.
"""

from __future__ import annotations

import itertools
import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches
from tidewatch.llm.tokens import load
from tidewatch.session import stage

CAPACITY = 4096
END_ID = 1
BLOCK_PIECES = 6000
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
GENERATIONS = 20
WELL_FILLED = 0.995

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
Bins = list[list[int]]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece, with ``salt`` (the row's number in its task), which spreads equal rows."""

    def make():
        tok, salt, end = load(tokenizer), itertools.count(), int(end_id).to_bytes(4, "little")

        def work(batch):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "salt")}
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tok.ids(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for name, value in zip(out, (doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), next(salt))):
                        out[name].append(value)
            return out

        work.close = tok.forget
        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), make, f"{PIECE}, salt bigint")


# ---- one island -------------------------------------------------------------------------------------------

def best_fit(order: list[int], sizes: list[int], capacity: int, bins: Bins) -> Bins:
    """Puts each item of ``order`` into the fullest bin that takes it, else into a new one."""
    rooms = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in order:
        at = bisect_left(rooms, (sizes[i], -1))
        if at < len(rooms):
            room, k = rooms.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > sizes[i]:
            insort(rooms, (room - sizes[i], k))
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then unevenly filled ones: they leave whole gaps to use."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(mine: Bins, other: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Injects well-filled bins of ``other`` into ``mine``."""
    ranked = sorted(other, key=lambda b: -sum(sizes[i] for i in b))
    good = ranked[:max(1, len(ranked) // 2)]
    injected = [list(b) for b in rng.sample(good, max(1, len(good) // 2))]
    taken = {i for b in injected for i in b}
    clean = [list(b) for b in mine if taken.isdisjoint(b)]
    placed = taken.union(*clean)
    displaced = [i for b in mine for i in b if i not in placed]
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, capacity, injected + clean)


def evolve(sizes: list[int], capacity: int, elites: list[Bins], rng: random.Random,
           population: int = POPULATION, generations: int = GENERATIONS) -> Bins:
    """The best chromosome after some generations; stops at the least possible number of bins."""
    least = -(-sum(sizes) // capacity)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    herd = list(elites) or [best_fit(order, sizes, capacity, [])]
    score = lambda b: fitness(b, sizes, capacity)
    while len(herd) < population and min(map(len, herd)) > least:
        noisy = sorted(order, key=lambda i: -sizes[i] * rng.uniform(0.8, 1.0))
        herd.append(best_fit(noisy, sizes, capacity, []))
    for _ in range(generations):
        herd.sort(key=score)
        if len(herd[0]) <= least or len(herd) < 2:
            break
        a, b = herd[0], rng.choice(herd[1:])
        herd += [crossover(a, b, sizes, capacity, rng), crossover(b, a, sizes, capacity, rng)]
        herd = sorted(herd, key=score)[:population]
    return min(herd, key=score)


# ---- islands on Spark -------------------------------------------------------------------------------------

def _columns(bins: Bins, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Each piece's bin and what that bin holds."""
    number, fill = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for k, b in enumerate(bins):
        number[b], fill[b] = k, sum(sizes[i] for i in b)
    return number, fill


def _epoch(rows: DataFrame, epoch: int, capacity: int, islands: int) -> DataFrame:
    """Evolves every (block, island); ``rows`` has a ``bin`` for each chromosome that came in, told apart by ``origin``."""
    columns = f"{PIECE}, salt bigint, block bigint, island int, origin int, bin bigint, fill bigint"

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        identity = ["doc_id", "piece", "start", "length", "ids_crc32", "salt"]
        pdf = pdf.sort_values([*identity, "origin"], kind="stable")
        elites: list[Bins] = []
        for _, one in pdf.groupby("origin", sort=True):
            elites.append([list(g) for g in pd.Series(range(len(one))).groupby(one["bin"].to_numpy()).agg(list)])
        out = pdf[pdf["origin"] == pdf["origin"].min()].reset_index(drop=True)
        sizes = out["length"].tolist()
        rng = random.Random(f"{key[0]}-{key[1]}-{epoch}")
        bins = evolve(sizes, capacity, elites, rng)
        number, fill = _columns(bins, sizes)
        return out.assign(bin=number, fill=fill, origin=np.int32(key[1]))

    return rows.groupBy("block", "island").applyInPandas(run, columns)


def _best_fit(rows: DataFrame, capacity: int) -> DataFrame:
    """Best-fit decreasing in every block: adds bin, fill and ``open``, whether fewer bins may be possible."""
    columns = f"{PIECE}, salt bigint, block bigint, bin bigint, fill bigint, open boolean"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "start", "length", "ids_crc32", "salt"], kind="stable").reset_index(drop=True)
        sizes = pdf["length"].tolist()
        bins = best_fit(sorted(range(len(sizes)), key=lambda i: -sizes[i]), sizes, capacity, [])
        number, fill = _columns(bins, sizes)
        return pdf.assign(bin=number, fill=fill, open=len(bins) > -(-sum(sizes) // capacity))

    return rows.groupBy("block").applyInPandas(run, columns)


def _pack(rows: DataFrame, capacity: int, block_pieces: int, islands: int, epochs: int) -> DataFrame:
    """Packs pieces within blocks; adds block, bin and fill.

    A block in which best fit reaches the least possible number of bins is done.  The others evolve on islands, which
    start from its result.
    """
    blocks = rows.agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_pieces))).alias("n")).scalar()
    block = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32", "salt"), F.greatest(blocks, F.lit(1)))
    dealt = rows.select(*[c.split()[0] for c in PIECE.split(", ")], "salt", block.cast("bigint").alias("block"))
    fitted = stage(_best_fit(dealt, capacity), "best-fit")
    state = fitted.where("open").drop("open")
    if state.isEmpty():
        return fitted.drop("open")
    state = state.select("*", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), F.lit(0).alias("origin"))
    for epoch in range(epochs):
        state = stage(_epoch(state, epoch, capacity, islands), f"islands-{epoch}")
        if epoch + 1 < epochs:  # the elite stays and also migrates to the next island
            homes = F.array_distinct(F.array(F.col("island"), (F.col("island") + 1) % islands))
            state = state.withColumn("island", F.explode(homes))
    score = (state.groupBy("block", "island")
             .agg((F.max("bin") + 1).alias("bins"), F.sum(F.col("fill") * F.col("length")).alias("quality")))
    winner = (score.groupBy("block")
              .agg(F.max(F.struct(-F.col("bins"), F.col("quality"), -F.col("island"))).alias("w"))
              .select("block", (-F.col("w")["col3"]).alias("island")))
    evolved = state.join(winner, ["block", "island"]).drop("island", "origin")
    return fitted.where("NOT open").drop("open").unionByName(evolved)


def _numbered(rows: DataFrame, level: int) -> DataFrame:
    """sequence_id and each piece's place in its sequence."""
    from pyspark.sql import Window

    sequence = F.lit(level << 61).bitwiseOR(F.shiftleft(F.col("block"), 20)).bitwiseOR(F.col("bin"))
    rows = rows.select("doc_id", "piece", "start", "length", "ids_crc32", "salt", sequence.alias("sequence_id"))
    # A sequence holds at most `capacity` pieces, so this window is bounded.
    before = (Window.partitionBy("sequence_id").orderBy("doc_id", "piece", "start", "ids_crc32", "salt")
              .rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("bigint"))).drop("salt")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
         block_pieces: int = BLOCK_PIECES, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = stage(pieces(docs, tokenizer, capacity, end_id), "pieces")
    first = _pack(cut, capacity, block_pieces, islands, epochs)
    full = F.col("fill") >= F.lit(int(capacity * WELL_FILLED))
    second = _pack(first.where(~full), capacity, block_pieces, islands, epochs)
    return _numbered(first.where(full), 0).unionByName(_numbered(second, 1))
