"""Vector codes: product quantisation with equal-average nearest-entry search.

Components become integers, vectors are cut into equal consecutive parts, and every part position has a codebook that
starts as that part of the vectors with the smallest ids and is moved to its parts' means a fixed number of times.

The nearest entry of a part is found by equal-average search: entries are sorted by the sum of their components; from the
part's own sum the search expands outward to the entry with the next smallest gap, and stops when the squared gap over the
part's length strictly exceeds the best squared distance, which no further entry can then reach.  All vectors of a batch
take these steps together in numpy.

Every round is one pass over the stored integers.  A task hands over one row per part, entry and position, so what is
summed and fetched is bounded by the codebooks' size.  Integer sums make the result independent of order.

Edge cases: vectors that are null or hold null, infinite or NaN components are dropped, and so are vectors whose length
differs from the table's, which is that of the smallest vec_id whose length is a multiple of the parts, and vectors with a
component so large that an error might not fit a long (beyond +-32,768 for 64 components); rows without vec_id count as the last ones;
equal vec_ids are ordered by their components, and repeated rows are coded each; fewer rows than entries give shorter
codebooks; an empty table gives an empty result; very long vectors only cost more (a batch holds 250 rows); other columns of the input,
whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import look_up, map_batches
from tidewatch.session import stage

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096


def greatest_component(length: int) -> int:
    """The bound of integer components for parts of this length: distances, sums and errors stay below 2^63."""
    return min(1 << 27, (1 << 30) // length)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of the nearest entry of every row of x, ties to the lower index, and the number of
    distances computed."""
    length, k = x.shape[1], len(entries)
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = x.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    none = 1 << 31  # above any gap
    best = np.full(len(x), (1 << 62) // length, dtype=np.int64)
    index = np.full(len(x), k, dtype=np.int64)
    active, computed = np.arange(len(x)), 0
    while len(active):
        a, b = left[active], right[active]
        below = np.where(a >= 0, own[active] - sums[np.maximum(a, 0)], none)
        above = np.where(b < k, sums[np.minimum(b, k - 1)] - own[active], none)
        go_below = below <= above
        gap = np.where(go_below, below, above)
        open_ = gap < none
        open_[open_] = gap[open_] ** 2 <= best[active[open_]] * length
        active, go_below, a, b = active[open_], go_below[open_], a[open_], b[open_]
        entry = order[np.where(go_below, a, b)]
        distance = ((x[active] - entries[entry]) ** 2).sum(axis=1)
        computed += len(active)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < index[active]))
        best[active[better]], index[active[better]] = distance[better], entry[better]
        left[active[go_below]] -= 1
        right[active[~go_below]] += 1
    return index, best, computed


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(-1, length)


def integers(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, int]:
    """(vec_id, label, x: integers as bytes) of the kept rows, and the length of a part (0: no rows)."""
    whole = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("bigint"), "label", "embedding").where(F.col("embedding").isNotNull() & whole)
    size = F.size("embedding")
    first = (rows.where((size > 0) & (size % parts == 0)).orderBy(F.col("vec_id").asc_nulls_last(), size).select(size).first())
    length = first[0] // parts if first else 0
    bound = greatest_component(max(1, length))

    def make():
        def work(batch):
            lists = batch.column("embedding")
            x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1) * scale)
            kept = np.abs(x).max(axis=1) <= bound if len(x) else np.zeros(0, dtype=bool)
            x = x[kept].astype("<i8")
            mask = pa.array(kept)
            return {"vec_id": batch.column("vec_id").filter(mask), "label": batch.column("label").filter(mask),
                    "x": [row.tobytes() for row in x]}

        return work

    label = vectors.schema["label"].dataType.simpleString()
    rows = rows.where(size == length * parts) if length else rows.limit(0)
    return map_batches(rows, make, f"vec_id bigint, label {label}, x binary"), length


def _sums(rows: DataFrame, length: int, parts: int, books: np.ndarray) -> DataFrame:
    """part, entry, position and sum of the parts of each entry; position ``length`` has their number."""
    k = books.shape[1]

    def run(batches):
        total = np.zeros((parts, k, length + 1), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), parts * length)
            for p in range(parts):
                piece = x[:, p * length:(p + 1) * length]
                index = nearest(piece, books[p])[0]
                np.add.at(total[p, :, :length], index, piece)
                total[p, :, length] += np.bincount(index, minlength=k)
        p, e, at = np.nonzero(np.broadcast_to(total[:, :, length:] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            (p, e, at, total[p, e, at]), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["part", "entry", "at", "value"])

    sums = rows.select("x").mapInArrow(run, "part int, entry int, at int, value bigint")
    return sums.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))


def learn(rows: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) after the given rounds; ``rows``: vec_id, x."""
    first = rows.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([np.frombuffer(r["x"], dtype="<i8") for r in first], dtype=np.int64)
    books = x.reshape(len(first), parts, length).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        found = {(r["part"], r["entry"], r["at"]): int(r["value"]) for r in _sums(rows, length, parts, books).collect()}
        for (p, e, at), value in found.items():
            if at < length:
                books[p, e, at] = value // found[p, e, length]
    return books


def encode(rows: DataFrame, length: int, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every row."""
    parts = len(books)

    def make():
        def work(batch):
            x = _matrix(batch.column("x"), parts * length)
            index, error = np.zeros((len(x), parts), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
            for p in range(parts):
                at, distance, _ = nearest(x[:, p * length:(p + 1) * length], books[p])
                index[:, p] = at
                error += distance
            return {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": [c.tobytes().hex() for c in index],
                    "error": error}

        return work

    label = rows.schema["label"].dataType.simpleString()
    return map_batches(rows.select("vec_id", "label", "x"), make, f"vec_id bigint, label {label}, code string, error bigint")


def codebook_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.ravel().tolist()))


def by_label(coded: DataFrame) -> DataFrame:
    """Adds label_error, the sum of error over equal labels, nulls together."""
    coded = stage(coded.withColumns({"bare": F.col("label").isNull(), "named": F.coalesce(F.col("label").cast("string"), F.lit(""))}), "coded")
    total: Column = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("bare", "named").agg(F.count(F.lit(1)).alias("n"), F.least(total, F.lit((1 << 63) - 1)).cast("bigint").alias("label_error"))
    out = look_up(coded, sums, ["bare", "named"], F.col("n"), coded.agg(F.count(F.lit(1))).scalar(), F.col("vec_id"))
    return out.drop("bare", "named", "n")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, label_error) of ``vectors`` (vec_id, embedding, label), and the codebooks."""
    rows, length = integers(vectors, parts)
    rows = stage(rows, "integers")
    books = learn(rows, length, parts, entries, rounds) if length else np.zeros((parts, 0, 0), dtype=np.int64)
    return by_label(encode(rows, length, books)), books
