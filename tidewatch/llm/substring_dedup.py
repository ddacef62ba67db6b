"""Substring deduplication with difference-cover anchors.

A match is a sequence of ``MATCH`` words that starts in two places.  Anchors are hashes of shorter word windows,
taken only where the word's number modulo ``PERIOD`` is in a difference cover: for any two places some shift below the period brings both onto the cover, so two
equal sequences of ``MATCH`` words share an anchor at the same distance from their starts.

1. Anchors of all texts are grouped by hash.  A group with one row is a unique anchor, and its least locator
   names it; hot groups collapse map-side, so no group is ever gathered and nothing is joined on a hot key.
2. Anchors that are not unique extend to the windows of ``MATCH`` words around them.  Only these windows are
   hashed (96 bits) and grouped the same way: what is not unique occurs elsewhere.
3. Words covered by such windows go.

Per document only its lists of unique places travel, bounded by its own length.

Edge cases: null, empty and short texts have no window and lose nothing; overlapping windows of one document
count as occurrences; repeated rows are occurrences of each other and both lose all their windows; rows are located
by a hash of doc_id and text, so rows of different text that share a doc_id or have none are judged each by itself.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches
from tidewatch.session import stage

MATCH = 35
# A perfect difference set; every difference modulo 21 occurs.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
ANCHOR = MATCH - PERIOD + 1
CHUNK_ROWS = 200_000

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so they have inverses modulo 2^64


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Hashes of all windows of a length, from prefix sums of a polynomial modulo 2^64."""

    def __init__(self, base: int):
        self.steps = (np.uint64(base), np.uint64(pow(base, -1, 1 << 64)))
        self.powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]

    def _grow(self, n: int) -> None:
        while len(self.powers[0]) < n:
            for k, p in enumerate(self.powers):
                self.powers[k] = np.concatenate([p, p * (p[-1] * self.steps[k])])

    def windows(self, words: np.ndarray, size: int) -> np.ndarray:
        n = len(words) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        self._grow(len(words))
        up, down = self.powers
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * up[:len(words)], dtype=np.uint64)])
        return _scramble((sums[size:] - sums[:-size]) * down[:n])


def split_words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def cover_places(n_words: int) -> np.ndarray:
    """Word numbers where an anchor starts."""
    starts = np.arange(0, max(0, n_words - ANCHOR + 1))
    return starts[np.isin(starts % PERIOD, COVER)]


def _union(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Flags of 0..n-1 covered by [start, stop) ranges."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, stops, -1)
    return np.cumsum(change[:-1]) > 0


def candidate_windows(n_words: int, unique_anchors) -> np.ndarray:
    """Starts of the windows that hold an anchor which is not unique."""
    n = n_words - MATCH + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    anchors = np.setdiff1d(cover_places(n_words), np.asarray(unique_anchors, dtype=np.int64), assume_unique=True)
    first = np.maximum(anchors - (PERIOD - 1), 0)
    keep = first < n
    return np.flatnonzero(_union(first[keep], np.minimum(anchors[keep] + 1, n), n))


def _located(docs: DataFrame) -> DataFrame:
    """doc_id, text and the row's locator."""
    return docs.select(F.col("doc_id").cast("bigint"), "text",
                       F.xxhash64(F.col("doc_id").cast("bigint"), "text").alias("at"))


def _chunks(rows):
    """Column chunks of bounded size from (at, places, hash columns) of each text."""
    held, size = [], 0

    def flush():
        at = np.concatenate([np.full(len(p), a, dtype=np.int64) for a, p, _ in held])
        out = {"at": at, "place": np.concatenate([p for _, p, _ in held]).astype(np.int32)}
        for k in range(len(held[0][2])):
            out[f"g{k}"] = np.concatenate([g[k] for _, _, g in held])
        return out

    for row in rows:
        held.append(row)
        size += len(row[1])
        if size >= CHUNK_ROWS:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _uniques(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """at and the places of its rows whose keys occur nowhere else."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at"), F.min("place").alias("place"))
    return groups.where("n = 1").groupBy("at").agg(F.collect_list("place").alias(name))


def unique_anchors(located: DataFrame) -> DataFrame:
    def make():
        roller = Roller(_BASES[0])

        def rows(batch):
            for at, text in zip(batch.column("at").to_pylist(), batch.column("text").to_pylist()):
                h = word_hashes(split_words(text))
                if len(h) >= MATCH:
                    places = cover_places(len(h))
                    yield at, places, [roller.windows(h, ANCHOR)[places].view(np.int64)]

        return lambda batch: _chunks(rows(batch))

    anchors = map_batches(located.select("at", "text"), make, "at bigint, place int, g0 bigint")
    return _uniques(anchors, ["g0"], "anchors")


def unique_windows(located: DataFrame, anchors: DataFrame) -> DataFrame:
    def make():
        one, two = (Roller(b) for b in _BASES)

        def rows(batch):
            for at, text, unique in zip(*(batch.column(c).to_pylist() for c in ("at", "text", "anchors"))):
                words = split_words(text)
                places = candidate_windows(len(words), unique or [])
                if len(places):
                    h = word_hashes(words)
                    yield at, places, [one.windows(h, MATCH)[places].view(np.int64),
                                       (two.windows(h, MATCH)[places] >> np.uint64(32)).astype(np.uint32).view(np.int32)]

        return lambda batch: _chunks(rows(batch))

    joined = located.join(anchors, "at", "left").select("at", "text", "anchors")
    windows = map_batches(joined, make, "at bigint, place int, g0 bigint, g1 int")
    return _uniques(windows, ["g0", "g1"], "windows")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, text (the words that stay, joined by one space), n_words and n_removed of every row."""
    located = _located(docs)
    anchors = stage(unique_anchors(located), "anchors")
    windows = stage(unique_windows(located, anchors), "windows")

    def make():
        def cut(text, anchors, windows):
            words = split_words(text)
            n = len(words)
            places = np.setdiff1d(candidate_windows(n, anchors or []), np.asarray(windows or [], dtype=np.int64))
            lost = _union(places, places + MATCH, n)
            kept = [w for w, gone in zip(words, lost.tolist()) if not gone] if len(places) else words
            return n, n - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")

        def work(batch):
            rows = [cut(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("text", "anchors", "windows")))]
            return {"doc_id": batch.column("doc_id"), "text": [r[2] for r in rows],
                    "n_words": [r[0] for r in rows], "n_removed": [r[1] for r in rows]}

        return work

    joined = located.join(anchors, "at", "left").join(windows, "at", "left")
    return map_batches(joined.select("doc_id", "text", "anchors", "windows"), make,
                       "doc_id bigint, text string, n_words bigint, n_removed bigint")
