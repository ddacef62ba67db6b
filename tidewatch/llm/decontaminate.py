"""Benchmark decontamination: one automaton over all windows of the test items, each text scanned once.

Texts are normalised to words (A-Z lower-cased; letters, digits and everything outside ASCII).  Every word of
the items gets a code and a window of 13 words becomes a string of 13 codes; one Aho-Corasick automaton over
these strings runs along the coded words of a document, so a match's end is a word index, which maps back to
the characters of the original text.

The items are fetched in blocks of at most ``block_chars`` characters, one automaton each; a longer item is cut into parts
that overlap by a window less one word, so its windows stay whole.  A task holds at most ``BLOCKS`` automata: that many blocks
or fewer are one scan.  More are scanned ``BLOCKS`` at a time, any number of times; the findings of a scan are written, keyed
by a hash of the text (findings depend on nothing else), and a last step joins and merges them.  The work grows with the
number of scans.

Edge cases: null or wordless text has no words, no hits and is clean; items without words never match; an
item of fewer than 13 words is one window; repeated items count once per item_id; items with a null id hit
words but are not counted or listed; repeated document rows are judged each by itself.
"""

from __future__ import annotations

import re
from collections import deque
from itertools import batched, chain

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches
from tidewatch.session import work_dir

WINDOW = 13
BLOCK_CHARS = 1_000_000
BLOCKS = 2

# ASCII letters and digits stay (A-Z as a-z), other ASCII bytes become spaces, bytes beyond ASCII stay.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                for c in range(256))
_ORIGINAL_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

FOUND = ("struct<n_words: bigint, hits: array<struct<start: int, stop: int>>, "
         "spans: array<struct<start: int, stop: int>>, items: array<bigint>>")
PARTS = "_text1 bigint, _text2 bigint, hits array<struct<start: int, stop: int>>, items array<bigint>"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


class Scanner:
    """Finds the windows of some items in texts."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int):
        self.codes: dict[bytes, str] = {}
        owners: dict[str, set] = {}
        for item, text in items:
            coded = "".join(self.codes.setdefault(w, chr(len(self.codes) + 0x10000)) for w in words_of(text))
            for i in range(max(1, len(coded) - window + 1) if coded else 0):
                owners.setdefault(coded[i:i + window], set()).update([] if item is None else [item])
        self.automaton = ahocorasick.Automaton()
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), ids))
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: str | None, before: dict | None = None) -> dict:
        """Number of words, hit word ranges, their character ranges, items; joined with an earlier block's."""
        words = words_of(text)
        found = [(h["start"], h["stop"]) for h in before["hits"]] if before else []
        items = set(before["items"]) if before else set()
        if len(self.automaton):
            coded = "".join([self.codes.get(w, "\0") for w in words])
            for end, (size, ids) in self.automaton.iter(coded):
                found.append((end + 1 - size, end + 1))
                items |= ids
        ranges: list[list[int]] = []
        for start, stop in sorted(found):
            if ranges and start <= ranges[-1][1]:
                ranges[-1][1] = max(ranges[-1][1], stop)
            else:
                ranges.append([start, stop])
        spans = []
        if ranges:
            places = [m.span() for m in _ORIGINAL_WORD.finditer(text)]
            spans = [{"start": places[a][0], "stop": places[b - 1][1]} for a, b in ranges]
        return {"n_words": len(words), "hits": [{"start": a, "stop": b} for a, b in ranges], "spans": spans,
                "items": sorted(items)}


def _pieces(text: str, size: int, window: int):
    """The item, or parts of at most ``size`` characters (of ``window`` words at least) with all of its windows."""
    if len(text) <= size:
        yield text
        return
    held: deque[tuple[int, int]] = deque()
    for m in _ORIGINAL_WORD.finditer(text):
        if len(held) >= window and m.end() - held[0][0] > size:
            yield text[held[0][0]:held[-1][1]]
            while len(held) >= window:
                held.popleft()
        held.append(m.span())
    if held:
        yield text[held[0][0]:held[-1][1]]


def _blocks(items: DataFrame, item_id: str, text: str, block_chars: int, window: int):
    """Items in blocks of bounded size, fetched one partition at a time."""
    rows = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t"))
    block, size = [], 0
    for i, t in rows.toLocalIterator():
        for piece in _pieces(t or "", block_chars, window):
            if block and size + len(piece) > block_chars:
                yield block
                block, size = [], 0
            block.append((i, piece))
            size += len(piece)
    if block:
        yield block


def _scan(docs: DataFrame, blocks: tuple, text: str, window: int) -> DataFrame:
    """``docs`` with its column ``found`` joined with what the blocks' automata find."""

    def make():
        scanners = [Scanner(b, window) for b in blocks] or [Scanner([], window)]

        def one(t, found):
            for s in scanners:
                found = s.scan(t, found)
            return found

        def work(batch):
            texts, before = batch.column(text).to_pylist(), batch.column("found").to_pylist()
            out = {f: batch.column(f) for f in batch.schema.names}
            out["found"] = [one(t, b) for t, b in zip(texts, before)]
            return out

        return work

    return map_batches(docs, make, docs.schema)


def _part(keyed: DataFrame, blocks: tuple, window: int) -> DataFrame:
    """Findings of the blocks in the texts that have any, one row per text.  ``keyed``: _text1, _text2, text."""

    def make():
        scanners = [Scanner(b, window) for b in blocks]

        def work(batch):
            out = {"_text1": [], "_text2": [], "hits": [], "items": []}
            for k1, k2, t in zip(*(batch.column(c).to_pylist() for c in ("_text1", "_text2", "text"))):
                found = None
                for s in scanners:
                    found = s.scan(t, found)
                if found["hits"]:
                    for name, value in zip(out, (k1, k2, found["hits"], found["items"])):
                        out[name].append(value)
            return out

        return work

    return map_batches(keyed, make, PARTS).dropDuplicates(["_text1", "_text2"])


def find_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` plus ``found`` (n_words, hits, spans, items); an input column ``found`` is replaced.

    ``hits`` are ranges of word numbers, ``spans`` the same in characters of the original text.
    """
    docs = docs.drop("found")
    groups = batched(_blocks(items, item_id, item_text, block_chars, window), BLOCKS)
    first, second = next(groups, ()), next(groups, None)
    if second is None:
        return _scan(docs.withColumn("found", F.lit(None).cast(FOUND)), first, text, window)

    spark = docs.sparkSession
    path = work_dir(spark, "found")
    keys = {"_text1": F.xxhash64(text), "_text2": F.xxhash64(F.lit(3), text)}
    keyed = docs.where(F.col(text).isNotNull()).select(*[c.alias(k) for k, c in keys.items()], F.col(text).alias("text"))
    for blocks in chain((first, second), groups):
        _part(keyed, blocks, window).write.mode("append").parquet(path)
    # A text has one row per scan at most.
    parts = spark.read.schema(PARTS).parquet(path).groupBy("_text1", "_text2").agg(
        F.struct(F.lit(None).cast("bigint").alias("n_words"), F.flatten(F.collect_list("hits")).alias("hits"),
                 F.lit(None).cast("array<struct<start: int, stop: int>>").alias("spans"),
                 F.flatten(F.collect_list("items")).alias("items")).alias("found"))
    joined = docs.withColumns(keys).join(parts, list(keys), "left").select(*docs.columns, F.col("found").cast(FOUND))
    return _scan(joined, (), text, window)


def decontaminate(docs: DataFrame, items: DataFrame, share: float = 0.05, **options) -> DataFrame:
    """``find_items`` plus n_hit and contaminated: hit words are at least ``share`` of all words."""
    docs = find_items(docs, items, **options)
    lengths = F.transform("found.hits", lambda h: h.stop.cast("long") - h.start)
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)
    docs = docs.drop("n_hit", "contaminated").withColumn("n_hit", n_hit)
    return docs.withColumn("contaminated",
                           (F.col("n_hit") > 0) & (F.col("n_hit") >= F.lit(share) * F.col("found.n_words")))
