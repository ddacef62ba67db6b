"""Secret scans: fixed patterns, and strings that look random to a pair of character Markov models.

Two first-order character models are trained from labelled samples: strings that the patterns mark as secrets,
and ordinary tokens of the same documents.  A long token is reported when the log-likelihood ratio of the two
models exceeds the prior odds against a token being a secret.  Training reads a bounded sample of documents
(``sample_docs``, by the hash of doc_id); every whole text is then scanned once, in Arrow batches.

Edge cases: null text is empty and has no spans; repeated rows are scanned each; without any labelled secret
the model of random strings is uniform; spans are counted in code points, ends exclusive; doc_id may be null.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, sample_by_hash

SAMPLE_DOCS = 4000
PRIOR = 1e-6
MIN_RANDOM = 16

# The three patterns and their least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RANDOM)
# Ordinary samples are too short to be reported themselves, so an unknown secret cannot pass for one.
ORDINARY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,%d}(?![A-Za-z0-9+/_=-])" % (MIN_RANDOM - 1))
_CODE = bytes(SIGNS.find(bytes([c])) if bytes([c]) in SIGNS else 255 for c in range(256))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # A run of 24 hexadecimal signs lies within a long token, so only those are searched.
    for t in TOKEN.finditer(text):
        out += [(t.start() + m.start(), 2, t.start() + m.end()) for m in HEX.finditer(t.group())]
    return sorted(out)


def _codes(token: str) -> np.ndarray:
    return np.frombuffer(token.encode().translate(_CODE), dtype=np.uint8)


def _log_model(tokens: list[str], backing: float = 10.0) -> np.ndarray:
    """log P(next | previous), backed by the smoothed shares of single characters; uniform without tokens."""
    n = len(SIGNS)
    counts, single = np.zeros((n, n)), np.full(n, 0.5)
    for t in tokens:
        c = _codes(t)
        np.add.at(counts, (c[:-1], c[1:]), 1)
        np.add.at(single, c, 1)
    return np.log((counts + backing * single / single.sum()) / (counts.sum(axis=1, keepdims=True) + backing))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratio of every pair of characters, from a bounded sample of documents."""
    sample = sample_by_hash(docs.select("doc_id", "text").where("text <> ''"), sample_docs, "doc_id", "text")
    secret, ordinary = [], []
    for row in sample.toLocalIterator():
        text, at = row["text"], 0
        for start, kind, end in base_spans(text):
            value = text[start:end]
            secret += re.findall(r"[A-Za-z0-9+/_=-]{6,}", ASSIGN.fullmatch(value)[2] if kind == 0 else value)
            ordinary += ORDINARY.findall(text[at:start])
            at = max(at, end)
        ordinary += ORDINARY.findall(text[at:])
    return _log_model(secret) - _log_model(ordinary)


def random_spans(text: str, taken: list[tuple[int, int, int]], ratio: np.ndarray, least: float) -> list:
    """Long tokens outside ``taken`` whose log-likelihood ratio exceeds ``least``."""
    out = []
    for m in TOKEN.finditer(text):
        c = _codes(m.group())
        if ratio[c[:-1], c[1:]].sum() > least and not any(a < m.end() and b > m.start() for a, _, b in taken):
            out.append((m.start(), 3, m.end()))
    return out


def scan(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, prior: float = PRIOR) -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, stop) by start, then kind."""
    ratio, least = train(docs, sample_docs), float(np.log((1 - prior) / prior))

    def make():
        def work(batch):
            spans = []
            for text in batch.column("text").to_pylist():
                found = base_spans(text or "")
                found = sorted(found + random_spans(text or "", found, ratio, least))
                spans.append([{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in found])
            return {"doc_id": batch.column("doc_id"), "spans": spans}

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), make,
                       "doc_id bigint, spans array<struct<kind: string, start: int, stop: int>>")
