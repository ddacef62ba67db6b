"""Document quality from a linear-chain conditional random field over lines.

Every line has features of its own (length, shares of character classes, word repetition, repetition of an
earlier line) and those of its two neighbours.  The field labels each line good or bad; forward-backward gives
the probability that a line is good, and a document's score is their mean weighted by line length.  Labels are
known per document only, so in training every line carries its document's label.

Training reads at most ``sample_docs`` labelled documents (smallest hash of doc_id; of rows that share a doc_id, the one
with the smallest text hash) and runs in numpy; the model is some fifty numbers.  Scoring runs in Arrow batches over whole texts.

Edge cases: null text is empty: one empty line, scored like any other; without labels, or with one class only,
every score is the share of good labels (0.5 without any); a document labelled twice counts as bad if any label
says so; null labels are skipped; repeated rows are scored each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import map_batches, sample_by_hash

SAMPLE_DOCS = 3000
EPOCHS = 12
BATCH = 128
RATE = 0.05
L2 = 1e-3
CHUNK_LINES = 40_000

_CLASSES = tuple(bytes(c) for c in (
    range(65, 91), range(48, 58), b"#*$%&|<>", b"!?", b".,;:'\"()-", range(128, 256)))
OWN = len(_CLASSES) + 9
SIZE = 3 * OWN + 3


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines, SIZE) features and (lines,) lengths; empty lines have length 1 like their line break."""
    rows, lengths, seen = [], [], set()
    for line in text.encode("utf-8", "replace").split(b"\n"):
        n, words = len(line), line.split()
        k = len(words)
        shares = [(n - len(line.translate(None, c))) / (n or 1) for c in _CLASSES]
        same = sum(map(bytes.__eq__, words, words[1:]))
        odd = [min(1.0, shares[c] * n / (k or 1)) for c in (2, 3)]  # signs per word
        rows.append([*shares, *odd, np.log1p(n) / 6, float(k == 0), float(k < 4), len(set(words)) / k if k else 1.0,
                     same / k if k else 0.0, min(3.0, n / k / 8) if k else 0.0, float(k > 0 and line in seen)])
        seen.add(line)
        lengths.append(n + 1)
    own = np.array(rows, dtype=np.float32)
    x = np.zeros((len(own), SIZE), dtype=np.float32)
    x[:, :OWN] = own
    x[1:, OWN:2 * OWN] = own[:-1]
    x[:-1, 2 * OWN:3 * OWN] = own[1:]
    x[0, 3 * OWN] = x[-1, 3 * OWN + 1] = x[:, 3 * OWN + 2] = 1
    return x, np.array(lengths, dtype=np.float64)


@dataclass
class Field:
    """weights: (SIZE, 2) emission weights of bad and good; transition: (2, 2) from, to."""

    weights: np.ndarray
    transition: np.ndarray
    constant: float | None = None


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def forward_backward(emission: np.ndarray, sizes: np.ndarray, transition: np.ndarray):
    """Padded (documents, lines, 2) scores -> log alpha, log beta, log normaliser; padding is left as it is."""
    docs, lines, _ = emission.shape
    alpha, beta = np.zeros_like(emission), np.zeros_like(emission)
    alpha[:, 0] = emission[:, 0]
    for t in range(1, lines):
        step = _log_sum(alpha[:, t - 1, :, None] + transition, 1) + emission[:, t]
        alpha[:, t] = np.where((t < sizes)[:, None], step, alpha[:, t - 1])
    for t in range(lines - 2, -1, -1):
        step = _log_sum(transition + (emission[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where((t + 1 < sizes)[:, None], step, 0)
    return alpha, beta, _log_sum(alpha[:, -1], 1)


def _padded(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(f) for f in features])
    x = np.zeros((len(features), sizes.max(), SIZE), dtype=np.float32)
    for k, f in enumerate(features):
        x[k, :len(f)] = f
    return x, sizes


def fit(texts: list[str], labels: list[int], seed: int = 11, epochs: int = EPOCHS) -> Field:
    """Adam on the regularised negative log-likelihood of the label sequences."""
    weights, transition = np.zeros((SIZE, 2)), np.zeros((2, 2))
    if len(set(labels)) < 2:
        return Field(weights, transition, float(np.mean(labels)) if labels else 0.5)
    rng = np.random.default_rng(seed)
    features = [line_features(t)[0] for t in texts]
    y = np.array(labels)
    order = np.argsort([len(f) for f in features], kind="stable")
    batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]  # similar lengths: little padding
    params = [weights, transition]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            x, sizes = _padded([features[i] for i in batches[b]])
            own = y[batches[b]]
            emission = x @ weights
            alpha, beta, z = forward_backward(emission, sizes, transition)
            real = np.arange(x.shape[1])[None, :] < sizes[:, None]
            p = np.exp(alpha + beta - z[:, None, None]) * real[:, :, None]
            wanted = np.eye(2)[own][:, None, :] * real[:, :, None]
            scale = 1 / sizes[:, None, None]  # every document counts the same
            g_weights = np.einsum("dts,dtc->sc", x, (p - wanted) * scale) / len(own)
            g_transition = np.zeros((2, 2))
            if x.shape[1] > 1:
                pair = (alpha[:, :-1, :, None] + transition + (emission + beta)[:, 1:, None, :] - z[:, None, None, None])
                pair = np.exp(np.minimum(pair, 0)) * real[:, 1:, None, None]
                seen = np.zeros((len(own), 2, 2))
                seen[np.arange(len(own)), own, own] = sizes - 1
                g_transition = ((pair.sum(axis=1) - seen) / sizes[:, None, None]).mean(axis=0)
            step += 1
            for q, g, m, v in zip(params, (g_weights + L2 * weights, g_transition + L2 * transition), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(weights, transition)


def score_texts(texts: list[str], field: Field) -> list[float]:
    """Length-weighted mean probability of a good line, of each text."""
    if field.constant is not None:
        return [field.constant] * len(texts)
    pairs = [line_features(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: len(pairs[i][1]))
    out = [0.0] * len(texts)
    at = 0
    while at < len(order):  # documents of similar length, a bounded number of padded lines at a time
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(pairs[order[stop]][1]) <= CHUNK_LINES:
            stop += 1
        some = order[at:stop]
        sizes = np.array([len(pairs[i][1]) for i in some])
        emission, weight = np.zeros((len(some), sizes.max(), 2)), np.zeros((len(some), sizes.max()))
        for k, i in enumerate(some):
            emission[k, :sizes[k]], weight[k, :sizes[k]] = pairs[i][0] @ field.weights, pairs[i][1]
        alpha, beta, z = forward_backward(emission, sizes, field.transition)
        good = np.exp(np.minimum(alpha[:, :, 1] + beta[:, :, 1] - z[:, None], 0))
        for k, value in enumerate((good * weight).sum(axis=1) / weight.sum(axis=1)):
            out[some[k]] = float(min(1.0, value))
        at = stop
    return out


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Field:
    """Field from ``labels`` (doc_id, quality) of documents with the smallest hashes of doc_id."""
    known = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.min("quality").alias("quality")))
    chosen = sample_by_hash(known, sample_docs)
    # At most sample_docs rows of two numbers: a bounded broadcast keeps the texts where they are.
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")
            .withColumn("h", F.xxhash64("text")))
    # One row per doc_id, found map-side by numbers alone, so that texts of one doc_id are never gathered.
    least = rows.groupBy("doc_id").agg(F.min("h").alias("h"))
    rows = rows.join(F.broadcast(least), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    pairs = sorted((r["doc_id"], r["text"], int(r["quality"])) for r in rows.toLocalIterator())
    return fit([t for _, t, _ in pairs], [q for _, _, q in pairs])


def score(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id and score of every row."""

    def make():
        def work(batch):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "score": score_texts(texts, field)}

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), make, "doc_id bigint, score double")
