"""Language identification by a byte convolutional network, written and trained in numpy.

Network: one-hot bytes, filters of several widths, maximum over a fixed-length window, softmax.  A filter on
one-hot bytes is a sum of table look-ups, so a window costs a few look-ups per byte.  Texts are cut into
windows of ``WINDOW`` bytes (the last one is padded); all windows of the whole text are scored in batches and
their log probabilities, weighted by the bytes they hold, are averaged.

Every language of the labelled rows is learned.  Each gives its share of ``sample_docs`` documents, but at least ``least_docs`` or
all it has (smallest hashes of doc_id and text; repeated rows
count once, texts without a letter not at all); whole texts are cut into windows of which each document gives at most ``sample_windows``.
Weights grow with the number of languages only (a few hundred KB for tens of them) and travel with the task.

Edge cases: a null text or one without a letter is ``und`` with score 0; without any labelled document every
text is ``und``; one language only gives that language with score 1; repeated rows are scored each; rows with
null lang are never learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import hash_place, map_batches

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 12
EPOCHS = 6
BATCH = 64
RATE = 0.02
SAMPLE_DOCS = 2000
LEAST_DOCS = 50
SAMPLE_WINDOWS = 3
BLOCK_WINDOWS = 256
UNKNOWN = "und"

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def windows_of(text: str) -> np.ndarray:
    """(n, WINDOW + widest filter - 1) bytes: consecutive windows, each with the bytes its last filter needs."""
    raw = np.frombuffer(text.encode("utf-8", "replace").translate(_LOWER), dtype=np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    padded = np.full(n * WINDOW + max(WIDTHS) - 1, 32, dtype=np.uint8)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + max(WIDTHS) - 1)[::WINDOW]


@dataclass
class Network:
    """Filter tables (one per width: width x 256 x filters), filter biases, output layer, languages."""

    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    languages: list[str]

    @staticmethod
    def new(languages: list[str], rng: np.random.Generator) -> "Network":
        n = len(WIDTHS) * FILTERS
        return Network([rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                       np.zeros(n, np.float32), rng.normal(0, 0.1, (n, len(languages))).astype(np.float32),
                       np.zeros(len(languages), np.float32), languages)

    def features(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window and filter: the largest response (at least 0) and where it was."""
        peaks, places = [], []
        for w, t in zip(WIDTHS, self.tables):
            response = t[0][x[:, :WINDOW]]
            for j in range(1, w):
                response += t[j][x[:, j:WINDOW + j]]
            places.append(response.argmax(axis=1))
            peaks.append(np.take_along_axis(response, places[-1][:, None, :], axis=1)[:, 0])
        return np.maximum(np.concatenate(peaks, axis=1) + self.bias, 0), np.concatenate(places, axis=1)

    def pair_tables(self) -> list[np.ndarray]:
        """For scoring: the first two bytes of each filter as one look-up (65,536 x filters)."""
        return [(t[0][:, None, :] + t[1][None, :, :]).reshape(65536, FILTERS) for t in self.tables]

    def log_probabilities(self, x: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
        wide = x.astype(np.int32)
        pair = wide[:, :-1] * 256 + wide[:, 1:]
        peaks = []
        for w, t, two in zip(WIDTHS, self.tables, pairs):
            response = two.take(pair[:, :WINDOW], axis=0)
            for j in range(2, w):
                response += t[j].take(x[:, j:WINDOW + j], axis=0)
            peaks.append(response.max(axis=1))
        hidden = np.maximum(np.concatenate(peaks, axis=1) + self.bias, 0)
        return _log_softmax(hidden @ self.out + self.out_bias)

    def score_texts(self, texts: list[str], pairs: list[np.ndarray]) -> tuple[list[int], list[float]]:
        """Best language and its probability of each text; windows of many texts share a batch."""
        views = [windows_of(t) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(v) for v in views])
        total = np.zeros((len(texts), len(self.languages)))
        weight = np.zeros(len(texts))
        for at in range(0, len(owner), BLOCK_WINDOWS):
            own = owner[at:at + BLOCK_WINDOWS]
            first = at - np.searchsorted(owner, own[0])
            parts = [v for v in views[own[0]:own[-1] + 1]]
            x = np.concatenate([parts[0][first:first + BLOCK_WINDOWS], *parts[1:]])[:len(own)]
            filled = np.maximum((x[:, :WINDOW] != 32).sum(axis=1), 1)
            np.add.at(total, own, self.log_probabilities(x, pairs) * filled[:, None])
            np.add.at(weight, own, filled)
        p = np.exp(_log_softmax(total / weight[:, None]))
        return p.argmax(axis=1).tolist(), p.max(axis=1).astype(float).tolist()


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def fit(texts: list[str], labels: list[str], seed: int = 7, epochs: int = EPOCHS,
        sample_windows: int = SAMPLE_WINDOWS) -> Network | None:
    """Adam on the cross-entropy of windows; None without labelled texts."""
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    xs, ys = [], []
    for text, label in zip(texts, labels):
        v = windows_of(text)
        take = v[rng.permutation(len(v))[:sample_windows]]
        xs.append(take)
        ys += [languages.index(label)] * len(take)
    x, y = np.concatenate(xs), np.array(ys)
    net = Network.new(languages, rng)
    params = [*net.tables, net.bias, net.out, net.out_bias]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            hidden, places = net.features(x[rows])
            delta = np.exp(_log_softmax(hidden @ net.out + net.out_bias))
            delta[np.arange(len(rows)), y[rows]] -= 1
            delta /= len(rows)
            back = (delta @ net.out.T) * (hidden > 0)
            grads = [np.zeros_like(t) for t in net.tables]
            for k, w in enumerate(WIDTHS):
                span = slice(k * FILTERS, (k + 1) * FILTERS)
                for j in range(w):
                    byte = np.take_along_axis(x[rows], places[:, span] + j, axis=1)
                    np.add.at(grads[k][j], (byte, np.arange(FILTERS)[None, :]), back[:, span])
            grads += [back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def sample_languages(docs: DataFrame, sample_docs: int, least_docs: int) -> DataFrame:
    """Labelled rows of every language: its share of ``sample_docs``, at least ``least_docs`` or all it has."""
    labelled = (docs.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
                .withColumn("place", hash_place("doc_id", "text")))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("place").alias("several")).collect()
    total = sum(r["n"] for r in counts)
    wanted = [(r["lang"], max(least_docs, -(-sample_docs * r["n"] // total)), r["several"]) for r in counts]
    # Only rows below their language's cut, some twice as many as wanted, are ordered.
    limits = docs.sparkSession.createDataFrame(
        [(lang, m, int(min(1.0, 2.0 * m / several) * (1 << 32))) for lang, m, several in wanted], "lang string, wanted long, cut long")
    rows = labelled.join(F.broadcast(limits), "lang").where("place < cut").dropDuplicates()
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    rows = rows.withColumn("rank", F.row_number().over(order)).where("rank <= wanted")
    return rows.orderBy("place", "doc_id", "text", "lang").select("doc_id", "text", "lang")


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, least_docs: int = LEAST_DOCS) -> Network | None:
    """Network from labelled rows of ``docs``, of every language."""
    sample = sample_languages(docs, sample_docs, least_docs)
    rows = [(r["text"], r["lang"]) for r in sample.toLocalIterator() if r["text"] and any(map(str.isalpha, r["text"]))]
    return fit([t for t, _ in rows], [lang for _, lang in rows])


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``docs`` (doc_id, text)."""

    def make():
        pairs = net.pair_tables() if net else []

        def work(batch):
            texts = batch.column("text").to_pylist()
            known = [i for i, t in enumerate(texts) if net and t and any(map(str.isalpha, t))]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known:
                for i, best, p in zip(known, *net.score_texts([texts[i] for i in known], pairs)):
                    lang[i], score[i] = net.languages[best], p
            return {"doc_id": batch.column("doc_id"), "lang_pred": lang, "score": score}

        return work

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), make,
                       "doc_id bigint, lang_pred string, score double")
