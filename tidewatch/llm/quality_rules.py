"""Quality rules with host verdicts, in DataFrame functions only.

Per document: words, their characters, symbols, repeated lines, and words in repeated 3-word windows; a
document fails by too few words or too much repetition.  Failures are counted per host; a host's rate is
shrunk towards all hosts by a beta prior whose mean and strength come from the hosts themselves (method of
moments); a host whose shrunk rate is above ``host_limit`` loses its remaining documents.

The repeated windows of a text are found inside its row (hash, sort, compare neighbours), so no text is
shuffled.  Host counts are reduced map-side, so a host with a third of all documents is one more row.

Edge cases: null and empty texts have no words and fail; documents without host form one host of their own
for nothing: they are judged by their own rules alone; repeated rows count each; with a single host, or equal
rates everywhere, the prior is as strong as ``MAX_STRENGTH`` documents; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import SPACE_CHARS, let

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT = 0.5
HOST_LIMIT = 0.5
WINDOW = 3
MAX_STRENGTH = 1e6
SALTS = 64
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _words(text: Column) -> Column:
    bare = F.call_function("btrim", text, F.expr(SPACE_CHARS))
    return F.when(F.length(bare) == 0, F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def _covered(places: Column) -> Column:
    """Words in the windows that start at the given sorted places."""
    gain = F.transform(places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW))))
    return F.aggregate(gain, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _repeated(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs more than once among ``hashes`` (in text order)."""
    numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        same = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(k - 1, x) | same(k + 1, x)), lambda x: x["i"]))

    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(some, let(let(numbered, places), _covered)).otherwise(F.lit(0).cast("bigint"))


def _repeat_words(words: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) > WINDOW, let(hashes, _repeated)).otherwise(F.lit(0).cast("bigint"))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` plus the measures and base_failed (input columns of these names are replaced)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.call_function("btrim", x, F.expr(SPACE_CHARS))) > 0)
    found = let(_words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words")))
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
    rest = [c for c in docs.columns if c not in MEASURES]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("d"), found.alias("w"), dup.alias("n_dup_lines"),
                      F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"))
    n_words, repeat = F.col("w.n_words"), F.col("w.n_repeat_words")
    failed = (n_words < MIN_WORDS) | (repeat > F.lit(MAX_REPEAT) * n_words)
    return out.select(*[F.col("d")[c].alias(c) for c in rest], n_words, "w.word_chars", "n_symbols", "n_dup_lines",
                      repeat, failed.alias("base_failed"))


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """host, n_docs, n_failed, rate and shrunk rate of every host."""
    hosts = (measured.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host"))
             .agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("n_failed")))
    hosts = hosts.withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    mean, spread = F.avg("rate"), F.var_pop("rate")
    strength = F.when((spread > 0) & (mean * (1 - mean) / spread - 1 < MAX_STRENGTH),
                      F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0))).otherwise(F.lit(MAX_STRENGTH))
    prior = hosts.agg(F.struct(mean.alias("mean"), strength.alias("strength"))).scalar()
    shrunk = (F.col("n_failed") + prior.mean * prior.strength) / (F.col("n_docs") + prior.strength)
    return hosts.withColumn("shrunk", shrunk)


def judge(measured: DataFrame, host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Adds ``kept``.  ``measured`` is read twice: store it before (it need not hold the texts).

    Rejected hosts are looked up with a salted key, so the rows of one host go to ``SALTS`` partitions.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    bad = host_rates(measured, host).where(F.col("shrunk") > host_limit).select("host", salts).alias("bad")
    out = measured.drop("kept").alias("m")
    salt = F.pmod(F.xxhash64("m.doc_id", "m.n_words", "m.word_chars"), F.lit(SALTS)).cast("int")
    out = out.join(bad, (F.col(f"m.`{host}`") == F.col("bad.host")) & (salt == F.col("bad.salt")), "left")
    return out.select("m.*", (~F.col("m.base_failed") & F.col("bad.host").isNull()).alias("kept"))
