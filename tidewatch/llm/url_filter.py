"""URL filters: host-suffix and path-prefix expressions joined to rules on a short hash prefix.

Each distinct URL is expanded into (host suffix, path prefix) expressions, each expression into its SHA-256
digest.  Rules carry the same digest.  The equi-join is on the first bytes of the digest; the full digest
then confirms, and the longest fitting rule wins.  Path prefixes are cut only at the lengths that occur in
the rules, so an arbitrary rule path (not only whole segments) is honoured and the expansion stays
(labels of the host) x (distinct rule path lengths).

Edge cases: a null URL or one without ``://`` has empty host and path, fits no rule and gets the default
verdict; repeated rows keep their number; equal URLs are judged once.  Among rules of equal length the longer
host wins, then block.  Rules with a null host, path or verdict are ignored; host labels of rules compare
in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import UPPER, ascii_lower

PREFIX_HEX = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict (input columns of these names are replaced).

    ``rules``: host, path, verdict.  Any number of rules works: Spark sends them to every task only if their
    measured size is below its threshold, and else joins by shuffle.
    """
    usable = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict")).dropna()
    usable = usable.select("*", _digest(F.col("r_host"), F.col("r_path")).alias("r_digest"))
    usable = usable.select("*", F.col("r_digest").substr(1, PREFIX_HEX).alias("prefix"))
    lengths = usable.agg(F.collect_set(F.length("r_path")).alias("n")).scalar()

    host, path = host_and_path(F.col("u"))
    urls = (pages.select(F.col(url).alias("u")).dropna().distinct()
            .select("u", host.alias("h"), path.alias("p")))
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    expanded = (urls.select("u", "h", "p", F.explode(lengths).alias("n")).where("n <= length(p)")
                .select("u", F.explode(suffixes).alias("s"), F.substring("p", F.lit(1), F.col("n")).alias("e"))
                .select("u", _digest(F.col("s"), F.col("e")).alias("digest")))
    expanded = expanded.select("u", "digest", F.col("digest").substr(1, PREFIX_HEX).alias("prefix"))
    fitting = expanded.join(usable, "prefix").where("digest = r_digest")
    best = F.max(F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"),
                          (F.col("r_verdict") == "block").alias("b"), F.concat("r_host", "r_path").alias("rule"),
                          F.col("r_verdict").alias("verdict")))
    won = fitting.groupBy("u").agg(best.alias("w")).select("u", "w.rule", "w.verdict")

    kept = pages.drop("host", "path", "rule", "verdict").alias("k")
    out = kept.join(won.alias("w"), F.col(f"k.`{url}`") == F.col("w.u"), "left")
    host, path = host_and_path(F.coalesce(F.col(f"k.`{url}`"), F.lit("")))
    return out.select("k.*", host.alias("host"), path.alias("path"), F.col("w.rule").alias("rule"),
                      F.coalesce("w.verdict", F.lit(default)).alias("verdict"))
