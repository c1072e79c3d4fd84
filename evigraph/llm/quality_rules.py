"""Quality rules of documents and of their hosts (operator 1); DataFrame functions only.

Each document gets counts of words, symbols, repeated lines and repeated three-word windows, and fails the base
rules on few words or much repetition. Failures are summed up by host (``source``); an empirical beta prior, by
the moments of the hosts' failure rates, shrinks each host's rate towards the common one, and the documents of a
host whose shrunk rate exceeds ``max_host_rate`` go.

A null text has no words (and so fails); a document without a host is judged alone. Repeated rows each count.
Three-word windows are compared by a 64-bit hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Fixed characters of the rules: white space between words, and symbols.
BLANKS, SYMBOLS = " \t\n\x0b\f\r", "#*$%&|<>"


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def document_metrics(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of each document with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.trim(text, F.lit(BLANKS))
    read = docs.select(
        *keys,
        F.when(trimmed != "", F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+")).otherwise(F.array().cast("array<string>")).alias("words"),
        F.length(_without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(BLANKS)) != "").alias("lines"),
    )
    counted = [*keys, "word_chars", "n_symbols"]
    windows = F.when(
        F.size("words") > 2,
        F.transform(F.slice("words", F.lit(1), F.size("words") - 2), lambda word, i: F.xxhash64(word, F.get("words", i + 1), F.get("words", i + 2))),
    )
    hashed = read.select(
        *counted,
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    counted += ["n_words", "n_dup_lines"]
    # Windows with their places, sorted by hash, of those documents that repeat one.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.select(*counted, F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered"))
    same = lambda x, k: (F.get("ordered", k)["h"] == x["h"])
    places = F.transform("ordered", lambda x, k: F.when(F.coalesce(same(x, k + 1), F.lit(False)) | F.coalesce(same(x, k - 1), F.lit(False)), x["i"]))
    placed = ordered.select(*counted, F.sort_array(F.array_compact(places)).alias("places"))
    fresh = F.transform("places", lambda i, k: F.least(F.lit(3), F.coalesce(F.get("places", k + 1) - i, F.lit(3))))
    repeated = F.coalesce(F.aggregate(fresh, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0))
    return placed.select(*counted, repeated.cast("long").alias("n_repeat_words"))


def base_failure(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def host_verdicts(metrics: DataFrame, host: str, max_host_rate: float) -> DataFrame:
    """Documents, failures, shrunk failure rate and verdict of each host."""
    hosts = metrics.filter(F.col(host).isNotNull()).groupBy(host).agg(F.count("*").alias("host_docs"), F.count_if("base_failed").alias("host_failures"))
    rate = F.col("host_failures") / F.col("host_docs")
    moments = hosts.agg((F.sum("host_failures") / F.sum("host_docs")).alias("mean"), F.var_samp(rate).alias("variance")).first()
    mean = moments.mean or 0.0
    spread = moments.variance or 0.0
    # Moments of a beta distribution; hosts that do not differ beyond a binomial bound give the widest prior used.
    weight = min(1e6, max(1.0, mean * (1 - mean) / spread - 1)) if spread > 0 else 1e6
    shrunk = (F.col("host_failures") + mean * weight) / (F.col("host_docs") + weight)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_failed", F.col("host_rate") > max_host_rate)


def judged(docs: DataFrame, keys: list[str], host: str = "source", max_host_rate: float = 0.5) -> DataFrame:
    """``keys`` of each document with its metrics, base_failed, the host's rate and verdict, and kept."""
    names = list(dict.fromkeys([*keys, host]))
    metrics = written(document_metrics(docs, names).withColumn("base_failed", base_failure()), "quality-metrics")
    hosts = host_verdicts(metrics, host, max_host_rate).select(host, "host_rate", "host_failed")
    joined = metrics.join(hosts, host, "left")
    failed = F.coalesce("host_failed", F.lit(False))
    return joined.withColumn("host_failed", failed).withColumn("kept", ~F.col("base_failed") & ~failed)
