"""Quality rules for documents, judged with the record of their hosts.

Every document has a figure and a limit for each rule.  Failures are added up per host; the
rates are shrunk towards the corpus with a beta prior that is fitted to all hosts, so a host with
few documents is judged mostly by the others.  The host verdict goes back to its documents:

* ``trusted``: a document goes if a rule's figure is above its limit;
* ``watched`` (a rule fails far more often than in the corpus): that rule's limit is halved;
* ``rejected`` (more than half of the documents fail, after shrinking): all go.

The host of a document is its ``source``; documents without source are one host.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import stored

#: Characters that count as symbols and that separate words: fixed values.
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 5

LEAST_WORDS = 10
#: Rules by name: figure, what it is a share of, and its limit in per cent.
RULES = {
    "repeats": ("n_repeat_words", "n_words", 20),
    "symbols": ("n_symbols", "word_chars", 5),
    "lines": ("n_dup_lines", "n_lines", 40),
}
#: A host is rejected from this shrunken rate of failing documents on.
REJECTED_RATE = 0.5
#: A host is watched for a rule if it fails at least this often, and so many times the corpus rate.
WATCHED_RATE = 0.2
WATCHED_TIMES = 2.0
#: Bounds of the prior's strength, in documents.
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
#: The host table is broadcast up to this many rows of about a hundred bytes.
BROADCAST_HOSTS = 100_000

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
HOST = "_host"


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five words that occur twice or more, the first occurrence included."""
    size = len(words) - WINDOW + 1
    if size < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.array([index.setdefault(word, len(index)) for word in words], np.uint64)
    windows, span = ids[:size], len(index)
    for k in range(1, WINDOW):
        if span * len(index) >= 1 << 64:  # name the windows so far by their rank
            windows = np.unique(windows, return_inverse=True)[1].astype(np.uint64)
            span = size
        windows = windows * np.uint64(len(index)) + ids[k : k + size]
        span *= len(index)
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    if len(counts) == size:
        return 0
    # Each repeated window covers five places; the sum of starts and ends marks them.
    starts = np.flatnonzero(counts[inverse] > 1)
    steps = np.zeros(len(words) + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int((np.cumsum(steps)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The figures of one whole text, in the order of ``STATS``; a NULL text has none of anything."""
    text = text or ""
    words = text.encode().split()  # at ASCII white space, unlike str.split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in STATS]))
def _stats(texts: pa.Array) -> pa.Array:
    columns = list(zip(*(text_stats(text.as_py()) for text in texts), strict=True)) or [()] * len(STATS)
    return pa.StructArray.from_arrays([pa.array(column, pa.int64()) for column in columns], names=STATS)


def base_failed() -> Column:
    """The rules that hold for every host."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def exceeds(rule: str, share: float = 1.0) -> Column:
    figure, whole, percent = RULES[rule]
    return 100 * F.col(figure) > F.lit(percent * share) * F.col(whole)


def fails() -> Column:
    any_rule = base_failed()
    for rule in RULES:
        any_rule = any_rule | exceeds(rule)
    return any_rule


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, the host and the figures of every whole text."""
    columns = [F.col(name) for name in keep]
    return docs.select(
        *columns, docs["source"].cast("string").alias(HOST), _stats(docs["text"].cast("string")).alias("_stats")
    ).select(*columns, HOST, "_stats.*")


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host its documents, and per rule (and ``any``) its shrunken rate and the corpus rate."""
    rules = {"any": fails(), **{rule: exceeds(rule) for rule in RULES}}
    hosts = measured.groupBy(HOST).agg(
        F.count("*").alias("n"), *(F.sum(failed.cast("int")).alias(f"k_{rule}") for rule, failed in rules.items())
    )
    # The prior: mean and strength from the spread of rates between hosts, weighted by documents.
    moments = [F.sum("n").alias("all_n"), F.count("*").alias("hosts")]
    for rule in rules:
        k = F.col(f"k_{rule}")
        moments += [F.sum(k).alias(f"sum_{rule}"), F.sum(k * k / F.col("n")).alias(f"square_{rule}")]
    shrunk = hosts.crossJoin(F.broadcast(hosts.agg(*moments)))  # one row
    columns = [F.col(HOST), F.col("n")]
    for rule in rules:
        mean = F.col(f"sum_{rule}") / F.col("all_n")
        spread = F.col(f"square_{rule}") / F.col("all_n") - mean * mean
        # What chance alone adds to the spread.
        chance = mean * (1 - mean) * F.col("hosts") / F.col("all_n")
        between = spread - chance
        strength = F.when(between > 0, mean * (1 - mean) / between - 1).otherwise(F.lit(MOST_STRENGTH))
        strength = F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
        columns += [
            ((F.col(f"k_{rule}") + strength * mean) / (F.col("n") + strength)).alias(f"rate_{rule}"),
            mean.alias(f"mean_{rule}"),
        ]
    return shrunk.select(*columns)


def host_verdicts(rates: DataFrame) -> DataFrame:
    """Per host the share of each rule's limit that its documents are held to, NULL if it is rejected."""
    rejected = F.col("rate_any") >= REJECTED_RATE
    columns = []
    for rule in RULES:
        often = F.greatest(F.lit(WATCHED_RATE), WATCHED_TIMES * F.col(f"mean_{rule}"))
        watched = F.col(f"rate_{rule}") >= often
        columns.append(F.when(~rejected, F.when(watched, 0.5).otherwise(1.0)).alias(f"share_{rule}"))
    return rates.select(HOST, rejected.alias("host_rejected"), *columns)


def with_verdict(spark: SparkSession, measured: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``; ``verdicts`` is a stored table with a row per host."""
    few = verdicts.count() <= BROADCAST_HOSTS
    hosts = verdicts.withColumnRenamed(HOST, "_verdict_host")
    hosts = F.broadcast(hosts) if few else hosts
    joined = measured.join(hosts, measured[HOST].eqNullSafe(hosts["_verdict_host"]), "left")
    bad = base_failed() | F.col("host_rejected")
    for rule in RULES:
        figure, whole, percent = RULES[rule]
        bad = bad | (100 * F.col(figure) > percent * F.col(f"share_{rule}") * F.col(whole))
    return joined.withColumns({"base_failed": base_failed(), "kept": ~F.coalesce(bad, F.lit(True))})


def judge(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id``, the figures, ``base_failed`` and ``kept`` of every document.

    The figures are stored once, without texts, and read for the host totals and for the verdicts.
    Totals are combined before their shuffle, so a hot host is one row per task.  Up to
    ``BROADCAST_HOSTS`` hosts are joined by broadcast; more by a shuffle, whose hot partitions AQE
    splits, with the same result.

    A NULL or empty text has no words and fails; a NULL id stays NULL; documents without source
    are one host; repeated rows are judged each, and count each for their host; an empty table
    gives no rows; other columns are not read.
    """
    ids = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    measured = stored(spark, measure(ids, "doc_id"), "figures")
    verdicts = stored(spark, host_verdicts(host_rates(measured)), "hosts")
    return with_verdict(spark, measured, verdicts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    Texts are measured twice, for the hosts and for the verdicts, which is less than storing them.
    """
    verdicts = stored(spark, host_verdicts(host_rates(measure(docs))), "hosts")
    packed = docs.select(F.struct("*").alias("_row"), "text", "source")
    return with_verdict(spark, measure(packed, "_row"), verdicts).where("kept").select("_row.*")
