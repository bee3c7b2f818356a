"""Operator 3: quality rules, with DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated eight-word windows of the whole text.
The method's verdict is a hashed n-gram log-likelihood ratio: tokens (runs of letters and digits, runs
of other characters) and their bigrams fall into ``BUCKETS`` buckets; one multinomial is counted on
trusted documents, one on all documents. A document's score is the mean over its n-grams of
``ln p_trusted - ln p_raw``; it is kept if the score reaches a threshold, halfway between the mean
scores of the trusted and of the rejected labelled documents.

The raw multinomial covers every document, the trusted one and the threshold every labelled document:
texts meet their labels once, in a shuffled join. A class's mean score is linear in the weights, so the
same pass adds up, by bucket and class, the shares of their documents that n-grams make up, in units of
``1 / SHARES``. Counts and shares are whole numbers and a score adds up inside one row: results do not
depend on partitioning. The model, ``BUCKETS`` weights and one threshold, is a constant of the scoring
expression; nothing else passes the driver.

Defined cases: a null or empty text has no words and fails the base rules; a null ``doc_id`` is judged
like any other; repeated rows are judged each; without trusted or without rejected labels the threshold
is ``DEFAULT_THRESHOLD``; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import SPACE, bind, free_name

BUCKETS = 1 << 14
SMOOTHING = 1.0
SHARES = 1 << 36  # a class of 2**27 documents fits a long even if all have the same single n-gram
DEFAULT_THRESHOLD = -0.5
SYMBOL = "[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8  # a power of two
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside ``WINDOW``-word windows that occur twice or more in the text."""
    def covered(at: Column) -> Column:
        # ``at``: sorted starts of repeated windows; each covers up to the next start
        after = F.concat(F.slice(at, 2, F.size(at)), F.array(F.element_at(at, -1) + WINDOW))
        steps = F.zip_with(at, after, lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda s, n: s + n)

    def twice(sorted_windows: Column) -> Column:
        # neighbours with the same hash; ``get`` is null beyond either end
        hits = F.filter(sorted_windows, lambda x, k: (
            (F.get(sorted_windows, k - 1)["h"] == x["h"]) | (F.get(sorted_windows, k + 1)["h"] == x["h"])))
        return bind(F.sort_array(hits["i"]), covered)

    def located(hashes: Column) -> Column:
        return bind(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), twice)

    def counted(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(located(hashes))

    def joined(values: Column, width: int) -> Column:
        # words or hashes of ``width`` words at every start -> hashes of twice as many, padded with nulls at the end
        return bind(values, lambda v: F.zip_with(
            v, F.slice(v, width + 1, F.size(v)), lambda a, b: F.xxhash64(a, b)))

    def windows(w: Column) -> Column:
        hashes, width = w, 1
        while width < WINDOW:
            hashes, width = joined(hashes, width), 2 * width
        whole = bind(hashes, lambda h: F.slice(h, 1, F.size(h) - (WINDOW - 1)))
        return bind(whole, counted)

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(windows(words))


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def base_counts(text: Column) -> Column:
    """The base rules' counts of a text that is not null, as a struct."""
    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x)).cast("long").alias("word_chars"),
            (F.size(F.split(text, SYMBOL)) - 1).cast("long").alias("n_symbols"),
            repeated_lines(text).cast("long").alias("n_dup_lines"),
            repeated_words(w).cast("long").alias("n_repeat_words"))

    return bind(words_of(text), counts)


def ngram_buckets(text: Column) -> Column:
    """Buckets of the text's tokens and of their bigrams, one entry per occurrence."""
    def bucket(*parts: Column) -> Column:
        return F.xxhash64(*parts).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")

    def both(tokens: Column) -> Column:
        bigrams = F.zip_with(F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
                             F.slice(tokens, 2, F.size(tokens)), lambda a, b: bucket(a, b))
        return F.concat(F.transform(tokens, lambda t: bucket(t)), bigrams)

    return bind(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), both)


def labelled(labels: DataFrame) -> DataFrame:
    """``(key, quality)`` of every labelled document."""
    return (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy(F.struct(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("spread")).alias("key"))
            .agg(F.min("quality").alias("quality")))


def count_grams(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(bucket, class, n, shares)``: n-grams by class (1 trusted, 0 rejected, null neither) and the sums of
    their shares of a document; bucket ``BUCKETS`` counts the documents themselves."""
    # documents without an id have no label; their texts spread them over the tasks
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    texts = docs.select(F.struct(F.col("doc_id").alias("id"), spread.alias("spread")).alias("key"), "text")
    rows = texts.join(labelled(labels).hint("shuffle_hash"), "key", "left").select(
        F.when(F.col("quality").isin(0, 1), F.col("quality")).alias("class"),
        ngram_buckets(F.col("text")).alias("grams"))
    share = F.when(F.size("grams") > 0, F.round(SHARES / F.size("grams"))).otherwise(0).cast("long")
    # a step of its own: beside ``explode`` the share would be computed for every n-gram
    return (rows.select("class", share.alias("share"), "grams")
            .select("class", "share", F.explode(F.concat("grams", F.array(F.lit(BUCKETS)))).alias("bucket"))
            .groupBy("bucket", "class").agg(F.count("*").alias("n"), F.sum("share").alias("shares")))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Column, float]:
    """The log ratio of every bucket as a constant array, and the threshold."""
    raw, trusted, members = [0] * BUCKETS, [0] * BUCKETS, {}
    shares = {0: [0] * BUCKETS, 1: [0] * BUCKETS}
    for bucket, of, n, share in count_grams(docs, labels).collect():  # at most 3 * (BUCKETS + 1) rows
        if bucket == BUCKETS:
            members[of] = n
            continue
        raw[bucket] += n
        if of is not None:
            shares[of][bucket] = share
        if of == 1:
            trusted[bucket] = n

    def logs(n: list[int]) -> list[float]:
        total = sum(n) + SMOOTHING * BUCKETS
        return [math.log((x + SMOOTHING) / total) for x in n]

    ratios = [f"{t - r:.9g}" for t, r in zip(logs(trusted), logs(raw))]
    threshold = DEFAULT_THRESHOLD
    if {0, 1} <= members.keys():
        means = [sum(float(w) * x for w, x in zip(ratios, shares[of])) / SHARES / members[of] for of in (0, 1)]
        threshold = sum(means) / 2
    return F.split(F.lit(",".join(ratios)), ",").cast("array<double>"), threshold


def mean_ratio(text: Column, w: Column) -> Column:
    """Mean log ratio over the n-grams of a text; 0 without any."""
    return bind(ngram_buckets(text), lambda grams: F.when(F.size(grams) == 0, F.lit(0.0)).otherwise(
        F.aggregate(grams, F.lit(0.0), lambda s, g: s + F.get(w, g)) / F.size(grams)))


def judge(docs: DataFrame, labels: DataFrame, into: str = "quality") -> DataFrame:
    """``docs`` with a struct column ``into``: the base counts, ``base_failed``, ``score`` and ``kept``."""
    w, threshold = fit(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), labels)
    text = F.coalesce(docs["text"], F.lit(""))
    counts, score = free_name(docs, "counts"), free_name(docs, "ratio")
    out = docs.select("*", base_counts(text).alias(counts),
                      mean_ratio(text, w).alias(score))
    failed = (F.col(f"{counts}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{counts}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{counts}.n_words"))
    verdict = F.struct(f"{counts}.*", failed.alias("base_failed"), F.col(score).alias("score"),
                       (~failed & (F.col(score) >= threshold)).alias("kept"))
    return out.withColumn(into, verdict).drop(counts, score)


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    verdict = free_name(docs, "quality_verdict")
    return judge(docs, labels, into=verdict).where(F.col(f"{verdict}.kept")).drop(verdict)
