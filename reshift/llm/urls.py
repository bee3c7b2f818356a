"""Operator 4: URL filter by rules, and by a character language-model ratio where no rule fits.

Rules name a host and a path prefix; the longest rule that fits decides. The URLs that rules decide are
the training set of two variable-order Markov models over the characters (UTF-8 bytes) of host and path,
one of accepted and one of rejected URLs: contexts of 0 to ``ORDER`` characters, each order smoothed by
the next shorter one. A URL's score is the log-likelihood difference per character, end mark
included; it is accepted if the score reaches a threshold calibrated on a fifth of the training URLs
(by hash) that the models do not see: the one with the best balanced accuracy, the nearest to 0 if several.

Counts cover every URL that a rule decides, and each context and each context with its next character has
its own count under an exact key, so the model grows with the distinct contexts of the corpus. It is a table.
Only while it has at most ``MOST_KEYS`` rows is it collected and sent to the tasks. Beyond that URLs are
scored by joins: the distinct grams of all texts are given their probabilities order by order, each from its
own counts and those of the next shorter order (a gram, a context and a shorter gram each meet at most 257
rows), and a text's score is the mean over its grams. Both ways give the same scores.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and is judged by
the models as an empty string; without training URLs of both kinds every score is 0 and the threshold 0
(allow); repeated rows are judged each and count each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import free_name, shared_table, slices, string_bytes

ALLOW, BLOCK = "allow", "block"
ORDER = 5
SYMBOL_BITS, BEFORE_START, NO_SYMBOL = 9, 257, 511  # bytes are 1 to 256, the end mark is 0
SMOOTHING = 4.0
CALIBRATION_FOLDS = 5
BINS, WIDTH = 2001, 0.01  # threshold candidates from -10 to 10
MOST_KEYS = 1_000_000  # of a model that is sent to tasks: 24 MB


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    below = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
    return below & F.startswith(path, F.lit(rule.path))


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits; null fields without one."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    none = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return reduce(
        lambda rest, r: F.when(_fits(r, host, path),
                               F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(rest),
        reversed(ordered), none)


def exact_transitions(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, context, gram)`` of every character and the end mark; the last two have a line per order.

    Contexts do not reach past the start of a row. A key has three bits for the order and nine for each of up
    to five symbols of context and the next one.
    """
    data, bounds = string_bytes(column)
    n_rows = len(bounds) - 1
    row = np.repeat(np.arange(n_rows), np.diff(bounds) + 1)  # one more place for the end mark
    starts = bounds[:-1] + np.arange(n_rows)
    symbol = np.zeros(len(row), np.int64)
    inside = np.ones(len(row), bool)
    inside[bounds[1:] + np.arange(n_rows)] = False
    symbol[inside] = data.astype(np.int64) + 1
    place = np.arange(len(row)) - starts[row]
    contexts = np.zeros((ORDER + 1, len(row)), np.int64)
    grams = np.zeros_like(contexts)
    context = np.zeros(len(row), np.int64)
    for k in range(ORDER + 1):
        if k:
            before = np.concatenate((np.zeros(k, np.int64), symbol))[:len(row)]
            context = (context << SYMBOL_BITS) | np.where(place >= k, before, BEFORE_START)
        key = (k << SYMBOL_BITS * (ORDER + 1)) | (context << SYMBOL_BITS)
        contexts[k], grams[k] = key | NO_SYMBOL, key | symbol
    return row, contexts, grams


@dataclass(frozen=True)
class Models:
    """Counts of both models: ``tables[0]`` of rejected, ``tables[1]`` of accepted URLs.

    Column i counts the exact key ``keys[i]`` (ascending), and one more column at the end is 0 for keys that
    do not occur.
    """

    tables: np.ndarray
    keys: np.ndarray

    def _entries(self, wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, wanted)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == wanted[known]
        return np.where(known, at, len(self.keys))

    def scores(self, column: pa.Array) -> np.ndarray:
        row, *found = exact_transitions(column)
        contexts, grams = map(self._entries, found)
        logs = []
        for table in self.tables:
            p = np.full(len(row), 1 / 257)
            for c, g in zip(contexts, grams):
                p = (table[g] + SMOOTHING * p) / (table[c] + SMOOTHING)
            logs.append(np.log(p))
        n = len(column)
        return np.bincount(row, logs[1] - logs[0], n) / np.bincount(row, minlength=n)


def _count_transitions(batches):
    for some_urls in (s for batch in batches for s in slices(batch, 0)):
        row, contexts, grams = exact_transitions(some_urls.column(0))
        keys, entry = np.unique(np.concatenate((contexts, grams)).reshape(-1), return_inverse=True)
        accepted = np.tile(np.array(some_urls.column(1).to_pylist(), bool)[row], 2 * (ORDER + 1))
        both = np.bincount(entry, minlength=len(keys))
        good = np.bincount(entry[accepted], minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, both - good, good)],
                                         names=["key", "rejected", "accepted"])


def _sent(models: Models, text: Column) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        parts = [models.scores(some.column(0)) for some in slices(batch, 0)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return run(text)


def _text_grams(batches):
    """The longest gram of every character of a text, with the text's hashes."""
    for some in (s for batch in batches for s in slices(batch, 0)):
        row, _, grams = exact_transitions(some.column(0))
        hashes = (some.column(c).to_numpy()[row] for c in (1, 2))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*hashes, grams[ORDER])], names=["h1", "h2", "gram"])


def _shorter(gram: Column, order: int, k: int) -> Column:
    """The key of order ``k`` in a gram of a higher order; the symbol next to the character stands highest."""
    symbol = F.lit((1 << SYMBOL_BITS) - 1)
    context = F.shiftright(gram.bitwiseAND(F.lit((1 << SYMBOL_BITS * (order + 1)) - 1)), SYMBOL_BITS * (1 + order - k))
    key = F.shiftleft(context, SYMBOL_BITS).bitwiseOR(gram.bitwiseAND(symbol))
    return key.bitwiseOR(F.lit(k << SYMBOL_BITS * (ORDER + 1)))


def _probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``(gram, difference)``: the log-likelihood difference of every distinct longest gram."""
    symbol = (1 << SYMBOL_BITS) - 1
    named = {kind: counts.select(F.col("key").alias(kind), *[F.col(c).alias(f"{kind}_{c}") for c in ("rejected", "accepted")])
             for kind in ("gram", "context")}
    before = None
    for k in range(ORDER + 1):
        rows = grams.select(_shorter(F.col("gram"), ORDER, k).alias("gram")).distinct()
        rows = (rows.withColumn("context", F.col("gram").bitwiseOR(F.lit(symbol)))
                .join(named["gram"], "gram", "left").join(named["context"], "context", "left"))
        if before is None:
            rows = rows.withColumns({"p_rejected": F.lit(1 / 257), "p_accepted": F.lit(1 / 257)})
        else:
            rows = rows.withColumn("shorter", _shorter(F.col("gram"), k, k - 1)).join(before, "shorter")
        p = {f"p_{c}": (F.coalesce(f"gram_{c}", F.lit(0)) + SMOOTHING * F.col(f"p_{c}"))
             / (F.coalesce(f"context_{c}", F.lit(0)) + SMOOTHING) for c in ("rejected", "accepted")}
        level = rows.withColumns(p)
        before = level.select(F.col("gram").alias("shorter"), *p)
    return level.select("gram", (F.log("p_accepted") - F.log("p_rejected")).alias("difference"))


def _joined(rows: DataFrame, text: Column, counts: DataFrame, into: str) -> DataFrame:
    """``rows`` with the score of ``text``, computed by joins with the table of counts."""
    one, two = free_name(rows, "url_h1"), free_name(rows, "url_h2")
    hashed = rows.withColumns({one: F.xxhash64(text), two: F.xxhash64(F.lit(1), text)})
    texts = hashed.select(text.alias("text"), F.col(one).alias("h1"), F.col(two).alias("h2")).distinct()
    held = shared_table(texts.mapInArrow(_text_grams, "h1 long, h2 long, gram long"))
    known = shared_table(_probabilities(held, counts))
    scores = held.join(known, "gram").groupBy("h1", "h2").agg(F.avg("difference").alias(into))
    return (hashed.join(scores.select(F.col("h1").alias(one), F.col("h2").alias(two), into), [one, two])
            .select(*rows.columns, into))


def with_score(rows: DataFrame, text: Column, model: Models | DataFrame | None, into: str) -> DataFrame:
    """``rows`` with the score of ``text`` as ``into``, by a model that is sent or by its table of counts."""
    if model is None:
        return rows.withColumn(into, F.lit(0.0))
    if isinstance(model, Models):
        return rows.withColumn(into, _sent(model, text))
    return _joined(rows, text, model, into)


def train(decided: DataFrame, most_keys: int = MOST_KEYS) -> tuple[Models | DataFrame | None, float]:
    """Model and threshold from ``(text, accepted)``; None and 0 without URLs of both kinds."""
    fold = F.pmod(F.xxhash64("text"), F.lit(CALIBRATION_FOLDS))
    seen = decided.where(fold != 0).mapInArrow(_count_transitions, "key long, rejected long, accepted long")
    counts = shared_table(seen.groupBy("key").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")))
    size = counts.agg(F.count(F.lit(1)).alias("keys"), F.max("rejected").alias("rejected"), F.max("accepted").alias("accepted")).first()
    if not size["rejected"] or not size["accepted"]:
        return None, 0.0
    models = counts
    if size["keys"] <= most_keys:
        sent = counts.toArrow()
        keys, *tables = (sent.column(name).to_numpy() for name in ("key", "rejected", "accepted"))
        order = np.argsort(keys)
        models = Models(np.stack([np.append(table[order], 0) for table in tables]).astype(np.float64), keys[order])
    unseen = with_score(decided.where(fold == 0), F.col("text"), models, "score")
    bins = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(F.col("score") / WIDTH) + BINS // 2)).cast("int")
    histogram = np.zeros((2, BINS + 1))
    for r in unseen.groupBy("accepted", bins.alias("bin")).count().collect():  # at most 2 * BINS rows
        histogram[int(r["accepted"]), r["bin"] + 1] = r["count"]
    if not histogram.any(axis=1).all():
        return models, 0.0
    below = np.cumsum(histogram, axis=1) / histogram.sum(axis=1, keepdims=True)
    good = below[0] - below[1]  # rejected below the edge, less accepted below it
    edges = (np.arange(BINS + 1) - BINS // 2) * WIDTH
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return models, float(edges[best[np.argmin(np.abs(edges[best]))]])


def judge(pages: DataFrame, rules=RULES, into: str = "url_verdict", most_keys: int = MOST_KEYS) -> DataFrame:
    """``pages`` with a struct column ``into``: host, path, rule, score, verdict (allow or block)."""
    url = F.col("url").cast("string")
    parts, found, score = (free_name(pages, n) for n in ("url_parts", "url_rule", "url_score"))
    out = pages.withColumn(parts, F.struct(host_of(url).alias("host"), path_of(url).alias("path")))
    out = out.withColumn(found, longest_rule(F.col(f"{parts}.host"), F.col(f"{parts}.path"), rules))
    text = F.concat(F.col(f"{parts}.host"), F.col(f"{parts}.path"))
    models, threshold = train(out.where(F.col(f"{found}.rule").isNotNull()).select(
        text.alias("text"), (F.col(f"{found}.verdict") == ALLOW).alias("accepted")), most_keys)
    out = with_score(out, text, models, score)
    by_model = F.when(F.col(score) >= threshold, F.lit(ALLOW)).otherwise(F.lit(BLOCK))
    verdict = F.struct(F.col(f"{parts}.host").alias("host"), F.col(f"{parts}.path").alias("path"),
                       F.col(f"{found}.rule").alias("rule"), F.col(score).alias("score"),
                       F.coalesce(F.col(f"{found}.verdict"), by_model).alias("verdict"))
    return out.withColumn(into, verdict).drop(parts, found, score)
