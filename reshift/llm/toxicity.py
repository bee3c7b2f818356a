"""Operator 7: toxicity by a factorization machine over hashed terms.

A document is the set of its distinct lower-case words and of their beginnings (``PREFIXES`` characters,
for inflected forms), hashed into ``BUCKETS`` terms. The score is
``sigmoid(b + sum_i w_i + sum_{i<j} <v_i, v_j>)`` over its terms: the second sum is how strongly pairs
of terms (an insult and a group, say) go beyond what each says alone. A term takes part if it says
something alone (its gradient at the start is at least half the penalty) or as a member of a pair: after
a first fit, the toxic documents beyond those expected are counted for every two terms that meet in ``MIN_DOCUMENTS``
toxic documents, whatever the terms say alone, and pairs beyond what chance gives so many of them start
a second fit with factors of their size. Proximal steps pull the weights of uninformative terms and the
factors that no pair needs to exactly zero, so that long documents do not add up noise.

The model is fitted on at most ``max_labelled`` labelled documents (smallest hashes of ``doc_id``)
outside the held-out remainder, as far as ``MAX_TERMS`` distinct terms of theirs go; that is the only
sample. It is fitted in one task, which holds the sample as one array of numbers, and only the weights that
are not zero reach the driver. Words are hashed JVM-side over whole texts; every document is scored.

Defined cases: a null or empty text has no terms and gets ``sigmoid(b)``; a null ``doc_id`` is neither
held out nor learnt from; repeated rows are scored each; without labels of both kinds every score is 0;
an empty table gives an empty result. Labels, language, source and ids are never inputs of a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import bind, free_name, shared_table

BUCKETS = 1 << 18
MAX_LABELLED = 8_000
MAX_TERMS = 16_000_000  # of all labelled documents together; 64 MB
MIN_DOCUMENTS = 5
FACTORS = 4
ROUNDS = 150
STEP = 0.05
# penalties for one labelled row; noise in a mean over n rows falls with the root of n, and so do they
SHRINK_TERMS = 0.15
SHRINK_FACTORS = 0.08
SCREEN = 0.5
START_FACTORS = 0.03
CHANCE_PAIRS = 10.0  # by chance among all pairs of terms that may pass, at most
MOST_PAIRS = 1_000
LARGEST_GAIN = 4.0  # in a pair's log-odds, at the start
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
PREFIXES = (6, 8)
WORD = r"[\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """The distinct hashed terms of a text, ascending."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))

    def bucket(*parts) -> Column:
        return F.xxhash64(*parts).bitwiseAND(F.lit(BUCKETS - 1)).cast("int")

    def beginning(k: int):
        return lambda x: bucket(F.substring(x, 1, k), F.lit(k))

    def hashed(w: Column) -> Column:
        begun = [F.transform(w, beginning(k)) for k in PREFIXES]
        return F.array_sort(F.array_distinct(F.concat(F.transform(w, lambda x: bucket(x)), *begun)))

    return bind(F.array_distinct(words), hashed)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


@dataclass(frozen=True)
class Machine:
    """Weights of the terms that matter: ``place[bucket]`` is a row of ``w`` and ``v``, or -1."""

    bias: float
    place: np.ndarray
    w: np.ndarray
    v: np.ndarray

    def margins(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Margin of each document; ``flat[starts[i]:starts[i + 1]]`` are the terms of document i."""
        at = self.place[flat]
        used = np.flatnonzero(at >= 0)
        at, doc = at[used], np.searchsorted(starts, used, "right") - 1
        n = len(starts) - 1
        out = self.bias + np.bincount(doc, self.w[at], n)
        for f in self.v.T:
            x = f[at]
            out += 0.5 * (np.bincount(doc, x, n) ** 2 - np.bincount(doc, x * x, n))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _flat(rows) -> tuple[np.ndarray, np.ndarray]:
    rows = [np.asarray(r, np.int32) for r in rows]
    starts = np.cumsum([0, *map(len, rows)])
    return (np.concatenate(rows) if rows else np.zeros(0, np.int32)), starts


def _adam(grad: np.ndarray, state: dict, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Adam's step and the step size of every coordinate."""
    state["t"] += 1
    state["m"] += 0.1 * (grad - state["m"])
    state["s"] += 0.01 * (grad * grad - state["s"])
    size = rate / (np.sqrt(state["s"] / (1 - 0.99 ** state["t"])) + 1e-3)
    return size * state["m"] / (1 - 0.9 ** state["t"]), size


def _by_term(at: np.ndarray, doc: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents of every term: those of term i are ``docs[starts[i]:starts[i + 1]]``."""
    return doc[np.argsort(at, kind="stable")], np.concatenate(([0], np.cumsum(np.bincount(at, minlength=m))))


def _excess(k: np.ndarray, expected: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Chernoff's exponent of ``k`` of ``n`` where ``expected`` are expected: chance has at most ``exp(-it)``."""
    p, q = k / n, np.clip(expected / n, 1e-9, 1 - 1e-9)
    return n * (p * np.log(np.maximum(p, 1e-300) / q) + (1 - p) * np.log(np.maximum(1 - p, 1e-300) / (1 - q)))


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    sizes = last - first
    ends = np.cumsum(sizes)
    return np.repeat(first - ends + sizes, sizes) + np.arange(sizes.sum())


def pairs_beyond(flat: np.ndarray, starts: np.ndarray, y: np.ndarray, p: np.ndarray) -> list[tuple[int, int, float]]:
    """Pairs of buckets whose documents are toxic more often than ``p`` says, with the gain in log-odds.

    Every pair that meets in ``MIN_DOCUMENTS`` toxic documents is looked at. Of pairs that mostly meet in the
    same documents (a word and its beginning) the strongest stands for all.
    """
    lengths = np.diff(starts)
    of_toxic = np.repeat(y > 0, lengths)
    buckets = np.flatnonzero(np.bincount(flat[of_toxic], minlength=BUCKETS) >= MIN_DOCUMENTS)
    m = len(buckets)
    number = np.full(BUCKETS, -1, np.int32)
    number[buckets] = np.arange(m)
    at = number[flat]
    doc = np.repeat(np.arange(len(y), dtype=np.int32), lengths)[at >= 0]
    toxic_at, at = at[of_toxic & (at >= 0)], at[at >= 0]
    docs, ends = _by_term(at, doc, m)
    toxic_doc = doc[y[doc] > 0]
    # where each term stands in its toxic documents, and where those end: what follows are its partners
    stands, toxic_ends = _by_term(toxic_at, np.arange(len(toxic_at), dtype=np.int32), m)
    stops = np.searchsorted(toxic_doc, toxic_doc[stands], "right")
    light = p[toxic_doc]
    first, second, strength, gains = [], [], [], []
    least = max(math.log(max(m * (m - 1) / 2, 1) / CHANCE_PAIRS), 1e-9)
    for i in range(m):
        some = slice(toxic_ends[i], toxic_ends[i + 1])
        met = _ranges(stands[some].astype(np.int64) + 1, stops[some])
        partners = toxic_at[met] - (i + 1)
        k = np.bincount(partners)
        j = np.flatnonzero(k >= MIN_DOCUMENTS)
        if not len(j):
            continue
        k = k[j]
        expected = np.bincount(partners, light[np.repeat(stands[some], stops[some] - stands[some] - 1)])[j]
        hope = k * np.log(k / np.maximum(expected, 1e-9)) >= least  # harmless documents only make it less
        j, k = j[hope] + i + 1, k[hope]
        if not len(j):
            continue
        mine = np.zeros(len(y), bool)
        mine[docs[ends[i]:ends[i + 1]]] = True
        theirs = docs[_ranges(ends[j], ends[j + 1])]
        pair = np.repeat(np.arange(len(j)), ends[j + 1] - ends[j])[mine[theirs]]
        theirs = theirs[mine[theirs]]
        meet, expected = np.bincount(pair, minlength=len(j)), np.bincount(pair, p[theirs], len(j))
        power = np.where(k > expected, _excess(k, expected, meet), 0.0)
        strong = power >= least
        if strong.any():
            j, k, expected, meet = j[strong], k[strong], expected[strong], meet[strong]
            gain = np.log((k + 0.5) / (meet - k + 0.5)) - np.log((expected + 0.5) / (meet - expected + 0.5))
            first.append(np.full(len(j), i))
            second.append(j)
            strength.append(power[strong])
            gains.append(np.clip(gain, 0.0, LARGEST_GAIN))
    if not first:
        return []
    first, second, strength, gains = map(np.concatenate, (first, second, strength, gains))
    out: list[tuple[int, int, float]] = []
    covered = np.zeros(len(y), bool)
    for x in np.argsort(-strength, kind="stable"):
        if len(out) == MOST_PAIRS:
            break
        a, b = first[x], second[x]
        both = np.intersect1d(docs[ends[a]:ends[a + 1]], docs[ends[b]:ends[b + 1]], assume_unique=True)
        if covered[both].mean() <= 0.5:
            covered[both] = True
            out.append((int(buckets[a]), int(buckets[b]), float(gains[x])))
    return out


def _start(m: int, pairs: list[tuple[int, int, float]], rng) -> np.ndarray:
    """Factors at the start: small ones, and for pairs (of row numbers) a direction that gives their gain."""
    v = rng.normal(0, START_FACTORS, (m, FACTORS))
    placed: set[int] = set()
    for a, b, gain in pairs:
        if b in placed:
            a, b = b, a
        if a not in placed:
            direction = rng.normal(size=FACTORS)
            v[a] = direction / np.linalg.norm(direction) * np.sqrt(abs(gain))
        if b not in placed:
            v[b] = v[a] * gain / max(v[a] @ v[a], 1e-12)
        placed |= {a, b}
    return v


def _descend(flat: np.ndarray, starts: np.ndarray, y: np.ndarray, seen: np.ndarray, pairs, seed: int) -> Machine:
    """Proximal steps for the buckets ``seen`` (ascending); ``pairs`` of buckets have factors at the start."""
    n, m = len(y), len(seen)
    place = np.full(BUCKETS, -1, np.int32)
    place[seen] = np.arange(m)
    at = place[flat]
    doc = np.repeat(np.arange(n, dtype=np.int32), np.diff(starts))[at >= 0]
    at = at[at >= 0]
    # the rows of one term together as well, for the sums of gradients by term
    term_docs, term_starts = _by_term(at, doc, m)
    term_starts = term_starts[:-1]
    rng = np.random.default_rng(seed)
    bias, w = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(m)
    v = _start(m, [(int(place[a]), int(place[b]), gain) for a, b, gain in pairs], rng)
    shrink = np.full((m, 1), SHRINK_FACTORS / np.sqrt(n))
    shrink[[place[bucket] for a, b, _ in pairs for bucket in (a, b)]] = 0  # these have been tested
    sw, sv = ({"m": np.zeros_like(z), "s": np.zeros_like(z), "t": 0} for z in (w, v))
    for turn in range(ROUNDS if m else 0):
        totals = np.zeros((n, FACTORS))
        squares = np.zeros(n)
        for f in range(FACTORS):
            x = v[at, f]
            totals[:, f] = np.bincount(doc, x, n)
            squares += np.bincount(doc, x * x, n)
        margin = bias + np.bincount(doc, w[at], n) + 0.5 * ((totals ** 2).sum(1) - squares)
        error = (_sigmoid(margin) - y) / n
        bias -= 2.0 * error.sum()
        e = error[term_docs]
        gw = np.add.reduceat(e, term_starts)
        gv = np.stack([np.add.reduceat(e * totals[term_docs, f], term_starts) for f in range(FACTORS)], 1) \
            - v * gw[:, None]
        rate = STEP * (1 - turn / ROUNDS)
        step, size = _adam(gw, sw, rate)
        w = w - step
        w = np.sign(w) * np.maximum(np.abs(w) - size * SHRINK_TERMS / np.sqrt(n), 0)
        step, size = _adam(gv, sv, rate)
        v = v - step
        norm = np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        v *= np.maximum(0, 1 - size.mean(axis=1, keepdims=True) * shrink / norm)
    kept = np.flatnonzero((w != 0) | np.any(v != 0, axis=1))
    place[:] = -1
    place[seen[kept]] = np.arange(len(kept))
    return Machine(bias, place, w[kept], v[kept])


def fit(rows, toxic: np.ndarray, seed: int = 7) -> Machine | None:
    """Fit a machine to documents given as term lists; None without labels of both kinds."""
    return fit_flat(*_flat(rows), np.asarray(toxic, np.float64), seed)


def fit_flat(flat: np.ndarray, starts: np.ndarray, y: np.ndarray, seed: int = 7) -> Machine | None:
    """Fit a machine to documents whose terms stand in a row, ``flat[starts[i]:starts[i + 1]]`` of document i."""
    if not 0 < y.sum() < len(y):
        return None
    n = len(y)
    frequency = np.bincount(flat, minlength=BUCKETS)
    start = np.abs(np.bincount(flat, np.repeat(y - y.mean(), np.diff(starts)), BUCKETS)) / n
    alone = ((frequency >= MIN_DOCUMENTS) & (frequency < n)
             & (start >= SCREEN * SHRINK_TERMS / np.sqrt(n)))
    machine = _descend(flat, starts, y, np.flatnonzero(alone), [], seed)
    pairs = pairs_beyond(flat, starts, y, _sigmoid(machine.margins(flat, starts)))
    if not pairs:
        return machine
    alone[[bucket for a, b, _ in pairs for bucket in (a, b)]] = True
    return _descend(flat, starts, y, np.flatnonzero(alone), pairs, seed)


MODEL = "bias double, buckets array<int>, w array<double>, v array<double>"


def _fit_rows(batches):
    """One machine from the sample's rows (terms, toxic), as a row of ``MODEL``; none without labels of both kinds."""
    flats, lengths, toxic = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0)]
    room = MAX_TERMS
    for batch in batches:
        terms_of, label = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
        n = np.diff(terms_of.offsets.to_numpy())
        fits = int(np.searchsorted(np.cumsum(n), room, "right"))
        flats.append(terms_of.slice(0, fits).flatten().to_numpy().copy())
        lengths.append(n[:fits].astype(np.int64))
        toxic.append(label[:fits].astype(np.float64))
        room = room - int(n[:fits].sum()) if fits == len(n) else 0
    flat, starts, y = np.concatenate(flats), np.concatenate(([0], np.cumsum(np.concatenate(lengths)))), np.concatenate(toxic)
    flats.clear()
    machine = fit_flat(flat, starts, y)
    if machine is None:
        return
    buckets = np.flatnonzero(machine.place >= 0).astype(np.int32)
    at = machine.place[buckets]
    yield pa.RecordBatch.from_pydict({
        "bias": pa.array([machine.bias]), "buckets": pa.array([buckets], pa.list_(pa.int32())),
        "w": pa.array([machine.w[at]], pa.list_(pa.float64())), "v": pa.array([machine.v[at].ravel()], pa.list_(pa.float64()))})


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Machine | None:
    """Fit on a bounded sample of the labelled documents that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    sample = shared_table(known.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").alias("toxic"))
                          .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(max_labelled))
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id"))
            .select("doc_id", terms(F.col("text")).alias("terms"), F.col("toxic").cast("int").alias("toxic")))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.size("terms"), F.xxhash64("terms")]
    fitted = (shared_table(rows).repartition(1).sortWithinPartitions(*order).select("terms", "toxic")
              .mapInArrow(_fit_rows, MODEL)).collect()
    if not fitted:
        return None
    found = fitted[0]
    buckets = np.array(found["buckets"], np.int64)
    place = np.full(BUCKETS, -1, np.int32)
    place[buckets] = np.arange(len(buckets))
    return Machine(found["bias"], place, np.array(found["w"]), np.array(found["v"]).reshape(len(buckets), FACTORS))


def score(text: Column, machine: Machine | None) -> Column:
    """Score of a text, 0 to 1."""
    if machine is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def scored(found: pd.Series) -> pd.Series:
        flat, starts = _flat(found)
        return pd.Series(_sigmoid(machine.margins(flat, starts)))

    return scored(terms(text))


def judge(docs: DataFrame, labels: DataFrame, into: str = "toxicity", max_labelled: int = MAX_LABELLED,
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with a struct column ``into``: ``held_out``, ``score`` and ``predicted``."""
    machine = train(docs, labels, max_labelled)
    name = free_name(docs, "toxic_score")
    out = docs.withColumn(name, score(F.col("text"), machine))
    verdict = F.struct(held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"),
                       (F.col(name) >= threshold).cast("int").alias("predicted"))
    return out.withColumn(into, verdict).drop(name)


def keep_harmless(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    verdict = free_name(docs, "toxicity_verdict")
    return judge(docs, labels, into=verdict).where(F.col(f"{verdict}.predicted") == 0).drop(verdict)
