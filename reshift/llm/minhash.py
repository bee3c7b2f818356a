"""Operator 1: near-duplicate documents by improved consistent weighted sampling.

A document is its multiset of five-word shingles (a shorter text is one shingle). A shingle weighs its
count in the document times the mean inverse document frequency of its words; frequencies are counted
over all documents, in ``IDF_BUCKETS`` hashed words, so that the table has one size for every corpus.
``BANDS * ROWS`` consistent weighted samples (Ioffe) are drawn per document; two documents share a
sample with a probability equal to their weighted Jaccard similarity. Documents that agree on a whole
band are candidates, and a candidate is a link only if the exact weighted Jaccard similarity of the whole
texts is at least ``SIMILARITY``. A pair of exactly that similarity becomes a candidate with a
probability of 1 - (1 - 0.8**5)**20 = 0.9996.

Candidates without all pairs. Copies of one text are one representative. In every bucket of a band each
member is first compared with the bucket's leader, its smallest id; that joins most groups of thousands
with a comparison per member. Pairs of a bucket whose classes still differ are then compared inside one
task each: buckets come in blocks of at most ``BLOCK`` members (a pair of blocks is a task's unit, small
buckets share a unit), a pair is looked at in the first band that it shares, and of the samples at least
``SAMPLES_ALIKE`` must agree before the exact similarity is computed (a link at the threshold has that
many with a probability of 1 - 3e-7). Units return at most one link per pair of classes, never their
pairs, so no link that joins classes is lost and no group meets in one task.

Defined cases: words are cut at ASCII white space and folded to lower case for A-Z; null and empty texts
have no shingle and link with nothing, not even with each other. Every row is a document of its own, under
a key that is written with it: of a class one row is kept, that of the smallest ``doc_id`` (nulls last,
among equal ids any one row), whose id names the class; a class of rows without id has none. An empty
table gives an empty result; other columns pass through ``keep_first`` and are not read elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import components, free_name, shared_table, slices, string_bytes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 5
IDF_BUCKETS = 1 << 16
SAMPLES_ALIKE = 60
BLOCK = 512
ROWS_A_UNIT = 2000
PAIRS_A_STEP = 8192
SHINGLES_A_STEP = 1 << 19  # of both sides of the pairs that are compared at a time
# ids sent to every task at most (8 bytes each); more are joined by a shuffle
MAX_SENT_IDS = 1_000_000
CHUNK = 1 << 16

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and where each document's words begin (one more entry than rows)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, _U), np.zeros(len(bounds), np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(_U)
    opens = ~blank
    opens[1:] &= blank[:-1]
    rows = bounds[:-1][np.diff(bounds) > 0]
    opens[rows] = ~blank[rows]  # a document's first byte opens a word whatever stands before it
    start = np.flatnonzero(opens)
    shut = blank.copy()
    shut[rows[rows > 0]] |= True
    stops = np.append(np.flatnonzero(shut), n)
    end = stops[np.searchsorted(stops, start, "right")]
    # polynomial hash of each word: position inside the word picks the power
    own = np.zeros(n, np.int64)
    own[start] = np.diff(np.concatenate(([0], start)))
    inside = np.arange(n) - np.cumsum(own)
    powers = np.cumprod(np.full(int((end - start).max(initial=1)) + 1, _ODD, _U))
    value = (low + _U(1)) * powers[np.clip(inside, 0, len(powers) - 1)]
    total = np.concatenate((np.zeros(1, _U), np.cumsum(value, dtype=_U)))
    hashed = _mix(total[end] - total[start] + (end - start).astype(_U))
    return hashed, np.searchsorted(start, bounds)


def weighted_shingles(column: pa.Array, idf: np.ndarray):
    """``(key, weight, starts)``: per row the sorted distinct shingles with their weights.

    A key holds the row in its upper 16 bits and 48 bits of the shingle's hash.
    """
    data, bounds = string_bytes(column)
    words, at = word_hashes(data, bounds)
    n_rows, counts = len(at) - 1, np.diff(at)
    weight = idf[(words & _U(len(idf) - 1)).astype(np.int64)].astype(np.float32)
    row = np.repeat(np.arange(n_rows), np.maximum(counts - SHINGLE + 1, (counts > 0).astype(np.int64)))
    first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n_rows))))
    pos = at[row] + np.arange(len(row)) - first[row]
    size = np.minimum(counts[row], SHINGLE)
    hashed, heavy = np.zeros(len(row), _U), np.zeros(len(row), np.float32)
    short = bool((size < SHINGLE).any())
    for j in range(SHINGLE):
        there = np.minimum(pos + j, max(len(words) - 1, 0))
        term, w = words[there], weight[there]
        if short:
            use = size > j
            term, w = np.where(use, term, _U(0)), np.where(use, w, np.float32(0))
        hashed = hashed * _ODD + (term ^ (term >> _U(29)))
        heavy += w
    heavy /= size
    key = (row.astype(_U) << _U(48)) | (_mix(hashed) >> _U(16))
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(key))).astype(np.float32)
    key = key[new]
    starts = np.searchsorted(key, np.arange(n_rows + 1, dtype=np.int64).astype(_U) << _U(48))
    return key, heavy[order][new] * times, starts


def shingles_of(texts: pa.Array, idf: np.ndarray):
    """``weighted_shingles`` of texts of any total length, a bounded part of them at a time."""
    keys, weights, starts, rows, total = [], [], [np.zeros(1, np.int64)], 0, 0
    for some in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
        key, weight, at = weighted_shingles(some.column(0), idf)
        keys.append(key + (_U(rows) << _U(48)))
        weights.append(weight)
        starts.append(at[1:] + total)
        rows, total = rows + some.num_rows, total + len(key)
    return (np.concatenate(keys) if keys else np.zeros(0, _U), np.concatenate(weights) if weights else np.zeros(0, np.float32),
            np.concatenate(starts))


class Sampler:
    """Consistent weighted samples. The random variates of a (shingle, sample) come from a table."""

    def __init__(self, samples: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = 1 << 16
        self.r = rng.gamma(2.0, 1.0, size).astype(np.float32)
        self.inverse = (1 / self.r).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32)
        self.beta = rng.random(size, np.float32)
        self.factors = rng.integers(0, 1 << 63, samples, np.uint64) * _U(2) + _U(1)

    def samples(self, key: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``(samples, rows)``; rows without a shingle get 0."""
        out = np.zeros((len(self.factors), len(starts) - 1), _U)
        full = np.flatnonzero(np.diff(starts))
        i = 0
        while i < len(full):
            j = int(np.searchsorted(starts[full], starts[full[i]] + CHUNK, "left"))
            rows = full[i:max(j, i + 1)]
            a, b = starts[rows[0]], starts[rows[-1] + 1]
            h = _mix(key[a:b] & _U((1 << 48) - 1))
            low = h.astype(np.uint32)
            log_w, cuts = np.log(weight[a:b]), starts[rows] - a
            for k, factor in enumerate(self.factors):
                pick = ((h * factor) >> _U(48)).astype(np.int64)
                beta, r = self.beta[pick], self.r[pick]
                t = np.floor(log_w * self.inverse[pick] + beta)
                log_a = self.log_c[pick] - r * (t - beta + np.float32(1))
                rank = (log_a + np.float32(256)).view(np.uint32).astype(_U) << _U(32)
                mark = low ^ (t.astype(np.int32).view(np.uint32) * np.uint32(0x85EBCA6B))
                out[k, rows] = np.minimum.reduceat(rank | mark, cuts)
            i += len(rows)
        return out


def _count_words():
    def run(batches):
        total = np.zeros(IDF_BUCKETS, np.int64)
        n = 0
        for some in (s for batch in batches for s in slices(batch, 0)):
            data, bounds = string_bytes(some.column(0))
            words, at = word_hashes(data, bounds)
            row = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
            n += int((np.diff(at) > 0).sum())
            seen = np.sort((row << 16) | (words & _U(IDF_BUCKETS - 1)).astype(np.int64))
            seen = seen[np.concatenate(([True], seen[1:] != seen[:-1]))] if len(seen) else seen
            total += np.bincount(seen & (IDF_BUCKETS - 1), minlength=IDF_BUCKETS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1), pa.int32()), pa.array(np.append(total[found], n), pa.int64())],
            names=["bucket", "n"])

    return run


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """``ln(1 + documents / documents with the word)`` of every bucket (``IDF_BUCKETS`` rows at most)."""
    counted = docs.select("text").mapInArrow(_count_words(), "bucket int, n long")
    rows = {r["bucket"]: r["n"] for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    frequency = np.ones(IDF_BUCKETS)
    for bucket, n in rows.items():
        if bucket >= 0:
            frequency[bucket] = n
    return np.log1p(max(rows.get(-1, 0), 1) / frequency)


def _sketch(idf: np.ndarray):
    def run(batches):
        sampler = Sampler(BANDS * ROWS)
        for batch in batches:
            for some in slices(batch, 2):
                key, weight, starts = weighted_shingles(some.column(2), idf)
                drawn = sampler.samples(key, weight, starts).reshape(BANDS, ROWS, -1)
                bands = np.zeros((BANDS, drawn.shape[2]), _U)
                for r in range(ROWS):
                    bands = _mix(bands * _ODD + drawn[:, r] + _U(r + 1))
                full = np.flatnonzero(np.diff(starts))
                flat = pa.array(np.ascontiguousarray(bands.T[full]).reshape(-1).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * BANDS, pa.int32()), flat)
                rows = pa.array(full)
                marks = np.ascontiguousarray(drawn.reshape(BANDS * ROWS, -1).T[full].astype("<u4"))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(rows), some.column(1).take(rows), lists,
                     pa.array([m.tobytes() for m in marks], pa.binary())], names=["id", "same", "bands", "marks"])

    return run


def similarities(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity, row by row."""
    key_a, weight_a, starts = weighted_shingles(left, idf)
    key_b, weight_b, starts_b = weighted_shingles(right, idf)
    n = len(starts) - 1

    def sums(key, weight):
        return np.bincount((key >> _U(48)).astype(np.int64), weight, n)

    total = sums(key_a, weight_a) + sums(key_b, weight_b)
    shared, ia, ib = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
    both = sums(shared, np.minimum(weight_a[ia], weight_b[ib]))
    return np.divide(both, total - both, out=np.zeros(n), where=total > 0)


def _verify(idf: np.ndarray, least: float):
    def run(batches):
        for batch in batches:
            for some in slices(batch, 2, 3):
                ok = pa.array(similarities(some.column(2), some.column(3), idf) >= least - 1e-9)
                yield some.select([0, 1]).filter(ok)

    return run


def among(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is (``left_semi``) or is not (``left_anti``) an ``id``.

    The ids are sent to every task if there are at most ``MAX_SENT_IDS``, so that texts stay where they
    are; else both sides are shuffled.
    """
    few = ids.limit(MAX_SENT_IDS + 1).count() <= MAX_SENT_IDS
    return docs.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("id"), how)


def _links(pairs: DataFrame, docs: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """The pairs ``(a, b)`` of representatives, a written table, that are similar enough."""
    ids = shared_table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    texts = shared_table(among(docs, ids, "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return shared_table(joined.mapInArrow(_verify(idf, least), "a long, b long"))


def _pairs_inside(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of one bucket, for rows sorted by bucket."""
    n = len(bucket)
    last = np.searchsorted(bucket, bucket, "right")
    after = last - np.arange(n) - 1
    left = np.repeat(np.arange(n), after)
    nth = np.arange(len(left)) - np.repeat(np.cumsum(after) - after, after)
    return left, left + 1 + nth


def pair_similarities(key, weight, starts, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of pairs of rows of ``weighted_shingles``."""
    shingle = np.unique(key & _U((1 << 48) - 1), return_inverse=True)[1].astype(np.int64)
    sizes = np.diff(starts)
    total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weight, len(sizes))
    out = np.zeros(len(left))

    def entries(rows):
        n = sizes[rows]
        at = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return (np.repeat(np.arange(len(rows)), n) << 32) | shingle[at], weight[at]

    ends = np.cumsum(sizes[left] + sizes[right])
    cut = 0
    while cut < len(left):
        before = ends[cut - 1] if cut else 0
        stop = max(int(np.searchsorted(ends, before + SHINGLES_A_STEP, "right")), cut + 1)
        a, b = left[cut:stop], right[cut:stop]
        (key_a, w_a), (key_b, w_b) = entries(a), entries(b)
        shared, ia, ib = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
        both = np.bincount(shared >> 32, np.minimum(w_a[ia], w_b[ib]), len(a))
        out[cut:stop] = both / (total[a] + total[b] - both)
        cut = stop
    return out


def _resolve(idf: np.ndarray, least: float):
    names = ("band", "bucket", "block", "low", "high", "rep", "class")

    def run(unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks().sort_by([("band", "ascending"), ("bucket", "ascending"), ("rep", "ascending")])
        band, bucket, block, low, high, rep, group = (unit[c].to_numpy() for c in names)
        if low[0] == high[0]:
            runs = np.concatenate(([0], np.cumsum((band[1:] != band[:-1]) | (bucket[1:] != bucket[:-1]))))
            left, right = _pairs_inside(runs)
        else:
            one, two = np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])
            left, right = np.repeat(one, len(two)), np.tile(two, len(one))
        apart = group[left] != group[right]
        left, right = left[apart], right[apart]
        bands = np.array(unit["bands"].to_pylist(), np.int64)
        marks = np.frombuffer(b"".join(unit["marks"].to_pylist()), "<u4").reshape(unit.num_rows, -1)
        likely = np.zeros(len(left), bool)
        for cut in range(0, len(left), PAIRS_A_STEP):
            a, b = left[cut:cut + PAIRS_A_STEP], right[cut:cut + PAIRS_A_STEP]
            first = np.argmax(bands[a] == bands[b], axis=1) == band[a]
            likely[cut:cut + len(a)] = first & ((marks[a] == marks[b]).sum(axis=1) >= SAMPLES_ALIKE)
        left, right = left[likely], right[likely]
        if len(left):
            used, at = np.unique(np.concatenate((left, right)), return_inverse=True)
            texts = unit["text"].combine_chunks().take(pa.array(used))
            alike = pair_similarities(*shingles_of(texts, idf), at[:len(left)], at[len(left):]) >= least - 1e-9
            left, right = left[alike], right[alike]
        classes_joined = np.sort(np.stack((group[left], group[right]), axis=1), axis=1)
        one_each = np.unique(classes_joined, axis=0, return_index=True)[1]
        a, b = rep[left[one_each]], rep[right[one_each]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links_between(rows: DataFrame, copies: DataFrame, docs: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """Links between members ``(band, bucket, rep, class)`` of one bucket whose classes differ."""
    sizes = rows.groupBy("band", "bucket").agg(
        F.min("class").alias("first"), F.max("class").alias("last"), F.count("*").alias("n"))
    mixed = sizes.where("first < last").select("band", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    mixed = shared_table(rows.join(mixed, ["band", "bucket"]))
    ids = shared_table(mixed.select(F.col("rep").alias("id")).distinct())
    texts = among(docs, ids, "left_semi").groupBy(F.col("doc_id").alias("rep")).agg(F.min("text").alias("text"))
    texts = texts.join(copies.select("rep", "bands", "marks"), "rep")
    units = max(1, mixed.count() // ROWS_A_UNIT)
    small = F.pmod(F.xxhash64("band", "bucket"), F.lit(units)).cast("int")
    dealt = (mixed.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other"),
                           "unit": F.when(F.col("blocks") == 1, small).otherwise(F.lit(-1))})
             .withColumn("own", F.when(F.col("blocks") > 1, F.struct("band", "bucket"))))
    return shared_table(dealt.join(texts, "rep").groupBy("unit", "own", "low", "high")
                        .applyInArrow(_resolve(idf, least), "a long, b long"))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``(id, class_id)`` of the documents that belong to a group of two or more."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    idf = inverse_frequencies(docs)
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND text <> ''")
    sketches = shared_table(known.select("doc_id", F.unhex(F.md5("text")).alias("same"), "text")
                            .mapInArrow(_sketch(idf), "id long, same binary, bands array<long>, marks binary"))
    copies = shared_table(sketches.groupBy("same").agg(
        F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"), F.min_by("marks", "id").alias("marks"),
        F.count("*").alias("n")))
    several = copies.where("n > 1").select("same", "rep")
    links = sketches.select("same", "id").join(several, "same").where("id <> rep") \
        .select(F.col("rep").alias("a"), F.col("id").alias("b"))
    members = copies.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.min("rep").alias("leader"))
    members = shared_table(members.join(shared.where("n > 1").drop("n"), ["band", "bucket"]))
    pairs = members.where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    links = shared_table(links.union(_links(shared_table(pairs), known, idf, least)))
    grouped = components(links)
    rows = members.join(grouped, members["rep"] == grouped["node"], "left") \
        .select("band", "bucket", "rep", F.coalesce("component", "rep").alias("class"))
    more = _links_between(rows, copies, known, idf, least)
    if not more.isEmpty():
        grouped = components(links.union(more))
    return grouped.select(F.col("node").alias("id"), F.col("component").alias("class_id"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of its own for every row, written so that it stays."""
    key = free_name(docs, "row_key")
    return shared_table(docs.withColumn(key, F.monotonically_increasing_id())), key


def _firsts(rows: DataFrame, key: str, least: float) -> DataFrame:
    """``(row, first)`` of every row in a group of two or more: the group's row of the smallest ``doc_id``.

    Null ids come last; among equal ids the first key counts. ``first`` is a struct with ``doc_id`` and ``row``.
    """
    found = classes(rows.select(F.col(key).alias("doc_id"), "text"), least)
    ids = rows.select(F.col(key).alias("id"), F.col("doc_id").cast("long").alias("doc_id"))
    few = shared_table(found.join(ids, "id"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col("id").alias("row"))
    return few.join(few.groupBy("class_id").agg(F.min(order).alias("first")), "class_id").select(F.col("id").alias("row"), "first")


def duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id`` (the class's smallest id) and ``kept`` (one row of a class)."""
    rows, key = _keyed(docs.select("doc_id", "text"))
    firsts = _firsts(rows, key, least)
    return rows.select("doc_id", F.col(key).alias("row")).join(firsts, "row", "left").select(
        "doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).cast("long").alias("class_id"),
        F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest id."""
    rows, key = _keyed(docs)
    gone = shared_table(_firsts(rows, key, least).where("row <> first.row").select(F.col("row").alias(f"{key}_gone")))
    few = gone.limit(MAX_SENT_IDS + 1).count() <= MAX_SENT_IDS
    return rows.join(F.broadcast(gone) if few else gone, F.col(key) == F.col(f"{key}_gone"), "left_anti").drop(key)
