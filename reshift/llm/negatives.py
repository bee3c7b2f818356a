"""Hard negatives from labelled vectors by Fagin's threshold algorithm.

An anchor's positives are the first rows of its own label, by inner product of integer components; the
negatives of an (anchor, positive) pair are the first rows of other labels whose score lies in a window
below the positive's. Higher scores come first, ties by smaller ``vec_id``.

Vectors are dealt into blocks of about ``BLOCK`` rows and anchors into blocks of about ``ANCHORS``; each pair
of blocks is one bounded group, whatever the labels. Inside a group every dimension has a list of
candidates sorted by component. An anchor reads the lists from the end that its own component's sign
favours, one depth after the other; ids met are scored by random access, in integers. The threshold of a
depth is the score that a candidate would have with the components at that depth: no unread candidate has
more. An anchor stops once the threshold is strictly below the k-th score of each of its windows (strictly,
so that ties are all seen), or below the window's lower end. The best of all groups are merged by a
ranking whose partial step keeps k rows a task. Positives come first, over all rows; their scores set the
windows of the second pass.

The scores are exact: double precision is used only where every partial sum is below 2^53.

Defined cases: rows with a null id, null label or null vector, or any null or non-finite component take no
part. Of rows that share a ``vec_id`` the one with the smallest (label, vector) does. Vectors of different
dimension are not compared; a vector without components scores 0. Scores beyond a long's range are cut to
it. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshift.llm.common import shared_table

SCALE = 256
BLOCK = 8192
ANCHORS = 2048
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95   # a negative's score as a share of the positive's, in percent
DEPTHS = 4           # each look reads this many times as deep as the last one
FIRST_DEPTH = 16
LONG = np.iinfo(np.int64)
EXACT = 2.0 ** 53


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``(vec_id, label, v)``: rows that take part, components as whole doubles."""
    e = F.col(vector)

    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & ~F.exists(e, bad))
    # floor of a double would pass through a long; whole numbers beyond 2^53 are their own floor
    whole = F.transform(e, lambda x: F.when(F.abs(x.cast("double") * SCALE) < EXACT, F.floor(x.cast("double") * SCALE).cast("double"))
                        .otherwise(x.cast("double") * SCALE))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))
    best = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("best"))
    return best.select("vec_id", "best.label", "best.v", F.size("best.v").alias("dims"))


def dealt(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` with a block number, about ``size`` rows a block."""
    blocks = -(-rows.count() // size) or 1
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), blocks


def scored(matrix: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as int64."""
    if matrix.size == 0:
        return np.zeros(len(matrix), np.int64)
    if matrix.shape[1] * np.abs(matrix).max() * np.abs(anchor).max() < EXACT:
        return (matrix @ anchor).astype(np.int64)
    a = [int(x) for x in anchor]
    exact = [sum(int(x) * y for x, y in zip(row, a, strict=True)) for row in matrix]
    return np.array([min(max(x, LONG.min), LONG.max) for x in exact], np.int64)


class Lists:
    """The candidates of one block, with one sorted list a dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.v = ids[by_id], labels[by_id], vectors[by_id]
        self.order = np.argsort(self.v, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.v, self.order, axis=0)

    def top(self, anchor_id: int, label: int, anchor: np.ndarray, same: bool, windows: list[tuple[float, float]],
            k: int) -> list[list[tuple[int, int]]]:
        """For each window (low, high) the first ``k`` eligible ``(id, score)`` of the block."""
        n = len(self.ids)
        eligible = (self.labels == label) & (self.ids != anchor_id) if same else self.labels != label
        if not eligible.any():
            return [[] for _ in windows]
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        unseen = eligible.copy()
        found_at, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best: list[np.ndarray] = []
        read, depth = 0, min(FIRST_DEPTH, n)
        while True:
            met = np.zeros(n, bool)
            met[self.order[n - depth:n - read, up].ravel()] = True
            met[self.order[read:depth, down].ravel()] = True
            if depth == n:
                met[:] = True  # an anchor of zeros has no list to read
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            found_at = np.concatenate([found_at, new])
            found = np.concatenate([found, scored(self.v[new], anchor)])
            best = [self._first(found_at, found, w, k) for w in windows]
            if depth == n:
                break
            edge = np.zeros(self.v.shape[1])
            edge[up], edge[down] = self.sorted[n - depth, up], self.sorted[depth - 1, down]
            threshold = scored(edge[None, :], anchor)[0]
            if all(threshold < low or (len(b) == k and threshold < found[b[-1]])
                   for b, (low, _) in zip(best, windows, strict=True)):
                break
            read, depth = depth, min(depth * DEPTHS, n)
        return [[(int(self.ids[found_at[i]]), int(found[i])) for i in b] for b in best]

    @staticmethod
    def _first(at: np.ndarray, scores: np.ndarray, window: tuple[float, float], k: int) -> np.ndarray:
        inside = np.flatnonzero((scores >= window[0]) & (scores <= window[1]))
        if len(inside) > 4 * k:  # ties with the k-th stay
            kth = np.partition(scores[inside], len(inside) - k)[len(inside) - k]
            inside = inside[scores[inside] >= kth]
        # candidates are kept by rising id
        return inside[np.lexsort((at[inside], -scores[inside]))][:k]


def _blocks(group: Iterator[pd.DataFrame]):
    return pd.concat(list(group), ignore_index=True)


def searched(vectors: DataFrame, n_blocks: int, anchors: DataFrame, k: int, same: bool, anchor_block: int) -> DataFrame:
    """The best ``k`` a window and block, for anchors with ``windows`` (arrays of id, low, high).

    ``(anchor_id, window_id, vec_id, score)``.
    """
    parts, n_parts = dealt(anchors, anchor_block, "part")
    left = vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    right = parts.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def search(candidates: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(wanted):
            lists = Lists(candidates["vec_id"].to_numpy(), candidates["label"].to_numpy(),
                          np.stack(candidates["v"].to_numpy()).astype(float).reshape(len(candidates), -1))
            for vec_id, label, v, windows in zip(wanted["vec_id"], wanted["label"], wanted["v"], wanted["windows"], strict=True):
                bounds = [(w["low"], w["high"]) for w in windows]
                for w, hits in zip(windows, lists.top(vec_id, label, np.asarray(v, float), same, bounds, k), strict=True):
                    out += [(vec_id, w["id"], hit, score) for hit, score in hits]
        return pd.DataFrame(out, columns=["anchor_id", "window_id", "vec_id", "score"]).astype("int64")

    keys = ["dims", "block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "anchor_id long, window_id long, vec_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("anchor_id", "window_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, block: int = BLOCK, anchor_block: int = ANCHORS,
                   vector: str = "embedding") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of every anchor."""
    rows = shared_table(usable(embeddings, vector))
    vectors, n_blocks = dealt(rows, block, "block")
    anchors = shared_table(rows.where(is_anchor))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("id"), F.lit(LONG.min).alias("low"), F.lit(LONG.max).alias("high")))
    first = ranked(searched(vectors, n_blocks, anchors.withColumn("windows", whole), positives, True, anchor_block), positives)
    first = shared_table(first.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # whole scores n with low * p <= 100 * n <= high * p, for p >= 0; below zero the window is empty
    p = F.col("positive_score")
    window = F.struct(F.col("positive_id").alias("id"), F.ceil(p.cast("decimal(20,0)") * low / 100).cast("long").alias("low"),
                      F.floor(p.cast("decimal(20,0)") * high / 100).cast("long").alias("high"))
    windows = first.where(p >= 0).groupBy("anchor_id").agg(F.array_sort(F.collect_list(window)).alias("windows"))
    second = shared_table(anchors.join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    found = ranked(searched(vectors, n_blocks, second, negatives, False, anchor_block), negatives)
    return found.join(first, (found["anchor_id"] == first["anchor_id"]) & (found["window_id"] == first["positive_id"])).select(
        found["anchor_id"], "positive_id", "rank", found["vec_id"].alias("negative_id"), "positive_score",
        found["score"].alias("negative_score"))
