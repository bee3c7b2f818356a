"""Operator 5: near-duplicate embeddings through a pivot-permutation index.

Reference points are a bounded sample of the vectors. A vector is described by the ordered list of its
``PREFIX`` nearest pivots. Every pivot keeps an inverted list of the vectors that have it in their
prefix; two vectors are retrieved if they share a pivot, and become a link if their cosine, computed in
double precision, is at least ``COSINE``.

A sampled vector is a pivot only if its cosine to every pivot before it is below ``APART``. Otherwise a
dense group of like vectors would hold pivots in proportion to its size, and its members' prefixes would
lie inside it in nearly independent order. A prefix ends before the pivots that are further than the
nearest one by more than twice the angle of a link: whatever the vector is linked to has the same nearest
pivot, so these lists add nothing, and a dense group is compared in one list.

Vectors of different dimension never link; every dimension has pivots and lists of its own, a rare one
(at most ``RARE`` vectors) a single list.

The number of pivots grows with the square root of the vectors up to ``MAX_PIVOTS``, so a list holds
about ``PREFIX * sqrt(n)`` vectors. A pair is counted in one list only, that of its smallest shared
pivot. A list is one group of tasks: it is dealt into blocks of at most about ``BLOCK`` vectors, and
each pair of blocks is a group of its own, so that a hot list (many like vectors) is spread out. A
group returns one row per vector with its number of links there and the smallest vector it is joined to
there, never the pairs. Equal vectors are one representative with a count.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with
nothing; a null ``vec_id`` links with
nothing and has null results; repeated ``vec_id`` are one node with the counts of its rows added up; ties
in distance go to the smaller pivot number; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import components, shared_table

COSINE = 0.9
PREFIX = 8
APART = 0.8
SAMPLED = 4  # vectors looked at for one pivot
MIN_PIVOTS, MAX_PIVOTS = 64, 1024
PIVOTS_PER_ROOT = 1.5
BLOCK = 8192
RARE = 512
ROWS_A_STEP = 64
ROUNDING = 1e-9  # cosines nearer to the threshold are computed once more, pair by pair


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components present and finite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors) -> np.ndarray:
    """Rows in double precision with length 1; scaled first, so that squares neither vanish nor overflow."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spread(unit: np.ndarray, most: int) -> np.ndarray:
    """Row numbers, in order, of at most ``most`` rows whose cosine to every row taken before is below ``APART``."""
    taken: list[int] = []
    for i, row in enumerate(unit):
        if len(taken) == most:
            break
        if not taken or (unit[taken] @ row).max() < APART:
            taken.append(i)
    return np.array(taken, np.int64)


def prefixes(unit: np.ndarray, pivots: np.ndarray, least: float = COSINE) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first.

    Pivots too far to matter to a link of the row are given as its nearest one once more.
    """
    near = np.round(unit @ pivots.T, 12)
    order = np.argsort(-near, axis=1, kind="stable")[:, :PREFIX].astype(np.int32)
    angle = np.arccos(np.clip(np.take_along_axis(near, order, axis=1), -1, 1))
    return np.where(angle <= angle[:, :1] + 2 * math.acos(least) + 1e-6, order, order[:, :1])


def _masks(prefix: np.ndarray, n_pivots: int) -> np.ndarray:
    words = np.zeros((len(prefix), (n_pivots + 63) // 64), np.uint64)
    for column in prefix.T:
        words[np.arange(len(prefix)), column >> 6] |= np.uint64(1) << (column & 63).astype(np.uint64)
    return words


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` after the links ``(a, b)``; it names the smallest place reached from each place."""
    while True:
        label_a, label_b = label[a], label[b]
        apart = label_a != label_b
        if not apart.any():
            return label
        a, b, label_a, label_b = a[apart], b[apart], label_a[apart], label_b[apart]
        np.minimum.at(label, np.maximum(label_a, label_b), np.minimum(label_a, label_b))
        while not np.array_equal(label, label[label]):
            label = label[label]


def linked_in_list(pivot: int, n_pivots: int, left: tuple, right: tuple | None, least: float):
    """Links among the vectors of a list that have ``pivot`` as their smallest shared pivot.

    A side is ``(ids, copies, prefix, unit)``; without ``right`` the pairs inside ``left`` are taken.
    Returns per vector of both sides: links (copies counted) and the smallest vector joined to it.
    """
    ids = left[0] if right is None else np.concatenate((left[0], right[0]))
    copies = left[1] if right is None else np.concatenate((left[1], right[1]))
    other, shift = (left, 0) if right is None else (right, len(left[0]))
    words = (pivot >> 6) + 1
    below = np.full(words, ~np.uint64(0))
    below[-1] = (np.uint64(1) << np.uint64(pivot & 63)) - np.uint64(1)
    mask_a, mask_b = (_masks(side[2], n_pivots)[:, :words] & below for side in (left, other))
    links = np.zeros(len(ids), np.int64)
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    label = np.arange(len(ids))  # place of the smallest vector reached so far, by place
    for at in range(0, len(mask_a), ROWS_A_STEP):
        cosines = left[3][at:at + ROWS_A_STEP] @ other[3].T
        a, b = np.nonzero(cosines >= least - ROUNDING)
        unsure = cosines[a, b] < least + ROUNDING
        a += at
        if right is None:
            once = a < b
            a, b, unsure = a[once], b[once], unsure[once]
        taken = np.ones(len(a), bool)
        for cut in range(0, len(a), 1 << 16):
            some = slice(cut, cut + (1 << 16))
            taken[some] = ~(mask_a[a[some]] & mask_b[b[some]]).any(axis=1)
        doubtful = np.flatnonzero(unsure & taken)
        taken[doubtful] = np.einsum("ij,ij->i", left[3][a[doubtful]], other[3][b[doubtful]]) >= least
        a, b = a[taken], b[taken] + shift
        links += np.bincount(a, copies[b], len(ids)).astype(np.int64)
        links += np.bincount(b, copies[a], len(ids)).astype(np.int64)
        label = _joined(label, place[a], place[b])
    return ids, links, ids[order][label[place]]


def _side(frame: pd.DataFrame) -> tuple:
    return (frame["rep"].to_numpy(np.int64), frame["n"].to_numpy(np.int64),
            np.stack(frame["prefix"].to_numpy()), unit_rows(frame["vector"]))


class Index:
    """The pivots of all dimensions: those of dimension ``d`` are numbered from ``base[d]`` on.

    A dimension without entry in ``pivots`` is rare: all its vectors are in the one list ``base[d]``.
    """

    def __init__(self, sizes: dict[int, int], pivots: dict[int, np.ndarray]):
        self.pivots, self.base, end = pivots, {}, 0
        for d in sorted(sizes):
            self.base[d] = end
            end += self.lists(d)

    def lists(self, d: int) -> int:
        return len(self.pivots[d]) if d in self.pivots else 1

    def describe(self, vectors, least: float) -> list[np.ndarray]:
        """The numbers of the nearest pivots of every vector, nearest first."""
        sizes = np.array([len(v) for v in vectors])
        out: list = [None] * len(sizes)
        for d in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == d)
            if d in self.pivots:
                near = prefixes(unit_rows([vectors[i] for i in at]), self.pivots[d], least) + np.int32(self.base[d])
            else:
                near = np.full((len(at), 1), self.base[d], np.int32)
            for i, row in zip(at, near, strict=True):
                out[i] = row
        return out


def pivots_of(size: int) -> int:
    """How many pivots ``size`` vectors of one dimension have, at most."""
    return min(max(MIN_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(size))), MAX_PIVOTS, max(size, 1))


def build_index(reps: DataFrame) -> Index:
    """Pivots from a bounded sample of the vectors of every dimension that is not rare."""
    sizes = {r["d"]: r["count"] for r in reps.groupBy(F.size("vector").alias("d")).count().collect()}  # a row a dimension
    pivots = {}
    for d, size in sorted(sizes.items()):
        if size > RARE:
            sampled = (reps.where(F.size("vector") == d).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLED * pivots_of(size))
                       .select("rep", "vector").collect())
            unit = unit_rows([r["vector"] for r in sampled])
            pivots[d] = unit[spread(unit, pivots_of(size))]
    return Index(sizes, pivots)


def _list_task(index: Index, least: float):
    bases, lists = index.base, {d: index.lists(d) for d in index.base}

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        pivot, low, high = (int(frame[c].iloc[0]) for c in ("pivot", "low", "high"))
        d = len(frame["vector"].iloc[0])
        pivot, n_pivots = pivot - bases[d], lists[d]
        frame = frame.assign(prefix=[np.asarray(p) - bases[d] for p in frame["prefix"]])
        frame = frame.sort_values("rep", kind="stable")
        left = frame[frame["block"] == low]
        right = frame[frame["block"] == high] if low != high else None
        if not len(left) or (right is not None and not len(right)):
            return pd.DataFrame({"rep": [], "links": [], "lowest": []})
        got = linked_in_list(pivot, n_pivots, _side(left), None if right is None else _side(right), least)
        ids, links, lowest = got
        some = links > 0
        return pd.DataFrame({"rep": ids[some], "links": links[some], "lowest": lowest[some]})

    return run


def duplicates(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id``, ``embedding``)."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    good = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    reps = shared_table(good.groupBy(F.col("embedding").alias("vector"))
                        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    index = build_index(reps)

    @F.pandas_udf("array<int>")
    def described(vector: pd.Series) -> pd.Series:
        return pd.Series(index.describe(list(vector), least))

    indexed = shared_table(reps.withColumn("prefix", described("vector")))
    postings = indexed.withColumn("pivot", F.explode(F.array_distinct("prefix")))
    blocks = postings.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = (postings.join(F.broadcast(blocks), "pivot")  # a row per pivot
             .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}))
    found = shared_table(dealt.groupBy("pivot", "low", "high").applyInPandas(
        _list_task(index, least), "rep long, links long, lowest long"))
    between = found.groupBy("rep").agg(F.sum("links").alias("links"))
    several = reps.where("n > 1").select("vector", "rep")
    same = good.join(several, good["embedding"] == several["vector"]).select(
        F.col("rep").alias("a"), F.col("vec_id").alias("b"))
    joined = components(same.union(found.select("rep", "lowest")))
    counted = (good.join(reps, good["embedding"] == reps["vector"]).join(between, "rep", "left")
               .groupBy("vec_id").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    results = counted.join(joined, counted["vec_id"] == joined["node"], "left").select(
        F.col("vec_id").alias("known"), "n_links", F.coalesce("component", "vec_id").alias("component"))
    return (vectors.select("vec_id").join(results, F.col("vec_id") == F.col("known"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id") == F.col("component_id")))
