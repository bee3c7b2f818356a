"""Operator 9: pack documents into sequences of a fixed number of tokens.

A document is its ids and one end id. Only documents longer than a sequence are cut: the pieces
after the first are full, so the first alone may be shorter.

Method, exact-complement hashing. Pieces of one length are alike, so the plan works on the count of
every length, a table of at most ``capacity`` rows whatever the corpus. From the longest length down,
the gap a piece leaves is looked up among the sums of one, of two and of three lengths that are still
available; a hit fills the gap exactly and is consumed as often as the counts allow. What no exact
sum serves is packed best fit, longest first, into the tightest open gap.

On Spark: one pass encodes the texts and writes the pieces with their rank inside (task, length);
counts per (task, length) turn into global ranks; the plan, whose size is bounded by ``capacity``,
is sent to the tasks, which look up the place of (length, rank). No task gathers a length or a
sequence, and the driver sees the histogram only.

Defined cases: null or empty text is one piece holding the end id; a null ``doc_id`` is kept; repeated
rows are packed each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reshift.llm.common import shared_table, slices
from reshift.llm.vocab import BYTE_BPE, BYTES_A_CALL, encoder

CAPACITY = 2048
END_ID = 0

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank long"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: the first takes what full pieces leave."""
    full, rest = divmod(n, capacity)
    return ([rest] if rest else []) + [capacity] * full


def _pieces(vocabulary: str, capacity: int):
    def run(batches):
        encode = encoder(vocabulary).encode
        task = TaskContext.get().partitionId()
        ranks: dict[int, int] = {}
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for some in slices(batch, 1, most_bytes=BYTES_A_CALL):
                for doc, raw in zip(some.column(0).to_pylist(), encode(some.column(1))):
                    raw += end
                    start = 0
                    for piece, n in enumerate(cut_lengths(len(raw) // 4, capacity)):
                        rank = ranks.get(n, 0)
                        ranks[n] = rank + 1
                        crc = zlib.crc32(raw[4 * start:4 * (start + n)])
                        rows.append((doc, piece, start, n, crc, task, rank))
                        start += n
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = list(zip(*rows)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def pieces(docs: DataFrame, vocabulary: str = BYTE_BPE, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its length, checksum and rank among its task's pieces of that length."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_pieces(vocabulary, capacity), PIECES)


def _exact_sum(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to ``gap``; long ones are spent first."""
    if left[gap]:
        return (gap,)

    def pair(total: int, spent: int) -> tuple[int, int] | None:
        # lengths x >= y with x + y == total, of which ``spent`` is already taken once
        have = left.copy() if spent else left
        if spent:
            have[spent] -= 1
        x = np.arange((total + 1) // 2, total)
        ok = (have[x] > 0) & (have[total - x] > (x == total - x))
        hits = np.flatnonzero(ok)
        return (int(x[hits[-1]]), int(total - x[hits[-1]])) if len(hits) else None

    if gap >= 2 and (two := pair(gap, 0)):
        return two
    for first in np.flatnonzero(left[:max(gap - 1, 0)])[::-1]:
        if 3 * first < gap:
            break
        if gap - first >= 2 and (two := pair(int(gap - first), int(first))):
            return (int(first), *two)
    return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """``(lengths, how many sequences)`` using every piece once."""
    left = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        left[n] = c
    done: list[tuple[tuple[int, ...], int]] = []
    for a in range(capacity, 0, -1):
        while left[a]:
            left[a] -= 1  # the piece whose gap is looked up
            fill = () if a == capacity else _exact_sum(left, capacity - a)
            left[a] += 1
            if fill is None:
                break
            lengths = (a, *fill)
            need = {n: lengths.count(n) for n in lengths}
            times = min(int(left[n]) // k for n, k in need.items())
            for n, k in need.items():
                left[n] -= times * k
            done.append((lengths, times))
    # best fit: sequences with the same gap and content are one group; by_gap[g] lists the groups
    by_gap: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]
    for a in range(capacity, 0, -1):
        todo = int(left[a])
        gap = a
        while todo:
            while gap <= capacity and not by_gap[gap]:
                gap += 1
            if gap > capacity:
                each = capacity // a
                whole, rest = divmod(todo, each)
                if whole:
                    by_gap[capacity - each * a].append(((a,) * each, whole))
                if rest:
                    by_gap[capacity - rest * a].append(((a,) * rest, 1))
                break
            lengths, times = by_gap[gap].pop()
            used = min(times, todo)
            if times > used:
                by_gap[gap].append((lengths, times - used))
            by_gap[gap - a].append(((*lengths, a), used))
            todo -= used
            if gap - a >= a:
                gap = a
    return done + [g for groups in by_gap for g in groups]


def places(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every length, by rank: first rank, first sequence and offset of each run of like places."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, times in packed:
        offset = 0
        for n in lengths:
            runs.setdefault(n, []).append((used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in runs.items()}


def pack(docs: DataFrame, vocabulary: str = BYTE_BPE, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = shared_table(pieces(docs, vocabulary, capacity))
    counted = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = counted.withColumn("base", F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "task", F.coalesce("base", F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = places(plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for rows in np.split(order, cuts):
            if len(rows):
                first, seq, off = where[int(lengths[rows[0]])]
                run = np.searchsorted(first, ranks[rows], "right") - 1
                sequence[rows] = seq[run] + ranks[rows] - first[run]
                offset[rows] = off[run]
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = cut.join(before, ["length", "task"]).withColumn("at", place("length", F.col("rank") + F.col("base")))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset"))
