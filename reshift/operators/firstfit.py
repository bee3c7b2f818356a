"""G5 + J4 + P13: assign each chosen move to one reservation (first fit).

Within a pool (region, zone, os, type) the chosen moves are served in walk
order; each gives its whole shift to the first reservation row, in raw
inventory order, whose remaining active count covers it. Remaining counts are
tracked per reservation row, so no reservation is promised twice. A move no
single row can cover is not assigned.

Bounded groups. A pool may own a very large share of the inventory, but only
few rows can ever be chosen: with ``K`` moves in the pool, the move at position
``k <= K`` lands on one of the first ``K`` rows (in order) whose *original*
count covers its shift, since at most ``k - 1`` rows have been drawn down before
it. Each reservation row falls into exactly one bucket, the largest of the
pool's shifts that its count covers (a row below the smallest shift is left
out), and the first ``K`` rows of every bucket are kept. The first ``K`` rows
that cover a shift ``t`` lie in the buckets from ``t`` up, so they are all
kept; first fit over the kept rows is the same as over all rows. The join makes at
most one row per reservation, and the first ``K`` of a bucket are taken in two
window passes, the first one over salted slices, so a hot pool is spread over
many tasks.

The fold is one pass over a sorted stream: reservation rows and moves are
hash-partitioned by pool and sorted, a pool's rows in inventory order first,
its moves in walk order after them. The pass reads a pool's kept rows into a
tree of largest remaining counts; a move descends it to the first row that
covers its shift and corrects one path, so it costs the logarithm of the rows,
not their number. One pool's kept rows (at most ``K`` a bucket) are all that is
held; the moves are not.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reshift.operators.greedy import relabel_regional, typed
from reshift.operators.inventory import RESERVATION_ORDER

# shipped to the Python workers by value, like the greedy walk
cloudpickle.register_pickle_by_value(sys.modules[__name__])

POOL = ("region", "availability_zone", "os", "instancetype")

RESERVATION_COLUMNS = POOL + ("account_id", "reserved_instance_id", "offering_type",
                              "product_description", "instance_type", "active")
MOVE_COLUMNS = POOL + ("productname", "ondemand_availabilityzone", "ondemand_instancetype",
                       "instances_tobe_shifted", "savings", "pick_order")

DEFAULT_SALT_BUCKETS = 32


SHIFT_SCHEMA = (
    "productname string, reserved_instance_id string, account_id string, offering_type string, "
    "instancetype string, region string, availability_zone string, os string, active long, "
    "ondemand_availabilityzone string, ondemand_instancetype string, "
    "active_instances_tobe_shifted double, savings double")


def pool_limits(moves: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per pool: how many moves it has, and their distinct shifts."""
    return moves.groupBy(*by, *POOL).agg(
        F.count(F.lit(1)).alias("k"), F.collect_set("instances_tobe_shifted").alias("shifts"))


def order_columns(order: str) -> tuple[str, ...]:
    """Columns a pool's reservations are served by, ascending."""
    return ("active", *RESERVATION_ORDER) if order == "fewest" else RESERVATION_ORDER


def reachable_reservations(limits: DataFrame, res_list: DataFrame,
                           salt_buckets: int = DEFAULT_SALT_BUCKETS, order: str = "id",
                           by: tuple[str, ...] = ()) -> DataFrame:
    """The reservation rows first fit can choose (exact pruning, see module doc)."""
    inventory = res_list.filter(F.col("active") > 0).select(*RESERVATION_COLUMNS)
    # a plain join: AQE broadcasts the limits while their measured size allows, and splits a hot
    # pool on the reservation side beyond that
    rows = (inventory.join(limits, list(POOL))
            .withColumn("bucket", F.array_max(F.filter("shifts", lambda t: t <= F.col("active"))))
            .filter(F.col("bucket").isNotNull())
            .withColumn("salt", F.pmod(F.xxhash64(*RESERVATION_ORDER), F.lit(int(salt_buckets))))
            .drop("shifts"))
    ranked = [F.col(c).asc_nulls_first() for c in order_columns(order)]
    for keys in ((*by, *POOL, "bucket", "salt"), (*by, *POOL, "bucket")):
        rows = (rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked)))
                .filter(F.col("rn") <= F.col("k")))
    return rows.select(*by, *RESERVATION_COLUMNS)


class Remaining:
    """Remaining counts of a pool's rows, as a tree whose nodes hold the largest count below them."""

    def __init__(self, counts: list[float]):
        self.size = 1 << max(len(counts) - 1, 0).bit_length()
        self.tree = [0.0] * self.size + counts + [0.0] * (self.size - len(counts))
        for i in range(self.size - 1, 0, -1):
            self.tree[i] = max(self.tree[2 * i], self.tree[2 * i + 1])

    def take(self, shift: float) -> int | None:
        """Take ``shift`` from the first row whose positive rest covers it; its place, or None."""
        tree, i = self.tree, 1
        if not (tree[1] >= shift and tree[1] > 0):
            return None
        while i < self.size:
            i *= 2
            if not (tree[i] >= shift and tree[i] > 0):
                i += 1
        place = i - self.size
        tree[i] -= shift
        while i > 1:
            i //= 2
            tree[i] = max(tree[2 * i], tree[2 * i + 1])
        return place


def fold(batches: Iterable[pa.RecordBatch], by: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """First fit over pools that arrive one after the other, rows before moves; pools may span batches."""
    pool, rows, left = None, [], None
    kinds = [pa.string()] * 8 + [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in SHIFT_SCHEMA.split(", ")]
    for batch in batches:
        out, at = [], []
        keys = zip(*(batch.column(c).to_pylist() for c in (*by, *POOL)), strict=True)
        stream = zip(*(batch.column(c).to_pylist() for c in STREAM), strict=True)
        for i, (key, (pick, product, od_zone, od_type, shift, savings, rid, account, offering, active)) in enumerate(
                zip(keys, stream, strict=True)):
            if key != pool:
                pool, rows, left = key, [], None
            if pick is None:
                rows.append((rid, account, offering, active))
                continue
            if left is None:
                left = Remaining([float(row[3]) for row in rows])
            place = None if shift is None else left.take(shift)
            if place is not None:
                rid, account, offering, active = rows[place]
                region, zone, os, itype = key[len(by):]
                out.append((product, rid, account, offering, itype, region, zone, os, active, od_zone, od_type, shift, savings))
                at.append(i)
        columns = zip(*out, strict=True) if out else [()] * len(names)
        front = batch.select(list(by)).take(pa.array(at, pa.int32())).columns if by else []
        yield pa.RecordBatch.from_arrays([*front, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                                         names=[*by, *names])


# what the fold reads beside the pool's keys
STREAM = ("pick_order", "productname", "ondemand_availabilityzone", "ondemand_instancetype",
          "instances_tobe_shifted", "savings", "reserved_instance_id", "account_id", "offering_type", "active")


def first_fit(moves: DataFrame, rows: DataFrame, order: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """First fit per pool; one output row per assigned move."""
    pool = (*by, *POOL)
    stream = rows.select(*by, *RESERVATION_COLUMNS).unionByName(moves.select(*by, *MOVE_COLUMNS), allowMissingColumns=True)
    ranked = [F.col(c).asc_nulls_first() for c in ("pick_order", *order_columns(order)) if c not in POOL]
    return (stream.repartition(*pool).sortWithinPartitions(*pool, *ranked).select(*pool, *STREAM)
            .mapInArrow(partial(fold, by=by), typed(moves, by) + SHIFT_SCHEMA))


def reservation_shift(picks: DataFrame, res_list: DataFrame,
                      salt_buckets: int = DEFAULT_SALT_BUCKETS, order: str = "id",
                      by: tuple[str, ...] = ()) -> DataFrame:
    """Assigned moves, one row per (move, reservation row) with a positive shift."""
    # the picks feed the limits and the fold: a stored table in a full run; a lazy plan walks the shared,
    # sorted candidates twice, with the same picks, as their order is total
    moves = relabel_regional(picks).select(*by, *MOVE_COLUMNS)
    rows = reachable_reservations(pool_limits(moves, by), res_list, salt_buckets, order, by)
    return first_fit(moves, rows, order, by).filter(F.col("active_instances_tobe_shifted") > 0)
