"""G1 + G2 + G4 + G6: choose non-competing moves greedily.

The walk visits candidates pool by pool (product, instance type, zone all
descending), inside a pool by savings descending (nulls last), ties broken
by on-demand zone and type ascending. A candidate is taken when its demand
(region, os, on-demand zone, on-demand type) is not yet claimed and the
pool's running total stays strictly below the pool's average unused count;
taking it claims the demand for every later pool.

With ``allow_full_use`` a pool may give away its whole average unused count, and a demand is claimed
only as far as it is covered: a later pool may serve what is left, with a shift cut to the rest.

Parallelism. Pools compete only through a shared demand, and a candidate
binds pool and demand to one region, os and two-letter family. So
(region, os, family) is an independent component, and the walk restricted to
a component equals the global walk restricted to it. Candidates are
hash-partitioned by component and sorted inside each partition in walk order,
by Spark, which spills; the walk itself is one ``mapInArrow`` pass over that
stream. It carries the component it is in across batches and holds only the
claimed demands and one running total: no component is ever in memory as a
whole, and thousands of small components cost one pass, not one call each.
Only the columns the result needs cross the Arrow boundary.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reshift.functions.columns import family

# The walk is shipped to the Python workers by value (this module's code and
# constants travel with the task), so executors need neither the package
# installed nor --py-files for it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENT_KEYS = ("region", "os", "family")

PICK_COLUMNS = ("productname", "region", "availability_zone", "os", "instancetype",
                "avg_unused_instances", "availabilityzone", "ondemand_instancetype",
                "avg_ondemand_instances", "instances_tobe_shifted",
                "ondemand_instances_increased", "savings")

PICK_SCHEMA = (
    "productname string, region string, availability_zone string, os string, "
    "instancetype string, avg_unused_instances double, availabilityzone string, "
    "ondemand_instancetype string, avg_ondemand_instances double, "
    "instances_tobe_shifted double, ondemand_instances_increased double, savings double, "
    "pick_order long")

# What the walk needs beyond the picks' columns to follow the rest of a demand.
REST_COLUMNS = ("unused_instance_cpu", "ondemand_instance_cpu", "avg_ondemand_cpu_needed")


def walk_order(by: tuple[str, ...] = ()) -> list:
    """Sort columns of the walk: component by component, then the order inside one."""
    descending = ("productname", "instancetype", "availability_zone", "savings")
    ascending = ("availabilityzone", "ondemand_instancetype")
    return [*by, *COMPONENT_KEYS, *[F.col(c).desc_nulls_last() for c in descending],
            *[F.col(c).asc_nulls_last() for c in ascending]]


def walk(batches: Iterable[pa.RecordBatch], allow_full_use: bool = False,
         by: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """The greedy walk over candidates in walk order; yields the picks of each batch.

    Components and pools may end anywhere inside a batch or go on in the next one.
    """
    component = pool = None
    position, used = 0, 0.0
    claimed: set = set()
    rest: dict = {}  # CPU units of a demand that are not covered yet

    for batch in batches:
        def values(*names, batch=batch):
            return zip(*(batch.column(name).to_pylist() for name in names), strict=True)

        cpu = values(*REST_COLUMNS) if allow_full_use else ((1, 1, 0),) * batch.num_rows
        taken, places, shifts, savings, increased = [], [], [], [], []
        keys = values(*by, *COMPONENT_KEYS)
        rows = values("productname", "instancetype", "availability_zone", "availabilityzone",
                      "ondemand_instancetype", "instances_tobe_shifted", "avg_unused_instances", "savings")
        for i, (key, (product, itype, zone, od_zone, od_type, shift, cap, saved),
                (unit, od_unit, need)) in enumerate(zip(keys, rows, cpu, strict=True)):
            if key != component:
                component, pool, position = key, None, 0
                claimed, rest = set(), {}
            if (product, itype, zone) != pool:
                pool, used = (product, itype, zone), 0.0
            place, position = position, position + 1
            demand = (od_zone, od_type)
            if demand in claimed:
                continue
            planned = shift
            if allow_full_use:
                need = rest.get(demand, need)
                shift = min(shift, math.floor(need / unit + 0.5))
                if shift < 1:
                    continue
            if not (used + shift < cap or (allow_full_use and used + shift <= cap)):
                continue
            used += shift
            if allow_full_use:
                rest[demand] = need - shift * unit
                shifts.append(float(shift))
                savings.append(None if saved is None else saved * shift / planned)
                increased.append(float(math.floor(shift * unit / od_unit + 0.5)))
            else:
                claimed.add(demand)
            taken.append(i)
            places.append(place)
        picks = batch.select([*by, *PICK_COLUMNS]).take(pa.array(taken, pa.int32()))
        if allow_full_use:
            for name, column in (("instances_tobe_shifted", shifts), ("savings", savings),
                                 ("ondemand_instances_increased", increased)):
                picks = picks.set_column(len(by) + PICK_COLUMNS.index(name), name, pa.array(column, pa.float64()))
        yield picks.append_column("pick_order", pa.array(places, pa.int64()))


def greedy_picks(candidates: DataFrame, allow_full_use: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Chosen candidates with their walk position (``pick_order``) inside the component."""
    shift, cap = F.col("instances_tobe_shifted"), F.col("avg_unused_instances")
    # a single shift beyond the pool's cap can never be taken; with the rest of a demand it may be cut
    possible = F.lit(True) if allow_full_use else shift < cap
    wanted = PICK_COLUMNS + (REST_COLUMNS if allow_full_use else ())
    narrow = candidates.filter(possible).select(*by, *wanted, family(F.col("instancetype")).alias("family"))
    ordered = narrow.repartition(*by, *COMPONENT_KEYS).sortWithinPartitions(*walk_order(by))
    return ordered.mapInArrow(partial(walk, allow_full_use=allow_full_use, by=by), typed(narrow, by) + PICK_SCHEMA)


def typed(df: DataFrame, columns: tuple[str, ...]) -> str:
    """The beginning of a schema that has ``columns`` of ``df`` in front."""
    return "".join(f"{c} {df.schema[c].dataType.simpleString()}, " for c in columns)


def relabel_regional(picks: DataFrame) -> DataFrame:
    """G4: for a regional pool the on-demand zone is reported as the region."""
    regional = F.col("region") == F.col("availability_zone")
    return picks.withColumn(
        "ondemand_availabilityzone",
        F.when(regional, F.col("availability_zone")).otherwise(F.col("availabilityzone")))


def suggestions(picks: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """G6: the suggestion table in its output column order."""
    return relabel_regional(picks).select(
        *by, "productname", "region",
        F.col("availability_zone").alias("unused_ri_availabilityzone"),
        "os",
        F.col("instancetype").alias("unused_ri_instancetype"),
        "avg_unused_instances", "ondemand_availabilityzone", "ondemand_instancetype",
        "avg_ondemand_instances", "instances_tobe_shifted", "ondemand_instances_increased",
        "savings")
