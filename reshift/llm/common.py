"""What several operators share: lineage cuts, batches of whole texts, components of a link graph."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reshift.session import checkpoint_dir

# whitespace of the contracts' word rule
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``."""
    folder = checkpoint_dir(spark)
    if not folder:
        raise ValueError("spark.checkpoint.dir is unset; name a folder that all executors share")
    return folder


def shared_table(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, and what a task decided (ranks, partition
    numbers) stays as written. The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/reshift-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bind(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once a row, however often ``fn`` names it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until no column of ``df`` has that name (any case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each row begins and ends (nulls: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, *columns: int, most_bytes: int = 1 << 20, most_rows: int = 4096):
    """Consecutive parts of a batch with a bounded amount of text in the given columns (a row at least)."""
    sizes = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        sizes += np.diff(string_bytes(batch.column(c))[1])
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at] - sizes[at]
        stop = int(np.searchsorted(ends, before + most_bytes, "right"))
        stop = min(max(stop, at + 1), at + most_rows)
        yield batch.slice(at, stop - at)
        at = stop


def components(nodes_linked: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: ``(node, component)`` for columns ``(a, b)``.

    Each round gives a node the smallest label among itself and its neighbours, then the label of
    that label, until nothing changes. Every step is a join or a partial aggregate on node ids,
    and each round is written to the shared folder, so no component meets in one task or on the
    driver. Null and self links are ignored; an empty table has no components.
    """
    spark = nodes_linked.sparkSession
    pairs = nodes_linked.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    links = shared_table(pairs.select("a", "b").union(pairs.select("b", "a")).distinct())
    labels = shared_table(links.groupBy(F.col("a").alias("node"))
                          .agg(F.least(F.col("a"), F.min("b")).alias("component")))
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("theirs"))
        lowest = (links.join(seen, "b").groupBy(F.col("a").alias("node"))
                  .agg(F.min("theirs").alias("lowest")))
        step = labels.join(lowest, "node").select(
            "node", "component", F.least("component", "lowest").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        moved = shared_table(step.join(up, "next", "left").select(
            "node", F.col("component").alias("old"),
            F.least("next", F.coalesce("jump", "next")).alias("component")))
        changed = not moved.where("component <> old").isEmpty()
        labels = moved.select("node", "component")
        if not changed:
            return labels
