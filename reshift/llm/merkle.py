"""Operator 2: Merkle fixity audit of WARC records.

Each record is a leaf: SHA-256 over its header and payload. Leaves are joined by ordered offset ranges: a
node of the first level covers ``2**RANGE_BITS`` bytes of its file, a node of each further level
``2**FANOUT_BITS`` nodes below it, up to one root per file. A node's hash covers the places and hashes of
its children in order, so that a lost, added, moved or altered record changes the nodes above it and no
other.

The audit compares replicas from the roots down and descends into mismatching nodes only; every step is a
join on (file, node), and payloads are read once per replica, where the leaves are hashed, and never
shuffled. A node's children are few by construction (records that begin in one range, or ``2**FANOUT_BITS``
nodes), whatever share of all records one file holds, so no group grows with the data. Trees are written
to the shared folder; a lost executor costs a re-read.

Defined cases: null headers and payloads hash as empty; a null file name is a file of its own; records
at one offset are ordered by their hash; repeated records are leaves each and compared by their number;
a file or record that only one replica has is reported as ``added`` or ``missing``; an empty table has no
nodes. Other columns of the records are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshift.llm.common import shared_table

RANGE_BITS = 16
FANOUT_BITS = 4
RECORDS_PER_FILE = 1000


def header_of(page: DataFrame) -> Column:
    """Header block of a page as a WARC response record."""
    length = F.octet_length(F.coalesce(page["html"], F.lit("")))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(page["url"], F.lit("")),
                    F.lit("\r\nContent-Length: "), length.cast("string"), F.lit("\r\n\r\n"))


def leaf_hash(header: Column, payload: Column) -> Column:
    return F.sha2(F.concat(F.lit("leaf\n"), F.coalesce(header, F.lit("")), F.coalesce(payload, F.lit(""))), 256)


def page_leaves(pages: DataFrame, per_file: int = RECORDS_PER_FILE, **payloads: Column) -> DataFrame:
    """Pages as records ``file, record_id, length`` and a leaf hash per replica, named in ``payloads``.

    A file holds the pages of ``per_file`` consecutive ids; pages without an id are dealt by their URL.
    """
    header = header_of(pages)
    number = F.coalesce(F.floor(F.col("page_id") / per_file), -1 - F.pmod(F.xxhash64("url"), F.lit(1 << 20)))
    size = F.octet_length(header) + F.octet_length(F.coalesce("html", F.lit(""))) + 4
    return pages.select(number.alias("file"), F.col("page_id").alias("record_id"), size.cast("long").alias("length"),
                        *[leaf_hash(header, held).alias(name) for name, held in payloads.items()])


def with_offsets(records: DataFrame, ties: str = "hash") -> DataFrame:
    """Offsets of records written to their files in the order of ``record_id``; a file is bounded."""
    before = Window.partitionBy("file").orderBy("record_id", ties).rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def _joined(children: Column, place: str) -> Column:
    """Hash over sorted ``(place, hash)`` children."""
    lines = F.transform(F.array_sort(children), lambda c: F.concat_ws(" ", c[place].cast("string"), c["hash"]))
    return F.sha2(F.concat(F.lit("node\n"), F.array_join(lines, "\n")), 256)


class Tree:
    """``levels[0]``: leaves (``file, node, record_id, length, hash``); above: ``file, node, hash``; last: roots."""

    def __init__(self, leaves: DataFrame, height: int):
        self.levels = [leaves]
        bits, place = RANGE_BITS, "node"
        for _ in range(height):
            below = self.levels[-1]
            above = below.groupBy("file", F.shiftright("node", bits).alias("node")).agg(
                _joined(F.collect_list(F.struct("node", "hash")), place).alias("hash"))
            self.levels.append(shared_table(above))
            bits = FANOUT_BITS


def height_for(*leaves: DataFrame) -> int:
    """Levels above the leaves so that the last one has a single node per file."""
    last = max((x.agg(F.max("node").alias("n")).first()["n"] or 0) for x in leaves)
    height, nodes = 1, last >> RANGE_BITS
    while nodes:
        height, nodes = height + 1, nodes >> FANOUT_BITS
    return height


def trees(*replicas: DataFrame) -> list[Tree]:
    """Trees of equal height over replicas' records ``file, offset, record_id, length, hash``."""
    leaves = [shared_table(r.select("file", F.col("offset").cast("long").alias("node"), "record_id", "length", "hash"))
              for r in replicas]
    height = height_for(*leaves)
    return [Tree(x, height) for x in leaves]


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that one side lacks: ``file, node, primary_hash, replica_hash``."""
    a = left.select("file", "node", F.col("hash").alias("primary_hash"))
    b = right.select(F.col("file").alias("f"), F.col("node").alias("n"), F.col("hash").alias("replica_hash"))
    both = a.join(b, F.col("file").eqNullSafe(F.col("f")) & (F.col("node") == F.col("n")), "full")
    there = F.col("node").isNotNull()
    return both.where(~F.col("primary_hash").eqNullSafe(F.col("replica_hash"))).select(
        F.when(there, F.col("file")).otherwise(F.col("f")).alias("file"), F.coalesce("node", "n").alias("node"),
        "primary_hash", "replica_hash")


def _below(level: DataFrame, parents: DataFrame, bits: int) -> DataFrame:
    up = parents.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
    return level.join(up, level["file"].eqNullSafe(F.col("up_file"))
                      & (F.shiftright(level["node"], bits) == F.col("up_node")), "left_semi")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records on which two replicas differ.

    ``file, offset, record_id, length, primary_hash, replica_hash, status``; the status is ``altered``,
    ``missing`` (the replica lacks it) or ``added``.
    """
    ours, theirs = trees(primary, replica)
    bad = shared_table(_differing(ours.levels[-1], theirs.levels[-1]))
    for level in range(len(ours.levels) - 2, 0, -1):
        bad = shared_table(_differing(*(_below(t.levels[level], bad, FANOUT_BITS) for t in (ours, theirs))))
    a, b = (_below(t.levels[0], bad, RANGE_BITS) for t in (ours, theirs))
    # records of one place are matched in the order of their hashes
    turn = F.row_number().over(Window.partitionBy("file", "node", "record_id").orderBy("hash"))
    keys = ["file", "node", "record_id", "turn"]
    a = a.withColumn("turn", turn).select(*keys, F.col("length").alias("a_length"), F.col("hash").alias("primary_hash"))
    b = b.withColumn("turn", turn).select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col("length").alias("b_length"),
                                          F.col("hash").alias("replica_hash"))
    same = [F.col(k).eqNullSafe(F.col(f"b_{k}")) for k in keys]
    both = a.join(b, same, "full").where(~F.col("primary_hash").eqNullSafe(F.col("replica_hash")))
    ours_has = F.col("primary_hash").isNotNull()
    status = (F.when(F.col("replica_hash").isNull(), "missing").when(~ours_has, "added").otherwise("altered"))
    return both.select(*[F.when(ours_has, F.col(k)).otherwise(F.col(f"b_{k}")).alias("offset" if k == "node" else k)
                         for k in keys[:3]], F.coalesce("a_length", "b_length").alias("length"),
                       "primary_hash", "replica_hash", status.alias("status"))


def damaged(html: Column, page_id: Column) -> Column:
    """Payloads of a replica with known damage: the first character of every 97th page is another one."""
    first = F.when(F.substring(html, 1, 1) == "~", F.lit("!")).otherwise(F.lit("~"))
    rest = F.expr("substring(html, 2)")
    return F.when((page_id % 97 == 13) & (F.length(html) > 0), F.concat(first, rest)).otherwise(html)


def audit_damaged_copy(pages: DataFrame) -> DataFrame:
    """Audit all pages as WARC files against a replica that ``damaged`` derives from them."""
    html = F.col("html")
    both = page_leaves(pages, primary=html, replica=damaged(html, F.col("page_id")))
    both = shared_table(with_offsets(both, ties="primary"))
    return audit(*(both.select("file", "offset", "record_id", "length", F.col(name).alias("hash"))
                   for name in ("primary", "replica")))
