"""Conversation prefix trie, rolled up by a centroid decomposition of its parent edges.

Every conversation is a path: its first ``d`` turns are a node of depth ``d``, shared by all conversations
(members) that begin alike. A node is named by its smallest member and its depth, so the nodes that one
conversation names form a vertical chain, and ancestors are looked up on the paths, not by climbing.

Nodes are found by prefix hashes: the exclusive-or of a 128-bit hash of (depth, role, text) of every turn,
which needs no order of evaluation. A conversation is laid over range partitions and both its positions
and its prefixes are put together from sums by partition, so not even a conversation with a third of all
turns meets in one task.

Roll-up. The forest of first turns is cut at centroids, level by level, as joins over the whole forest: in
each component the deepest node whose subtree holds half of it is the centroid. The subtree's total is one
partial aggregate; it is the centroid's result and is added to all nodes on the path from the centroid to
the component's top. What hung below the centroid and what stays above it are the next components, each of
at most half the size. So a chain of a million turns takes twenty levels, not a million. Components of at
most ``SMALL`` nodes are summed as one sorted stream with one component in memory at a time.

A node's subtree size, which chooses centroids, is counted from the paths: of each member the nodes that
it names, and of the node's own namer those from here on.

Defined cases: turns are ordered by turn (null first), then role, then text. Rows without ``conv_id`` take
no part; null role or text is empty; repeated rows are turns of their own; an empty table has no nodes;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reshift.llm.common import shared_table

GROUP = 100   # conversations c - c % GROUP ... lend their first turns
SHARED = 6    # ... fewer than SHARED of them
SMALL = 20_000
CHUNK = 4096  # ids of a node's ends that travel as one string

NODE = ["owner", "depth"]
COMPONENT = ["comp_owner", "comp_depth"]


def positions(conversations: DataFrame) -> DataFrame:
    """``(conv_id, block, pos, role, text)``: each conversation's turns counted from 1, in ``block``s by order."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    order = ["conv_id", "turn", "role", "text"]
    laid = shared_table(rows.repartitionByRange(*order).withColumn("block", F.spark_partition_id()))
    local = laid.withColumn("rank", F.row_number().over(
        Window.partitionBy("conv_id", "block").orderBy(*[F.col(c).asc_nulls_first() for c in order[1:]])))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = laid.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return local.join(sizes, ["conv_id", "block"]).select(
        "conv_id", "block", (F.col("rank") + F.col("before")).alias("pos"), "role", "text")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations with their lent first turns ``(conv_id, block, depth, role, text)``, and their ids."""
    turns = shared_table(positions(conversations))
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    ids = own.select("conv_id", base.alias("base"), (F.crc32(F.col("conv_id").cast("string")) % SHARED).alias("lent"))
    lenders = own.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    ids = shared_table(ids.join(lenders, "base", "left").withColumn(
        "taken", F.least("lent", F.coalesce("there", F.lit(0)))).drop("there"))
    first = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < SHARED)).select(
        F.col("conv_id").alias("base"), "pos", "role", "text")
    lent = ids.join(first, "base").where("pos <= lent").select(
        "conv_id", F.lit(-1).alias("block"), F.col("pos").alias("depth"), "role", "text")
    kept = turns.join(ids, "conv_id").where("pos > lent").select(
        "conv_id", "block", (F.col("taken") + F.col("pos") - F.col("lent")).alias("depth"), "role", "text")
    return lent.union(kept), ids.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, p1, p2, chars)``: the hash of every prefix, and the code points of its last text."""
    what = ["depth", "role", "text"]
    marked = shared_table(turns.select(
        "conv_id", "block", "depth", F.xxhash64(*what).alias("e1"), F.xxhash64(F.lit(1), *what).alias("e2"),
        F.length("text").cast("long").alias("chars")))
    local = Window.partitionBy("conv_id", "block").orderBy("depth")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (marked.groupBy("conv_id", "block").agg(F.bit_xor("e1").alias("e1"), F.bit_xor("e2").alias("e2"))
              .select("conv_id", "block", *[F.coalesce(F.bit_xor(e).over(before), F.lit(0)).alias(b)
                                            for e, b in (("e1", "b1"), ("e2", "b2"))]))
    inside = marked.select("conv_id", "block", "depth", "chars",
                           F.bit_xor("e1").over(local).alias("e1"), F.bit_xor("e2").over(local).alias("e2"))
    return inside.join(blocks, ["conv_id", "block"]).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("e1").bitwiseXOR(F.col("b1")).alias("p1"),
        F.col("e2").bitwiseXOR(F.col("b2")).alias("p2"), "chars")


def paths(turns: DataFrame, root: int) -> DataFrame:
    """``(conv_id, depth, owner, prev, n_convs, chars)``: the node of every prefix, and its parent's owner."""
    found = shared_table(prefixes(turns))
    named = found.groupBy("depth", "p1", "p2").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"))
    steps = shared_table(found.join(named, ["depth", "p1", "p2"]).drop("p1", "p2"))
    above = steps.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("owner").alias("prev"))
    return shared_table(steps.join(above, ["conv_id", "depth"], "left").withColumn(
        "prev", F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("prev"))))


def nodes_of(steps: DataFrame) -> DataFrame:
    """One row a node but the root: what it counts alone, its subtree's size, and its first-turn tree."""
    chains = steps.groupBy("conv_id").agg(
        F.max("depth").alias("length"), F.count_if(F.col("owner") == F.col("conv_id")).alias("named"))
    own = (F.col("owner") == F.col("conv_id"))
    sizes = (steps.join(chains, "conv_id").groupBy(*NODE).agg(
        F.sum(F.when(own, F.col("length") - F.col("depth") + 1).otherwise(F.col("named"))).alias("size")))
    children = steps.where(own).groupBy(F.col("prev").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    tops = steps.where("depth = 1").select("conv_id", F.col("owner").alias("comp_owner"))
    rows = (steps.where(own).join(tops, "conv_id").join(sizes, NODE).join(children, NODE, "left"))
    rows = rows.select(
        *NODE, "prev", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "size", "comp_owner",
        F.lit(1).cast("long").alias("comp_depth"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    whole = rows.where("depth = 1").select("comp_owner", F.col("size").alias("comp_size"))
    return rows.join(whole, "comp_owner")


def _split(live: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level: all components cut at their centroids. Returns (centroids with totals, next components)."""
    half = live.where(2 * F.col("size") >= F.col("comp_size"))
    centroids = half.groupBy(*COMPONENT).agg(F.min(F.struct("size", *NODE)).alias("c"))
    deeper = F.col("depth") > F.col("c.depth")
    # a deeper node is below the centroid if its path goes through it, any other above if the centroid's does
    look = steps.select(F.col("conv_id").alias("at"), F.col("depth").alias("at_depth"),
                        F.col("owner").alias("met"), F.col("prev").alias("met_prev"))
    seen = (live.join(centroids, COMPONENT)
            .withColumns({"at": F.when(deeper, F.col("owner")).otherwise(F.col("c.owner")),
                          "at_depth": F.when(deeper, F.col("c.depth") + 1).otherwise(F.col("depth"))})
            .join(look, ["at", "at_depth"]))
    below = deeper & (F.col("met_prev") == F.col("c.owner"))
    on_path = ~deeper & (F.col("met") == F.col("owner"))
    tagged = shared_table(seen.select(
        *live.columns, F.col("c.size").alias("c_size"), below.alias("below"),
        (on_path & (F.col("depth") < F.col("c.depth"))).alias("above"),
        (on_path & (F.col("depth") == F.col("c.depth"))).alias("centre"),
        F.when(below, F.col("met")).otherwise(F.col("comp_owner")).alias("next_owner"),
        F.when(below, F.col("c.depth") + 1).otherwise(F.col("comp_depth")).alias("next_depth")))
    totals = tagged.where("below OR centre").groupBy(*COMPONENT).agg(
        F.sum("leaf").alias("t_leaves"), F.sum("saved").alias("t_saved"))
    tops = tagged.where("below").groupBy("next_owner", "next_depth").agg(F.max("size").alias("top_size"))
    added = tagged.join(totals, COMPONENT)
    ended = added.where("centre").select(
        *NODE, (F.col("t_leaves") + F.col("more_leaves")).alias("leaves"), (F.col("t_saved") + F.col("more_saved")).alias("saved"))
    put = {c: F.col(c) + F.when(F.col("above"), F.col(t)).otherwise(0)
           for c, t in (("more_leaves", "t_leaves"), ("more_saved", "t_saved"))}
    put["size"] = F.col("size") - F.when(F.col("above"), F.col("c_size")).otherwise(0)
    put["comp_size"] = F.when(F.col("below"), F.col("top_size")).otherwise(F.col("comp_size") - F.col("c_size"))
    put["comp_owner"], put["comp_depth"] = F.col("next_owner"), F.col("next_depth")
    rest = added.where("NOT centre").join(tops, ["next_owner", "next_depth"], "left").withColumns(put)
    return ended, shared_table(rest.select(*live.columns))


SUMMED = "owner long, depth long, leaves long, saved long"


def _sum_small(batches):
    """Subtree totals of components that arrive one after the other, each one's deepest nodes first."""
    component, waiting = None, {}
    for batch in batches:
        out = []
        for top, top_depth, depth, owner, prev, leaf, saved, more_leaves, more_saved in zip(
                *(c.to_pylist() for c in batch.columns), strict=True):
            if (top, top_depth) != component:
                component, waiting = (top, top_depth), {}
            below = waiting.pop((owner, depth), (0, 0))
            leaf, saved = leaf + below[0], saved + below[1]
            others = waiting.get((prev, depth - 1), (0, 0))
            waiting[prev, depth - 1] = (others[0] + leaf, others[1] + saved)
            out.append((owner, depth, leaf + more_leaves, saved + more_saved))
        owner, depth, leaves, saved = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (owner, depth, leaves, saved)],
                                         names=["owner", "depth", "leaves", "saved"])


def subtree_totals(nodes: DataFrame, steps: DataFrame, small: int = SMALL) -> DataFrame:
    """``(owner, depth, leaves, saved)`` summed over the subtree of every node, by centroid decomposition."""
    live = nodes.select(
        *NODE, "prev", *COMPONENT, "comp_size", "size", (F.col("n_children") == 0).cast("long").alias("leaf"), "saved",
        F.lit(0).cast("long").alias("more_leaves"), F.lit(0).cast("long").alias("more_saved"))
    ended, ready = [], []
    while True:
        ready.append(live.where(F.col("comp_size") <= small))
        live = live.where(F.col("comp_size") > small)
        if live.isEmpty():
            break
        centres, live = _split(live, steps)
        ended.append(centres)
    parts = reduce(DataFrame.union, ready).select(
        *COMPONENT, "depth", "owner", "prev", "leaf", "saved", "more_leaves", "more_saved")
    summed = (parts.repartition(*COMPONENT).sortWithinPartitions(*COMPONENT, F.col("depth").desc())
              .mapInArrow(_sum_small, SUMMED))
    return reduce(DataFrame.union, [summed, *ended])


ENDS = "owner long, depth long, ends_sha256 string"


def _digest(batches):
    """SHA-256 of each node's sorted id chunks, comma-joined; only the running hash is kept."""
    node, digest = None, None
    for batch in batches:
        out = []
        for owner, depth, _, chunk in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (owner, depth) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (owner, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(chunk.encode())
        yield _ends_batch(out)
    if node:
        yield _ends_batch([(*node, digest.hexdigest())])


def _ends_batch(rows):
    columns = zip(*rows, strict=True) if rows else ((), (), ())
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["owner", "depth", "ends_sha256"])


def ends(steps: DataFrame, ids: DataFrame, root: int) -> DataFrame:
    """``(owner, depth, ends_sha256)`` of the nodes at which a conversation ends."""
    lengths = steps.groupBy("conv_id").agg(F.max(F.struct("depth", "owner")).alias("last"))
    at = ids.join(lengths, "conv_id", "left").select(
        "conv_id", F.coalesce("last.owner", F.lit(root)).alias("owner"),
        F.coalesce("last.depth", F.lit(0).cast("long")).alias("depth"), F.floor(F.col("conv_id") / CHUNK).alias("chunk"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = at.groupBy(*NODE, "chunk").agg(joined.alias("ids"))
    return chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk").mapInArrow(_digest, ENDS)


def prefix_trie(conversations: DataFrame, small: int = SMALL) -> DataFrame:
    """One row a node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    turns, ids = rebuilt(conversations)
    counted = ids.agg(F.min("conv_id").alias("root"), F.count(F.lit(1)).alias("n")).first()
    root = counted["root"] if counted["n"] else 0
    steps = paths(turns, root)
    nodes = shared_table(nodes_of(steps))
    totals = subtree_totals(nodes, steps, small)
    rows = nodes.join(totals.withColumnRenamed("saved", "saved_tokens"), NODE).select(
        *NODE, F.col("prev").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), "saved_tokens")
    if counted["n"]:
        first = nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"),
                          F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
                          F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
        number = [F.lit(x).cast("long").alias(c) for x, c in
                  ((root, "owner"), (0, "depth"), (None, "parent_conv_id"), (counted["n"], "n_convs"))]
        rows = rows.union(first.select(*number, "n_children", "n_leaves", "saved_tokens"))
    nobody = hashlib.sha256(b"").hexdigest()
    return rows.join(ends(steps, ids, root), NODE, "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))
