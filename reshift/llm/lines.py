"""Line deduplication over levelled sorted runs of line hashes; DataFrame functions only.

A line's key is the line without white space at its ends, with A-Z lower-cased. A key of at least
``MIN_LENGTH`` code points that ``MIN_DOCS`` documents or more hold loses all its lines except those of
the largest ``doc_id`` that holds it.

Documents come in batches of falling ``doc_id``, as an ingestion job would add them. The state is a list
of runs: bucketed tables of key hashes, sorted inside each bucket, each hash in one run only, with the
``doc_id`` that keeps its line. A batch hashes its lines once, counts them by key (partial aggregates,
so a line that a third of all documents share leaves each task once) and merge-anti-joins the runs: what
no run holds becomes its own run, and since ids fall, the batch's largest id is the keeper; what a run
holds already is noted beside it as a count of further documents. ``FANOUT`` runs of a level are
compacted into one of the next, so that a batch meets few runs whatever their number. Runs and batches
share one bucketing: the join moves no run over the network. Single lines, the bulk of a corpus, meet
no later aggregate: only counts of repeated keys are added up in the end. The positions to drop are
found by joining the hashed lines with the heavy keys (an inner join that adaptive execution splits
where a key is hot) and each text is cut in one pass.

Hashes are 128 bits, two xxhash64 of different seeds. No step holds a group in memory: what is collected
is the list of line numbers of one document.

Defined cases: a null text is one empty line and comes out empty. Every row is a document: repeated rows
count each, and all rows of the largest ``doc_id`` keep the line. A null ``doc_id`` is less than every
other; rows without id are one such id. An empty table gives an empty one. Other columns pass through,
whatever their names. The runs stay in the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import bind, free_name, shared_folder, shared_table

MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 6
FANOUT = 3

ENDS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ("h1", "h2")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; text of ASCII alone takes the faster function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def long_lines(text: Column, min_length: int) -> Column:
    """The lines with a key, ordered by hash: structs of h1, h2, position, and whether the key is new in the text."""
    trimmed = F.transform(split_lines(text), lambda line, i: F.struct(
        F.btrim(line, F.lit(ENDS)).alias("line"), i.alias("pos")))
    hashed = F.transform(F.filter(trimmed, lambda x: F.length(x["line"]) >= min_length), lambda x: bind(
        lower_ascii(x["line"]), lambda key: F.struct(
            F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), x["pos"].alias("pos"))))

    def flagged(found: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            last = F.get(found, i - 1)
            again = F.coalesce((last["h1"] == x["h1"]) & (last["h2"] == x["h2"]), F.lit(False))
            return F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"), (~again).alias("first"))
        return F.transform(found, one)

    return bind(F.array_sort(hashed), flagged)


def hashed_lines(docs: DataFrame, min_length: int, batches: int) -> DataFrame:
    """``(doc_id, stamp, lines, batch)`` of every document that has lines with a key, written by batch."""
    shares = [i / batches for i in range(1, batches)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else None
    # the largest ids come first; any bounds give the same result
    batch = sum((F.coalesce(F.col("doc_id") <= b, F.lit(True)).cast("int") for b in sorted(set(bounds or []))), F.lit(0))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("stamp"),
                       long_lines(F.col("text"), min_length).alias("lines"), batch.alias("batch"))
    return shared_table(rows.where(F.size("lines") > 0), partition_by=("batch",))


class Runs:
    """Levels of sorted runs: disjoint sets of key hashes with their keepers, in one bucketing."""

    def __init__(self, spark, buckets: int, fanout: int):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[DataFrame]] = []
        self.repeats: list[DataFrame] = []
        self.tables: list[str] = []

    def add(self, batch: DataFrame) -> None:
        """Merge-anti-join ``(h1, h2, docs, keeper)``, one row a key, with all runs, and add its own run."""
        marks = []
        for run in (run for level in self.levels for run in level):
            mark = f"mark{len(marks)}"
            batch = batch.join(run.select(*KEY, F.lit(True).alias(mark)).hint("merge"), list(KEY), "left")
            marks.append(mark)
        known = F.coalesce(*marks, F.lit(False)) if marks else F.lit(False)
        written = self._write(batch.select(*KEY, "docs", "keeper", known.alias("known")))
        self.repeats.append(written.where("known").select(*KEY, "docs"))
        self._push(0, written.where("NOT known").drop("known"))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = reduce(DataFrame.union, self.levels[level]).repartition(self.buckets, *KEY)
            self.levels[level] = []
            self._push(level + 1, self._write(merged))

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"reshift_run_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").option("path", f"{shared_folder(self.spark)}/{name}")
        if "known" in rows.columns:
            writer = writer.partitionBy("known")
        writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    def heavy(self, min_docs: int) -> DataFrame:
        """``(h1, h2, keeper)`` of the keys that ``min_docs`` documents or more hold, written."""
        more = reduce(DataFrame.union, self.repeats).groupBy(*KEY).agg(F.sum("docs").alias("more"))
        runs = reduce(DataFrame.union, [run for level in self.levels for run in level])
        found = (runs.join(more, list(KEY), "left")
                 .where(F.col("docs") + F.coalesce("more", F.lit(0)) >= min_docs).select(*KEY, "keeper"))
        return shared_table(found)

    def forget(self) -> None:
        """Take the runs' names out of the catalog; their files stay."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def heavy_keys(lines: DataFrame, min_docs: int, batches: int, fanout: int) -> DataFrame:
    spark = lines.sparkSession
    runs = Runs(spark, int(spark.conf.get("spark.sql.shuffle.partitions")), fanout)
    try:
        for b in range(batches):
            firsts = (lines.where(F.col("batch") == b).select("doc_id", F.explode("lines").alias("line"))
                      .where("line.first").select("doc_id", "line.h1", "line.h2"))
            runs.add(firsts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keeper")))
        return runs.heavy(min_docs)
    finally:
        runs.forget()


def drop_repeated_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS,
                        batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with repeated lines cut out of ``text``, and ``n_lines`` (before) and ``n_dropped`` in ``line_dedup``."""
    if min(min_docs, batches) < 1 or fanout < 2:
        raise ValueError("min_docs and batches must be at least 1, fanout at least 2")
    lines = hashed_lines(docs, min_length, batches)
    heavy = heavy_keys(lines, min_docs, batches, fanout)
    dropped = (lines.select("doc_id", "stamp", F.explode("lines").alias("line"))
               .select("doc_id", "stamp", "line.h1", "line.h2", "line.pos").join(heavy, list(KEY))
               .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
               .groupBy("doc_id", "stamp").agg(F.collect_set("pos").alias("dropped")))
    # equal id and text: equal positions, so repeated rows need no key of their own
    wanted, mine, cut = (free_name(docs, x) for x in ("cut_id", "cut_stamp", "cut"))
    named = dropped.select(F.col("doc_id").alias(wanted), F.col("stamp").alias(mine), F.col("dropped").alias(cut))
    met = docs.join(named, F.col("doc_id").eqNullSafe(F.col(wanted))
                    & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col(mine)), "left")

    def kept(all_lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col(cut))
        return F.array_join(F.transform(stay, lambda p: F.get(all_lines, p)), "\n")

    counts = F.struct(F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
                      F.coalesce(F.size(cut), F.lit(0)).cast("long").alias("n_dropped"))
    text = F.when(F.col(cut).isNull(), F.coalesce("text", F.lit(""))).otherwise(bind(split_lines(F.col("text")), kept))
    return met.select(*[text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns],
                      counts.alias(free_name(docs, "line_dedup")))
