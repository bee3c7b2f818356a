"""Operator 8: documents as token ids in a compressed, checksummed binary file.

A file is a Parquet table of segments, in ascending document order; a segment is one binary value:

    magic "RTS2" | vocabulary, documents, blocks: uint32 | ids: uint64
    per document: id int64, null mark uint8, ids uint32
    per block: ids uint32, bytes uint32, CRC-32 of the ids uint32
    the coded blocks

A segment holds whole documents up to about ``SEGMENT_IDS`` ids; its blocks are coded independently by
``coder``, and a block whose ids do not match its checksum is reported with its place. Reading needs
one segment at a time, so memory does not grow with the file. Parquet is the container because Spark's
committed writes survive lost executors and work on any file system of the cluster.

Ascending order comes from a range partitioning by ``doc_id`` and, among equal ids, by a hash of the text,
which also splits the rows of a hot id. The number of ids before a document adds up counts per task and
per segment; no text or id list passes the driver.

Defined cases: null or empty text is the end id alone; documents with a null ``doc_id`` come first;
repeated rows are stored each; an empty table makes an empty file; other columns are not stored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reshift.llm import coder
from reshift.llm.common import shared_table, slices
from reshift.llm.vocab import BYTE_BPE, BYTES_A_CALL, encoder

END_ID = 0
SEGMENT_IDS = coder.BLOCK * coder.LANES
MAGIC = b"RTS2"
HEAD = "<4sIIIQ"
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("ids", "<u4")])
BLOCK_ENTRY = np.dtype([("ids", "<u4"), ("bytes", "<u4"), ("crc", "<u4")])

SEGMENTS = "task int, turn int, n_ids long, data binary"


class DamagedBlock(ValueError):
    """A block's ids do not match its checksum."""


def pack_segment(doc_ids: list[int | None], raws: list[bytes], vocabulary: int) -> bytes:
    """One segment of documents given by their ids as little-endian uint32 bytes."""
    documents = np.zeros(len(doc_ids), DOCUMENT)
    documents["id"] = [d or 0 for d in doc_ids]
    documents["null"] = [d is None for d in doc_ids]
    documents["ids"] = [len(r) // 4 for r in raws]
    ids = np.frombuffer(b"".join(raws), "<u4").astype(np.int64)
    blocks = [ids[i:i + coder.BLOCK] for i in range(0, len(ids), coder.BLOCK)]
    coded = [c for at in range(0, len(blocks), coder.LANES)
             for c in coder.encode_blocks(blocks[at:at + coder.LANES], vocabulary)]
    entries = np.zeros(len(blocks), BLOCK_ENTRY)
    entries["ids"] = [len(b) for b in blocks]
    entries["bytes"] = [len(c) for c in coded]
    entries["crc"] = [coder.checksum(b) for b in blocks]
    head = struct.pack(HEAD, MAGIC, vocabulary, len(documents), len(blocks), len(ids))
    return b"".join((head, documents.tobytes(), entries.tobytes(), *coded))


def unpack_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The documents' entries and all ids of a segment; raises ``DamagedBlock``."""
    magic, vocabulary, n_documents, n_blocks, n_ids = struct.unpack_from(HEAD, data)
    if magic != MAGIC:
        raise DamagedBlock("not a segment")
    at = struct.calcsize(HEAD)
    documents = np.frombuffer(data, DOCUMENT, n_documents, at)
    at += documents.nbytes
    entries = np.frombuffer(data, BLOCK_ENTRY, n_blocks, at)
    at += entries.nbytes
    ends = at + np.cumsum(entries["bytes"].astype(np.int64))
    coded = [data[e - n:e] for e, n in zip(ends.tolist(), entries["bytes"].tolist())]
    lengths = entries["ids"].tolist()
    blocks = [b for i in range(0, n_blocks, coder.LANES)
              for b in coder.decode_blocks(coded[i:i + coder.LANES], lengths[i:i + coder.LANES], vocabulary)]
    for place, (block, crc) in enumerate(zip(blocks, entries["crc"].tolist())):
        if coder.checksum(block) != crc:
            raise DamagedBlock(f"block {place} of {n_blocks}")
    ids = np.concatenate(blocks) if blocks else np.zeros(0, np.uint32)
    if len(ids) != n_ids:
        raise DamagedBlock(f"{len(ids)} ids instead of {n_ids}")
    return documents, ids


def _write(vocabulary: str):
    def run(batches):
        words = encoder(vocabulary)
        size = words.library.get_vocab_size(with_added_tokens=True)
        task, turn = TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u4").tobytes()
        doc_ids: list[int | None] = []
        raws: list[bytes] = []
        held = 0

        def flush():
            nonlocal turn, doc_ids, raws, held
            data = pack_segment(doc_ids, raws, size)
            columns = [pa.array([task], pa.int32()), pa.array([turn], pa.int32()),
                       pa.array([held], pa.int64()), pa.array([data], pa.binary())]
            turn, doc_ids, raws, held = turn + 1, [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=["task", "turn", "n_ids", "data"])

        for batch in batches:
            for some in slices(batch, 1, most_bytes=BYTES_A_CALL):
                for doc, raw in zip(some.column(0).to_pylist(), words.encode(some.column(1))):
                    doc_ids.append(doc)
                    raws.append(raw + end)
                    held += len(raw) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
        if doc_ids:
            yield flush()

    return run


def segments(docs: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """The segments of a file, numbered by task and turn in ascending ``doc_id`` order."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_write(vocabulary), SEGMENTS)


def write(docs: DataFrame, path: str, vocabulary: str = BYTE_BPE) -> None:
    """Write the documents' ids to ``path``."""
    segments(docs, vocabulary).write.parquet(path)


READ = "task int, turn int, doc_id long, before long, n_tokens long, ids binary"
SUMS = "task int, turn int, doc_id long, before long, n_tokens long, ids_crc32 long"


def _read(digest: bool):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                task, turn, data = (batch.column(c)[row].as_py() for c in ("task", "turn", "data"))
                documents, ids = unpack_segment(data)
                lengths = documents["ids"].astype(np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[e - n:e] for e, n in zip(ends.tolist(), lengths.tolist())]
                n = len(documents)
                last = pa.array([coder.checksum(p) for p in parts], pa.int64()) if digest \
                    else pa.array([p.astype("<u4").tobytes() for p in parts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task] * n, pa.int32()), pa.array([turn] * n, pa.int32()),
                     pa.array(documents["id"], pa.int64(), mask=documents["null"] > 0),
                     pa.array(ends - lengths), pa.array(lengths), last],
                    names=["task", "turn", "doc_id", "before", "n_tokens", "ids_crc32" if digest else "ids"])

    return run


def _starts(parts: DataFrame) -> DataFrame:
    """``(task, turn, base)``: the ids before each segment."""
    def running(keys: list[str], by: str):
        return F.coalesce(F.sum("n_ids").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))

    # one row per task of the writing job, then the segments of each task
    tasks = parts.groupBy("task").agg(F.sum("n_ids").alias("n_ids"))
    tasks = tasks.select("task", running([], "task").alias("earlier"))
    inside = parts.select("task", "turn", running(["task"], "turn").alias("within"))
    return inside.join(tasks, "task").select("task", "turn", (F.col("earlier") + F.col("within")).alias("base"))


def read(file: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens`` and the ids (or their CRC-32) of every document of a file's segments."""
    rows = file.select("task", "turn", "data").mapInArrow(_read(digest), SUMS if digest else READ)
    starts = _starts(file.select("task", "turn", "n_ids"))
    return rows.join(starts, ["task", "turn"]).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32" if digest else "ids")


def round_trip(docs: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Write the documents to a file in the shared folder and read their digests back."""
    return read(shared_table(segments(docs, vocabulary)), digest=True)
