"""Token-id files: ids ranked by frequency, coded in one to four bytes each, their lengths in separate control bytes.

A file is a sequence of frames. A frame holds whole documents and can be read on its own::

    magic b"TGF1" | documents u32 | symbols u32 | ids u64 | data bytes u64
    doc_id i64 per document | 1 if it has an id, else 0, u8 per document | ids u64 per document
    symbols u32: the frame's ids, most frequent first, ties by id
    control bytes: two bits per id, the lowest first, holding the bytes of its rank less one
    data: the ranks, little-endian, without leading zero bytes

Files are numbered in ascending order of doc_id (null first, repeated ids by text), and so are documents in them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegate.llm.store import attempt_name, bounded_batches, kept, new_folder, opened
from tablegate.llm.tokenizing import encoded

FRAME_IDS = 4_000_000  # a frame is closed when it has as many ids; one longer document is a frame of its own
MAGIC = b"TGF1"
_HEAD = struct.Struct("<4sIIQQ")
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1  # by control byte


def ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, most frequent first (ties by id), and each id's place among them."""
    if not len(ids):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    symbols = symbols[np.argsort(-counts[symbols], kind="stable")]
    places = np.zeros(len(counts), np.uint32)
    places[symbols] = np.arange(len(symbols), dtype=np.uint32)
    return symbols.astype(np.uint32), places[ids]


def pack_values(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    sizes = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = sizes - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    whole = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control, whole[np.arange(4) < sizes[:, None]]


def unpack_values(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The inverse of pack_values, by a table of the four lengths that each control byte stands for."""
    sizes = _LENGTHS[control].reshape(-1)[:n]
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    out = data[starts].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(sizes > k)
        out[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def frame(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One frame of whole documents."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    symbols, places = ranked(flat)
    control, data = pack_values(places)
    return b"".join(
        (
            _HEAD.pack(MAGIC, len(ids), len(symbols), len(flat), len(data)),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
            np.array([len(b) // 4 for b in ids], "<u8").tobytes(),
            symbols.astype("<u4").tobytes(),
            control.tobytes(),
            data.tobytes(),
        )
    )


def unframe(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, bounds of their ids, and all ids of a frame."""
    magic, docs, n_symbols, n, data_bytes = _HEAD.unpack_from(body)
    if magic != MAGIC:
        raise ValueError("not a token frame")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(body, kind, count, at)
        at += found.nbytes
        return found

    numbers, known, counts = take("<i8", docs), take("u1", docs), take("<u8", docs)
    symbols, control, data = take("<u4", n_symbols), take("u1", -(-n // 4)), take("u1", data_bytes)
    ids = symbols[unpack_values(control, data, n)] if n else np.empty(0, "<u4")
    bounds = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    return [int(d) if k else None for d, k in zip(numbers, known)], bounds, ids


FRAMES = "file_no int, path string, frame_no int, at long, n_bytes long, n_docs long, n_ids long"


def write(docs: DataFrame, vocabulary: str, end_id: int, folder: str) -> DataFrame:
    """Encode every whole text, end each with ``end_id``, write the files, and return their index, a row per frame.

    Null texts are empty and yield the end id alone. Only doc_id and text are looked at. An index row is the only
    thing that makes a file count, so files of lost or repeated attempts are never read.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, found = TaskContext.get().partitionId(), []
        path, out = "", None
        held_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> None:
            nonlocal out, path, size
            if out is None:
                path = attempt_name(folder, number, ".tgf")
                system, place = opened(path)
                out = system.open_output_stream(place)
            body = frame(held_ids, held)
            n = sum(map(len, held)) // 4
            found.append((number, path, len(found), sum(x[4] for x in found), len(body), len(held), n))
            out.write(body)
            held_ids.clear()
            held.clear()
            size = 0

        for batch in batches:
            numbers = batch.column(0).to_pylist()
            for number_, ids in zip(numbers, encoded(vocabulary, batch.column(1).to_pylist())):
                held_ids.append(number_)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= FRAME_IDS:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        if found:
            names = ["file_no", "path", "frame_no", "at", "n_bytes", "n_docs", "n_ids"]
            types = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    parts = max(1, rows.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    return kept(ordered.mapInArrow(run, FRAMES), "token-index")


def read(index: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the indexed files: doc_id, start (ids of all documents before), n_tokens, ids_crc32, ids if asked.

    ids is binary, little-endian unsigned 32-bit; the checksum is the unsigned crc32 of it. An empty index gives no rows.
    """
    files = index.groupBy("file_no").agg(F.sum("n_ids").alias("total"))  # as many rows as tasks wrote
    before_file = F.sum("total").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("file_no", F.coalesce(before_file, F.lit(0)).alias("before_file"))
    in_file = Window.partitionBy("file_no").orderBy("frame_no").rowsBetween(Window.unboundedPreceding, -1)
    frames = index.withColumn("before", F.coalesce(F.sum("n_ids").over(in_file), F.lit(0))).join(files, "file_no")
    frames = frames.select("path", "at", "n_bytes", (F.col("before") + F.col("before_file")).alias("before"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, n_bytes, before in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = opened(path)
                with system.open_input_file(place) as source:
                    doc_ids, bounds, ids = unframe(source.read_at(n_bytes, at))
                bodies = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                columns = [
                    pa.array(doc_ids, pa.int64()),
                    pa.array(bounds[:-1] + before),
                    pa.array(np.diff(bounds)),
                    pa.array([zlib.crc32(b) for b in bodies], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(bodies, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    # frames are a few MB each: deal them evenly, whatever the index's own partitions are
    dealt = frames.repartition(max(8, index.sparkSession.sparkContext.defaultParallelism * 4))
    return dealt.mapInArrow(run, schema)


def files_folder(spark: SparkSession) -> str:
    return new_folder(spark, "token-files")
