"""Best-fit packing by minimum bin slack: fill sequence after sequence with the fullest feasible set of lengths.

What a sequence can hold depends on lengths alone, so the plan is made on the histogram of lengths, which has at most
``capacity`` entries however many documents there are. Each step takes the largest length left, finds by subset-sum
dynamic programming over bitsets the fullest combination of the lengths left for the rest of the sequence, and removes
it as many times as the counts allow. Pieces of a length are interchangeable: the k-th piece of a length takes the
k-th place planned for it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches, kept
from tablegate.llm.tokenizing import encoded

CAPACITY = 2048
RANKED_TOGETHER = 1_000_000  # a length with more pieces is ranked in several groups

PIECES = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else capacity each but the first, which has the rest."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity
    starts = ([0] if first else []) + list(range(first, total, capacity))
    return list(zip(starts, np.diff([*starts, total]).tolist()))


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every whole document as token ids and its end id, cut where longer than a sequence.

    Null text is empty (the end id alone); a null doc_id stays null; repeated rows are documents of their own, told
    apart by ``copy``. Columns other than doc_id and text are not looked at. with_ids adds the ids (binary, u32).
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            numbers, copies = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for number, copy, ids in zip(numbers, copies, encoded(vocabulary, batch.column(1).to_pylist())):
                body = ids + end
                for k, (start, n) in enumerate(cut(len(body) // 4, capacity)):
                    part = body[4 * start : 4 * (start + n)]
                    out.append((number, copy, k, start, n, zlib.crc32(part), *([part] if with_ids else [])))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "copy", "piece", "start", "length", "ids_crc32", "ids"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names[: len(out[0])])

    return rows.mapInArrow(run, PIECES + ", ids binary" * with_ids)


def fullest(room: int, counts: dict[int, int]) -> list[tuple[int, int]]:
    """The (length, times) whose sum is the largest that fits the room, from lengths with counts; large ones first.

    Bit s of ``reach`` is set if some combination of the lengths looked at so far sums to s.
    """
    everything, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        steps.append((length, reach))
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            reach |= reach << (k * length) & everything
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        times = 0
        while not before >> total & 1:
            total -= length
            times += 1
        if times:
            chosen.append((length, times))
    return chosen


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """(sequences, [(length, times in each)]): minimum bin slack over the histogram of lengths."""
    left, steps = {k: v for k, v in histogram.items() if v}, []
    while left:
        largest = max(left)
        left[largest] -= 1
        if not left[largest]:
            del left[largest]
        chosen = dict(fullest(capacity - largest, left))
        left[largest] = left.get(largest, 0) + 1
        chosen[largest] = chosen.get(largest, 0) + 1
        sequences = min(left[x] // n for x, n in chosen.items())
        for x, n in chosen.items():
            left[x] -= n * sequences
            if not left[x]:
                del left[x]
        steps.append((sequences, sorted(chosen.items(), reverse=True)))
    return steps


def places(steps: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """A row per step and length: length, first rank, times, first sequence, offset; sorted by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for sequences, chosen in steps:
        offset = 0
        for length, times in chosen:
            rows.append((length, taken.get(length, 0), times, sequence, offset))
            taken[length] = taken.get(length, 0) + sequences * times
            offset += times * length
        sequence += sequences
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranks(df: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0; a length of very many is numbered in several groups."""
    counted = df.groupBy("length").agg(F.count("*").alias("n"))
    groups = F.ceil(F.max("n") / RANKED_TOGETHER).cast("int").alias("groups")
    most = counted.agg(groups).first()["groups"] or 1
    dealt = df.withColumn("salt", F.pmod(F.xxhash64("copy"), F.lit(most)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    offsets = offsets.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("copy", "piece")
    numbered = dealt.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(offsets, ["length", "salt"]).withColumn("rank", F.col("own") + F.col("before")).drop("salt", "own", "before")


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (which must be a table that reads the same each time, not a plan).

    Every sequence is filled from 0 without gaps up to at most ``capacity``. No pieces, no sequences.
    """
    histogram = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(plan(histogram, capacity))  # bounded by the capacity, not by the documents
    wide = 1 << 44
    keys = table[:, 0] * wide + table[:, 1] if len(table) else np.empty(0, np.int64)

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length, rank):
        import pandas as pd

        row = table[np.searchsorted(keys, length.to_numpy() * wide + rank.to_numpy(), "right") - 1]
        within = rank.to_numpy() - row[:, 1]
        return pd.DataFrame(
            {"sequence_id": row[:, 3] + within // row[:, 2], "offset": row[:, 4] + within % row[:, 2] * row[:, 0]}
        )

    numbered = ranks(cut_pieces).withColumn("place", placed("length", "rank"))
    return numbered.select(*cut_pieces.columns, "place.sequence_id", "place.offset")


def packed(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Documents as placed pieces: pieces, kept once in the shared folder, then pack."""
    return pack(kept(pieces(docs, vocabulary, end_id, capacity, with_ids), "pieces"), capacity)
