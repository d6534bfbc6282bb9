"""Importance resampling towards a target distribution, over hashed word n-grams counted by distinct lines.

A text's features are all runs of one to three consecutive words, each in the bucket its crc32 says. Most of what a corpus
repeats it repeats by the line, so texts are cut at newlines, which no word holds:

* The n-grams inside a line are found once for each distinct line. Corpus counts take them times the line's occurrences;
  a line's sum of gains is taken once and joined to its occurrences by the line's 128-bit digest.
* The n-grams that stand across a line's end belong to no line. They are found in whole texts and added to both.

A bucket's gain says by how much the target prefers it over the corpus. A document's score is the sum of its features'
gains plus a Gumbel-distributed number from its id; the highest scores are a sample without replacement in which a
document's chance follows its weight.

Lines joined to their occurrences are cut in two: at most 10,000 distinct lines can each make up a ten-thousandth of all
lines, and these are broadcast; the others meet in a shuffle in which no line is heavy. Ranks come from a distributed
sort, of which only the number of rows of each part goes to the driver.

Null and empty texts have no features: weight 0. Every row is a document of its own, whether its id is null (the last among
equal scores; its number is that of an empty id) or shared. Only doc_id and text are looked at. An empty table gives no
rows; an empty target prefers nothing in particular.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.crc import joined, span_crcs
from tablegate.llm.store import bounded_batches, kept
from tablegate.llm.text import LOWER, buffers, chunks, runs

BUCKETS = 10_000
HOT_SHARE = 10_000  # a line is hot if it makes up one of so many lines; there are at most as many
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
_SPACE = span_crcs(np.array([32], np.uint8), np.array([0]), np.array([1]))[0]
_WORD = np.ones(256, bool)  # bytes of a word once A-Z are lower case: digits, letters, all beyond ASCII
_WORD[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
HAS_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"


class Grams:
    """Words of some texts and the buckets of their n-grams."""

    def __init__(self, column: pa.Array, buckets: int = BUCKETS) -> None:
        data, self.offsets = buffers(column)
        self.data = LOWER[data]
        self.starts, self.ends = runs(_WORD[self.data], self.offsets)
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.last = np.repeat(self.bounds[1:], np.diff(self.bounds))  # where the text of each word ends
        self.buckets = buckets

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Buckets of the n-grams of ``size`` words from word ``start`` on."""
        used = np.zeros(len(self.starts) + 3, bool)
        for k in range(3):
            used[start[size > k] + k] = True
        place = np.cumsum(used) - 1
        words = np.flatnonzero(used)
        crcs, lengths = span_crcs(self.data, self.starts[words], self.ends[words]), self.ends[words] - self.starts[words]
        spaced = joined(np.full(len(words), _SPACE), crcs, lengths)  # a space and the word
        at = place[start]
        out = crcs[at] if len(at) else np.empty(0, np.uint32)
        for k in (1, 2):
            longer = np.flatnonzero(size > k)
            next_ = place[start[longer] + k]
            out[longer] = joined(out[longer], spaced[next_], lengths[next_] + 1)
        return (out % np.uint32(self.buckets)).astype(np.uint16 if self.buckets <= 1 << 16 else np.uint32)

    def inside(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all n-grams of each text, one text after the other, and the n + 1 bounds of each text's."""
        room = np.minimum(self.last - np.arange(len(self.starts)), 3)  # n-grams that begin with each word
        start = np.repeat(np.arange(len(room)), room)
        upto = np.concatenate([[0], np.cumsum(room)])
        size = np.arange(len(start)) - upto[start] + 1
        return self.of(start, size), upto[self.bounds]

    def across(self) -> tuple[np.ndarray, np.ndarray]:
        """The same of the n-grams that stand across a newline."""
        n = len(self.starts)
        line = np.searchsorted(np.flatnonzero(self.data == 10), self.starts)
        parts = []
        for size in (2, 3):
            start = np.arange(max(0, n - size + 1))
            start = start[(start + size <= self.last[start]) & (line[start + size - 1] > line[start])]
            parts.append(np.column_stack([start, np.full(len(start), size)]))
        found = np.concatenate(parts)
        found = found[np.argsort(found[:, 0], kind="stable")]
        return self.of(found[:, 0], found[:, 1]), np.searchsorted(found[:, 0], self.bounds)


def _binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    at = pa.py_buffer(bounds.astype(np.int64) * values.itemsize)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(column)
    return np.frombuffer(data.tobytes(), np.uint16), offsets // 2


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(key, occurrences, features): every distinct line with a word, and the buckets of the n-grams inside it, found once."""
    line = F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line")
    counted = docs.select(line).filter(F.col("line").rlike(HAS_WORD)).groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "line"):
            columns = [piece.column(1), piece.column(2), _binary(*Grams(piece.column(0)).inside())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "occurrences", "features"])

    keyed = bounded_batches(counted.select("line", F.unhex(F.md5("line")).alias("key"), "occurrences"))
    return kept(keyed.mapInArrow(run, "key binary, occurrences long, features binary"), "lines", compression="zstd")


def outlines(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, features, keys) of every document: n-grams across lines, and the digests of its lines."""
    keys = F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike(HAS_WORD)), lambda x: F.unhex(F.md5(x)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = bounded_batches(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", keys.alias("keys")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            grams = Grams(piece.column(2))
            columns = [piece.column(0), piece.column(1), pa.array(np.diff(grams.bounds)), _binary(*grams.across()), piece.column(3)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "features", "keys"])

    return kept(rows.mapInArrow(run, "row long, doc_id long, n_words long, features binary, keys array<binary>"), "outlines")


def bucket_counts(features: DataFrame) -> dict[int, int]:
    """How often each bucket occurs, of rows (features, times); a task adds up its own, and there are BUCKETS at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            values, bounds = _unpacked(batch.column(0))
            times = np.repeat(batch.column(1).to_numpy(), np.diff(bounds))
            for once in (True, False):  # weights are summed in floating point, which is exact for a batch
                own = times == 1
                counts += np.bincount(values[own], minlength=BUCKETS) if once else np.bincount(values[~own], times[~own], BUCKETS).astype(np.int64)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    found = features.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r.bucket: r.n for r in found.collect()}


def target_counts(target: DataFrame) -> dict[int, int]:
    """How often each bucket occurs in whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            columns = [_binary(*Grams(piece.column(0)).inside()), pa.array(np.ones(len(piece), np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["features", "times"])

    texts = bounded_batches(target.select(F.col("text").cast("string").alias("text")))
    return bucket_counts(texts.mapInArrow(run, "features binary, times long"))


def gains(corpus: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """Per bucket floor(1000 ln of the target's smoothed share over the corpus's)."""
    s_all, t_all = sum(corpus.values()) + BUCKETS, sum(target.values()) + BUCKETS
    ratio = lambda b: (target.get(b, 0) + 1) * s_all / ((corpus.get(b, 0) + 1) * t_all)
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(BUCKETS)], np.int64)


def _weighed(df: DataFrame, names: str, gain: np.ndarray) -> DataFrame:
    """The columns of df, of which the last is ``features``, with that replaced by the sum of its gains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = _unpacked(batch.column(batch.num_columns - 1))
            sums = np.concatenate([[0], np.cumsum(gain[values])])
            weight = pa.array(sums[bounds[1:]] - sums[bounds[:-1]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], weight], [*batch.schema.names[:-1], "weight"])

    return df.mapInArrow(run, f"{names}, weight long")


def weights(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, weight) of every document."""
    lines, outline = distinct_lines(docs), outlines(docs)
    counted = lines.select("features", F.col("occurrences").alias("times")).unionAll(outline.select("features", F.lit(1).cast("long").alias("times")))
    gain = gains(bucket_counts(counted), target_counts(target))
    own = "row long, doc_id long, n_words long"
    parts = _weighed(outline.select("row", "doc_id", "n_words", "features"), own, gain)
    # The condition names the hot lines alone, so their number is bounded by HOT_SHARE and they may be broadcast.
    total = lines.agg(F.sum("occurrences")).first()[0] or 0
    is_hot = F.col("occurrences") * HOT_SHARE >= total
    hot = F.broadcast(_weighed(lines.filter(is_hot).select("key", "features"), "key binary", gain))
    cold = _weighed(lines.filter(~is_hot).select("key", "features"), "key binary", gain)
    stands = outline.select("row", "doc_id", "n_words", F.explode("keys").alias("key"))
    names = ["row", "doc_id", "n_words", "weight"]
    common = stands.join(hot, "key").select(names)
    rest = stands.join(hot.select("key"), "key", "left_anti").join(cold, "key").select(names)
    every = parts.unionAll(common).unionAll(rest)
    return every.groupBy("row", "doc_id", "n_words").agg(F.sum("weight").alias("weight"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    Drawn are the highest-scoring ``percent`` of the documents with at least ``least_words`` words, rounded down.
    """
    spark = docs.sparkSession
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(label, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    n = F.col("n_words")
    n_features = F.greatest(n, F.lit(0)) + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))
    scored = weights(docs, target).select("row", "doc_id", n_features.alias("n_features"), "weight", (F.col("weight") + noise).alias("score"), (n >= least_words).alias("takes_part"))
    scored = kept(scored, "scored")
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.desc("takes_part"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    placed = scored.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number has the part in its upper bits and the place in the part in the lower 33.
    placed = kept(placed.withColumn("number", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("number", 33)
    sizes = {r.part: (r.rows, r.taking) for r in placed.groupBy(part.alias("part")).agg(F.count("row").alias("rows"), F.count_if("takes_part").alias("taking")).collect()}
    before, so_far = [], 0
    for p in range(max(sizes, default=-1) + 1):
        before.append(so_far)
        so_far += sizes.get(p, (0, 0))[0]
    drawn = percent * sum(t for _, t in sizes.values()) // 100
    rank = F.get(F.lit(before or [0]).cast("array<bigint>"), part.cast("int")) + F.col("number").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    rank = F.when(F.col("takes_part") & (rank <= drawn), rank).cast("long").alias("rank")
    return placed.select("doc_id", "n_features", "weight", "score", rank)
