"""Ranked lexical search: exact top-k by postings in geometric blocks with coordinatewise-maximum summaries.

Documents are scored as sparse vectors over the queries' terms, a coordinate being the term's weight times its saturated
frequency; a query's score is the sum over its own terms. The search is exact:

1. The forward index: per document its length and the terms it shares with the queries, with their frequencies. Corpus
   counts (documents, lengths, documents per term) are aggregates over all of it.
2. A task takes the forward index in shards of bounded postings and inverts each. A term's posting list is clustered by
   document similarity: documents go to the nearest of some members of the list, in a random projection of their vectors.
   Clusters are cut into blocks, and a block's summary has the largest value of each coordinate that a query with this
   term can ask for. Blocks of a list are made when a query first needs them.
3. A query goes through its lists from the highest maximum down. It leaves off where the maxima of what is left sum up to
   less than its k-th best score, skips each block whose summary does so, and scores the documents of the others in full,
   those with the highest bounds first. The k best so far stay from shard to shard of a task.
4. The best of the tasks are merged, by parts first.

Bounds are sums of integers, not estimates, and a block is skipped only if its bound is less than a score that is held; a
bound equal to it is looked into, as ties go by id. Queries are taken in blocks of a bounded number of terms.

Null texts have no term; items without one have no rows. Every row is a document, or an item, of its own, whether its id
is null (the last among equal scores) or shared. Only doc_id, item_id and text are looked at. Terms are compared by 64-bit
hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches, kept
from tablegate.llm.text import buffers, chunks, random_words, runs, span_hashes

TOP = 50
SHARD_POSTINGS = 1_000_000  # postings that a task inverts at a time
BLOCK_TERMS = 50_000  # terms of the queries that are searched together
SUMMARY_BYTES = 256 << 20  # of the summaries that a task remembers
BLOCK_DOCS = 64  # documents of a block, at most
SKETCH = 24  # dimensions of the random projection by which lists are clustered
_WORD = np.ones(256, bool)  # bytes of a term: digits, letters, all beyond ASCII
_WORD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_NOBODY = np.iinfo(np.int64).max


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of each text, one text after the other, and the n + 1 bounds of each text's."""
    data, offsets = buffers(column)
    starts, ends = runs(_WORD[data], offsets)
    return span_hashes(data, starts, ends, lower=True), np.searchsorted(starts, offsets)


@dataclass
class Queries:
    """Items by number, and their terms: sorted hashes, and for each item the places of its own among them."""

    ids: list[int | None] = field(default_factory=list)
    vocabulary: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    items: list[np.ndarray] = field(default_factory=list)


def query_blocks(queries: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Queries]:
    """The items a block at a time, as they come: with so many terms in all, or one item."""

    def closed(held: list[tuple[int | None, np.ndarray]]) -> Queries:
        vocabulary = np.unique(np.concatenate([h for _, h in held]))
        return Queries([i for i, _ in held], vocabulary, [np.searchsorted(vocabulary, h) for _, h in held])

    held: list[tuple[int | None, np.ndarray]] = []
    size = 0
    for r in queries.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        own = np.unique(terms(pa.array([r.text or ""]))[0])
        if not len(own):
            continue
        if held and size + len(own) > block_terms:
            yield closed(held)
            held, size = [], 0
        held.append((r.item_id, own))
        size += len(own)
    if held:
        yield closed(held)


FORWARD = "doc_id long, n long, term binary, tf binary"


def forward_index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, term, tf) of every document with a term: its length, and the places in the vocabulary of the terms it
    has of that, ascending, with their frequencies; both are little-endian 32-bit integers."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            found, bounds = terms(piece.column(1))
            n = np.diff(bounds)
            place = np.minimum(np.searchsorted(vocabulary, found), max(0, len(vocabulary) - 1))
            known = np.flatnonzero(vocabulary[place] == found)
            doc = np.repeat(np.arange(len(n)), n)[known]
            pair, tf = np.unique(doc.astype(np.int64) << 32 | place[known], return_counts=True)
            ends = np.searchsorted(pair, np.arange(len(n) + 1, dtype=np.int64) << 32)
            held = np.flatnonzero(n)
            term, tf = (pair & 0xFFFFFFFF).astype("<i4"), tf.astype("<i4")
            columns = [piece.column(0).take(pa.array(held)), pa.array(n[held])]
            for values in (term, tf):
                columns.append(pa.array([values[ends[i] : ends[i + 1]].tobytes() for i in held], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "term", "tf"])

    return kept(bounded_batches(rows).mapInArrow(run, FORWARD), "forward-index")


@dataclass(frozen=True)
class Statistics:
    """Documents with a term, all their terms, and the weight of each term of the vocabulary."""

    documents: int
    length: int
    weights: np.ndarray

    def values(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The coordinates of documents of n terms: weight times saturated frequency, in integers."""
        m = 100 - 50 + (50 * self.documents * n) // self.length
        return self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def statistics(index: DataFrame, size: int) -> Statistics:
    """Counts over the whole index; of the terms, as many rows as the vocabulary of the block has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(buffers(batch.column(0))[0].tobytes(), "<i4"), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], ["term", "df"])

    whole = index.agg(F.count("n").alias("documents"), F.sum("n").alias("length")).first()
    counts = index.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r.term: r.df for r in counts.collect()}
    weights = [math.floor(1000 * math.log((2 * whole.documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)]
    return Statistics(whole.documents, whole.length or 1, np.array(weights, np.int64))


@dataclass
class Blocks:
    """A term's posting list in blocks: documents by block, their bounds, and the summaries of the coordinates asked for."""

    docs: np.ndarray
    bounds: np.ndarray
    column: np.ndarray  # of each coordinate in the summaries, -1 for those nobody asks for
    summaries: np.ndarray


class Shard:
    """Some documents, inverted."""

    def __init__(
        self, doc_ids: np.ndarray, known: np.ndarray, starts: np.ndarray, term: np.ndarray, value: np.ndarray, asked: dict[int, np.ndarray], size: int, block_docs: int = BLOCK_DOCS
    ) -> None:
        self.doc_ids, self.known, self.starts, self.term, self.value = doc_ids, known, starts, term, value
        self.asked, self.size, self.block_docs = asked, size, block_docs
        doc = np.repeat(np.arange(len(doc_ids)), np.diff(starts))
        order = np.argsort(term, kind="stable")
        self.posted, self.list_bounds = doc[order], np.searchsorted(term[order], np.arange(size + 1))
        self.maxima = np.zeros(size, np.int64)
        filled = np.flatnonzero(np.diff(self.list_bounds))
        if len(filled):
            self.maxima[filled] = np.maximum.reduceat(value[order], self.list_bounds[filled])
        self.sketches: np.ndarray | None = None
        self.made: dict[int, Blocks] = {}
        self.summary_bytes = 0

    def _sketched(self) -> np.ndarray:
        """Documents as unit vectors of a random projection, in which near ones stay near."""
        if self.sketches is None:
            axes = random_words(41, self.size)[:, None] >> np.arange(SKETCH, dtype=np.uint64) & np.uint64(1)
            signed = (axes.astype(np.float32) * 2 - 1)[self.term] * self.value[:, None].astype(np.float32)
            sums = np.zeros((len(self.doc_ids), SKETCH), np.float32)
            filled = np.flatnonzero(np.diff(self.starts))
            if len(filled):
                sums[filled] = np.add.reduceat(signed, self.starts[filled], axis=0)
            self.sketches = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return self.sketches

    def _entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the coordinates of some documents, one document after the other, and where each one's start."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        ends = np.cumsum(sizes)
        first = ends - sizes
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[docs] - first, sizes), first

    def blocks(self, term: int) -> Blocks:
        if term not in self.made:
            docs = self.posted[self.list_bounds[term] : self.list_bounds[term + 1]]
            centres = max(1, len(docs) // self.block_docs)
            sketch = self._sketched()[docs]
            near = (sketch @ sketch[:: max(1, len(docs) // centres)][:centres].T).argmax(1)
            order = np.argsort(near, kind="stable")
            docs, near = docs[order], near[order]
            place = np.arange(len(docs)) - np.searchsorted(near, near)
            new = place % self.block_docs == 0  # each cluster begins a block, and so do its documents from time to time
            block = np.cumsum(new) - 1
            column = np.full(self.size, -1, np.int32)
            column[self.asked[term]] = np.arange(len(self.asked[term]))
            at, _ = self._entries(docs)
            row = np.repeat(block, self.starts[docs + 1] - self.starts[docs])
            own = column[self.term[at]]
            summaries = np.zeros((block[-1] + 1, len(self.asked[term])), np.int64)
            np.maximum.at(summaries.reshape(-1), (row * summaries.shape[1] + own)[own >= 0], self.value[at[own >= 0]])
            if self.summary_bytes > SUMMARY_BYTES:  # made again when a query needs them
                self.made, self.summary_bytes = {}, 0
            self.made[term] = Blocks(docs, np.append(np.flatnonzero(new), len(docs)), column, summaries)
            self.summary_bytes += summaries.nbytes + column.nbytes
        return self.made[term]

    def search(self, items: np.ndarray, best: Best) -> None:
        """Offer a query, the places of its terms, every document that can be among its best."""
        present = items[self.maxima[items] > 0]
        present = present[np.argsort(-self.maxima[present], kind="stable")]
        left = np.cumsum(self.maxima[present][::-1])[::-1]  # what lists from here on can add up to
        mine = np.zeros(self.size, bool)
        mine[items] = True
        seen = np.zeros(len(self.doc_ids), bool)
        for term, most in zip(present, left):
            if most < best.least:
                break
            own = self.blocks(int(term))
            bound = own.summaries[:, own.column[present]].sum(1)
            waiting = np.flatnonzero(bound >= best.least)
            waiting = waiting[np.argsort(-bound[waiting], kind="stable")]
            step = 2
            while len(waiting):
                now, waiting = waiting[:step], waiting[step:]
                docs = np.concatenate([own.docs[own.bounds[b] : own.bounds[b + 1]] for b in now])
                docs = docs[~seen[docs]]
                seen[docs] = True
                at, first = self._entries(docs)
                if len(docs):
                    scores = np.add.reduceat(np.where(mine[self.term[at]], self.value[at], 0), first)
                    best.offer(scores, self.doc_ids[docs], self.known[docs])
                waiting = waiting[bound[waiting] >= best.least]
                step *= 2


class Best:
    """The k best documents a query has met: highest scores above 0, then smallest ids, null ids last."""

    def __init__(self, k: int) -> None:
        self.k, self.least = k, 1  # what scores less can't be among them
        self.scores, self.ids, self.known = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        good = scores >= self.least
        scores, ids, known = (np.concatenate(x) for x in ((self.scores, scores[good]), (self.ids, ids[good]), (self.known, known[good])))
        order = np.lexsort((ids, ~known, -scores))[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]
        if len(order) == self.k:
            self.least = int(self.scores[-1])


def _shards(
    batches: Iterator[pa.RecordBatch], told: Statistics, asked: dict[int, np.ndarray], postings: int = SHARD_POSTINGS, block_docs: int = BLOCK_DOCS
) -> Iterator[Shard]:
    """A task's part of the forward index, so many postings at a time, or a document."""
    size = len(told.weights)

    def inverted(parts: list[tuple]) -> Shard:
        ids, known, n, counts, term, tf = (np.concatenate(x) for x in zip(*parts))
        starts = np.concatenate([[0], np.cumsum(counts)])
        return Shard(ids, known, starts, term, told.values(term, tf.astype(np.int64), np.repeat(n, counts)), asked, size, block_docs)

    parts, held = [], 0
    for batch in batches:
        data, offsets = buffers(batch.column(2))
        term, tf = np.frombuffer(data.tobytes(), "<i4"), np.frombuffer(buffers(batch.column(3))[0].tobytes(), "<i4")
        ids = batch.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids, n, ends = ids.fill_null(_NOBODY).to_numpy(), batch.column(1).to_numpy(), offsets // 4
        start = 0
        while start < len(ids):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + postings - held, "right")) - 1)
            own = slice(ends[start], ends[stop])
            parts.append((ids[start:stop], known[start:stop], n[start:stop], np.diff(ends[start : stop + 1]), term[own], tf[own]))
            held += int(ends[stop] - ends[start])
            start = stop
            if held >= postings or start < len(ids):
                yield inverted(parts)
                parts, held = [], 0
    if parts:
        yield inverted(parts)


def _searched(index: DataFrame, block: Queries, told: Statistics, k: int, postings: int, block_docs: int) -> DataFrame:
    """(item, item_id, doc_id, score): the best k of each task for every query."""
    asked: dict[int, list[np.ndarray]] = {}
    for own in block.items:
        for term in own.tolist():
            asked.setdefault(term, []).append(own)
    columns = {term: np.unique(np.concatenate(own)) for term, own in asked.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in block.items]
        for shard in _shards(batches, told, columns, postings, block_docs):
            for own, held in zip(block.items, best):
                shard.search(own, held)
        for item, (item_id, held) in enumerate(zip(block.ids, best)):
            n = len(held.scores)
            ids = pa.array(held.ids, mask=~held.known)
            columns_ = [pa.array([item] * n, pa.int64()), pa.array([item_id] * n, pa.int64()), ids, pa.array(held.scores)]
            yield pa.RecordBatch.from_arrays(columns_, ["item", "item_id", "doc_id", "score"])

    found = index.mapInArrow(run, "item long, item_id long, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # As many rows per item as there are tasks, times k: first within parts of them.
    found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, postings: int = SHARD_POSTINGS, block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each query with a score above 0, the best first.

    Queries are read a block at a time, and each block goes over the documents once.
    """
    found: DataFrame | None = None
    for block in query_blocks(queries, block_terms):
        index = forward_index(docs, block.vocabulary)
        part = _searched(index, block, statistics(index, len(block.vocabulary)), k, postings, block_docs)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
