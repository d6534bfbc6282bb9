"""Benchmark decontamination by spaced seeds.

A document leaks an item if some ``SPAN`` words in a row of the one equal those of the other but for at most
``SUBSTITUTED``. The span is four blocks of three words; as two substitutions spoil at most two blocks, two blocks
are intact, 3, 6 or 9 words apart. So the masks, with a 1 for each word that counts, are::

    111111    111000111    111000000111

Every place of a text is hashed under each mask and looked up among the hashes of the items. A hit gives a diagonal (the
item laid along the text), on which all spans are verified word by word, so the seeds decide the speed and not the result.
Items shorter than the span must be found whole and unchanged.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased; spaces and punctuation end a word, also those
beyond ASCII, such as curly quotes, and in scripts without spaces each character is a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches
from tablegate.llm.text import buffers, chunks, mix, random_words, script_runs, span_hashes

SPAN, SUBSTITUTED = 12, 2
BLOCK = 3
APART = (3, 6, 9)
TOGETHER = 1_000_000  # words of items that are looked for in one pass over the documents
_FILTER_BITS = 22

_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[48:58] = _WORD_BYTES[65:91] = _WORD_BYTES[97:123] = _WORD_BYTES[128:] = True


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and the bounds of each text's."""
    data, offsets = buffers(column)
    starts, ends = script_runs(data, offsets, _WORD_BYTES[data], True)
    return span_hashes(data, starts, ends, lower=True), np.searchsorted(starts, offsets)


def _seeds(words: np.ndarray) -> dict[int, np.ndarray]:
    """By distance: the hash of the two blocks that start at each place and at the distance from it."""
    factors = random_words(41, BLOCK + 1) | np.uint64(1)
    n = max(0, len(words) - BLOCK + 1)
    block = np.zeros(n, np.uint64)
    for k in range(BLOCK):
        block += words[k : k + n] * factors[k]
    block = mix(block)
    return {d: mix(block[: max(0, n - d)] * factors[BLOCK] + block[d:] + np.uint64(d)) for d in APART}


class Items:
    """Benchmark items ready for lookups."""

    def __init__(self, ids: list, words: list[np.ndarray]) -> None:
        self.ids, self.words = ids, words
        parts: dict[int, list[np.ndarray]] = {d: [] for d in APART}
        self.exact: dict[int, dict[bytes, list[int]]] = {}
        for item, own in enumerate(words):
            if len(own) < SPAN:
                self.exact.setdefault(len(own), {}).setdefault(own.tobytes(), []).append(item)
                continue
            for d, seeds in _seeds(own).items():
                parts[d].append(np.stack([seeds, np.full(len(seeds), item, np.uint64), np.arange(len(seeds), dtype=np.uint64)]))
        self.seeds = {}
        for d, found in parts.items():
            table = np.concatenate(found, 1) if found else np.zeros((3, 0), np.uint64)
            table = table[:, np.argsort(table[0], kind="stable")]
            known = np.zeros(1 << _FILTER_BITS, bool)
            known[table[0] >> np.uint64(64 - _FILTER_BITS)] = True
            self.seeds[d] = (table[0].copy(), table[1].astype(np.int64), table[2].astype(np.int64), known)

    def diagonals(self, words: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, item, place of the item's first word in the text) wherever a seed of both agrees."""
        found: set[tuple[int, int, int]] = set()
        for d, seeds in _seeds(words).items():
            values, items, places, known = self.seeds[d]
            at = np.flatnonzero(known[seeds >> np.uint64(64 - _FILTER_BITS)])
            low, high = np.searchsorted(values, seeds[at], "left"), np.searchsorted(values, seeds[at], "right")
            hit = np.flatnonzero(high > low)
            at, low, times = at[hit], low[hit], (high - low)[hit]
            text = np.searchsorted(bounds, at, "right") - 1
            inside = at + d + BLOCK <= bounds[text + 1]
            at, low, times, text = at[inside], low[inside], times[inside], text[inside]
            rows = np.repeat(np.arange(len(at)), times)
            entry = low[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
            start = at[rows] - bounds[text[rows]] - places[entry]
            found |= set(zip(text[rows].tolist(), items[entry].tolist(), start.tolist()))
        return found

    def leaks(self, words: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """(text, item) -> [first word, end word, spans] over all spans of the text that leak the item."""
        found: dict[tuple[int, int], list[int]] = {}

        def add(key: tuple[int, int], starts: list[int], size: int) -> None:
            own = found.setdefault(key, [starts[0], starts[0] + size, 0])
            own[0], own[1], own[2] = min(own[0], starts[0]), max(own[1], starts[-1] + size), own[2] + len(starts)

        for text, item, start in self.diagonals(words, bounds):
            own, item_words = words[bounds[text] : bounds[text + 1]], self.words[item]
            a, b = max(0, start), min(len(own), start + len(item_words))
            if b - a < SPAN:
                continue
            equal = np.concatenate([[0], np.cumsum(own[a:b] == item_words[a - start : b - start])])
            good = np.flatnonzero(equal[SPAN:] - equal[:-SPAN] >= SPAN - SUBSTITUTED)
            if len(good):
                add((text, item), (good + a).tolist(), SPAN)
        for size, table in self.exact.items():
            firsts = np.array(sorted({np.frombuffer(k, np.uint64)[0] for k in table}), np.uint64)
            for at in np.flatnonzero(np.isin(words, firsts)):
                for item in table.get(words[at : at + size].tobytes(), ()):
                    text = int(np.searchsorted(bounds, at, "right")) - 1
                    if at + size <= bounds[text + 1]:
                        add((text, item), [int(at - bounds[text])], size)
        return found


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[bytes]]]:
    """Items as word hashes, in blocks of a bounded number of words."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in chunks(batches, "text"):
            words, bounds = tokens(piece.column(1))
            bodies = [words[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(bodies, pa.binary()), pa.array(np.diff(bounds))], ["item_id", "words", "n"])

    hashed = rows.mapInArrow(run, "item_id long, words binary, n long").filter("n > 0").distinct()
    total = hashed.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // TOGETHER)
    for k in range(blocks):
        own = hashed if blocks == 1 else hashed.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k)
        found = sorted(((r["item_id"], bytes(r["words"])) for r in own.select("item_id", "words").collect()), key=str)
        yield [i for i, _ in found], [w for _, w in found]


LEAKS = "doc_id long, item_id long, first_word int, end_word int, spans long"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, end_word, spans): a row per document and benchmark item it leaks.

    Word numbers count from 0; spans are all places, over all alignments, where ``SPAN`` words agree. Items are looked
    for in blocks of bounded size, one pass over the documents each, so the benchmark may grow. Null, empty and short
    texts leak nothing; items that repeat an item_id and text count once. A null id stays null. Other columns are not used.
    """
    session = docs.sparkSession
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = None
    for ids, bodies in _blocks(benchmark):
        shared = session.sparkContext.broadcast((ids, bodies))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, packed = shared.value
            items = Items(known, [np.frombuffer(b, np.uint64) for b in packed])
            for piece in chunks(batches, "text"):
                found = items.leaks(*tokens(piece.column(1)))
                if found:
                    keys = list(found)
                    columns = [
                        piece.column(0).take(pa.array([t for t, _ in keys])),
                        pa.array([items.ids[i] for _, i in keys], pa.int64()),
                        *(pa.array([found[k][c] for k in keys], kind) for c, kind in enumerate((pa.int32(), pa.int32(), pa.int64()))),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "first_word", "end_word", "spans"])

        part = rows.mapInArrow(run, LEAKS)
        result = part if result is None else result.union(part)
    return session.createDataFrame([], LEAKS) if result is None else result


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns; every row is looked at for itself, whatever its doc_id."""
    session = docs.sparkSession
    rest = bounded_batches(docs)
    for ids, bodies in _blocks(benchmark):
        shared = session.sparkContext.broadcast((ids, bodies))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known, packed = shared.value
            items = Items(known, [np.frombuffer(b, np.uint64) for b in packed])
            for piece in chunks(batches, "text"):
                stay = np.ones(piece.num_rows, bool)
                stay[[text for text, _ in items.leaks(*tokens(piece.column("text")))]] = False
                yield piece.filter(pa.array(stay))

        rest = rest.mapInArrow(run, docs.schema)
    return rest
