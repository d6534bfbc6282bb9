"""Document fingerprints: a randomised edit embedding, sampled, banded and verified.

A text is walked with steps of 0 or 1 that a table shared by all texts draws from the step's number and the character
under the walk. Texts a few edits apart fall into step again after each edit, so the sequence of characters read maps
edit distance to Hamming distance. A fingerprint keeps the characters (four hashed bits each) at sampled steps. Which
steps are sampled depends on their numbers alone: level l keeps the steps whose hash has l trailing zeros, about one in
2**l, and a text takes the first level that keeps at most ``SAMPLES`` of its steps on average. A coarser level is a
subset of a finer one, so fingerprints of any two lengths can be compared.

A fingerprint is text: two hex digits of level, then a hex digit per sampled step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.store import bounded_batches
from tablegate.llm.text import mix, random_words

SAMPLES = 512
LEVELS = 24
CHUNK_CHARS = 6 << 20  # characters walked side by side
_PERIOD = 4096
_END = 0  # what a walk reads past the end of its text; it never moves on

_WALK = (random_words(11, _PERIOD * 256 // 64).view(np.uint8)[:, None] >> np.arange(8, dtype=np.uint8) & 1).astype(np.int64)
_WALK = _WALK.reshape(_PERIOD, 256)
_WALK[:, _END] = 0
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


class _Steps:
    """The sampling level of every step, extended to the longest walk a worker has met."""

    def __init__(self) -> None:
        self.depth = np.empty(0, np.uint8)
        self.kept: list[np.ndarray] = []

    def upto(self, n: int) -> _Steps:
        if n > len(self.depth):
            n = max(n, 1 << 16, 2 * len(self.depth))
            hashed = mix(np.arange(n, dtype=np.uint64) + np.uint64(77)) | np.uint64(1 << LEVELS)
            low = hashed & (~hashed + np.uint64(1))
            self.depth = np.log2(low.astype(np.float64)).astype(np.uint8)
            self.kept = [np.flatnonzero(self.depth >= k) for k in range(LEVELS + 1)]
        return self


_STEPS = _Steps()


def walk_lengths(sizes: np.ndarray) -> np.ndarray:
    """Steps kept of texts of n characters at least: twice as many and a margin. A walk not at its end then goes on."""
    return np.where(sizes > 0, (2 * sizes + 3 * np.sqrt(2.0 * sizes) + 8).astype(np.int64), 0)


def levels(steps: np.ndarray) -> np.ndarray:
    """The sampling level of walks of so many steps."""
    return np.ceil(np.log2(np.maximum(steps, 1) / SAMPLES)).clip(0, LEVELS).astype(np.int64)


def fingerprints(texts: Sequence[str]) -> list[tuple[int, np.ndarray]]:
    """(level, sampled values of 0 to 15) of each text; an empty text has none.

    Every text is walked to its end, which any walk comes to: no character stands still for a whole period of the table.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    read = np.full(starts[-1], _END, np.uint8)
    for i, at, n in zip(order, starts, sizes):
        if n:
            code = np.frombuffer(texts[i].encode("utf-32-le", "surrogatepass"), "<u4")
            read[at : at + n] = (code * np.uint32(0x9E3779B1) >> np.uint32(24)) % np.uint32(255) + np.uint32(1)
    steps = walk_lengths(sizes)
    level = levels(steps)
    depth = _STEPS.upto(int(steps[0]) if len(steps) else 0).depth
    counts = np.array([np.searchsorted(_STEPS.kept[k], s) for k, s in zip(level, steps)], np.int64)
    out = np.zeros((int(counts.max(initial=0)), len(texts)), np.uint8)
    used = np.unique(level)
    first = {k: int(np.searchsorted(-level, -k, "left")) for k in used}
    last = {k: int(np.searchsorted(-level, -k, "right")) for k in used}
    slot = dict.fromkeys(used.tolist(), 0)
    rising = sorted(slot)
    at, ends = starts[:-1].copy(), starts[1:] - 1
    falling, taken = -steps, steps.copy()
    block, active = 0, int(np.searchsorted(falling, 0, "left"))
    while active:
        if block + 64 > len(depth):
            depth = _STEPS.upto(block + 64).depth
        due = int(np.searchsorted(falling, -(block + 64), "left"))  # from here on, walks that should end in this block
        read_on = np.zeros(max(0, active - due), np.int64)
        here = at[:active]
        for j in range(block, block + 64):
            seen = read[here]
            for k in rising:
                if k > depth[j]:
                    break
                if first[k] < active:
                    if slot[k] >= len(out):
                        out = np.concatenate([out, np.zeros((max(64, len(out)), len(texts)), np.uint8)])
                    stop = min(last[k], active)
                    out[slot[k], first[k] : stop] = seen[first[k] : stop]
                slot[k] += 1
            if due < active:
                read_on += seen[due:] != _END
            here += _WALK[j % _PERIOD][seen]
        at[:active] = here
        late = due + np.flatnonzero(read_on)
        taken[late] = np.maximum(taken[late], block + read_on[late - due])
        block += 64
        unfinished = np.flatnonzero(at[:active] < ends[:active])
        active = max(int(np.searchsorted(falling, -block, "left")), int(unfinished[-1]) + 1 if len(unfinished) else 0)
    _STEPS.upto(int(taken.max(initial=0)))
    counts = np.array([np.searchsorted(_STEPS.kept[k], s) for k, s in zip(level, taken)], np.int64)
    found: list[tuple[int, np.ndarray]] = [(0, np.empty(0, np.uint8))] * len(texts)
    for column, i in enumerate(order):
        values = out[: counts[column], column]
        found[i] = (int(level[column]), values * 7 % 16)
    return found


def as_text(fingerprint: tuple[int, np.ndarray]) -> str:
    level, values = fingerprint
    return f"{level:02x}" + _HEX[values].tobytes().decode()


def from_text(fingerprint: str) -> tuple[int, np.ndarray]:
    return int(fingerprint[:2], 16), np.array([int(c, 16) for c in fingerprint[2:]], np.uint8)


def at_level(fingerprint: tuple[int, np.ndarray], level: int) -> np.ndarray:
    """The values a coarser level would have kept."""
    own, values = fingerprint
    if own >= level or not len(values):
        return values
    steps = _STEPS.upto(len(values) * 4 << own)
    while len(steps.kept[own]) < len(values):
        steps = _STEPS.upto(2 * len(steps.depth))
    return values[steps.depth[steps.kept[own][: len(values)]] >= level]


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """Share of sampled steps at which two walks read the same, 0 to 1; empty texts are like each other only."""
    level = max(a[0], b[0])
    x, y = at_level(a, level), at_level(b, level)
    longer, shorter = max(len(x), len(y)), min(len(x), len(y))
    if not longer:
        return 1.0
    return float((x[:shorter] == y[:shorter]).sum() / longer)


def edited(text: str, following: str) -> str:
    """A text whose last quarter of characters is replaced by the first as many (or all) of another."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


OWN, GUEST, ALONE = 0, 1, 2


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, role) dealt into partitions of consecutive doc_ids, sorted, each followed by the next one's first.

    Repeated doc_ids go by the text's hash. A guest row stands for the first document of the next partition (of the
    first one after the last). Rows without doc_id have no place in the order and stand alone.
    """
    rows = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = max(1, rows.rdd.getNumPartitions())
    cuts = rows.agg(F.percentile_approx("doc_id", [k / parts for k in range(parts)], max(10_000, 20 * parts)).alias("c"))
    bounds = np.unique(np.array(cuts.first()["c"] or [], np.int64))  # one a partition

    @F.pandas_udf("array<struct<part:int,role:int>>")
    def dealt(ids, hashes):
        import pandas as pd

        out = []
        for doc_id, spread in zip(ids, hashes):
            if pd.isna(doc_id):
                out.append([{"part": int(spread) % max(1, len(bounds)), "role": ALONE}])
                continue
            at = int(np.searchsorted(bounds, int(doc_id), "right")) - 1
            here = [{"part": at, "role": OWN}]
            if bounds[at] == int(doc_id):
                here.append({"part": (at - 1) % len(bounds), "role": GUEST})
            out.append(here)
        return pd.Series(out)

    rows = rows.withColumn("deal", F.explode(dealt("doc_id", F.xxhash64("text"))))
    rows = rows.select("doc_id", "text", "deal.part", "deal.role")
    placed = rows.repartitionById(max(1, len(bounds)), F.col("part"))
    return placed.sortWithinPartitions("role", "doc_id", F.xxhash64("text")).drop("part")


FINGERPRINTED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the same with its last quarter replaced, and their likeness to each other.

    The replacement comes from the next document in ascending doc_id, the first following the last. Null text is empty.
    A row without doc_id is followed by an empty document. Repeated rows follow each other. Other columns are not used.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        alone: list[tuple[int | None, str]] = []
        guest, size = "", 0
        waiting = True

        def rows(own: list[tuple[int | None, str]], following: list[str]) -> pa.RecordBatch:
            texts = [t for _, t in own]
            changed = [edited(t, f) for t, f in zip(texts, following)]
            distinct = {t: i for i, t in enumerate(dict.fromkeys([*texts, *changed, *following]))}
            made = fingerprints(list(distinct))
            first, second, third = ([made[distinct[t]] for t in group] for group in (texts, changed, following))
            columns = [
                pa.array([i for i, _ in own], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                pa.array(map(as_text, first), pa.string()),
                pa.array(map(as_text, second), pa.string()),
                pa.array(map(likeness, first, second), pa.float64()),
                pa.array(map(likeness, first, third), pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FINGERPRINTED.split(", ")])

        for batch in batches:
            for doc_id, text, role in zip(*(c.to_pylist() for c in batch.columns)):
                if role == OWN:
                    held.append((doc_id, text))
                elif role == ALONE:
                    alone.append((doc_id, text))
                elif waiting:
                    guest, waiting = text, False
                size += len(text)
                if size >= CHUNK_CHARS:
                    if len(held) > 1:
                        yield rows(held[:-1], [t for _, t in held[1:]])
                        held = held[-1:]
                    if alone:
                        yield rows(alone, [""] * len(alone))
                        alone = []
                    size = sum(len(t) for _, t in held)
        if held:
            yield rows(held, [t for _, t in held[1:]] + [guest])
        if alone:
            yield rows(alone, [""] * len(alone))

    return in_order(docs).mapInArrow(run, FINGERPRINTED)


BANDS, BAND_STEPS = 24, 6
RUNGS = 4  # band ranges an octave of lengths
BLOCK = 1024  # members of a band compared side by side, twice as many in a task at once


def band_keys(fingerprint: str, at_least: float = 0.8) -> list[tuple[int, int, int, bytes]]:
    """(level, range, band, values) of steps sampled from a fingerprint, at every level that texts near enough may have.

    A band reads its steps from all of a range that holds the whole walk; past the walk's end it reads the end, as
    ``likeness`` counts. Ranges are powers of 2 ** (1 / RUNGS), and a text takes those up to the length its longest
    partner may have, so two texts alike enough share one. There each of their bands agrees with a probability of at least
    likeness ** BAND_STEPS, wherever the texts differ. A band whose steps all lie past the end says nothing and is left out.
    """
    own, values = from_text(fingerprint)
    keys = []
    for level in range(own, own + 1 + int(1 + np.log2(1.1 / at_least))):
        seen = at_level((own, values), level)
        if not len(seen):
            continue
        low, high = np.log2(len(seen)) * RUNGS, np.log2(len(seen) / at_least) * RUNGS
        for rung in range(int(np.ceil(low - 1e-9)), int(np.ceil(high + 1e-9)) + 1):
            size = max(int(np.ceil(2 ** (rung / RUNGS))), len(seen))
            whole = np.zeros(size, np.uint8)
            whole[: len(seen)] = seen
            for band in range(BANDS):
                places = (random_words(100 + 31 * rung + 7919 * band, BAND_STEPS) >> np.uint64(33)) % np.uint64(int(np.ceil(2 ** (rung / RUNGS))))
                places = places.astype(np.int64)
                if (places < len(seen)).any():
                    keys.append((level, rung, band, whole[places].tobytes()))
    return keys


BAND = ["level", "rung", "band", "key"]


def near_earlier(prints: DataFrame, at_least: float = 0.8) -> DataFrame:
    """(doc_id, earlier_id, likeness): every two documents of different fingerprints that share a band and are alike enough.

    Takes (doc_id, fingerprint). Equal fingerprints are one text to the bands; every holder but the first is returned
    with the first at likeness 1, and the first stands for all in other pairs. All members of a band are compared with each
    other: a band is cut into blocks, and every two blocks meet in a group of their own, which bounds what a task holds.
    A pair at likeness s shares no band with a probability of (1 - s ** BAND_STEPS) ** BANDS at most: 7e-4 at 0.8.
    """
    groups = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    copies = prints.join(groups, "fingerprint").filter("doc_id <> first")
    copies = copies.select("doc_id", F.col("first").alias("earlier_id"), F.lit(1.0).alias("likeness"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            prints_of = batch.column(0).to_pylist()
            for start in range(0, len(prints_of), 256):
                own = zip(prints_of[start : start + 256], batch.column(1).slice(start, 256).to_pylist())
                found = [(i, *k) for f, i in own for k in band_keys(f, at_least)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], ["first", *BAND])

    known = groups.filter("first IS NOT NULL").select("fingerprint", "first")
    banded = known.mapInArrow(emit, "first long, level int, rung int, band int, key binary")
    bands = banded.groupBy(*BAND).agg(F.count("*").alias("n")).filter("n > 1")
    bands = bands.select(*BAND, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    dealt = banded.join(bands, BAND).withColumn("own", F.pmod(F.xxhash64("first"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    dealt = dealt.join(known, "first")

    def compared(key, table):
        level, i, j = key[0].as_py(), key[4].as_py(), key[5].as_py()
        doc, block = table.column("first").to_numpy(), table.column("own").to_numpy()
        made = [from_text(f) for f in table.column("fingerprint").to_pylist()]
        own = np.array([k for k, _ in made])
        seen = [at_level(f, level) for f in made]
        sizes = np.array([len(x) for x in seen])
        whole = np.full((len(seen), int(sizes.max())), 16, np.uint8)
        for row, values in enumerate(seen):
            whole[row, : len(values)] = values
        found: list[tuple[int, int, float]] = []
        for row in range(1, len(doc)):
            good = np.maximum(own[:row], own[row]) == level  # others meet at a level of their own
            if i != j:
                good &= block[:row] != block[row]
            others = np.flatnonzero(good)
            equal = ((whole[others] == whole[row]) & (whole[row] < 16)).sum(1)
            alike = equal / np.maximum(sizes[others], sizes[row])
            for other, share in zip(others[alike >= at_least], alike[alike >= at_least]):
                found.append((int(max(doc[row], doc[other])), int(min(doc[row], doc[other])), float(share)))
        kinds = {"doc_id": pa.int64(), "earlier_id": pa.int64(), "likeness": pa.float64()}
        return pa.table({c: pa.array([f[k] for f in found], kind) for k, (c, kind) in enumerate(kinds.items())})

    columns = [*BAND, "i", "j", "first", "own", "fingerprint"]
    met = dealt.select(columns).groupBy(*BAND, "i", "j").applyInArrow(compared, "doc_id long, earlier_id long, likeness double")
    return copies.unionByName(met.dropDuplicates(["doc_id", "earlier_id"]))
