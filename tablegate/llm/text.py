"""Words, hashes and shingles of many texts at once: numpy over the bytes of an Arrow string column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tablegate.llm.tokenizing import forget

CHUNK_BYTES = 1 << 20  # texts are looked at in chunks of about this size; one longer text is a chunk of its own
_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Growing:
    """Powers of the hash base, kept by each worker and extended to the longest chunk it has met."""

    def __init__(self, base: int) -> None:
        self.base, self.values = base, np.empty(0, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            self.values = _powers(self.base, max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2)))
        return self.values[:n]


_UP, _DOWN = _Growing(_PRIME), _Growing(_INVERSE)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the splitmix finaliser)."""
    v = values ^ (values >> np.uint64(30))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def random_words(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 0x5851F42D4C957F2D % (1 << 64))))


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_HASH = random_words(1, 256)
_BYTE_HASH_LOWER = _BYTE_HASH[LOWER]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 places where its texts start and end; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return body, at.astype(np.int64) - int(at[0])


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each piece have at most ``limit`` bytes, or are one text."""
    forget()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


@dataclass
class Words:
    """Words of some texts in order: hashes, byte spans, and the n + 1 bounds of each text's words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    values = (_BYTE_HASH_LOWER if lower else _BYTE_HASH)[data]
    values *= _UP.upto(n)
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _DOWN.upto(n + 1)[starts])


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that don't cross from one text into the next."""
    n = len(inside)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    before[edge], after[edge - 1] = False, False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


# Code points of scripts that put no spaces between words; each of their characters is a word of its own.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3041, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
# Code points beyond ASCII that are white space, controls or punctuation.
SEPARATORS = ((0x80, 0xA9), (0xAB, 0xB4), (0xB6, 0xB9), (0xBB, 0xBF), (0xD7, 0xD7), (0xF7, 0xF7), (0x1680, 0x1680), (0x2000, 0x206F), (0x2E00, 0x2E7F), (0x3000, 0x3040), (0xFE10, 0xFE1F), (0xFE30, 0xFE6F), (0xFEFF, 0xFEFF), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))


def character_class(ranges: tuple[tuple[int, int], ...]) -> str:
    """Ranges of code points as they stand in the brackets of a regular expression of Python."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


def _within(points: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    place = np.searchsorted([a for a, _ in ranges], points, "right") - 1
    return (place >= 0) & (points <= np.array([b for _, b in ranges])[place])


def _scripts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the characters of unspaced scripts, and those of the separators beyond ASCII."""
    lead = np.flatnonzero(data >= 0xC2)
    first = data[lead].astype(np.int64)
    size = 2 + (first >= 0xE0) + (first >= 0xF0)
    points = np.where(size == 2, first & 0x1F, np.where(size == 3, first & 0x0F, first & 0x07))
    for k in (1, 2, 3):
        longer = size > k
        points[longer] = points[longer] << 6 | data[lead[longer] + k] & 0x3F
    solo, apart = _within(points, UNSPACED), _within(points, SEPARATORS)
    return lead[solo], lead[solo] + size[solo], lead[apart], lead[apart] + size[apart]


def script_runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, punctuation: bool) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``inside``, with each character of an unspaced script a run of its own.

    With ``punctuation`` separators beyond ASCII end a run as well.
    """
    if not (data >= 0xC2).any():
        return runs(inside, offsets)
    starts, ends, from_, upto = _scripts(data)
    if punctuation and len(from_):
        inside = inside.copy()
        for k in range(4):
            at = from_ + k
            inside[at[at < upto]] = False
    return runs(inside, np.concatenate([offsets, starts, ends]))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, by_script: bool = False) -> Words:
    """What stands between ASCII white space, with A-Z lower-cased if asked; by script, see ``script_runs``."""
    inside = ~SPACES[data]
    starts, ends = script_runs(data, offsets, inside, False) if by_script else runs(inside, offsets)
    return Words(span_hashes(data, starts, ends, lower), starts, ends, np.searchsorted(starts, offsets))


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text and their bounds; shorter texts are one run, none is none."""
    n = len(hashes)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(n)
    total = np.zeros(n, np.uint64)
    factors = random_words(2, size) | np.uint64(1)
    for k in range(size):
        part = np.zeros(n, np.uint64)
        part[: n - k] = hashes[k:]
        part[at + k >= ends] = 0
        total += part * factors[k]
    firsts = np.zeros(n, bool)
    firsts[bounds[:-1][np.diff(bounds) > 0]] = True
    valid = (at + size <= ends) | firsts
    counts = np.concatenate([[0], np.cumsum(valid)])
    return mix(total[valid]), counts[bounds]
