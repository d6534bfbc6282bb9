"""CRC-32 of many byte spans at once, and of what they make when joined, by the linearity of the checksum."""

from __future__ import annotations

import zlib

import numpy as np

_POLYNOMIAL = 0xEDB88320  # fixed value: that of zlib's crc32
_SPAN_BYTES = 64  # longer spans go to zlib one by one


def _step_table() -> np.ndarray:
    """The effect of one byte on an empty register."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & 1, np.uint32(_POLYNOMIAL), np.uint32(0))
    return table


_STEP = _step_table()


def _applied(operator: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    """A linear operator, a row of 256 values per byte of the register, on many registers."""
    out = operator[0][crcs & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ operator[k][crcs >> np.uint32(8 * k) & np.uint32(255)]
    return out


def _doublings() -> list[np.ndarray]:
    """Operators that append 1, 2, 4, ... zero bytes to what a register stands for."""
    values = np.arange(256, dtype=np.uint32)[None] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    operators = [_STEP[values & np.uint32(255)] ^ (values >> np.uint32(8))]
    while len(operators) < 40:
        operators.append(_applied(operators[-1], operators[-1]))
    return operators


_ZEROS = _doublings()


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What crcs contribute when as many bytes as lengths say follow them."""
    out = crcs.copy()
    for k in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero(lengths >> k & 1)
        out[at] = _applied(_ZEROS[k], out[at])
    return out


def joined(first: np.ndarray, second: np.ndarray, second_lengths: np.ndarray) -> np.ndarray:
    """crc32 of concatenations from the crc32 of both parts."""
    return shifted(first, second_lengths) ^ second


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of the bytes of each span."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, _SPAN_BYTES + 1), kind="stable")
    falling, starts = -np.minimum(lengths, _SPAN_BYTES + 1)[order], starts[order]
    long = int(np.searchsorted(falling, -_SPAN_BYTES))
    crcs = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(-falling[long:].min(initial=0))):
        stop = int(np.searchsorted(falling, -k))  # spans with a byte at place k
        own = crcs[long:stop]
        crcs[long:stop] = _STEP[(own ^ data[starts[long:stop] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    crcs ^= np.uint32(0xFFFFFFFF)
    for i in range(long):
        crcs[i] = zlib.crc32(data[starts[i] : ends[order[i]]])
    out = np.empty_like(crcs)
    out[order] = crcs
    return out
