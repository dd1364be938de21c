"""Directly addressable codes: numbers of varying length with access to each one.

A number is cut into chunks of bits, lowest first. Level k holds the k-th chunk
of every number that has one; a bitmap says which of them go on in the next
level. The place of a number there is the count of set bits before it, which a
directory of counts per block answers without decoding anything else.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
#: Bits of a bitmap that share one entry of its directory.
BLOCK_BITS = 512
_HEAD = struct.Struct("<4sBQ")
_LEVEL = struct.Struct("<BQ")
_ONES = np.array([bin(value).count("1") for value in range(256)], np.uint8)


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths that take the least space for these numbers."""
    bits = np.frexp(ids.astype(np.float64))[1]
    counts = np.bincount(np.maximum(bits, 1), minlength=2)
    most = len(counts) - 1
    # longer[s]: numbers with more than s bits, which reach a level that begins at bit s.
    longer = [int(counts[s + 1 :].sum()) if s else len(ids) for s in range(most + 1)]
    cost, choice = [0.0] * (most + 1), [0] * (most + 1)
    for start in range(most - 1, -1, -1):
        options = []
        for width in range(1, min(16, most - start) + 1):
            last = start + width == most
            options.append((longer[start] * (width + (0 if last else 1 + 32 / BLOCK_BITS)) + cost[start + width], width))
        cost[start], choice[start] = min(options)
    widths, start = [], 0
    while start < most:
        widths.append(choice[start])
        start += choice[start]
    return widths


def _pack(values: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bits in a row, padded so that four bytes can be read at any of them."""
    if width == 8:
        return values.astype(np.uint8).tobytes() + bytes(4)
    if width == 16:
        return values.astype("<u2").tobytes() + bytes(4)
    bits = np.unpackbits(values.astype("<u2").view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes() + bytes(4)


def encode(ids: np.ndarray, widths: list[int] | None = None) -> bytes:
    """All numbers as one block of bytes."""
    ids = np.asarray(ids, np.uint32)
    if widths is None or not len(ids):
        widths = best_widths(ids) if len(ids) else []
    parts = [_HEAD.pack(MAGIC, len(widths), len(ids))]
    rest = ids
    for level, width in enumerate(widths):
        parts.append(_LEVEL.pack(width, len(rest)))
        parts.append(_pack(rest & np.uint32((1 << width) - 1), width))
        if level + 1 < len(widths):
            higher = rest >> np.uint32(width)
            goes_on = higher > 0
            bitmap = np.packbits(goes_on, bitorder="little")
            bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK_BITS // 8)))
            ones = _ONES[bitmap].reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint32)
            directory = np.concatenate([[0], np.cumsum(ones)]).astype("<u4")
            parts += [bitmap.tobytes(), directory.tobytes()]
            rest = higher[goes_on]
    return b"".join(parts)


class Codes:
    """Reads single numbers and runs of them out of encoded bytes."""

    def __init__(self, data: bytes, at: int = 0):
        magic, levels, self._count = _HEAD.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("these bytes are not directly addressable codes")
        at += _HEAD.size
        self._levels = []
        for level in range(levels):
            width, count = _LEVEL.unpack_from(data, at)
            at += _LEVEL.size
            size = (count * width + 7) // 8 + 4
            chunks = np.frombuffer(data, np.uint8, size, at)
            at += size
            bitmap = directory = None
            if level + 1 < levels:
                blocks = -(-count // BLOCK_BITS)
                bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK_BITS // 8, at)
                at += len(bitmap)
                directory = np.frombuffer(data, "<u4", blocks + 1, at)
                at += directory.nbytes
            self._levels.append((width, chunks, bitmap, directory))
        #: Where the bytes of these codes end.
        self.end = at

    def __len__(self) -> int:
        return self._count

    def __getitem__(self, place: int) -> int:
        """One number; nothing before or after it is decoded."""
        if not 0 <= place < self._count:
            raise IndexError(place)
        value = shift = 0
        for width, chunks, bitmap, directory in self._levels:
            bit = place * width
            word = int.from_bytes(chunks[bit >> 3 : (bit >> 3) + 4].tobytes(), "little")
            value |= (word >> (bit & 7) & ((1 << width) - 1)) << shift
            shift += width
            if bitmap is None or not bitmap[place >> 3] >> (place & 7) & 1:
                break
            place = self._rank(bitmap, directory, place)
        return value

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, place: int) -> int:
        """Set bits before ``place``."""
        block = place // BLOCK_BITS
        first, byte = block * BLOCK_BITS // 8, place >> 3
        ones = int(directory[block]) + int(_ONES[bitmap[first:byte]].sum())
        if place & 7:
            ones += int(_ONES[bitmap[byte] & ((1 << (place & 7)) - 1)])
        return ones

    def run(self, start: int, stop: int) -> np.ndarray:
        """The numbers from ``start`` up to ``stop``, as 32-bit values."""
        out = np.zeros(max(0, stop - start), np.uint32)
        if not len(out):
            return out
        if not 0 <= start <= stop <= self._count:
            raise IndexError((start, stop))
        targets, shift = None, 0
        for width, chunks, bitmap, directory in self._levels:
            if width == 8:
                values = chunks[start:stop].astype(np.uint32)
            else:
                bit = np.arange(start, stop, dtype=np.int64) * width
                byte = bit >> 3
                word = chunks[byte].astype(np.uint32)
                for k in (1, 2) if width <= 16 else (1, 2, 3):
                    word |= chunks[byte + k].astype(np.uint32) << np.uint32(8 * k)
                values = word >> (bit & 7).astype(np.uint32) & np.uint32((1 << width) - 1)
            values <<= np.uint32(shift)
            if targets is None:
                out[:] = values
            else:
                out[targets] |= values
            shift += width
            if bitmap is None:
                break
            flags = np.unpackbits(bitmap[start >> 3 : (stop + 7) >> 3], bitorder="little")
            on = np.flatnonzero(flags[start & 7 : (start & 7) + stop - start])
            if not len(on):
                break
            targets = on if targets is None else targets[on]
            start = self._rank(bitmap, directory, start)
            stop = start + len(on)
        return out
