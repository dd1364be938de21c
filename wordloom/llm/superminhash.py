"""SuperMinHash signatures of many sets at once.

Every element visits all ``size`` places of the signature in an order of its
own, and the value it offers at its j-th place is j plus a fraction. The ranks of
one element are a permutation, so they differ from place to place, which lowers
the variance against independent hashes. Once every place of a set holds less
than j + 1, later visits cannot change it and the set is done.

The order of an element is drawn from the permutations a + j * b modulo a prime,
so it takes no memory.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed random bijection of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``words`` words.

    A-Z are folded; words are separated by space and the characters tab to
    carriage return. A shorter text is one run; without words there is none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    runs = np.full(count, width, np.uint64)
    for at in range(width):
        runs = mixed(runs * _M1 + hashes[at : at + count])
    return np.unique(runs)


def is_prime(number: int) -> bool:
    return number > 1 and all(number % k for k in range(2, int(number**0.5) + 1))


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """One row of ``size`` values per set, ``size`` being a prime; an empty set has infinite values."""
    if not is_prime(size):
        raise ValueError("the size of a signature must be a prime number")
    lengths = [len(one) for one in sets]
    table = np.full(len(sets) * size, np.inf)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owners = np.repeat(np.arange(len(sets)), lengths)
    at = (mixed(elements) % np.uint64(size)).astype(np.int64)
    stride = (mixed(elements + np.uint64(_STEP)) % np.uint64(size - 1)).astype(np.int64) + 1
    base = owners * size
    rows = table.reshape(len(sets), size)
    for step in range(size):
        if not len(elements):
            break
        salt = np.uint64((step + 2) * _STEP & _MASK)
        fraction = (mixed(elements + salt) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        np.minimum.at(table, base + at, step + fraction)
        at += stride
        at[at >= size] -= size
        going = rows.max(axis=1) > step + 1
        alive = going[owners]
        if not alive.all():
            elements, owners, base, at, stride = (one[alive] for one in (elements, owners, base, at, stride))
    return rows


def band_keys(rows: np.ndarray, bands: int, depth: int) -> np.ndarray:
    """A 64-bit key per set and band of ``depth`` values; keys of different bands differ.

    The places of a band are drawn from the whole signature, the same for all
    sets. An element visits places at equal strides, so two small sets would
    differ once in each band of neighbouring places too often.
    """
    order = np.argsort(mixed(np.arange(1, rows.shape[1] + 1, dtype=np.uint64)), kind="stable")
    values = rows[:, order[: bands * depth]].copy().view(np.uint64).reshape(len(rows), bands, depth)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(rows), bands)).copy()
    for at in range(depth):
        keys = mixed(keys * _M1 + values[:, :, at])
    return keys


def sketches(rows: np.ndarray, count: int, planes: int) -> np.ndarray:
    """The first ``count`` values of each signature as ``planes`` bits each, in words of 64.

    Word p * w + k of a row holds bit p of the values 64 * k to 64 * k + 63, w
    being the words of a plane.
    """
    codes = mixed(rows[:, :count].copy().view(np.uint64))
    width = -(-count // 64) * 64
    out = []
    for plane in range(planes):
        bits = np.zeros((len(rows), width), np.uint8)
        bits[:, :count] = codes >> np.uint64(plane) & np.uint64(1)
        out.append(np.packbits(bits, axis=1, bitorder="little").view(np.int64))
    return np.concatenate(out, axis=1)


def most_mismatches(percent: int, count: int, planes: int, risk: float = 1e-7) -> int:
    """Differing values up to which two sketches may belong to sets of this similarity.

    Sets that are similar enough differ in more values with a probability of
    ``risk`` at most.
    """
    differ = (1 - percent / 100) * (1 - 2.0**-planes)
    tail, most = 0.0, count
    while most > 0:
        tail += math.comb(count, most) * differ**most * (1 - differ) ** (count - most)
        if tail > risk:
            return most
        most -= 1
    return 0
