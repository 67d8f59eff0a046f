"""Bit-sliced Hamming comparison of 64-bit fingerprints.

Fingerprints are stored vertically: word ``p`` of a *plane* holds bit ``p`` of 64
different fingerprints.  One pass over the planes then advances 64 distances per
machine word: the differing bits are added into carry-save counters (ones, twos,
fours) and a sticky word marks the lanes beyond the radius.  Rows of lanes that
are all beyond it are abandoned before the remaining planes are read.
"""

from __future__ import annotations

import numpy as np

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Planes read between two looks at what can be abandoned.
STRIDE = 8


def planes(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Bit planes ``bits`` of uint64 ``values``: shape (len(bits), ceil(n / 64)); spare lanes are zero."""
    lanes = -(-len(values) // 64) * 64
    out = np.zeros((len(bits), lanes // 8), np.uint8)
    for row, bit in enumerate(bits):
        plane = ((values >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        out[row, : -(-len(values) // 8)] = np.packbits(plane, bitorder="little")
    return out.view(np.uint64)


def _exceeds(ones: np.ndarray, twos: np.ndarray, fours: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter (0 to 7) is above ``radius`` (0 to 5)."""
    if radius == 0:
        return ones | twos | fours
    if radius == 1:
        return twos | fours
    if radius == 2:
        return (twos & ones) | fours
    if radius == 3:
        return fours
    if radius == 4:
        return fours & (ones | twos)
    return fours & twos


def near_lanes(differing, n_planes: int, shape: tuple[int, int], radius: int) -> np.ndarray:
    """Bit matrix of the lanes within ``radius``.

    ``differing(p, rows)`` gives plane ``p`` of the differing bits for the rows of
    lanes still alive.  Radius at most 5, so that a step of two planes can't jump
    over the sticky mark.
    """
    if not 0 <= radius <= 5:
        raise ValueError("radius must be from 0 to 5")
    alive = np.arange(shape[0])
    ones, twos, fours, over = (np.zeros(shape, np.uint64) for _ in range(4))
    result = np.zeros(shape, np.uint64)
    for p in range(0, n_planes, 2):
        first = differing(p, alive)
        second = differing(p + 1, alive) if p + 1 < n_planes else np.zeros_like(first)
        half = ones ^ first
        carry = (ones & first) | (half & second)
        ones = half ^ second
        up = twos & carry
        twos = twos ^ carry
        over |= fours & up
        fours = fours ^ up
        over |= _exceeds(ones, twos, fours, radius)
        if (p + 2) % STRIDE == 0 and p + 2 < n_planes:
            keep = (over != ALL).any(axis=1)
            if not keep.all():
                alive, ones, twos, fours, over = alive[keep], ones[keep], twos[keep], fours[keep], over[keep]
                if not len(alive):
                    return result
    result[alive] = ~over
    return result


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Boolean per position: whether ``left[i]`` and ``right[i]`` differ in at most ``radius`` bits."""
    if not len(left):
        return np.zeros(0, bool)
    wide = 64 * 16  # lanes of a row, the block that can be abandoned
    rows = -(-len(left) // wide)
    mixed = np.full(rows * wide, ALL)
    mixed[: len(left)] = left ^ right
    sliced = planes(mixed, np.arange(64)).reshape(64, rows, wide // 64)
    out = near_lanes(lambda p, alive: sliced[p][alive], 64, (rows, wide // 64), radius)
    return np.unpackbits(out.reshape(-1).view(np.uint8), bitorder="little")[: len(left)].astype(bool)


def adjacency(values: np.ndarray, radius: int, chunk: int = 256) -> np.ndarray:
    """Bit matrix (n, ceil(n / 64)) of all links among ``values``."""
    varying = np.bitwise_or.reduce(values ^ values[0])
    bits = np.array([b for b in range(64) if int(varying) >> b & 1] or [0])
    sliced = planes(values, bits)
    out = np.zeros((len(values), sliced.shape[1]), np.uint64)
    for at in range(0, len(values), chunk):
        asked = values[at : at + chunk]
        masks = np.where((asked[None, :] >> bits[:, None].astype(np.uint64)) & np.uint64(1), ALL, np.uint64(0))
        out[at : at + chunk] = near_lanes(
            lambda p, alive: sliced[p][None, :] ^ masks[p][alive][:, None], len(bits), (len(asked), sliced.shape[1]), radius)
    if len(values) % 64:  # lanes without a fingerprint
        out[:, -1] &= np.uint64((1 << len(values) % 64) - 1)
    return out


def stars(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the link graph of distinct sorted ``values``: (member, smallest member of its part)."""
    links = adjacency(values, radius)
    unseen = np.unpackbits(np.full(links.shape[1], ALL).view(np.uint8), bitorder="little")
    unseen[len(values):] = 0
    free = np.packbits(unseen, bitorder="little").view(np.uint64)
    members, roots = [], []
    for start in range(len(values)):
        if not int(free[start // 64]) >> (start % 64) & 1:
            continue
        free[start // 64] &= ~(np.uint64(1) << np.uint64(start % 64))
        todo = [start]
        while todo:
            found = links[todo.pop()] & free
            if found.any():
                free &= ~found
                new = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little"))
                todo.extend(new.tolist())
                members.append(new)
                roots.append(np.full(len(new), start))
    if not members:
        return values[:0], values[:0]
    return values[np.concatenate(members)], values[np.concatenate(roots)]
