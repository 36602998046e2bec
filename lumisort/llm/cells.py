"""Byte windows of a text, grouped so that equal windows of any two texts meet.

A window is ``length`` bytes.  Its anchor is the leftmost of the ``GRAM``-byte grams in
it with the smallest hash, so equal windows have equal anchors at equal offsets.
Consecutive windows with one anchor form a range; a range is cut into cells of
``CELL`` offsets from the anchor.  The core of a cell, the bytes common to all windows
that the cell can hold, is the same for equal windows.  Hashes of any stretch come
from two prefix sums.
"""

from __future__ import annotations

import numpy as np

GRAM, CELL = 48, 12
BLOCK = 1 << 17  # windows looked at together; places in a block fit 20 bits
PLACE = np.uint64((1 << 20) - 1)
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


BASE = 0x9E3779B97F4A7C15 | 5
LETTER = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = U(base)
        np.multiply.accumulate(out, out=out)
    return out


UP = _powers(BASE, BLOCK + 4096)
DOWN = _powers(pow(BASE, -1, 1 << 64), BLOCK + 4096)

PRIME = (1 << 31) - 1
BASE_31 = 1_103_515_245
LETTER_31 = LETTER % U(PRIME)


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, up to one PRIME too large."""
    x = (x & U(PRIME)) + (x >> U(31))
    return (x & U(PRIME)) + (x >> U(31))


def _powers_31(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    size = 1
    while size < n:  # the powers so far, times the next one
        more = min(size, n - size)
        out[size:size + more] = out[:more] * U(pow(base, size, PRIME)) % U(PRIME)
        size += more
    return out


UP_31 = _powers_31(BASE_31, BLOCK + 4096)
DOWN_31 = _powers_31(pow(BASE_31, -1, PRIME), BLOCK + 4096)


class Prefix:
    """Hashes of stretches of at most BLOCK + 4096 bytes: a polynomial modulo 2^64 and, as such
    polynomials agree on some pairs of different texts whatever the base (Thue-Morse words), an
    independent one modulo a prime, in 64 bits together."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sum, self.sum_31 = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(LETTER[data] * UP[:n], out=self.sum[1:])
        np.cumsum(_fold(LETTER_31[data] * UP_31[:n]), out=self.sum_31[1:])  # below 2^49

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        wide = (self.sum[stop] - self.sum[start]) * DOWN[start] + (stop - start).astype(np.uint64)
        prime = _fold(_fold(self.sum_31[stop] - self.sum_31[start]) * DOWN_31[start])
        prime = np.where(prime >= U(PRIME), prime - U(PRIME), prime)
        return mix(mix(wide) ^ (prime * U(0x9E3779B97F4A7C15)))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, len(x) - width + 1 of them."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if span < width else x


def ranges(data: np.ndarray, starts: np.ndarray, length: int, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Ranges of the windows of texts laid end to end (``starts``: the first byte of
    each, and the end).  first, last: windows by first byte; anchor: its place; key:
    hash of the anchor's gram; hull: hash of all bytes with their place at the anchor."""
    out: dict[str, list] = {k: [] for k in ("first", "last", "anchor", "key", "hull")}
    n = len(data)
    at = 0
    while at + length <= n:
        stop = min(at + BLOCK, n - length + 1)  # windows at .. stop - 1
        part = data[at:stop + length - 1]
        prefix = Prefix(part)
        i = np.arange(len(part) - gram + 1)
        key = prefix.of(i, i + gram)
        low = sliding_min((key & ~PLACE) | i.astype(np.uint64), length - gram + 1)
        anchor = (low & PLACE).astype(np.int64)
        first = np.arange(stop - at)
        # a window lies in one text if the next text starts at its end or later
        text = np.searchsorted(starts, at + first, "right")
        whole = starts[np.minimum(text, len(starts) - 1)] >= at + first + length
        new = np.ones(len(first), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(first)) - 1
        # windows that cross an end come last in their text: cut them off
        n_whole = np.add.reduceat(whole.astype(np.int64), head) if len(head) else head
        head, tail = head[n_whole > 0], (head + n_whole - 1)[n_whole > 0]
        if len(head):
            a = anchor[head]
            out["first"].append(head + at)
            out["last"].append(tail + at)
            out["anchor"].append(a + at)
            out["key"].append(key[a])
            out["hull"].append(mix(prefix.of(head, tail + length) + (a - head).astype(np.uint64)))
        at = stop
    kinds = {"key": np.uint64, "hull": np.uint64}
    return {k: np.concatenate(v) if v else np.zeros(0, kinds.get(k, np.int64)) for k, v in out.items()}


def cells(data: np.ndarray, first: np.ndarray, last: np.ndarray, anchor: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Cells of ranges: range (its number), lo, hi (windows by first byte), core, hull."""
    if not len(first):
        return {k: np.zeros(0, np.uint64 if k in ("core", "hull") else np.int64) for k in ("range", "lo", "hi", "core",
                                                                                        "hull")}
    c0, c1 = (first - anchor) // CELL, (last - anchor) // CELL
    n = c1 - c0 + 1
    of = np.repeat(np.arange(len(first)), n)
    c = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + c0[of]
    corner = anchor[of] + c * CELL
    lo, hi = np.maximum(corner, first[of]), np.minimum(corner + CELL - 1, last[of])
    core, hull = np.empty(len(of), np.uint64), np.empty(len(of), np.uint64)
    i = 0
    while i < len(of):  # stretches near each other share a prefix sum
        j = int(np.searchsorted(lo, lo[i] + BLOCK - 2 * length, "left"))
        j = max(j, i + 1)
        base = int(lo[i]) - CELL
        base = max(base, 0)
        prefix = Prefix(data[base:int(hi[i:j].max()) + length])
        s = slice(i, j)
        core[s] = prefix.of(corner[s] + CELL - 1 - base, corner[s] + length - base)
        hull[s] = mix(prefix.of(lo[s] - base, hi[s] + length - base) + (lo[s] - corner[s]).astype(np.uint64))
        i = j
    return {"range": of, "lo": lo, "hi": hi, "core": core, "hull": hull}
