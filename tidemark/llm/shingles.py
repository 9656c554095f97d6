"""Hashed words and five-word shingles of whole Arrow text columns, and their SuperMinHash signatures, in numpy.

Words are runs of bytes other than white space, A-Z lower-cased. A word's hash is the difference of two prefix sums of a
polynomial modulo 2**64, mixed; a shingle's hash combines the hashes of its words. Texts are taken in slices of bounded size;
a long text is cut at white space, so memory follows the slice and the number of words.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SLICE = 1 << 19
BASE = 0x9E3779B97F4A7C55 | 1
WEIGHTS = [U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
LENGTH = U(0x1D8E4E27C47D124F)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        size, inverse = max(n, SLICE), pow(BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            for key, base in (("up", BASE), ("down", inverse)):
                x = np.full(size, base, dtype=U)
                x[0] = 1
                _powers[key] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def _hash_words(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of consecutive texts and the number of words before each cut."""
    raw = LOWER[raw]
    gap = SPACE[raw]
    first, last = ~gap, ~gap
    full = cuts[:-1] < cuts[1:]
    before, after = np.roll(gap, 1), np.roll(gap, -1)
    before[cuts[:-1][full]] = True
    after[cuts[1:][full] - 1] = True
    first &= before
    last &= after
    a, z = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=U)
    np.cumsum((raw.astype(U) + U(1)) * up[: len(raw)], out=sums[1:])
    return mix((sums[z] - sums[a]) * down[a]), np.searchsorted(a, cuts)


def _whole(raw: np.ndarray) -> np.ndarray:
    """Word hashes of one long text, block by block."""
    found, at = [], 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        while end < len(raw) and not SPACE[raw[end]]:
            step = SPACE[raw[end : end + SLICE]]
            end += int(step.argmax()) if step.any() else len(step)
        found.append(_hash_words(raw[at:end], np.array([0, end - at]))[0])
        at = end
    return np.concatenate(found)


def text_slices(column):
    """(first row, last row + 1, bytes, cuts) for slices of an Arrow string column; nulls are empty; a long text comes alone."""
    import pyarrow as pa

    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + SLICE, side="right")) - 1)
        end = min(end, len(column))
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def shingle_sets(column, width: int = 5):
    """For slices of a text column: (first row, sorted distinct shingle hashes of all texts, offsets per text)."""
    with np.errstate(over="ignore"):
        for row, _, raw, cuts in text_slices(column):
            if len(cuts) == 2 and len(raw) > SLICE:
                words = _whole(raw)
                marks = np.array([0, len(words)])
            else:
                words, marks = _hash_words(raw, cuts)
            sums = np.zeros(max(0, len(words) - width + 1), dtype=U)
            for k in range(width):
                sums += words[k : k + len(sums)] * WEIGHTS[k % 5]
            sums = mix(sums + LENGTH * U(width))
            parts, ends = [], [0]
            for a, z in zip(marks[:-1].tolist(), marks[1:].tolist()):
                if z - a >= width:
                    own = np.unique(sums[a : z - width + 1])
                elif z > a:
                    one = LENGTH * U(z - a)
                    for k in range(z - a):
                        one = one + words[a + k] * WEIGHTS[k % 5]
                    own = mix(np.array([one], dtype=U))
                else:
                    own = np.zeros(0, dtype=U)
                parts.append(own)
                ends.append(ends[-1] + len(own))
            yield row, np.concatenate(parts), np.array(ends)


def super_minhash(hashes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures (texts x size) of consecutive sets.

    Every element draws a random permutation of the positions, one step at a time; at step k its next position takes the value
    k plus a fraction, and a position keeps the smallest value. All elements take step k together. A text whose positions all
    hold a value stops, as later steps only offer larger ones.
    """
    n, top = len(ends) - 1, np.iinfo(U).max
    out = np.full(n * size, top, dtype=U)
    owner = np.repeat(np.arange(n), np.diff(ends))
    h, p, k = hashes, None, 0
    with np.errstate(over="ignore"):
        while len(h):
            draw = mix(h + U(0x9E3779B97F4A7C15) * U(k + 1))
            j = k + ((draw & U(0xFFFFFFFF)) * U(size - k) >> U(32)).astype(np.int64)
            if k:
                rows = np.arange(len(h))
                place = p[rows, j]
                p[rows, j] = p[rows, k]
                p[rows, k] = place
                place = place.astype(np.int64)
            else:
                place = j
            np.minimum.at(out, owner * size + place, (U(k) << U(32)) | (draw >> U(32)))
            open_ = (out.reshape(n, size) == top).any(axis=1)
            stay = open_[owner]
            if k == 0:
                h, owner = h[stay], owner[stay]
                p = np.tile(np.arange(size, dtype=np.uint16), (len(h), 1))
                rows, j = np.arange(len(h)), j[stay]
                p[rows, j] = 0
                p[rows, 0] = j
            elif stay.sum() < 0.7 * len(h) or not stay.any():
                h, owner, p = h[stay], owner[stay], p[stay]
            k += 1
    return out.reshape(n, size)
