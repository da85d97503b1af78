"""Words, lines and their hashes over the bytes of many texts at once.

UTF-8 keeps every non-ASCII code point in bytes of 0x80 and more, so word classes that
are given by ASCII characters are found on bytes, with numpy instead of a loop.
"""

from __future__ import annotations

import numpy as np
import xxhash

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Words `[^\x20\x09-\x0D]+`.
SPACED = ~SPACE
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z were lower-cased.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
#: Longer words are hashed one by one.
_LANES = 32


def words(buf: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and the first word of each text (one more at the end)."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = kind[buf]
    edge = inside[1:] != inside[:-1]
    starts, ends = edge & inside[1:], edge & inside[:-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(buf))]
    both = cut[inside[cut] & inside[cut + 1]]
    starts[both] = ends[both] = True
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    return s, e, np.searchsorted(s, offsets)


def single_spaced(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words with one blank after each, and where each begins (and the end)."""
    lengths = e - s
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    if not len(s):
        return b"", begin
    take = np.repeat(s - begin[:-1], lengths + 1) + np.arange(begin[-1])
    joined = buf[np.minimum(take, len(buf) - 1)]
    joined[begin[1:] - 1] = 0x20
    return joined.tobytes(), begin


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    n = (e - s).astype(np.int64)
    h = n.astype(np.uint64) * _A
    if not len(s):
        return h
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))
    live = np.arange(len(s))
    for k in range(_LANES):
        left = n[live] - 8 * k
        if k:
            live = live[left > 0]
            left = n[live] - 8 * k
        if not len(live):
            break
        lane = lanes[s[live] + 8 * k]
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix((h[live] ^ lane) * _A + _B)
    for i in np.flatnonzero(n > 8 * _LANES):
        h[i] = xxhash.xxh3_64_intdigest(buf[s[i] : e[i]].tobytes(), 7)
    return h


def windows(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words within a text, and the word each starts at."""
    if len(h) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        total = (total + h[k : k + len(total)]) * _A
    ok = np.ones(len(total), bool)
    for back in range(1, size):  # windows that would run into the next text
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < len(total))]] = False
    at = np.flatnonzero(ok)
    return mix(total[at]), at


def cover(at: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``size`` words that starts in ``at``."""
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return np.cumsum(step[:-1]) > 0


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of flags between successive bounds."""
    run = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return run[bounds[1:]] - run[bounds[:-1]]
