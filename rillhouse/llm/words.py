"""Word and shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Fixed random odd numbers.
POWER = 0xD6E8FEB86659FD93
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7,
                  0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xFF51AFD7ED558CCD], np.uint64)
#: Bytes of text hashed in one go; a longer text is one go of its own.
CHUNK = 1 << 19
MASK = (1 << 64) - 1
BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """The finisher of the public splitmix64 generator."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", POWER), ("down", pow(POWER, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, one text after the other, and how many each text has.

    Words are runs without blank, tab, line feed, vertical tab, form feed or carriage return, A-Z in lower case.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))  # word starts and ends in turn
    start, end = edge[::2], edge[1::2]
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.take(BYTES, lower, out=total[1:])
    total[1:] *= up[:-1]
    np.cumsum(total[1:], out=total[1:])
    h = mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return h, np.bincount(np.searchsorted(np.cumsum(sizes), start, side="right"), minlength=len(texts))


def shingles(h: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``n`` words within each text, repeats included, and how many each text has.

    A text with fewer words, but some, has its whole sequence as one.
    """
    starts = np.cumsum(counts) - counts
    have = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    lead = np.cumsum(have) - have
    at = np.repeat(starts - lead, have) + np.arange(have.sum())
    short = np.repeat(counts, have)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        step = STEPS[k % len(STEPS)] * np.uint64(2 * (k // len(STEPS)) + 1)
        out += np.where(k < short, h[np.minimum(at + k, max(len(h) - 1, 0))] * step, np.uint64(0)) if len(h) else out
    return mixed(out + np.minimum(short, n).astype(np.uint64)), have


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Neighbouring texts of about ``CHUNK`` bytes together, with the place of the first."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > CHUNK:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]
