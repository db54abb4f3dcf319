"""Word shingles as 64-bit hashes, computed for many texts at once inside a task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when a longer block comes."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = max(n, BLOCK)
            up = np.full(size, _BASE)
            down = np.full(size, _BASE_INVERSE)
            up[0] = down[0] = 1
            cls.up, cls.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return cls.up[:n], cls.down[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums of ``byte * base**i``: the difference of two belongs to the bytes between."""
    up, _ = Powers.upto(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each ``data[start:end]`` that doesn't depend on where it stands."""
    _, down = Powers.upto(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _block_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each run of bytes other than ASCII white space."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    return slice_hashes(prefix_hashes(raw), starts, ends), starts


def _cut_points(data: bytes) -> Iterator[tuple[int, int]]:
    """Blocks of about BLOCK bytes that end at white space, so that no word is cut."""
    at, gaps = 0, b" \t\n\v\f\r"
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and data[end] not in gaps:
            end += 1
        yield at, end
        at = end


def word_hashes(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words, A-Z lower-cased; short texts share one block."""
    waiting: list[bytes] = []
    size = 0

    def flush():
        data = b" ".join(waiting)
        hashes, starts = _block_words(data)
        bounds = np.cumsum([0] + [len(w) + 1 for w in waiting])
        cuts = np.searchsorted(starts, bounds)
        for a, b in zip(cuts, cuts[1:]):
            yield hashes[a:b]

    for text in texts:
        data = (text or "").encode().lower()  # of bytes, lower() changes A-Z only
        if size + len(data) > BLOCK and waiting:
            yield from flush()
            waiting, size = [], 0
        if len(data) > BLOCK:
            yield np.concatenate([_block_words(data[a:b])[0] for a, b in _cut_points(data)])
        else:
            waiting.append(data)
            size += len(data) + 1
    if waiting:
        yield from flush()


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; of fewer words, that of all of them."""
    if len(words) == 0:
        return words
    width = min(n, len(words))
    h = words[: len(words) - width + 1]
    for j in range(1, width):
        h = mix(h) * np.uint64(0xD6E8FEB86659FD93) + words[j: len(words) - width + 1 + j]
    return np.unique(mix(h + np.uint64(width)))
