"""Cuckoo filters over 64-bit key hashes: membership with insertion and deletion."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from tidemark.llm.shingles import mix

SLOTS = 4
LOAD = 0.8
MAX_KICKS = 400


def _places(keys: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint (never 0) and both buckets of each key."""
    scrambled = mix(keys.astype(np.uint64))
    print_ = (scrambled >> np.uint64(48)).astype(np.uint16)
    print_[print_ == 0] = 1
    first = (scrambled & np.uint64(n_buckets - 1)).astype(np.int64)
    return print_, first, _other(print_, first, n_buckets)


def _other(print_: np.ndarray, bucket: np.ndarray, n_buckets: int) -> np.ndarray:
    return bucket ^ (mix(print_.astype(np.uint64)) & np.uint64(n_buckets - 1)).astype(np.int64)


def _fill(table: np.ndarray, print_: np.ndarray, bucket: np.ndarray) -> bool:
    """Puts all fingerprints into the table, evicting where buckets are full; False if stuck."""
    n = len(table)
    rng = np.random.default_rng(len(print_))
    for _ in range(MAX_KICKS):
        if len(print_) == 0:
            return True
        order = np.argsort(bucket, kind="stable")
        print_, bucket = print_[order], bucket[order]
        rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
        used = (table != 0).sum(axis=1)[bucket]
        fits = used + rank < SLOTS
        for b, f in ((bucket[fits], print_[fits]),):
            # Free slots of a bucket are filled in order, one per rank.
            free = np.argsort(table[b] != 0, axis=1, kind="stable")
            table[b, free[np.arange(len(b)), rank[fits]]] = f
        print_, bucket, rank = print_[~fits], bucket[~fits], rank[~fits]
        # Of those left, the first at each bucket swaps with a resident; the others move on.
        swap = np.concatenate(([True], bucket[1:] != bucket[:-1])) if len(bucket) else rank > 0
        slot = rng.integers(0, SLOTS, len(bucket))
        evicted = table[bucket, slot]
        table[bucket[swap], slot[swap]] = print_[swap]
        print_ = np.where(swap, evicted, print_)
        bucket = _other(print_, bucket, n)
    return len(print_) == 0


def build(keys: np.ndarray) -> bytes:
    """A filter that holds each of ``keys`` once."""
    n_buckets = 1
    while n_buckets * SLOTS * LOAD < len(keys):
        n_buckets *= 2
    while True:
        table = np.zeros((n_buckets, SLOTS), np.uint16)
        print_, first, _ = _places(keys, n_buckets)
        if _fill(table, print_, first):
            return table.tobytes()
        n_buckets *= 2


def _table(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16).reshape(-1, SLOTS)


def contains(segments: Sequence[bytes], keys: np.ndarray) -> np.ndarray:
    """Whether a key may be in one of the segments; never wrong on a key that is."""
    found = np.zeros(len(keys), bool)
    for data in segments:
        table = _table(data)
        print_, first, second = _places(keys, len(table))
        found |= (table[first] == print_[:, None]).any(axis=1)
        found |= (table[second] == print_[:, None]).any(axis=1)
    return found


def _added(table: np.ndarray, keys: np.ndarray) -> np.ndarray | None:
    """The table with ``keys`` too, if they fit."""
    if (table != 0).sum() + len(keys) > LOAD * table.size:
        return None
    table = table.copy()
    print_, first, _ = _places(keys, len(table))
    return table if _fill(table, print_, first) else None


def insert(segments: Sequence[bytes], keys: np.ndarray) -> list[bytes]:
    """Adds keys that aren't held yet: into the last segment if it has room, else new ones.

    All segments have the size of the first. Two keys that ``delete`` takes for each other in one
    segment are then the same to all, and it doesn't matter whose fingerprint goes.
    """
    segments = list(segments)
    if len(keys) == 0:
        return segments
    if not segments:
        return [build(keys)]
    table = _added(_table(segments[-1]), keys)
    if table is not None:
        return segments[:-1] + [table.tobytes()]
    empty, waiting = np.zeros_like(_table(segments[-1])), [keys]
    while waiting:
        part = waiting.pop()
        table = _added(empty, part)
        if table is None:
            waiting += np.array_split(part, 2)
        else:
            segments.append(table.tobytes())
    return segments


def delete(segments: Sequence[bytes], keys: np.ndarray) -> list[bytes]:
    """Takes out one fingerprint of each key, which must have been inserted; segments must be of
    one size, as ``insert`` makes them."""
    tables = [_table(s).copy() for s in segments]
    for key in keys:
        for table in tables:
            print_, first, second = _places(np.array([key]), len(table))
            spots = [(b, s) for b in (first[0], second[0])
                     for s in np.flatnonzero(table[b] == print_[0])]
            if spots:
                table[spots[0]] = 0
                break
    return [t.tobytes() for t in tables]
