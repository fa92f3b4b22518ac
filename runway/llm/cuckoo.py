"""A cuckoo filter over 64-bit keys: insertions, deletions, no false negatives."""

from __future__ import annotations

import numpy as np

from .textops import mix64

SLOTS = 4
MAX_ROUNDS = 400


class CuckooFilter:
    """Buckets of four 16-bit fingerprints (0 is empty); a key may lie in either
    of two buckets that follow from each other and its fingerprint.  A batch is
    inserted in rounds, at most one eviction per bucket and round.  Equal keys
    may be inserted several times (a filter can hold 8 of them at most) and
    are deleted one by one; deleting a key that was never inserted is an error
    of the caller, who keeps exact counts."""

    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16)

    @classmethod
    def of(cls, keys: np.ndarray, load: float = 0.8) -> CuckooFilter:
        """A filter of these keys, as large as they need."""
        buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * load)))))
        while True:
            made = cls(buckets)
            if made.insert(keys):
                return made
            buckets *= 2

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        made = cls(1)
        made.table = np.frombuffer(raw, dtype=np.uint16).reshape(-1, SLOTS).copy()
        return made

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix64(mark.astype(np.uint64)) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix64(np.asarray(keys).astype(np.int64).view(np.uint64) ^ np.uint64(0x5BF03635))
        mark = ((h >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        return (h & np.uint64(len(self.table) - 1)).astype(np.int64), mark

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, mark = self._place(keys)
        here = (self.table[bucket] == mark[:, None]).any(axis=1)
        return here | (self.table[self._other(bucket, mark)] == mark[:, None]).any(axis=1)

    def _settle(self, bucket: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fill free slots; returns which items found none, and of those the
        first of each bucket."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        begin = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        rank = np.arange(len(b)) - np.repeat(begin, np.diff(np.r_[begin, len(b)]))
        free = self.table[b] == 0
        room = free.sum(axis=1)
        fits = rank < room
        nth = np.cumsum(free, axis=1) - 1 == rank[:, None]
        slot = (nth & free).argmax(axis=1)
        self.table[b[fits], slot[fits]] = mark[order[fits]]
        left = np.zeros(len(b), dtype=bool)
        left[order[~fits]] = True
        first = np.zeros(len(b), dtype=bool)
        first[order[~fits & (rank == room)]] = True
        return left, first

    def insert(self, keys: np.ndarray) -> bool:
        """Insert all keys; False (and an unusable filter) if they do not fit."""
        bucket, mark = self._place(keys)
        rng = np.random.default_rng(7)
        for turn in range(MAX_ROUNDS):
            if not len(bucket):
                return True
            left, first = self._settle(bucket, mark)
            if turn % 2:  # both buckets are full: one item of each evicts another
                evict = np.flatnonzero(first)
                slot = rng.integers(0, SLOTS, len(evict))
                out = self.table[bucket[evict], slot].copy()
                self.table[bucket[evict], slot] = mark[evict]
                mark = mark.copy()
                mark[evict] = out
            bucket, mark = bucket[left], mark[left]
            bucket = self._other(bucket, mark)
        return not len(bucket)

    def delete(self, keys: np.ndarray) -> None:
        """Delete each key once, in rounds of one key per bucket."""
        bucket, mark = self._place(keys)
        moved = np.zeros(len(bucket), dtype=bool)
        while len(bucket):
            _, one = np.unique(bucket, return_index=True)
            hit = self.table[bucket[one]] == mark[one, None]
            found = hit.any(axis=1)
            self.table[bucket[one[found]], hit.argmax(axis=1)[found]] = 0
            stays = np.ones(len(bucket), dtype=bool)
            stays[one[found]] = False
            miss = one[~found]
            stays[miss[moved[miss]]] = False
            moved[miss] = True
            bucket[miss] = self._other(bucket[miss], mark[miss])
            bucket, mark, moved = bucket[stays], mark[stays], moved[stays]
