"""A cuckoo filter over 64-bit codes: membership without false negatives, with insertion **and** deletion.

A code has a 16-bit fingerprint and two buckets of four slots; each bucket follows from the other and the
fingerprint, so that a fingerprint can move without its code.  A fingerprint that finds no place after many moves goes to a small
list beside the table, so no insertion fails.  A code must be inserted once and deleted at most once.
"""

from __future__ import annotations

import numpy as np

from stockwise.llm.textbytes import mixed

SLOTS = 4
#: Share of the slots that are filled before a filter counts as full.
LOAD = 0.85
MOVES = 500


class CuckooFilter:
    def __init__(self, buckets: int):
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.beside: list[tuple[int, int]] = []

    @staticmethod
    def buckets_for(codes: int) -> int:
        """A power of two with room for ``codes``."""
        return 1 << max(2, int(np.ceil(np.log2(max(1, codes) / (SLOTS * LOAD)))))

    @property
    def capacity(self) -> int:
        return int(self.table.size * LOAD)

    def _places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        marks = (codes >> np.uint64(48)) % np.uint64(0xFFFF) + np.uint64(1)
        first = (codes & np.uint64(len(self.table) - 1)).astype(np.int64)
        return marks, first, self._other(first, marks)

    def _other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return bucket ^ (mixed(marks) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, codes: np.ndarray) -> np.ndarray:
        marks, first, second = self._places(codes)
        short = marks.astype(np.uint16)[:, None]
        found = (self.table[first] == short).any(axis=1) | (self.table[second] == short).any(axis=1)
        for bucket, mark in self.beside:
            found |= (marks == mark) & ((first == bucket) | (second == bucket))
        return found

    def insert(self, codes: np.ndarray) -> None:
        marks, first, second = self._places(codes)
        left = np.arange(len(codes))
        for buckets in (first, second):
            # The k-th code of a bucket takes its k-th free slot, all buckets at once.
            left = left[np.argsort(buckets[left], kind="stable")]
            own = buckets[left]
            place = np.arange(len(left)) - np.searchsorted(own, own)
            free = (self.table[own] == 0).sum(axis=1)
            fits = place < free
            put, rows = left[fits], own[fits]
            slot = np.argsort(self.table[rows] != 0, axis=1, kind="stable")[np.arange(len(put)), place[fits]]
            self.table[rows, slot] = marks[put]
            left = left[~fits]
        for k in left.tolist():
            self._push(int(second[k]), int(marks[k]))

    def _push(self, bucket: int, mark: int) -> None:
        for step in range(MOVES):
            row = self.table[bucket]
            empty = np.flatnonzero(row == 0)
            if len(empty):
                row[empty[0]] = mark
                return
            at = (step + mark) % SLOTS
            mark, row[at] = int(row[at]), mark
            bucket = int(self._other(np.array([bucket]), np.array([mark], np.uint64))[0])
        self.beside.append((bucket, mark))

    def delete(self, codes: np.ndarray) -> None:
        marks, first, second = self._places(codes)
        for mark, one, two in zip(marks.tolist(), first.tolist(), second.tolist(), strict=True):
            for bucket in (one, two):
                at = np.flatnonzero(self.table[bucket] == mark)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break
                if (bucket, mark) in self.beside:
                    self.beside.remove((bucket, mark))
                    break

    def to_bytes(self) -> bytes:
        head = np.array([len(self.table), len(self.beside)], "<i8")
        return head.tobytes() + np.array(self.beside, "<i8").tobytes() + self.table.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        buckets, beside = np.frombuffer(raw, "<i8", 2).tolist()
        out = cls.__new__(cls)
        out.beside = [tuple(x) for x in np.frombuffer(raw, "<i8", 2 * beside, 16).reshape(-1, 2).tolist()]
        out.table = np.frombuffer(raw, "<u2", buckets * SLOTS, 16 + 16 * beside).astype(np.uint16).reshape(buckets, SLOTS)
        return out
