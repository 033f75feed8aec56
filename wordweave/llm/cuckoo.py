"""A cuckoo filter over digests."""

from __future__ import annotations

SLOTS = 4
MAX_KICKS = 200


class Overflow(Exception):
    """The filter found no place for a fingerprint; build a larger one from the stored keys."""


class CuckooFilter:
    """Set membership with deletion: 4 slots a bucket, 16-bit fingerprints, no false negative."""

    def __init__(self, capacity: int):
        self.buckets = 1 << max(0, (max(1, -(-capacity * 5 // (4 * SLOTS))) - 1).bit_length())
        self.table: list[list[int]] = [[] for _ in range(self.buckets)]
        self.victim = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") or 1
        first = int.from_bytes(digest[2:10], "big") % self.buckets
        return mark, first, self._other(first, mark)

    def _other(self, place: int, mark: int) -> int:
        # Exclusive or with a hash of the fingerprint: the way back needs no digest.
        return (place ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def __contains__(self, digest: bytes) -> bool:
        mark, a, b = self._places(digest)
        return mark in self.table[a] or mark in self.table[b]

    def insert(self, digest: bytes) -> None:
        mark, a, b = self._places(digest)
        for place in (a, b):
            if len(self.table[place]) < SLOTS:
                self.table[place].append(mark)
                return
        place = b
        for _ in range(MAX_KICKS):
            self.victim = (self.victim + 1) % SLOTS
            slots = self.table[place]
            mark, slots[self.victim] = slots[self.victim], mark
            place = self._other(place, mark)
            if len(self.table[place]) < SLOTS:
                self.table[place].append(mark)
                return
        raise Overflow

    def delete(self, digest: bytes) -> bool:
        """Remove one copy of an inserted digest; the caller has checked that it is stored."""
        mark, a, b = self._places(digest)
        for place in (a, b):
            if mark in self.table[place]:
                self.table[place].remove(mark)
                return True
        return False

    def to_bytes(self) -> bytes:
        return b"".join(m.to_bytes(2, "big") for slots in self.table for m in slots + [0] * (SLOTS - len(slots)))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        self = cls(1)
        self.buckets = len(raw) // (2 * SLOTS)
        marks = [int.from_bytes(raw[i : i + 2], "big") for i in range(0, len(raw), 2)]
        self.table = [[m for m in marks[i : i + SLOTS] if m] for i in range(0, len(marks), SLOTS)]
        return self
