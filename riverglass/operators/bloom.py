"""A Bloom filter for a stream's state; batch queries use exact keys."""

from __future__ import annotations

import math

import xxhash


class BloomFilter:
    """Membership of strings in a bit array, sized for a number of keys and a false-positive rate.

    Two 64-bit hashes give all bit places. put() of a key that seems present changes and counts nothing.
    """

    def __init__(self, capacity: int, fpp: float):
        self.capacity, self.fpp = capacity, fpp
        self.bits = max(1, math.ceil(-capacity * math.log(fpp) / math.log(2) ** 2))
        self.hashes = max(1, math.ceil(self.bits / capacity * math.log(2)))
        self.clear()

    def clear(self) -> None:
        """Forget all keys."""
        self.data, self.count = bytearray((self.bits + 7) // 8), 0

    def _places(self, key: str) -> list[int]:
        a, b = xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1
        return [(a + i * b) % self.bits for i in range(self.hashes)]

    def __contains__(self, key: str) -> bool:
        return all(self.data[p >> 3] >> (p & 7) & 1 for p in self._places(key))

    def put(self, key: str) -> bool:
        """Add a key; whether it was new."""
        if key in self:
            return False
        for p in self._places(key):
            self.data[p >> 3] |= 1 << (p & 7)
        self.count += 1
        return True

    def expected_fpp(self) -> float:
        """The false-positive rate at the present count."""
        return (1 - math.exp(-self.hashes * self.count / self.bits)) ** self.hashes

    def near_capacity(self, share: float = 0.9) -> bool:
        """Whether it is time to start an empty filter."""
        return self.count >= share * self.capacity
