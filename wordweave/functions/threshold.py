"""Exact Jaccard thresholds on integers.

A similarity ``inter / (a + b - inter)`` is compared with ``num / den`` without any
division, so a value that equals the threshold is never lost to rounding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Threshold:
    """Keep pairs with similarity ``>= num/den``, or ``> num/den`` if not inclusive."""

    num: int
    den: int
    inclusive: bool = True

    def __post_init__(self) -> None:
        if not 0 < self.num <= self.den:
            raise ValueError("the threshold must be above 0 and at most 1")

    def _at_least(self, left: Column, left_factor: int, right: Column, right_factor: int) -> Column:
        left, right = (
            side.cast("bigint") * F.lit(factor) for side, factor in ((left, left_factor), (right, right_factor))
        )
        return left >= right if self.inclusive else left > right

    @property
    def admits_equal_sets(self) -> bool:
        return self.inclusive or self.num < self.den

    def overlap_suffices(self, inter: Column, total: Column) -> Column:
        """``total`` is the sum of both set sizes."""
        return self._at_least(inter, self.num + self.den, total, self.num)

    def similarity_suffices(self, inter: Column, union: Column) -> Column:
        return self._at_least(inter, self.den, union, self.num)

    def lengths_suffice(self, shorter: Column, longer: Column) -> Column:
        return self._at_least(shorter, self.den, longer, self.num)

    def prefix_length(self, size: str) -> Column:
        """``n - ceil(n * t) + 1`` in integers."""
        return F.expr(f"{size} - (bigint({size}) * {self.num} + {self.den - 1}) div {self.den} + 1")

    def _least_overlap_prefix(self, size: str, num: int, den: int) -> Column:
        needed = (
            f"(bigint({size}) * {num} + {den - 1}) div {den}"
            if self.inclusive
            else f"(bigint({size}) * {num}) div {den} + 1"
        )
        return F.expr(f"greatest({size} - ({needed}) + 1, 0)")

    def probe_prefix(self, size: str) -> Column:
        """Prefix that meets every similar set that is no longer than this one."""
        return self._least_overlap_prefix(size, self.num, self.den)

    def index_prefix(self, size: str) -> Column:
        """Prefix that meets every similar set that is no shorter than this one."""
        return self._least_overlap_prefix(size, 2 * self.num, self.num + self.den)


def shared_words(left: Column, right: Column) -> Column:
    """Size of the intersection of two sets given as arrays."""
    return F.size(F.array_intersect(left, right))


def jaccard(inter: Column, union: Column) -> Column:
    return inter.cast("double") / union.cast("double")


def unordered_pairs(n: str) -> Column:
    """``n * (n - 1) / 2`` as a decimal, which holds the pairs of any number of lines."""
    return F.expr(f"cast({n} div 2 as decimal(19,0)) * cast({n} - 1 + {n} % 2 as decimal(19,0))")
