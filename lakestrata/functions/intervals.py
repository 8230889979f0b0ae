"""Sets of batch numbers as intervals."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Intervals:
    """Whole numbers as disjoint ranges ``(low, high)`` in order, both ends included, none next to another."""

    ranges: tuple[tuple[int, int], ...] = ()

    @staticmethod
    def of(numbers: Iterable[int]) -> Intervals:
        return Intervals().add((n, n) for n in numbers)

    @staticmethod
    def read(cell: list) -> Intervals:
        return Intervals(tuple((a, b) for a, b in cell))

    def stored(self) -> list:
        return [list(r) for r in self.ranges]

    def add(self, more: Iterable[tuple[int, int]]) -> Intervals:
        """With further ranges; ranges that touch become one."""
        out: list[tuple[int, int]] = []
        for low, high in sorted([*self.ranges, *more]):
            if out and low <= out[-1][1] + 1:
                out[-1] = out[-1][0], max(high, out[-1][1])
            else:
                out.append((low, high))
        return Intervals(tuple(out))

    def __contains__(self, n: int) -> bool:
        k = bisect_right(self.ranges, (n, float("inf"))) - 1
        return k >= 0 and n <= self.ranges[k][1]

    @property
    def top(self) -> int:
        return self.ranges[-1][1] if self.ranges else 0

    def gaps(self) -> list[tuple[int, int]]:
        """The ranges between the set's ranges."""
        return [(a[1] + 1, b[0] - 1) for a, b in zip(self.ranges, self.ranges[1:])]

    def holds(self, column: str) -> Column:
        """Whether a column's value is in the set; a null isn't."""
        hit = F.lit(False)
        for low, high in self.ranges:
            hit = hit | F.col(column).between(low, high)
        return F.coalesce(hit, F.lit(False))
