"""Pages of an order, whose cost does not grow with their number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.store import fresh, release, written

PLACE_BITS = 33  # of a place within its partition


class Pages:
    """Rows in the order of the columns, laid out once: range-partitioned, sorted within partitions and written with their places.

    The driver knows how many rows each partition has, so a page is a range of places in one partition or a few neighbours. The filter
    reaches the scan, which skips all row groups but those of the page; nothing but the page is sorted.
    """

    def __init__(self, df: DataFrame, order: list[str]):
        (self._at,) = fresh(df, "at")
        self.columns = df.columns
        self._rows = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(self._at, F.monotonically_increasing_id()), "pages")
        part = F.shiftright(self._at, PLACE_BITS)
        self._counts = sorted((r[0], r[1]) for r in self._rows.groupBy(part).count().collect())  # a row for each partition
        self.total = sum(n for _, n in self._counts)

    def places(self, first: int, n: int) -> list[tuple[int, int]]:
        """Ranges of places that hold the rows from first on, both ends included."""
        out, before = [], 0
        for part, count in self._counts:
            lo, hi = max(first - before, 0), min(first + n - before, count) - 1
            if lo <= hi:
                out.append(((part << PLACE_BITS) + lo, (part << PLACE_BITS) + hi))
            before += count
        return out

    def scan(self, first: int, n: int) -> DataFrame:
        """n rows from first (0, 1, ...) on, with their places, in no order."""
        ranges = [F.col(self._at).between(lo, hi) for lo, hi in self.places(first, n)]
        return self._rows.where(reduce(lambda a, b: a | b, ranges, F.lit(False)))

    def page(self, number: int, size: int) -> DataFrame:
        """The page (0, 1, ...) in order."""
        return self.scan(number * size, size).orderBy(self._at).select(*self.columns)

    def close(self) -> None:
        release(self._rows)
