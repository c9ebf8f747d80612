"""Pages of any depth: rows are sorted once by ranges, and a page is read from the ranges that hold it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sheets import kept

BLOCK, ROW = "__block", "__row"


class Pages:
    """df in its order, as a table whose rows know their range and their place in it.

    The driver keeps one count a range. A page asks for one or a few ranges by name, which prunes folders, and for their places, which
    skips row groups; its rows alone are sorted again. So the ten thousandth page costs as much as the first, and no task ever holds a top
    of all rows before it. ``order`` should tell all rows apart; rows that it doesn't are in any order, the same on every page.
    """

    def __init__(self, df: DataFrame, order: list[Column]) -> None:
        ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
        placed = ranged.withColumns({BLOCK: F.expr("cast(shiftright(__id, 33) as int)"), ROW: F.expr("__id & 8589934591")}).drop("__id")
        self.rows = kept(placed, BLOCK)
        self.counts = sorted((r[BLOCK], r["n"]) for r in self.rows.groupBy(BLOCK).agg(F.count("*").alias("n")).collect())
        self.total = sum(n for _, n in self.counts)

    def last(self, size: int) -> int:
        return max(1, -(-self.total // size))

    def page(self, number: int, size: int = 100) -> DataFrame:
        """Rows of one page, numbered from 1; ``number`` is clamped to the pages that there are."""
        first = (max(1, min(number, self.last(size))) - 1) * size
        wanted, before = F.lit(False), 0
        for block, n in self.counts:
            low, high = max(first - before, 0), min(first + size - before, n)
            if low < high:
                wanted = wanted | ((F.col(BLOCK) == block) & (F.col(ROW) >= low) & (F.col(ROW) < high))
            before += n
        return self.rows.filter(wanted).orderBy(BLOCK, ROW).drop(BLOCK, ROW)
