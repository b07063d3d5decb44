"""Sketches as stored columns: distinct counts, quantiles and heavy hitters that are built once and merged as often as asked.

A table of sketches has a row for each group (a day and a kind, say). merge() gives those of coarser groups, whose answers have
the same bounds as if they had been built anew, from those rows alone; the table's rows are never read again. Distinct counts are HyperLogLog (2^lg_k registers,
relative error 1.04 / sqrt(2^lg_k) one time in three), quantiles are KLL (rank error about 2.3 / k^0.9). Heavy hitters are counted by
hash in `width` cells of `depth` rows (count-min), beside a list of candidates: an estimate is never too small, and too large by more than
2.72 / width of all rows with probability exp(-depth).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Distinct:
    """How many different values; nulls don't count."""

    column: str
    lg_k: int = 12

    def build(self) -> Column:
        return F.hll_sketch_agg(F.col(self.column), F.lit(self.lg_k))

    def merge(self, sketch: str) -> Column:
        return F.hll_union_agg(F.col(sketch), F.lit(True))

    def error(self) -> float:
        """Relative, one standard error."""
        return 1.04 / 2 ** (self.lg_k / 2)

    def estimate(self, sketch: str) -> Column:
        return F.hll_sketch_estimate(F.col(sketch))


@dataclass(frozen=True)
class Quantiles:
    """Quantiles of a number; nulls don't count."""

    column: str
    k: int = 400

    def build(self) -> Column:
        return F.kll_sketch_agg_double(F.col(self.column).cast("double"), F.lit(self.k))

    def merge(self, sketch: str) -> Column:
        return F.kll_merge_agg_double(F.col(sketch), F.lit(self.k))

    def error(self) -> float:
        """Of a rank, as a share of the rows, at 99 %."""
        return 2.296 / self.k**0.9021

    def estimate(self, sketch: str, share: float) -> Column:
        return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(share))

    def rank(self, sketch: str, value: Column) -> Column:
        return F.kll_sketch_get_rank_double(F.col(sketch), value)


def build(df: DataFrame, keys: list[str], sketches: dict[str, Distinct | Quantiles]) -> DataFrame:
    """One row a key: keys, rows, and each sketch by its name."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[s.build().alias(name) for name, s in sketches.items()])


def merge(table: DataFrame, keys: list[str], sketches: dict[str, Distinct | Quantiles]) -> DataFrame:
    """Rows of build() or merge() put together for coarser keys."""
    return table.groupBy(*keys).agg(F.sum("rows").alias("rows"), *[s.merge(name).alias(name) for name, s in sketches.items()])


@dataclass(frozen=True)
class Hitters:
    """Values that make up a share of `least` or more of a group's rows."""

    column: str
    width: int = 2048
    depth: int = 5
    least: float = 0.01

    def __post_init__(self):
        if not 0 < self.least <= 1 or self.width * self.least < 2.72:
            raise ValueError("width must be 2.72 / least or more, or every value could seem to be one")

    def _cell(self, row: Column) -> Column:
        return F.pmod(F.xxhash64(row, F.col("value")), F.lit(self.width))

    def build(self, df: DataFrame, keys: list[str], share: float = 0.5) -> tuple[DataFrame, DataFrame]:
        """(cells, candidates), both to be stored: cells (keys, row, cell, n), at most depth x width a group;
        candidates (keys, value): values that make up share x least of a group, found by counts (one aggregate, combined before its shuffle).
        A value that is a hitter of several groups together is one of at least one of them."""
        rows = df.where(F.col(self.column).isNotNull()).groupBy(*keys, F.col(self.column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        cells = rows.select(*keys, "value", "n", F.explode(F.array(*[F.lit(i) for i in range(self.depth)])).alias("row")).groupBy(*keys, "row", self._cell(F.col("row")).alias("cell")).agg(F.sum("n").alias("n"))
        totals = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("n").alias("_all"))
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        some = rows.join(totals, on).where(F.col("n") >= share * self.least * F.col("_all")).select(*keys, "value") if keys else rows.join(F.broadcast(totals)).where(F.col("n") >= share * self.least * F.col("_all")).select("value")
        return cells, some

    def merge(self, cells: DataFrame, keys: list[str]) -> DataFrame:
        return cells.groupBy(*keys, "row", "cell").agg(F.sum("n").alias("n"))

    def estimate(self, cells: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
        """(keys, value, n): hitters, by the least of their cells; n is never too small."""
        total = cells.where("row = 0").groupBy(*keys).agg(F.sum("n").alias("_all"))
        asked = candidates.select(*keys, "value").distinct().withColumn("row", F.explode(F.array(*[F.lit(i) for i in range(self.depth)]))).withColumn("cell", self._cell(F.col("row")))
        least = asked.join(cells, [*keys, "row", "cell"]).groupBy(*keys, "value").agg(F.min("n").alias("n"))
        both = least.join(total, keys) if keys else least.join(F.broadcast(total))
        return both.where(F.col("n") >= self.least * F.col("_all")).select(*keys, "value", "n")
