"""Whether two tables hold the same rows, and which differ, without moving either.

Rows fall into buckets by a hash of their key. A bucket's digest is made of sums of the rows' hashes, so their order and the
number of files play no part, and equal rows count as often as they come. Both sides are read once for their digests, a row
a bucket. Only buckets that differ are looked into: their rows meet by key, in one aggregate and without a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import q

#: Buckets that differ and are looked into with one filter; more are joined.
LISTED = 1000


def _hash(columns: list[str], salt: int) -> Column:
    """Of values and of which are null: a null alone would leave no trace."""
    return F.xxhash64(F.lit(salt), *[x for c in columns for x in (F.col(q(c)), F.col(q(c)).isNull())])


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(_hash(keys, 1), F.lit(buckets))


def _sums(row: Column, prefix: str = "") -> list[Column]:
    """A hash's halves, each summed in 64 bits: exact up to 2^31 rows of a bucket."""
    return [F.sum(row.bitwiseAND(0xFFFFFFFF)).alias(f"{prefix}low"), F.sum(F.shiftrightunsigned(row, 32)).alias(f"{prefix}high")]


def digests(df: DataFrame, keys: list[str], buckets: int = 4096, columns: list[str] | None = None) -> DataFrame:
    """(bucket, n, low, high, other): to keep beside a table, or to compare. Rows of columns (default: all)."""
    columns = columns or df.columns
    rows = df.select(bucket_of(keys, buckets).alias("bucket"), _hash(columns, 2).alias("_a"), _hash(columns, 3).alias("_b"))
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *_sums(F.col("_a")), F.bit_xor("_b").alias("other"))


@dataclass
class Comparison:
    """buckets: how many there are; differing: those whose digests differ; rows: keys, status (missing, extra, changed), which
    columns differ, and how often the key comes on either side."""

    buckets: int
    differing: list[int]
    rows: DataFrame

    def same(self) -> bool:
        return not self.differing


def aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """right with left's columns in left's order and types."""
    known = {c.lower(): c for c in right.columns}
    if {c.lower() for c in left.columns} != set(known):
        raise ValueError(f"columns differ: {sorted({c.lower() for c in left.columns} ^ set(known))}")
    return right.select(*[F.col(q(known[f.name.lower()])).cast(f.dataType).alias(f.name) for f in left.schema])


def differing(a: DataFrame, b: DataFrame) -> list[int]:
    """Buckets whose digests differ, or that one side lacks: at most as many as there are buckets."""
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "low", "high", "other")]
    both = a.alias("a").join(b.alias("b"), F.col("a.bucket") == F.col("b.bucket"), "full")
    odd = both.where(~(same[0] & same[1] & same[2] & same[3])).select(F.coalesce("a.bucket", "b.bucket"))
    return sorted(r[0] for r in odd.collect())


def compare(left: DataFrame, right: DataFrame, keys: list[str], buckets: int = 4096, known: DataFrame | None = None) -> Comparison:
    """What right lacks, has too much, or has otherwise than left. known: digests of left that were kept (of as many buckets); then left
    is read only for what differs."""
    right = aligned(left, right)
    found = differing(known if known is not None else digests(left, keys, buckets), digests(right, keys, buckets))
    return Comparison(buckets, found, differences(left, right, keys, buckets, found))


def differences(left: DataFrame, right: DataFrame, keys: list[str], buckets: int, found: list[int]) -> DataFrame:
    """Rows of some buckets that differ."""
    values = [c for c in left.columns if c not in keys]
    spark = left.sparkSession

    def side(df: DataFrame, sign: int) -> DataFrame:
        at = bucket_of(keys, buckets)
        some = df.where(at.isin(found) if found else F.lit(False)) if len(found) <= LISTED else df.withColumn("_bucket", at).join(F.broadcast(_numbers(spark, found)), "_bucket", "left_semi").drop("_bucket")
        # equal keys differ by content as well: a key that comes twice is compared as a set of rows
        return some.select(*[F.col(q(k)) for k in keys], F.lit(sign).alias("_side"), _hash(df.columns, 2).alias("_row"), *[_hash([c], 5).alias(f"_v{i}") for i, c in enumerate(values)])

    both = side(left, 0).unionByName(side(right, 1))
    mine, theirs = F.col("_side") == 0, F.col("_side") == 1
    total = lambda c, test: [F.sum(F.when(test, F.col(c).bitwiseAND(0xFFFFFFFF))), F.sum(F.when(test, F.shiftrightunsigned(F.col(c), 32)))]
    pairs = lambda c: F.struct(*total(c, mine)).eqNullSafe(F.struct(*total(c, theirs)))
    names = F.array_compact(F.array(*[F.when(~pairs(f"_v{i}"), F.lit(c)) for i, c in enumerate(values)])) if values else F.array().cast("array<string>")
    rows = both.groupBy(*[F.col(q(k)) for k in keys]).agg(F.count_if(mine).alias("left_rows"), F.count_if(theirs).alias("right_rows"), pairs("_row").alias("_same"), names.alias("_names"))
    status = F.when(F.col("right_rows") == 0, "missing").when(F.col("left_rows") == 0, "extra").otherwise("changed")
    odd = rows.where(~F.col("_same") | (F.col("left_rows") != F.col("right_rows"))).withColumn("status", status)
    return odd.select(*[F.col(q(k)) for k in keys], "status", F.when(F.col("status") == "changed", F.col("_names")).otherwise(F.array().cast("array<string>")).alias("columns"), "left_rows", "right_rows")


def _numbers(spark: SparkSession, found: list[int]) -> DataFrame:
    return spark.createDataFrame([(b,) for b in found], "_bucket long")
