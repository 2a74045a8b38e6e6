"""Tables laid out by a hash bucket of their key: a batch reads and writes the buckets of its keys only.

A bucket is a partition folder, so a list of bucket numbers prunes the scan, and Spark's dynamic
partition overwrite replaces the folders of the buckets that change. The number of buckets is
fixed when the table is made: choose it so that a bucket is a file or a few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histkit.sources.files import materialize, path_exists

BUCKET, LOAD, FILLER = "_bucket", "_load", "_filler"
_OWN = (BUCKET, LOAD, FILLER)
# A bucket is written by up to this many tasks.
_PIECE, PIECES = "_piece", 16


@dataclass(frozen=True)
class BucketTable:
    """A folder of buckets. ``keys`` decide the bucket; null keys have one too.

    Each bucket that was ever written holds a filler row, which readers skip: a bucket that
    loses its last row can be overwritten, and an empty table has a schema.
    """

    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def exists(self, spark: SparkSession) -> bool:
        return path_exists(spark, self.path)

    def touched(self, keys: DataFrame) -> list[int]:
        """Buckets of these keys: at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket().alias(BUCKET)).distinct().collect())

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None, before: int | None = None) -> DataFrame:
        """All rows, or those of some buckets, or those of loads before a number."""
        rows = spark.read.parquet(self.path)
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(list(buckets)))
        if before is not None:
            rows = rows.where(F.col(LOAD) < before)
        return rows.where(~F.col(FILLER)).drop(*[c for c in _OWN if c != LOAD or before is None])

    def of_keys(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Rows whose key is among these; only their buckets are read. Null keys match nothing."""
        names = list(self.keys)
        found = self.read(keys.sparkSession, self.touched(keys), before)
        return found.join(keys.select(*names).distinct(), names, "left_semi").select(*found.columns)

    def _fillers(self, rows: DataFrame, buckets: Sequence[int]) -> DataFrame:
        spark = rows.sparkSession
        numbers = spark.createDataFrame([(b,) for b in buckets], f"{BUCKET} int")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != BUCKET]
        return numbers.select(BUCKET, *nothing).withColumn(FILLER, F.lit(True))

    def _placed(self, rows: DataFrame, buckets: Sequence[int]) -> DataFrame:
        placed = rows.withColumns({BUCKET: self.bucket()})
        placed = placed.withColumn(FILLER, F.lit(False)).unionByName(self._fillers(placed, buckets))
        # A few buckets would keep as few tasks busy, and later readers too: Spark joins pieces that are small.
        piece = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys], F.lit(1)), F.lit(PIECES))
        return placed.withColumn(_PIECE, piece).hint("rebalance", BUCKET, _PIECE).drop(_PIECE)

    def write(self, rows: DataFrame) -> None:
        """Make the table, or replace all of it."""
        self._placed(rows, [0]).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def replace(self, keys: DataFrame, rows: DataFrame) -> None:
        """The rows of these keys become ``rows``; all others stay, and untouched buckets keep their files.

        The new buckets are written apart first, as they are made of the ones that are replaced.
        """
        spark, names = rows.sparkSession, list(self.keys)
        touched = self.touched(keys)
        if not touched:
            return
        old = self.read(spark, touched)
        others = old.join(keys.select(*names).distinct(), names, "left_anti").select(*old.columns)
        new = materialize(self._placed(others.unionByName(rows.select(*old.columns)), touched), "buckets")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def append(self, rows: DataFrame, load: int) -> None:
        """Add the rows of a numbered load; a repeated load replaces its own rows."""
        placed = self._placed(rows, range(self.buckets)).withColumn(LOAD, F.lit(int(load)))
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD, BUCKET).parquet(self.path)


def newest_load(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows that several loads brought for one key, those of the newest load. Rows with a null in the key are left out.

    The last of the keys is a time, the others are what windows after this one part rows by: all share one shuffle. A
    join with the newest load of each key is taken for small, as it has few columns, and sent through the driver.
    """
    same = Window.partitionBy(*(keys[:-1] or keys)).orderBy(keys[-1]).rangeBetween(Window.currentRow, Window.currentRow)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    newest = rows.where(known).withColumn("_newest", F.max(LOAD).over(same)).where(F.col(LOAD) == F.col("_newest"))
    return newest.select(*keys, *[c for c in rows.columns if c not in (*keys, LOAD)])
