"""What the operators of this subpackage share: tables, shared scratch storage and sizing."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.sources.shared import shared_folder, spread

#: Estimates from here on say that Spark doesn't know a size.
UNKNOWN_BYTES = 1 << 50
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def words_of(c: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while wish in have:
        wish += "_"
    return wish


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive lost executors.

    A table goes when ``drop`` is called or when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        self.names = 0
        atexit.register(self.clear)

    def save(self, df: DataFrame) -> DataFrame:
        self.names += 1
        path = f"{self.folder}/{self.names}"
        cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(cleanup, None)
        self.spark.conf.set(cleanup, "true")  # what the write has shuffled isn't needed beyond it
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(cleanup) if before is None else self.spark.conf.set(cleanup, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *saved: DataFrame) -> None:
        for df in saved:
            self._delete(df.scratch_path)

    def clear(self) -> None:
        atexit.unregister(self.clear)
        if self.spark.sparkContext._jsc is not None:
            try:
                self._delete(self.folder)
            except Exception:  # the driver is ending; what is left goes with the folder
                pass

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Rows (a few numbers each) that may be broadcast, of tables whose rows are counted.
BROADCAST_ROWS = 400_000


def small(saved: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A saved table, to be broadcast if it has few rows; beyond, Spark joins by a shuffle and splits what is skewed."""
    return F.broadcast(saved) if saved.count() <= most else saved


def shuffle_count(spark: SparkSession, df: DataFrame, times: float = 1.0, target: int = 32 << 20) -> int:
    """Partitions for a shuffle of about ``times`` the input's bytes, ``target`` bytes each.

    Never fewer than the session's own setting, which counts alone where Spark knows no size; it grows with the input,
    so one partition doesn't. Beyond 100,000, where the driver's own book-keeping would be the limit, partitions grow; what reads
    them takes them in sorted order, a bounded part at a time.
    """
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = float(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= UNKNOWN_BYTES:  # Spark has no estimate, or a product of a join's sides
        return own
    return max(own, min(100_000, int(size * times / target) + 1))
