"""Figures of a run, aggregated over its tasks: one row a task in, one row in all out; each has a value for no tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def _sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def _mean(c: str) -> Column:
    """The mean without its fraction."""
    return F.coalesce(F.expr(f"cast(sum({c}) as bigint) div nullif(count({c}), 0)"), F.lit(0)).cast("long")


def _most(c: str, none: int) -> Column:
    return F.coalesce(F.max(c), F.lit(none)).cast("long")


#: Figure -> its aggregate over the tasks' values of a column.
AGGREGATES = {
    "RecordsProcessed": _sum,
    "BytesProcessed": _sum,
    "ArchiveCompressedBytesProcessed": _sum,
    "ArchiveObjectsProcessed": _sum,
    "ArchiveDatabaseRowCount": _sum,
    "KafkaOffset": _sum,
    "RecordsPerSecond": _mean,
    "BytesPerSecond": _mean,
    "ArchiveDatabaseRowAvgLatency": _mean,
    "ArchiveDatabaseRowMaxLatency": lambda c: _most(c, LONG_MIN),
    "ArchiveDatabaseRowMinLatency": lambda c: F.coalesce(F.min(c), F.lit(LONG_MAX)).cast("long"),
    "ArchiveOffset": lambda c: _most(c, -1),
    "LatestKafkaTimestamp": lambda c: _most(c, 0),
}


def aggregate(tasks: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row with each figure in ``columns`` (figure -> column of ``tasks``)."""
    return tasks.agg(*[AGGREGATES[figure](c).alias(figure) for figure, c in columns.items()])


def observed(events: DataFrame, name: str = "events") -> DataFrame:
    """Events whose number, bytes and last time a streaming listener or an Observation can read, without another pass."""
    return events.observe(name, F.count(F.lit(1)).alias("RecordsProcessed"), F.coalesce(F.sum(F.octet_length("_raw")), F.lit(0)).alias("BytesProcessed"), F.max("_time").alias("LatestTimestamp"))


#: What the source's tasks write (option ``figures``), one JSON line a task.
TASKS = """records bigint, bytes bigint, compressed_bytes bigint, objects bigint, denied_objects bigint, archive_offset bigint, tail_offset bigint, latest_tail_timestamp bigint, seconds double,
records_per_second bigint, bytes_per_second bigint, object_rows bigint, object_milliseconds bigint, object_milliseconds_most bigint, object_milliseconds_least bigint"""
#: Figure -> column of a task.
PRODUCED = {
    "RecordsProcessed": "records", "BytesProcessed": "bytes", "ArchiveCompressedBytesProcessed": "compressed_bytes", "ArchiveObjectsProcessed": "objects", "ArchiveDatabaseRowCount": "object_rows", "KafkaOffset": "tail_offset",
    "RecordsPerSecond": "records_per_second", "BytesPerSecond": "bytes_per_second", "ArchiveDatabaseRowAvgLatency": "object_milliseconds", "ArchiveDatabaseRowMaxLatency": "object_milliseconds_most",
    "ArchiveDatabaseRowMinLatency": "object_milliseconds_least", "ArchiveOffset": "archive_offset", "LatestKafkaTimestamp": "latest_tail_timestamp",
}


def produced(spark: SparkSession, folder: str) -> DataFrame:
    """One row with all figures of the tasks that wrote to a folder. A task that ran twice wrote twice: figures are for watching, not for accounts."""
    return aggregate(spark.read.schema(TASKS).json(folder), PRODUCED)
