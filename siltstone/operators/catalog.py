"""The catalog: which streams exist, which hourly objects they have, and what a query needs of them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import paths
from siltstone.plans.conditions import NAMES, on_objects, on_streams
from siltstone.plans.query import Node

#: A table that the catalog joins is broadcast while it is known to be below this size; beyond it Spark chooses.
BROADCAST_BYTES = 32 << 20


@dataclass(frozen=True)
class Catalog:
    """The relations of a catalog. Streams: log_group(id, name), stream(id, gid, directory, stream, tag), stream_host(id, name, gid).
    Objects: logfile, host(id, name), bucket(id, name), logtag(id, logtag), corrupted(logfile_id)."""

    log_group: DataFrame
    stream: DataFrame
    stream_host: DataFrame
    logfile: DataFrame
    host: DataFrame
    bucket: DataFrame
    logtag: DataFrame
    corrupted: DataFrame


def small(df: DataFrame) -> DataFrame:
    """Broadcast if Spark's own estimate of the size allows it."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def streams(c: Catalog, condition: Column | None = None) -> DataFrame:
    """(directory, stream, tag_id, host, host_id) of the streams that fulfil a condition on directory, stream and host."""
    g = c.log_group.select(F.col("id").alias("gid"))
    s = c.stream.select("gid", "directory", "stream", "tag")
    h = c.stream_host.select("gid", F.col("name").alias("host"))
    out = s.join(small(g), "gid").join(small(h), "gid")
    out = out.join(small(c.host.select(F.col("id").alias("host_id"), F.col("name").alias("host"))), "host")
    out = out.join(small(c.logtag.select(F.col("id").alias("tag_id"), F.col("logtag").alias("tag"))), "tag")
    if condition is not None:
        out = out.where(condition)
    return out.select("directory", "stream", "tag_id", "host", "host_id")


def streams_for(c: Catalog, node: Node, compat: bool = False) -> DataFrame:
    return streams(c, on_streams(node, F.col("directory"), F.col("stream"), F.col("host"), compat))


def objects(c: Catalog, chosen: DataFrame, zone: str = "UTC") -> DataFrame:
    """The objects of streams, with the hour of each, without corrupted ones; an object without an hour in its path isn't one.

    The streams are joined first, so that logfile, the only large relation, is pruned by them and by its day.
    """
    files = c.logfile.select("id", "logdate", "bucket_id", "path", "host_id", "logtag_id", "file_size", "uncompressed_file_size")
    keyed = chosen.select("directory", "stream", "host", "host_id", F.col("tag_id").alias("logtag_id"))
    out = files.join(small(keyed), ["host_id", "logtag_id"]).withColumn("logtime", paths.logtime(F.col("path"), zone)).where("logtime is not null")
    return out.join(small(c.corrupted.select(F.col("logfile_id").alias("id"))), "id", "left_anti")


def enriched(c: Catalog, found: DataFrame) -> DataFrame:
    """Objects with the names of bucket and tag: what a reader needs."""
    out = found.join(small(c.bucket.select(F.col("id").alias("bucket_id"), F.col("name").alias("bucket"))), "bucket_id")
    out = out.join(small(c.logtag.select(F.col("id").alias("logtag_id"), "logtag")), "logtag_id")
    return out.select("id", "directory", "stream", "host", "logtag", "logdate", "bucket", "path", "logtime", "file_size", "uncompressed_file_size")


def objects_for(c: Catalog, node: Node, term=None, zone: str = "UTC", compat: bool = False) -> DataFrame:
    """The enriched objects that may have rows for a query."""
    found = objects(c, streams_for(c, node, compat), zone)
    names = dict(zip(NAMES, (F.col("directory"), F.col("stream"), F.col("host")), strict=True))
    return enriched(c, found.where(on_objects(node, names, F.col("logtime"), F.col("logdate"), term, compat)))


def hour_range(found: DataFrame, after: int, last: int, before: int | None = None) -> DataFrame:
    """Objects of the hours from ``after`` (exclusive) to ``last`` (inclusive) and, if given, earlier than ``before``."""
    out = found.where((F.col("logtime") > after) & (F.col("logtime") <= last))
    return out if before is None else out.where(F.col("logtime") < before)


def next_hour(found: DataFrame, after: int, before: int | None = None) -> DataFrame:
    """(logtime, size) of the first hour after ``after``: at most one row."""
    out = found.where(F.col("logtime") > after)
    out = out if before is None else out.where(F.col("logtime") < before)
    return out.groupBy("logtime").agg(F.sum("file_size").alias("size")).orderBy("logtime").limit(1)


def load(spark: SparkSession, root: str, names: Mapping[str, str] | None = None) -> Catalog:
    """A catalog from tables below a folder, by the names of its relations or others that ``names`` maps them to (also in other folders)."""
    named = names or {}
    return Catalog(**{f.name: spark.read.parquet(f"{root}/{named.get(f.name, f.name)}.parquet") for f in fields(Catalog)})


def materialise(found: DataFrame, path: str) -> DataFrame:
    """Enriched objects written out by day, for planners that ask for one range of hours after the other; a day's files alone are read for it."""
    found.repartition("logdate").write.mode("overwrite").partitionBy("logdate").parquet(path)
    return found.sparkSession.read.parquet(path)


def of_hours(slice_: DataFrame, after: int, last: int) -> DataFrame:
    """The objects of the hours from ``after`` (exclusive) to ``last`` (inclusive) of a materialised slice, whose other days are pruned."""
    day = lambda t: F.to_date(F.timestamp_seconds(F.lit(t)))
    near = (F.col("logdate") >= F.date_sub(day(after), 1)) & (F.col("logdate") <= F.date_add(day(last), 1))
    return hour_range(slice_.where(near), after, last)
