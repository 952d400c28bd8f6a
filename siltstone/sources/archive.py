"""Batch reading of archive objects: gzip'd RFC 5424 records, decoded into the nine-column relation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import envelopes, syslog
from siltstone.functions.paths import path_timestamp

#: Inflated bytes that are held at once while an object is cut into lines.
PIECE = 1 << 20


def lines(data: bytes) -> Iterator[bytes]:
    """The lines of an object, which may be gzip'd (several members too) or plain."""
    if data[:2] != b"\x1f\x8b":
        yield from (x for x in data.split(b"\n") if x)
        return
    rest, tail = data, b""
    while rest:
        inflate = zlib.decompressobj(31)
        while True:
            piece = inflate.decompress(rest, PIECE)
            tail += piece
            *whole, tail = tail.split(b"\n")
            yield from (x for x in whole if x)
            rest = inflate.unconsumed_tail
            if inflate.eof or not (piece or rest):
                break
        rest = inflate.unused_data
    if tail:
        yield tail


def _explode(first_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                at, rows = 0, []
                for x in lines(data or b""):
                    rows.append(x.decode("utf-8", "replace"))
                    if first_only or len(rows) == 4096:
                        yield _lines(path, rows, at)
                        at, rows = at + len(rows), []
                        if first_only:
                            break
                if rows:
                    yield _lines(path, rows, at)

    return run


def _lines(path: str, rows: list[str], at: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"object": pa.array([path] * len(rows)), "offset": pa.array(range(at + 1, at + 1 + len(rows)), pa.int64()), "value": pa.array(rows)})


def read_lines(spark: SparkSession, root: str, first_only: bool = False) -> DataFrame:
    """(object, offset, value) of all objects below a folder of any store that Spark reads; offsets count from 1.

    Objects are told apart by content, not by name: ``x.gz.4`` is inflated too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", "content").mapInArrow(_explode(first_only), "object string, offset bigint, value string")


def events(spark: SparkSession, root: str, objects: DataFrame, skip_bad: bool = False) -> DataFrame:
    """The nine columns for the catalog's objects (id, directory, stream, host, path, ...) whose files lie below ``root``.

    A line that is no record ends its object with ``skip_bad``, and else is an error.
    """
    found = read_lines(spark, root).withColumn("key", F.substring_index("object", root.rstrip("/").rpartition(":")[2] + "/", -1))
    joined = found.join(objects.select("id", "directory", "stream", "host", F.col("path").alias("key")), "key")
    good = syslog.is_record(F.col("value"))
    if skip_bad:
        first_bad = joined.where(~good).groupBy("key").agg(F.min("offset").alias("bad"))
        joined = joined.join(first_bad, "key", "left").where("bad is null or offset < bad")
    else:
        joined = joined.withColumn("value", F.when(good, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a record in "), "key")).cast("string")))
    return syslog.decoded(joined, F.col("value"), F.col("directory"), F.col("stream"), F.col("host"), F.col("id"), F.col("offset"))


def _stand_in(objects: DataFrame, time: Column, raw: Column, offset: Column, source: Column, origin: Column, lower: bool) -> DataFrame:
    name = (lambda c: F.lower(c)) if lower else F.col
    return objects.select(time.alias("_time"), raw.alias("_raw"), name("directory").alias("index"), name("stream").alias("sourcetype"), name("host").alias("host"), source.alias("source"), F.col("id").cast("string").alias("partition"), offset.alias("offset"), origin.alias("origin"))


def metadata(objects: DataFrame) -> DataFrame:
    """One row an object, from the catalog alone: its hour and, as raw text, its sizes."""
    raw = envelopes.object_metadata(F.col("uncompressed_file_size"), F.col("file_size"))
    return _stand_in(objects, F.timestamp_seconds("logtime"), raw, F.lit(0).cast("long"), F.lit(""), F.lit(""), lower=False)


def migration(first_lines: DataFrame, objects: DataFrame, zone: str = "Europe/Helsinki") -> DataFrame:
    """One row an object, by its first event (key, value): an envelope with its times; whatever isn't a record is described too."""
    both = objects.join(first_lines.select(F.col("key").alias("path"), "value"), "path")
    value, sd = F.col("value"), syslog.structured_data(F.col("value"))
    good = syslog.is_record(value) & syslog.event_time(value).isNotNull()
    where = (F.col("bucket"), F.col("path"), F.col("id").cast("string"))
    raw = F.when(good, envelopes.syslog_envelope(*where, syslog.field(value, 3), syslog.epoch_micros(syslog.event_time(value)), zone)).otherwise(envelopes.path_envelope(*where, zone))
    time = F.when(good, syslog.event_time(value)).otherwise(path_timestamp(F.col("path"), zone))
    return _stand_in(both, time, raw, F.lit(0).cast("long"), F.when(good, syslog.source(sd)).otherwise("unknown-source"), F.when(good, syslog.origin(sd)).otherwise("unknown-origin"), lower=True)
