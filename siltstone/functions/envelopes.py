"""JSON that stands in for raw text in metadata and migration queries; keys come in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import paths


def object_metadata(uncompressed: Column, compressed: Column) -> Column:
    """Sizes of an object; an unknown uncompressed size is -1."""
    return F.to_json(F.struct(F.coalesce(uncompressed, F.lit(-1)).cast("long").alias("uncompressed"), compressed.cast("long").alias("compressed")))


def _object(bucket: Column, path: Column, partition: Column) -> Column:
    return F.struct(bucket.alias("bucket"), path.alias("path"), partition.alias("partition"))


def _path_time(path: Column, zone: str) -> Column:
    return F.date_format(paths.path_timestamp(path, zone), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def syslog_envelope(bucket: Column, path: Column, partition: Column, timestamp_text: Column, epoch: Column, zone: str = "Europe/Helsinki") -> Column:
    """Of an object whose first event is a record."""
    times = F.struct(
        timestamp_text.alias("rfc5424timestamp"), epoch.alias("epoch"), _path_time(path, zone).alias("path-extracted"), paths.precision(path).alias("path-extracted-precision"), F.lit("syslog").alias("source")
    )
    return F.to_json(F.struct(F.lit(True).alias("epochMigration"), F.lit("rfc5424").alias("format"), _object(bucket, path, partition).alias("object"), times.alias("timestamp")))


def path_envelope(bucket: Column, path: Column, partition: Column, zone: str = "Europe/Helsinki") -> Column:
    """Of an object whose first event is something else."""
    times = F.struct(_path_time(path, zone).alias("path-extracted"), paths.precision(path).alias("path-extracted-precision"), F.lit("object-path").alias("source"))
    return F.to_json(F.struct(F.lit(True).alias("epochMigration"), F.lit("non-rfc5424").alias("format"), _object(bucket, path, partition).alias("object"), times.alias("timestamp")))
