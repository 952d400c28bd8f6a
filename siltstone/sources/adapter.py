"""The star-schema test tables seen as a log archive: events as the nine-column relation, and a catalog of their hourly objects."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.functions.paths import object_path
from siltstone.operators.catalog import Catalog
from siltstone.sources.shared import shared_folder

COLUMNS = ("_time", "_raw", "index", "sourcetype", "host", "source", "partition", "offset", "origin")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with index, sourcetype, host, the hour and the path of their object."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    host = F.concat(F.lit("host-"), (F.col("user_id") % 10).cast("string"))
    out = e.select("event_id", F.col("ts").alias("_time"), F.col("props").alias("_raw"), "value", "user_id", F.col("event_type").alias("index"), F.concat(F.lit("log:"), "event_type", F.lit(":0")).alias("sourcetype"), host.alias("host"))
    out = out.withColumn("path", object_path(F.col("index"), F.col("host"), F.col("_time")))
    return out.withColumn("epoch", F.expr("cast(unix_seconds(cast(_time as timestamp)) as bigint)")).withColumn("logtime", F.expr("epoch - epoch % 3600"))


def relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine columns; an offset counts an object's events from 1."""
    w = Window.partitionBy("path").orderBy("event_id")  # an object is one hour of one host: bounded by the archive's layout
    out = tagged(spark, sf_dir).withColumn("offset", F.row_number().over(w).cast("long"))
    return out.select("_time", "_raw", "index", "sourcetype", "host", F.lit("::").alias("source"), F.col("path").alias("partition"), "offset", F.lit("").alias("origin"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, index, sourcetype, host, logtime, logdate, file_size, events) of the hourly objects."""
    grouped = tagged(spark, sf_dir).groupBy("path", "index", "sourcetype", "host", "logtime")
    out = grouped.agg(F.sum(F.length("_raw")).alias("file_size"), F.count("*").alias("events"))
    return out.withColumn("logdate", F.to_date(F.timestamp_seconds("logtime")))


_saved: dict[tuple[str, str], str] = {}


def saved_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``objects``, written out once a session: a catalog is a table, not something to be derived from events for each of its relations."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _saved:
        path = f"{shared_folder(spark)}/objects-{uuid.uuid4().hex}"
        objects(spark, sf_dir).write.parquet(path)
        _saved[key] = path
    return spark.read.parquet(_saved[key])


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The catalog's relations, with ids that both Spark and SQL can derive from names and hours."""
    o = saved_objects(spark, sf_dir)
    names = o.select("index", "sourcetype", "host").distinct()
    number = F.regexp_extract("host", "([0-9]+)$", 1).cast("long")
    group = F.ascii(F.substring("index", 1, 1)).cast("long") * 1000 + F.length("index")
    return Catalog(
        log_group=names.select(group.alias("id"), F.col("index").alias("name")).distinct(),
        stream=names.select(group.alias("id"), group.alias("gid"), F.col("index").alias("directory"), F.col("sourcetype").alias("stream"), F.col("index").alias("tag")).distinct(),
        stream_host=names.select((group * 100 + number).alias("id"), F.col("host").alias("name"), group.alias("gid")).distinct(),
        logfile=o.select(
            (F.col("logtime") * 1000000 + group * 10 + number % 10).alias("id"), "logdate", F.lit(1).alias("bucket_id"), "path", number.alias("host_id"), group.alias("logtag_id"), "file_size", (F.col("file_size") * 3).alias("uncompressed_file_size")
        ),
        host=names.select(number.alias("id"), F.col("host").alias("name")).distinct(),
        bucket=spark.range(1).select(F.lit(1).alias("id"), F.lit("archive").alias("name")),
        logtag=names.select(group.alias("id"), F.col("index").alias("logtag")).distinct(),
        corrupted=o.where("logtime % 86400 = 46800 and host = 'host-3'").select((F.col("logtime") * 1000000 + group * 10 + number % 10).alias("logfile_id")),
    )
