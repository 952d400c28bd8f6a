"""Event-time windows over streams of events, with watermarks, and a runner that drains what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How late an event may come.
LATE = "40 days"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files, with a time that windows and watermarks take."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("time", F.col("ts").cast("timestamp")).withWatermark("time", LATE)


def _start(window: str) -> Column:
    return F.unix_timestamp(F.col(f"{window}.start")).alias("start")


def tumbling(stream: DataFrame, size: str) -> DataFrame:
    return stream.groupBy(F.window("time", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(_start("w"), "event_type", "n")


def sliding(stream: DataFrame, size: str, step: str) -> DataFrame:
    return stream.groupBy(F.window("time", size, step).alias("w"), "event_type").agg(F.count("*").alias("n")).select(_start("w"), "event_type", "n")


def sessions(stream: DataFrame, gap: str) -> DataFrame:
    return stream.groupBy("user_id", F.session_window("time", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", _start("w"), "n")


def run(spark: SparkSession, stream: DataFrame, folder: str, mode: str = "append", keys: tuple[str, ...] = ()) -> DataFrame:
    """The final table of a stream, once all that is there now has been read. State and progress lie in a shared folder.

    ``append``: rows go out once and for all, those of a window when the watermark has passed it. ``update``: a window goes out whenever it
    has changed, its state is dropped behind the watermark, and the last row of each of ``keys`` counts. ``complete``: all rows go out
    each time, and no state is ever dropped; only session windows need it, for which Spark has no updates.
    """
    name = f"stream_{uuid.uuid4().hex}"
    table = f"{folder}/{name}/rows"
    out = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/{name}/state").outputMode(mode)
    if mode == "append":
        out.format("parquet").option("path", table).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(table)
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    write = lambda batch, k: batch.withColumn("batch", F.lit(k).cast("long")).write.mode("overwrite").parquet(f"{table}/{k}" if mode == "update" else table)
    out.foreachBatch(write).start().awaitTermination()
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(table)
    if mode == "update":
        rest = [c for c in stream.columns if c not in keys]
        rows = rows.groupBy(*keys).agg(F.max(F.struct("batch", *rest)).alias("last")).select(*keys, *[F.col(f"last.{c}").alias(c) for c in rest])
    return rows.select(*stream.columns)
