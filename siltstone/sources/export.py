"""The star-schema test tables written out as a log archive with its catalog, and as a replayable live tail, for ``format("siltstone")``."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.paths import object_path
from siltstone.operators import bloom
from siltstone.sources import adapter, stores
from siltstone.sources.shared import shared_folder

_done: dict[tuple[str, str], str] = {}
#: Filter types of the exported objects: (id, expectedElements, targetFpp, pattern).
TYPES = ((1, 2000, 0.001, "[0-9]+"), (2, 100, 0.01, "[A-Z]{12,}"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of daily objects: (event_id, index, sourcetype, host, object, logtime, path, record).

    Every fourth record has a host name of its own and the rest of its source from the relay, where archive and tail differ.
    """
    t = adapter.tagged(spark, sf_dir).drop("path", "logtime")
    k, host = F.col("event_id") % 4, F.col("host")
    own = F.concat(F.lit('[event_node_source@32473 hostname="src-'), host, F.lit('" source="10.0.0.1" source_module="imudp"][origin@32473 hostname="o-'), F.col("user_id").cast("string"), F.lit('"]'))
    relay = F.lit('[event_node_relay@32473 hostname="relay" source="r" source_module="imrelp"][origin@32473 hostname="a\\"b"]')
    both = F.concat(F.lit('[event_node_source@32473 hostname="own" source_module="imfile"]'), relay)
    sd = F.concat(F.when(k == 0, own).when(k == 1, relay).when(k == 3, both).otherwise(""), F.lit('[tenant@32473 directory="'), F.col("index"), F.lit('" streamname="'), F.col("sourcetype"), F.lit('"]'))
    line = F.concat(F.lit("<14>1 "), F.date_format("_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit(" "), host, F.lit(" app - - "), sd, F.lit(" "), F.col("_raw"))
    day = F.date_trunc("day", "_time")
    return t.select("event_id", "index", "sourcetype", "host", "_raw", F.expr("epoch - epoch % 86400").alias("logtime"), object_path(F.col("index"), host, day).alias("path"), line.alias("record"))


def object_id(logtime: Column, index: Column, host: Column) -> Column:
    group = F.ascii(F.substring(index, 1, 1)).cast("long") * 1000 + F.length(index)
    return logtime * 1000000 + group * 10 + F.regexp_extract(host, "([0-9]+)$", 1).cast("long") % 10


def _write(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for path, lines in zip(batch["path"].to_pylist(), batch["lines"].to_pylist(), strict=True):
            where, base = stores.opened(root)
            where.create_dir(f"{base}/{path}".rpartition("/")[0], recursive=True)
            body = gzip.compress(("\n".join(lines) + "\n").encode(), compresslevel=1, mtime=0)
            with where.open_output_stream(f"{base}/{path}", compression=None) as f:
                f.write(body)
            sizes.append(len(body))
        yield pa.RecordBatch.from_pydict({"path": batch["path"], "written": pa.array(sizes, pa.int64())})


def exported(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the archive, which is written once a session: objects/, catalog.parquet, tables/, tail.parquet, filters.parquet, types.parquet."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _done:
        return _done[key]
    folder = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    r = records(spark, sf_dir)
    # an object is one day of one host and index: bounded by the archive's layout
    bodies = r.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("event_id", "record"))).alias("of")).select("path", F.col("of.record").alias("lines"))
    bodies.mapInArrow(partial(_write, root=f"{folder}/objects"), "path string, written bigint").write.parquet(f"{folder}/written.parquet")
    o = r.groupBy("path", "index", "sourcetype", "host", "logtime").agg(F.sum(F.length("_raw")).alias("file_size"), F.count("*").alias("events"))
    o = o.withColumn("id", object_id(F.col("logtime"), F.col("index"), F.col("host")))
    names = [F.col("index").alias("directory"), F.col("sourcetype").alias("stream"), "host"]
    o.select("id", *names, F.lit("archive").alias("bucket"), "path", "logtime", "file_size", F.when(F.col("host") != "host-1", F.col("file_size") * 3).alias("uncompressed_file_size")).write.parquet(f"{folder}/catalog.parquet")
    r.select(F.col("index").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("record").cast("binary").alias("value")).write.parquet(f"{folder}/tail.parquet")
    types = spark.createDataFrame(TYPES, "id long, expectedElements long, targetFpp double, pattern string")
    types.write.parquet(f"{folder}/types.parquet")
    texts = r.select(object_id(F.col("logtime"), F.col("index"), F.col("host")).alias("partition_id"), F.col("_raw").alias("text"))
    bloom.build(texts, types).write.parquet(f"{folder}/filters.parquet")
    group = F.ascii(F.substring("index", 1, 1)).cast("long") * 1000 + F.length("index")
    number = F.regexp_extract("host", "([0-9]+)$", 1).cast("long")
    tables = {
        "log_group": o.select(group.alias("id"), F.col("index").alias("name")).distinct(),
        "stream": o.select(group.alias("id"), group.alias("gid"), F.col("index").alias("directory"), F.col("sourcetype").alias("stream"), F.col("index").alias("tag")).distinct(),
        "stream_host": o.select((group * 100 + number).alias("id"), F.col("host").alias("name"), group.alias("gid")).distinct(),
        "host": o.select(number.alias("id"), F.col("host").alias("name")).distinct(),
        "logtag": o.select(group.alias("id"), F.col("index").alias("logtag")).distinct(),
        "bucket": spark.range(1).select(F.lit(1).cast("long").alias("id"), F.lit("archive").alias("name")),
        "logfile": o.select(
            "id", F.to_date(F.timestamp_seconds("logtime")).alias("logdate"), F.lit(1).cast("long").alias("bucket_id"), "path", number.alias("host_id"), group.alias("logtag_id"), "file_size", F.when(F.col("host") != "host-1", F.col("file_size") * 3).alias("uncompressed_file_size")
        ),
        "corrupted": o.where("host = 'host-3' and logtime % 172800 = 0").select(F.col("id").alias("logfile_id")),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/tables/{name}.parquet")
    _done[key] = folder
    return folder
