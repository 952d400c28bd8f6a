"""Queries through ``format("siltstone")``: events are written as objects with a catalog and as a live tail, and read back by the source."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.operators import metrics
from siltstone.plans.conditions import DAY
from siltstone.queries import EVENTS, T0, leaf, op
from siltstone.sources.datasource import LogSource
from siltstone.sources.export import exported
from siltstone.sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

ROWS = EVENTS + """,
x AS (SELECT *, epoch - epoch % 86400 AS day, ascii("index") * 1000 + length("index") AS g, CAST(regexp_extract(host, '([0-9]+)$', 1) AS BIGINT) AS n FROM e),
r AS (SELECT *, CAST(day * 1000000 + g * 10 + n % 10 AS VARCHAR) AS "partition", row_number() OVER (PARTITION BY "index", host, day ORDER BY event_id) AS "offset",
  strftime(_time, '%Y/%m-%d') || '/' || host || '/' || "index" || '/' || "index" || '.log-' || strftime(_time, '%Y%m%d') || '00.log.gz' AS path,
  CASE event_id % 4 WHEN 0 THEN 'imudp:src-' || host || ':10.0.0.1' WHEN 1 THEN 'imrelp:relay:r' WHEN 3 THEN 'imfile:own:r' ELSE '::' END AS archive_source,
  CASE event_id % 4 WHEN 0 THEN 'imudp:src-' || host || ':10.0.0.1' WHEN 1 THEN 'imrelp:relay:r' WHEN 3 THEN 'imfile:own:' ELSE '::' END AS tail_source,
  CASE event_id % 4 WHEN 0 THEN 'o-' || user_id WHEN 2 THEN '' ELSE 'a"b' END AS origin FROM x),
objects AS (SELECT "partition", "index", sourcetype, host, day, path, sum(length(_raw)) AS size, min(event_id) AS first FROM r GROUP BY ALL),
kept AS (SELECT * FROM objects WHERE NOT (host = 'host-3' AND day % 172800 = 0))"""
_ARCHIVE = '_raw, "index", sourcetype, host, archive_source AS source, "partition", "offset", origin, epoch_us(_time) AS us'
_TAIL = "_raw, \"index\", sourcetype, host, tail_source AS source, '0' AS \"partition\", event_id AS \"offset\", origin, epoch_us(_time) AS us"
CUT = T0 + 15 * DAY
ALL = leaf("index", "*")


def load(spark: SparkSession, sf_dir: str, query: str, archive: bool = True, tail: bool = False, tables: bool = False, **more: str) -> DataFrame:
    """The source over the exported tables; times as microseconds."""
    spark.dataSource.register(LogSource)
    folder = exported(spark, sf_dir)
    options = {"queryXML": query, "archive.enabled": str(archive), "kafka.enabled": str(tail), "num_partitions": spark.conf.get("spark.sql.shuffle.partitions"), "zone": "UTC"}
    options |= {"objects": f"{folder}/objects", "tail.path": f"{folder}/tail.parquet", "bloom.filters": f"{folder}/filters.parquet", "bloom.types": f"{folder}/types.parquet"}
    options |= {"catalog.tables": f"{folder}/tables"} if tables else {"catalog": f"{folder}/catalog.parquet"}
    df = spark.read.format("siltstone").options(**(options | more)).load()
    return df.withColumn("us", F.unix_micros("_time")).drop("_time")


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        SQL[name] = f"WITH {ROWS} {sql}"
        return f

    return keep


_SOME = op("AND", op("OR", leaf("index", "cl*"), leaf("host", "host-3")), op("AND", leaf("earliest", T0 + 5 * DAY), leaf("latest", T0 + 12 * DAY + 4321)))


@register("d_archive", f"SELECT {_ARCHIVE} FROM r WHERE (\"index\" LIKE 'cl%' OR host = 'host-3') AND epoch BETWEEN {T0 + 5 * DAY} AND {T0 + 12 * DAY + 4321}")
def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, _SOME)


@register("d_archive_catalog", f"SELECT {_ARCHIVE} FROM r WHERE \"index\" <> 'click' AND \"partition\" IN (SELECT \"partition\" FROM kept)")
def archive_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the relations of a catalog, without its corrupted objects."""
    return load(spark, sf_dir, op("NOT", leaf("index", "CLICK")), tables=True)


@register("d_tail", f"SELECT {_TAIL} FROM r WHERE \"index\" IN ('click', 'view') AND host <> 'host-1'")
def tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, op("AND", op("OR", leaf("index", "click"), leaf("index", "vie?").replace("?", "*")), leaf("host", "host-1", "NOT_EQUALS")), archive=False, tail=True)


@register("d_hybrid", f"SELECT {_ARCHIVE} FROM r WHERE epoch < {CUT} UNION ALL SELECT {_TAIL} FROM r WHERE epoch >= {CUT}")
def hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides hold all events; the options' common cut makes each count once."""
    return load(spark, sf_dir, ALL, tail=True, **{"archive.includeBeforeEpoch": str(CUT), "kafka.includeEpochAndAfter": str(CUT)})


@register("d_metadata", """SELECT '{"uncompressed":' || CASE WHEN host = 'host-1' THEN -1 ELSE size * 3 END || ',"compressed":' || size || '}' AS _raw, "index", sourcetype, host, '' AS source, "partition", CAST(0 AS BIGINT) AS "offset", '' AS origin, day * 1000000 AS us FROM kept""")
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, ALL, tables=True, **{"metadataQuery.enabled": "true"})


@register("d_migration", """SELECT '{"epochMigration":true,"format":"rfc5424","object":{"bucket":"archive","path":"' || r.path || '","partition":"' || r."partition" || '"},"timestamp":{"rfc5424timestamp":"' || strftime(r._time, '%Y-%m-%dT%H:%M:%S.%fZ') || '","epoch":' || epoch_us(r._time)
 || ',"path-extracted":"' || strftime(to_timestamp(r.day) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') || '","path-extracted-precision":"hourly","source":"syslog"}}' AS _raw, r."index", r.sourcetype, r.host, archive_source AS source, r."partition", CAST(0 AS BIGINT) AS "offset", origin, epoch_us(r._time) AS us
FROM r JOIN objects ON r.event_id = objects.first""")
def migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an object, by its first event."""
    return load(spark, sf_dir, ALL, epochMigrationMode="true")


@register("d_bloom", f"SELECT {_ARCHIVE} FROM r WHERE contains(_raw, '\"k\": 77}}')")
def bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search term whose number is a token of the objects' filters; objects without it aren't read."""
    return load(spark, sf_dir, leaf("indexstatement", "&quot;k&quot;: 77}"), **{"bloom.enabled": "true"})


@register("d_without_filters", f"SELECT {_ARCHIVE} FROM r")
def without_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No object has long capitals, so none has a filter of that type."""
    return load(spark, sf_dir, ALL, **{"bloom.withoutFilters": "true", "bloom.withoutFiltersPattern": "[A-Z]{12,}"})


@register("d_metrics", """SELECT count(*) AS "RecordsProcessed", (SELECT count(*) FROM objects) AS "ArchiveObjectsProcessed", (SELECT count(*) FROM objects) AS "ArchiveDatabaseRowCount", max(day) AS "ArchiveOffset", 0::BIGINT AS "KafkaOffset" FROM r""")
def figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source's tasks say of a read of the whole archive."""
    folder = f"{shared_folder(spark)}/figures-{uuid.uuid4().hex}"
    load(spark, sf_dir, ALL, figures=folder).write.format("noop").mode("overwrite").save()
    return metrics.produced(spark, folder).select("RecordsProcessed", "ArchiveObjectsProcessed", "ArchiveDatabaseRowCount", "ArchiveOffset", "KafkaOffset")
