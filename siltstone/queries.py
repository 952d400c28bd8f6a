"""The registered queries of the log engine, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import envelopes, paths, search_tokens, syslog
from siltstone.operators import bloom, metrics
from siltstone.operators import catalog as catalogs
from siltstone.plans import schedule
from siltstone.plans.conditions import DAY, NAMES, earliest_epoch, on_objects, on_rows, on_streams, topic_regex
from siltstone.plans.options import Batching
from siltstone.plans.query import Node, parse
from siltstone.sources import adapter
from siltstone.sources.shared import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The adapter's views in SQL.
EVENTS = """e AS (SELECT event_id, ts AS _time, props AS _raw, value, user_id, event_type AS "index", 'log:' || event_type || ':0' AS sourcetype, 'host-' || (user_id % 10) AS host,
  CAST(floor(epoch(ts)) AS BIGINT) AS epoch FROM events),
t AS (SELECT *, epoch - epoch % 3600 AS logtime, strftime(_time, '%Y/%m-%d') || '/' || host || '/' || "index" || '/' || "index" || '.log-' || strftime(_time, '%Y%m%d%H') || '.log.gz' AS path FROM e)"""
OBJECTS = EVENTS + """,
o AS (SELECT path, "index", sourcetype, host, logtime, CAST(sum(length(_raw)) AS BIGINT) AS file_size, count(*) AS events, CAST(to_timestamp(logtime) AT TIME ZONE 'UTC' AS DATE) AS logdate,
  ascii("index") * 1000 + length("index") AS g, CAST(regexp_extract(host, '([0-9]+)$', 1) AS BIGINT) AS n FROM t GROUP BY ALL),
f AS (SELECT *, logtime * 1000000 + g * 10 + n % 10 AS id FROM o),
good AS (SELECT * FROM f WHERE NOT (logtime % 86400 = 46800 AND host = 'host-3'))"""
T0 = 1704067200  # 2024-01-01
T1, T2 = T0 + 5 * DAY + 1234, T0 + 12 * DAY + 4321


def leaf(tag: str, value: object, operation: str = "EQUALS") -> str:
    return f'<{tag} value="{value}" operation="{operation}"/>'


def op(name: str, *parts: str) -> str:
    return f"<{name}>{''.join(parts)}</{name}>"


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return keep


def names() -> dict:
    return {n: F.col(n) for n in NAMES}


def rows_of(df: DataFrame, node: Node) -> DataFrame:
    return df.where(on_rows(node, names(), F.col("epoch"), F.col("_raw")))


def _filter_query(name: str, xml: str, where: str) -> None:
    """A query on rows, planned as the engine plans it: objects first, by their hour, and then their rows."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        node = parse(xml)
        events = adapter.tagged(spark, sf_dir)
        coarse = on_objects(node, names(), F.col("logtime"))
        return rows_of(events.where(coarse), node).select("event_id", "index", "host", "epoch")

    QUERIES[name] = run
    SQL[name] = f'WITH {EVENTS} SELECT event_id, "index", host, epoch FROM t WHERE {where}'


_click, _host3 = leaf("index", "click"), leaf("host", "host-3")
for _name, _xml, _where in (
    ("q_index_eq", _click, "\"index\" = 'click'"),
    ("q_index_ne", leaf("index", "click", "NOT_EQUALS"), "\"index\" <> 'click'"),
    ("q_index_wild", leaf("index", "*i*"), "\"index\" ILIKE '%i%'"),
    ("q_index_star", leaf("index", "*"), "true"),
    ("q_index_star_ne", leaf("index", "*", "NOT_EQUALS"), "false"),
    ("q_sourcetype_eq", leaf("sourcetype", "log:view:0"), "sourcetype = 'log:view:0'"),
    ("q_sourcetype_ne", leaf("sourcetype", "log:v*", "NOT_EQUALS"), "NOT sourcetype LIKE 'log:v%'"),
    ("q_host_eq", _host3, "host = 'host-3'"),
    ("q_host_wild_ne", leaf("host", "*-3", "NOT_EQUALS"), "NOT host LIKE '%-3'"),
    ("q_and", op("AND", _click, _host3), "\"index\" = 'click' AND host = 'host-3'"),
    ("q_or", op("OR", _click, _host3), "\"index\" = 'click' OR host = 'host-3'"),
    ("q_not_leaf", op("NOT", _click), "NOT \"index\" = 'click'"),
    ("q_not_compound", op("NOT", op("OR", _click, op("AND", _host3, leaf("index", "view")))), "NOT (\"index\" = 'click' OR (host = 'host-3' AND \"index\" = 'view'))"),
    ("q_not_not", op("NOT", op("NOT", _click)), "\"index\" = 'click'"),
    ("q_nested_bool", op("AND", op("OR", _click, leaf("index", "error")), op("OR", _host3, op("NOT", leaf("host", "host-*")))), "(\"index\" IN ('click', 'error')) AND (host = 'host-3' OR NOT host LIKE 'host-%')"),
    ("q_single_branch", op("AND", _click), "\"index\" = 'click'"),
    ("q_drop_unsupported_leaf", op("AND", _click, leaf("unknown", "x")), "\"index\" = 'click'"),
    ("q_case_insensitive", leaf("index", "CLI*"), "\"index\" ILIKE 'CLI%'"),
    ("q_like_metachar", leaf("host", "host_3"), "host ILIKE 'host\\_3' ESCAPE '\\'"),
    ("q_earliest", leaf("earliest", T1), f"epoch >= {T1}"),
    ("q_latest", leaf("latest", T2), f"epoch <= {T2}"),
    ("q_time_between", op("AND", leaf("earliest", T1), leaf("latest", T2)), f"epoch BETWEEN {T1} AND {T2}"),
    ("q_not_earliest", op("NOT", leaf("earliest", T1)), f"epoch < {T1}"),
    ("q_not_latest", op("NOT", leaf("latest", T2)), f"epoch > {T2}"),
    ("q_index_earliest_alias", op("AND", leaf("index_earliest", T1), leaf("index_latest", T2)), f"epoch BETWEEN {T1} AND {T2}"),
    ("q_indexstatement", op("AND", _click, leaf("indexstatement", '&quot;K&quot;: 6')), "\"index\" = 'click' AND contains(lower(_raw), '\"k\": 6')"),
    ("q_indexstatement_ne", leaf("indexstatement", "6", "NOT_EQUALS"), "NOT contains(_raw, '6')"),
    ("q_or_term_or_index", op("OR", _click, leaf("indexstatement", "77")), "\"index\" = 'click' OR contains(_raw, '77')"),
):
    _filter_query(_name, _xml, _where)


def _stream_query(name: str, xml: str, where: str, compat: bool) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        streams = adapter.tagged(spark, sf_dir).select(*NAMES).distinct()
        return streams.where(on_streams(parse(xml), *(F.col(n) for n in NAMES), compat=compat))

    QUERIES[name] = run
    SQL[name] = f'WITH {EVENTS} SELECT DISTINCT "index", sourcetype, host FROM t WHERE {where}'


_or_term = op("OR", _click, leaf("indexstatement", "77"))
_stream_query("q_stream_mode_weakening", _or_term, "true", False)
_stream_query("q_stream_mode_elision", _or_term, "\"index\" = 'click'", True)
_stream_query("q_stream_mode_and", op("AND", op("AND", _click, leaf("earliest", T1)), op("NOT", leaf("indexstatement", "x"))), "\"index\" = 'click'", False)


@register("q_coarse_objects", f"WITH {OBJECTS} SELECT path, logtime FROM o WHERE \"index\" = 'click' AND logtime >= {T1 - T1 % 3600} AND logtime <= {T2}")
def coarse_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = parse(op("AND", _click, op("AND", leaf("earliest", T1), leaf("latest", T2))))
    return adapter.objects(spark, sf_dir).where(on_objects(node, names(), F.col("logtime"), F.col("logdate"))).select("path", "logtime")


_FOLDS = (("now_minus_day", _click), ("least", op("OR", leaf("earliest", 2), leaf("earliest", 1))), ("not_ignored", op("AND", op("OR", leaf("earliest", 2611657302), leaf("earliest", 1000)), op("NOT", leaf("earliest", 1)))), ("clamped", leaf("earliest", 2611657302)))


@register("q_earliest_epoch_fold", f"SELECT * FROM (VALUES ('now_minus_day', {T2 - DAY}::BIGINT), ('least', 1), ('not_ignored', 1000), ('clamped', {T2 - DAY})) AS v(fold, start)")
def earliest_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(n, earliest_epoch(parse(x), T2)) for n, x in _FOLDS], "fold string, start bigint")


@register("q_kafka_topic_match", f"WITH {EVENTS} SELECT DISTINCT \"index\" AS topic FROM t WHERE regexp_full_match(\"index\", 'cl[^/]*|view')")
def topic_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    regex = topic_regex(parse(op("OR", leaf("index", "cl*"), leaf("index", "view"))))
    return adapter.tagged(spark, sf_dir).select(F.col("index").alias("topic")).distinct().where(F.col("topic").rlike(regex))


# paths and times


@register("q_logtime_from_path", f"WITH {OBJECTS} SELECT path, CAST(epoch(strptime(regexp_extract(path, '-([0-9]{{10}})\\.', 1), '%Y%m%d%H')) AS BIGINT) AS logtime FROM o")
def logtime_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.objects(spark, sf_dir).select("path", paths.logtime(F.col("path")).alias("logtime"))


@register("q_path_timestamp_hour", f"WITH {OBJECTS} SELECT path, CAST(epoch(strptime(regexp_extract(path, '-([0-9]{{10}})\\.', 1), '%Y%m%d%H') AT TIME ZONE 'Europe/Helsinki') AS BIGINT) AS at FROM o")
def path_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.objects(spark, sf_dir).select("path", F.unix_timestamp(paths.path_timestamp(F.col("path"))).alias("at"))


@register("q_path_timestamp_day", f"WITH {OBJECTS} SELECT DISTINCT replace(path, '.log-', '.daily.') AS path, CAST(epoch(strptime(substr(path, 1, 10), '%Y/%m-%d') AT TIME ZONE 'Europe/Helsinki') AS BIGINT) AS at FROM (SELECT path FROM o)")
def path_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = adapter.objects(spark, sf_dir).select(F.replace(F.col("path"), F.lit(".log-"), F.lit(".daily.")).alias("path")).distinct()
    return daily.select("path", F.unix_timestamp(paths.path_timestamp(F.col("path"))).alias("at"))


@register("q_path_invalid_null", f"WITH {OBJECTS} SELECT 'x' || replace(path, '-', '_') AS path, CAST(NULL AS BIGINT) AS logtime, CAST(NULL AS VARCHAR) AS prec FROM o")
def path_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.concat(F.lit("x"), F.replace(F.col("path"), F.lit("-"), F.lit("_")))
    return adapter.objects(spark, sf_dir).select(p.alias("path")).select("path", paths.logtime(F.col("path")).alias("logtime"), paths.precision(F.col("path")).alias("prec"))


@register("q_hour_floor", "SELECT n, n - n % 3600 AS hour FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) - 1705000000 AS n FROM events)")
def hour_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("epoch") - 1705000000).alias("n")
    return adapter.tagged(spark, sf_dir).select(n).select("n", F.expr("n - n % 3600").alias("hour"))


# catalog

@register("q_stream_table_join", f"WITH {OBJECTS} SELECT DISTINCT \"index\" AS directory, sourcetype AS stream, CAST(g AS BIGINT) AS tag_id, host, n AS host_id FROM o WHERE \"index\" = 'click'")
def stream_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogs.streams_for(adapter.catalog(spark, sf_dir), parse(_click))


@register("q_logfile_day_join", f"WITH {OBJECTS} SELECT CAST(id AS BIGINT) AS id, path, logtime, file_size FROM good WHERE \"index\" = 'click' AND logdate = DATE '2024-01-05'")
def logfile_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = adapter.catalog(spark, sf_dir)
    found = catalogs.objects(c, catalogs.streams_for(c, parse(_click)))
    return found.where(F.col("logdate") == F.lit("2024-01-05").cast("date")).select("id", "path", "logtime", "file_size")


@register("q_enrich", f"WITH {OBJECTS} SELECT CAST(id AS BIGINT) AS id, \"index\" AS directory, sourcetype AS stream, host, \"index\" AS logtag, CAST(logdate AS VARCHAR) AS logdate, 'archive' AS bucket, path, logtime, file_size, file_size * 3 AS uncompressed_file_size FROM good WHERE \"index\" = 'view' AND logtime >= {T1 - T1 % 3600}")
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogs.objects_for(adapter.catalog(spark, sf_dir), parse(op("AND", leaf("index", "view"), leaf("earliest", T1))))
    return found.withColumn("logdate", F.col("logdate").cast("string"))


@register("q_corrupted_anti", f"WITH {OBJECTS} SELECT host, count(*) AS n FROM good GROUP BY host")
def corrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = adapter.catalog(spark, sf_dir)
    return catalogs.objects(c, catalogs.streams(c)).groupBy("host").agg(F.count("*").alias("n"))


@register("q_hour_range", f"WITH {OBJECTS} SELECT path, logtime FROM good WHERE logtime > {T0 + 3600} AND logtime <= {T0 + 36000} AND logtime < {T0 + 28800}")
def hour_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = adapter.catalog(spark, sf_dir)
    return catalogs.hour_range(catalogs.objects(c, catalogs.streams(c)), T0 + 3600, T0 + 36000, T0 + 28800).select("path", "logtime")


@register("q_next_hour_weight", f"WITH {OBJECTS} SELECT logtime, CAST(sum(file_size) AS BIGINT) AS size FROM good WHERE logtime > {T1} GROUP BY 1 ORDER BY 1 LIMIT 1")
def next_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = adapter.catalog(spark, sf_dir)
    return catalogs.next_hour(catalogs.objects(c, catalogs.streams(c)), T1)


# batches

_BATCH = Batching(partitions=1, quantum=0.000002, most_objects=40)


@register("q_hour_weights", f"WITH {OBJECTS} SELECT logtime, CAST(sum(file_size) AS BIGINT) AS size, count(*) AS objects, round(sum(file_size) * 15.5 / 1048576 / 136.5, 9) AS seconds FROM o GROUP BY 1")
def hour_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = schedule.hour_weights(adapter.objects(spark, sf_dir))
    return w.withColumn("seconds", F.round(schedule.weight_column(F.col("size")), 9))


@register("q_admission_batches", f"""WITH {OBJECTS}, h AS (SELECT logtime, CAST(sum(file_size) AS BIGINT) AS size, count(*) AS objects FROM o GROUP BY 1),
r AS (SELECT *, coalesce(sum(size) OVER w, 0) AS b, coalesce(sum(objects) OVER w, 0) AS c FROM h WINDOW w AS (ORDER BY logtime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT logtime, size, objects FROM r WHERE b * 15.5 / 1048576 / 136.5 <= 0.000002 AND c <= 40""")
def admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule.first_batch(schedule.hour_weights(adapter.objects(spark, sf_dir)), _BATCH)


@register("q_include_before_epoch", f"WITH {OBJECTS} SELECT path FROM o WHERE logtime < {T1}")
def include_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.objects(spark, sf_dir).where(F.col("logtime") < T1).select("path")


@register("q_epoch_and_after", f"WITH {EVENTS} SELECT event_id FROM t WHERE epoch >= {T2}")
def epoch_and_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.tagged(spark, sf_dir).where(F.col("epoch") >= T2).select("event_id")


_LPT = f"""WITH RECURSIVE {OBJECTS},
u AS (SELECT logdate, file_size AS s, row_number() OVER (PARTITION BY logdate ORDER BY file_size DESC, path) AS k FROM o),
q AS (SELECT DISTINCT logdate, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS a, CAST(0 AS BIGINT) AS b, CAST(0 AS BIGINT) AS c, CAST(0 AS BIGINT) AS d FROM u
UNION ALL SELECT logdate, k, a + CASE m WHEN 0 THEN s ELSE 0 END, b + CASE m WHEN 1 THEN s ELSE 0 END, c + CASE m WHEN 2 THEN s ELSE 0 END, d + CASE m WHEN 3 THEN s ELSE 0 END
  FROM (SELECT q.logdate, u.k, u.s, a, b, c, d, CASE least(a, b, c, d) WHEN a THEN 0 WHEN b THEN 1 WHEN c THEN 2 ELSE 3 END AS m FROM q JOIN u ON u.logdate = q.logdate AND u.k = q.k + 1)),
z AS (SELECT logdate, max(k) AS k FROM q GROUP BY logdate), e4 AS (SELECT q.* FROM q JOIN z ON q.logdate = z.logdate AND q.k = z.k)
SELECT logdate, CAST(0 AS BIGINT) AS queue, a AS load FROM e4 UNION ALL SELECT logdate, 1, b FROM e4 UNION ALL SELECT logdate, 2, c FROM e4 UNION ALL SELECT logdate, 3, d FROM e4"""


@register("q_lpt_packing", _LPT)
def lpt_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load of each of four queues after the objects of a day were dealt, the largest first and each to the least loaded one."""

    def loads(day):
        import pandas as pd

        units = [(int(s), int(s)) for s in day.sort_values(["file_size", "path"], ascending=[False, True])["file_size"]]
        held = [sum(q) for q in schedule.pack(units, 4, keep_empty=True)]
        return pd.DataFrame({"logdate": day["logdate"].iloc[0], "queue": range(4), "load": held})

    found = adapter.saved_objects(spark, sf_dir).select("logdate", "path", "file_size")
    return found.groupBy("logdate").applyInPandas(loads, "logdate date, queue bigint, load bigint")  # a day of the catalog, as a planner holds it


@register("q_lpt_packing_days", f"WITH {OBJECTS} SELECT logdate, CAST(sum(file_size) AS BIGINT) AS bytes, count(*) AS units, true AS balanced FROM o GROUP BY logdate")
def lpt_packing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of every day of the catalog dealt to eight queues, a row a day; the driver holds one partition's days at once."""
    found = adapter.saved_objects(spark, sf_dir).select("logdate", "path", "file_size").orderBy("logdate").toLocalIterator()
    out = []
    for logdate, day in groupby(found, key=lambda r: r.logdate):
        units = [(r.file_size, (r.path, r.file_size)) for r in day]
        queues = schedule.pack(units, 8)
        loads = [sum(size for _, size in q) for q in queues]
        out.append((logdate, sum(loads), sum(map(len, queues)), max(loads) - min(loads) <= max(size for size, _ in units)))
    return spark.createDataFrame(out, "logdate date, bytes bigint, units bigint, balanced boolean")


# decoding

_RECORD = "'<14>1 ' || strftime(_time, '%Y-%m-%dT%H:%M:%S.%fZ') || ' ' || host || ' app - - ' || sd || ' ' || _raw"
_SD = """CASE event_id % 3 WHEN 0 THEN '[event_node_source@32473 hostname="src-' || host || '" source="10.0.0.1" source_module="imudp"][origin@32473 hostname="o-' || user_id || '"]'
 WHEN 1 THEN '[event_node_relay@32473 hostname="relay" source="r" source_module="imrelp"][origin@32473 hostname="a\\"b"]' ELSE '-' END"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spread(adapter.tagged(spark, sf_dir))
    k, host = F.col("event_id") % 3, F.col("host")
    own = F.concat(F.lit('[event_node_source@32473 hostname="src-'), host, F.lit('" source="10.0.0.1" source_module="imudp"][origin@32473 hostname="o-'), F.col("user_id").cast("string"), F.lit('"]'))
    relay = F.lit('[event_node_relay@32473 hostname="relay" source="r" source_module="imrelp"][origin@32473 hostname="a\\"b"]')
    sd = F.when(k == 0, own).when(k == 1, relay).otherwise("-")
    return t.withColumn("record", F.concat(F.lit("<14>1 "), F.date_format("_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.lit(" "), host, F.lit(" app - - "), sd, F.lit(" "), F.col("_raw")))


_PARTS = "CASE event_id % 3 WHEN 0 THEN 'imudp:src-' || host || ':10.0.0.1' WHEN 1 THEN 'imrelp:relay:r' ELSE '::' END"
_ORIGIN = "CASE event_id % 3 WHEN 0 THEN 'o-' || user_id WHEN 1 THEN 'a\"b' ELSE '' END"


@register("q_decode_rfc5424", f"""WITH {EVENTS} SELECT event_id, epoch_us(_time) AS us, _raw, "index", sourcetype, host, {_PARTS} AS source, path AS "partition", CAST(1 AS BIGINT) AS "offset", {_ORIGIN} AS origin FROM t""")
def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = syslog.decoded(records(spark, sf_dir), F.col("record"), F.upper("index"), F.col("sourcetype"), F.col("host"), F.col("path"), F.lit(1), keep=("event_id",))
    return out.withColumn("us", syslog.epoch_micros(F.col("_time"))).drop("_time")


@register("q_source_archive", f"WITH {EVENTS} SELECT event_id, {_PARTS} AS source FROM t")
def source_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("event_id", syslog.source(syslog.structured_data(F.col("record"))).alias("source"))


@register("q_source_kafka", f"WITH {EVENTS} SELECT event_id, {_PARTS} AS source FROM t")
def source_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("event_id", syslog.source(syslog.structured_data(F.col("record")), tail_rule=True).alias("source"))


@register("q_origin", f"WITH {EVENTS} SELECT event_id, {_ORIGIN} AS origin FROM t")
def origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("event_id", syslog.origin(syslog.structured_data(F.col("record"))).alias("origin"))


@register("q_metadata_json", f"""WITH {OBJECTS} SELECT path, '{{"uncompressed":' || CASE WHEN host = 'host-1' THEN -1 ELSE file_size * 3 END || ',"compressed":' || file_size || '}}' AS _raw FROM o""")
def metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = F.when(F.col("host") != "host-1", F.col("file_size") * 3)
    return adapter.objects(spark, sf_dir).select("path", envelopes.object_metadata(unknown, F.col("file_size")).alias("_raw"))


@register("q_epoch_migration_first_event", f"WITH {EVENTS} SELECT path, min(event_id) AS event_id FROM t GROUP BY path")
def first_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.tagged(spark, sf_dir).groupBy("path").agg(F.min("event_id").alias("event_id"))


@register("q_envelope_json", f"""WITH {EVENTS} SELECT event_id, '{{"epochMigration":true,"format":"rfc5424","object":{{"bucket":"archive","path":"' || path || '","partition":"' || event_id || '"}},"timestamp":{{"rfc5424timestamp":"' || strftime(_time, '%Y-%m-%dT%H:%M:%S.%fZ')
|| '","epoch":' || epoch_us(_time) || ',"path-extracted":"' || strftime(to_timestamp(logtime) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') || '","path-extracted-precision":"hourly","source":"syslog"}}}}' AS _raw FROM t""")
def envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("record")
    raw = envelopes.syslog_envelope(F.lit("archive"), F.col("path"), F.col("event_id").cast("string"), syslog.field(r, 3), syslog.epoch_micros(syslog.event_time(r)), "UTC")
    return records(spark, sf_dir).select("event_id", raw.alias("_raw"))


@register("q_envelope_json_path", f"""WITH {OBJECTS} SELECT path, '{{"epochMigration":true,"format":"non-rfc5424","object":{{"bucket":"archive","path":"' || path || '","partition":"7"}},"timestamp":{{"path-extracted":"' || strftime(to_timestamp(logtime) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')
|| '","path-extracted-precision":"hourly","source":"object-path"}}}}' AS _raw FROM o""")
def envelope_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.objects(spark, sf_dir).select("path", envelopes.path_envelope(F.lit("archive"), F.col("path"), F.lit("7"), "UTC").alias("_raw"))


# Bloom filters over documents.text; 50 objects by doc_id

_TERM = "licensed"
_TYPES = ((1, 20000, 0.01, "[A-Za-z]{6,}"), (2, 2000, 0.01, "[0-9]+"), (3, 5000, 0.02, "[A-Z]{12,}"))


def _bloom(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select((F.col("doc_id") % 50).alias("partition_id"), "text")
    types = spark.createDataFrame(_TYPES, "id long, expectedElements long, targetFpp double, pattern string")
    return docs, types, bloom.build(docs, types)


@register("q_bloom_no_false_negative", "SELECT 0::BIGINT AS missed, count(DISTINCT doc_id % 50) AS objects FROM documents")
def bloom_no_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, types, filters = _bloom(spark, sf_dir)
    objects = docs.select(F.col("partition_id").alias("id")).distinct()
    kept = bloom.prune(objects, filters, types, _TERM).withColumn("kept", F.lit(True))
    tokens = F.transform(search_tokens.regex_tokens(F.col("text"), _TYPES[0][3]), lambda x: F.lower(x))
    true = docs.where(F.array_contains(tokens, _TERM)).select(F.col("partition_id").alias("id")).distinct().withColumn("true", F.lit(True))
    both = objects.join(kept, "id", "left").join(true, "id", "left")
    return both.agg(F.count(F.when(F.col("true") & F.col("kept").isNull(), 1)).alias("missed"), F.count("*").alias("objects"))


@register("q_bloom_hits", f"SELECT doc_id % 50 AS partition_id, bool_or(regexp_matches(text, '(?i)(^|[^a-z]){_TERM}([^a-z]|$)')) AS hit FROM documents GROUP BY 1")
def bloom_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which objects a term leaves, by filters so sparse that none of 50 objects is left wrongly."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select((F.col("doc_id") % 50).alias("partition_id"), "text")
    types = spark.createDataFrame([(1, 20000, 1e-9, _TYPES[0][3])], "id long, expectedElements long, targetFpp double, pattern string")
    return bloom.may_hold(bloom.build(docs, types), types, _TERM)


@register("q_bloom_relevant_types", "SELECT CAST(id AS BIGINT) AS filter_type_id FROM (VALUES " + ", ".join(f"({k}, '{p}')" for k, _, _, p in _TYPES) + f") AS v(id, p) WHERE regexp_matches('{_TERM}', p)")
def bloom_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = spark.createDataFrame(_TYPES, "id long, expectedElements long, targetFpp double, pattern string")
    return bloom.relevant_types(types, _TERM).select("filter_type_id")


@register("q_without_filters", "WITH p AS (SELECT doc_id % 50 AS id, bool_or(regexp_matches(text, '[A-Z]{12,}')) AS has FROM documents GROUP BY 1) SELECT id FROM p WHERE NOT has")
def without_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, types, filters = _bloom(spark, sf_dir)
    return bloom.without_filters(docs.select(F.col("partition_id").alias("id")).distinct(), filters, types, _TYPES[2][3])


@register("q_regex_tokens", "SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) AS n, list_aggregate(regexp_extract_all(text, '[0-9]+'), 'string_agg', ',') AS tokens FROM documents WHERE regexp_matches(text, '[0-9]')")
def regex_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where(F.col("text").rlike("[0-9]"))
    tokens = search_tokens.regex_tokens(F.col("text"), "[0-9]+")
    return docs.select("doc_id", F.size(tokens).cast("long").alias("n"), F.array_join(tokens, ",").alias("tokens"))


@register("q_delimiter_tokens", "SELECT unnest(['test', 'nest', '.', 'test.nest', '.nest', 'test.']) AS token")
def delimiter_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1).select(F.explode(search_tokens.delimiter_tokens(F.lit("test.nest"))).alias("token"))


@register("q_delimiter_tokens_paths")
def delimiter_tokens_of_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delimiter tokens of every object's path, and the size of its filter of a type without a pattern."""
    found = adapter.objects(spark, sf_dir).select("path")
    types = spark.createDataFrame([(1, 1000, 0.01, None)], "id long, expectedElements long, targetFpp double, pattern string")
    filters = bloom.build(found.select(F.col("path").alias("partition_id"), F.col("path").alias("text")), types)
    tokens = found.select("path", F.sort_array(search_tokens.delimiter_tokens(F.col("path"))).alias("tokens"))
    return tokens.join(filters.select(F.col("partition_id").alias("path"), F.size("bits").alias("n_bits")), "path")


@register("q_term_regex_join", f"WITH {EVENTS}, p(pattern) AS (VALUES ('^c'), ('w$'), ('r{{2}}')) SELECT DISTINCT \"index\", pattern FROM t JOIN p ON regexp_matches(\"index\", pattern)")
def term_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A term matched against patterns in a column: a handful of patterns, broadcast."""
    patterns = spark.createDataFrame([("^c",), ("w$",), ("r{2}",)], "pattern string")
    indexes = adapter.tagged(spark, sf_dir).select("index").distinct()
    return indexes.join(F.broadcast(patterns), F.expr("index rlike pattern"))


# archive and live tail together

_CUT = T0 + 15 * DAY


@register("q_hybrid_union", f"WITH {EVENTS} SELECT event_id, CASE WHEN epoch < {_CUT} THEN 'archive' ELSE 'tail' END AS side FROM t")
def hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = adapter.tagged(spark, sf_dir)
    archive = t.where(F.col("logtime") < _CUT).select("event_id", F.lit("archive").alias("side"))
    return archive.unionByName(t.where(F.col("epoch") >= _CUT).select("event_id", F.lit("tail").alias("side")))


@register("q_dedup_handover", f"WITH {EVENTS} SELECT \"index\", count(*) AS n FROM t GROUP BY 1")
def handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides hold all events; the common cut makes each count once."""
    return hybrid(spark, sf_dir).join(adapter.tagged(spark, sf_dir).select("event_id", "index"), "event_id").groupBy("index").agg(F.count("*").alias("n"))


# figures


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapter.tagged(spark, sf_dir).groupBy("host").agg(F.count("*").alias("records"), F.sum(F.length("_raw")).alias("bytes"), F.max("logtime").alias("last"))


def _metric(name: str, figures: dict[str, str], sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: metrics.aggregate(_tasks(spark, sf_dir), figures)
    SQL[name] = f"WITH {EVENTS}, k AS (SELECT host, count(*) AS records, CAST(sum(length(_raw)) AS BIGINT) AS bytes, max(logtime) AS last FROM t GROUP BY 1) SELECT {sql} FROM k"


_metric("q_metric_sum", {"RecordsProcessed": "records", "BytesProcessed": "bytes"}, 'CAST(sum(records) AS BIGINT) AS "RecordsProcessed", CAST(sum(bytes) AS BIGINT) AS "BytesProcessed"')
_metric("q_metric_mean", {"RecordsPerSecond": "records", "BytesPerSecond": "bytes"}, 'CAST(sum(records) AS BIGINT) // count(records) AS "RecordsPerSecond", CAST(sum(bytes) AS BIGINT) // count(bytes) AS "BytesPerSecond"')
_metric("q_metric_max", {"ArchiveOffset": "last", "ArchiveDatabaseRowMaxLatency": "records"}, 'max(last) AS "ArchiveOffset", max(records) AS "ArchiveDatabaseRowMaxLatency"')
_metric("q_metric_min", {"ArchiveDatabaseRowMinLatency": "records"}, 'min(records) AS "ArchiveDatabaseRowMinLatency"')


_LEAST, _MOST = f"CAST('{-(2**63)}' AS BIGINT)", f"CAST('{2**63 - 1}' AS BIGINT)"


@register("q_metric_empty", f'SELECT 0::BIGINT AS "RecordsProcessed", 0::BIGINT AS "RecordsPerSecond", {_LEAST} AS "ArchiveDatabaseRowMaxLatency", {_MOST} AS "ArchiveDatabaseRowMinLatency", -1::BIGINT AS "ArchiveOffset"')
def metric_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = _tasks(spark, sf_dir).where("records < 0")
    return metrics.aggregate(none, {"RecordsProcessed": "records", "RecordsPerSecond": "records", "ArchiveDatabaseRowMaxLatency": "records", "ArchiveDatabaseRowMinLatency": "records", "ArchiveOffset": "last"})


# the flagship: events by host of a query on index and time

_FLAGSHIP = op("AND", _click, op("AND", leaf("earliest", T1), leaf("latest", T2)))


@register("q_flagship", f"WITH {EVENTS} SELECT host, count(*) AS n, sum(CAST(length(_raw) AS BIGINT))::BIGINT AS bytes FROM t WHERE \"index\" = 'click' AND epoch BETWEEN {T1} AND {T2} GROUP BY 1")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = parse(_FLAGSHIP)
    events = adapter.tagged(spark, sf_dir)
    found = rows_of(events.where(on_objects(node, names(), F.col("logtime"))), node)
    return found.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.length("_raw")).alias("bytes"))


def queries() -> dict[str, Query]:
    from siltstone import generic, source_queries

    return QUERIES | generic.QUERIES | source_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    from siltstone import generic, source_queries

    return SQL | generic.SQL | source_queries.SQL
