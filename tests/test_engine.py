import gzip
import json
import sys
import time
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone.functions import paths, search_tokens, syslog
from siltstone.operators import bloom, catalog, metrics
from siltstone.plans import options, schedule
from siltstone.plans.options import Batching
from siltstone.plans.query import parse
from siltstone.sources import archive, catalogs, datasource, offsets, records, tail
from siltstone.sources.datasource import LogSource
from siltstone.streaming import windows

T0 = 1_552_600_800


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("path", "zone", "at"),
    [
        ("2019/03-09/web-07/shop/shop.access-2019031522.log.gz", "Europe/Helsinki", 1552680000),
        ("a/b-2019031522.log.gz.4", "UTC", 1552687200),
        ("no hour in here", "UTC", None),
        ("x/y-2019139901.log.gz", "UTC", None),
        ("x/-today.log", "UTC", None),
        (None, "UTC", None),
    ],
)
def test_logtime(spark, path, zone, at):
    assert one(spark, paths.logtime(F.lit(path).cast("string"), zone)) == at


def test_path_timestamp(spark):
    assert one(spark, F.unix_timestamp(paths.path_timestamp(F.lit("2019/03-15/h/shop.access-2019031522.log.gz")))) == int(datetime(2019, 3, 15, 20, tzinfo=UTC).timestamp())
    assert one(spark, F.unix_timestamp(paths.path_timestamp(F.lit("2019/03-15/h/shop.log")))) == int(datetime(2019, 3, 14, 22, tzinfo=UTC).timestamp())
    assert one(spark, paths.precision(F.lit("2019/03-15/h/shop.log"))) == "daily"
    with pytest.raises(Exception, match="no date in path"):
        one(spark, paths.path_timestamp(F.lit("h/shop/file.log"), strict=True))


SD = r'[event_node_source@32473 hostname="src.host" source="10.0.0.1" source_module="imudp"][origin@32473 hostname="a\"b\]c"]'
LINE = f"<14>1 2014-06-20T09:14:07.123456789+02:00 host01 app - - {SD} the message [not data]"


def test_records_agree_in_columns_and_python(spark):
    df = spark.createDataFrame([(LINE,), ("no record",), ("<14>1 2014-06-20T09:14:07Z h a - - -",)], "v string")
    v = F.col("v")
    rows = df.select(syslog.is_record(v), F.unix_micros(syslog.event_time(v)), syslog.message(v), syslog.source(syslog.structured_data(v)), syslog.origin(syslog.structured_data(v))).collect()
    assert tuple(rows[0]) == (True, 1403248447123456, "the message [not data]", "imudp:src.host:10.0.0.1", 'a"b]c')
    assert rows[1][0] is False and rows[1][1] is None
    assert tuple(rows[2])[2:] == ("", "::", "")
    d = records.Decoded(pa.array([LINE, "no record", "<14>1 2014-06-20T09:14:07Z h a - - -", "<14>1 2014-13-20T09:14:07Z h a - - - x"]))
    assert d.good.to_pylist() == [True, False, True, True]
    assert [d.time[0].as_py(), d.time[3].as_py()] == [datetime(2014, 6, 20, 7, 14, 7, 123456, tzinfo=UTC), None]
    assert [d.host[0].as_py(), d.message.to_pylist()[:3], d.source().to_pylist()[:3:2], d.origin()[0].as_py()] == ["host01", ["the message [not data]", None, ""], ["imudp:src.host:10.0.0.1", "::"], 'a"b]c']
    whole = syslog.decoded(df, v, F.lit("I"), F.lit("S"), F.lit("H"), F.lit(7), F.lit(1)).withColumn("us", F.unix_micros("_time")).drop("_time").collect()
    assert tuple(whole[0]) == ("the message [not data]", "i", "s", "h", "imudp:src.host:10.0.0.1", "7", 1, 'a"b]c', 1403248447123456)
    assert tuple(whole[2])[:5] == ("", "i", "s", "h", "::") and whole[1].us is None and whole[1]._raw == ""


ODD = [
    '[a x="1"][origin@32473 hostname="h"]', '[origin@32473 x="b hostname=" hostname="h"]', '[a x="][origin@32473 hostname=" y="z"][origin@32473 hostname="h"]', '[origin@32473 y="]" hostname="h"]', '[origin@32473]', '-',
    r'[origin@32473 y="\"]" hostname="h\\"]', '[origin@324731 hostname="x"]', '[origin@32473 hostname=""]', '[a hostname="x"][b]', '[origin@32473 x=" hostname=" y="q"]', '[x y="[origin@32473 hostname="][origin@32473 hostname="h"]',
]


def test_odd_structured_data_is_read_alike(spark):
    lines = [f"<14>1 2020-01-01T00:00:00Z h a - - {sd} {m}" for sd in ODD for m in ('m', 'x] "y" [z')]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, v string")
    none = F.lit("")
    got = {r.k: (r.origin, r._raw) for r in syslog.decoded(df, F.col("v"), none, none, none, none, F.col("k"), keep=("k",)).collect()}
    d = records.Decoded(pa.array(lines))
    assert got == {k: (o, m or "") for k, (o, m) in enumerate(zip(d.origin().to_pylist(), d.message.to_pylist(), strict=True))}
    assert [got[2 * k][0] for k in range(len(ODD))] == ["h", "h", "h", "h", "", "", "h\\", "", "", "", "", "h"]
    assert {r[0] for r in df.select(syslog.is_record(F.col("v"))).collect()} == {True}


def test_tail_rule_of_source(spark):
    sd = F.lit('[event_node_source@32473 hostname="h" source_module="m"][event_node_relay@32473 source="r"]')
    assert one(spark, syslog.source(sd)) == "m:h:r"
    assert one(spark, syslog.source(sd, tail_rule=True)) == "m:h:"


def test_tokens(spark):
    assert set(one(spark, search_tokens.delimiter_tokens(F.lit("test.nest")))) == {"test", "nest", ".", "test.nest", ".nest", "test."}


def test_bloom_has_no_misses_and_honours_missing_filters(spark):
    types = spark.createDataFrame([(1, 1000, 0.01, "[0-9.]{7,}"), (2, 1000, 0.01, None)], "id long, expectedElements long, targetFpp double, pattern string")
    texts = spark.createDataFrame([(k, f"host 10.0.0.{k} word{k}") for k in range(20)], "partition_id long, text string")
    objects = spark.range(22)
    filters = bloom.build(texts, types)
    left = {r.id for r in bloom.prune(objects, filters, types, "10.0.0.7").collect()}
    assert {7, 20, 21} <= left and len(left) < 8
    assert {r.id for r in bloom.without_filters(objects, filters, types, "[0-9.]{7,}").collect()} == {20, 21}
    assert bloom.prune(objects, filters, types.where("id = 1"), "word").count() == 22


def test_metrics_of_no_tasks(spark):
    tasks = spark.createDataFrame([], "a long")
    out = metrics.aggregate(tasks, dict.fromkeys(metrics.AGGREGATES, "a")).first()
    assert (out.RecordsProcessed, out.ArchiveOffset, out.ArchiveDatabaseRowMaxLatency, out.ArchiveDatabaseRowMinLatency) == (0, -1, -(2**63), 2**63 - 1)


def test_admission_and_packing():
    b = Batching(quantum=10, partitions=1, ratio=1, speed=1, most_objects=100)
    hours = [(k * 3600, 4 << 20, 1) for k in range(1, 9)]
    assert schedule.admit(hours, 0, b) == 3 * 3600
    assert schedule.admit(hours, 3 * 3600, b) == 6 * 3600
    assert schedule.admit(hours, 8 * 3600, b) == 8 * 3600
    assert schedule.admit(hours, 0, b, before=7200) == 3600
    assert schedule.admit(hours, 0, Batching(most_objects=1)) == 7200
    queues = schedule.pack([(s, s) for s in (7, 6, 5, 4, 3)], 2)
    assert sorted(map(sum, queues)) == [11, 14] or sorted(map(sum, queues)) == [12, 13]


def test_offsets_round_trip():
    stored = offsets.Offset(T0, {("test-a", 777): 9999}).to_dict()
    assert stored == {"version": 1, "archiveOffset": {"offset": T0, "json": str(T0)}, "kafkaOffset": {"serializedKafkaOffset": {"test-a-777": 9999}}}
    assert offsets.from_dict(stored) == offsets.Offset(T0, {("test-a", 777): 9999})
    assert offsets.from_dict(offsets.Offset(None, None).to_dict()) == offsets.Offset()
    for bad in ({"version": 2}, {"version": 1, "kafkaOffset": {"serializedKafkaOffset": {"t": 1}}}, {"version": 1, "kafkaOffset": {"serializedKafkaOffset": {"t-1": None}}}):
        with pytest.raises(ValueError):
            offsets.from_dict(bad)


def test_options():
    with pytest.raises(ValueError, match="neither"):
        options.read({"queryXML": "<a/>"})
    with pytest.raises(ValueError, match="Pattern"):
        options.read({"queryXML": "<a/>", "archive.enabled": "true", "catalog": "c", "objects": "o", "bloom.withoutFilters": "true"})
    assert options.read({"QUERYXML": "<a/>", "kafka.enabled": "true", "tail.path": "t", "quantumLength": "3"}).batching.quantum == 3.0


@pytest.fixture
def store(tmp_path):
    """26 hourly objects of one record, and 11 records of a tail."""
    rows = []
    for k in range(26):
        at, path = T0 + k * 43200, f"2019/03-15/h/shop/shop.log-{k}.log.gz" + (".4" if k % 2 else "")
        body = f'<14>1 {datetime.fromtimestamp(at + 5, UTC):%Y-%m-%dT%H:%M:%SZ} web app - - [origin@32473 hostname="o"] event {k}\n'
        (tmp_path / "objects" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "objects" / path).write_bytes(gzip.compress(body.encode()))
        rows.append({"id": 500 + k, "directory": "Shop", "stream": "log:shop:0", "host": "WEB", "bucket": "b", "path": path, "logtime": at, "file_size": 31_000_000, "uncompressed_file_size": None if k == 3 else 5})
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "catalog.parquet")
    tail = [{"topic": "shop", "partition": 0, "offset": n, "value": f'<14>1 2020-01-01T00:00:{n:02d}Z th app - - [tenant@32473 streamname="s" directory="shop"] tail {n}'.encode()} for n in range(11)]
    pq.write_table(pa.Table.from_pylist(tail), tmp_path / "tail.parquet")
    return tmp_path


def reader(spark, store, kind, **extra):
    spark.dataSource.register(LogSource)
    base = {"queryXML": '<AND><index value="shop" operation="EQUALS"/><earliest value="1552600800" operation="GE"/></AND>', "archive.enabled": "true", "kafka.enabled": "true", "catalog": f"{store}/catalog.parquet"}
    return getattr(spark, kind).format("siltstone").options(**(base | {"objects": f"{store}/objects", "tail.path": f"{store}/tail.parquet", "num_partitions": "3"} | extra))


def test_batch_source(spark, store):
    df = reader(spark, store, "read").load()
    assert df.count() == 37
    row = df.where("_raw = 'event 3'").first()
    assert (row["index"], row.host, row.partition, row.offset, row.origin, row.source) == ("shop", "web", "503", 1, "o", "::")
    assert reader(spark, store, "read", queryXML='<index value="other" operation="EQUALS"/>').load().count() == 0


def test_metadata_source(spark, store):
    df = reader(spark, store, "read", **{"metadataQuery.enabled": "true", "kafka.enabled": "false"}).load()
    assert df.count() == 26
    assert df.where("partition = '503'").first()._raw == '{"uncompressed":-1,"compressed":31000000}'


def test_migration_source(spark, store):
    on = {"epochMigrationMode": "true", "kafka.enabled": "false"}
    got = sorted(map(tuple, reader(spark, store, "read", **on).load().collect()))
    objects = spark.read.parquet(f"{store}/catalog.parquet")
    first = archive.read_lines(spark, f"{store}/objects").withColumn("key", F.substring_index("object", "/objects/", -1))
    assert got == sorted(map(tuple, archive.migration(first, objects).collect())) and len(got) == 26
    rows = [(0, b"no record\nnor this"), (1, b""), (2, b"<14>1 2014-06-20T09:14:07Z h a - - - x\n<14>1 2014-06-20T09:14:08Z h a - - - y")]
    for k, data in rows:
        (store / "objects" / f"2019/03-15/h/shop.log-201903150{k}.gz").parent.mkdir(parents=True, exist_ok=True)
        (store / "objects" / f"2019/03-15/h/shop.log-201903150{k}.gz").write_bytes(gzip.compress(data))
    catalog = [{"id": k, "directory": "Shop", "stream": "S", "host": "H", "bucket": "b", "path": f"2019/03-15/h/shop.log-201903150{k}.gz", "logtime": T0, "file_size": 1, "uncompressed_file_size": 1} for k, _ in rows]
    pq.write_table(pa.Table.from_pylist(catalog), store / "odd.parquet")
    odd = {r.partition: r for r in reader(spark, store, "read", catalog=f"{store}/odd.parquet", zone="UTC", **on).load().withColumn("s", F.unix_timestamp("_time")).collect()}
    assert {k: (r.s, r.source, r.offset) for k, r in odd.items()} == {"0": (1552608000, "unknown-source", 0), "1": (1552611600, "unknown-source", 0), "2": (1403255647, "::", 0)}
    named = '"object":{"bucket":"b","path":"2019/03-15/h/shop.log-2019031501.gz","partition":"1"}'
    assert odd["1"]._raw == f'{{"epochMigration":true,"format":"non-rfc5424",{named},"timestamp":{{"path-extracted":"2019-03-15T01:00:00Z","path-extracted-precision":"hourly","source":"object-path"}}}}'


def test_source_of_objects_without_filters(spark, store):
    types = [{"id": 1, "expectedElements": 10, "targetFpp": 0.1, "pattern": "a+"}, {"id": 2, "expectedElements": 10, "targetFpp": 0.1, "pattern": "b+"}]
    filters = [{"partition_id": 500 + k, "filter_type_id": 1 + k % 2, "bits": None if k == 4 else [1]} for k in range(22)]
    pq.write_table(pa.Table.from_pylist(types), store / "types.parquet")
    pq.write_table(pa.Table.from_pylist(filters), store / "filters.parquet")
    on = {"bloom.withoutFilters": "true", "bloom.withoutFiltersPattern": "a+", "bloom.filters": f"{store}/filters.parquet", "bloom.types": f"{store}/types.parquet", "kafka.enabled": "false"}
    left = {int(r.partition) - 500 for r in reader(spark, store, "read", **on).load().collect()}
    assert left == {k for k in range(26) if k % 2 or k == 4 or k >= 22}
    assert reader(spark, store, "read", **(on | {"bloom.withoutFiltersPattern": "c"})).load().count() == 26
    with pytest.raises(Exception, match="search terms"):
        reader(spark, store, "read", queryXML='<indexstatement value="x" operation="EQUALS"/>', **on).load().count()


@pytest.mark.parametrize(
    ("extra", "said"),
    [({"bloom.enabled": "true"}, "bloom.filters"), ({"audit.user": "u"}, "run by me"), ({"audits": "r"}, "audits"), ({"zone": "Nowhere/X"}, "zone"), ({"bloom.withoutFilters": "true", "bloom.withoutFiltersPattern": "a"}, "bloom.filters")],
)
def test_options_that_are_errors(extra, said):
    with pytest.raises(ValueError, match=said):
        options.read({"queryXML": "<a/>", "kafka.enabled": "true", "tail.path": "t"} | extra, "me")


def test_source_hashes_as_spark_does(spark):
    df = spark.createDataFrame([("Abc",), ("77",), ("",), ("Ünïcode " * 9,)], "t string")
    for r in df.select("t", bloom.positions(F.col("t"), 9600, 7).alias("p")).collect():
        assert catalogs.positions(r.t, 9600, 7) == r.p
    for t in ("test.nest", "a=b,c--d", "x@y.z:1 "):
        assert catalogs.tokens_of(t, None) == set(one(spark, search_tokens.delimiter_tokens(F.lit(t))))


def test_bloom_leaves_out_objects(spark, store):
    types = spark.createDataFrame([(1, 1000, 0.001, "[0-9]+")], "id long, expectedElements long, targetFpp double, pattern string")
    texts = spark.createDataFrame([(500 + k, f"event {k}") for k in range(20)], "partition_id long, text string")
    types.write.parquet(f"{store}/types.parquet")
    bloom.build(texts, types).write.parquet(f"{store}/filters.parquet")
    on = {"bloom.enabled": "true", "bloom.filters": f"{store}/filters.parquet", "bloom.types": f"{store}/types.parquet", "kafka.enabled": "false", "figures": f"file://{store}/figures"}
    got = reader(spark, store, "read", queryXML='<indexstatement value="event 7" operation="EQUALS"/>', **on).load()
    assert [r._raw for r in got.collect()] == ["event 7"]
    told = metrics.produced(spark, f"file://{store}/figures").first()
    assert 7 <= told.ArchiveObjectsProcessed <= 9 and told.RecordsProcessed == 1  # its own, and the six without a filter
    assert told.ArchiveCompressedBytesProcessed > 0 and told.ArchiveOffset == T0 + 25 * 43200
    negated = '<NOT><indexstatement value="event 7" operation="EQUALS"/></NOT>'
    assert reader(spark, store, "read", queryXML=negated, **on).load().count() == 25


def test_catalog_of_relations(spark, store):
    key = {"log_group": [(1, "g")], "host": [(5, "WEB")], "logtag": [(9, "t")], "bucket": [(3, "b")]}
    for name, rows in key.items():
        pq.write_table(pa.Table.from_pylist([{"id": k, "logtag" if name == "logtag" else "name": v} for k, v in rows]), store / f"{name}.parquet")
    pq.write_table(pa.Table.from_pylist([{"id": 1, "gid": 1, "directory": "Shop", "stream": "log:shop:0", "tag": "t"}, {"id": 2, "gid": 8, "directory": "other", "stream": "s", "tag": "t"}]), store / "stream.parquet")
    pq.write_table(pa.Table.from_pylist([{"id": 1, "name": "WEB", "gid": 1}]), store / "stream_host.parquet")
    pq.write_table(pa.table({"logfile_id": pa.array([2], pa.int64())}), store / "corrupted.parquet")
    files = [(1, "2019/03-15/x/y.log-2019031500.log.gz", 5), (2, "2019/03-15/x/y.log-2019031501.log.gz", 5), (3, "2019/03-15/x/no hour", 5), (4, "2019/03-15/x/y.log-2019031502.log.gz", 6), (5, "2019/03-20/x/y.log-2019032002.log.gz", 5)]
    pq.write_table(pa.Table.from_pylist([{"id": k, "logdate": datetime.strptime(p[:10], "%Y/%m-%d").date(), "bucket_id": 3, "path": p, "host_id": h, "logtag_id": 9, "file_size": 10, "uncompressed_file_size": None} for k, p, h in files]), store / "logfile.parquet")
    o = options.read({"queryXML": "<index value='shop' operation='EQUALS'/>", "archive.enabled": "true", "catalog.tables": str(store), "objects": "x", "zone": "UTC"})
    found = catalogs.Objects(o, parse(o.query))
    assert found.between(-(1 << 62), 1 << 62).select(["id", "bucket", "host", "logtime"]).sort_by("id").to_pylist() == [{"id": 1, "bucket": "b", "host": "WEB", "logtime": 1552608000}, {"id": 5, "bucket": "b", "host": "WEB", "logtime": 1553047200}]
    assert found.between(1552608000, 1553047200)["id"].to_pylist() == [5] and found.between(0, 1552608000)["id"].to_pylist() == [1]
    other = options.read({"queryXML": "<index value='other' operation='EQUALS'/>", "archive.enabled": "true", "catalog.tables": str(store), "objects": "x"})
    assert len(catalogs.Objects(other, parse(other.query)).between(0, 1 << 62)) == 0


def refused(*_args, **_kwargs):
    raise PermissionError("no")


def test_denied_objects_are_left_out_and_others_are_errors(store, monkeypatch):
    o = options.read({"queryXML": "<index value='*' operation='EQUALS'/>", "archive.enabled": "true", "catalog": f"{store}/catalog.parquet", "objects": f"{store}/objects", "figures": f"{store}/told"})
    plan = datasource.Plan(o)
    part = datasource.ArchivePart(plan.catalog.between(0, 1 << 40).to_pylist())
    assert sum(b.num_rows for b in plan.rows(part)) == 26
    whole = plan._data
    monkeypatch.setattr(plan, "_data", lambda r: refused() if r["id"] < 503 else whole(r))
    assert sum(b.num_rows for b in plan.rows(part)) == 23
    assert sorted(json.loads(f.read_text())["denied_objects"] for f in (store / "told").iterdir()) == [0, 3]
    part.objects[5]["path"] = "gone"
    with pytest.raises(FileNotFoundError):
        list(plan.rows(part))


AUDITED = []


def audited(rows, query, reason, user):
    AUDITED.append((rows.num_rows, query, reason, user))


def test_audit_hook(store):
    named = {"audit.hook": "test_engine:audited", "audit.query": "q", "audit.reason": "r", "audit.user": "me"}
    o = options.read({"queryXML": "<index value='*' operation='EQUALS'/>", "archive.enabled": "true", "catalog": f"{store}/catalog.parquet", "objects": f"{store}/objects"} | named, "me")
    plan = datasource.Plan(o)
    sys.modules.setdefault("test_engine", sys.modules[__name__])
    list(plan.rows(datasource.ArchivePart(plan.catalog.between(0, T0).to_pylist())))
    assert sys.modules["test_engine"].AUDITED == [(1, "q", "r", "me")]


def test_broker_options_and_rows(spark):
    node = parse("<AND><index value='shop' operation='EQUALS'/><indexstatement value='tail' operation='EQUALS'/></AND>")
    o = tail.broker_options(node, "b:9092", {"security.protocol": "SASL_PLAINTEXT"}, include_from=7, limit=50)
    assert o["subscribePattern"] == r"^\Qshop\E$" and o["startingTimestamp"] == "7000" and o["kafka.security.protocol"] == "SASL_PLAINTEXT" and o["maxOffsetsPerTrigger"] == "50"
    sd = '[event_node_source@32473 hostname="h" source_module="m"][event_node_relay@32473 source="r"][tenant@32473 directory="shop" streamname="s"]'
    rows = [("shop", 0, 3, f"<14>1 2020-01-01T00:00:0{k}Z th app - - {sd} {m}".encode()) for k, m in enumerate(("tail 1", "other", "tail 2"))]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, value binary")
    got = tail.events(df, node, include_from=1577836801).collect()
    assert [(r["index"], r.sourcetype, r.host, r.source, r.partition, r._raw) for r in got] == [("shop", "s", "th", "m:h:", "0", "tail 2")]
    bad = df.withColumn("value", F.lit(b"no record"))
    assert tail.events(bad, node, skip_bad=True).count() == 0
    with pytest.raises(Exception, match="not a record at shop-0:3"):
        tail.events(bad, node).collect()


def test_stream_in_batches_and_across_a_restart(spark, store):
    out, state, batches = f"{store}/out", f"{store}/state", []

    def start():
        query = reader(spark, store, "readStream").load().writeStream.option("checkpointLocation", state).trigger(processingTime="0 seconds")
        return query.foreachBatch(lambda df, n: (batches.append(n), df.write.mode("append").parquet(out))).start()

    first = start()
    while len(batches) < 2 and first.isActive:
        first.processAllAvailable() if len(batches) else first.awaitTermination(1)
        if len(batches) >= 2:
            break
    first.stop()
    second = start()
    second.processAllAvailable()
    second.stop()
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("partition", "offset", "_raw").distinct().count() == 37


def test_archive_batch_pipeline(spark, store):
    objects = spark.read.parquet(f"{store}/catalog.parquet")
    events = archive.events(spark, f"{store}/objects", objects)
    assert events.count() == 26 and events.where("index = 'shop' and offset = 1").count() == 26
    assert archive.metadata(objects).count() == 26
    first = archive.read_lines(spark, f"{store}/objects", first_only=True).withColumn("key", F.substring_index("object", "/objects/", -1))
    moved = archive.migration(first, objects.withColumn("path", F.col("path")))
    assert moved.count() == 26 and moved.where("_raw like '%\"format\":\"rfc5424\"%'").count() == 26


def test_late_events_and_dropped_state(spark, tmp_path):
    """Three batches of files: what lies behind the watermark of the first is left out of the third, and its state is gone."""
    day = lambda k: datetime(2024, 1, 1 + k, 12, tzinfo=UTC)
    schema = "event_type string, time timestamp"
    batches = [[("a", day(0)), ("a", day(0)), ("a", day(9))], [("a", day(9))], [("a", day(1)), ("a", day(9)), ("b", day(12))]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1 * (k < 2))  # files are read by age
    for mode, keys in (("append", ()), ("update", ("start", "event_type"))):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withWatermark("time", "2 days")
        got = windows.run(spark, windows.tumbling(stream, "1 day"), f"file://{tmp_path}/{mode}", mode, keys)
        n = {(datetime.fromtimestamp(r.start, UTC).day, r.event_type): r.n for r in got.collect()}
        if mode == "append":
            assert n == {(1, "a"): 2, (10, "a"): 3}
        else:
            assert n == {(1, "a"): 2, (10, "a"): 3, (13, "b"): 1}


def test_catalog_slice_by_day(spark, tmp_path):
    rows = [(k, k * 43200) for k in range(8)]
    found = spark.createDataFrame(rows, "id long, logtime long").withColumn("logdate", F.to_date(F.timestamp_seconds("logtime")))
    kept = catalog.materialise(found, f"{tmp_path}/slice")
    for after, last in ((0, 86400), (-1, 0), (100000, 200000), (43200, 10**9)):
        near = catalog.of_hours(kept, after, last)
        assert sorted(r.id for r in near.collect()) == [k for k, t in rows if after < t <= last]
    assert "PartitionFilters: [isnotnull(logdate" in catalog.of_hours(kept, 0, 86400)._jdf.queryExecution().executedPlan().toString()


def test_catalog_under_other_names(spark, tmp_path):
    for f in ("groups", "stream", "stream_host", "logfile", "host", "bucket", "logtag", "corrupted"):
        spark.range(1).write.parquet(f"{tmp_path}/{f}.parquet")
    assert catalog.load(spark, str(tmp_path), {"log_group": "groups"}).log_group.count() == 1
