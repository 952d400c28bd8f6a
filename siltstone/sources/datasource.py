"""The log source for Spark: ``spark.dataSource.register(LogSource)``, then ``format("siltstone")``, as a batch or a stream.

The archive side reads hourly objects that a catalog lists: one parquet table (``catalog``: id, directory, stream, host, bucket, path,
logtime, file_size, uncompressed_file_size), or the relations of one in a folder (``catalog.tables``). With bloom.enabled or
bloom.withoutFilters, tables of filters (partition_id, filter_type_id, bits) and filter types (id, expectedElements, targetFpp, pattern)
narrow the objects. The tail side reads a replayable table (topic, partition, offset, value). Both give the same nine columns, as Arrow
batches. Which objects and offsets a batch has follows from the catalog and the batch's offsets alone, so that a restarted stream reads
the same again.
"""

from __future__ import annotations

import getpass
import importlib
import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from siltstone.plans import schedule
from siltstone.plans.conditions import HOUR, TERM, earliest_epoch, topic_regex
from siltstone.plans.evaluate import rows_match
from siltstone.plans.options import Options, read
from siltstone.plans.query import leaves, parse
from siltstone.sources import archive, records, stores
from siltstone.sources.catalogs import Objects
from siltstone.sources.offsets import Offset, from_dict

SCHEMA = "_time timestamp, _raw string, index string, sourcetype string, host string, source string, partition string, offset long, origin string"
NAMES = ("_time", "_raw", "index", "sourcetype", "host", "source", "partition", "offset", "origin")
EPOCH, MICROSECOND = datetime(1970, 1, 1, tzinfo=UTC), timedelta(microseconds=1)
#: Lines that are decoded at once.
LINES = 8192


@dataclass
class ArchivePart(InputPartition):
    """Objects that one task reads, one after the other."""

    objects: list[dict]


@dataclass
class TailPart(InputPartition):
    """A range of offsets (the end isn't in it) of one topic's partition."""

    topic: str
    part: int
    start: int
    end: int


def _java_pattern(regex: str) -> str:
    r"""A Java pattern with ``\Q`` and ``\E`` for Python."""
    return re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), regex)


def _batch(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), list(NAMES))


def _same(value: str, n: int) -> pa.Array:
    return pa.array([value] * n, pa.string())


class Figures:
    """What a task has done, written as one JSON line for ``operators.metrics`` if the option ``figures`` names a folder."""

    def __init__(self, options: Options):
        self.o, self.began = options, time.perf_counter()
        self.of = {"records": 0, "bytes": 0, "compressed_bytes": 0, "objects": 0, "denied_objects": 0, "archive_offset": None, "tail_offset": None, "latest_tail_timestamp": None}
        self.latency: list[float] = []

    def add(self, **numbers: int) -> None:
        for k, v in numbers.items():
            self.of[k] += v

    def most(self, **numbers: int) -> None:
        for k, v in numbers.items():
            self.of[k] = v if self.of[k] is None else max(self.of[k], v)

    def close(self) -> None:
        if not self.o.figures:
            return
        seconds = max(time.perf_counter() - self.began, 1e-6)
        rate = {"seconds": seconds, "records_per_second": int(self.of["records"] / seconds), "bytes_per_second": int(self.of["bytes"] / seconds)}
        slow = [int(x * 1000) for x in self.latency]
        waits = {"object_rows": len(slow), "object_milliseconds": sum(slow) // len(slow) if slow else None, "object_milliseconds_most": max(slow, default=None), "object_milliseconds_least": min(slow, default=None)}
        where, path = stores.opened(self.o.figures, self.o.store)
        where.create_dir(path, recursive=True)
        with where.open_output_stream(f"{path}/{uuid.uuid4().hex}.json") as f:
            f.write((json.dumps(self.of | rate | waits) + "\n").encode())


class Plan:
    """What a query reads, from options and catalog."""

    def __init__(self, options: Options):
        self.o = options
        self.node = parse(options.query)
        if self.o.without_filters and any(leaf.tag == TERM for leaf in leaves(self.node)):
            raise ValueError("bloom.withoutFilters doesn't go with search terms")
        self.topics = re.compile(_java_pattern(topic_regex(self.node)))
        self.catalog = Objects(options, self.node)

    def hours(self, after: int) -> list[tuple[int, int, int]]:
        """(hour, bytes, objects) of the hours after ``after``: sums of three columns of the catalog."""
        found = self.catalog.between(after, self.o.include_before, ["logtime", "file_size"])
        sums = found.group_by("logtime").aggregate([("file_size", "sum"), ("file_size", "count")]).sort_by("logtime")
        return list(zip(*(sums[c].to_pylist() for c in ("logtime", "file_size_sum", "file_size_count")), strict=True))

    def tail_bounds(self) -> dict[tuple[str, int], tuple[int, int]]:
        """First offset and next offset of each matching topic's partitions; each batch of the table is summed up on its own."""
        found: dict[tuple[str, int], tuple[int, int]] = {}
        for batch in stores.dataset(self.o.tail_path, self.o.store).scanner(columns=["topic", "partition", "offset"]).to_batches():
            for r in pa.Table.from_batches([batch]).group_by(["topic", "partition"]).aggregate([("offset", "min"), ("offset", "max")]).to_pylist():
                if self.topics.match(r["topic"]):
                    key, least, next_one = (r["topic"], r["partition"]), r["offset_min"], r["offset_max"] + 1
                    low, high = found.get(key, (least, next_one))
                    found[key] = (min(low, least), max(high, next_one))
        return found

    def parts(self, start: Offset, end: Offset) -> list[InputPartition]:
        units: list[tuple[int, dict | TailPart]] = []
        if start.archive is not None and end.archive is not None:
            units += [(r["file_size"], r) for r in self.catalog.between(start.archive, end.archive).to_pylist()]
        for key, n in (end.tail or {}).items():
            first = (start.tail or {}).get(key, 0)
            if first != n:
                units.append((schedule.TAIL_UNIT_BYTES, TailPart(key[0], key[1], first, n)))
        out: list[InputPartition] = []
        for queue in schedule.pack(units, self.o.batching.partitions):
            if own := [u for u in queue if isinstance(u, dict)]:
                out.append(ArchivePart(sorted(own, key=lambda r: (r["logtime"], r["id"]))))
            out += [u for u in queue if isinstance(u, TailPart)]
        return out

    def rows(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        figures = Figures(self.o)
        if isinstance(part, TailPart):
            yield from self._tail(part, figures)
        elif self.o.metadata:
            if part.objects:
                yield self._metadata(part.objects)
                figures.add(records=len(part.objects))
        else:
            for r in part.objects:
                began = time.perf_counter()
                try:
                    data = self._data(r)
                except OSError as e:
                    if not stores.denied(e):
                        raise
                    figures.add(denied_objects=1)  # what the store won't show is left out, and counted
                    continue
                figures.add(objects=1, compressed_bytes=len(data))
                figures.most(archive_offset=r["logtime"])
                figures.latency.append(time.perf_counter() - began)
                if self.o.epoch_migration:
                    yield self._migration(r, data)
                    figures.add(records=1)
                else:
                    yield from self._archive(r, data, figures)
        figures.close()

    def _keep(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        if not self.o.residual:
            return rows
        return rows.filter(pc.fill_null(rows_match(self.node, {n: rows[n] for n in ("index", "sourcetype", "host")}, rows["_time"], rows["_raw"]), False))

    def _metadata(self, found: list[dict]) -> pa.RecordBatch:
        raw = [f'{{"uncompressed":{-1 if r["uncompressed_file_size"] is None else r["uncompressed_file_size"]},"compressed":{r["file_size"]}}}' for r in found]
        text = lambda k: pa.array([r[k] for r in found], pa.string())
        times = pa.array([r["logtime"] * 1_000_000 for r in found], pa.int64()).cast(records.TIMESTAMP)
        n = len(found)
        return _batch(times, pa.array(raw, pa.string()), text("directory"), text("stream"), text("host"), _same("", n), pa.array([str(r["id"]) for r in found], pa.string()), pa.array([0] * n, pa.int64()), _same("", n))

    def _data(self, r: dict) -> bytes:
        store, root = stores.opened(self.o.objects, self.o.store)
        with store.open_input_stream(f"{root}/{r['path']}", compression=None) as f:
            return f.read()

    def _migration(self, r: dict, data: bytes) -> pa.RecordBatch:
        """One envelope an object, by its first event; one without a record, or without any line, is described by its path."""
        at, precision = records.path_time(r["path"], self.o.zone)
        times = {"path-extracted": None if at is None else f"{at:%Y-%m-%dT%H:%M:%SZ}", "path-extracted-precision": precision}
        form, source, origin = "non-rfc5424", "unknown-source", "unknown-origin"
        first = records.Decoded(pa.array([next(archive.lines(data), b"").decode("utf-8", "replace")]), self.o.ids)
        if first.good[0].as_py() and first.time[0].is_valid:
            at = first.time[0].as_py()
            form, source, origin = "rfc5424", first.source()[0].as_py(), first.origin()[0].as_py()
            times = {"rfc5424timestamp": first.text[0].as_py(), "epoch": (at - EPOCH) // MICROSECOND} | times | {"source": "syslog"}
        else:
            times["source"] = "object-path"
        named = {"bucket": r["bucket"], "path": r["path"], "partition": str(r["id"])}
        raw = {"epochMigration": True, "format": form, "object": named, "timestamp": {k: v for k, v in times.items() if v is not None}}
        text = [json.dumps(raw, ensure_ascii=False, separators=(",", ":")), *(r[k].lower() for k in ("directory", "stream", "host")), source, str(r["id"])]
        return _batch(pa.array([at], records.TIMESTAMP), *(pa.array([x], pa.string()) for x in text), pa.array([0], pa.int64()), pa.array([origin], pa.string()))

    def _archive(self, r: dict, data: bytes, figures: Figures) -> Iterator[pa.RecordBatch]:
        done, more = 0, archive.lines(data)
        while lines := [x.decode("utf-8", "replace") for _, x in zip(range(LINES), more, strict=False)]:
            found = records.Decoded(pa.array(lines, pa.string()), self.o.ids)
            n = len(lines)
            bad = pc.index(found.good, False).as_py()
            if bad >= 0 and not self.o.skip_bad:
                raise records.BadRecord(f"{r['path']}, line {done + bad + 1}: {lines[bad][:200]}")
            names = [_same(r[k].lower(), n) for k in ("directory", "stream", "host")]
            rows = _batch(found.time, found.message, *names, found.source(), _same(str(r["id"]), n), pa.array(range(done + 1, done + n + 1), pa.int64()), found.origin())
            rows = self._keep(rows if bad < 0 else rows.slice(0, bad))
            figures.add(records=len(rows), bytes=sum(map(len, lines if bad < 0 else lines[:bad])))
            self._audit(rows)
            yield rows
            if bad >= 0:  # what follows a line that is no record is left out
                return
            done += n

    def _audit(self, rows: pa.RecordBatch) -> None:
        a = self.o.audit
        if a.hook:
            module, _, name = a.hook.partition(":")
            getattr(importlib.import_module(module), name)(rows, a.query, a.reason, a.user)

    def _tail(self, p: TailPart, figures: Figures) -> Iterator[pa.RecordBatch]:
        at = ds.field("offset")
        where = (ds.field("topic") == p.topic) & (ds.field("partition") == p.part) & (at >= p.start) & (at < p.end)
        table = stores.table(self.o.tail_path, ["offset", "value"], where, self.o.store).sort_by("offset")
        for batch in table.to_batches(max_chunksize=LINES):
            lines = pa.array([bytes(x).decode("utf-8", "replace") for x in batch["value"].to_pylist()], pa.string())
            found = records.Decoded(lines, self.o.ids)
            if not self.o.skip_bad and (bad := pc.index(found.good, False).as_py()) >= 0:
                raise records.BadRecord(f"{p.topic}-{p.part}, offset {batch['offset'][bad]}: {lines[bad].as_py()[:200]}")
            rows = _batch(found.time, found.message, found.tenant("directory"), found.tenant("streamname"), found.host, found.source(tail_rule=True), _same(str(p.part), len(lines)), batch["offset"].cast(pa.int64()), found.origin())
            recent = pc.greater_equal(found.time.cast(pa.int64()), max(self.o.include_from * 1_000_000, -(1 << 63)))
            rows = self._keep(rows.filter(pc.and_(found.good, pc.fill_null(recent, True))))
            figures.add(records=len(rows), bytes=sum(map(len, lines.to_pylist())))
            figures.most(tail_offset=p.end)
            if latest := pc.max(found.time.cast(pa.int64())).as_py():
                figures.most(latest_tail_timestamp=latest // 1000)
            yield rows


class LogBatchReader(DataSourceReader):
    def __init__(self, options: Options):
        self.plan = Plan(options)

    def partitions(self) -> list[InputPartition]:
        o = self.plan.o
        bounds = self.plan.tail_bounds() if o.tail else {}
        start = Offset(-(1 << 62) if o.archive else None, {k: low for k, (low, _) in bounds.items()})
        end = Offset(o.include_before if o.archive else None, {k: high for k, (_, high) in bounds.items()})
        return self.plan.parts(start, end) or [ArchivePart([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.plan.rows(partition)


class LogStreamReader(DataSourceStreamReader):
    """Hours are admitted batch by batch; the tail's end is fixed at the first batch unless it is continuous.

    After a restart Spark first asks for the last planned range, from whose end this reader goes on.
    """

    def __init__(self, options: Options, now: int):
        self.plan, self.now = Plan(options), now
        self.last: int | None = None
        self.ends: dict[tuple[str, int], int] | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        o = self.plan.o
        archive_at = earliest_epoch(self.plan.node, self.now) - HOUR if o.archive else None
        return Offset(archive_at, {k: low for k, (low, _) in self.plan.tail_bounds().items()} if o.tail else None).to_dict()

    def latestOffset(self) -> dict:  # noqa: N802
        o = self.plan.o
        if o.archive:
            if self.last is None:
                self.last = from_dict(self.initialOffset()).archive
            self.last = schedule.admit(self.plan.hours(self.last), self.last, o.batching, o.include_before)
        if o.tail and (self.ends is None or o.continuous):
            self.ends = {k: high for k, (_, high) in self.plan.tail_bounds().items()}
        return Offset(self.last if o.archive else None, self.ends if o.tail else None).to_dict()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, upto = from_dict(start), from_dict(end)
        if upto.archive is not None:
            if first.archive is not None and upto.archive < first.archive:
                raise ValueError(f"offsets go back from {first.archive} to {upto.archive}")
            self.last = max(upto.archive, self.last if self.last is not None else upto.archive)
        return self.plan.parts(first, upto) or [ArchivePart([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.plan.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept that a commit could free."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "siltstone"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> Options:
        return read(dict(self.options), getpass.getuser())

    def reader(self, schema) -> DataSourceReader:
        return LogBatchReader(self._options())

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return LogStreamReader(self._options(), int(self.options.get("now", time.time())))
