"""The catalog as the source's planner reads it: Arrow tables, with filters pushed into their scans."""

from __future__ import annotations

import re
import struct
from datetime import UTC, datetime, timedelta
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds

from siltstone.functions.paths import HOURLY
from siltstone.functions.search_tokens import MAJOR, MINOR
from siltstone.operators.bloom import shape
from siltstone.plans.conditions import NAMES, TERM
from siltstone.plans.evaluate import object_may_match
from siltstone.plans.options import Options
from siltstone.plans.query import Leaf, Node, leaves
from siltstone.sources import stores

#: What a reader needs of an object.
COLUMNS = ["id", "directory", "stream", "host", "bucket", "path", "logtime", "file_size", "uncompressed_file_size"]
_SEED = 42  # of Spark's xxhash64 (fixed value)
#: Days around a range of hours that may hold its objects, whatever the zone.
MARGIN = timedelta(days=1)
#: Seconds from the epoch beyond which a bound is none.
FAR = 1 << 37


def tokens_of(text: str, pattern: str | None) -> set[str]:
    """As ``functions.search_tokens``: by a filter's pattern, or by delimiters where it has none."""
    if pattern is not None:
        return {m[0] for m in re.finditer(pattern, text)}
    out = set()
    for major in re.split(MAJOR, text):
        pieces = [x for x in re.split(f"({MINOR})", major) if x]
        out |= {"".join(pieces[i:k]) for i in range(len(pieces)) for k in range(i + 1, len(pieces) + 1)}
    return out


def positions(token: str, bits: int, hashes: int) -> list[int]:
    """As ``operators.bloom.positions``: Spark's hash of the token, then of each number with that as its seed."""
    import xxhash

    seed = xxhash.xxh64_intdigest(token.lower().encode(), seed=_SEED)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return [signed(xxhash.xxh64_intdigest(struct.pack("<i", i), seed=seed)) % bits for i in range(1, hashes + 1)]


class Objects:
    """The hourly objects that a query may need: from one flat table, or from the relations of a catalog."""

    def __init__(self, options: Options, node: Node):
        self.o, self.node = options, node
        self.terms = any(leaf.tag == TERM for leaf in leaves(node))
        self._streams: pa.Table | None = None

    def between(self, after: int, last: int, columns: list[str] = COLUMNS) -> pa.Table:
        """Objects of the hours after ``after`` up to ``last``, without corrupted ones and those whose filters lack the query's terms."""
        last = min(last, self.o.include_before - 1)
        if self.o.catalog_tables:
            found = self._related(after, last)
        else:
            hour = ds.field("logtime")
            found = stores.table(self.o.catalog, COLUMNS, (hour > after) & (hour <= last) & self._condition(ds.field, pc.scalar(True)), self.o.store)
        if self.o.without_filters:
            found = found.filter(pc.invert(pc.is_in(found["id"], value_set=self._filtered())))
        if self.o.bloom and self.terms and len(found):
            found = found.filter(self._with_terms(found))
        return found.select(columns)

    def _condition(self, column, true: Any, term=None) -> Any:
        names = dict(zip(NAMES, map(column, ("directory", "stream", "host")), strict=True))
        return object_may_match(self.node, names, column("logtime"), true, term)

    def _read(self, name: str, columns: list[str], where: Any = None) -> pa.Table:
        """Columns of a relation; ids and sizes as 64-bit numbers, whatever their width, so that relations can be joined."""
        found = stores.table(f"{self.o.catalog_tables}/{name}.parquet", columns, where, self.o.store)
        kinds = [(c, pa.int64() if c.endswith(("id", "size")) else pa.string()) for c in columns]
        return found.select(columns).cast(pa.schema(kinds))

    def streams(self) -> pa.Table:
        """(directory, stream, host, host_id, logtag_id, logtag) of the query's streams: group by group, then by the names of hosts and tags."""
        if self._streams is None:
            key = lambda t, **names: t.rename_columns([names.get(c, c) for c in t.column_names])
            groups = key(self._read("log_group", ["id"]), id="gid")
            out = self._read("stream", ["gid", "directory", "stream", "tag"]).join(groups, "gid", join_type="inner")
            out = out.join(key(self._read("stream_host", ["gid", "name"]), name="host"), "gid", join_type="inner")
            out = out.join(key(self._read("host", ["id", "name"]), id="host_id", name="host"), "host", join_type="inner")
            out = out.join(key(self._read("logtag", ["id", "logtag"]), id="logtag_id", logtag="tag"), "tag", join_type="inner")
            names = dict(zip(NAMES, (out["directory"], out["stream"], out["host"]), strict=True))
            mask = object_may_match(self.node, names, None, pa.scalar(True))
            out = out if isinstance(mask, pa.Scalar) else out.filter(mask)
            self._streams = out.select(["directory", "stream", "host", "host_id", "logtag_id"])
        return self._streams

    def _related(self, after: int, last: int) -> pa.Table:
        streams = self.streams()
        day = lambda t, margin: pa.scalar(datetime.fromtimestamp(t, UTC).date() + margin)
        where = pc.field("host_id").isin(pc.unique(streams["host_id"])) & pc.field("logtag_id").isin(pc.unique(streams["logtag_id"]))
        if after > -FAR:
            where &= pc.field("logdate") >= day(after, -MARGIN)
        if last < FAR:
            where &= pc.field("logdate") <= day(last, MARGIN)
        files = self._read("logfile", ["id", "bucket_id", "path", "host_id", "logtag_id", "file_size", "uncompressed_file_size"], where)
        found = pc.struct_field(pc.extract_regex(files["path"], HOURLY.replace("([0-9]{10})", "(?P<hour>[0-9]{10})")), "hour")
        hour = pc.strptime(found, "%Y%m%d%H", "s", error_is_null=True)
        hour = pc.assume_timezone(hour, self.o.zone, ambiguous="earliest", nonexistent="latest").cast(pa.int64())
        files = files.append_column("logtime", hour).filter(pc.fill_null(pc.and_(pc.greater(hour, after), pc.less_equal(hour, last)), False))
        corrupted = pc.unique(self._read("corrupted", ["logfile_id"])["logfile_id"])
        files = files.filter(pc.invert(pc.is_in(files["id"], value_set=corrupted)))
        buckets = self._read("bucket", ["id", "name"]).rename_columns(["bucket_id", "bucket"])
        out = files.join(streams, ["host_id", "logtag_id"], join_type="inner").join(buckets, "bucket_id", join_type="inner")
        mask = self._condition(lambda c: out[c], pa.scalar(True))
        return out.select(COLUMNS) if isinstance(mask, pa.Scalar) else out.filter(mask).select(COLUMNS)

    def _types(self) -> list[dict]:
        return stores.table(self.o.filter_types, store=self.o.store).to_pylist()  # a handful

    def _filtered(self) -> pa.Array:
        """Objects with a filter of the types with exactly the option's pattern."""
        types = [t["id"] for t in self._types() if t["pattern"] == self.o.without_filters_pattern]
        where = ds.field("filter_type_id").isin(types) & ds.field("bits").is_valid()
        return pc.unique(stores.table(self.o.filters, ["partition_id"], where, self.o.store)["partition_id"])

    def _with_terms(self, found: pa.Table) -> Any:
        ids = found["id"].combine_chunks()

        def term(leaf: Leaf) -> pa.Array:
            lacking = self._lacking(leaf.value, ids)
            return pc.invert(pc.is_in(ids, value_set=pa.array(lacking, ids.type)))

        mask = self._condition(lambda c: found[c].combine_chunks(), pa.scalar(True), term)
        return pa.array([mask.as_py()] * len(ids)) if isinstance(mask, pa.Scalar) else mask

    def _lacking(self, text: str, ids: pa.Array) -> list[int]:
        """Objects that have filters of types which say something about a term, of which none has all its bits."""
        bits: dict[int, np.ndarray] = {}
        for t in self._types():
            n, hashes = shape(t["expectedElements"], t["targetFpp"])
            if tokens := tokens_of(text, t["pattern"]):
                bits[t["id"]] = np.unique([p for x in tokens for p in positions(x, n, hashes)])
        hit: dict[int, bool] = {}
        where = ds.field("filter_type_id").isin(list(bits)) & ds.field("bits").is_valid() & ds.field("partition_id").isin(ids)
        if bits:
            for batch in stores.dataset(self.o.filters, self.o.store).scanner(columns=["partition_id", "filter_type_id", "bits"], filter=where).to_batches():
                for k, kind, own in zip(batch["partition_id"].to_pylist(), batch["filter_type_id"].to_pylist(), batch["bits"], strict=True):
                    hit[k] = hit.get(k, False) or bool(np.isin(bits[kind], own.values.to_numpy(zero_copy_only=False)).all())
        return [k for k, has in hit.items() if not has]

