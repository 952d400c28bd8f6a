"""RFC 5424 records read in Arrow arrays, for the data source's own readers; the rules are those of ``functions.syslog``."""

from __future__ import annotations

import re
from datetime import UTC, datetime
from zoneinfo import ZoneInfo

import pyarrow as pa
import pyarrow.compute as pc

from siltstone.functions.paths import DAILY, HOURLY
from siltstone.functions.syslog import IDS, TIME, Ids

_QUOTED = r'"(?:[^"\\]|\\(?s:.))*"'
_RECORD = (
    r"(?s)^<[0-9]{1,3}>[0-9]{1,2} (?P<time>[^\s\x{FFFF}]+) (?P<host>[^\s\x{FFFF}]+) \S+ \S+ \S+ "
    rf'(?P<sd>-|(?:\[(?:[^\]"\\\x{{FFFF}}]|\\.|{_QUOTED})*\])+)(?P<rest>(?: .*)?)$'
)
TIMESTAMP = pa.timestamp("us", tz="UTC")


class BadRecord(ValueError):
    """A line that is no record."""


class Decoded:
    """The records of an array of lines: ``good`` says which lines are records, the others have nulls."""

    def __init__(self, lines: pa.Array, ids: Ids = IDS):
        self.ids = ids
        found = pc.extract_regex(lines, _RECORD)
        text = pc.struct_field(found, "time")
        self.text, self.host, self.sd = text, pc.struct_field(found, "host"), pc.struct_field(found, "sd")
        self.time = _times(pc.replace_substring_regex(text, r"(\.\d{6})\d+", r"\1"))
        self.good = pc.and_(found.is_valid(), pc.fill_null(pc.match_substring_regex(text, TIME), False))
        rest = pc.struct_field(found, "rest")
        self.message = pc.replace_substring_regex(rest, "^ \\x{FEFF}?", "")
        self._elements: dict[str, pa.Array] = {}

    def param(self, name: str, key: str) -> pa.Array:
        """A parameter of an element, with its escapes undone; null where there is none."""
        if name not in self._elements:
            found = pc.extract_regex(self.sd, rf'\[{re.escape(name)}(?P<p>(?: [^ =\]"]+={_QUOTED})*)\]')
            self._elements[name] = pc.struct_field(found, "p")
        raw = pc.struct_field(pc.extract_regex(self._elements[name], rf'^(?: [^ =\]"]+={_QUOTED})*? {re.escape(key)}="(?P<v>(?:[^"\\]|\\(?s:.))*)"'), "v")
        return pc.replace_substring_regex(raw, r'\\(["\\\]])', r"\1")

    def source(self, tail_rule: bool = False) -> pa.Array:
        own, relay = (lambda k: self.param(self.ids.source, k)), (lambda k: self.param(self.ids.relay, k))
        part = lambda k: pc.coalesce(own(k), relay(k), "")
        last = part("source")
        if tail_rule:
            last = pc.if_else(own("hostname").is_null(), pc.coalesce(relay("source"), ""), pc.coalesce(own("source"), ""))
        return pc.binary_join_element_wise(part("source_module"), part("hostname"), last, ":")

    def origin(self) -> pa.Array:
        return pc.coalesce(self.param(self.ids.origin, "hostname"), "")

    def tenant(self, key: str) -> pa.Array:
        return pc.coalesce(self.param(self.ids.tenant, key), "")


def _times(text: pa.Array) -> pa.Array:
    try:
        return text.cast(TIMESTAMP)
    except pa.ArrowInvalid:  # some are no times, or of no day
        return pa.array([_time(x) for x in text.to_pylist()], TIMESTAMP)


def _time(text: str | None) -> datetime | None:
    try:
        return None if text is None else datetime.fromisoformat(text).astimezone(UTC)
    except ValueError:
        return None


def path_time(path: str, zone: str) -> tuple[datetime | None, str | None]:
    """The time in a path, by hour or else by day, and its precision; the rules are those of ``functions.paths``."""
    found, precision = None, None
    for pattern, form, name in ((HOURLY, "%Y%m%d%H", "hourly"), (DAILY, "%Y/%m-%d", "daily")):
        if at := re.search(pattern, path):
            precision = precision or name
            try:
                found = found or datetime.strptime(at[1], form).replace(tzinfo=ZoneInfo(zone)).astimezone(UTC)
            except ValueError:  # digits that are no date
                continue
    return found, precision
