"""RFC 5424 records decoded by column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_QUOTED = r'"(?:[^"\\]++|\\.)*+"'
_SD = rf'(?:-|(?:\[(?:[^\]"\\\x{{FFFF}}]++|\\.|{_QUOTED})*+\])++)'
#: Priority, version, time, host, application, process, message id, structured data, message.
RECORD = rf"(?s)^<([0-9]{{1,3}})>([0-9]{{1,2}}) ([^\s\x{{FFFF}}]+) ([^\s\x{{FFFF}}]+) (\S+) (\S+) (\S+) ({_SD})(?: \x{{FEFF}}?(.*))?$"
TIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"
#: A character that no text has; it parts what one match of a record gives.
BORDER = "￿"


@dataclass(frozen=True)
class Ids:
    """Ids of the structured data elements that say where a record comes from. Archives name their own (the source's options ``sd.*``); the
    number of the defaults is the one that is set aside for examples."""

    source: str = "event_node_source@32473"
    relay: str = "event_node_relay@32473"
    origin: str = "origin@32473"
    tenant: str = "tenant@32473"


IDS = Ids()


def is_record(value: Column) -> Column:
    return value.rlike(RECORD)


def field(value: Column, k: int) -> Column:
    """A part of a record by its place in RECORD; empty for no record."""
    return F.regexp_extract(value, RECORD, k)


def _time_of(text: Column) -> Column:
    cut = F.when(F.length(text) > 26, F.regexp_replace(text, r"(\.\d{6})\d+", "$1")).otherwise(text)
    return F.when(text.rlike(TIME), F.try_to_timestamp(cut))


def event_time(value: Column) -> Column:
    """The record's time with microseconds (more digits are cut off); null for none."""
    return _time_of(field(value, 3))


def epoch_micros(time: Column) -> Column:
    return F.unix_micros(time)


def structured_data(value: Column) -> Column:
    return field(value, 8)


def message(value: Column) -> Column:
    return field(value, 9)


def _odd_quotes(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1


def element(sd: Column, name: str) -> Column:
    """The parameters of the first element of some id, as they are written; null if there is none.

    Where nothing is escaped the element is cut out at its brackets, unless one of them stands within quotes; else a pattern finds it.
    """
    pattern = rf'\[\Q{name}\E((?: [^ =\]"]+={_QUOTED})*+)\]'
    closed, opens = F.concat(F.lit("]"), sd), f"][{name} "
    at = F.instr(closed, opens)
    inner = F.substring_index(F.substring(closed, at + F.lit(len(opens) - 1), F.length(closed)), "]", 1)
    odd = F.contains(sd, F.lit("\\")) | (at == 0) | _odd_quotes(inner) | _odd_quotes(F.substring(closed, F.lit(1), at))
    return F.when(~F.contains(sd, F.lit(f"[{name}")), F.lit(None)).when(~odd, inner).when(sd.rlike(pattern), F.regexp_extract(sd, pattern, 1))


def param(params: Column, name: str, pieces: Column | None = None) -> Column:
    """One of an element's parameters, with its escapes undone; null if there is none.

    Where nothing is escaped it is the piece between quotes that follows the name (``pieces``: the parameters cut at quotes); else the
    parameters before it are matched whole, so that a value can't pass for a name.
    """
    pattern = rf'^(?: [^ =\]"]+={_QUOTED})*? \Q{name}\E="((?:[^"\\]++|\\.)*+)"'
    matched = F.when(params.rlike(pattern), F.regexp_replace(F.regexp_extract(params, pattern, 1), r'\\(["\\\]])', "$1"))
    pieces = F.split(params, '"') if pieces is None else pieces
    at = F.array_position(pieces, f" {name}=").cast("int")
    return F.when(F.contains(params, F.lit("\\")), matched).when(at % 2 == 1, F.get(pieces, at)).when(at > 0, matched)


def sd_get(sd: Column, name: str, key: str) -> Column:
    """A parameter of a structured data element; null if there is none."""
    return param(element(sd, name), key)


def origin(sd: Column, ids: Ids = IDS) -> Column:
    return F.coalesce(sd_get(sd, ids.origin, "hostname"), F.lit(""))


def source(sd: Column, tail_rule: bool = False, ids: Ids = IDS) -> Column:
    """``module:host:source`` of the sending node, each from the source element or else the relay's; ``::`` for none.

    With ``tail_rule`` the third part falls back only where the source element has no host name, as the live tail had it.
    """
    own, relay = element(sd, ids.source), element(sd, ids.relay)
    return _source(lambda p: param(own, p), lambda p: param(relay, p), tail_rule)


def _source(own: Callable[[str], Column], relay: Callable[[str], Column], tail_rule: bool) -> Column:
    part = lambda p: F.coalesce(own(p), relay(p), F.lit(""))
    last = part("source")
    if tail_rule:
        last = F.when(own("hostname").isNull(), F.coalesce(relay("source"), F.lit(""))).otherwise(F.coalesce(own("source"), F.lit("")))
    return F.concat_ws(":", part("source_module"), part("hostname"), last)


def decoded(events: DataFrame, value: Column, index: Column, sourcetype: Column, host: Column, partition: Column, offset: Column, keep: tuple[str, ...] = (), tail: bool = False, ids: Ids = IDS) -> DataFrame:
    """The columns ``keep`` of ``events`` and the nine columns of the event relation, for records of archive objects or of the live tail.

    A record is matched once and an element of its structured data found once: each step is a projection of its own, which the
    optimizer leaves apart as the next one names its columns several times. What is no record has no time and an empty message.
    """
    names = {"index": index, "sourcetype": sourcetype, "host": host, "partition": partition, "offset": offset}
    # time, host, message and structured data, of which only the message may have the border in it
    parts = F.split(F.regexp_replace(value, RECORD, f"$3{BORDER}$4{BORDER}$8{BORDER}$9"), BORDER, 4)
    out = events.select(*keep, F.struct(*[c.alias(k) for k, c in names.items()]).alias("_of"), parts.alias("_parts"))
    at = lambda k: F.when(F.size("_parts") == 4, F.get("_parts", F.lit(k))).otherwise(F.lit(""))
    out = out.select(*keep, "_of", at(0).alias("_text"), at(1).alias("_host"), at(2).alias("_sd"), at(3).alias("_raw"))
    wanted = {"_source": ids.source, "_relay": ids.relay, "_origin": ids.origin} | ({"_tenant": ids.tenant} if tail else {})
    bare = F.length("_sd") < 3  # nothing, or "-"
    out = out.select(*keep, "_of", "_text", "_host", "_raw", *[F.when(~bare, element(F.col("_sd"), name)).alias(c) for c, name in wanted.items()])
    out = out.select(*keep, "_of", "_text", "_host", "_raw", *wanted, *[F.split(c, '"').alias(f"{c}_pieces") for c in wanted])
    of = lambda c: lambda p: param(F.col(c), p, F.col(f"{c}_pieces"))
    if tail:
        of_tenant = lambda p: F.coalesce(of("_tenant")(p), F.lit(""))
        index, sourcetype, host = of_tenant("directory"), of_tenant("streamname"), F.col("_host")
    else:
        index, sourcetype, host = F.lower("_of.index"), F.lower("_of.sourcetype"), F.lower("_of.host")
    return out.select(
        *keep, _time_of(F.col("_text")).alias("_time"), "_raw", index.alias("index"), sourcetype.alias("sourcetype"), host.alias("host"), _source(of("_source"), of("_relay"), tail).alias("source"),
        F.col("_of.partition").cast("string").alias("partition"), F.col("_of.offset").cast("long").alias("offset"), F.coalesce(of("_origin")("hostname"), F.lit("")).alias("origin"),
    )
