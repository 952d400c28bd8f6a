"""The live tail straight from a broker, by Spark's own ``format("kafka")`` (its package must be on the class path)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions import syslog
from siltstone.plans.conditions import NAMES, on_rows, topic_regex
from siltstone.plans.query import Node


def broker_options(node: Node, servers: str, more: Mapping[str, str] | None = None, include_from: int | None = None, limit: int | None = None) -> dict[str, str]:
    """What the broker's reader is given: the topics that the query may need, and where to begin.

    Topics that the user isn't allowed to see don't match a pattern subscription, so that a query has the rest. ``more`` goes on
    to the client as it is, with the prefix ``kafka.`` (security protocol, mechanism, poll sizes).
    """
    out = {"kafka.bootstrap.servers": servers, "subscribePattern": topic_regex(node), "failOnDataLoss": "true"}
    out |= {"startingTimestamp": str(include_from * 1000), "startingOffsetsByTimestampStrategy": "latest"} if include_from is not None else {"startingOffsets": "earliest"}
    if limit is not None:
        out["maxOffsetsPerTrigger"] = str(limit)
    return out | {f"kafka.{k}": v for k, v in (more or {}).items()}


def events(records: DataFrame, node: Node, skip_bad: bool = False, include_from: int | None = None, ids: syslog.Ids = syslog.IDS) -> DataFrame:
    """The nine columns of a broker's records (topic, partition, offset, value), by the rules of the live tail."""
    value = F.col("value").cast("string")
    good = syslog.is_record(value)
    text = value if skip_bad else F.when(good, value).otherwise(F.raise_error(F.concat(F.lit("not a record at "), "topic", F.lit("-"), F.col("partition").cast("string"), F.lit(":"), F.col("offset").cast("string"))).cast("string"))
    chosen = records.where(good) if skip_bad else records
    none = F.lit("")
    out = syslog.decoded(chosen.select(text.alias("line"), "partition", "offset"), F.col("line"), none, none, none, F.col("partition"), F.col("offset"), tail=True, ids=ids)
    seconds = F.unix_micros("_time") / 1_000_000
    out = out.where(on_rows(node, {n: F.col(n) for n in NAMES}, seconds, F.col("_raw")))
    return out if include_from is None else out.where(seconds >= include_from)


def stream(spark: SparkSession, node: Node, servers: str, more: Mapping[str, str] | None = None, include_from: int | None = None, limit: int | None = None, skip_bad: bool = False) -> DataFrame:
    source = spark.readStream.format("kafka").options(**broker_options(node, servers, more, include_from, limit)).load()
    return events(source, node, skip_bad, include_from)
