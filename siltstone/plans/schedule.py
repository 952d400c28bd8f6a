"""What goes into a micro-batch and which task reads it: decisions over catalog metadata alone."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.plans.options import Batching

Unit = TypeVar("Unit")
MIB = 1024 * 1024
#: What a unit of the live tail counts as, in bytes.
TAIL_UNIT_BYTES = 16 * MIB


def weight(size: float, b: Batching = Batching()) -> float:
    """Seconds that a compressed object takes."""
    return size * b.ratio / MIB / b.speed


def weight_column(size: Column, b: Batching = Batching()) -> Column:
    return size * F.lit(b.ratio) / F.lit(float(MIB)) / F.lit(b.speed)


def admit(hours: Iterable[tuple[int, int, int]], after: int, b: Batching = Batching(), before: int | None = None) -> int:
    """The last hour of the next batch: hours (start, bytes, objects) are added until the time or the objects are exceeded.

    The hour that exceeds them is the last one. Without any hour after ``after``, ``after`` itself.
    """
    seconds, objects, last = 0.0, 0, after
    for start, size, count in sorted(hours):
        if start <= after or (before is not None and start >= before):
            continue
        seconds, objects, last = seconds + weight(size, b), objects + count, start
        if seconds > b.quantum * b.partitions or objects > b.most_objects:
            break
    return last


def hour_weights(objects: DataFrame) -> DataFrame:
    """(logtime, size, objects) of each hour that has a logtime."""
    return objects.where("logtime is not null").groupBy("logtime").agg(F.sum("file_size").alias("size"), F.count("*").alias("objects"))


def first_batch(hours: DataFrame, b: Batching = Batching()) -> DataFrame:
    """The hours of the first batch, as a plan: those whose hours before them stay within the limits."""
    w = Window.orderBy("logtime").rowsBetween(Window.unboundedPreceding, -1)  # hours, not rows of the archive
    before = hours.withColumn("seconds", F.coalesce(F.sum(weight_column(F.col("size"), b)).over(w), F.lit(0.0))).withColumn("count", F.coalesce(F.sum("objects").over(w), F.lit(0)))
    return before.where((F.col("seconds") <= b.quantum * b.partitions) & (F.col("count") <= b.most_objects)).drop("seconds", "count")


def pack(units: Sequence[tuple[int, Unit]], queues: int, keep_empty: bool = False) -> list[list[Unit]]:
    """Units (bytes, unit) dealt to queues, the largest first and each to the least loaded; empty queues are left out, or kept on request."""
    heap = [(0, k) for k in range(max(1, queues))]
    out: list[list[Unit]] = [[] for _ in heap]
    for size, unit in sorted(units, key=lambda u: -u[0]):
        load, k = heapq.heappop(heap)
        out[k].append(unit)
        heapq.heappush(heap, (load + max(0, size), k))
    return [q for q in out if q or keep_empty]
