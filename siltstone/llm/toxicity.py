"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words, word pairs and pairs with one word between are hashed into 2**20 places. The features of a bounded sample of labelled
rows are made where the rows lie; one task makes the updates, in order. Each place has its own learning rate, and L1 leaves few
weights other than 0, which are broadcast and summed over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch
from siltstone.llm.wordhash import IS_MARK, U64, Words, give_back, mix, slices

BITS = 20


@dataclass(frozen=True)
class Settings:
    """Of the learner. ``max_rows`` bounds the labelled ids it sees (those with the smallest hash), one row each."""

    max_rows: int = 20_000
    epochs: int = 8
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 15.0
    l2: float = 0.1
    #: Toxic rows are rarer than others, and each counts so many times.
    toxic_weight: float = 3.0
    #: Log-odds are capped here while learning, so that no row's gradient vanishes by overflow.
    cap: float = 35.0


def places(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The row and the place of each word, pair and skip-pair of a slice, by row."""
    h, row, n = w.hash, w.row, len(w.hash)
    rows, out = [row], [mix(h)]
    for step, salt in ((1, 0x1F3D5B79), (2, 0x2E4C6A88)):
        if n > step:
            same = np.flatnonzero(row[:-step] == row[step:])
            rows.append(row[same])
            out.append(mix(h[same] * U64(2 * salt + 1) + h[same + step]))
    return np.concatenate(rows), (np.concatenate(out) >> U64(64 - BITS)).astype(np.int64)


class Ftrl:
    def __init__(self, settings: Settings):
        self.s = settings
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.s, self.z[at]
        small = np.abs(z) <= s.l1
        if len(at):  # the bias, in the last place, isn't held back
            small &= at != 1 << BITS
        pull = np.where(at == 1 << BITS, 0.0, s.l1)
        w = -(z - np.sign(z) * pull) / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)
        return np.where(small, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        s = self.s
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -s.cap, s.cap)))
        g = (p - label) * x * (s.toxic_weight if label else 1.0)
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / s.alpha
        self.z[at] += g - rate * w
        self.n[at] += g * g


def _rows(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row its places, once each, and 1 + log of how often each occurs; the bias is last."""
    row, at = places(w)
    order = np.argsort(row, kind="stable")
    at = at[order]
    ends = np.cumsum(np.bincount(row, minlength=w.rows))
    for k in range(w.rows):
        own, count = np.unique(at[ends[k - 1] if k else 0 : ends[k]], return_counts=True)
        yield np.append(own, 1 << BITS), np.append(1 + np.log(count), 1.0)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and counts of each row as bytes: what a row takes is bounded by the number of places, however long its text."""
    for batch in batches:
        for part in slices(batch, "text"):
            rows = list(_rows(Words(part.column("text"), lower=True, breaks=IS_MARK)))
            at = pa.array([x.astype(np.int32).tobytes() for x, _ in rows], pa.binary())
            value = pa.array([x.astype(np.float32).tobytes() for _, x in rows], pa.binary())
            yield pa.RecordBatch.from_pydict({"id": part.column("id"), "label": part.column("label"), "at": at, "value": value})
    give_back()


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The places with a weight, and their weights, after all epochs over rows (places, values, label)."""
    model = Ftrl(settings)
    for _ in range(settings.epochs):
        for at, x, label in rows:
            model.learn(at, x, label)
    at = np.arange((1 << BITS) + 1)
    w = model.weights(at)
    at = at[w != 0]
    return at, w[at]


def _train(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[np.ndarray, np.ndarray, int]] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("at", "value", "label"))
        rows += [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32), label) for at, x, label in zip(*columns, strict=True)]
    at, w = learn(rows, settings)
    del rows
    yield pa.RecordBatch.from_pydict({"place": pa.array(at, pa.int32()), "weight": pa.array(w, pa.float64())})
    give_back()


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """Weights (place, weight) learned from at most ``settings.max_rows`` labelled ids, in one task.

    An id with several labels counts as toxic if one of them says so, and of several texts the first in order is learned from;
    null labels and ids without a text are left out.
    """
    own = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("label"))
    sample = own.orderBy(F.xxhash64("id"), "id").limit(settings.max_rows)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    joined = texts.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    featured = Scratch(docs.sparkSession).save(joined.mapInArrow(_featured, f"id {kind}, label int, at binary, value binary"))
    ordered = featured.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id")
    return ordered.select("at", "value", "label").mapInArrow(partial(_train, settings=settings), "place int, weight double")


def _score(batches: Iterator[pa.RecordBatch], weights, text_column: str, keep: list[str]) -> Iterator[pa.RecordBatch]:
    at, value = weights.value
    dense = np.zeros(1 << BITS)
    dense[at[at < 1 << BITS]] = value[at < 1 << BITS]
    bias = float(value[at == 1 << BITS].sum())
    for batch in batches:
        for part in slices(batch, text_column):
            w = Words(part.column(text_column), lower=True, breaks=IS_MARK)
            row, place = places(w)
            hit = np.flatnonzero(dense[place])
            key, count = np.unique(row[hit] << (BITS + 1) | place[hit], return_counts=True)
            total = np.bincount(key >> (BITS + 1), weights=dense[key & ((1 << BITS) - 1)] * (1 + np.log(count)), minlength=part.num_rows) + bias
            score = 1 / (1 + np.exp(-np.clip(total, -700, 700)))
            yield pa.RecordBatch.from_pydict({c: part.column(c) for c in keep} | {"score": pa.array(score, pa.float64())})
    give_back()


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.7, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> DataFrame:
    """Score each text: (id, held_out, score, predicted), a row for each row of ``docs``.

    Rows whose crc32 of the id's text leaves 1 when divided by 3 are held out of learning. Nulls count as empty
    texts, which get the bias alone; without labelled rows all scores are 0.5; repeated rows get the same score;
    other columns are neither read nor returned; an empty table gives an empty result. The broadcast weights are
    at most 2**20 + 1 numbers, whatever the data. Scoring is one narrow pass over whole texts.
    """
    spark = docs.sparkSession
    remainder = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 3
    learned = train(docs, labels.where(remainder(id_column) != 1), settings, id_column, text_column, label_column).toPandas()
    weights = spark.sparkContext.broadcast((learned["place"].to_numpy(np.int64), learned["weight"].to_numpy(np.float64)))
    kind = docs.schema[id_column].dataType.simpleString()
    run = partial(_score, weights=weights, text_column=text_column, keep=[id_column])
    scored = docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, score double")
    held_out = F.coalesce(remainder(id_column) == 1, F.lit(False))
    return scored.select(id_column, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
