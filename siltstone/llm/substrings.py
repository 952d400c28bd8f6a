"""Removal of repeated passages by difference-cover anchors.

A passage of ``window`` words that occurs at x and y has an offset k below the period with x + k and y + k both
at cover positions modulo the period, as every difference modulo the period occurs within the cover. So two equal
windows share an anchor (a shorter window) at a cover position of each, and only 4 of 13 positions are hashed:

1. Anchors at cover positions meet by hash. Those that occur twice mark the windows that hold them.
2. Only marked windows are hashed whole (96 bits, of two lanes that are independent from the words' bytes on) and meet by hash; all but
   the first occurrence are repeats.
3. The words that repeats cover are cut.

No pairs are made: within a slice of documents equal hashes are settled at once and one of them goes on, so a hash
gets at most one row a slice however often it occurs. Each text is read twice: as it lies for the anchors, and
dealt by id for the other steps, which share that one exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import Scratch, shuffle_count
from siltstone.llm.wordhash import Words, give_back, slices

#: Perfect difference covers: every residue is a difference of two members (fixed values).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
_ROWS = "h bigint, g int, id bigint, start int, stop int"


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of at least a third of the window."""
    period = max(p for p in COVERS if window - p + 1 >= max(1, window // 3))
    return period, COVERS[period]


def _rows(h: np.ndarray, g: np.ndarray, ids: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array((g >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(ids, pa.int64()), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], ["h", "g", "id", "start", "stop"])


def _runs(row: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges joined where they touch, within each row; ordered by row and first."""
    if not len(row):
        return row, first, last
    wide = int(last.max()) + 2
    a, b = row * wide + first, row * wide + last
    top = np.maximum.accumulate(b)
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] > top[:-1] + 1) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], first[at], np.append(top[at[1:] - 1], top[-1]) - row[at] * wide


def _with_local(h: np.ndarray, g: np.ndarray, w: Words, ids: np.ndarray, starts: np.ndarray, later_only: bool, back: int) -> pa.RecordBatch:
    """A row for each different hash of a slice (stop -1), and the ranges of starts that the slice settles itself.

    Of equal hashes the first by id and start goes on. Settled are the others (``later_only``), or all of them.
    A settled start s stands for the range s - back to s.
    """
    row = w.row[starts]
    own, at = ids[row], starts - w.first[row]
    order = np.lexsort((at, own, g, h)) if later_only else np.argsort(h, kind="stable")
    hs, gs = h[order], g[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (hs[1:] == hs[:-1]) & (gs[1:] == gs[:-1])
    ask = np.sort(order[~same])  # as they lie: neighbours compress well
    if later_only:  # a start that equals the first one's id and start is no later
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        settled = order[same & ((own[order] != own[order[first]]) | (at[order] != at[order[first]]))]
    else:
        group = same.copy()
        group[:-1] |= same[1:]
        settled = order[group]
    settled = np.sort(settled)
    r, a, b = _runs(row[settled], np.maximum(0, at[settled] - back), at[settled])
    none = np.full(len(ask), -1)
    spread = (ids[r].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + a.astype(np.uint64)
    return _rows(np.concatenate([h[ask], spread]), np.concatenate([g[ask], spread]), np.concatenate([own[ask], ids[r]]), np.concatenate([at[ask], a]), np.concatenate([none, b]))


def _known_ids(part: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    part = part.filter(part.column("id").is_valid())
    return part, part.column("id").to_numpy(zero_copy_only=False).astype(np.int64)


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    period, cover = cover_for(window)
    size = window - period + 1
    chosen = np.isin(np.arange(period), cover)
    for batch in batches:
        for part in slices(batch, "text"):
            part, ids = _known_ids(part)
            w = Words(part.column("text"))
            starts, h = w.windows(size)
            row = w.row[starts]
            keep = chosen[(starts - w.first[row]) % period] & (w.count[row] >= window)
            yield _with_local(h[keep], np.zeros(keep.sum(), np.uint64), w, ids, starts[keep], False, period - 1)
    give_back()


def _marked(part: pa.RecordBatch, w: Words, window: int) -> np.ndarray:
    """The starts of windows that lie in a slice's ranges."""
    ranges = part.column("ranges")
    counts = np.diff(ranges.offsets.to_numpy())
    row = np.repeat(np.arange(len(counts)), counts)
    packed = ranges.flatten().to_numpy(zero_copy_only=False)
    first = w.first[row] + (packed >> 32)
    last = np.minimum(w.first[row] + (packed & 0xFFFFFFFF), w.first[row + 1] - window)
    fine = last >= first
    change = np.zeros(len(w.hash) + 1, dtype=np.int32)
    np.add.at(change, first[fine], 1)
    np.add.at(change, last[fine] + 1, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            part, ids = _known_ids(part.filter(part.column("ranges").is_valid()))
            w = Words(part.column("text"), lanes=2)
            starts = _marked(part, w, window)
            yield _with_local(w.window_hashes(starts, window), w.window_hashes(starts, window, 1), w, ids, starts, True, 0)
    give_back()


def _meet(batches: Iterator[pa.RecordBatch], later_only: bool, back: int) -> Iterator[pa.RecordBatch]:
    """Ranges of starts by id: those settled before, and those of hashes that two rows or more have.

    Rows come sorted by hash (and then by id and start if ``later_only``). One row is carried from batch to batch, so that neither a
    partition nor a hash that very many slices have is ever held.
    """
    carry: tuple[np.ndarray, ...] | None = None  # of the last hash: its first row (``later_only``), or its last
    told = False  # whether that row went out already
    for batch in batches:
        h, g, ids, start, stop = (batch.column(c).to_numpy() for c in ("h", "g", "id", "start", "stop"))
        settled = np.flatnonzero(stop >= 0)
        asks = np.flatnonzero(stop < 0)
        out_ids, first, last = [ids[settled]], [start[settled]], [stop[settled]]
        if len(asks):
            rows = tuple(x[asks] for x in (h, g, ids, start))
            if carry is not None:
                rows = tuple(np.concatenate([c, x]) for c, x in zip(carry, rows, strict=True))
            ah, ag, aid, at = rows
            same = np.zeros(len(ah), dtype=bool)
            same[1:] = (ah[1:] == ah[:-1]) & (ag[1:] == ag[:-1])
            if later_only:
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(ah))))
                found = np.flatnonzero(same & ((aid != aid[lead]) | (at != at[lead])))
                carry = tuple(x[lead[-1:]] for x in rows)
            else:
                group = same.copy()
                group[:-1] |= same[1:]
                if carry is not None and told:
                    group[0] = False
                found = np.flatnonzero(group)
                told = bool(group[-1]) or (len(group) == 1 and told)
                carry = tuple(x[-1:] for x in rows)
            out_ids.append(aid[found])
            first.append(np.maximum(0, at[found] - back))
            last.append(at[found])
        packed = np.concatenate(first).astype(np.int64) << 32 | np.concatenate(last).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"id": pa.array(np.concatenate(out_ids), pa.int64()), "range": pa.array(packed, pa.int64())})
    give_back()


def _cut(batches: Iterator[pa.RecordBatch], window: int, digest: bool, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            w = Words(part.column("text"))
            kept = np.ones(len(w.hash), dtype=bool)
            hit = part.column("ranges").is_valid().to_numpy(zero_copy_only=False)
            covered = np.zeros(part.num_rows, dtype=bool)
            if hit.any():
                empty = part.set_column(part.schema.get_field_index("ranges"), "ranges", part.column("ranges").fill_null([]))
                starts = _marked(empty, w, window)
                change = np.zeros(len(w.hash) + 1, dtype=np.int32)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + window, -1)
                kept = np.cumsum(change[:-1]) == 0
                covered[w.row[starts]] = True
            total = np.concatenate([[0], np.cumsum(kept)])
            n_kept = total[w.first[1:]] - total[w.first[:-1]]
            if digest:
                data = w.data.tobytes()
                sums = []
                for r in range(part.num_rows):
                    a, b = w.first[r], w.first[r + 1]
                    if not covered[r]:
                        words = data[w.start[a] : w.end[b - 1]].split() if b > a else []
                    else:
                        words = [data[s:e] for s, e, k in zip(w.start[a:b].tolist(), w.end[a:b].tolist(), kept[a:b].tolist(), strict=True) if k]
                    sums.append(hashlib.sha256(b" ".join(words)).hexdigest())
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "n_words": pa.array(w.count, pa.int64()), "n_removed": pa.array(w.count - n_kept, pa.int64()), "kept_sha256": pa.array(sums, pa.string())})
            else:
                texts = part.column("text").to_pylist()
                for r in np.flatnonzero(covered):
                    a, b = w.first[r], w.first[r + 1]
                    pieces, k = [], a
                    while k < b:  # runs of kept words, with the space that follows them
                        if not kept[k]:
                            k += 1
                            continue
                        stop = k
                        while stop < b and kept[stop]:
                            stop += 1
                        pieces.append(w.data[w.start[k] : w.start[stop] if stop < b else w.end[b - 1]].tobytes().decode("utf-8", "replace"))
                        k = stop
                    texts[r] = "".join(pieces)
                yield pa.RecordBatch.from_pydict({c: (pa.array(texts, pa.string()) if c == "text" else part.column(c)) for c in names})
    give_back()


def _by_id(ranges: DataFrame) -> DataFrame:
    """All ranges of a document in one array, which its own length bounds."""
    return ranges.groupBy("id").agg(F.collect_list("range").alias("ranges"))


def substring_dedup(docs: DataFrame, window: int = 20, id_column: str = "doc_id", text_column: str = "text", digest: bool = False) -> DataFrame:
    """Cut each word that a window of ``window`` words covers whose words also occur earlier (a smaller id, or further up).

    Returns ``docs`` with the text cut (white space between kept words stays; a text of repeats alone becomes empty), or
    with ``digest`` (id, n_words, n_removed, kept_sha256). Nulls count as empty texts in the digest and stay null
    otherwise; rows without an id are left as they are and count nowhere; rows that share an id count as one document
    whose rows all begin at word 0, so a repeated row isn't a repeat of itself; other columns pass through, whatever their
    names; an empty table gives an empty result. Ids are integers. Windows are judged on the input, not on what is left. Very long
    texts are taken whole, one at a time.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    n = shuffle_count(spark, docs, target=16 << 20)
    others = [c for c in docs.columns if c not in (id_column, text_column)] if not digest else []
    other_names = [f"c{k}" for k in range(len(others))]
    named: list[Column] = [F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text")]
    plain = docs.select(*named)
    period, _ = cover_for(window)
    shared = plain.mapInArrow(partial(_anchors, window=window), _ROWS).repartition(n, "h").sortWithinPartitions("h", "g").mapInArrow(partial(_meet, later_only=False, back=period - 1), "id bigint, range bigint")
    shared = scratch.save(shared)
    # both uses of the dealt texts take all their columns and no filter, so that one exchange serves both
    dealt = docs.select(*named, *[F.col(f"`{c}`").alias(x) for c, x in zip(others, other_names, strict=True)]).repartition(n, "id")
    asked = dealt.join(_by_id(shared).hint("shuffle_hash"), "id", "left").mapInArrow(partial(_windows, window=window), _ROWS)
    repeats = asked.repartition(n, "h").sortWithinPartitions("h", "g", "id", "start").mapInArrow(partial(_meet, later_only=True, back=0), "id bigint, range bigint")
    whole = dealt.join(_by_id(repeats).hint("shuffle_hash"), "id", "left")
    if digest:
        out = whole.select("id", "text", "ranges").mapInArrow(partial(_cut, window=window, digest=True, names=[]), "id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
        return out.withColumnRenamed("id", id_column)
    names = ["id", "text", *other_names]
    schema = ", ".join(f"{x} {whole.schema[x].dataType.simpleString()}" for x in names)
    out = whole.select(*names, "ranges").mapInArrow(partial(_cut, window=window, digest=False, names=names), schema)
    back = dict(zip(others, other_names, strict=True)) | {id_column: "id", text_column: "text"}
    return out.select(*[F.col(back[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
