"""Similarity join of documents by the Jaccard similarity of their shingles, over count-vector R-trees.

1. Texts become sets of 5-word shingles; equal sets are folded into one.
2. A first round links what is easily linked, with rows in proportion to the documents: sets that share two of four least hashes
   with the smallest id that has them are verified against it. It may miss links; the components it gives are labels.
3. The exact round has only pairs of different labels left. Two sets of similarity 0.75 share a shingle among the first quarter of
   each in any fixed order (the first seventh of the smaller one). The order puts shingles that many documents have last, so that a
   passage in many documents makes no large block. Sets that share such a shingle are a block, named after its smallest id and a
   class of sizes; blocks of a single label are dropped.
4. Within a block, an R-tree over vectors of shingle counts by hash group drops sets without a partner: the overlap of two
   sets is at most the sum of the smaller counts of each group. No set is shipped for that, only its vector.
5. The sets that are left are shipped to their blocks, and pairs that the tree lets pass are verified exactly, unless the
   two are connected already. Links that connect come out, not all pairs.
6. Links become components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import BROADCAST_ROWS, Scratch, shuffle_count, small
from siltstone.llm.components import components
from siltstone.llm.rtree import CountTree, folded, groups_for, need
from siltstone.llm.wordhash import U64, Words, give_back, mix, slices

PERCENT = 75
#: A shingle counts as frequent if slices that have it in so many documents have it in twice as many together.
FREQUENT = 2
#: Frequent shingles (those of the highest levels, by the logarithm of their number) that are told to all tasks; the others are
#: ordered as the rest. It bounds the broadcast to 9 MB, not the result.
MOST_FREQUENT = 1_000_000
#: Members, and shingles of all members, of a block that one task holds at once; larger blocks are split into tiles.
TILE, TILE_SHINGLES = 1024, 1 << 22
#: Bytes that a task gathers before it works on whole blocks.
HELD_BYTES = 16 << 20
#: Bytes of copies of sets that go out at once.
SHIPPED_BYTES = 4 << 20
#: Salts of the least hashes of the first round, and how many of them must agree.
SALTS, AGREE = (0x2545F491, 0x4F6CDD1D, 0x5851F42D, 0x7FB5D329), 2
#: Keys of this level (in 2**16 documents) or a higher one are never dealt out as they are.
HOT_LEVEL = 16
#: Sets of fewer shingles are similar to equal ones only.
LEAST = 3


def shingles(w: Words, size: int = 5, other: bool = False) -> tuple[np.ndarray, ...]:
    """Row and hash (``other``: and that of the second lane) of each distinct shingle, by hash; rows of fewer words have their whole sequence as one."""
    rows, at = [], []
    starts = np.flatnonzero(w.row[: max(0, len(w.row) - size + 1)] == w.row[size - 1 :]) if len(w.row) >= size else np.zeros(0, np.int64)
    lanes: list[list[np.ndarray]] = [[w.window_hashes(starts, size, k)] for k in range(1 + other)]
    rows.append(w.row[starts])
    for n in range(1, size):
        short = np.flatnonzero(w.count == n)
        if len(short):
            rows.append(short)
            for k, lane in enumerate(lanes):
                lane.append(w.window_hashes(w.first[short], n, k))
    row, h = np.concatenate(rows), np.concatenate(lanes[0])
    at = np.argsort(row, kind="stable") if len(rows) > 1 else np.arange(len(row))
    at = at[np.argsort(h[at], kind="stable")]  # rows ascend among equal hashes
    row, h = row[at], h[at]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return (row[new], h[new], np.concatenate(lanes[1])[at][new]) if other else (row[new], h[new])


def by_row(row: np.ndarray, rows: int) -> np.ndarray:
    """An order by row that keeps the order within rows."""
    return np.argsort(row.astype(np.uint16) if rows <= 1 << 16 else row, kind="stable")


def _frequent(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, h = shingles(Words(part.column("text"), lower=True), size)
            at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            n = np.diff(np.append(at, len(h)))
            often = n >= FREQUENT
            yield pa.RecordBatch.from_pydict({"h": pa.array(h[at[often]].view(np.int64)), "n": pa.array(n[often].astype(np.int64))})
    give_back()


def _signed(batches: Iterator[pa.RecordBatch], size: int, frequent) -> Iterator[pa.RecordBatch]:
    """For each document its number of shingles, two sums that stand for its set, its least hashes, count vector and first quarter."""
    often, level = frequent.value
    for batch in batches:
        for part in slices(batch, "text"):
            part = part.filter(part.column("id").is_valid())
            w = Words(part.column("text"), lower=True, lanes=2)
            row, h, other = shingles(w, size, other=True)
            key = h >> U64(6)
            if len(often) and len(h):
                at = np.minimum(np.searchsorted(often, h), len(often) - 1)
                key |= np.where(often[at] == h, level[at], 0).astype(U64) << U64(58)
            order = np.argsort(key, kind="stable")
            order = order[by_row(row[order], w.rows)]
            row, h, key, other = row[order], h[order], key[order], other[order]
            n = np.bincount(row, minlength=w.rows)
            first = np.concatenate([[0], np.cumsum(n)])
            sums = []
            for lane, salt in ((h, 0x3C6EF372), (other, 0x1BD11BDA)):
                total = np.concatenate([[U64(0)], np.cumsum(mix(lane + U64(salt)))])
                sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            some = np.flatnonzero(n)
            least = np.zeros((len(SALTS), w.rows), dtype=np.int64)
            for k, salt in enumerate(SALTS if len(some) else ()):
                least[k, some] = np.minimum.reduceat(mix(h ^ U64(salt)), first[some]).view(np.int64)
            groups = groups_for(n)
            at = np.concatenate([[0], np.cumsum(groups)])
            vector = np.bincount(at[row] + (h & (groups[row] - 1).astype(U64)).astype(np.int64), minlength=at[-1])
            vector = np.minimum(vector, 65535).astype(np.uint16)  # of a set of over 2**32 shingles alone
            prefix = np.where(n >= LEAST, n - (n * PERCENT + 99) // 100 + 1, 0)
            chosen = np.arange(len(row)) - first[row] < prefix[row]
            starts = np.concatenate([[0], np.cumsum(prefix)]) * 8
            yield pa.RecordBatch.from_pydict(
                {
                    "id": part.column("id"), "n": pa.array(n, pa.int64()), "s1": pa.array(sums[0]), "s2": pa.array(sums[1]), **{f"m{k}": pa.array(x) for k, x in enumerate(least)},
                    "vector": _blobs(vector.tobytes(), at * 2), "prefix": _blobs(key[chosen].tobytes(), starts),
                }
            )
    give_back()


def _blobs(data: bytes, starts: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32).tobytes()), pa.py_buffer(data)])


def _spans(blobs: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in an array of blobs, and where each blob begins among them."""
    _, offsets, data = blobs.buffers()
    wide = pa.types.is_large_binary(blobs.type)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[blobs.offset : blobs.offset + len(blobs) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return body.view(kind), (at - at[0]) // size


def _classes(largest: int) -> np.ndarray:
    """Lower edges of the size classes: similar sets are in the same or in neighbouring classes."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(edges[-1] * 100 // PERCENT + 1)
    return np.array(edges)


EDGES = _classes(1 << 40)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of the first quarters; ``room`` shingles of the document stand there or behind it in the order."""
    for batch in batches:
        key, first = _spans(batch.column("prefix"), U64)
        count = np.diff(first)
        own = np.searchsorted(EDGES, batch.column("n").to_numpy(), side="right").astype(np.int32)
        ids, n, label = (np.repeat(batch.column(c).to_numpy(), count) for c in ("id", "n", "label"))
        room = n - (np.arange(len(key)) - np.repeat(first[:-1], count))
        columns = {"key": key.view(np.int64), "id": ids, "n": n.astype(np.int32), "room": room.astype(np.int32), "label": label, "own": np.repeat(own, count)}
        for k in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_pydict({c: pa.array(x[k : k + (1 << 16)]) for c, x in columns.items()})


def _need(a: Column, b: Column) -> Column:
    """As ``rtree.need``; the division of whole numbers below 2**53 is exact where its result is whole."""
    return F.floor(((a.cast("bigint") + b.cast("bigint")) * PERCENT + (100 + PERCENT - 1)) / (100 + PERCENT))


def _small_role() -> Column:
    """Whether a document may be the smaller one of a pair that meets at this shingle."""
    return F.col("room") >= _need(F.col("n"), F.col("n"))


def _figures() -> list[Column]:
    return [F.count("*").alias("members"), F.min("label").alias("low_label"), F.max("label").alias("high_label"), F.min(F.when(_small_role(), F.col("n"))).alias("low"), F.max("n").alias("high")]


_MIXED = "members > 1 and low_label < high_label and low <= high"


def _meeting(tokens: DataFrame, top_level: int, n_parts: int, scratch: Scratch) -> DataFrame:
    """Tokens whose key sets of several labels have.

    Tokens are dealt out by key once, for both the figures of the keys and the join with them. Keys that the order knows to be in very many
    documents go another way: their figures are summed up where the tokens lie, and the tokens of those that are mixed are joined as they lie.
    """
    level = F.shiftrightunsigned("key", 58)
    # the figures name every column and the join isn't a semi-join, which would be pushed below, so that one exchange serves both sides
    all_of_them = [F.min("id").alias("some_id"), F.max("own").alias("some_own")]
    dealt = (tokens if top_level < HOT_LEVEL else tokens.where(level < HOT_LEVEL)).repartition(n_parts, "key")
    keys = dealt.groupBy("key").agg(*_figures(), *all_of_them).where(F.expr(_MIXED) & F.col("some_id").isNotNull() & F.col("some_own").isNotNull()).select("key")
    met = dealt.join(keys.hint("shuffle_hash"), "key")
    if top_level >= HOT_LEVEL:
        hot = tokens.where(level >= HOT_LEVEL)
        hot_keys = scratch.save(hot.groupBy("key").agg(*_figures()).where(_MIXED).select("key"))
        met = met.unionAll(hot.join(small(hot_keys), "key", "left_semi"))
    return met


def _blocks(met: DataFrame, top_level: int, n_parts: int, scratch: Scratch) -> DataFrame:
    """(leader, cls, id, label): sets that share a key with one of another label and about their size.

    A pair needs be met only at its first common key, where what stands behind it in both orders must still make up the overlap; so a
    key counts for the smaller of two sets only within its first seventh. As in ``_meeting``, figures and join are dealt out by the same keys
    at any size, and the keys of very many documents go another way.
    """
    # the next class is joined by those that may be the smaller one
    classes = F.when(_small_role(), F.array(F.col("own"), F.col("own") + 1)).otherwise(F.array("own"))
    met = met.select("key", F.explode(classes).alias("cls"), "id", "n", "room", "label", "own")
    met = scratch.save(met.select("key", "cls", "id", "n", "room", "label", (F.col("own") == F.col("cls")).alias("mine")))
    of = ["key", "cls"]
    figures = [*_figures(), F.min("id").alias("leader"), F.max("mine").alias("any_mine"), F.min("n").alias("least"), F.min("room").alias("low_room")]
    wide = lambda c: F.col(c).cast("bigint")
    two = (F.col("members") > 2) | ((100 * wide("least") >= PERCENT * wide("high")) & (F.col("low_room") >= _need(F.col("least"), F.col("high"))))
    chosen = F.expr(_MIXED) & F.col("any_mine") & two
    level = F.shiftrightunsigned("key", 58)
    dealt = (met if top_level < HOT_LEVEL else met.where(level < HOT_LEVEL)).repartition(n_parts, *of)
    groups = dealt.groupBy(*of).agg(*figures).where(chosen).select(*of, "leader")
    out = dealt.join(groups.hint("shuffle_hash"), of).select("leader", "cls", "id", "label")
    if top_level >= HOT_LEVEL:
        hot = met.where(level >= HOT_LEVEL)
        hot_groups = scratch.save(hot.groupBy(*of).agg(*figures).where(chosen).select(*of, "leader"))
        out = out.unionAll(hot.join(small(hot_groups), of).select("leader", "cls", "id", "label"))
    out = scratch.save(out.distinct())
    scratch.drop(met)
    return out


def _tiled(blocks: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """(leader, cls, tile, id, label, n, vector). A block that is small is tile 0.

    Of a larger one, those of its most frequent label needn't meet one another: they are cut into shares, and so are the rest, and a
    tile is a share of the rest with a share of either. So a large group of which all but a few are linked has rows in proportion to its size.
    """
    whole = sizes.join(small(blocks), "id")
    of = ["leader", "cls"]
    labels = whole.groupBy(*of, "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    block = labels.groupBy(*of).agg(F.sum("c").alias("members"), F.sum("s").alias("total"), F.max(F.struct("c", "label")).alias("top"))
    large = block.where((F.col("members") > TILE) | (F.col("total") > TILE_SHINGLES))
    share = F.greatest(F.lit(1.0), F.least(F.lit(TILE / 2), F.col("members") * (TILE_SHINGLES / 2) / F.col("total")))
    large = large.select(*of, F.col("top.label").alias("top"), F.ceil(F.col("top.c") / share).alias("tops"), F.ceil((F.col("members") - F.col("top.c")) / share).alias("rests"))
    large = scratch.save(large)
    tops, rests, width = F.col("tops"), F.col("rests"), F.col("tops") + F.col("rests")
    own = lambda n: F.pmod(F.xxhash64("id"), n)
    to = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    as_top = F.transform(to(rests), lambda i: i * width + rests + own(tops))
    with_rest = F.transform(to(rests), lambda j: F.least(j, own(rests)) * width + F.greatest(j, own(rests)))
    with_top = F.transform(to(tops), lambda j: own(rests) * width + rests + j)
    tiles = F.when(F.col("top").isNull(), F.array(F.lit(0).cast("bigint"))).when(F.col("label") == F.col("top"), as_top).otherwise(F.concat(with_rest, with_top))
    return whole.join(small(large), of, "left").select(*of, F.explode(tiles).alias("tile"), "id", "label", "n", "vector")


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = HELD_BYTES) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys`` in tables of whole groups, with where each group begins, and the end; a table has about ``most`` bytes, or one group."""
    held: list[pa.RecordBatch] = []
    size = 0

    def edges(rows: pa.Table) -> np.ndarray:
        columns = [rows[c].to_numpy() for c in keys]
        new = np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
        return np.append(np.flatnonzero(new), rows.num_rows)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            rows = pa.Table.from_batches(held)
            at = edges(rows)
            if len(at) > 2:
                yield rows.slice(0, at[-2]), at[:-1]
            held = rows.slice(at[-2]).to_batches()
            size = min(sum(b.nbytes for b in held), most // 2)
    if held:
        rows = pa.Table.from_batches(held)
        yield rows, edges(rows)


def _pieces(blobs: pa.ChunkedArray, kind) -> list[np.ndarray]:
    spans = [_spans(c, kind) for c in blobs.chunks]
    return [s[f[k] : f[k + 1]] for s, f in spans for k in range(len(f) - 1)]


BLOCK = ["leader", "cls", "tile"]


def _with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of blocks that may be similar to one of another label, by their vectors alone."""
    for rows, at in _whole_groups(batches, BLOCK):
        vectors, sizes, labels = _pieces(rows["vector"], np.uint16), rows["n"].to_numpy(), rows["label"].to_numpy()
        keep = np.zeros(len(sizes), dtype=bool)
        for k in np.flatnonzero(np.diff(at) > 1):
            a, b = at[k], at[k + 1]
            if (labels[a:b] == labels[a]).all():
                continue
            counts = folded(vectors[a:b])
            tree = CountTree(counts, sizes[a:b], PERCENT)
            rest = labels[a:b] != _most_common(labels[a:b])  # each pair has one that isn't of the most common label
            passed = []
            for i in (a + np.flatnonzero(rest)).tolist():
                if keep[i]:
                    passed.append(i)
                else:
                    _keep_partners(i, a, counts, tree, sizes, labels, keep)
            # of pairs with one passed over, only the other may still be missing, and only if it is of the most common label
            missing = (a + np.flatnonzero(~rest & ~keep[a:b])).tolist()
            for i in min(passed, missing, key=len):
                _keep_partners(i, a, counts, tree, sizes, labels, keep)
        yield from rows.select([*BLOCK, "id", "label"]).filter(pa.array(keep)).combine_chunks().to_batches()
    give_back()


def _keep_partners(i: int, a: int, counts: np.ndarray, tree: CountTree, sizes: np.ndarray, labels: np.ndarray, keep: np.ndarray) -> None:
    """Mark row ``i``, of a block that begins at row ``a``, and the rows of other labels that may be similar to it, if there are any."""
    found = a + tree.order[tree.partners(counts[i - a], sizes[i])]
    found = found[labels[found] != labels[i]]
    if len(found):
        keep[i] = True
        keep[found] = True


def _most_common(labels: np.ndarray) -> int:
    values, count = np.unique(labels, return_counts=True)
    return values[count.argmax()]


def _sets(batches: Iterator[pa.RecordBatch], size: int, to: list[str]) -> Iterator[pa.RecordBatch]:
    """Each document's set, once for each of its blocks (the fields ``to``)."""
    for batch in batches:
        for part in slices(batch, "text"):
            w = Words(part.column("text"), lower=True)
            row, h = shingles(w, size)
            order = by_row(row, w.rows)
            h = h[order]
            n = np.bincount(row, minlength=w.rows)
            first = np.concatenate([[0], np.cumsum(n)])
            sets = _blobs(h.tobytes(), first * 8)
            blocks = part.column("blocks")
            each = np.repeat(np.arange(w.rows), np.diff(blocks.offsets.to_numpy()))
            flat = blocks.flatten()
            weight = np.cumsum(n[each] * 8 + 64)
            k = 0
            while k < len(each):  # so many copies at a time
                stop = max(k + 1, int(np.searchsorted(weight, (weight[k - 1] if k else 0) + SHIPPED_BYTES)))
                one, at = pa.array(each[k:stop]), flat.slice(k, stop - k)
                yield pa.RecordBatch.from_pydict({c: at.field(c) for c in to} | {"id": part.column("id").take(one), "set": sets.take(one)})
                k = stop
    give_back()


def _shipped(plain: DataFrame, wanted: DataFrame, to: list[str], size: int, scratch: Scratch) -> DataFrame:
    """(to, id, set) for the rows (id, to) of ``wanted``. Of one document's many tiles 64 go into a row, so that no row is unbounded."""
    kinds = dict(wanted.dtypes)
    wanted = scratch.save(wanted.groupBy("id", F.floor(F.col("tile") / 64).alias("some")).agg(F.collect_set(F.struct(*to)).alias("blocks")).select("id", "blocks"))
    rows = wanted.agg(F.coalesce(F.sum(F.size("blocks")), F.lit(0)).alias("n")).first().n
    texts = plain.where("id is not null").join(F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted, "id").select("id", "text", "blocks")
    return texts.mapInArrow(partial(_sets, size=size, to=to), ", ".join(f"{c} {kinds[c]}" for c in to) + ", id bigint, set binary")


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common numbers of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    spot = np.minimum(b.searchsorted(a), len(b) - 1)
    return int((b[spot] == a).sum())


def _to_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of members to the leader of their group, which comes first in it."""
    for rows, at in _whole_groups(batches, ["leader", "tile"]):
        ids, leaders, member = rows["id"].to_numpy(), rows["leader"].to_numpy(), rows["member"].to_numpy()
        sets = _pieces(rows["set"], U64)
        found = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            heads = [i for i in range(a, b) if not member[i]]
            for i in range(a, b):
                if member[i]:
                    for k in heads:
                        both = _overlap(sets[k], sets[i])
                        if both and 100 * both >= PERCENT * (len(sets[k]) + len(sets[i]) - both):
                            found.append(i)
                            break
        yield pa.RecordBatch.from_pydict({"a": pa.array(ids[found], pa.int64()), "b": pa.array(leaders[found], pa.int64())})
    give_back()


def _first_round(plain: DataFrame, alone: DataFrame, size: int, n_parts: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of sets to the smallest id with which they share least hashes."""
    least = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"m{k}").alias("m")) for k in range(len(SALTS))]))
    each = alone.where(F.col("n") >= LEAST).select("id", "n", least.alias("of")).select("id", "n", "of.*")
    heads = scratch.save(each.groupBy("k", "m").agg(F.min(F.struct("id", "n")).alias("head"), F.count("*").alias("c")).where("c > 1").select("k", "m", F.col("head.id").alias("leader"), F.col("head.n").alias("long")))
    pairs = each.join(small(heads), ["k", "m"]).where((F.col("id") != F.col("leader")) & (100 * F.least("n", "long") >= PERCENT * F.greatest("n", "long")))
    pairs = scratch.save(pairs.groupBy("leader", "id", "n").agg(F.count("*").alias("c")).where(F.col("c") >= AGREE).select("leader", "id", "n"))
    # a leader's members are cut into tiles, each of which gets the leader's set
    counted = scratch.save(pairs.groupBy("leader").agg(F.ceil(F.greatest(F.count("*") / (TILE - 1), F.sum("n") / TILE_SHINGLES)).alias("tiles")))
    members = pairs.join(small(counted), "leader").select("id", "leader", F.pmod(F.xxhash64("id"), F.col("tiles")).alias("tile"), F.lit(True).alias("member"))
    leaders = counted.select(F.col("leader").alias("id"), "leader", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("tile"), F.lit(False).alias("member"))
    sets = _shipped(plain, members.unionByName(leaders), ["leader", "tile", "member"], size, scratch)
    return sets.repartition(n_parts, "leader", "tile").sortWithinPartitions("leader", "tile").mapInArrow(_to_leaders, "a bigint, b bigint")


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect what is similar within each block, each verified on the whole sets."""
    for rows, at in _whole_groups(batches, BLOCK):
        ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        sets = _pieces(rows["set"], U64)
        left, right = [], []
        for k in np.flatnonzero(np.diff(at) > 1):
            for i, j in similar(sets[at[k] : at[k + 1]], labels[at[k] : at[k + 1]]):
                left.append(ids[at[k] + i])
                right.append(ids[at[k] + j])
        yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})
    give_back()


def similar(sets: list[np.ndarray], labels: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of similar sets (sorted arrays) that connect all that is similar; pairs already connected, as by equal ``labels``, are left out."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    label = np.arange(len(sets)) if labels is None else np.unique(labels, return_inverse=True)[1]
    if (label == label[0]).all():
        return
    groups = groups_for(sizes)
    counts = folded([np.bincount((s & U64(g - 1)).astype(np.int64), minlength=g) for s, g in zip(sets, groups.tolist(), strict=True)])
    tree = CountTree(counts, sizes, PERCENT)
    common = _most_common(label)
    rest = np.flatnonzero(label != common)
    place = np.full(len(sets), -1)
    place[rest] = np.arange(len(rest))
    for i in rest.tolist():
        near = tree.order[tree.partners(counts[i], sizes[i])]
        near = near[((place[near] < 0) | (place[near] > place[i])) & (label[near] != label[i])]
        for j in near.tolist():
            if label[j] == label[i]:
                continue
            both = _overlap(sets[i], sets[j])
            if both and 100 * both >= PERCENT * (sizes[i] + sizes[j] - both):
                label[label == label[j]] = label[i]
                yield i, j


def jaccard_join(docs: DataFrame, size: int = 5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for each document: similar documents, directly or through others, share the smallest id.

    A-Z are lower-cased; two documents link if 100 * intersection >= 75 * union of their sets of ``size``-word shingles.
    Nulls and texts without words have 0 shingles and link with nothing; fewer words than ``size`` make one shingle.
    Rows that share an id are one node, with the links of each row; rows without an id are left out. Other columns are
    neither read nor returned; an empty table gives an empty result. Ids are integers. Very long texts are taken whole.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    plain = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    n_parts = shuffle_count(spark, docs, target=16 << 20)

    often = plain.select("text").mapInArrow(partial(_frequent, size=size), "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= 2 * FREQUENT)
    often = scratch.save(often.select("h", F.least(F.lit(63), F.floor(F.log2("n"))).cast("byte").alias("level")))
    kept, least, top_level = 0, 64, 0
    for r in often.groupBy("level").count().orderBy(F.desc("level")).collect():  # at most 64 rows
        kept, top_level = kept + r["count"], max(top_level, r["level"])
        if kept > MOST_FREQUENT:
            break
        least = r["level"]
    chosen = often.where(F.col("level") >= least).toPandas()
    h, level = chosen["h"].to_numpy(np.int64).view(U64), chosen["level"].to_numpy(np.int8)
    order = np.argsort(h)
    frequent = spark.sparkContext.broadcast((h[order], level[order]))

    least_hashes = ", ".join(f"m{k} bigint" for k in range(len(SALTS)))
    signed = scratch.save(plain.mapInArrow(partial(_signed, size=size, frequent=frequent), f"id bigint, n bigint, s1 bigint, s2 bigint, {least_hashes}, vector binary, prefix binary"))
    of = ["n", "s1", "s2"]
    full = signed.where("n > 0")
    equal = scratch.save(full.groupBy(*of).agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1").select(*of, "first"))
    copies = full.select("id", *of).join(small(equal), of).where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    alone = full.join(small(equal), of, "left").where("first is null or first = id").drop("first", "s1", "s2")

    easy = scratch.save(_first_round(plain, alone, size, n_parts, scratch))
    first_labels = scratch.save(components(easy, scratch))
    labels = first_labels.select(F.col("node").alias("id"), F.col("component").alias("label"))
    known = alone.where(F.col("n") >= LEAST).select("id", "n", "prefix").join(small(labels), "id", "left").withColumn("label", F.coalesce("label", "id"))
    tokens = known.select("id", "n", "prefix", "label").mapInArrow(_tokens, "key bigint, id bigint, n int, room int, label bigint, own int")
    blocks = _blocks(_meeting(tokens, top_level, n_parts, scratch), top_level, n_parts, scratch)
    near = _tiled(blocks, alone.select("id", "n", "vector"), scratch)
    near = near.repartition(n_parts, *BLOCK).sortWithinPartitions(*BLOCK)
    near = scratch.save(near.mapInArrow(_with_partner, "leader bigint, cls int, tile bigint, id bigint, label bigint"))
    sets = _shipped(plain, near, [*BLOCK, "label"], size, scratch)
    links = sets.repartition(n_parts, *BLOCK).sortWithinPartitions(*BLOCK).mapInArrow(_links, "a bigint, b bigint")
    all_links = first_labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(links).unionAll(copies)
    final = components(all_links, scratch).select(F.col("node").alias("id"), "component")
    out = signed.select("id", F.col("n").alias("n_shingles")).join(final, "id", "left")
    return out.select(F.col("id").alias(id_column), "n_shingles", F.coalesce("component", "id").alias("component_id"))
