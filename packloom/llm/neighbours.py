"""Problem 2: the most similar vectors of every vector.

Method: NN-descent. Blocks around pivots give first neighbours; then, round after round, the neighbours of each
vector are joined with each other through Spark and the better ones kept, until few change. The search runs on
codes of one byte a value; an exact check orders what it leaves. Queries walk the graph greedily.

A vector's home is the block of its nearest pivot. A round's joins are made home by home, so a code is sent once to
each home that needs it, not to each of the vectors there, and a home tells a vector only of its best finds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions.session import delete, settle, ship
from packloom.llm.groups import groups_of
from packloom.llm.sample import least_hashed

KEEP = 16
"""Neighbours kept for each vector during the search; the answer is the best of them."""
MEMBERS = 20
"""Neighbours, either way, that a vector's join takes in one round: new ones first, then the closest. New ones beyond wait for the next round."""
NEAR = 4
"""Pivots in whose blocks a vector looks for its first neighbours."""
PIVOTS, BLOCK = 2048, 512
"""Most pivots of one level, and the size of a block. Blocks far larger are split by pivots of their own, level by level."""
PART = 50_000
"""Members of one block that a task splits; larger blocks go in several parts, each with the block's pivots."""
LEVELS = 3
"""Levels of pivots below the first; blocks that are still too large hold vectors of nearly one code and are split at random."""
ROUNDS, ENOUGH = 40, 0.002
"""The search ends when fewer than this share of all links is new; more rounds than that raise RuntimeError."""
BEAM, STEP, START = 32, 6, 8
"""Of a greedy search: nodes kept for a query, those opened in a round, and with how many of each of its blocks it begins."""
ASKED = 4096
"""Queries that a task compares with a block; more go in several tasks."""


def _raw(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """The bytes of values of one width, none of them null."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if not len(column):
        return np.zeros((0, width), np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(-1, width)


def _encoded(units: np.ndarray) -> list[bytes]:
    """One byte a value."""
    q = np.rint(units * (127 / np.maximum(np.abs(units).max(axis=1, keepdims=True), 1e-30))).astype(np.int8)
    return [r.tobytes() for r in q]


def _decoded(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Unit vectors from their codes."""
    m = _raw(column, size).view(np.int8).astype(np.float32)
    return m / np.sqrt(np.maximum((m * m).sum(axis=1, keepdims=True), 1e-30))


def _usable(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(id, vector) -> (id, cls, q, f) of the usable vectors: hash of the values, code, and the float values."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):  # bounds the arrays of a batch
            batch = whole.slice(at, 1000)
            m = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, size)
            wide = m.astype(np.float64)
            norm = np.sqrt((wide * wide).sum(axis=1))
            ok = np.isfinite(norm) & (norm > 0)
            m, unit = np.ascontiguousarray(m[ok]) + np.float32(0), wide[ok] / norm[ok][:, None]
            raw = [r.tobytes() for r in m]
            cls = pa.array([xxhash.xxh3_64_intdigest(r) - 2**63 for r in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), cls, pa.array(_encoded(unit), pa.binary()), pa.array(raw, pa.binary())], ["id", "cls", "q", "f"])


def prepared(vectors: DataFrame, key: str, vector: str, size: int) -> DataFrame:
    """The usable vectors, (``id``, ``cls``, ``q``, ``f``). Equal vectors have one ``cls``."""
    ship(vectors.sparkSession)
    rows = vectors.where(F.col(key).isNotNull() & (F.size(vector) == size)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"))
    return rows.mapInArrow(lambda it: _usable(it, size), "id long, cls long, q binary, f binary")


def _nearest_pivots(units: np.ndarray, pivots: np.ndarray, count: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, the nearest first."""
    s = units @ pivots.T
    count = min(count, s.shape[1])
    some = np.argpartition(-s, count - 1, axis=1)[:, :count]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(s, some, axis=1), axis=1, kind="stable"), axis=1)


def _placed(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """(node, q) -> (block, node, q, home), each vector in the blocks of its nearest pivots."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            near = _nearest_pivots(_decoded(batch.column(1), size), pivots, NEAR)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
            home = np.zeros(near.shape, bool)
            home[:, 0] = True
            yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(home.ravel())], ["block", "node", "q", "home"])


def _split(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(part, block, pivot, node, q, home) sorted by part -> (block, node, q, home), by the part's own pivots.

    A home goes on with the nearest pivot and looks at the next one too.
    """
    for table in groups_of(batches):
        is_pivot = table.column("pivot").to_numpy()
        pivots, rest = table.filter(pa.array(is_pivot)), table.filter(pa.array(~is_pivot))
        if not rest.num_rows:
            continue
        if not pivots.num_rows:  # the sample of a part may be empty
            yield from rest.select(["block", "node", "q", "home"]).combine_chunks().to_batches()
            continue
        units, names = _decoded(pivots.column("q"), size), pivots.column("node").to_numpy().astype(np.uint64)
        for at in range(0, rest.num_rows, 2000):
            part = rest.slice(at, 2000)
            near = _nearest_pivots(_decoded(part.column("q"), size), units, 2)
            old, home = part.column("block").to_numpy().astype(np.uint64), part.column("home").to_numpy()
            blocks = [_mixed(old * np.uint64(31) + _mixed(names[near[:, 0]])).view(np.int64)]
            rows, homes = [np.arange(len(near))], [home]
            if near.shape[1] > 1:
                rows.append(np.flatnonzero(home))
                blocks.append(_mixed(old * np.uint64(31) + _mixed(names[near[:, 1]])).view(np.int64)[home])
                homes.append(np.zeros(int(home.sum()), bool))
            take = pa.array(np.concatenate(rows))
            column = lambda c: pa.concat_arrays(part.column(c).chunks).take(take)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(blocks)), column("node"), column("q"), pa.array(np.concatenate(homes))], ["block", "node", "q", "home"])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _best_in_block(batches: Iterator[pa.RecordBatch], size: int, keep: int) -> Iterator[pa.RecordBatch]:
    """(block, node, q) sorted by block -> (node, other, sim): the nearest of each vector in its block."""
    for table in groups_of(batches):
        own, units = table.column("node").to_numpy(), _decoded(table.column("q"), size)
        k = min(keep, len(own) - 1)
        for i in range(0, len(own) if k > 0 else 0, BLOCK):
            s = units[i : i + BLOCK] @ units.T
            s[np.arange(len(s)), np.arange(i, i + len(s))] = -2
            top = np.argpartition(-s, k - 1, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own[i : i + BLOCK], k)), pa.array(own[top].ravel()), pa.array(np.take_along_axis(s, top, axis=1).ravel())], ["node", "other", "sim"])


def _firsts(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def _ranks(sorted_groups: np.ndarray) -> np.ndarray:
    """Each row's place in its run of equal values."""
    first = _firsts(sorted_groups)
    return np.arange(len(sorted_groups)) - np.repeat(first, np.diff(np.append(first, len(sorted_groups))))


def _joined(batches: Iterator[pa.RecordBatch], size: int, keep: int) -> Iterator[pa.RecordBatch]:
    """Rows of homes, sorted -> (node, other, sim): better neighbours found by joining neighbours of one vector.

    A home's rows (home, kind, centre, place, other, fresh, least, q) are codes, kind 0, and then links, kind 1. Two
    vectors near the same centre are compared if one of them is new there, and told of each other if that betters
    the last of their own neighbours. A home passes on the best ``keep`` of each vector.
    """
    for table in groups_of(batches):
        links = table.column("kind").to_numpy() == 1
        codes, links = table.filter(pa.array(~links)), table.filter(pa.array(links))
        if not links.num_rows or not codes.num_rows:
            continue
        ids, least, units = codes.column("other").to_numpy(), codes.column("least").to_numpy(), _decoded(codes.column("q"), size)
        order = np.argsort(ids)
        centre, fresh = links.column("centre").to_numpy(), links.column("fresh").to_numpy()
        other = order[np.searchsorted(ids, links.column("other").to_numpy(), sorter=order)]
        number = np.cumsum(np.append(False, centre[1:] != centre[:-1]))
        once = np.sort(np.unique(number * np.int64(len(ids)) + other, return_index=True)[1])  # a mutual link comes twice
        number, other, fresh = number[once], other[once], fresh[once]
        place = _ranks(number)
        used = place < MEMBERS
        number, other, fresh, place = number[used], other[used], fresh[used], place[used]
        near = np.full((int(number[-1]) + 1, MEMBERS), -1, np.int64)
        new = np.zeros(near.shape, bool)
        near[number, place], new[number, place] = other, fresh
        xs, ys, ss = [], [], []
        for at in range(0, len(near), 128):
            n, f = near[at : at + 128], new[at : at + 128]
            u = units[n]
            s = u @ u.transpose(0, 2, 1)
            good = (f[:, :, None] | f[:, None, :]) & (n >= 0)[:, :, None] & (n >= 0)[:, None, :] & (s > least[n][:, :, None])
            good[:, np.arange(MEMBERS), np.arange(MEMBERS)] = False
            c, i, j = np.nonzero(good)
            xs.append(n[c, i]), ys.append(n[c, j]), ss.append(s[c, i, j])
        x, y, s = (np.concatenate(v) for v in (xs, ys, ss))
        _, once = np.unique(x * np.int64(len(ids)) + y, return_index=True)
        x, y, s = x[once], y[once], s[once]
        order = np.lexsort((y, -s, x))
        order = order[_ranks(x[order]) < keep]
        yield pa.RecordBatch.from_arrays([pa.array(ids[x[order]]), pa.array(ids[y[order]]), pa.array(s[order].astype(np.float32))], ["node", "other", "sim"])


def _best(rows: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


@dataclass
class Graph:
    """``nodes`` (node, home, q), ``edges`` (node, other, sim) and what places further vectors: first pivots, pivots of each level, ``blocks`` (block, part, node)."""

    nodes: DataFrame
    edges: DataFrame
    size: int
    pivots: np.ndarray
    levels: list[DataFrame]
    blocks: DataFrame


def _descended(placed: DataFrame, pivots: DataFrame, size: int) -> DataFrame:
    """Rows of ``placed`` in blocks that have ``pivots`` (block, parts, node, q), one level down; others as they are."""
    parts = pivots.select("block", "parts").distinct()
    rows = placed.join(parts, "block")
    part = F.xxhash64("block", F.pmod(F.xxhash64("node"), F.col("parts")))
    members = rows.select(part.alias("part"), "block", F.lit(False).alias("pivot"), "node", "q", "home")
    copies = pivots.select("block", "node", "q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("i"))
    copies = copies.select(F.xxhash64("block", "i").alias("part"), "block", F.lit(True).alias("pivot"), "node", "q", F.lit(False).alias("home"))
    split = members.union(copies).repartition("part").sortWithinPartitions("part").mapInArrow(lambda it: _split(it, size), "block long, node long, q binary, home boolean")
    return split.union(placed.join(parts, "block", "left_anti").select("block", "node", "q", "home"))


def _first_placed(rows: DataFrame, pivots: np.ndarray, size: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(pivots)
    return rows.select("node", "q").mapInArrow(lambda it: _placed(it, sent.value, size), "block long, node long, q binary, home boolean")


def graph(nodes: DataFrame, size: int, keep: int = KEEP) -> Graph:
    """The neighbour graph of ``nodes`` (``node``, ``q``), no two of one ``node``, by approximate cosine.

    Blocks and homes hold at most ``BLOCK`` vectors and the join of a round at most 2 * ``MEMBERS`` links of each, so
    no task's memory grows with the table, however many vectors lie together.
    """
    spark = nodes.sparkSession
    ship(spark)
    n = nodes.count()
    count = int(min(PIVOTS, max(1, n // (BLOCK // 4))))
    chosen = least_hashed(nodes.select(F.col("node").alias("k"), "q"), n, count)
    pivots = _decoded(pa.array([bytes(r.q) for r in chosen], pa.binary()), size)
    if not chosen:
        none = nodes.withColumn("home", F.lit(0).cast("long")).select("node", "home", "q")
        return Graph(none, none.select("node", F.col("node").alias("other"), F.lit(0.0).cast("float").alias("sim")), size, pivots, [], none.select(F.col("home").alias("block"), F.col("home").alias("part"), "node"))
    placed, levels = _first_placed(nodes, pivots, size), []
    for level in range(LEVELS):
        sizes = placed.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > 4 * BLOCK)
        sizes, held = settle(sizes)
        if not sizes.limit(1).count():
            delete(spark, held)
            break
        placed, _ = settle(placed)
        want = F.least(F.lit(PIVOTS), F.ceil(F.col("n") / (BLOCK / 4)))
        draw = F.pmod(F.xxhash64("node", F.lit(level + 10)), F.lit(2**40)) / 2**40
        own = placed.join(sizes, "block").where(draw < want / F.col("n")).select("block", F.ceil(F.col("n") / PART).alias("parts"), "node", "q")
        own, _ = settle(own)
        levels.append(own)
        placed = _descended(placed, own, size)
    thin, _ = settle(placed.select("block", "node", "home"))
    sizes = thin.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    split = thin.join(sizes, "block").select("block", F.xxhash64("block", F.pmod(F.xxhash64("node", "block"), F.col("parts"))).alias("part"), "node", "home")
    split, _ = settle(split)
    codes, _ = settle(nodes.select("node", "q").join(split.where("home").select("node", F.col("part").alias("home")), "node").select("node", "home", "q"))
    inside = split.select("part", "node").join(nodes.select("node", "q"), "node").select("part", "node", "q")
    first = inside.repartition("part").sortWithinPartitions("part").mapInArrow(lambda it: _best_in_block(it, size, keep), "node long, other long, sim float")
    state, path = settle(_best(first.groupBy("node", "other").agg(F.max("sim").alias("sim")), keep).drop("rank").withColumn("fresh", F.lit(True)))
    for _ in range(ROUNDS):
        after, new = settle(_round(state, codes, size, keep))
        delete(spark, path)
        state, path = after, new
        if state.where("fresh").count() <= ENOUGH * n * keep:
            return Graph(codes, state.select("node", "other", "sim"), size, pivots, levels, split.select("block", "part", "node"))
    raise RuntimeError("the neighbour graph did not settle")


def _round(state: DataFrame, codes: DataFrame, size: int, keep: int) -> DataFrame:
    """One round of NN-descent on the links (node, other, sim, fresh)."""
    least = state.groupBy("node").agg(F.when(F.count("*") >= keep, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("least"))
    known = codes.select(F.col("node").alias("other"), "q").join(least.withColumnRenamed("node", "other"), "other", "left")
    both = state.select(F.col("node").alias("centre"), "other", "sim", "fresh", F.lit(True).alias("own")).union(state.select("other", "node", "sim", "fresh", F.lit(False)))
    order = Window.partitionBy("centre").orderBy(F.desc("fresh"), F.desc("sim"), "other", F.desc("own"))
    lists = both.withColumn("place", F.row_number().over(order)).where(F.col("place") <= 2 * MEMBERS)
    lists = lists.withColumn("live", F.max("fresh").over(Window.partitionBy("centre"))).where("live")
    lists = lists.join(codes.select(F.col("node").alias("centre"), "home"), "centre")
    lists, _ = settle(lists.select("home", "centre", "place", "other", "fresh", "own"))
    sent = lists.select("home", "other").distinct().join(known, "other")
    rows = sent.select("home", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("centre"), F.lit(0).alias("place"), "other", F.lit(False).alias("fresh"), F.coalesce("least", F.lit(-2.0).cast("float")).alias("least"), "q")
    rows = rows.union(lists.select("home", F.lit(1), "centre", "place", "other", "fresh", F.lit(0.0).cast("float"), F.lit(b"")))
    better = rows.repartition("home").sortWithinPartitions("home", "kind", "centre", "place").mapInArrow(lambda it: _joined(it, size, keep), "node long, other long, sim float")
    no = F.lit(False)
    used = lists.where(F.col("own") & (F.col("place") <= MEMBERS)).select(F.col("centre").alias("node"), "other", F.lit(-2.0).cast("float").alias("sim"), no.alias("fresh"), no.alias("old"), F.lit(True).alias("used"))
    every = state.select("node", "other", "sim", "fresh", F.lit(True).alias("old"), no.alias("used")).union(used).union(better.select("node", "other", "sim", no, no, no))
    merged = every.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.max("fresh").alias("fresh"), F.max("old").alias("old"), F.max("used").alias("used"))
    merged = merged.select("node", "other", "sim", F.when(F.col("old"), F.col("fresh") & ~F.col("used")).otherwise(True).alias("fresh"))
    return _best(merged, keep).drop("rank")


def _exact(batches: Iterator[pa.RecordBatch], size: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows of homes (home, kind, a, b, f), vectors before links -> (a, b, cosine to 6 decimals), ``k`` and ties for each a."""
    for table in groups_of(batches):
        links = table.column("kind").to_numpy() == 1
        vectors, links = table.filter(pa.array(~links)), table.filter(pa.array(links))
        if not links.num_rows:
            continue
        ids, f = vectors.column("a").to_numpy(), _raw(vectors.column("f"), 4 * size).view(np.float32)
        order = np.argsort(ids)
        a, b = (order[np.searchsorted(ids, links.column(c).to_numpy(), sorter=order)] for c in ("a", "b"))
        cosine = np.empty(len(a))
        for at in range(0, len(a), 2000):
            x, y = f[a[at : at + 2000]].astype(np.float64), f[b[at : at + 2000]].astype(np.float64)
            cosine[at : at + 2000] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
        cosine = np.round(cosine, 6)
        order = np.lexsort((-cosine, a))
        a, b, cosine = a[order], b[order], cosine[order]
        first = _firsts(a)
        last = np.minimum(first + k, np.append(first[1:], len(a))) - 1
        good = cosine >= np.repeat(cosine[last], np.diff(np.append(first, len(a))))
        yield pa.RecordBatch.from_arrays([pa.array(ids[a[good]]), pa.array(ids[b[good]]), pa.array(cosine[good])], ["a", "b", "cosine"])


def _cosines(links: DataFrame, nodes: DataFrame, size: int, k: int) -> DataFrame:
    """Exact cosines of ``links`` (``home``, ``a``, ``b``): (``a``, ``b``, ``cosine``), the best ``k`` and ties. A home's vectors are sent to it once."""
    needed = links.select("home", "a").union(links.select("home", "b")).distinct()
    vectors = needed.join(nodes.select(F.col("node").alias("a"), "f"), "a").select("home", F.lit(0).alias("kind"), "a", "a", "f")
    rows = vectors.union(links.select("home", F.lit(1), "a", "b", F.lit(b""))).toDF("home", "kind", "a", "b", "f")
    return rows.repartition("home").sortWithinPartitions("home", "kind").mapInArrow(lambda it: _exact(it, size, k), "a long, b long, cosine double")


def _by_class(vectors: DataFrame, key: str, vector: str, size: int) -> tuple[DataFrame, DataFrame]:
    """The distinct usable vectors (``node``, ``q``, ``f``), named by their least id, and which ``id`` each ``node`` stands for."""
    rows, _ = settle(prepared(vectors, key, vector, size))
    least = F.min_by(F.struct("q", "f"), "id")
    nodes, _ = settle(rows.groupBy("cls").agg(F.min("id").alias("node"), least.alias("v")).select("cls", "node", "v.q", "v.f"))
    members, _ = settle(rows.select("id", "cls").join(nodes.select("cls", "node"), "cls").select("id", "node").distinct())
    return nodes.drop("cls"), members


def _listed(cosines: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(``id``, ``other``, ``cosine``, ``rank``) of all members of the classes that ``cosines`` (a, b, cosine) lists."""
    order = Window.partitionBy("node").orderBy("id")
    listed = members.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).select(F.col("node").alias("other"), "id")
    alone = members.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node", F.col("node").alias("other"), F.lit(1.0).alias("cosine"))
    order = Window.partitionBy("node").orderBy(F.desc("cosine"), "id")
    best = cosines.toDF("node", "other", "cosine").union(alone).join(listed, "other").select("node", "id", "cosine").withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    best = best.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("r", F.col("id").alias("other"), "cosine"))).alias("best"))
    each = members.join(best, "node").select("id", F.slice(F.filter("best", lambda x: x["other"] != F.col("id")), 1, k).alias("best"))
    return each.select("id", F.posexplode("best").alias("place", "x")).select("id", F.col("x.other").alias("other"), F.col("x.cosine").alias("cosine"), (F.col("place") + 1).alias("rank"))


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 384, k: int = 10) -> DataFrame:
    """The ``k`` most similar other vectors of every usable one: (``id``, ``other``, ``cosine``, ``rank``).

    Usable are vectors of exactly ``size`` values, all finite, not all zero; others, nulls and rows with a null key
    are left out. Cosines have 6 decimals, ties go to the smaller id. Equal vectors are searched as one and listed
    one by one, so a vector that a third of all rows hold costs one node; only the ``k`` + 1 least ids of a class can
    be among anyone's neighbours. A table of one vector gives no rows, an empty one neither; repeated rows of one key
    count once. Other columns are not read.
    """
    nodes, members = _by_class(vectors, key, vector, size)
    g = graph(nodes, size, max(KEEP, k + 6))
    links = g.edges.join(g.nodes.select("node", "home"), "node").select("home", F.col("node").alias("a"), F.col("other").alias("b"))
    cosines, _ = settle(_cosines(links, nodes, size, k))
    return _listed(cosines, members, k)


def _scored(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(query, node, qq, q) -> (query, node, sim)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 2000):
            batch = whole.slice(at, 2000)
            x, y = (_decoded(batch.column(i), size) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((x * y).sum(axis=1))], ["query", "node", "sim"])


def _in_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(part, query, id, q) sorted by part, members before queries -> (query, node, sim): the best ``START`` of the part."""
    for table in groups_of(batches):
        asked = table.column("query").to_numpy()
        members, asked = table.filter(pa.array(~asked)), table.filter(pa.array(asked))
        if members.num_rows and asked.num_rows:
            m, ids, q = _decoded(members.column("q"), size), members.column("id").to_numpy(), asked.column("id").to_numpy()
            k = min(START, len(ids))
            for at in range(0, len(q), 256):
                s = _decoded(asked.column("q").slice(at, 256), size) @ m.T
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q[at : at + 256], k)), pa.array(ids[top].ravel()), pa.array(np.take_along_axis(s, top, axis=1).ravel())], ["query", "node", "sim"])


def _begun(placed: DataFrame, g: Graph, size: int) -> DataFrame:
    """Where queries (``block``, ``node``, ``q``) begin: the best of each of their blocks."""
    placed, _ = settle(placed.select("block", "node", "q"))
    copies = placed.groupBy("block").agg(F.ceil(F.count("*") / ASKED).alias("copies"))
    salted = F.xxhash64("part", "i")
    members = g.blocks.join(copies, "block").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    members = members.join(g.nodes.select("node", "q"), "node").select(salted.alias("part"), F.lit(False).alias("query"), F.col("node").alias("id"), "q")
    asked = placed.join(copies, "block").withColumn("i", F.pmod(F.xxhash64("node"), F.col("copies"))).join(g.blocks.select("block", "part").distinct(), "block")
    rows = members.union(asked.select(salted, F.lit(True), "node", "q"))
    found = rows.repartition("part").sortWithinPartitions("part", "query").mapInArrow(lambda it: _in_blocks(it, size), "query long, node long, sim float")
    return found.groupBy("query", "node").agg(F.max("sim").alias("sim"))


def walked(g: Graph, queries: DataFrame) -> DataFrame:
    """Greedy search of ``queries`` (``query``, ``q``) in the graph: (``query``, ``node``, ``sim``), the ``BEAM`` best of each.

    A query begins at the best vectors of the blocks of its nearest pivots. Every round it opens the ``STEP`` best nodes
    of its beam that it hasn't opened, following links either way, all queries at once; it ends when no query has one
    left, which takes as many rounds as it takes.
    """
    spark, size = queries.sparkSession, g.size
    pairs = g.edges.select("node", "other").union(g.edges.select("other", "node")).distinct()
    back = Window.partitionBy("node").orderBy(F.xxhash64("other", "node"))
    links, _ = settle(pairs.withColumn("r", F.row_number().over(back)).where(F.col("r") <= 4 * KEEP).select("node", "other"))
    asked, _ = settle(queries.select("query", "q"))
    placed = _first_placed(asked.withColumnRenamed("query", "node"), g.pivots, g.size)
    for own in g.levels:
        placed = _descended(placed, own, g.size)
    begin = _begun(placed, g, size)
    score = lambda rows: rows.join(asked.select("query", F.col("q").alias("qq")), "query").join(g.nodes.select("node", "q"), "node").select("query", "node", "qq", "q").mapInArrow(lambda it: _scored(it, size), "query long, node long, sim float")
    order = Window.partitionBy("query").orderBy(F.desc("sim"), "node")
    top = lambda rows: rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= BEAM).drop("r")
    state, path = settle(top(begin).withColumn("open", F.lit(False)))
    while state.where("not open").limit(1).count():
        chosen = state.where("not open").withColumn("r", F.row_number().over(order)).where(F.col("r") <= STEP).select("query", "node")
        near = chosen.join(links, "node").select("query", F.col("other").alias("node")).distinct().join(state.select("query", "node"), ["query", "node"], "left_anti")
        opened = state.join(chosen.withColumn("now", F.lit(True)), ["query", "node"], "left").select("query", "node", "sim", (F.col("open") | F.col("now").isNotNull()).alias("open"))
        after, new = settle(top(opened.union(score(near).withColumn("open", F.lit(False)))))
        delete(spark, path)
        state, path = after, new
    return state.select("query", "node", "sim")


def search(vectors: DataFrame, asked: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = 384, k: int = 10) -> DataFrame:
    """The ``k`` most similar other vectors of those whose ``key`` is in ``asked``, by greedy search: as ``nearest``.

    Equal vectors are one node here too. Keys that no usable vector has give no rows.
    """
    nodes, members = _by_class(vectors, key, vector, size)
    g = graph(nodes, size, max(KEEP, k + 6))
    wanted = members.join(asked.select(F.col(key).cast("long").alias("id")).distinct(), "id")
    queries = nodes.join(wanted.select("node").distinct(), "node").select(F.col("node").alias("query"), "q")
    found = walked(g, queries).where("query <> node")
    links = found.join(g.nodes.select(F.col("node").alias("query"), "home"), "query").select("home", F.col("query").alias("a"), F.col("node").alias("b"))
    cosines, _ = settle(_cosines(links, nodes, size, k))
    return _listed(cosines, members, k).join(asked.select(F.col(key).cast("long").alias("id")).distinct(), "id", "left_semi")
