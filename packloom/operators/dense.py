"""Dense retrieval: exact cosine top-k of queries against all vectors."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions.session import ship

AT_ONCE = 4096
"""Queries sent to tasks at once, and the size of a block where there are more."""


def unit(vector: Column | str) -> Column:
    """``vector`` divided by its length; a zero vector stays as it is."""
    vector = (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(vector, lambda x: F.when(norm > 0, x / norm).otherwise(x))


def _matrix(column: pa.Array) -> np.ndarray:
    m = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=m, where=norm > 0)


def _scores(batches: Iterator[pa.RecordBatch], ids: np.ndarray, units: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """(id, vector) -> (query_id, chunk_index, score): the best ``k`` of each batch for each query."""
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column(0).to_numpy()
        order = np.argsort(own, kind="stable")
        s = np.round(_matrix(batch.column(1)) @ units.T, 6)[order]
        n = min(k, len(own))
        if 8 * n < len(own):  # ties at the last place are settled by index, so all of them stay for the sort
            least = np.partition(s, len(own) - n, axis=0)[len(own) - n]
            kept = (s >= least).any(axis=1)
            s, order = s[kept], order[kept]
        best = np.argsort(-s, axis=0, kind="stable")[:n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.tile(ids, n)), pa.array(own[order][best].ravel()), pa.array(np.take_along_axis(s, best, axis=0).ravel())], ["query_id", "chunk_index", "score"]
        )


def _grouped(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """(cell, kind, id, vector) sorted, a cell's queries before its vectors -> the best ``k`` of each batch for each query."""
    cell, ids, units = None, [], []
    for batch in batches:
        cells, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        edges = np.flatnonzero(np.append(True, (np.diff(cells) != 0) | (np.diff(kinds) != 0))) if len(cells) else []
        for a, b in zip(edges, [*edges[1:], len(cells)], strict=True):
            if cells[a] != cell:
                cell, ids, units = cells[a], [], []
            part = batch.slice(a, b - a)
            if kinds[a] == 0:
                ids.append(part.column(2).to_numpy()), units.append(_matrix(part.column(3)))
            elif ids:
                ids, units = [np.concatenate(ids)], [np.concatenate(units)]
                yield from _scores(iter([part.select([2, 3])]), ids[0], units[0], k)


def _single(rows: DataFrame, query: int, vector: list[float], k: int) -> DataFrame:
    """The best of one query, inside the JVM: the vector is a constant, and each task keeps its best ``k``."""
    v = np.asarray(vector, np.float64)
    norm = float(np.sqrt((v * v).sum()))
    own = F.lit((v / norm if norm > 0 else v).tolist())
    dot = F.aggregate(F.zip_with(F.col("v").cast("array<double>"), own, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    length = F.sqrt(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda s, x: s + x * x))
    best = rows.select(F.lit(query).cast("long").alias("query_id"), F.col("k").alias("chunk_index"), F.round(F.when(length > 0, dot / length).otherwise(0.0), 6).alias("score")).orderBy(F.desc("score"), "chunk_index").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_index")))


def topk(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", query: str = "query_id") -> DataFrame:
    """The ``k`` best vectors of each query by cosine: (``query_id``, ``rank``, ``chunk_index``, ``score``).

    Scores have 6 decimals, ties go to the smaller index; fewer than ``k`` vectors give fewer rows. Vectors whose
    length isn't the commonest of the queries', or that hold a null or NaN, are left out. One query is a constant of
    the plan; up to ``AT_ONCE`` are sent to where the vectors lie, and only each batch's best are shuffled. More are
    never gathered: blocks of queries meet parts of the vectors in Spark.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = vectors.sparkSession
    ship(spark)
    good = lambda c: F.col(c).isNotNull() & ~F.exists(c, lambda x: x.isNull() | F.isnan(x))
    asked = queries.where(good(vector)).select(F.col(query).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v"))
    usable = lambda size: vectors.where(good(vector) & (F.size(vector) == size)).select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    schema = "query_id long, chunk_index long, score double"
    taken = asked.limit(AT_ONCE + 1).collect()
    if not taken:
        out = spark.createDataFrame([], schema)
    elif len(taken) <= AT_ONCE:
        sizes = Counter(len(r.v) for r in taken)
        size = min(sizes, key=lambda n: (-sizes[n], n))
        taken = [r for r in taken if len(r.v) == size]
        if len(taken) == 1:
            return _single(usable(size), taken[0].query_id, taken[0].v, k).select("query_id", "rank", "chunk_index", "score")
        sent = spark.sparkContext.broadcast((np.array([r.query_id for r in taken], np.int64), _matrix(pa.array([r.v for r in taken], pa.list_(pa.float64())))))
        out = usable(size).mapInArrow(lambda it: _scores(it, *sent.value, k), schema)
    else:
        size, n = asked.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
        blocks, parts = -(-n // AT_ONCE), int(spark.conf.get("spark.sql.shuffle.partitions"))
        cell = lambda block, part: (block * parts + part).cast("long").alias("cell")
        q = asked.where(F.size("v") == size).withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        q = q.select(cell(F.pmod(F.xxhash64("query_id"), F.lit(blocks)), F.col("p")), F.lit(0).alias("kind"), F.col("query_id").alias("id"), "v")
        v = usable(size).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        v = v.select(cell(F.col("b"), F.pmod(F.xxhash64("k"), F.lit(parts))), F.lit(1).alias("kind"), F.col("k").alias("id"), F.col("v").cast("array<double>"))
        out = q.union(v).repartition("cell").sortWithinPartitions("cell", "kind").mapInArrow(lambda it: _grouped(it, k), schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_index")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "chunk_index", "score")


def stats(chunks: DataFrame, embeddings: DataFrame, citations: DataFrame | None = None, text: str = "text", vector: str = "embedding") -> DataFrame:
    """One row about a pack: status, number, dimension and lengths of chunks, number of citations."""
    n = F.length(text)
    c = chunks.where(F.col(text).isNotNull()).agg(F.count("*").alias("num_chunks"), F.min(n).alias("min_chunk_length"), F.max(n).alias("max_chunk_length"), F.avg(n).alias("avg_chunk_length"))
    e = embeddings.agg(F.max(F.size(vector)).alias("embedding_dimension"))
    out = c.join(e, how="cross").withColumn("status", F.when(F.col("num_chunks") > 0, "loaded").otherwise("no_data"))
    if citations is None:
        return out.withColumns({"has_citations": F.lit(False), "num_citations": F.lit(0).cast("long")})
    m = citations.agg(F.count("*").alias("num_citations"))
    return out.join(m, how="cross").withColumn("has_citations", F.col("num_citations") > 0)
