"""The queries of this subpackage, by name, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions.session import ship
from packloom.functions.text import SPACES
from packloom.llm import language, leak, mix, neardup, neighbours, sentences, spam, split, unify


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{d}/{table}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = unify.alike_pairs(_read(spark, d, "chunks"), "chunk_index")
    return pairs.select(F.col("a").alias("chunk_a"), F.col("b").alias("chunk_b"))


def p1_canonical(spark: SparkSession, d: str) -> DataFrame:
    return unify.with_form(_read(spark, d, "chunks").select("chunk_index", "text")).select("chunk_index", "canonical")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    chunks = _read(spark, d, "chunks").select(F.lit("chunks").alias("tab"), F.col("chunk_index").alias("k"), F.col("text").alias("t"))
    snippets = _read(spark, d, "citations").select(F.lit("citations").alias("tab"), F.col("citation_id").alias("k"), F.col("snippet").alias("t"))
    return chunks.union(snippets)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.similar_pairs(_texts(spark, d), 0.7)


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(_texts(spark, d), 0.7)


def p2_nearest(spark: SparkSession, d: str) -> DataFrame:
    out = neighbours.nearest(_read(spark, d, "chunk_vectors"))
    return out.select(F.col("id").alias("vec_id"), F.col("other").alias("neighbour_id"), "cosine", "rank")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neighbours.nearest(_read(spark, d, "chunk_vectors"))
    return pairs.select(F.least("id", "other").alias("vec_a"), F.greatest("id", "other").alias("vec_b")).distinct()


def p2_search(spark: SparkSession, d: str) -> DataFrame:
    """Greedy search for every vector whose id is divisible by 50, against all vectors."""
    vectors = _read(spark, d, "chunk_vectors")
    found = neighbours.search(vectors, vectors.where("vec_id % 50 = 0"))
    return found.select(F.col("id").alias("vec_id"), F.col("other").alias("neighbour_id"), "cosine", "rank")


def p3_segments(spark: SparkSession, d: str) -> DataFrame:
    chunks = _read(spark, d, "chunks")
    return language.segments(chunks, language.fitted(chunks, "chunk_index"), "chunk_index")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return language.mislabelled(p3_segments(spark, d), "chunk_index")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    chunks = _read(spark, d, "chunks")
    return sentences.sentences(chunks, sentences.fitted(chunks, "chunk_index"), "chunk_index")


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.pieces(split.pack_items(_read(spark, d, "chunks"), _read(spark, d, "citations"), _read(spark, d, "packs")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_pieces(spark, d).where("piece = 1").select("tab", "id").distinct()  # what is cut has a second piece


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(_read(spark, d, "documents"), _read(spark, d, "benchmark_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_leaks(spark, d).where("exact_windows > 0").select("doc_id", "item_id")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = mix.sized(_read(spark, d, "documents"))
    return rows, mix.plan(rows, _read(spark, d, "mix_targets"))


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix.mixture(*_mix(spark, d))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.shares(*_mix(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_shares(spark, d).where("short").select("mix_id", "source")


def p9_pages(spark: SparkSession, d: str) -> DataFrame:
    seen = spam.features(_read(spark, d, "documents"))
    return spam.judged(seen, spam.fit(seen))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_pages(spark, d).where("spam").select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit()}


def oracle_sql() -> dict[str, str]:
    blank = "".join(f" || chr({o})" for o in SPACES)[4:]
    tokens = f"""SELECT doc_id, source, greatest(1, length(text) // 4) AS tokens FROM documents
        WHERE source IS NOT NULL AND trim(coalesce(text, ''), {blank}) <> ''"""
    form = unify.canonical_sql("text")
    return {
        "p1_canonical": f"SELECT chunk_index, {form} AS canonical FROM chunks",
        "p1_found": f"""
            WITH f AS (SELECT chunk_index, text, {form} AS c FROM chunks WHERE text IS NOT NULL)
            SELECT a.chunk_index AS chunk_a, b.chunk_index AS chunk_b FROM f a JOIN f b USING (c)
            WHERE a.chunk_index < b.chunk_index AND a.text <> b.text AND trim(c, {blank}) <> ''""",
        "p6_found": f"""
            SELECT 'chunks' AS tab, chunk_index AS id FROM chunks JOIN packs USING (pack_id)
            WHERE greatest(1, length(text) // 4) > chunk_size AND trim(coalesce(text, ''), {blank}) <> ''
            UNION ALL SELECT 'citations', citation_id FROM citations JOIN packs USING (pack_id)
            WHERE end_char > start_char AND (end_char - start_char) // 4 > chunk_size""",
        "p8_found": f"""
            WITH own AS (SELECT source, sum(tokens) AS own FROM ({tokens}) GROUP BY source),
            t AS (SELECT mix_id, source, weight, max_repeats, coalesce(own, 0) AS own FROM mix_targets LEFT JOIN own USING (source))
            SELECT mix_id, source FROM (
                SELECT *, weight / sum(weight) OVER w * CAST(sum(own) OVER w AS DOUBLE) AS budget FROM t WINDOW w AS (PARTITION BY mix_id))
            WHERE budget > max_repeats * own""",
    }
