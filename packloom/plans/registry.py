"""The core queries of the engine, by name. Each takes a session and the folder of the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions.session import shared_dir, ship
from packloom.operators import chunk, citations, dense, embed, enrich, tfidf, validate
from packloom.plans.oracles import oracle_sql
from packloom.sources import documents as pages
from packloom.sources import pack
from packloom.streaming import ingest

__all__ = ["flagship", "oracle_sql", "queries"]

CHUNK_COLUMNS = ("doc_id", "chunk_id", "start_char", "end_char", "token_count", "char_count")


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{d}/{table}.parquet")


def _chunked(size: int, overlap: int, sentences: bool) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return chunk.chunk(_read(spark, d, "documents"), size, overlap, sentences).select(*CHUNK_COLUMNS, F.md5("text").alias("text_md5"))

    return run


def _items(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "benchmark_items").withColumnRenamed("item_id", "query_id")


def _fitted(spark: SparkSession, d: str) -> tfidf.Fitted:
    return tfidf.fit(_read(spark, d, "documents"))


def _histograms(rows: DataFrame, key: str) -> DataFrame:
    return rows.where("text is not null").select(key, embed.histogram("text", 256).alias("embedding")).where(F.exists("embedding", lambda x: x > 0))


def _text_dense(spark: SparkSession, d: str) -> DataFrame:
    return dense.topk(_histograms(_read(spark, d, "documents"), "doc_id"), _histograms(_items(spark, d), "query_id"), 5, "doc_id")


def _cosine(where: str, k: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        v = _read(spark, d, "embeddings")
        return dense.topk(v, v.where(where).withColumnRenamed("vec_id", "query_id"), k)

    return run


def _with_citations(spark: SparkSession, d: str) -> DataFrame:
    v = _read(spark, d, "chunk_vectors").where(F.exists("embedding", lambda x: x != 0))
    hits = dense.topk(v.where(F.size("embedding") == 384), v.where("vec_id % 50 = 0 and size(embedding) = 384").withColumnRenamed("vec_id", "query_id"), 5)
    hits = hits.withColumnRenamed("chunk_index", "vec_id").join(_read(spark, d, "chunk_vectors").select("vec_id", "chunk_index"), "vec_id")
    return citations.attach(hits, _read(spark, d, "citations")).select("query_id", "rank", "chunk_index", "score", "citation_id", "snippet")


def _place(spark: SparkSession, name: str) -> str:
    """A new place for files that Python writes: the shared folder must be one that all machines mount."""
    root = shared_dir(spark)
    if "://" in root and not root.startswith("file://"):
        raise ValueError(f"packs are written to mounted folders, not to {root}")
    return f"{root.removeprefix('file://').removeprefix('file:')}/{name}-{uuid.uuid4().hex}"


def _sidecar(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tfidf-{uuid.uuid4().hex}"
    tfidf.export(_fitted(spark, d), path)
    return tfidf.topk(tfidf.load(spark, path), _items(spark, d), 5)


def _written(spark: SparkSession, d: str, suffix: str, **how) -> str:
    """One pack of all chunks that have a text and a vector of 384 values: a row for each such vector."""
    vectors = _read(spark, d, "chunk_vectors").where("size(embedding) = 384").select("vec_id", "chunk_index", "embedding")
    chunks = _read(spark, d, "chunks").where("text is not null").withColumn("snippet", chunk.snippet("text")).withColumns({"context_before": F.lit(""), "context_after": F.lit("")})
    rows = vectors.join(chunks.select("chunk_index", "text", *citations.FIELDS), "chunk_index").drop("chunk_index").withColumnRenamed("vec_id", "chunk_index")
    path = _place(spark, "pack") + suffix
    registered = enrich.register(_read(spark, d, "source_documents"))
    meta = pack.manifest_of(chunk.metadata(128, 20), embed.metadata("model", "1"), registered, rows, pack_id="all", created_at="2024-01-01T00:00:00")
    pack.write(rows, None if how.get("legacy") else rows.select("chunk_index", *citations.FIELDS), path, meta, **how)
    return path


def _roundtrip(suffix: str, vectors: str = "npy", **how) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        path = f"{_written(spark, d, suffix, **how)[:-1]}?" if vectors == "npy" else _written(spark, d, suffix, **how)  # a pattern names one or many packs
        value = lambda i: F.col("embedding")[i].cast("double")
        v = pack.read(spark, path, "embeddings", vectors).select("chunk_index", value(0).alias("first_value"), value(383).alias("last_value"), F.size("embedding").alias("dimension"))
        return pack.read(spark, path, "chunks").join(v, "chunk_index").select("chunk_index", "text", "first_value", "last_value", "dimension")

    return run


def _cited(spark: SparkSession, d: str) -> DataFrame:
    return pack.read(spark, _written(spark, d, ".zip"), "citations").select("line", "chunk_id", "doc_id", "start_char", "end_char", "page_number")


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """What the manifest of a written pack says of its sources."""
    meta = pack.read(spark, _written(spark, d, ".zip"), "manifest")
    fields = "array<struct<doc_id: string, title: string, path: string, page_count: bigint, char_count: bigint>>"
    rows = meta.select(F.posexplode(F.from_json(F.get_json_object("manifest", "$.source_documents"), fields)).alias("place", "s"))
    return rows.select("place", "s.*")


def _manifests(spark: SparkSession, d: str) -> DataFrame:
    """A manifest for each row of ``packs``; what is null there is missing in it."""
    fields = F.struct(
        "pack_version", "pack_id", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.struct("method", "chunk_size", "overlap", "tokenizer_name", "preserve_sentences").alias("chunker"),
        F.struct(F.col("embedder_name").alias("name"), F.lit("1").alias("version"), "dimensions").alias("embedder"),
        F.struct("features", F.lit(0).alias("chunk_count")).alias("indexer"),
        F.struct(F.lit("chunks.json").alias("chunks"), F.lit("embeddings.npy").alias("embeddings")).alias("files"),
    )
    return _read(spark, d, "packs").select("pack_id", F.to_json(fields).alias("manifest"))


def _rules(spark: SparkSession, d: str) -> DataFrame:
    return validate.manifest_rules(_manifests(spark, d))


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    return validate.coverage(_read(spark, d, "chunks"), _read(spark, d, "citations"))


def _verdict(spark: SparkSession, d: str) -> DataFrame:
    """Packs without a version are taken as written without a manifest or old metadata."""
    names = F.when(F.col("pack_version").isNull(), F.array(F.lit("chunks.json"), F.lit("embeddings.npy"))).otherwise(F.array(F.lit("chunks.json"), F.lit("embeddings.npy"), F.lit("manifest.json")))
    listed = _read(spark, d, "packs").select(F.col("pack_id").alias("pack"), F.explode(names).alias("member"))
    rules = _rules(spark, d).withColumnRenamed("pack_id", "pack")
    out = validate.verdict(validate.structure(listed), rules, _coverage(spark, d).withColumnRenamed("pack_id", "pack"))
    return out.select(F.col("pack").alias("pack_id"), "valid", F.coalesce("coverage_ok", F.lit(False)).alias("coverage_ok"))


def _formatted(spark: SparkSession, d: str) -> DataFrame:
    hits = tfidf.topk(_fitted(spark, d), _items(spark, d), 5)
    return citations.render(hits.join(_read(spark, d, "documents").select(F.col("doc_id").alias("chunk_index"), F.col("text").alias("chunk")), "chunk_index"))


def _streamed(spark: SparkSession, d: str) -> DataFrame:
    """Documents read as a stream until none is left, chunked in fixed mode, and counted from what was written."""
    ship(spark)
    rows = ingest.parquet(spark, f"{d}/documents.parquet").select("doc_id", "text")
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    sink = lambda df, n: chunk.chunk(df, 512, 50, False).select("doc_id", "chunk_id").write.mode("overwrite").parquet(f"{place}/out/batch={n}")
    ingest.append(rows, place, f"{place}/state", sink).awaitTermination()
    return spark.read.parquet(f"{place}/out").groupBy("doc_id").agg(F.count("*").alias("chunks"))


def _joined(c: str) -> F.Column:
    return F.array_join(F.coalesce(c, F.array().cast("array<int>")), ",").alias(c)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The five best chunks for each benchmark item by TF-IDF, with their citations."""
    rows = chunk.chunk(_read(spark, d, "documents"), 512, 50)
    rows = rows.withColumn("chunk_index", F.col("doc_id") * 100_000 + F.col("chunk_id"))
    hits = tfidf.topk(tfidf.fit(rows, "chunk_index"), _items(spark, d), 5)
    cites = rows.select("chunk_index", F.col("doc_id").alias("cited_doc"), "start_char", "end_char", "snippet")
    return hits.join(cites, "chunk_index", "left").select("query_id", "rank", "chunk_index", "score", "cited_doc", "start_char", "end_char", "snippet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query for each operator."""
    t = _read
    return {
        "token_count_estimate": lambda s, d: t(s, d, "documents").where("text is not null").select("doc_id", chunk.token_count("text").alias("token_count")),
        "chunk_fixed_512_50": _chunked(512, 50, False),
        "chunk_fixed_200_30": _chunked(200, 30, False),
        "chunk_sentence_512_50": _chunked(512, 50, True),
        "chunk_sentence_200_30": _chunked(200, 30, True),
        "chunk_no_overlap": _chunked(128, 0, True),
        "chunk_counts_per_doc": lambda s, d: chunk.chunk(t(s, d, "documents"), 512, 50, False).groupBy("doc_id").agg(F.count("*").alias("chunks")),
        "chunk_info": lambda s, d: chunk.info(t(s, d, "chunks")),
        "chunk_snippet": lambda s, d: t(s, d, "chunks").select("chunk_index", chunk.snippet("text").alias("snippet")),
        "paragraph_boundaries": lambda s, d: t(s, d, "chunks").where("text is not null").select("chunk_index", F.array_join(chunk.paragraph_boundaries("text"), ",").alias("boundaries")),
        "pack_stats": lambda s, d: dense.stats(t(s, d, "chunks"), t(s, d, "chunk_vectors"), t(s, d, "citations")).withColumn("avg_chunk_length", F.round("avg_chunk_length", 6)),
        "char_histogram_embedding": lambda s, d: embed.histogram_long(t(s, d, "benchmark_items"), "item_id").withColumn("share", F.round("share", 6)),
        "embedder_hash": lambda s, d: t(s, d, "packs").select("pack_id", embed.fingerprint(F.col("embedder_name"), F.col("dimensions")).alias("hash")),
        "hash_embedding_props": lambda s, d: embed.stand_in(t(s, d, "benchmark_items")).select("item_id", F.size("embedding").alias("dimension"), F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)), 5).alias("norm")),
        "register_latest": lambda s, d: enrich.register(t(s, d, "source_documents")).select("doc_id", "seq", "title", "path", "page_count", "first_seq"),
        "index_metadata": lambda s, d: enrich.index_metadata(t(s, d, "source_documents"), t(s, d, "chunks")),
        "page_line_estimate": lambda s, d: t(s, d, "chunks").select("chunk_index", enrich.page("start_char").alias("page_number"), enrich.line("start_char").alias("line_number")),
        "term_frequency": lambda s, d: enrich.term_frequency(t(s, d, "documents"), ["doc_id"]),
        "term_frequency_stats": lambda s, d: t(s, d, "documents").select("doc_id", enrich.words("text").alias("w")).where("size(w) > 0").select("doc_id", F.size("w").alias("document_length"), F.size(F.array_distinct("w")).alias("unique_terms")),
        "l2_normalize": lambda s, d: t(s, d, "embeddings").select("vec_id", F.posexplode(dense.unit("embedding")).alias("place", "value")).withColumn("value", F.round("value", 6)),
        "cosine_topk": _cosine("vec_id = 0", 10),
        "cosine_topk_batch": _cosine("vec_id % 50 = 0", 10),
        "cosine_self_top1": _cosine("vec_id % 50 = 0", 1),
        "text_dense_topk": _text_dense,
        "citations": lambda s, d: citations.project(t(s, d, "chunks")).withColumn("paragraph_boundaries", _joined("paragraph_boundaries")),
        "citations_cumulative": lambda s, d: citations.cumulative(chunk.chunk(t(s, d, "documents"), 200, 30, False)),
        "citation_lookup": lambda s, d: t(s, d, "chunks").select("chunk_index").join(citations.lookup(t(s, d, "citations")), "chunk_index", "left").select("chunk_index", "citation_id", "snippet"),
        "search_with_citations": _with_citations,
        "tfidf_vocab": lambda s, d: _fitted(s, d).vocabulary.select("term", "feature_index", "df", "ctf"),
        "tfidf_idf": lambda s, d: _fitted(s, d).vocabulary.select("term", F.round("idf", 6).alias("idf")),
        "tfidf_weights": lambda s, d: _fitted(s, d).weights.select("chunk_index", "term", "tf", F.round("weight", 6).alias("weight")),
        "tfidf_topk": lambda s, d: tfidf.topk(_fitted(s, d), _items(s, d), 5),
        "tfidf_sidecar_roundtrip": _sidecar,
        "tfidf_top_features": lambda s, d: tfidf.top_features(_fitted(s, d), 10),
        "dense_vs_lexical": lambda s, d: tfidf.compare(_text_dense(s, d), tfidf.topk(_fitted(s, d), _items(s, d), 5)),
        "result_format": _formatted,
        "pack_roundtrip_zip": _roundtrip(".zip"),
        "pack_roundtrip_dir": _roundtrip("", compress=False),
        "pack_roundtrip_legacy": _roundtrip(".zip", legacy=True),
        "pack_roundtrip_csv": _roundtrip("", "csv", compress=False),
        "pack_manifest_sources": _sources,
        "enriched_terms": lambda s, d: enrich.enrich(t(s, d, "chunks"), ("bm25_tf_idf",)).select("chunk_index", F.explode("bm25_features.term_frequency").alias("term", "tf")).withColumn("tf", F.col("tf").cast("long")),
        "chunk_fixed_repeated_ids": lambda s, d: chunk.chunk(t(s, d, "chunks").where("text is not null").select("doc_id", "text"), 64, 10, False).groupBy("doc_id", "chunk_id").agg(F.count("*").alias("n"), F.sum("char_count").alias("characters")),
        "stream_window_counts": lambda s, d: ingest.counted_until_empty(s, f"{d}/documents.parquet", _place(s, "windows")),
        "pack_citations_roundtrip": _cited,
        "manifest_validation": _rules,
        "citation_coverage": _coverage,
        "pack_verdict": _verdict,
        "suffix_filter_sorted": lambda s, d: pack.listing(t(s, d, "source_documents"), "path", ".pdf"),
        "document_text_from_pages": lambda s, d: pages.from_pages(t(s, d, "chunks"), "doc_id", "chunk_index").select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars")),
        "stream_chunk_counts": _streamed,
    }
