"""Validation: rules on pack structure, manifest and citation coverage, as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED = ("chunks.json", "embeddings.npy")
COVERAGE = 95.0


def structure(members: DataFrame) -> DataFrame:
    """For each pack of a listing (``pack``, ``member``, perhaps ``error``): what is wrong with it, and whether only old metadata is there."""
    told = F.collect_set("error") if "error" in members.columns else F.array().cast("array<string>")
    have = members.groupBy("pack").agg(F.collect_set("member").alias("m"), told.alias("told"))
    has = lambda name: F.array_contains("m", name)
    lacks = F.array(*[F.when(~has(n), F.lit(f"{n} is missing")) for n in REQUIRED], F.when(~has("manifest.json") & ~has("metadata.json"), F.lit("neither manifest.json nor metadata.json is there")))
    warning = F.when(~has("manifest.json") & has("metadata.json"), F.lit("an old pack: metadata.json without manifest.json"))
    errors = F.when(F.size("told") > 0, F.col("told")).otherwise(F.filter(lacks, lambda e: e.isNotNull()))
    return have.select("pack", (F.size(errors) == 0).alias("structure_ok"), errors.alias("errors"), warning.alias("warning"), has("citations.jsonl").alias("has_citations"))


def quick(manifests: DataFrame, column: str = "manifest") -> DataFrame:
    """Of packs with ``metadata.json`` (*other columns, JSON text): whether it names the pack, its model and its numbers."""
    v = F.try_parse_json(column)
    at = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    ok = v.isNotNull() & reduce(lambda a, b: a & b, [F.coalesce(F.length(at(k)) > 0, F.lit(False)) for k in ("pack_name", "created_at", "model_used", "num_chunks", "embedding_dim")])
    return manifests.withColumn("quick_ok", ok).drop(column)


def _kind(v: Column, *kinds: str) -> Column:
    name = F.lower(F.schema_of_variant(v))
    return F.coalesce(reduce(lambda a, b: a | b, [name.startswith(k) for k in kinds]), F.lit(False))


def manifest_rules(manifests: DataFrame, column: str = "manifest") -> DataFrame:
    """The 18 rules on a manifest's JSON text: a row (*other columns, ``rule``, ``ok``) for each.

    A rule on an optional part holds where that part is missing; text that isn't JSON breaks every rule.
    """
    rows = manifests.withColumn("v", F.try_parse_json(column))
    v = F.col("v")
    at = lambda path: F.try_variant_get(v, path, "variant")
    text = lambda p: _kind(at(p), "string")
    whole = lambda p: _kind(at(p), "bigint", "int", "smallint", "tinyint")
    least = lambda p, n: whole(p) & F.coalesce(F.try_variant_get(v, p, "bigint") >= n, F.lit(False))
    absent = lambda p: at(p).isNull()
    present = lambda *ps: reduce(lambda a, b: a & b, [~absent(p) for p in ps])
    every = lambda p, test: absent(p) | (_kind(at(p), "array") & F.coalesce(F.forall(F.try_variant_get(v, p, "array<variant>"), test), F.lit(False)))
    field = lambda x, p: F.try_variant_get(x, f"$.{p}", "variant")
    or_null = lambda x, p: field(x, p).isNull() | _kind(field(x, p), "void") | (_kind(field(x, p), "bigint", "int", "smallint", "tinyint") & F.coalesce(F.try_variant_get(x, f"$.{p}", "bigint") >= 0, F.lit(False)))
    rules = [
        present(*[f"$.{k}" for k in ("pack_version", "pack_id", "created_at", "chunker", "embedder", "indexer", "files")]),
        F.coalesce(F.try_variant_get(v, "$.pack_version", "string") == "1.1", F.lit(False)) & text("$.pack_version"),
        text("$.pack_id"),
        text("$.created_at"),
        present("$.chunker.method", "$.chunker.chunk_size", "$.chunker.overlap"),
        absent("$.chunker.chunk_size") | least("$.chunker.chunk_size", 1),
        absent("$.chunker.overlap") | least("$.chunker.overlap", 0),
        (absent("$.chunker.tokenizer_name") | text("$.chunker.tokenizer_name")) & (absent("$.chunker.preserve_sentences") | _kind(at("$.chunker.preserve_sentences"), "boolean")),
        present("$.embedder.name", "$.embedder.version", "$.embedder.dimensions"),
        absent("$.embedder.dimensions") | least("$.embedder.dimensions", 1),
        absent("$.embedder.hash") | text("$.embedder.hash"),
        _kind(at("$.indexer"), "object") & (absent("$.indexer.document_count") | least("$.indexer.document_count", 0)) & (absent("$.indexer.chunk_count") | least("$.indexer.chunk_count", 0)),
        every("$.indexer.features", lambda x: _kind(x, "string")),
        present("$.files.chunks", "$.files.embeddings"),
        reduce(lambda a, b: a & b, [absent(f"$.files.{k}") | text(f"$.files.{k}") for k in ("chunks", "embeddings", "citations")]) & (absent("$.files.metadata") | _kind(at("$.files.metadata"), "object")),
        every("$.source_documents", lambda x: field(x, "doc_id").isNotNull() & field(x, "title").isNotNull()),
        every("$.source_documents", lambda x: reduce(lambda a, b: a & b, [field(x, p).isNull() | _kind(field(x, p), "string") for p in ("path", "timestamp")])),
        every("$.source_documents", lambda x: or_null(x, "page_count") & or_null(x, "char_count")),
    ]
    named = F.array(*[F.struct(F.lit(f"R{i}").alias("rule"), (v.isNotNull() & F.coalesce(r, F.lit(False))).alias("ok")) for i, r in enumerate(rules, 1)])
    return rows.select(*manifests.columns, F.explode(named).alias("r")).select(*manifests.columns, "r.rule", "r.ok").drop(column)


def coverage(chunks: DataFrame, citations: DataFrame, key: str = "pack_id") -> DataFrame:
    """For each pack its numbers of chunks and citations, the share in percent and whether it is enough."""
    c = chunks.groupBy(key).agg(F.count("*").alias("num_chunks"))
    m = citations.groupBy(key).agg(F.count("*").alias("num_citations"))
    out = c.join(m, key, "full_outer").select(key, *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in ("num_chunks", "num_citations")])
    share = F.when(F.col("num_chunks") > 0, F.col("num_citations") / F.col("num_chunks") * 100).otherwise(0.0)
    return out.select(key, "num_chunks", "num_citations", F.round(share, 6).alias("coverage"), (share >= COVERAGE).alias("coverage_ok"))


def verdict(structures: DataFrame, rules: DataFrame, coverages: DataFrame | None = None, key: str = "pack", strict: bool = False) -> DataFrame:
    """Whether each pack is valid: its structure and its manifest; its coverage too only if ``strict``.

    A pack without manifest rows has no manifest to break.
    """
    good = rules.groupBy(key).agg(F.bool_and("ok").alias("manifest_ok"), F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("rule")))).alias("broken"))
    out = structures.join(good, key, "left").withColumn("manifest_ok", F.coalesce("manifest_ok", F.lit(True)))
    valid = F.col("structure_ok") & F.col("manifest_ok")
    if coverages is not None:
        out = out.join(coverages.select(key, "coverage_ok"), key, "left")
        if strict:
            valid = valid & F.coalesce("coverage_ok", F.lit(False))
    return out.withColumn("valid", valid)
