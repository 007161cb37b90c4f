"""Command line: ``python -m packloom.cli search|stats|validate PACK ...``."""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from packloom.operators import citations, dense, embed, tfidf, validate
from packloom.sources import pack


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="packloom", description="Query and validate retrieval packs.")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("search", help="best chunks for a query")
    s.add_argument("pack")
    s.add_argument("-q", "--query", required=True)
    s.add_argument("-k", type=int, default=5)
    s.add_argument("--method", choices=("tfidf", "dense"), default="tfidf")
    s.add_argument("--no-scores", action="store_true")
    s.add_argument("--max-length", type=int, default=200)
    s.add_argument("--export", help="folder for the fitted TF-IDF tables")
    sub.add_parser("stats", help="numbers about a pack").add_argument("pack")
    v = sub.add_parser("validate", help="check a pack; exit code 0 if it is valid")
    v.add_argument("pack")
    v.add_argument("--strict", action="store_true", help="too few citations make a pack invalid")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = _arguments(argv)
    spark = SparkSession.builder.getOrCreate()
    if a.command == "validate":
        return _validate(spark, a)
    chunks = pack.read(spark, a.pack, "chunks")
    if a.command == "stats":
        row = dense.stats(chunks, pack.read(spark, a.pack, "embeddings"), pack.read(spark, a.pack, "citations")).first().asDict()
        meta = json.loads(pack.read(spark, a.pack, "manifest").first()["manifest"])
        row |= {"pack_version": meta.get("pack_version", "legacy"), "model": meta.get("embedder", {}).get("name") or meta.get("model_used", "unknown")}
        print(json.dumps(row, default=str))
        return 0
    began = time.time()
    asked = spark.createDataFrame([(0, a.query)], "query_id long, text string")
    if a.method == "tfidf":
        model = tfidf.fit(chunks, "chunk_index")
        if a.export:
            tfidf.export(model, a.export)
        hits = tfidf.topk(model, asked, a.k)
    else:
        hits = dense.topk(pack.read(spark, a.pack, "embeddings"), asked.withColumn("embedding", embed.histogram("text")), a.k, "chunk_index")
    hits = hits.join(chunks.select("chunk_index", F.col("text").alias("chunk")), "chunk_index")
    out = citations.render(hits, not a.no_scores, a.max_length).first()
    print(out["output"] if out else "No results found.")
    if (took := time.time() - began) > 0.2:
        print(f"search took {took * 1000:.0f} ms", file=sys.stderr)
    return 0


def _validate(spark: SparkSession, a: argparse.Namespace) -> int:
    name = os.path.basename(a.pack.rstrip("/"))
    listed = pack.members(spark, a.pack)
    if not listed.limit(1).count():
        print(f"{a.pack}: not a pack")
        return 1
    found = validate.structure(listed).first()
    bad = list(found["errors"]) + ([found["warning"]] if found["warning"] else [])
    ok = found["structure_ok"]
    meta = pack.read(spark, a.pack, "manifest").where("member = 'manifest.json' and manifest <> '{}'").select("pack", "manifest")
    broken = [r["rule"] for r in validate.manifest_rules(meta).where("not ok").collect()]
    ok = ok and not broken
    if ok and a.strict:
        both = [pack.read(spark, a.pack, part).select("pack") for part in ("chunks", "citations")]
        ok = validate.coverage(*both, "pack").first()["coverage_ok"]
        bad += [] if ok else ["too few citations"]
    for line in [*bad, *[f"manifest breaks {r}" for r in broken]]:
        print(line)
    print(f"{name}: {'valid' if ok else 'invalid'}")
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
