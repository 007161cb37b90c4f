"""Citations: their projection from chunks, their lookup by hit, and the text form of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packloom.operators.chunk import snippet

FIELDS = {
    "chunk_id": "int", "doc_id": "string", "start_char": "int", "end_char": "int", "snippet": "string", "paragraph_boundaries": "array<int>",
    "page_number": "int", "line_number": "int", "context_before": "string", "context_after": "string",
}


def project(chunks: DataFrame) -> DataFrame:
    """The citation of each chunk; what a chunk lacks gets its default."""
    have = set(chunks.columns)
    get = lambda c, default: F.coalesce(F.col(c), default) if c in have else default
    none = F.lit(None)
    values = {
        "chunk_id": get("chunk_id", F.lit(0)), "doc_id": get("doc_id", F.lit("unknown")), "start_char": get("start_char", F.lit(0)), "end_char": get("end_char", F.lit(0)),
        "snippet": snippet("text"), "paragraph_boundaries": get("paragraph_boundaries", F.array().cast("array<int>")), "page_number": get("page_number", none),
        "line_number": get("line_number", none), "context_before": F.lit(""), "context_after": F.lit(""),
    }
    return chunks.select(*[values[c].cast(FIELDS[c]).alias(c) if c != "doc_id" else values[c].alias(c) for c in FIELDS])


def cumulative(chunks: DataFrame) -> DataFrame:
    """Citations whose offsets add up the lengths of a document's chunks, whatever their overlap."""
    order = Window.partitionBy("doc_id").orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, 0)
    n = F.length("text")
    end = F.sum(n).over(order)
    name = F.concat(F.col("doc_id").cast("string"), F.lit("#"), F.format_string("%05d", "chunk_id"))
    return chunks.select(name.alias("chunk_ref"), F.format_string("p-%04d", "chunk_id").alias("para_id"), (end - n).alias("start_char"), end.alias("end_char"), F.substring("text", 1, 200).alias("snippet"))


def lookup(citations: DataFrame, key: str = "chunk_index", order: str = "citation_id") -> DataFrame:
    """One citation for each chunk, the first by ``order``; citations without a chunk are left out."""
    rest = [c for c in citations.columns if c not in (key, order)]
    first = citations.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(order, *rest), order).alias("c"))
    return first.select(key, "c.*")


def attach(hits: DataFrame, citations: DataFrame, key: str = "chunk_index") -> DataFrame:
    """Hits with their citation, or nulls. Only citations of the hits are grouped: the hits' keys go first."""
    wanted = citations.join(hits.select(key).distinct(), key, "left_semi")
    return hits.join(lookup(wanted, key), key, "left")


def render(hits: DataFrame, scores: bool = True, most: int = 200) -> DataFrame:
    """Each query's hits as text, in rank order: (``query_id``, ``output``). Scores round half up as decimals."""
    preview = F.when(F.length("chunk") > most, F.concat(F.substring("chunk", 1, most), F.lit("..."))).otherwise(F.col("chunk"))
    score = F.concat(F.lit("[Score: "), F.format_string("%.4f", "score"), F.lit("] ")) if scores else F.lit("")
    entry = F.concat(F.col("rank").cast("string"), F.lit(". "), score, preview)
    all_of = F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry"))))
    return hits.groupBy("query_id").agg(F.array_join(F.transform(all_of, lambda x: x["entry"]), "\n\n").alias("output"))
