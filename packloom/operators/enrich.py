"""Enrichment: registry of source documents, page and line estimates, term frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions.text import JAVA_CLASS, strip

PER_PAGE, PER_LINE = 2000, 80


def register(events: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """The last registration of each document, placed where it was first seen (``first_seq``).

    Rows without a key are left out; of rows with the same ``order`` the greatest by its other columns holds.
    """
    rest = [c for c in events.columns if c not in (key, order)]
    last = F.max(F.struct(order, *rest)).alias("last")
    out = events.where(F.col(key).isNotNull()).groupBy(key).agg(last, F.min(order).alias("first_seq"))
    return out.select(key, *[F.col(f"last.{c}").alias(c) for c in (order, *rest)], "first_seq")


def page(start: Column | str) -> Column:
    """The page a character offset falls on, by estimate."""
    return F.floor((F.col(start) if isinstance(start, str) else start) / PER_PAGE).cast("int") + 1


def line(start: Column | str) -> Column:
    """The line a character offset falls on, by estimate."""
    return F.floor((F.col(start) if isinstance(start, str) else start) / PER_LINE).cast("int") + 1


def words(text: Column | str) -> Column:
    """The lower-cased words between white space; none for a blank text."""
    bare = strip(F.lower(text))
    return F.when(F.length(bare) > 0, F.split(bare, f"[{JAVA_CLASS}]+")).otherwise(F.array().cast("array<string>"))


def term_frequency(chunks: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """How often each word occurs in each chunk: (*keys, ``term``, ``tf``)."""
    return chunks.select(*keys, F.explode(words(text)).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def enrich(chunks: DataFrame, features: tuple[str, ...] = (), now: Column | None = None) -> DataFrame:
    """Chunks with ``indexed_at``, ``features``, page and line; with the feature ``bm25_tf_idf`` also word counts."""
    out = chunks.withColumns(
        {"indexed_at": now if now is not None else F.current_timestamp(), "features": F.array(*map(F.lit, features)).cast("array<string>"), "page_number": page("start_char"), "line_number": line("start_char")}
    )
    if "bm25_tf_idf" not in features:
        return out
    # no lambda below refers to a whole array: the optimizer would put the array's making into the lambda
    w = F.array_sort(words("text"))
    first = F.zip_with(w, F.concat(F.array(F.lit("")), w), lambda x, before: x != before)  # sorted, a word's copies are one run
    begins = F.filter(F.transform(first, lambda f, i: F.when(f, i)), lambda i: i.isNotNull())
    ends = F.concat(F.slice(begins, 2, F.greatest(F.size(begins) - 1, F.lit(0))), F.array(F.size(w)))
    kinds, counts = F.array_distinct(w), F.zip_with(begins, F.slice(ends, 1, F.size(begins)), lambda i, j: j - i)
    counted = F.map_from_arrays(kinds, counts)
    return out.withColumn("bm25_features", F.struct(counted.alias("term_frequency"), F.size(w).alias("document_length"), F.size(kinds).alias("unique_terms")))


def index_metadata(registry: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: how many documents are registered and how many chunks there are."""
    documents = registry.agg(F.count_distinct("doc_id").alias("document_count"))
    return documents.join(chunks.agg(F.count("*").alias("chunk_count")), how="cross")
