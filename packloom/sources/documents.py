"""Documents from files and from pages of extracted text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packloom.functions.session import ship
from packloom.functions.text import not_blank


def from_pages(pages: DataFrame, key: str = "doc_id", page: str = "page", text: str = "text") -> DataFrame:
    """Each document's pages in order, joined without a separator; null pages are empty, blank documents left out."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.coalesce(text, F.lit("")).alias("t"))))
    return pages.groupBy(key).agg(F.array_join(F.transform(ordered, lambda x: x["t"]), "").alias("text")).where(not_blank("text"))


def _pages(batches: Iterator[pa.RecordBatch], extract: Callable[[bytes], list[str | None]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            try:
                texts, error = list(extract(content)), None
            except Exception as e:  # noqa: BLE001 - a file that can't be read is a row, not the end of the job
                texts, error = [None], f"{type(e).__name__}: {e}"
            n = len(texts)
            yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(range(1, n + 1), pa.int32()), pa.array(texts, pa.string()), pa.array([error] * n, pa.string())], ["path", "page", "text", "error"])


def pages_of_files(spark: SparkSession, path: str, extract: Callable[[bytes], list[str | None]], suffix: str = ".pdf") -> DataFrame:
    """The pages of all files under ``path`` that end with ``suffix``: (``path``, ``page``, ``text``, ``error``).

    ``extract`` gives the texts of a file's pages from its bytes; which library it uses for PDF is the caller's. A
    file it fails on is one row with an error.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.lower("path").endswith(suffix.lower()))
    return files.select("path", "content").mapInArrow(lambda it: _pages(it, extract), "path string, page int, text string, error string")
