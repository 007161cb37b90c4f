"""Chunking: one document becomes overlapping chunks with exact offsets into its stripped text."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import ship
from packloom.functions.text import WS, strip

PER_TOKEN = 4
SNIPPET = 200
ENDS = re.compile("[.!?](?=[" + re.escape(WS) + "])")


def check(size: int, overlap: int) -> None:
    """Raise ValueError unless 0 <= overlap < size."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    if overlap < 0:
        raise ValueError("overlap must not be negative")
    if overlap >= size:
        raise ValueError("overlap must be smaller than chunk size")


def token_count(text: Column | str) -> Column:
    """Estimated tokens: a quarter of the characters, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / PER_TOKEN).cast("int"))


def snippet(text: Column | str, most: int = SNIPPET) -> Column:
    """The first ``most`` characters, with dots after them if there are more."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def paragraph_boundaries(text: Column | str) -> Column:
    """Offsets of the blank lines (two line feeds, left to right, never overlapping) within ``text``."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(text, "\n\n", -1), lambda p: F.length(p) + 2)
    sums = F.aggregate(
        F.slice(parts, 1, F.size(parts) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["all"], acc["at"] + n - 2).alias("all")),
    )
    return sums["all"]


def spans(text: str, size: int, overlap: int, sentences: bool, count: Callable[[str], int] | None = None) -> list[tuple[int, int]]:
    """Offsets of the windows of a stripped text. ``count`` counts tokens; without it they are estimated.

    A window ends at the last sentence end inside it, if ``sentences``; the next one begins ``overlap`` tokens
    before that end but at least one character on. Beginnings always move forward.
    """
    n = len(text)
    reach = _reach(text, count)
    if not n:
        return []
    if (count(text) if count else max(1, n // PER_TOKEN)) <= size:
        return [(0, n)]
    ends = [m.start() for m in ENDS.finditer(text)] if sentences else []
    out, start = [], 0
    while True:
        end = reach(start, size)
        if ends and end < n:
            i = bisect_right(ends, end - 1) - 1
            if i >= 0 and ends[i] > start:
                end = ends[i] + 1
        end = max(end, start + 1)
        out.append((start, end))
        if end >= n:
            return out
        start = max(start + 1, end - min(end - start, PER_TOKEN * overlap)) if overlap else end


def _reach(text: str, count: Callable[[str], int] | None) -> Callable[[int, int], int]:
    """The furthest end of a window of so many tokens from an offset."""
    n = len(text)
    if count is None:
        return lambda start, size: min(start + PER_TOKEN * size, n)

    def far(start: int, size: int) -> int:
        low, high = start, n
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if count(text[start:mid]) <= size else (low, mid - 1)
        return low

    return far


def _chunks(batches: Iterator[pa.RecordBatch], size: int, overlap: int, sentences: bool, tokenizer: Callable[[], Callable[[str], int]] | None) -> Iterator[pa.RecordBatch]:
    count = tokenizer() if tokenizer else None
    for batch in batches:
        at, ids, texts, starts, ends, tokens = [], [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            text = text.strip(WS)
            n = 0
            for a, b in spans(text, size, overlap, sentences, count):
                part = text[a:b]
                bare = part.strip(WS)
                if bare:
                    lead = a + len(part) - len(part.lstrip(WS))
                    at.append(i), ids.append(n), texts.append(bare), starts.append(lead), ends.append(lead + len(bare))
                    tokens.append(count(bare) if count else max(1, len(bare) // PER_TOKEN))
                    n += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at, pa.int64())), pa.array(ids, pa.int32()), pa.array(texts, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(tokens, pa.int32())],
            ["doc_id", "chunk_id", "text", "start_char", "end_char", "token_count"],
        )


def _dressed(chunks: DataFrame) -> DataFrame:
    return chunks.withColumns({"char_count": F.length("text"), "paragraph_boundaries": paragraph_boundaries("text"), "snippet": snippet("text")})


def chunk(documents: DataFrame, size: int = 512, overlap: int = 50, sentences: bool = True, tokenizer: Callable[[], Callable[[str], int]] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of ``documents``, with ids that count up within each document.

    Null and blank texts have no chunks. Windows that hold only white space are left out and take no id. Offsets
    count in the text without white space at its ends. Without sentence ends to respect, and without a
    ``tokenizer`` (called once for each task, to give a counting function), windows have a closed form and no
    Python runs. Repeated rows are chunked and numbered each on their own; very long texts within one task.
    """
    check(size, overlap)
    if not sentences and tokenizer is None:
        return _dressed(_fixed(documents, size, overlap, key, text))
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.where(F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {kind}, chunk_id int, text string, start_char int, end_char int, token_count int"
    return _dressed(rows.mapInArrow(lambda it: _chunks(it, size, overlap, sentences, tokenizer), schema))


def _fixed(documents: DataFrame, size: int, overlap: int, key: str, text: str) -> DataFrame:
    """Windows in closed form, numbered within their row, so nothing is shuffled."""
    step, width = PER_TOKEN * (size - overlap), PER_TOKEN * size
    t = documents.select(F.col(key).alias("doc_id"), strip(text).alias("t")).where(F.length("t") > 0)
    n = F.length("t")
    last = F.when(n <= width + PER_TOKEN - 1, 0).otherwise(F.ceil((n - width) / step).cast("int"))
    t = t.withColumn("w", F.when(last > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("t"), i * step + 1, F.lit(width)))).otherwise(F.array("t")))
    t = t.withColumn("w", F.transform("w", lambda x, i: F.struct((i * step + F.length(x) - F.length(F.ltrim(x, F.lit(WS)))).alias("a"), strip(x).alias("bare"))))
    w = t.select("doc_id", F.posexplode(F.filter("w", lambda x: F.length(x["bare"]) > 0)).alias("chunk_id", "x"))
    w = w.select("doc_id", "chunk_id", F.col("x.bare").alias("text"), F.col("x.a").alias("start_char"))
    return w.select("doc_id", "chunk_id", "text", "start_char", (F.col("start_char") + F.length("text")).alias("end_char"), token_count("text").alias("token_count"))


def info(chunks: DataFrame) -> DataFrame:
    """Each chunk's counts and a preview of 100 characters."""
    return chunks.select("doc_id", "chunk_id", "token_count", "char_count", snippet("text", 100).alias("preview"))


def metadata(size: int, overlap: int, sentences: bool = True, tokenizer: str | None = None) -> dict:
    """What a manifest says of the chunker."""
    return {"method": "token_based", "chunk_size": size, "overlap": overlap, "tokenizer_name": tokenizer or "estimate", "preserve_sentences": sentences}
