"""Problem 6: splitting oversized items at natural boundaries.

Method: recursive bisection. An item above its limit is cut at the strongest boundary near its midpoint, halves
that still exceed the limit less the overlap are cut again, and the overlaps are attached last.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import ship
from packloom.functions.text import not_blank

PER_TOKEN = 4
# The kinds of boundary, strongest first: blank line, line break, sentence end, clause, blank.
BOUNDARIES = [
    re.compile(r"\n[ \t\r]*\n\s*"),
    re.compile(r"\n\s*"),
    re.compile(r"[.!?…।]+[\"'”’»)\]]*\s+|[。！？]+[」』”’）]*"),
    re.compile(r"[,;:–—]\s+|[，、；：]|(?<=[ก-๎])\s+(?=[ก-๎])"),
    re.compile(r"\s+"),
]


def _whole(text: str, at: int) -> bool:
    """Whether a cut before ``text[at]`` leaves marks with the letters they belong to."""
    return at >= len(text) or not (unicodedata.combining(text[at]) or unicodedata.category(text[at]) in ("Mn", "Mc", "Me") or text[at] == "‍" or text[at - 1] == "‍")


def cuts(lo: int, hi: int, room: int, text: str | None, text_at: int = 0) -> list[int]:
    """Ends of the cores of [lo, hi), each at most ``room`` long; ``text`` covers [text_at, text_at + len(text))."""
    text = text or ""
    places = [[p for m in b.finditer(text) if lo < (p := text_at + m.end()) < hi] for b in BOUNDARIES]
    ends, todo = [], [(lo, hi)]
    while todo:
        a, b = todo.pop()
        if b - a <= room:
            ends.append(b)
            continue
        mid, best = (a + b) // 2, None
        for reach in ((b - a) // 4, b - a):  # near the midpoint first, then anywhere inside
            for found in places:
                i = bisect_left(found, mid)
                near = [p for p in found[max(0, i - 1) : i + 1] if a < p < b and abs(p - mid) <= reach]
                if near:
                    best = min(near, key=lambda p: (abs(p - mid), p))
                    break
            if best is not None:
                break
        if best is None:
            best = mid
            while best - 1 > a and text_at < best < text_at + len(text) and not _whole(text, best - text_at):
                best -= 1
            if best - 1 <= a:
                best = mid
        todo += [(best, b), (a, best)]
    return ends


def pieces_of(lo: int, hi: int, size: int, overlap: int, text: str | None, text_at: int = 0) -> list[tuple[int, int]]:
    """Offsets of the pieces of one item with a limit of ``size`` tokens."""
    most = PER_TOKEN * size + PER_TOKEN - 1
    if hi - lo <= most:
        return [(lo, hi)]
    shared = PER_TOKEN * max(0, min(overlap, size - 1))
    start, out = lo, []
    for end in cuts(lo, hi, most - shared, text, text_at):
        out.append((max(lo, start - shared), end))
        start = end
    return out


def _split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = []
        for x in f.itertuples(index=False):
            text = x.text if isinstance(x.text, str) else None
            at = 0 if text is None else int(x.text_at)
            for i, (a, b) in enumerate(pieces_of(int(x.lo), int(x.hi), int(x.size), int(x.overlap), text, at)):
                inside = text is not None and at <= a and b <= at + len(text)
                rows.append((x.tab, x.id, i, a, b, max(1, (b - a) // PER_TOKEN), text[a - at : b - at] if inside else None))
        yield pd.DataFrame(rows, columns=["tab", "id", "piece", "start_char", "end_char", "tokens", "text"])


def pieces(items: DataFrame) -> DataFrame:
    """The pieces of the items above their limit: (``tab``, ``id``, ``piece``, ``start_char``, ``end_char``, ``tokens``, ``text``).

    ``items`` has ``tab``, ``id``, ``lo``, ``hi``, ``text``, ``text_at``, ``size`` and ``overlap``; the span [lo, hi)
    counts in the coordinates in which ``text`` begins at ``text_at``; where text is missing, cuts fall at midpoints.
    Items within the limit, with a null or reversed span, or with a null or non-positive limit give no rows; a null
    overlap is 0. Pieces cover the item without a gap and share exactly the overlap with the piece before. Repeated
    items are split each. Very long texts are cut whole, in one task each.
    """
    ship(items.sparkSession)
    over = items.where("size > 0 and hi > lo and greatest(1, (hi - lo) div 4) > size").withColumn("overlap", F.coalesce("overlap", F.lit(0)))
    over = over.select("tab", F.col("id").cast("long"), F.col("lo").cast("long"), F.col("hi").cast("long"), "text", F.col("text_at").cast("long"), "size", "overlap")
    schema = "tab string, id long, piece int, start_char long, end_char long, tokens long, text string"
    return over.mapInPandas(_split, schema)


def pack_items(chunks: DataFrame, citations: DataFrame, packs: DataFrame) -> DataFrame:
    """The chunk texts and citation spans of packs as ``pieces`` takes them.

    A chunk's offsets count in its own text, a citation's in its document; its text is the part of its chunk that
    covers it. Blank chunks, spans with a null end and rows of unknown packs are left out. Of repeated packs the
    smallest limit holds, of repeated chunks the greatest text.
    """
    limits = packs.where("pack_id is not null and chunk_size is not null").groupBy("pack_id").agg(F.min(F.struct("chunk_size", F.coalesce("overlap", F.lit(0)).alias("overlap"))).alias("p"))
    limits = limits.select("pack_id", F.col("p.chunk_size").alias("size"), F.col("p.overlap").alias("overlap"))
    whole = chunks.where(not_blank("text")).join(limits, "pack_id")
    whole = whole.select(F.lit("chunks").alias("tab"), F.col("chunk_index").alias("id"), F.lit(0).alias("lo"), F.length("text").alias("hi"), "text", F.lit(0).alias("text_at"), "size", "overlap")
    spans = citations.where("start_char is not null and end_char > start_char").join(limits, "pack_id").where("greatest(1, (end_char - start_char) div 4) > size")
    spans = spans.select(F.lit("citations").alias("tab"), F.col("citation_id").alias("id"), F.col("start_char").alias("lo"), F.col("end_char").alias("hi"), "chunk_index", "size", "overlap")
    cited = chunks.select("chunk_index", "start_char", "text").where("start_char is not null").join(spans.select("chunk_index").distinct(), "chunk_index", "left_semi")
    cited = cited.groupBy("chunk_index").agg(F.max(F.struct("text", "start_char")).alias("c"))
    spans = spans.join(cited, "chunk_index", "left").select("tab", "id", "lo", "hi", F.col("c.text").alias("text"), F.coalesce("c.start_char", F.lit(0)).alias("text_at"), "size", "overlap")
    return whole.unionByName(spans)
