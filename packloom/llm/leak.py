"""Problem 7: evaluation texts inside training text.

Method: template canonicalisation. Words of a text become tokens: numbers, names and units become typed
placeholders, other words stay. Windows of twelve tokens are hash-joined between items and documents; the slots
behind the placeholders are then compared, which tells word-for-word passages from re-parameterised ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import settle, ship
from packloom.llm import chars

WINDOW = 12
FIXED = 4
"""A window with fewer plain words than this is joined on its very words: its template says too little."""
LARGEST = 28
"""A Bloom filter has at most 2 ** 28 bits, 32 MB; with more hashes in it, more of what it lets pass isn't in it, and the join finds that out."""
CHUNK = 19
"""Bits of a filter that one task sets, as a power of two."""
HOT = 20_000
"""Windows of documents with one key that a task joins; more go in several tasks."""
# Words of measurement that become the placeholder for units.
UNITS = "mm cm m km g kg mg t ml l s ms min h hz khz mhz ghz kb mb gb tb px pt percent prozent cento ciento cent процента секунд секунды seconds sekunden secondes segundos".split()
NUMBER, NAME, UNIT = np.uint64(11), np.uint64(13), np.uint64(17)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a batch of texts: their hashes, places and texts, all without a loop over words."""

    def __init__(self, texts: list[str]) -> None:
        table, expand = chars.word_table()
        texts = [t if t.isascii() or (chars.unicodedata.is_normalized("NFC", t) and expand.isdisjoint(t)) else chars.canonical(t) for t in texts]
        points, starts = chars.pack(texts)
        folded = table[points]
        kept = folded != 1
        # a separator after each text keeps words of neighbouring texts apart
        places = np.concatenate([[0], np.cumsum(kept)])[starts] + np.arange(len(starts))
        codes = np.zeros(places[-1] + 1, np.uint32)
        text_of = np.searchsorted(starts, np.flatnonzero(kept), side="right") - 1 if len(points) else np.zeros(0, np.int64)
        codes[np.arange(len(text_of)) + text_of] = folded[kept]
        inside = codes != 0
        edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
        self.codes, self.begin, self.end = codes, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.text = np.searchsorted(places, self.begin, side="right") - 1
        power = np.ones(len(codes) + 1, np.uint64)
        power[1:] = _ODD
        np.multiply.accumulate(power, out=power)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(codes.astype(np.uint64)) * power[: len(codes)])])
        back = np.ones(len(codes) + 1, np.uint64)
        back[1:] = _BACK
        np.multiply.accumulate(back, out=back)
        self.hash = _mix((sums[self.end] - sums[self.begin]) * back[self.begin])
        digit = (codes >= 50) & (codes <= 59)
        counted = np.concatenate([[0], np.cumsum(digit)])
        self.number = counted[self.end] > counted[self.begin]

    def string(self, i: int) -> str:
        return (self.codes[self.begin[i] : self.end[i]] - 2).astype(np.uint32).tobytes().decode("utf-32-le")

    def windows(self, plain: Bloom) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all windows, and the word at which each begins. ``plain`` holds the hashes of the vocabulary."""
        n = len(self.hash) - WINDOW + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        kind = self.kinds(plain)
        token = np.where(kind == 0, self.hash, np.array([0, NUMBER, NAME, UNIT], np.uint64)[kind])
        template, exact = np.zeros(n, np.uint64), np.full(n, np.uint64(7))
        for i in range(WINDOW):
            template = (template + token[i : i + n]) * _ODD
            exact = (exact + self.hash[i : i + n]) * _BACK
        fixed = np.concatenate([[0], np.cumsum(kind == 0)])
        enough = fixed[WINDOW:] - fixed[:-WINDOW] >= FIXED
        at = np.flatnonzero(self.text[: n] == self.text[WINDOW - 1 :])
        return _mix(np.where(enough, template, exact))[at], at

    def kinds(self, plain: Bloom) -> np.ndarray:
        """0 plain word, 1 number, 2 name, 3 unit."""
        kind = np.where(plain.has(self.hash), 0, 2).astype(np.int8)
        kind[_in(self.hash, _units())] = 3
        kind[self.number] = 1
        return kind


def _in(x: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_values, x)
    return sorted_values[np.minimum(at, len(sorted_values) - 1)] == x


def _units() -> np.ndarray:
    return np.sort(Words(UNITS).hash)


class Bloom:
    """A set of 64-bit hashes, of which it never misses one, in a fixed number of bits."""

    def __init__(self, power: int, bits: np.ndarray) -> None:
        self.power, self.bits = power, bits

    @staticmethod
    def positions(h: np.ndarray, power: int) -> list[np.ndarray]:
        return [(_mix(_mix(h + odd) * _ODD) >> np.uint64(64 - power)).astype(np.int64) for odd in (np.uint64(1), np.uint64(0x5DEECE66D))]

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in self.positions(h, self.power):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out

    @classmethod
    def of(cls, hashes: DataFrame, about: int) -> Bloom:
        """The filter of the column ``h`` of ``hashes``, of which there are ``about`` so many: set chunk by chunk in tasks, gathered as at most 32 MB."""
        power = int(min(LARGEST, max(CHUNK, np.ceil(np.log2(16 * max(about, 1))))))
        placed = hashes.select("h").mapInArrow(lambda it: _offsets(it, power), "chunk int, offsets binary")
        chunks = placed.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_chunk_bits, "chunk int, bits binary")
        bits = np.zeros(2 ** (power - 3), np.uint8)
        for r in chunks.collect():
            bits[r.chunk << CHUNK - 3 : r.chunk + 1 << CHUNK - 3] = np.frombuffer(r.bits, np.uint8)
        return cls(power, bits)


def _offsets(batches: Iterator[pa.RecordBatch], power: int) -> Iterator[pa.RecordBatch]:
    """(h) -> (chunk, offsets) of the bits to be set."""
    for batch in batches:
        at = np.unique(np.concatenate(Bloom.positions(batch.column(0).to_numpy().view(np.uint64), power)))
        edges = np.flatnonzero(np.append(True, np.diff(at >> CHUNK) > 0)) if len(at) else np.zeros(0, np.int64)
        low = (at & 2**CHUNK - 1).astype(np.uint32)
        parts = [low[a:b].tobytes() for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(at)], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array((at[edges] >> CHUNK).astype(np.int32)), pa.array(parts, pa.binary())], ["chunk", "offsets"])


def _chunk_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, offsets) sorted -> (chunk, bits)."""
    chunk, bits = None, np.zeros(2**CHUNK, np.uint8)
    for batch in batches:
        for c, offsets in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if c != chunk:
                if chunk is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["chunk", "bits"])
                chunk, bits = c, np.zeros(2**CHUNK, np.uint8)
            bits[np.frombuffer(offsets, np.uint32)] = 1
    if chunk is not None:
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["chunk", "bits"])


def _plain_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the words that begin with a small letter or in a script without case."""
    for batch in batches:
        found = {raw for text in batch.column(0).to_pylist() for raw in chars.re.findall(r"[^\W_]+", chars.canonical(text)) if raw[0] == raw[0].lower()}
        hashes = Words([w for w in sorted(found) if len(Words([w]).hash) == 1]).hash.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(hashes)], ["h"])


def _keyed(batches: Iterator[pa.RecordBatch], plain: Bloom, wanted: Bloom | None) -> Iterator[pa.RecordBatch]:
    """(k, t) -> (k, place, key, words, slots) of all windows, or of those whose key is wanted."""
    for batch in batches:
        for cut in range(0, batch.num_rows, 500):  # bounds the arrays of a batch of long texts
            part = batch.slice(cut, 500)
            words = Words(part.column(1).to_pylist())
            keys, at = words.windows(plain)
            if wanted is not None:
                hit = wanted.has(keys)
                keys, at = keys[hit], at[hit]
            kind = words.kinds(plain)
            strings: dict[int, str] = {}
            own = words.text[at] if len(at) else at
            first = np.searchsorted(words.text, own)
            rows, slots = [], []
            for i in at.tolist():
                rows.append(" ".join([strings.get(j) or strings.setdefault(j, words.string(j)) for j in range(i, i + WINDOW)]))
                slots.append([j for j in range(WINDOW) if kind[i + j]])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(own, pa.int64())), pa.array((at - first).astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(rows, pa.string()), pa.array(slots, pa.list_(pa.int32()))],
                ["k", "place", "key", "words", "slots"],
            )


def leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """Documents and the items whose passages they hold: a row per pair that shares a template window.

    Columns ``doc``, ``item``, ``windows`` (shared windows), ``exact_windows`` (those with the same words),
    ``slots`` and ``consistent_slots`` (fillings of the items' slots; those always filled by one word in this
    document) and ``kind``: ``exact`` if any window has the same words, ``reworded`` if the slots are filled
    consistently, else ``template``.

    Null, blank and shorter texts hold no window and give no row; very long texts are taken whole. Repeated rows of
    one key count once, equal texts under other keys each; items that share a passage are each reported. An empty
    table on either side gives no rows. Only the two named columns of each table are read.
    """
    spark = documents.sparkSession
    ship(spark)
    of = lambda df, k: df.where(F.col(k).isNotNull() & F.col(text).isNotNull()).select(F.col(k).cast("long").alias("k"), F.col(text).alias("t"))
    schema = "k long, place int, key long, words string, slots array<int>"
    asked = of(items, item)
    letters = asked.agg(F.sum(F.length("t"))).first()[0] or 0
    plain = Bloom.of(asked.select("t").mapInArrow(_plain_words, "h long"), letters // 6)
    known = spark.sparkContext.broadcast(plain)
    passages, _ = settle(asked.mapInArrow(lambda it: _keyed(it, known.value, None), schema).distinct())
    sent = spark.sparkContext.broadcast(Bloom.of(passages.select(F.col("key").alias("h")), letters // 6))
    found, _ = settle(of(documents, doc).mapInArrow(lambda it: _keyed(it, known.value, sent.value), schema).distinct())
    salts = found.groupBy("key").agg(F.ceil(F.count("*") / HOT).alias("salts"))
    keyed = passages.join(salts, "key").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    hits = found.join(salts, "key").withColumn("salt", F.pmod(F.xxhash64("k"), F.col("salts")))
    pairs = hits.alias("d").join(keyed.alias("i"), ["key", "salt"]).select(
        F.col("d.k").alias(doc), F.col("i.k").alias(item), F.col("d.words").alias("dw"), F.col("i.words").alias("iw"), F.col("i.slots").alias("at"))
    fillings = F.expr("transform(at, x -> named_struct('i', split(iw, ' ')[x], 'd', split(dw, ' ')[x]))")
    pairs = pairs.groupBy(doc, item).agg(
        F.count("*").alias("windows"),
        F.count_if(F.col("dw") == F.col("iw")).alias("exact_windows"),
        F.array_distinct(F.flatten(F.collect_set(fillings))).alias("f"),
    )
    total, distinct = F.size("f").cast("long"), F.expr("cast(size(array_distinct(f.i)) as long)")
    consistent = 2 * distinct - total
    kind = F.when(F.col("exact_windows") > 0, "exact").when(consistent >= 0.8 * distinct, "reworded").otherwise("template")
    return pairs.select(doc, item, "windows", "exact_windows", distinct.alias("slots"), F.greatest(consistent, F.lit(0).cast("long")).alias("consistent_slots"), kind.alias("kind"))
