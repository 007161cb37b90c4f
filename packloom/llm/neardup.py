"""Problem 5: groups of near-duplicate texts.

Method: many universal hash minima of a text's 5-character substrings, banding, verification by signature, an
exact check of what remains, and connected components by alternating large-star and small-star.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import delete, settle, ship
from packloom.functions.text import not_blank
from packloom.llm.classes import components, spelled_pairs
from packloom.llm.groups import groups_of, whole_groups

WIDTH = 5
BANDS, ROWS = 64, 6
MINIMA = BANDS * ROWS
"""Each band has 6 minima of its own. A pair at similarity 0.7 shares a band with probability 1 - (1 - 0.7 ** 6) ** 64 = 0.9997."""
SIGNATURE, AGREE = 64, 30
"""Four bits of 64 minima are compared. At similarity 0.7 some 46 agree, fewer than 30 with a probability under 0.0001."""
WORDS = ("s0", "s1", "s2", "s3")
HELD = 1 << 16
"""Classes whose keys are packed together, in which a class is named by two bytes."""
KEYS = 1 << 20
"""About how many keys the tasks that look for repeated ones take at once; there are as many parts of keys as that needs."""
BUCKET = 256
"""Classes with one key that are compared as one group; larger buckets are compared block by block, in as many groups."""
BLANKS = re.compile("[ \t\r\n]{2,}|[\t\r\n]")


def normal(text: str) -> str:
    """Lower case, each run of ASCII blanks one space."""
    return BLANKS.sub(" ", text.lower())


def _family(n: int) -> np.ndarray:
    """The odd factors of n universal hash functions a * x modulo 2 ** 32."""
    return (np.random.default_rng(2024).integers(1, 2**32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def shingles(texts: list[str]) -> list[np.ndarray]:
    """For each text 32-bit hashes of its substrings of WIDTH characters, repeated ones included."""
    ends = np.cumsum([len(t) for t in texts])
    p = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(len(p) - WIDTH + 1, 0)
    h = np.zeros(n, np.uint64)
    for i in range(WIDTH):
        h = h * np.uint64(0x100000001B3) + p[i : i + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h = (h >> np.uint64(32)).astype(np.uint32)
    return [h[end - len(t) : max(end - WIDTH + 1, end - len(t))] for t, end in zip(texts, ends.tolist(), strict=True)]


class Minima:
    """Least values of a family of hash functions over a text's shingles, any length, in a buffer of fixed size."""

    def __init__(self, n: int, block: int = 1024) -> None:
        self.a = _family(n)[:, None]
        self.n, self.block, self.room = n, block, np.empty(n * block, np.uint32)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        out = np.full(self.n, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(h), self.block):
            part = h[None, i : i + self.block]
            room = self.room[: self.n * part.shape[1]].reshape(self.n, -1)
            np.multiply(self.a, part, out=room)
            np.minimum(out, room.min(axis=1), out=out)
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _class(tab: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{tab}\0{text}".encode("utf-8", "surrogatepass")) - 2**63


class Packed:
    """Keys of one task's classes, until there are enough to pack."""

    def __init__(self, bits: int) -> None:
        self.bits, self.keys, self.name = bits, [], 0

    def rows(self) -> list[tuple[int, int, int, bytes]]:
        """(part, block, number, blob) for each part: the sorted keys' differences, a plane for each byte, and their classes' places."""
        keys = np.concatenate(self.keys)
        order = np.argsort(keys)
        keys, place = keys[order], (order // BANDS).astype(np.uint16)
        part = (keys >> np.uint64(63 - self.bits)).astype(np.int64) >> 1
        low = keys >> np.uint64(32 - self.bits) & np.uint64(2**32 - 1)
        edges = np.searchsorted(part, np.arange(2**self.bits + 1))
        out = []
        for p in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[p], edges[p + 1]
            steps = np.diff(low[a:b], prepend=np.uint64(0)).astype(np.uint32).view(np.uint8).reshape(-1, 4)
            planes = place[a:b].view(np.uint8).reshape(-1, 2)
            out.append((p, self.name, int(b - a), np.ascontiguousarray(np.hstack([steps, planes]).T).tobytes()))
        self.keys = []
        return out


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(blob, np.uint8).reshape(6, n)
    steps = np.ascontiguousarray(planes[:4].T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint64), np.ascontiguousarray(planes[4:].T).view(np.uint16).ravel()


FIELDS = pa.schema([("tab", pa.string()), ("k", pa.int64()), ("cls", pa.int64()), ("raw", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("blob", pa.binary())])
DDL = "tab string, k long, cls long, raw long, part int, block long, n int, blob binary"


def _signatures(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(tab, k, t) -> rows of ``FIELDS``: each text's class and spelling, and for each block of a partition's distinct classes its keys by their part, and who they are (part -1): classes and signatures.

    The first 2 ** bits parts of the keys' range are told apart, and 32 more bits of each key: at about ``KEYS`` keys a part, one in some thousands is like another by chance.
    """
    minima, seen, packed, held = Minima(MINIMA), set(), Packed(bits), []
    odd = _mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    salt = _mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))

    def block() -> pa.RecordBatch:
        who = np.array([c for c, _ in held], np.int64).tobytes() + b"".join(w for _, w in held)
        rows = [(-1, packed.name, len(held), who), *packed.rows()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.nulls(len(rows), f.type) for f in list(FIELDS)[:4]] + [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(FIELDS)[4:], strict=True)], schema=FIELDS)

    for batch in (whole.slice(at, 500) for whole in batches for at in range(0, whole.num_rows, 500)):  # bounds the arrays of a batch
        cls, raw, lows = [], [], [normal(t) for t in batch.column(2).to_pylist()]
        for tab, text, low, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), lows, shingles(lows), strict=True):
            c = _class(tab, low)
            cls.append(c), raw.append(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63)
            if c in seen or len(low) < WIDTH:
                continue
            seen.add(c)
            m = minima(h)
            half = (m[:SIGNATURE] & np.uint32(15)).astype(np.uint8)
            if not held:
                packed.name = c  # a class begins one block only
            held.append((c, (half[::2] << 4 | half[1::2]).tobytes()))
            packed.keys.append(_mix((m.reshape(BANDS, ROWS).astype(np.uint64) * odd).sum(axis=1, dtype=np.uint64) + salt + np.uint64(xxhash.xxh3_64_intdigest(tab))))
            if len(held) == HELD:
                yield block()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cls, pa.int64()), pa.array(raw, pa.int64()), *[pa.nulls(len(cls), f.type) for f in list(FIELDS)[4:]]], schema=FIELDS)
    if held:
        yield block()


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, block, n, blob) sorted by part and block -> (block, n, blob): the buckets, places and sides of the keys that come more than once.

    A key is a bucket; one of more than ``BUCKET`` classes is a bucket for each pair of blocks of its classes, and
    sides 1 and 2 tell the blocks apart.
    """
    for table in groups_of(batches):
        part = table.column("part")[0].as_py()
        names = table.column("block").to_numpy()
        each = [_unpacked(blob, n) for blob, n in zip(table.column("blob").to_pylist(), table.column("n").to_pylist(), strict=True)]
        keys, place = (np.concatenate([x[i] for x in each]) for i in (0, 1))
        block = np.repeat(np.arange(len(names)), [len(x[0]) for x in each])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        m = np.repeat(np.diff(np.append(first, len(keys))), np.diff(np.append(first, len(keys))))
        bucket = _mix(keys | np.uint64(part << 32))
        small, large = np.flatnonzero((m > 1) & (m <= BUCKET)), np.flatnonzero(m > BUCKET)
        yield _by_block(names, block[order[small]], bucket[small], place[order[small]], np.zeros(len(small), np.uint8))
        blocks = -(-m[large] // BUCKET)
        own = (_mix(_mix(names[block[order[large]]].view(np.uint64)) + place[order[large]]) % blocks.astype(np.uint64)).astype(np.int64)
        for j in range(int(blocks.max(initial=0))):  # each class meets every block of its bucket, its own included
            at = np.flatnonzero(blocks > j)
            low, high = np.minimum(own[at], j), np.maximum(own[at], j)
            pair = _mix(bucket[large[at]] + _mix((low * (1 << 31) + high + 1).astype(np.uint64)))
            yield _by_block(names, block[order[large[at]]], pair, place[order[large[at]]], np.where(own[at] == j, 0, np.where(own[at] < j, 1, 2)).astype(np.uint8))


def _by_block(names: np.ndarray, block: np.ndarray, bucket: np.ndarray, place: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(block, kind="stable")
    edges = np.searchsorted(block[order], np.arange(len(names) + 1))
    rows = [(int(names[i]), int(b - a), bucket[o].tobytes() + place[o].tobytes() + side[o].tobytes()) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a and len(o := order[a:b])]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["block", "n", "blob"])


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, who, n, blob) sorted, who is in a block before its repeated keys -> (bucket, cls, side, words)."""
    cls = words = None
    for batch in batches:
        for first, n, blob in zip(*(batch.column(c).to_pylist() for c in ("who", "n", "blob")), strict=True):
            if first:
                cls, words = np.frombuffer(blob, np.int64, n), np.frombuffer(blob, np.int64, 4 * n, 8 * n).reshape(n, 4)
                continue
            bucket, place, side = np.frombuffer(blob, np.int64, n), np.frombuffer(blob, np.uint16, n, 8 * n), np.frombuffer(blob, np.uint8, n, 10 * n)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(cls[place]), pa.array(side.astype(np.int32)), *map(pa.array, np.ascontiguousarray(words[place].T))], ["bucket", "cls", "side", *WORDS])


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many of their four-bit places rows of 64-bit numbers agree."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return SIGNATURE - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, cls, side, words) sorted by bucket -> (a, b) of the classes in it whose signatures agree enough.

    Members of sides 1 and 2 are compared across, those of side 0 all with each other.
    """
    for table in whole_groups(batches):
        bucket, cls, side = (table.column(c).to_numpy() for c in ("bucket", "cls", "side"))
        words = np.stack([table.column(w).to_numpy() for w in WORDS], axis=1).view(np.uint64)
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        after = np.repeat(np.append(first[1:], len(bucket)), np.diff(np.append(first, len(bucket))))
        at, step, found = np.arange(len(bucket)), 0, []
        while True:  # each row with the one so many rows on
            step += 1
            at = at[at + step < after[at]]
            if not len(at):
                break
            to = at + step
            good = (cls[at] != cls[to]) & ((side[at] == 0) | (side[at] != side[to])) & (_agreeing(words[at], words[to]) >= AGREE)
            found.append(np.stack([cls[at[good]], cls[to[good]]]))
        if found:
            pairs = np.unique(np.sort(np.concatenate(found, axis=1), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _similar(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b, ta, tb) -> (a, b, similarity) of the pairs at or above ``least``, exactly."""
    grams = lambda t: {t[i : i + WIDTH] for i in range(len(t) - WIDTH + 1)}
    for batch in batches:
        a, b, s, before, own = [], [], [], None, set()
        for x, y, tx, ty in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if x != before:
                before, own = x, grams(normal(tx))
            other = grams(normal(ty))
            both = len(own & other)
            alike = both / (len(own) + len(other) - both) if both else 0.0
            if alike >= least:
                a.append(x), b.append(y), s.append(alike)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], ["a", "b", "similarity"])


def class_links(rows: DataFrame, least: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Links between the classes of equal normal texts, and the classes' members.

    ``rows`` has ``tab`` (texts of different tables are never compared), ``k`` and ``t``. Gives the links (``a`` <
    ``b``, ``similarity``) and the members (``tab``, ``k``, ``cls``, ``raw``). Texts of fewer than five characters
    have no substrings and no links. A hot text is one class. Keys are packed by the thousand, sorted, and only those that
    come again are taken apart; a bucket of many classes is compared block by block, in groups of bounded size.
    """
    spark = rows.sparkSession
    ship(spark)
    bits = max(0, int(np.ceil(np.log2(max(rows.count(), 1) * BANDS / KEYS))))
    rows = rows.where("k is not null and t is not null").select(F.col("tab").cast("string"), F.col("k").cast("long"), "t")
    rows = rows.where(not_blank("t"))
    wide, path = settle(rows.select("tab", "k", "t").mapInArrow(lambda it: _signatures(it, bits), DDL))
    packed = wide.where("part >= 0").select("part", "block", "n", "blob")
    again, held = settle(packed.repartition("part").sortWithinPartitions("part", "block").mapInArrow(_repeated, "block long, n int, blob binary"))
    members, _ = settle(wide.where("part is null").select("tab", "k", "cls", "raw"))
    who, named = settle(wide.where("part = -1").select("block", F.lit(True).alias("who"), "n", "blob"))
    delete(spark, path)
    known = who.union(again.select("block", F.lit(False), "n", "blob"))
    classes = known.repartition("block").sortWithinPartitions("block", F.desc("who")).mapInArrow(_named, "bucket long, cls long, side int, " + ", ".join(f"{w} long" for w in WORDS))
    likely, _ = settle(classes.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_likely, "a long, b long").distinct())
    delete(spark, held), delete(spark, named)
    needed = likely.select(F.col("a").alias("cls")).union(likely.select("b")).distinct()
    first = members.join(needed, "cls", "left_semi").groupBy("tab", "cls").agg(F.min("k").alias("k"))
    texts = rows.join(first, ["tab", "k"]).groupBy("cls").agg(F.min("t").alias("t"))
    text = lambda x, t: texts.select(F.col("cls").alias(x), F.col("t").alias(t))
    pairs = likely.join(text("b", "tb"), "b").join(text("a", "ta"), "a").select("a", "b", "ta", "tb")
    links = pairs.sortWithinPartitions("a").mapInArrow(lambda it: _similar(it, least), "a long, b long, similarity double")
    return links, members


def similar_pairs(rows: DataFrame, least: float = 0.7) -> DataFrame:
    """Pairs (``tab``, ``id_a`` < ``id_b``) of rows whose raw texts differ and whose similarity is ``least`` or more.

    Null, blank and very short texts are in no pair, rows with a null key neither. Very long texts are taken whole.
    Exact copies are never paired with each other but each is with every text like theirs. Repeated rows (same
    ``tab`` and ``k``) count once. An empty table gives no pairs.
    """
    links, members = class_links(rows, least)
    across = links.select("a", "b").join(members.select(F.col("cls").alias("a"), "tab", F.col("k").alias("k1")), "a")
    across = across.join(members.select(F.col("cls").alias("b"), F.col("k").alias("k2")), "b").where("k1 <> k2")
    across = across.select("tab", F.least("k1", "k2").alias("a"), F.greatest("k1", "k2").alias("b"))
    within = spelled_pairs(members, ["tab", "cls"]).select("tab", "a", "b")
    return across.union(within).distinct().select("tab", F.col("a").alias("id_a"), F.col("b").alias("id_b"))


def groups(rows: DataFrame, least: float = 0.7) -> DataFrame:
    """One row per usable row: (``tab``, ``id``, ``group``, ``links``).

    ``group`` is the least id of the rows joined to it by chains of similar pairs, ``links`` the number of other
    classes of equal texts that its class is linked to. A row that is like no other is its own group.
    """
    links, members = class_links(rows, least)
    links, _ = settle(links)
    degree = links.select(F.col("a").alias("cls")).union(links.select("b")).groupBy("cls").agg(F.count("*").alias("links"))
    named = members.join(components(links).select(F.col("node").alias("cls"), "component"), "cls", "left").join(degree, "cls", "left")
    named = named.withColumn("component", F.coalesce("component", "cls"))
    least_id = named.groupBy("component").agg(F.min("k").alias("group"))
    return named.join(least_id, "component").select("tab", F.col("k").alias("id"), "group", F.coalesce("links", F.lit(0).cast("long")).alias("links")).distinct()
