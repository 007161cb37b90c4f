"""Embedding: character histograms inside the JVM, reproducible stand-in vectors, and any model by name."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import ship
from packloom.operators import chunk

DIMENSIONS = 384


def histogram(text: Column | str, dimensions: int = DIMENSIONS) -> Column:
    """Shares of the code points below 256 in the lower-cased text, padded with zeros; all zeros if there are none."""

    def count(values: pd.Series) -> pd.Series:
        texts = [(v or "").lower() for v in values]
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        kept = (points > 0) & (points < 256)
        n = np.bincount(row[kept] * 256 + points[kept], minlength=256 * len(texts)).reshape(-1, 256)[:, :dimensions].astype(np.float64)
        n /= np.maximum(n.sum(axis=1, keepdims=True), 1)
        return pd.Series(list(np.pad(n, ((0, 0), (0, dimensions - n.shape[1])))))

    return F.pandas_udf(count, "array<double>")(F.col(text) if isinstance(text, str) else text)


def histogram_long(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The histogram as rows (``key``, ``point``, ``share``), by a count that is combined before it is shuffled."""
    points = texts.select(key, F.explode(F.split(F.lower(text), "")).alias("c")).select(key, F.ascii("c").alias("point")).where("point > 0 and point < 256")
    counts = points.groupBy(key, "point").agg(F.count("*").alias("n"))
    total = counts.groupBy(key).agg(F.sum("n").alias("total"))
    return counts.join(total, key).select(key, "point", (F.col("n") / F.col("total")).alias("share"))


def _drawn(texts: list[str | None], dimensions: int) -> np.ndarray:
    """A unit vector for each text, from a generator that the text seeds."""
    seeds = [int.from_bytes(hashlib.blake2b((v or "").encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") for v in texts]
    x = np.stack([np.random.default_rng(seed).standard_normal(dimensions) for seed in seeds]) if seeds else np.zeros((0, dimensions))
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def stand_in(texts: DataFrame, text: str = "text", out: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """Unit vectors drawn from a generator that the text seeds: the same text has the same vector everywhere."""
    ship(texts.sparkSession)
    return texts.withColumn(out, F.pandas_udf(lambda v: pd.Series(list(_drawn(v.tolist(), dimensions))), "array<float>")(text))


def encode(texts: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]], text: str = "text", out: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """Vectors of a model that ``load`` opens once for each task; null texts are empty ones.

    A batch that the model fails on, or a task whose model can't be opened, gets stand-in vectors of ``dimensions``.
    """
    ship(texts.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            model = load()
        except Exception:  # noqa: BLE001 - a model that isn't there is what the stand-in is for
            model = None
        for b in batches:
            own = [v or "" for v in b]
            try:
                vectors = np.asarray(model(own), np.float32)
            except Exception:  # noqa: BLE001
                vectors = _drawn(own, dimensions)
            yield pd.Series(list(vectors))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return texts.withColumn(out, F.pandas_udf(run, "array<float>")(text))


def encode_one(load: Callable[[], Callable[[list[str]], np.ndarray]], text: str, dimensions: int = DIMENSIONS) -> list[float]:
    """The vector of one text, in the driver, with the same fallback."""
    try:
        return np.asarray(load()([text]), np.float32)[0].tolist()
    except Exception:  # noqa: BLE001
        return _drawn([text], dimensions)[0].tolist()


def chunk_and_embed(documents: DataFrame, load: Callable[[], Callable[[list[str]], np.ndarray]] | None = None, size: int = 512, overlap: int = 50, sentences: bool = True, dimensions: int = DIMENSIONS) -> DataFrame:
    """Chunks of ``documents`` with their vectors: those of a model, or stand-ins without one."""
    chunks = chunk.chunk(documents, size, overlap, sentences)
    return encode(chunks, load, dimensions=dimensions) if load else stand_in(chunks, dimensions=dimensions)


def fingerprint(name: Column, dimensions: Column) -> Column:
    """The hash by which a manifest names an embedder."""
    return F.substring(F.md5(F.concat_ws("_", name, dimensions.cast("string"))), 1, 16)


def metadata(name: str, version: str = "unknown", dimensions: int = DIMENSIONS) -> dict:
    """What a manifest says of the embedder."""
    return {"name": name, "version": version, "hash": hashlib.md5(f"{name}_{dimensions}".encode()).hexdigest()[:16], "dimensions": dimensions}
