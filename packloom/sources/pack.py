"""Packs as a Spark data source: ``spark.read.format("pack")`` and ``df.write.format("pack")``.

A pack is a folder or a zip file with ``chunks.json``, ``embeddings.npy`` (or ``embeddings.csv``), optionally
``citations.jsonl``, and ``manifest.json`` or the older ``metadata.json``. The option ``part`` names what is read:
``chunks``, ``embeddings``, ``citations`` or ``manifest``. A path may hold wildcards; every pack is read by its own
tasks, and vectors of a folder by several.
"""

from __future__ import annotations

import glob
import io
import json
import os
import shutil
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from packloom.functions.session import ship
from packloom.operators.citations import FIELDS
from packloom.sources import npy

SCHEMAS = {
    "chunks": "pack string, chunk_index long, text string",
    "embeddings": "pack string, chunk_index long, embedding array<float>",
    "citations": "pack string, line long, " + ", ".join(f"{k} {v}" for k, v in FIELDS.items()),
    "manifest": "pack string, member string, manifest string",
}
PER_TASK = 100_000


class Members:
    """The files of a folder or a zip."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.zip = zipfile.ZipFile(path) if os.path.isfile(path) else None

    def names(self) -> set[str]:
        return set(self.zip.namelist()) if self.zip else {x for x in os.listdir(self.path)}

    def open(self, name: str):
        if self.zip:
            return self.zip.open(name)
        return open(os.path.join(self.path, name), "rb")

    def json(self, name: str):
        with self.open(name) as f:
            return json.load(io.TextIOWrapper(f, encoding="utf-8"))


class Part(InputPartition):
    def __init__(self, path: str, first: int = 0, count: int = -1) -> None:
        self.path, self.first, self.count = path, first, count


class PackReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.part, self.csv = options.get("part", "chunks"), options.get("vectors", "npy") == "csv"
        where = options["path"]
        self.paths = sorted(glob.glob(where)) if glob.has_magic(where) else [where]
        if not self.paths or not all(map(os.path.exists, self.paths)):
            raise FileNotFoundError(where)

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.paths:
            m = Members(path)
            if self.part == "embeddings" and not self.csv and m.zip is None and "embeddings.npy" in m.names():
                with m.open("embeddings.npy") as f:
                    n = npy.read_header(f)[1][0]
                out += [Part(path, i, min(PER_TASK, n - i)) for i in range(0, max(n, 1), PER_TASK)]
            else:
                out.append(Part(path))
        return out

    def read(self, partition: Part) -> Iterator[tuple]:
        m = Members(partition.path)
        names, pack = m.names(), os.path.basename(partition.path.rstrip("/"))
        if self.part == "chunks":
            for i, x in enumerate(m.json("chunks.json")):
                yield (pack, i, x if isinstance(x, str) else x.get("text"))
        elif self.part == "embeddings":
            yield from self._vectors(m, names, pack, partition)
        elif self.part == "citations":
            if "citations.jsonl" in names:
                with m.open("citations.jsonl") as f:
                    n = 0
                    for line in io.TextIOWrapper(f, encoding="utf-8"):
                        if line.strip():
                            x = json.loads(line)
                            yield (pack, n, *(x.get(k) for k in FIELDS))
                            n += 1
        else:
            for name in ("manifest.json", "metadata.json"):
                if name in names:
                    yield (pack, name, json.dumps(m.json(name), ensure_ascii=False))
                    return
            yield (pack, None, "{}")

    def _vectors(self, m: Members, names: set[str], pack: str, p: Part) -> Iterator[tuple]:
        if "embeddings.npy" in names and not self.csv:
            with m.open("embeddings.npy") as f:
                if p.count >= 0:
                    rows = npy.read_rows(f, p.first, p.count)
                else:
                    data = io.BytesIO(f.read())
                    n = npy.read_header(data)[1][0]
                    data.seek(0)
                    rows = npy.read_rows(data, 0, n)
            for i, r in enumerate(rows):
                yield (pack, p.first + i, r.astype(np.float32).tolist())
        elif "embeddings.csv" in names:
            with m.open("embeddings.csv") as f:
                lines = (x for x in io.TextIOWrapper(f, encoding="utf-8") if x.strip())
                for i, line in enumerate(lines):
                    yield (pack, i, [float(x) for x in line.split(",")])
        else:
            raise FileNotFoundError(f"{p.path}: neither embeddings.npy nor embeddings.csv")


@dataclass
class Written(WriterCommitMessage):
    first: int
    count: int
    columns: int
    path: str


class PackWriter(DataSourceWriter):
    """Tasks write pieces of the members, in the order of ``chunk_index``; the commit joins them, piece by piece."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.compress = options.get("compress", "true").lower() == "true" or self.path.endswith(".zip")
        self.legacy = options.get("version", "1.1") == "legacy"
        self.manifest = options.get("manifest", "{}")
        self.missing = options.get("missing", "error")
        self.pieces = f"{self.path}.pieces-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        os.makedirs(self.pieces, exist_ok=True)
        base = os.path.join(self.pieces, uuid.uuid4().hex)
        first, n, columns, waiting = -1, 0, -1, 0
        blank = lambda: np.full(columns, np.nan, np.float32)
        with open(f"{base}.chunks", "w", encoding="utf-8") as c, open(f"{base}.npy", "wb") as v, open(f"{base}.csv", "w", encoding="utf-8") as t, open(f"{base}.citations", "w", encoding="utf-8") as q:
            for r in iterator:
                first = r.chunk_index if first < 0 else first
                c.write((", " if n else "") + json.dumps(r.text, ensure_ascii=False))
                if r.embedding is None:
                    if self.missing != "nan":
                        raise ValueError(f"chunk {r.chunk_index} has no vector")
                    waiting += 1  # the width is known once a row has a vector
                else:
                    x = np.asarray(r.embedding, np.float32)
                    if columns not in (-1, len(x)):
                        raise ValueError(f"chunk {r.chunk_index} has a vector of {len(x)} values, those before have {columns}")
                    columns = len(x)
                    for y in [*[blank()] * waiting, x]:
                        v.write(y.tobytes())
                        t.write(",".join(f"{z:.18e}" for z in y.astype(np.float64)) + "\n")
                    waiting = 0
                q.write((r.citation or "{}") + "\n")
                n += 1
            for _ in range(waiting if columns >= 0 else 0):
                v.write(blank().tobytes())
                t.write(",".join(f"{z:.18e}" for z in blank().astype(np.float64)) + "\n")
        return Written(first, n, columns, base)

    def commit(self, messages: list[Written]) -> None:
        parts = sorted((m for m in messages if m and m.count), key=lambda m: m.first)
        widths = {m.columns for m in parts if m.columns >= 0}
        if len(widths) > 1:
            raise ValueError(f"vectors have {', '.join(map(str, sorted(widths)))} values; a pack holds vectors of one length")
        rows, columns = sum(m.count for m in parts), max(widths, default=0)
        for m in parts:
            if m.columns < 0:  # a piece without any vector
                with open(f"{m.path}.npy", "wb") as v, open(f"{m.path}.csv", "w", encoding="utf-8") as t:
                    v.write(np.full(m.count * columns, np.nan, np.float32).tobytes())
                    t.write((",".join(["nan"] * columns) + "\n") * m.count)
        folder = f"{self.path}.joined-{uuid.uuid4().hex}" if self.compress else self.path
        os.makedirs(folder, exist_ok=True)
        out = lambda name, head, kind, between, tail: self._join(os.path.join(folder, name), head, [f"{m.path}.{kind}" for m in parts], between, tail)
        out("chunks.json", b"[", "chunks", b", ", b"]")
        out("embeddings.npy", npy.header(rows, columns), "npy", b"", b"")
        out("embeddings.csv", b"", "csv", b"", b"")
        if not self.legacy:
            out("citations.jsonl", b"", "citations", b"", b"")
        with open(os.path.join(folder, "metadata.json" if self.legacy else "manifest.json"), "w", encoding="utf-8") as f:
            json.dump(json.loads(self.manifest), f, ensure_ascii=False, indent=2)
        if self.compress:
            with zipfile.ZipFile(self.path, "w", zipfile.ZIP_DEFLATED) as z:
                for name in sorted(os.listdir(folder)):
                    z.write(os.path.join(folder, name), name)
            shutil.rmtree(folder)
        shutil.rmtree(self.pieces, ignore_errors=True)

    def abort(self, messages: list[Written]) -> None:
        shutil.rmtree(self.pieces, ignore_errors=True)

    @staticmethod
    def _join(path: str, head: bytes, parts: list[str], between: bytes, tail: bytes) -> None:
        with open(path, "wb") as out:
            out.write(head)
            for i, p in enumerate(parts):
                out.write(between if i else b"")
                with open(p, "rb") as f:
                    shutil.copyfileobj(f, out)
            out.write(tail)


class PackSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pack"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("part", "chunks")]

    def reader(self, schema) -> PackReader:
        return PackReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> PackWriter:
        return PackWriter(dict(self.options))


def use(spark: SparkSession) -> None:
    """Make the format ``pack`` known to the session."""
    ship(spark)
    spark.dataSource.register(PackSource)


def read(spark: SparkSession, path: str, part: str, vectors: str = "npy") -> DataFrame:
    """One part of a pack or of all packs that a pattern names. ``vectors`` = "csv" reads the text form of the vectors though there is a binary one."""
    use(spark)
    return spark.read.format("pack").option("part", part).option("vectors", vectors).load(path)


def manifest(chunker: dict, embedder: dict, indexer: dict, sources: list[dict], pack_id: str | None = None, created_at: str | None = None) -> dict:
    """A manifest of version 1.1. Null paths are left out of ``sources``, as the schema wants text there."""
    return {
        "pack_version": "1.1", "pack_id": pack_id or str(uuid.uuid4()), "created_at": created_at or datetime.now(UTC).isoformat(),
        "chunker": chunker, "embedder": embedder, "indexer": indexer,
        "files": {"chunks": "chunks.json", "embeddings": "embeddings.npy", "citations": "citations.jsonl", "metadata": {"embeddings_csv": "embeddings.csv", "manifest": "manifest.json"}},
        "source_documents": [{k: v for k, v in s.items() if not (k == "path" and v is None)} for s in sources],
    }


def manifest_of(chunker: dict, embedder: dict, registry: DataFrame, chunks: DataFrame, features: tuple[str, ...] = (), pack_id: str | None = None, created_at: str | None = None) -> dict:
    """The manifest of a pack whose sources are those of a registry as ``enrich.register`` gives it, in order of their first registration.

    A manifest lists every source, so the driver holds as many short rows as the pack has documents.
    """
    kept = [c for c in ("doc_id", "title", "path", "page_count", "char_count") if c in registry.columns]
    rows = registry.orderBy("first_seq" if "first_seq" in registry.columns else "doc_id").select(*kept).collect()
    when = created_at or datetime.now(UTC).isoformat()
    index = {"document_count": len(rows), "chunk_count": chunks.count(), "features": list(features), "timestamp": when}
    return manifest(chunker, embedder, index, [r.asDict() for r in rows], pack_id, when)


def old_manifest(name: str, model: str, chunks: int, dimensions: int, created_at: str | None = None) -> dict:
    """The ``metadata.json`` of packs without a version."""
    return {"pack_name": name, "created_at": created_at or datetime.now(UTC).isoformat(), "model_used": model, "num_chunks": chunks, "embedding_dim": dimensions}


def is_version(meta: dict, version: str = "1.1") -> bool:
    """Whether a manifest is of ``version``; one without a version is of none."""
    return meta.get("pack_version") == version


def sample(spark: SparkSession, path: str, compress: bool = True) -> None:
    """Write a small pack of three chunks with stand-in vectors and citations, to try things on."""
    from packloom.operators import chunk, citations, embed  # the tasks that read packs do without them

    texts = ["The glass furnace is lit before dawn. It cools for two days.", "Harbour fees are due on the first Monday.", "Seed orders close in March. Late orders wait a year."]
    rows = spark.createDataFrame([(i, 0, f"note-{i}", t, 0, len(t)) for i, t in enumerate(texts)], "chunk_index long, chunk_id int, doc_id string, text string, start_char int, end_char int")
    cites = citations.project(rows).join(rows.select("doc_id", "chunk_index"), "doc_id")
    meta = manifest(chunk.metadata(128, 20), embed.metadata("stand-in", "1"), {"document_count": 3, "chunk_count": 3, "features": [], "timestamp": ""}, [{"doc_id": f"note-{i}", "title": f"Note {i}"} for i in range(3)], "sample")
    write(embed.stand_in(rows), cites, path, meta, compress)


def write(chunks: DataFrame, cited: DataFrame | None, path: str, meta: dict, compress: bool = True, legacy: bool = False, partitions: int = 8, missing: str = "error") -> None:
    """Write a pack of ``chunks`` (``chunk_index``, ``text``, ``embedding``), sorted by index, with a citation for each.

    ``cited`` has ``chunk_index`` and the citation fields; a chunk without one gets an empty object. A chunk
    without a vector is an error, or with ``missing`` = "nan" a row of NaN; vectors of several lengths are an error.
    """
    spark = chunks.sparkSession
    use(spark)
    rows = chunks.select(F.col("chunk_index").cast("long").alias("chunk_index"), "text", F.col("embedding").cast("array<float>").alias("embedding"))
    if cited is not None:
        lines = cited.select("chunk_index", F.to_json(F.struct(*FIELDS), {"ignoreNullFields": "false"}).alias("citation"))
        rows = rows.join(lines, "chunk_index", "left")
    else:
        rows = rows.withColumn("citation", F.lit(None).cast("string"))
    rows = rows.select("chunk_index", "text", "embedding", "citation").repartitionByRange(partitions, "chunk_index").sortWithinPartitions("chunk_index")
    rows.write.format("pack").option("compress", str(compress).lower()).option("version", "legacy" if legacy else "1.1").option("manifest", json.dumps(meta, ensure_ascii=False)).option("missing", missing).mode("append").save(path)


def members(spark: SparkSession, pattern: str) -> DataFrame:
    """The listing (``pack``, ``member``, ``error``) of all packs that a pattern names; one that can't be read is a row with an error and no member."""
    paths = sorted(glob.glob(pattern)) if glob.has_magic(pattern) else [pattern]
    rows: list[tuple[str, str | None, str | None]] = []
    for p in paths:
        name = os.path.basename(p.rstrip("/"))
        try:
            rows += [(name, n, None) for n in sorted(Members(p).names())] or [(name, None, None)]
        except zipfile.BadZipFile:
            rows.append((name, None, "not a zip file"))
        except OSError as e:
            rows.append((name, None, e.strerror or "unreadable"))
    return spark.createDataFrame(rows, "pack string, member string, error string")


def listing(files: DataFrame, name: str, suffix: str) -> DataFrame:
    """The file names that end with ``suffix``, whatever their case, in order."""
    return files.select(name).where(F.lower(name).endswith(suffix.lower())).orderBy(name)
