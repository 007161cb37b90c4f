import json
import os
import zipfile

import numpy as np
import pytest

from packloom.operators import validate
from packloom.sources import documents, npy, pack


def _chunks(spark, n):
    return spark.createDataFrame([(i, f"täxt {i} \"q\"\n", [float(i), 0.5]) for i in range(n)], "chunk_index long, text string, embedding array<float>")


META = {
    "pack_version": "1.1", "pack_id": "p", "created_at": "now", "chunker": {"method": "m", "chunk_size": 5, "overlap": 0, "tokenizer_name": "t", "preserve_sentences": True},
    "embedder": {"name": "e", "version": "1", "dimensions": 2, "hash": "h"}, "indexer": {"document_count": 1, "chunk_count": 3, "features": ["a"]},
    "files": {"chunks": "c", "embeddings": "e", "citations": "x", "metadata": {}}, "source_documents": [{"doc_id": "d", "title": "t", "path": "p", "page_count": None, "char_count": 3}],
}


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("n", [0, 1, 25])
def test_round_trip(spark, tmp_path, compress, n):
    path = str(tmp_path / ("p.zip" if compress else "p"))
    pack.write(_chunks(spark, n), None, path, META, compress=compress)
    assert [(r.chunk_index, r.text) for r in pack.read(spark, path, "chunks").orderBy("chunk_index").collect()] == [(r.chunk_index, r.text) for r in _chunks(spark, n).orderBy("chunk_index").collect()]
    assert [list(r.embedding) for r in pack.read(spark, path, "embeddings").orderBy("chunk_index").collect()] == [[float(i), 0.5] for i in range(n)]
    assert json.loads(pack.read(spark, path, "manifest").first().manifest) == META
    if not compress:
        assert np.load(os.path.join(path, "embeddings.npy")).shape[0] == n


def test_csv_fallback_and_legacy(spark, tmp_path):
    path = str(tmp_path / "old.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("chunks.json", json.dumps(["a"]))
        z.writestr("embeddings.csv", "1.0,2.0\n")
        z.writestr("metadata.json", json.dumps({"model_used": "m"}))
    assert pack.read(spark, path, "embeddings").first().embedding == [1.0, 2.0]
    assert pack.read(spark, path, "citations").count() == 0
    assert pack.read(spark, path, "manifest").first().member == "metadata.json"
    s = validate.structure(pack.members(spark, path)).first()
    assert not s.structure_ok and s.errors == ["embeddings.npy is missing"] and s.warning.startswith("an old pack")


def test_npy_header_is_numpys(tmp_path):
    f = tmp_path / "a.npy"
    f.write_bytes(npy.header(2, 3) + np.arange(6, dtype="<f4").tobytes())
    assert np.load(f).tolist() == [[0, 1, 2], [3, 4, 5]]
    with f.open("rb") as g:
        assert npy.read_rows(g, 1, 1).tolist() == [[3, 4, 5]]


BREAKS = {
    "R1": lambda m: m.pop("embedder") and m.pop("files"), "R2": lambda m: m.update(pack_version="1.0"), "R3": lambda m: m.update(pack_id=3), "R4": lambda m: m.update(created_at=1),
    "R5": lambda m: m["chunker"].pop("method"), "R6": lambda m: m["chunker"].update(chunk_size=0), "R7": lambda m: m["chunker"].update(overlap=-1),
    "R8": lambda m: m["chunker"].update(preserve_sentences="yes"), "R9": lambda m: m["embedder"].pop("version"), "R10": lambda m: m["embedder"].update(dimensions=0),
    "R11": lambda m: m["embedder"].update(hash=1), "R12": lambda m: m["indexer"].update(chunk_count=-1), "R13": lambda m: m["indexer"].update(features=[1]),
    "R14": lambda m: m["files"].pop("chunks"), "R15": lambda m: m["files"].update(metadata="x"), "R16": lambda m: m["source_documents"][0].pop("title"),
    "R17": lambda m: m["source_documents"][0].update(path=None), "R18": lambda m: m["source_documents"][0].update(page_count=-1),
}


def test_every_rule_once(spark):
    rows = [("good", json.dumps(META))]
    for name, change in BREAKS.items():
        m = json.loads(json.dumps(META))
        change(m)
        rows.append((name, json.dumps(m)))
    rows.append(("text", "{not json"))
    found = validate.manifest_rules(spark.createDataFrame(rows, "pack string, manifest string")).where("not ok").collect()
    broken = {}
    for r in found:
        broken.setdefault(r["pack"], set()).add(r["rule"])
    assert "good" not in broken and len(broken["text"]) == 18
    for name in BREAKS:
        assert name in broken.get(name, set()), (name, broken.get(name))
        if name != "R1":
            assert broken[name] == {name}, (name, broken[name])


def test_coverage_and_verdict(spark):
    c = spark.createDataFrame([("a",)] * 20 + [("b",)] * 20, "pack_id string")
    m = spark.createDataFrame([("a",)] * 19 + [("b",)] * 18 + [("z",)], "pack_id string")
    got = {r.pack_id: (r.coverage, r.coverage_ok) for r in validate.coverage(c, m).collect()}
    assert got == {"a": (95.0, True), "b": (90.0, False), "z": (0.0, False)}


def _vectors(spark, rows):
    return spark.createDataFrame([(i, f"text {i}", v) for i, v in enumerate(rows)], "chunk_index long, text string, embedding array<float>").coalesce(1)


def test_null_and_ragged_vectors(spark, tmp_path):
    rows = _vectors(spark, [[1.0, 2.0, 3.0], None, [4.0, 5.0, 6.0]])
    with pytest.raises(Exception, match="has no vector"):
        pack.write(rows, None, str(tmp_path / "a.zip"), {})
    with pytest.raises(Exception, match="values"):
        pack.write(_vectors(spark, [[1.0, 2.0], [1.0]]), None, str(tmp_path / "b.zip"), {})
    pack.write(_vectors(spark, [None, [1.0, 2.0, 3.0], None, [4.0, 5.0, 6.0]]), None, str(tmp_path / "c.zip"), {}, missing="nan", partitions=2)
    for kind in ("npy", "csv"):
        got = {r.chunk_index: r.embedding for r in pack.read(spark, str(tmp_path / "c.zip"), "embeddings", kind).collect()}
        assert got[1] == [1.0, 2.0, 3.0] and got[3] == [4.0, 5.0, 6.0] and np.isnan(got[0]).all() and np.isnan(got[2]).all() and len(got[0]) == 3


def test_broken_packs_are_rows(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"not a zip")
    pack.sample(spark, str(tmp_path / "y.zip"))
    rows = {r.pack: r for r in validate.structure(pack.members(spark, str(tmp_path / "*.zip"))).collect()}
    assert rows["x.zip"].errors == ["not a zip file"] and not rows["x.zip"].structure_ok and rows["y.zip"].structure_ok
    gone = validate.structure(pack.members(spark, str(tmp_path / "none.zip"))).first()
    assert not gone.structure_ok and len(gone.errors) == 1
    assert pack.read(spark, str(tmp_path / "y.zip"), "chunks").count() == 3 and pack.is_version({"pack_version": "1.1"}) and not pack.is_version({})


def test_pages_of_files_and_old_manifests(spark, tmp_path):
    (tmp_path / "a.PDF").write_bytes(b"one|two")
    (tmp_path / "b.pdf").write_bytes(b"\xff")
    (tmp_path / "c.txt").write_bytes(b"three")
    got = documents.pages_of_files(spark, str(tmp_path), lambda raw: raw.decode().split("|")).collect()
    assert {(r.page, r.text, r.error is None) for r in got} == {(1, None, False), (1, "one", True), (2, "two", True)}
    meta = spark.createDataFrame([(1, json.dumps(pack.old_manifest("p", "m", 3, 4))), (2, "{}"), (3, "no json")], "id long, manifest string")
    assert {r.id: r.quick_ok for r in validate.quick(meta).collect()} == {1: True, 2: False, 3: False}
