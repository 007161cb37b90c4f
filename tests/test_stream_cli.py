import datetime

from packloom import cli
from packloom.sources import documents, pack
from packloom.streaming import ingest


def test_stream_drops_copies_and_chunks(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    rows = [(1, "One. " * 400, "s", t), (1, "One. " * 400, "s", t), (2, None, "s", t)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, ingested_at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    ingest.append(ingest.chunked(stream, 100, 10), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.select("doc_id").distinct().count() == 1
    assert out.count() == out.select("chunk_id").distinct().count() > 1


def test_pages(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, None), (2, 1, " ")], "doc_id long, page int, text string")
    assert [tuple(r) for r in documents.from_pages(df).collect()] == [(1, "ab")]


def test_command_line(spark, tmp_path, capsys):
    from tests.test_pack import META, _chunks

    path = str(tmp_path / "p.zip")
    pack.write(_chunks(spark, 3), None, path, META)
    assert cli.main(["validate", path]) == 0
    assert cli.main(["stats", path]) == 0
    assert cli.main(["search", path, "-q", "täxt", "--no-scores"]) == 0
    assert '"num_chunks": 3' in capsys.readouterr().out
