import numpy as np
import pytest

from packloom.operators import citations, dense, embed, enrich, tfidf

NOTES = [
    "The tide table lists low water before breakfast.",
    "A tide gauge fails when barnacles block the pipe.",
    "Bees leave the hive once the orchard blossoms.",
    "The orchard ladder leans against a pear tree.",
    "Rope makers twist hemp in a long shed.",
]


def _corpus(spark):
    return spark.createDataFrame(list(enumerate(NOTES)), "chunk_index long, text string")


def test_cosine_topk_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    m = rng.standard_normal((60, 8)).astype(np.float32)
    m[7] = m[3]
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)] + [(60, None), (61, [1.0]), (62, [float("nan")] * 8)], "vec_id long, embedding array<float>")
    got = dense.topk(v, v.where("vec_id < 5").withColumnRenamed("vec_id", "query_id"), 4).collect()
    u = m.astype(np.float64) / np.linalg.norm(m.astype(np.float64), axis=1)[:, None]
    s = np.round(u[:5] @ u.T, 6)
    want = {(q, r + 1, int(i), float(s[q, i])) for q in range(5) for r, i in enumerate(np.lexsort((np.arange(60), -s[q]))[:4])}
    assert {tuple(r) for r in got} == want


def test_more_than_there_is_and_blocks(spark, monkeypatch):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0])], "vec_id long, embedding array<float>")
    q = v.withColumnRenamed("vec_id", "query_id")
    monkeypatch.setattr(dense, "AT_ONCE", 1)
    assert dense.topk(v, q, 9).count() == 4
    assert dense.topk(v.limit(0), q, 9).count() == 0
    assert dense.topk(v, q.limit(0), 9).count() == 0
    with pytest.raises(ValueError):
        dense.topk(v, q, 0)


def test_blocks_of_queries_equal_one_block(spark, monkeypatch):
    rng = np.random.default_rng(1)
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.standard_normal((80, 6)))], "vec_id long, embedding array<double>")
    q = v.where("vec_id < 30").withColumnRenamed("vec_id", "query_id")
    want = set(map(tuple, dense.topk(v, q, 3).collect()))
    monkeypatch.setattr(dense, "AT_ONCE", 7)
    assert set(map(tuple, dense.topk(v, q, 3).collect())) == want and len(want) == 90
    one = q.where("query_id = 4")
    assert set(map(tuple, dense.topk(v, one, 3).collect())) == {r for r in want if r[0] == 4}


def test_tfidf(spark):
    model = tfidf.fit(_corpus(spark), "chunk_index")
    q = spark.createDataFrame([(0, "tide table"), (1, "pear orchard ladder"), (2, "zzz"), (3, "the of")], "query_id long, text string")
    hits = tfidf.topk(model, q, 5).collect()
    best = {r.query_id: r.chunk_index for r in hits if r["rank"] == 1}
    assert best == {0: 0, 1: 3}
    assert all(0 < r.score <= 1 for r in hits)
    norms = model.weights.groupBy("chunk_index").agg({"weight": "count"}).count()
    assert norms == 5


def test_tfidf_round_trip_and_cap(spark, tmp_path):
    model = tfidf.fit(_corpus(spark), "chunk_index", max_features=10)
    assert model.vocabulary.count() == 10
    q = spark.createDataFrame([(0, "orchard")], "query_id long, text string")
    tfidf.export(model, str(tmp_path / "t.x"))
    assert tfidf.topk(tfidf.load(spark, str(tmp_path / "t.x")), q, 3).collect() == tfidf.topk(model, q, 3).collect()
    with pytest.raises(ValueError):
        tfidf.fit(spark.createDataFrame([(0, "the of"), (1, None)], "chunk_index long, text string"), "chunk_index")


def test_histogram(spark):
    df = spark.createDataFrame([(0, "Aab"), (1, "世"), (2, ""), (3, None)], "id long, text string")
    rows = {r.id: r.h for r in df.select("id", embed.histogram("text", 256).alias("h")).collect()}
    assert rows[0][97] == pytest.approx(2 / 3) and rows[0][98] == pytest.approx(1 / 3)
    assert sum(rows[1]) == 0 == sum(rows[2])


def test_stand_in_is_reproducible(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "id long, text string")
    v = {r.id: r.embedding for r in embed.stand_in(df).collect()}
    assert v[0] == v[1] != v[2] and np.linalg.norm(v[2]) == pytest.approx(1, abs=1e-6)


def test_a_failing_model_is_replaced(spark):
    def load():
        def model(texts):
            if "bad" in texts:
                raise RuntimeError("no")
            return np.ones((len(texts), 4), np.float32)

        return model

    def broken():
        raise OSError("no model here")

    df = spark.createDataFrame([(0, "good"), (1, "bad"), (2, None)], "id long, text string").repartition(3, "id")
    v = {r.id: r.embedding for r in embed.encode(df, load, dimensions=4).collect()}
    assert len(v[1]) == 4 and np.linalg.norm(v[1]) == pytest.approx(1, abs=1e-6) and v[1] != [1.0] * 4
    assert embed.encode(df, broken, dimensions=4).where("size(embedding) = 4").count() == 3
    assert embed.encode_one(load, "good") == [1.0] * 4 and len(embed.encode_one(broken, "x", 6)) == 6
    docs = spark.createDataFrame([("d", "One two. " * 100)], "doc_id string, text string")
    assert embed.chunk_and_embed(docs, load, 50, 5).where("embedding[0] = 1").count() > 3


def test_register_and_enrich(spark):
    ev = spark.createDataFrame([(1, "a", "x"), (3, "a", "y"), (2, "b", None), (4, None, "z")], "seq long, doc_id string, title string")
    assert {(r.doc_id, r.title, r.first_seq) for r in enrich.register(ev).collect()} == {("a", "y", 1), ("b", None, 2)}
    df = spark.createDataFrame([("A a\tb", 4001), ("", None)], "text string, start_char int")
    a, b = enrich.enrich(df, ("bm25_tf_idf",)).collect()
    assert (a.page_number, a.line_number) == (3, 51) and a.bm25_features.term_frequency == {"a": 2, "b": 1} and a.bm25_features.document_length == 3
    assert b.page_number is None and b.bm25_features.unique_terms == 0


def test_attach_and_render(spark):
    hits = spark.createDataFrame([(0, 1, 7, 0.5, "x" * 300), (0, 2, 8, 0.25, "y")], "query_id long, rank int, chunk_index long, score double, chunk string")
    cites = spark.createDataFrame([(5, 7, "late"), (4, 7, "early"), (3, None, "lost")], "citation_id long, chunk_index long, snippet string")
    got = {r.chunk_index: r.snippet for r in citations.attach(hits, cites).collect()}
    assert got == {7: "early", 8: None}
    assert citations.render(hits).first().output == "1. [Score: 0.5000] " + "x" * 200 + "...\n\n2. [Score: 0.2500] y"
