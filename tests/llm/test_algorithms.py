"""Operators that plain Python can redo on small fixtures."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from packloom.llm import classes, mix, neardup, neighbours, split

LONG = "The kiln log was copied by hand. " * 3000


def _rows(spark, texts, tab="t"):
    return spark.createDataFrame([(tab, i, t) for i, t in enumerate(texts)], "tab string, k long, t string")


def _brute(texts, least):
    low = [neardup.normal(t or "") for t in texts]
    grams = [{t[i : i + 5] for i in range(len(t) - 4)} for t in low]
    out = set()
    for i, j in itertools.combinations(range(len(texts)), 2):
        if grams[i] and grams[j] and low[i].strip() and low[j].strip() and texts[i] != texts[j] and len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= least:
            out.add((i, j))
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}rd" for i in range(80)]
    base = [" ".join(rng.choices(words, k=40)) for _ in range(25)]
    texts = list(base)
    for t in base[:12]:
        w = t.split()
        w[rng.randrange(40)] = "changed"
        texts += [" ".join(w), t.upper(), t + " ", t]
    texts += [None, "", "   ", "abc", "abc", LONG, LONG + "x"]
    got = {(r.id_a, r.id_b) for r in neardup.similar_pairs(_rows(spark, texts)).collect()}
    want = _brute(texts, 0.7)
    assert got <= want and len(got) >= 0.99 * len(want)
    clashing = _rows(spark, texts).selectExpr("*", "1 as a", "2 as cls", "3 as raw")
    assert neardup.similar_pairs(clashing.select("tab", "k", "t", "a", "cls")).count() == len(got)


def test_near_duplicates_just_above_the_threshold(spark):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    texts = [same + letters(42) for same in (letters(204) for _ in range(400)) for _ in range(2)]  # 200 of 284 substrings are shared
    want = {(i, i + 1) for i in range(0, 800, 2) if _brute(texts[i : i + 2], 0.7)}
    got = {(r.id_a, r.id_b) for r in neardup.similar_pairs(_rows(spark, texts)).collect()}
    assert len(want) > 390 and got == want


def test_near_duplicates_keep_tables_apart_and_take_hot_texts(spark):
    same = ["one two three four five six seven"] * 300 + ["One two three four five six seven"]
    rows = _rows(spark, same).union(_rows(spark, same[-1:], "u"))
    got = neardup.similar_pairs(rows).collect()
    assert len(got) == 300 and {r.tab for r in got} == {"t"}
    assert neardup.similar_pairs(rows.limit(0)).count() == 0


def test_groups(spark):
    a = "the harbour log of the old mill was read twice by the review team"
    texts = [a, a.replace("twice", "twicE"), a + "!", "something else entirely that is not like it", a]
    got = {r.id: (r.group, r.links) for r in neardup.groups(_rows(spark, texts)).collect()}
    assert {got[i][0] for i in (0, 1, 2, 4)} == {0} and got[3] == (3, 0) and got[0][1] == 1


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(5, 5), (7, None)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in classes.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert classes.components(spark.createDataFrame([], "a long, b long")).count() == 0


def _exact(ids, m, k):
    u = m.astype(np.float64) / np.linalg.norm(m.astype(np.float64), axis=1)[:, None]
    s = np.round(u @ u.T, 6)
    np.fill_diagonal(s, -9)
    return {(int(ids[i]), int(ids[j])) for i in range(len(ids)) for j in np.lexsort((ids, -s[i]))[:k] if i != j}


def test_nearest_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16)) * 2
    m = (centres[rng.integers(0, 30, 900)] + rng.standard_normal((900, 16))).astype(np.float32)
    m[100:130] = m[100]
    ids = np.arange(900) * 3 + 1
    odd = [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [1.0] * 15), (5005, [None] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, m, strict=True)] + odd, "vec_id long, embedding array<float>")
    df = df.selectExpr("*", "1 as node", "2 as other", "3 as q").repartition(5)
    got = {(r.id, r.other) for r in neighbours.nearest(df, size=16).collect()}
    want = _exact(ids, m, 10)
    assert len(got) == len(want) and len(got & want) >= 0.97 * len(want)
    assert {b for a, b in got if a == 100 * 3 + 1} == {b for a, b in want if a == 100 * 3 + 1}  # ties of equal vectors


def test_nearest_of_few(spark):
    make = lambda n: spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(n)], "vec_id long, embedding array<float>")
    assert neighbours.nearest(make(0), size=2).count() == 0
    assert neighbours.nearest(make(1), size=2).count() == 0
    assert neighbours.nearest(make(3), size=2).count() == 6


def test_search_and_levels_on_many_clusters(spark, monkeypatch):
    """More clusters than pivots, blocks split level by level, and a third of all vectors close together."""
    monkeypatch.setattr(neighbours, "PIVOTS", 8)
    monkeypatch.setattr(neighbours, "BLOCK", 32)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((200, 24)) * 3
    m = np.concatenate([centres[rng.integers(0, 200, 800)] + rng.standard_normal((800, 24)), centres[0] + 0.5 * rng.standard_normal((400, 24))]).astype(np.float32)
    ids = rng.permutation(len(m))
    df = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, m, strict=True)], "vec_id long, embedding array<float>")
    exact = _exact(ids, m, 10)
    found = {(r.id, r.other) for r in neighbours.search(df, df.where("vec_id % 10 = 0"), size=24).collect()}
    want = {(a, b) for a, b in exact if a % 10 == 0}
    assert len(found & want) >= 0.95 * len(want) and {a for a, _ in found} == {a for a, _ in want}
    assert neighbours.search(df.limit(0), df, size=24).count() == 0


def test_hot_buckets_and_packed_keys():
    rng = np.random.default_rng(2)
    n, held = 700, neardup.Packed(2)
    same = rng.integers(0, 2**64, neardup.BANDS, dtype=np.uint64)
    held.keys = [np.append(same[:1], rng.integers(0, 2**64, neardup.BANDS - 1, dtype=np.uint64)) for _ in range(n)]  # all share one key
    held.name = 5
    rows = held.rows()
    batch = lambda r: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*r, strict=True), (pa.int32(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["part", "block", "n", "blob"])
    again = [x for r in rows for b in neardup._repeated(iter([batch([r])])) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    cls, words = np.arange(n) * 7, np.tile(rng.integers(0, 2**62, 4), (n, 1))
    who = pa.RecordBatch.from_arrays([pa.array([5] * (1 + len(again))), pa.array([True] + [False] * len(again)), pa.array([n] + [x[1] for x in again], pa.int32()), pa.array([cls.tobytes() + words.tobytes()] + [x[2] for x in again])], ["block", "who", "n", "blob"])
    named = pa.Table.from_batches(list(neardup._named(iter([who])))).sort_by("bucket")
    sizes = np.unique(named.column("bucket").to_numpy(), return_counts=True)[1]
    assert sizes.max() <= 3 * neardup.BUCKET
    pairs = [p for b in neardup._likely(iter(named.combine_chunks().to_batches())) for p in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    assert len(set(pairs)) == n * (n - 1) // 2


@pytest.mark.parametrize("text", ["word " * 400, "x" * 1000, "A sentence. " * 90 + "\n\n" + "Another one here. " * 60, "界" * 700 + "。" + "é" * 300, "é" * 600])
@pytest.mark.parametrize(("size", "overlap"), [(20, 5), (50, 0), (7, 6)])
def test_pieces(text, size, overlap):
    found = split.pieces_of(0, len(text), size, overlap, text)
    assert found[0][0] == 0 and found[-1][1] == len(text)
    assert all((b - a) // 4 <= size for a, b in found)
    assert all(x[1] - y[0] == min(4 * overlap, x[1]) and x[1] < y[1] for x, y in zip(found, found[1:], strict=False))


def test_pieces_cut_at_paragraphs_first():
    text = "a b c. " * 20 + "\n\n" + "d e f. " * 20
    assert split.pieces_of(0, len(text), 45, 0, text)[0][1] == text.index("d e f")


def test_pieces_of_odd_items(spark):
    schema = "tab string, id long, lo int, hi int, text string, text_at int, size int, overlap int, piece int"
    items = [("c", 1, 0, 400, "w " * 200, 0, 10, None, 9), ("c", 2, 9, 3, None, 0, 10, 1, 9), ("c", 3, None, 900, None, 0, 10, 1, 9), ("c", 4, 0, 43, None, 0, 10, 1, 9), ("c", 5, 100, 500, None, 0, 10, 2, 9), ("c", 6, 0, 900, "", 0, None, 1, 9), ("c", 7, 0, 44, None, 0, 10, 10, 9)]
    got = split.pieces(spark.createDataFrame(items, schema)).collect()
    assert {r.id for r in got} == {1, 5, 7}
    assert min(r.start_char for r in got if r.id == 5) == 100 and all(r.text is None for r in got if r.id == 5)
    assert split.pieces(spark.createDataFrame([], schema)).count() == 0


def test_mixture(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice("aab"), "x" * rng.randrange(4, 400), 1) for i in range(600)] + [(900, "c", "y" * 40, 1), (901, None, "z", 1), (902, "a", None, 1), (903, "a", "  ", 1)]
    documents = spark.createDataFrame(docs, "doc_id long, source string, text string, tokens int")
    targets = spark.createDataFrame([(1, "a", 1.0, 1), (1, "b", 1.0, 5), (1, "c", 2.0, 3), (1, "none", 1.0, 2), (2, "a", None, 1), (2, "b", 3.0, None)], "mix_id long, source string, weight double, max_repeats int")
    rows = mix.sized(documents)
    ordered = rows.orderBy("source", "before").collect()
    own = {}
    for r in ordered:
        assert r.before == own.get(r.source, 0)
        own[r.source] = own.get(r.source, 0) + r.tokens
    assert own["c"] == 10 and sum(own.values()) == sum(max(1, len(t) // 4) for i, s, t, _ in docs if s and t and t.strip())
    plans = mix.plan(rows, targets)
    report = {(r.mix_id, r.source): r for r in mix.shares(rows, plans).collect()}
    total = own["a"] + own["b"] + own["c"]
    assert {k for k, r in report.items() if r.short} == {(1, "c"), (1, "none"), (2, "b")}
    assert report[1, "c"].reached == 30
    for s in "ab":
        assert abs(report[1, s].reached - total / 5) <= 50
    assert report[2, "a"].reached == 0
    most = {(r.mix_id, r.source): 0 for r in plans.collect()}
    for r in mix.mixture(rows, plans).collect():
        most[r.mix_id, r.source] = max(most[r.mix_id, r.source], r.repeats)
    assert most[1, "a"] <= 1 and most[1, "b"] <= 5 and most[1, "c"] == 3
    assert mix.shares(mix.sized(documents.limit(0)), mix.plan(rows.limit(0), targets)).where("reached > 0").count() == 0
