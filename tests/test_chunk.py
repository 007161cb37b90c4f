import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from packloom.functions.text import WS
from packloom.operators import chunk

FOUR = "This is the first sentence. This is the second sentence! Is this the third one? Yes, it is the fourth. "


def _rows(spark, text, size, overlap, sentences=True):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(r.start_char, r.end_char, r.token_count) for r in chunk.chunk(df, size, overlap, sentences).orderBy("chunk_id").collect()]


@pytest.mark.parametrize(
    ("text", "size", "overlap", "count", "first", "last"),
    [
        (" ".join(f"Word{i}" for i in range(100)), 20, 5, 12, [(0, 80, 20), (60, 140, 20), (120, 199, 19), (180, 260, 20)], (660, 689, 7)),
        (" ".join(f"Sentence{i}." for i in range(50)), 20, 0, 9, [(0, 76, 19), (77, 145, 17), (146, 217, 17), (218, 289, 17)], (578, 589, 2)),
        ("A B C D E", 1, 0, 3, [(0, 3, 1), (4, 7, 1)], (8, 9, 1)),
        ("Ab. " + "x" * 400, 20, 5, 9, [(0, 3, 1), (1, 3, 1), (2, 82, 20), (62, 142, 20)], (362, 404, 10)),
        ("First paragraph.\n\nSecond paragraph.\n\nThird paragraph.", 50, 10, 1, [(0, 53, 13)], (0, 53, 13)),
    ],
)
def test_golden(spark, text, size, overlap, count, first, last):
    rows = _rows(spark, text, size, overlap)
    assert len(rows) == count
    assert rows[: len(first)] == first
    assert rows[-1] == last


def test_fixed_and_python_agree(spark):
    text = FOUR * 40
    df = spark.createDataFrame([(1, text), (2, " " + text[:333] + "\n"), (3, "short")], "doc_id long, text string")
    for size, overlap in ((30, 5), (20, 0), (7, 6)):
        native = chunk.chunk(df, size, overlap, False).select("doc_id", "chunk_id", "start_char", "end_char", "text").collect()
        python = {}
        for r in df.collect():
            t, n = r.text.strip(WS), 0
            for a, b in chunk.spans(t, size, overlap, False):
                part = t[a:b]
                if part.strip(WS):
                    lead = a + len(part) - len(part.lstrip(WS))
                    python[(r.doc_id, n)] = (lead, lead + len(part.strip(WS)), part.strip(WS))
                    n += 1
        assert {(r.doc_id, r.chunk_id): (r.start_char, r.end_char, r.text) for r in native} == python


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .!?\n世é", min_size=1, max_size=300), st.integers(1, 12), st.integers(0, 11), st.booleans())
def test_windows_cover_text_and_move_forward(text, size, overlap, sentences):
    text = text.strip(WS)
    found = chunk.spans(text, size, min(overlap, size - 1), sentences)
    assert all(a < b for a, b in found)
    assert all(x[0] < y[0] for x, y in zip(found, found[1:], strict=False))
    covered = {i for a, b in found for i in range(a, b)}
    assert covered == set(range(len(text)))


def test_odd_input(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t　"), (4, "x. " * 5000), (4, "x. " * 5000)], "doc_id long, text string")
    for sentences in (True, False):
        out = chunk.chunk(df, 10, 2, sentences)
        assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {4}
        assert chunk.chunk(df.limit(0), 10, 2, sentences).count() == 0


@pytest.mark.parametrize(("size", "overlap"), [(0, 0), (-1, 0), (5, -1), (5, 5), (5, 6)])
def test_bad_parameters(spark, size, overlap):
    with pytest.raises(ValueError):
        chunk.chunk(spark.createDataFrame([(1, "x")], "doc_id long, text string"), size, overlap)


def test_paragraph_boundaries(spark):
    df = spark.createDataFrame([("First paragraph.\n\nSecond paragraph.\n\nThird paragraph.",), ("\n\n\n",), ("\n\n\n\n",), ("none",), ("",)], "t string")
    assert [r[0] for r in df.select(chunk.paragraph_boundaries("t")).collect()] == [[16, 35], [0], [0, 2], [], []]


def test_custom_tokenizer(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven eight")], "doc_id long, text string")
    out = chunk.chunk(df, 3, 0, False, tokenizer=lambda: lambda t: len(t.split())).orderBy("chunk_id").collect()
    assert all(r.token_count <= 3 for r in out) and "".join(r.text for r in out).replace(" ", "") == "onetwothreefourfivesixseveneight"


def test_repeated_ids_are_numbered_each(spark):
    df = spark.createDataFrame([("d", "a" * 100), ("d", "b" * 100), ("e", None), ("f", "  ")], "doc_id string, text string")
    for sentences in (False, True):
        got = {(r.text[0], r.chunk_id) for r in chunk.chunk(df, 10, 2, sentences).collect()}
        n = len(got) // 2
        assert n > 2 and got == {(c, i) for c in "ab" for i in range(n)}
