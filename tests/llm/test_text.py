"""Operators on text, against brute force or held-out accuracy."""

import random
import unicodedata

import numpy as np
import pytest

from packloom.llm import chars, language, leak, sentences, spam, unify

EN = "The kiln log was copied by hand, although the second reader asked for a longer note."


def _docs(spark, texts, more=""):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    return df.selectExpr("*", *more.split(", ")) if more else df


def test_canonical_in_duckdb_equals_python(spark):
    texts = [
        None, "", "plain", "Ｆｕｌｌ　ｗｉｄｔｈ", "ﬁne ﬂow oﬀer", "é é", "pаypаl", "Α ｒｅаdеr", "re­po​rt", "a b c d", "⼀⼈", "น้ำ", "น้ํา", "ё ë", "ヘヘ",
        "ﾊﾝｶｸ", "﻿x", "x² ½ №", "'quoted' -- \\ $", "x" * 200_000 + "é",
    ]
    got = {r.id: r.canonical for r in unify.with_form(_docs(spark, texts, "1 as c, 2 as t").repartition(3)).collect()}
    assert got == {i: None if t is None else chars.canonical(t) for i, t in enumerate(texts)}
    assert got[3] == "Full width" and got[4] == "fine flow offer" and got[6] == "paypal" and got[11] == got[12]
    assert unify.with_form(_docs(spark, [None]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        unify.with_form(_docs(spark, ["x"]), out="text")


def test_canonical_is_stable():
    for o in range(0x20, 0x3100):
        c = chr(o)
        once = chars.canonical(c)
        assert chars.canonical(once) == once, hex(o)
    for a, b in (("é", "e"), ("A", "a"), ("a b", "a  b"), ("a\nb", "a b"), ("2", "²")):
        assert chars.canonical(a) != chars.canonical(b)


def test_alike_pairs(spark):
    texts = ["abc", "аbc", "abc", "a​bc", "Abc", None, "", " ", " ", "x"]
    got = {(r.a, r.b) for r in unify.alike_pairs(_docs(spark, texts), "id").collect()}
    assert got == {(0, 1), (1, 2), (0, 3), (1, 3), (2, 3)}
    assert unify.alike_pairs(_docs(spark, ["same"] * 50), "id").count() == 0


def _words(text):
    fold, skip = chars.word_table()[0], []
    for ch in unicodedata.normalize("NFC", chars.canonical(text)):
        c = int(fold[ord(ch)])
        if c != 1:
            skip.append(chr(c - 2) if c else " ")
    return "".join(skip).split()


def test_leak_words_equal_plain_words():
    texts = ["", "One, two-three: FOUR 5.", "Ｆｕｌｌ ﬁne re­port е́t", "Заметка ВО время", "a" * 5000 + " b", "...", "é é"]
    w = leak.Words(texts)
    for i, t in enumerate(texts):
        assert [w.string(j) for j in range(len(w.hash)) if w.text[j] == i] == _words(t)


def test_leaks(spark):
    passage = "Nalostal said the old mirror used a narrower window in batch 17 but the sentence detector near Marorath explained all the repair steps"
    again = passage.replace("Nalostal", "Belomere").replace("17", "98").replace("Marorath", "Tamalund")
    items = spark.createDataFrame([(1, passage + "\nWhich holds?"), (2, passage), (3, None), (4, "too short"), (5, passage.split(" in ")[0])], "item_id long, text string")
    assert leak.leaks(items.limit(0).withColumnRenamed("item_id", "doc_id"), items).count() == 0
    docs = spark.createDataFrame(
        [(10, "before " + passage.upper() + " after"), (11, again), (12, "nothing of it"), (13, None), (14, " ".join(passage.split()[:12])), (15, " ".join(passage.split()[:11])), (16, ("noise " * 50_000) + passage)],
        "doc_id long, text string",
    )
    rows = leak.leaks(docs.selectExpr("*", "1 as k", "2 as key"), items).collect()
    kinds = {(r.doc_id, r.item_id): r.kind for r in rows}
    assert {k for k, v in kinds.items() if v == "exact"} == {(d, i) for d in (10, 14, 16) for i in (1, 2)}
    assert kinds[11, 1] == "reworded"
    assert not any(d in (12, 13, 15) for d, _ in kinds)
    assert leak.leaks(docs.limit(0), items).count() == 0 == leak.leaks(docs, items.limit(0)).count()


def test_a_bloom_filter_misses_nothing(spark):
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    b = leak.Bloom.of(spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long"), 5000)
    assert b.has(h).all() and b.has(rng.integers(0, 2**64, 5000, dtype=np.uint64)).mean() < 0.05


CASES = [
    ('He said: "It failed. Try again." The rest went on.', ['He said: "It failed. Try again."', "The rest went on."]),
    ("A heading\n\nOne line\nwraps here. Next one!\n- item one\n- item two", ["A heading", "One line\nwraps here.", "Next one!", "- item one", "- item two"]),
    ("他说：“坏了。再来。”第二天好了！真的吗？", ["他说：“坏了。再来。”", "第二天好了！", "真的吗？"]),
    ("Is 3.14 right? See a.txt now.", ["Is 3.14 right?", "See a.txt now."]),
    ("ทดสอบระบบ ประโยคใหม่ 64 คำ", ["ทดสอบระบบ", "ประโยคใหม่ 64 คำ"]),
]


def _trained():
    rng, n = random.Random(1), 0
    said = [
        "The reader of the mill met Dr. Holm at no. {0} near the dam.", "Anna asked for a longer note.", "Early on {0} they left at 5 p.m. for the coast.", "The log was kept.",
        'He said: "It failed. Try {0} again."', "One line wraps here.", "The team, cf. p. {0}, found the page.", "See a note on the wall.", "In the end nobody asked why.", "Next one is at the dam.",
    ]
    texts = []
    for _ in range(200):
        paragraphs = []
        for _ in range(3):
            n += 1
            paragraphs.append(" ".join(rng.choices(said, k=4)).replace("{0}", str(n)))
        texts.append("\n\n".join(paragraphs))
    return sentences.train(texts)


@pytest.mark.parametrize(("text", "want"), CASES)
def test_sentences(text, want):
    m = _trained()
    assert [text[a:b] for a, b in m.sentences(text)] == want


def test_sentences_learn_abbreviations(spark):
    m = _trained()
    text = "The clerk met Dr. Holm at no. 7 near the dam. The log was kept."
    assert [text[a:b] for a, b in m.sentences(text)] == ["The clerk met Dr. Holm at no. 7 near the dam.", "The log was kept."]
    df = _docs(spark, [None, "", " \n ", "One. Two", "One. Two", "The log was kept. " * 4000, "(((", '"'], "7 as start_char")
    rows = sentences.sentences(df, m, "id").collect()
    assert {r.id for r in rows} == {3, 4, 5, 6, 7} and sum(r.id == 5 for r in rows) == 4000
    assert sentences.sentences(df.limit(0), m, "id").count() == 0
    assert sentences.train([]).sentences("A b. C d.")


def test_language(spark):
    base = {
        "en": ["the old kiln log was copied by hand before lunch", "the second reader asked for a longer note and left", "one of the teams found the lost pages near the mill"],
        "de": ["das alte Protokoll wurde vor dem Mittag mit der Hand kopiert", "der zweite Leser wollte eine längere Notiz und ging", "eine der Gruppen fand die verlorenen Seiten bei der Mühle"],
        "fr": ["le vieux relevé du four a été copié à la main avant midi", "le second lecteur a demandé une note plus longue et sortit", "une des équipes a trouvé les pages perdues près du moulin"],
        "ru": ["старый журнал печи переписали вручную до обеда", "второй читатель попросил более длинную заметку и ушёл", "одна из групп нашла потерянные страницы около мельницы"],
    }
    rows = [(f"{a}. {b}. {a}.", k) for k, s in base.items() for a in s for b in s for _ in range(12)]
    m = language.train(rows)
    mixed = base["en"][0] + ". " + base["en"][1] + ".\n\n" + base["de"][2] + ". " + base["de"][0] + "."
    texts = [(1, base["en"][2] + ".", "en_GB"), (2, base["de"][1] + ".", "English"), (3, mixed, "eng"), (4, base["ru"][0] + ".", None), (5, None, "en"), (6, "", "en"), (7, "12 34", "en"), (8, base["fr"][1] + ".", "French")]
    df = spark.createDataFrame(texts, "id long, text string, lang string").selectExpr("*", "1 as label", "2 as k")
    found = language.segments(df, m, "id")
    got = {(r.id, r.lang) for r in language.mislabelled(found, "id").collect()}
    assert got == {(2, "de"), (3, "en"), (3, "de"), (4, "ru")}
    assert all(0 < r.confidence <= 1 for r in found.collect())
    assert language.segments(df.limit(0), m, "id").count() == 0


def test_rejected_segments_keep_their_likeliest_language(spark):
    en, ru = "The old kiln log was copied by hand before lunch and read twice. ", "Старый журнал печи переписали вручную до обеда и прочли дважды. "
    m = language.train([(en * 3, "en"), (ru * 3, "ru")] * 40)
    strict = language.Model(m.table, m.temperature, 1.01)  # rejects all
    df = spark.createDataFrame([(1, ru, None), (2, en, "ru"), (3, ru, "ru"), (4, en * 4 + "\n\n" + ru * 4, "en")], "id long, text string, lang string")
    found = language.segments(df, strict, "id")
    assert {r.lang for r in found.collect()} == {"und"}
    assert {(r.id, r.lang) for r in language.mislabelled(found, "id").collect()} == {(1, "ru"), (2, "en"), (4, "en"), (4, "ru")}


def test_labels(spark):
    df = spark.createDataFrame([("EN",), ("en-US",), ("German",), ("zh_Hans",), ("xx",), ("",), (None,), ("it",), (" fra ",)], "lang string")
    assert [r[0] for r in df.select(language.normal_label("lang")).collect()] == ["en", "en", "de", "zh", None, None, None, "other", "fr"]


def test_spam_pages(spark):
    prose = [f"The harbour log of place{i} was read twice, and a colleague kept the old notes.\nNobody asked why the kiln was cold on day {i}.\n- the mill lost {i} rows" for i in range(120)]
    words = ["buy", "cheap", "model", "index", "best", "free"]
    stuffed = [" ".join(words[(i * 7 + j * (1 + i % 5)) % 6] for j in range(60)) for i in range(20)]
    links = ["\n".join(f"https://shop{i}.test/p/{j}" for j in range(12)) for i in range(20)]
    tags = [" ".join(f"#tag{i}_{j}" for j in range(30)) for i in range(20)]
    texts = prose + stuffed + links + tags
    m = spam.Model().fit(texts)
    odd = [None, "", "\n\n", prose[0] * 2000, prose[0] + "\n\n[1] https://a.test/x"]
    got = {r.id: r.spam for r in spam.pages(_docs(spark, texts + odd, "1 as menu, 2 as prose"), m, "id").collect()}
    wrong = [i for i, t in enumerate(texts) if got[i] != (i >= 120)]
    assert len(wrong) <= 3, wrong
    assert len(texts) not in got and [got[len(texts) + i] for i in (1, 2, 3, 4)] == [False] * 4
    labels = {r.label for r in spam.label_lines(_docs(spark, links[:1] + tags[:1]), m, "id").collect()}
    assert labels <= {"link list", "tag list"}
    assert spam.pages(_docs(spark, texts).limit(0), m, "id").count() == 0


def test_spam_words_are_counted_on_all_pages(spark):
    texts = [f"The harbour log was read twice and rare{chr(97 + i % 20)} was kept." if i < 100 else "The old kiln log was read." for i in range(6000)]
    lexicon = spam.fitted(_docs(spark, texts, "1 as x"), "id").lexicon
    assert {spam._hash(f"rare{chr(97 + i)}") for i in range(20)} <= lexicon.keys()


def test_spam_model_of_a_table_equals_that_of_its_texts(spark):
    prose = [f"The harbour log of place{i % 9} was read twice, and a colleague kept the old notes.\nNobody asked why the kiln was cold." for i in range(60)]
    stuffed = ["buy cheap model index best free " * (4 + i % 3) for i in range(20)]
    tags = ["\n".join(f"#tag{j} | #cheap | free" for j in range(8 + i)) for i in range(20)]
    texts = [*prose, *stuffed, *tags, " ".join(stuffed[:2]) + "\n" + prose[0], "a | b\nhttps://a.test/x\n" * 5]
    want, got = spam.Model().fit(texts), spam.fitted(_docs(spark, texts, "1 as x"), "id")
    assert got.lexicon.keys() == want.lexicon.keys() and max(abs(got.lexicon[w] - want.lexicon[w]) for w in want.lexicon) < 1e-9
    assert abs(got.move - want.move).max() < 1e-9 and max(abs(a - b).max() for a, b in zip(got.emit, want.emit, strict=True)) < 1e-9
