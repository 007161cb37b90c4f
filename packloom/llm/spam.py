"""Problem 9: keyword-stuffed and link-list pages.

Method: a hidden Markov model over a page's lines with the states prose, link list, tag list and menu. Lines are
observed as four graded features; the model is fitted by expectation maximisation from plain starting values on all
pages, of which Spark sums the counts. A page is flagged when most of its characters stand in lines that aren't prose.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import delete, settle, ship

STATES = ("prose", "link list", "tag list", "menu")
WEIGHT = 3000
"""Expected counts of more pages than this weigh as those of so many, so the prior's share is the same for any table."""
LEXICON = 50_000
PASSES, ROUNDS = 2, 3
PRIOR = 200.0
"""The starting values count as so many lines of each state, so the states keep their meaning."""
URL = re.compile(r"(?:https?://|www\.)\S+|(?<![\w@])[\w-]+(?:\.[\w-]+)*\.[a-z]{2,10}/\S*|</?a\b[^>]*>")
ITEM = re.compile(r"^(?:[-*•–]|\[?\d{1,3}[.)\]]|[a-z][.)])\s+")
LETTERS = 12
"""A line counts as at least one word for so many characters, so that lines of scripts without spaces are measured like others."""
SEPARATORS = frozenset("| / > < ; · • » → - – — ~ * :: / // || >>".split())
STRIP = ".,;:!?()[]{}<>«»“”„\"'’‘`#|/。，、！？（）「」…"
# The grades of a line's features: share of link characters, of separators, evenness of repetition, spam words.
LINK, MARKS, REPEAT, WORDS = (0.15, 0.5), (0.15, 0.3, 0.45), (0.012, 0.025, 0.045, 0.08), (-1.0, -0.25, 0.25, 1.0)
# Fixed starting values: how likely each grade is in each state.
START = [
    [(0.95, 0.04, 0.01), (0.80, 0.17, 0.02, 0.01), (0.72, 0.21, 0.05, 0.017, 0.003), (0.55, 0.25, 0.18, 0.015, 0.005)],
    [(0.04, 0.16, 0.80), (0.55, 0.25, 0.12, 0.08), (0.70, 0.14, 0.08, 0.05, 0.03), (0.06, 0.10, 0.54, 0.15, 0.15)],
    [(0.95, 0.03, 0.02), (0.05, 0.15, 0.30, 0.50), (0.25, 0.20, 0.20, 0.15, 0.20), (0.03, 0.07, 0.35, 0.20, 0.35)],
    [(0.96, 0.03, 0.01), (0.60, 0.20, 0.12, 0.08), (0.02, 0.06, 0.15, 0.22, 0.55), (0.02, 0.08, 0.25, 0.25, 0.40)],
]
STAY = 0.9


def _grade(x: float, steps: tuple[float, ...]) -> int:
    return sum(x >= s for s in steps)


def _tokens(line: str) -> list[str]:
    return [w for t in line.lower().split() if (w := t.strip(STRIP))]


def _parts(text: str) -> tuple[list[str], list[str], list[list[str]]]:
    """The lines that aren't blank, the same without the mark of a list item, which says nothing, and their words."""
    lines = [x for line in text.split("\n") if (x := line.strip())]
    bare = [ITEM.sub("", x) or x for x in lines]
    return lines, bare, [_tokens(x) for x in bare]


def _shapes(bare: list[str], words: list[list[str]]) -> list[tuple[int, int, int]]:
    """The grades of the features that need no word scores."""
    out = []
    for i, (line, own) in enumerate(zip(bare, words, strict=True)):
        link = sum(len(m) for m in URL.findall(line)) / len(line) if "/" in line or "www." in line or "<a" in line else 0.0
        raw = line.split()
        marks = sum(t in SEPARATORS or t[0] == "#" for t in raw) + 0.5 * (line.count(", ") + sum(map(_has_digit, raw)))
        near, j, k = own, i, i + 1
        while len(near) < 25 and (j > max(0, i - 3) or k < min(len(words), i + 4)):  # short lines are judged with those around them
            j, k = max(j - 1, 0, i - 3), min(k + 1, len(words), i + 4)
            near = [w for x in words[j:k] for w in x]
        out.append((_grade(link, LINK), _grade(marks / max(len(raw), 6, len(line) / LETTERS), MARKS), _grade(_repetition(near), REPEAT)))
    return out


def _has_digit(t: str) -> bool:
    return any("0" <= c <= "9" for c in t)


def _repetition(words: list[str]) -> float:
    """The chance that two of the words are the same, leaving out the commonest one unless it makes up a quarter."""
    if len(words) < 10:
        return 0.0
    counts = sorted(Counter(words).values())
    top = counts.pop()
    n = len(words) - top
    return 1.0 if 4 * top > len(words) or n < 2 else sum(c * (c - 1) for c in counts) / (n * (n - 1))


_hashes: dict[str, int] = {}


def _hash(word: str) -> int:
    known = _hashes.get(word)
    if known is None:
        if len(_hashes) > 500_000:
            _hashes.clear()
        known = _hashes[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
    return known


class Pages:
    """What the model sees of pages: the lines of each; of every line its shape, its length and its number of words; the words' hashes, one after the other. Words with digits are left out."""

    def __init__(self, lines: np.ndarray, shapes: np.ndarray, lengths: np.ndarray, counts: np.ndarray, words: np.ndarray) -> None:
        self.lines, self.shapes, self.lengths, self.counts, self.words = lines, shapes, lengths, counts, words
        self.begin = np.cumsum(lines) - lines

    @staticmethod
    def rows(texts: list[str]) -> list[tuple[bytes, bytes, bytes, bytes]]:
        """For each text the bytes of its shapes, lengths, counts and words."""
        out = []
        for text in texts:
            lines, bare, words = _parts(text)
            shapes = bytes(a + 3 * b + 12 * c for a, b, c in _shapes(bare, words))
            kept = [[_hash(w) for w in own if not _has_digit(w)] for own in words]
            out.append((shapes, np.array([len(x) for x in lines], np.int32).tobytes(), np.array([len(x) for x in kept], np.int32).tobytes(), np.array([h for x in kept for h in x], np.uint32).tobytes()))
        return out

    @classmethod
    def of(cls, shapes: list[bytes], lengths: list[bytes], counts: list[bytes], words: list[bytes]) -> Pages:
        join = lambda x, kind: np.frombuffer(b"".join(x), kind)
        return cls(np.array([len(x) for x in shapes], np.int64), join(shapes, np.uint8), join(lengths, np.int32), join(counts, np.int32), join(words, np.uint32))

    @classmethod
    def of_texts(cls, texts: list[str]) -> Pages:
        rows = cls.rows(texts)
        return cls.of(*([r[i] for r in rows] for i in range(4)))

    def line_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def codes(self, hashes: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The grades of each line in one number; ``hashes`` are the lexicon's, sorted."""
        x = np.zeros(len(self.shapes))
        if len(hashes) and len(self.words):
            at = np.minimum(np.searchsorted(hashes, self.words), len(hashes) - 1)
            known = hashes[at] == self.words
            line = self.line_of_word()[known]
            x = np.bincount(line, scores[at[known]], len(x)) / np.maximum(np.maximum(np.bincount(line, minlength=len(x)), 3), self.lengths / (2 * LETTERS))
        return self.shapes + 60 * np.searchsorted(np.array(WORDS), x, side="right").astype(np.uint16)


def _grades(codes: np.ndarray) -> np.ndarray:
    """(lines) -> (lines, 4 grades)."""
    c = codes.astype(np.int64)
    return np.stack([c % 3, c // 3 % 4, c // 12 % 5, c // 60], axis=1)


def _stacks(lines: np.ndarray, room: int = 200_000) -> Iterator[np.ndarray]:
    """Pages, the longest first, in groups that fill about ``room`` lines when they are padded to the longest."""
    order = np.argsort(-lines, kind="stable")
    order = order[lines[order] > 0]
    at = 0
    while at < len(order):
        n = max(1, room // int(lines[order[at]]))
        yield order[at : at + n]
        at += n


class Model:
    """Starting probabilities, transitions, graded emissions and the word scores."""

    def __init__(self) -> None:
        n = len(STATES)
        self.first = np.array([0.91, 0.03, 0.03, 0.03])
        self.move = np.full((n, n), (1 - STAY) / (n - 1))
        np.fill_diagonal(self.move, STAY)
        self.emit = [np.array([START[s][f] for s in range(n)]) for f in range(4)]
        self.lexicon: dict[int, float] = {}

    def sorted_lexicon(self) -> tuple[np.ndarray, np.ndarray]:
        hashes = np.array(sorted(self.lexicon), np.uint32)
        return hashes, np.array([self.lexicon[h] for h in hashes.tolist()])

    def _padded(self, codes: np.ndarray, begin: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lines, pages, states): the densities of pages of falling length, and how many pages have each line."""
        many = (lines[None, :] > np.arange(lines[0])[:, None]).sum(axis=1)
        at = np.minimum(begin[None, :] + np.arange(lines[0])[:, None], len(codes) - 1)
        g = _grades(np.arange(60 * (len(WORDS) + 1)))
        table = np.prod([e.T[g[:, f]] for f, e in enumerate(self.emit)], axis=0)
        return table[codes[at]], many

    def labels(self, codes: np.ndarray, begin: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """The most likely states of all pages' lines."""
        out = np.zeros(len(codes), np.int8)
        move = np.log(self.move)
        for own in _stacks(lines):
            b, n = begin[own], lines[own]
            d, many = self._padded(codes, b, n)
            logs = np.log(d)
            best, back = np.log(self.first) + logs[0], np.zeros(d.shape, np.int8)
            for t in range(1, len(d)):
                to = best[: many[t], :, None] + move
                back[t, : many[t]] = to.argmax(axis=1)
                best[: many[t]] = to.max(axis=1) + logs[t, : many[t]]
            state = best.argmax(axis=1)
            for t in range(len(d) - 1, -1, -1):
                m = many[t]
                out[b[:m] + t] = state[:m]
                state[:m] = back[t, np.arange(m), state[:m]]
        return out

    def fit(self, texts: list[str]) -> Model:
        """Expectation maximisation on whole pages; the starting values weigh in as earlier counts."""
        pages = Pages.of_texts(texts)
        for _ in range(PASSES):  # each pass scores words by the lines that the model before it labels
            words, prose, other = self.counted(pages)
            n = prose + other
            best = np.lexsort((words, -n))[:LEXICON]
            self.score([(int(words[i]), int(prose[i]), int(other[i])) for i in best if n[i] >= 5], [int(prose.sum()), int(other.sum())])
            codes = pages.codes(*self.sorted_lexicon())
            for _ in range(ROUNDS):
                self.maximise(self.expected(codes, pages.begin, pages.lines, np.ones(len(pages.lines))))
        return self

    def counted(self, pages: Pages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes and how often they come in prose and in other lines."""
        codes = pages.codes(*self.sorted_lexicon())
        label = self.labels(codes, pages.begin, pages.lines) > 0
        line = pages.line_of_word()
        taken = np.ones(len(codes), bool)
        if not self.lexicon:  # without word scores, repetition that prose may have too decides nothing
            g = _grades(codes)
            taken = ~label | (g[:, 0] >= 2) | (g[:, 1] >= 2) | (g[:, 2] >= 4)
        taken, label = taken[line], label[line]
        words, at = np.unique(pages.words[taken], return_inverse=True)
        other = np.bincount(at, label[taken], len(words)).astype(np.int64)
        return words, np.bincount(at, minlength=len(words)) - other, other

    def score(self, words: list[tuple[int, int, int]], total: list[int]) -> None:
        """Word scores from (hash, times in prose, times elsewhere) and the sums of both over all words."""
        a, b = (n + 1.0 for n in total)
        self.lexicon = {w: float(np.clip(np.log((other + 0.5) / b) - np.log((prose + 0.5) / a), -3, 3)) for w, prose, other in words}

    def expected(self, codes: np.ndarray, begin: np.ndarray, lines: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected counts of starts, moves and grades in pages, each counted so many ``times``, one after the other."""
        first, move, by_code = np.zeros(4), np.zeros((4, 4)), np.zeros((60 * (len(WORDS) + 1), 4))
        for own in _stacks(lines):
            b, n, w = begin[own], lines[own], times[own].astype(np.float64)
            d, many = self._padded(codes, b, n)
            a, back = np.zeros_like(d), np.ones_like(d)
            a[0] = self.first * d[0]
            a[0] /= a[0].sum(axis=1, keepdims=True)
            for t in range(1, len(d)):
                x = (a[t - 1, : many[t]] @ self.move) * d[t, : many[t]]
                a[t, : many[t]] = x / x.sum(axis=1, keepdims=True)
            for t in range(len(d) - 2, -1, -1):
                m = many[t + 1]
                x = (d[t + 1, :m] * back[t + 1, :m]) @ self.move.T
                back[t, :m] = x / x.sum(axis=1, keepdims=True)
            for t in range(len(d)):
                m = many[t]
                post = a[t, :m] * back[t, :m]
                post *= (w[:m] / post.sum(axis=1))[:, None]
                np.add.at(by_code, codes[b[:m] + t].astype(np.int64), post)
                if t == 0:
                    first += post.sum(axis=0)
                else:
                    x = a[t - 1, :m, :, None] * self.move * (d[t, :m] * back[t, :m])[:, None, :]
                    move += (x * (w[:m] / x.sum(axis=(1, 2)))[:, None, None]).sum(axis=0)
        g = _grades(np.arange(len(by_code)))
        emit = [np.stack([np.bincount(g[:, f], by_code[:, s], e.shape[1]) for s in range(4)]) for f, e in enumerate(self.emit)]
        return np.concatenate([first, move.ravel(), *(e.ravel() for e in emit)])

    def maximise(self, counts: np.ndarray) -> None:
        """Set the probabilities from expected counts and the prior's."""
        start = Model()
        parts = np.split(counts, np.cumsum([4, 16, *(e.size for e in self.emit)])[:-1])
        first, move = parts[0] + 1 + 20 * start.first, parts[1].reshape(4, 4) + 1 + 50 * start.move
        emit = [p.reshape(e.shape) + PRIOR * e for p, e in zip(parts[2:], start.emit, strict=True)]
        self.first, self.move = first / first.sum(), move / move.sum(axis=1, keepdims=True)
        self.emit = [e / e.sum(axis=1, keepdims=True) for e in emit]


FEATURES = ("shapes", "lengths", "counts", "words")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, t) -> (k, shapes, lengths, counts, words)."""
    for batch in batches:
        rows = Pages.rows(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(4))], ["k", *FEATURES])


def _seen(batch: pa.RecordBatch) -> Pages:
    return Pages.of(*(batch.column(c).to_pylist() for c in FEATURES))


def _counted(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Features -> (w, prose, other), sums over a batch."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in model.counted(_seen(batch))], ["w", "prose", "other"])


def _coded(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Features -> (codes), the grades of each page's lines."""
    lexicon = model.sorted_lexicon()
    for batch in batches:
        pages = _seen(batch)
        codes = pages.codes(*lexicon).astype("<u2").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([codes[2 * b : 2 * (b + n)] for b, n in zip(pages.begin.tolist(), pages.lines.tolist(), strict=True)], pa.binary())], ["codes"])


def _expected(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(codes, n) -> (i, x), the expected counts of a batch by their place."""
    for batch in batches:
        own = batch.column(0).to_pylist()
        lines = np.array([len(c) // 2 for c in own], np.int64)
        x = model.expected(np.frombuffer(b"".join(own), "<u2"), np.cumsum(lines) - lines, lines, batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(x)), pa.int32()), pa.array(x)], ["i", "x"])


def features(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What the model sees of each page that has a key and a text, settled, so that texts are read and cut into words once."""
    return settle(_usable(documents, key, text).mapInArrow(_features, "k long, " + ", ".join(f"{c} binary" for c in FEATURES)))[0]


def fit(seen: DataFrame) -> Model:
    """A model fitted on all pages of ``features``: the driver gets sums, at most ``LEXICON`` words and a place for each probability.

    Pages of the same grades, line by line, count as one page so many times.
    """
    spark = seen.sparkSession
    seen = seen.where("length(shapes) > 0")
    model, scale = Model(), min(1.0, WEIGHT / max(seen.count(), 1))
    for _ in range(PASSES):
        sent = spark.sparkContext.broadcast(model)
        words = seen.mapInArrow(lambda it, sent=sent: _counted(it, sent.value), "w long, prose long, other long")
        words, held = settle(words.groupBy("w").agg(F.sum("prose").alias("prose"), F.sum("other").alias("other")))
        total = words.agg(F.coalesce(F.sum("prose"), F.lit(0)), F.coalesce(F.sum("other"), F.lit(0))).first()
        n = F.col("prose") + F.col("other")
        model.score([tuple(r) for r in words.where(n >= 5).orderBy(n.desc(), "w").limit(LEXICON).collect()], list(total))
        delete(spark, held)
        sent = spark.sparkContext.broadcast(model)
        codes, held = settle(seen.mapInArrow(lambda it, sent=sent: _coded(it, sent.value), "codes binary").groupBy("codes").count())
        for _ in range(ROUNDS):
            sent = spark.sparkContext.broadcast(model)
            sums = codes.mapInArrow(lambda it, sent=sent: _expected(it, sent.value), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
            if sums:
                model.maximise(scale * np.array([r.x for r in sorted(sums)]))
        delete(spark, held)
    return model


def fitted(documents: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """A model fitted on all pages of ``documents``."""
    return fit(features(documents, key, text))


def _judged(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Features -> (k, prose, links, tags, menu), characters of each label."""
    lexicon = model.sorted_lexicon()
    for batch in batches:
        pages = _seen(batch)
        label = model.labels(pages.codes(*lexicon), pages.begin, pages.lines)
        cell = np.repeat(np.arange(len(pages.lines)), pages.lines) * len(STATES) + label
        n = np.bincount(cell, pages.lengths, len(pages.lines) * len(STATES)).astype(np.int64).reshape(-1, len(STATES))
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, np.ascontiguousarray(n.T))], ["k", "prose", "links", "tags", "menu"])


def _lines(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    lexicon = model.sorted_lexicon()
    for batch in batches:
        texts = batch.column(1).to_pylist()
        pages = Pages.of_texts(texts)
        label = model.labels(pages.codes(*lexicon), pages.begin, pages.lines)
        at = pa.array(np.repeat(np.arange(len(texts)), pages.lines))
        number = (np.arange(len(label)) - np.repeat(pages.begin, pages.lines)).astype(np.int32)
        lines = [x for text in texts for x in _parts(text)[0]]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(number), pa.array(lines, pa.string()), pa.array([STATES[s] for s in label], pa.string())], ["k", "line", "text", "label"])


def _usable(documents: DataFrame, key: str, text: str) -> DataFrame:
    ship(documents.sparkSession)
    return documents.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))


def label_lines(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every line that isn't blank with its label: (``key``, ``line``, ``text``, ``label``). See ``judged`` for odd input."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    out = _usable(documents, key, text).mapInArrow(lambda it: _lines(it, sent.value), "k long, line int, text string, label string")
    return out.withColumnRenamed("k", key)


def judged(seen: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """Of each page of ``features`` its characters by label, the share that isn't prose, and whether it is spam.

    Null texts give no row, blank ones none of any label and no spam. Every row is labelled on its own, so repeated
    rows are reported each; very long pages are taken whole; an empty table gives no rows; extra columns are not read.
    """
    sent = seen.sparkSession.sparkContext.broadcast(model)
    out = seen.mapInArrow(lambda it: _judged(it, sent.value), "k long, prose long, links long, tags long, menu long")
    other, total = F.col("links") + F.col("tags") + F.col("menu"), F.col("prose") + F.col("links") + F.col("tags") + F.col("menu")
    share = F.when(total > 0, other / total).otherwise(0.0)
    return out.withColumnRenamed("k", key).withColumns({"other_share": share, "spam": share > 0.5})


def pages(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``judged`` of documents whose features aren't at hand."""
    return judged(_usable(documents, key, text).mapInArrow(_features, "k long, " + ", ".join(f"{c} binary" for c in FEATURES)), model, key)
