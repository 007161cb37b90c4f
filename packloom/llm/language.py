"""Problem 3: missing or wrong document language labels.

Method: averaged hashed subword embeddings with a linear softmax, trained by stochastic gradient descent in numpy
on a bounded sample of the declared labels, with a temperature and a rejection threshold set on held-out texts.
A text is a sequence of units (sentences or lines); the languages of its units are decided together, so a change
of language needs evidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import settle, ship
from packloom.functions.text import not_blank
from packloom.llm import chars
from packloom.llm.sample import least_hashed

LANGUAGES = ("de", "en", "es", "fr", "hi", "ja", "pt", "ru", "th", "zh")
# Codes and names of the languages; regional forms are told by what stands before "-" or "_".
SPELLINGS = {
    "de": "de deu ger german deutsch",
    "en": "en eng english",
    "es": "es spa spanish español espanol castellano castilian",
    "fr": "fr fra fre french français francais",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "ja": "ja jp jpn japanese 日本語",
    "pt": "pt por portuguese português portugues",
    "ru": "ru rus russian русский",
    "th": "th tha thai ไทย ภาษาไทย",
    "zh": "zh zho chi cmn chinese mandarin 中文 汉语 漢語",
}
# Labels that name no language.
USELESS = "xx und unknown none null n/a na nan mul zxx mis ? -".split()
SAMPLE, PER_LANGUAGE, HELD_OUT = 4000, 900, 0.2
"""Texts of the least hashed keys that training reads, the most units of one language it uses, the share it tests on."""
BUCKETS, DIMENSIONS, ORDERS = 1 << 16, 12, (1, 2, 3)
EPOCHS, BATCH, RATE = 3, 32, 0.5
ERROR = 0.01
SWITCH = 5.0
"""What a change of language costs, in units of log likelihood; 20 letters count as one observation."""
UNIT = re.compile(r"[.!?…।]+[\"”’»)\]]*\s+|[。！？]+[」』”’）]*\s*|\n+|(?<=[ก-๎])[^\S\n]+(?=[ก-๎])")
LEAST, DOUBT = 12, 40
"""Units of fewer letters join a neighbour; a unit of 40 or more that is below the least confidence is set apart."""


def normal_label(label: F.Column | str) -> F.Column:
    """The two-letter code of a declared label; null if it is missing or useless, ``other`` for any other language."""
    low = F.lower(F.trim(F.col(label) if isinstance(label, str) else label))
    names = {n: k for k, v in SPELLINGS.items() for n in v.split()}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    head = F.regexp_extract(low, r"^([^\s_\-(]+)", 1)
    useless = low.isNull() | low.isin(*USELESS, "")
    return F.when(useless, None).otherwise(F.coalesce(table[low], table[head], F.lit("other")))


def units(text: str) -> list[tuple[int, int]]:
    """Parts of a text that end at an end mark or a line break; parts without enough letters go with their neighbour."""
    out, at = [], 0
    for m in [*UNIT.finditer(text), None]:
        end = m.end() if m else len(text)
        if end - at >= LEAST or m is None:
            if end > at:
                if out and end - at < LEAST:
                    out[-1] = (out[-1][0], end)
                else:
                    out.append((at, end))
            at = end
    return out


def _folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the texts in one array, others 0, and where each text begins. Offsets are those of the texts.

    Codes, that is runs of ASCII letters, digits and hyphens with a digit, belong to no language and are 0 too.
    """
    points, starts = chars.pack(texts)
    letters = _letters()[points]
    digit = (points >= 48) & (points <= 57)
    run = digit | (points == 45) | ((points | 32) >= 97) & ((points | 32) <= 122)
    edges = np.flatnonzero(np.diff(run.astype(np.int8), prepend=0, append=0))
    begin, end = edges[::2], edges[1::2]
    count = np.concatenate([[0], np.cumsum(digit)])
    coded = count[end] > count[begin]
    change = np.zeros(len(points) + 1, np.int8)
    change[begin[coded]] += 1
    change[end[coded]] -= 1
    letters = np.where(np.cumsum(change[:-1]) > 0, 0, letters)
    return letters.astype(np.uint32), starts


_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _table
    if _table is None:
        table = chars.word_table()[0].copy()
        table[table == 1] = 0
        for o in np.flatnonzero(table):
            if chr(o).isdigit():
                table[o] = 0
        for a, b in ((0x900, 0x980), (0xE31, 0xE4F)):  # vowel signs are part of these scripts' words
            for o in range(a, b):
                table[o] = table[o] or o + 2
        _table = table
    return _table


def _grams(letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the buckets of the substrings that begin at each place, and whether a letter begins them."""
    x = letters.astype(np.uint64)
    h = np.zeros(len(x), np.uint64)
    begins = letters != 0
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros_like(x)
        shifted[: len(x) - order + 1] = x[order - 1 :]
        h = (h + shifted + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if order in ORDERS:
            yield (h >> np.uint64(20)) % np.uint64(BUCKETS), begins


class Model:
    """Scores of the languages for each bucket of substrings, a temperature and a least confidence."""

    def __init__(self, table: np.ndarray, temperature: float, least: float) -> None:
        self.table, self.temperature, self.least = table.astype(np.float32), temperature, least

    def logits(self, letters: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Averaged scores of the spans that begin at ``starts`` and their numbers of letters."""
        at = np.flatnonzero(letters)
        total = np.zeros((len(at) + 1, len(LANGUAGES)), np.float32)
        for buckets, _ in _grams(letters):
            total[:-1] += self.table[buckets[at]]
        begins = np.searchsorted(at, starts)
        n = np.diff(np.append(begins, len(at)))
        sums = np.add.reduceat(total, begins, axis=0)
        sums[n == 0] = 0
        return sums / (np.maximum(n, 1) * len(ORDERS) * self.temperature)[:, None], n

    def log_probabilities(self, letters: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z, n = self.logits(letters, starts)
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True)), n

    def segments(self, texts: list[str]) -> list[list[tuple[int, int, int, float, int, bool]]]:
        """For each text its segments of one language: (begin, end, language number, confidence, letters, whether doubtful)."""
        spans = [units(t) for t in texts]
        if not any(spans):
            return [[] for _ in texts]
        letters, offsets = _folded(texts)
        # every text's units cover it without a gap, so their begins split the letters
        begins = np.array([offsets[i] + a for i, s in enumerate(spans) for a, _ in s], np.int64)
        logs, n = self.log_probabilities(letters, begins)
        out, at = [], 0
        best = logs.argmax(axis=1)
        for s in spans:
            lp, count, top = logs[at : at + len(s)], n[at : at + len(s)], best[at : at + len(s)]
            at += len(s)
            if not count.any():
                out.append([])
                continue
            path = top.tolist() if (top == top[0]).all() else self._path(lp * (np.minimum(count, 400) / 20)[:, None])
            found: list[list] = []
            for (a, b), language, row, letters_here in zip(s, path, lp, count.tolist(), strict=True):
                doubtful = letters_here >= DOUBT and np.exp(row[language]) < self.least
                if found and found[-1][2] == language and found[-1][5] == doubtful:
                    found[-1][1] = b
                    found[-1][3] += row * letters_here
                    found[-1][4] += letters_here
                else:
                    found.append([a, b, language, row * letters_here, letters_here, doubtful])
            out.append([(a, b, k, float(_share(v / max(m, 1), k)), m, bool(d)) for a, b, k, v, m, d in found])
        return out

    @staticmethod
    def _path(evidence: np.ndarray) -> list[int]:
        best, back = evidence[0], []
        for row in evidence[1:]:
            change = best.max() - SWITCH
            back.append(np.where(best >= change, np.arange(len(best)), best.argmax()))
            best = np.maximum(best, change) + row
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def _share(mean_log: np.ndarray, k: int) -> float:
    p = np.exp(mean_log - mean_log.max())
    return p[k] / p.sum()


def _descend(grams: list[np.ndarray], labels: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings and softmax weights, by stochastic gradient descent with decaying rates for each value."""
    rng = np.random.default_rng(seed)
    e = np.zeros((BUCKETS, DIMENSIONS), np.float32)  # a bucket that training never meets says nothing
    w = rng.normal(0, 0.5, (DIMENSIONS, len(LANGUAGES))).astype(np.float32)
    e2, w2 = np.full(BUCKETS, 1e-4, np.float32), np.full_like(w, 1e-4)
    for _ in range(EPOCHS):
        order = rng.permutation(len(grams))
        for at in range(0, len(order), BATCH):
            take = order[at : at + BATCH]
            flat = np.concatenate([grams[i] for i in take])
            sizes = np.array([len(grams[i]) for i in take])
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            hidden = np.add.reduceat(e[flat], begins, axis=0) / sizes[:, None]
            z = hidden @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(take)), labels[take]] -= 1
            gw = hidden.T @ p
            gh = (p @ w.T) / sizes[:, None]
            w2 += gw * gw
            w -= RATE * gw / np.sqrt(w2)
            sort = np.argsort(flat, kind="stable")
            ids, first = np.unique(flat[sort], return_index=True)
            ge = np.add.reduceat(np.repeat(gh, sizes, axis=0)[sort], first, axis=0)
            e2[ids] += (ge * ge).mean(axis=1)
            e[ids] -= RATE * ge / np.sqrt(e2[ids])[:, None]
    return e, w


def train(rows: list[tuple[str, str]]) -> Model:
    """A model of (text, language code) rows; labels may be wrong in places, which a first model sorts out."""
    rng = np.random.default_rng(1)
    held = rng.random(len(rows)) < HELD_OUT  # whole texts, before any model sees one
    spans = [(t[a:b], LANGUAGES.index(k), i) for i, (t, k) in enumerate(rows) for a, b in units(t)]
    keep, seen = [], np.zeros((2, len(LANGUAGES)), np.int64)
    for i in rng.permutation(len(spans)):
        t, k, row = spans[i]
        if seen[int(held[row]), k] < PER_LANGUAGE and len(t) >= 3 * LEAST:
            seen[int(held[row]), k] += 1
            keep.append(spans[i])
    grams, labels, texts = [], [], []
    for t, k, row in keep:
        letters, _ = _folded([t])
        g = np.concatenate([b[begins] for b, begins in _grams(letters)]).astype(np.int64)
        if len(g):
            grams.append(g)
            labels.append(k)
            texts.append(row)
    labels, texts = np.array(labels, np.int64), np.array(texts, np.int64)
    own = np.flatnonzero(~held[texts]) if len(texts) else texts
    if not len(own):
        return Model(np.zeros((BUCKETS, len(LANGUAGES))), 1.0, 1.0)
    e, w = _descend([grams[i] for i in own], labels[own], 2)
    scores = lambda: np.stack([(e[g].mean(axis=0)) @ w for g in grams])
    z = scores()
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    fit = own[p[own, labels[own]] >= 0.5]
    # a held-out text's label holds if its units as a whole have that language; its units that say otherwise are the errors
    votes = np.zeros((len(rows), len(LANGUAGES)))
    np.add.at(votes, texts, np.log(p + 1e-9))
    test = np.flatnonzero(held[texts] & (votes[texts].argmax(axis=1) == labels))
    e, w = _descend([grams[i] for i in fit], labels[fit], 3)
    z, truth = scores()[test], labels[test]
    temperature, loss = 1.0, np.inf
    for t in np.geomspace(0.1, 5, 30):
        s = z / t
        s -= s.max(axis=1, keepdims=True)
        nll = (np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(truth)), truth]).mean() if len(truth) else np.inf
        if nll < loss:
            temperature, loss = float(t), nll
    s = np.exp((z - z.max(axis=1, keepdims=True)) / temperature) if len(truth) else np.ones((1, len(LANGUAGES)))
    sure = s.max(axis=1) / s.sum(axis=1)
    wrong = s.argmax(axis=1) != truth if len(truth) else np.array([False])
    least = 0.5
    for t in np.arange(0.5, 0.96, 0.05):  # the least confidence at which few enough of the accepted are wrong
        least = float(t)
        if wrong[sure >= t].mean() <= ERROR if (sure >= t).any() else True:
            break
    return Model(e @ w, temperature, least)


def fitted(df: DataFrame, key: str, text: str = "text", label: str = "lang", sample: int = SAMPLE) -> Model:
    """A model trained on the ``sample`` labelled texts of the least hashed keys."""
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"), normal_label(label).alias("l"))
    rows = rows.where(not_blank("t") & F.col("l").isin(*LANGUAGES))
    return train([(r.t, r.l) for r in least_hashed(rows, df.count(), sample)])


def _segments(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    names = ["k", "label", "start_char", "end_char", "lang", "confidence", "letters", "best"]
    for batch in batches:
        for cut in range(0, batch.num_rows, 200):  # bounds the arrays of a batch of long texts
            part = batch.slice(cut, 200)
            rows = []
            for i, found in enumerate(model.segments(part.column(1).to_pylist())):
                rows += [(i, a, b, "und" if doubtful or p < model.least else LANGUAGES[k], p, n, LANGUAGES[k]) for a, b, k, p, n, doubtful in found]
            at, a, b, k, p, n, best = zip(*rows, strict=True) if rows else ((), (), (), (), (), (), ())
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(2).take(at), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.string()), pa.array(p, pa.float64()), pa.array(n, pa.int64()), pa.array(best, pa.string())], names)


def segments(df: DataFrame, model: Model, key: str, text: str = "text", label: str = "lang") -> DataFrame:
    """The segments of one language of each text: (``key``, ``label``, ``start_char``, ``end_char``, ``lang``, ``confidence``, ``letters``, ``best``).

    ``label`` is the declared label as a code, null if useless. ``best`` is the likeliest language; ``lang`` is the same,
    but ``und`` below the model's least confidence. Null and blank texts and texts without letters have no segments. Very long texts are taken whole;
    repeated rows each give their segments; an empty table gives none; other columns are not read.
    """
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    rows = df.where(F.col(key).isNotNull() & not_blank(text)).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), normal_label(label).alias("label"))
    schema = "k long, label string, start_char long, end_char long, lang string, confidence double, letters long, best string"
    return rows.mapInArrow(lambda it: _segments(it, sent.value), schema).withColumnRenamed("k", key)


def mislabelled(found: DataFrame, key: str) -> DataFrame:
    """(``key``, ``lang``) of the texts of ``segments`` whose label is missing, useless or not their main language, or that mix languages.

    A row per language in the text. Segments below the least confidence count as their likeliest language. Of languages with equally much text the first by name is the main one.
    """
    each = found.withColumn("lang", F.col("best")).groupBy(key, "lang").agg(F.sum("letters").alias("n"), F.max("label").alias("label"))
    each, _ = settle(each)  # else both uses of it run the model
    main = each.groupBy(key).agg(F.max_by("lang", F.struct("n", -F.ascii("lang"), -F.ascii(F.substring("lang", 2, 1)))).alias("main"), F.count("*").alias("languages"), F.max("label").alias("label"))
    wrong = main.where("label is null or label <> main or languages > 1").select(key)
    return each.join(wrong, key, "left_semi").select(key, "lang")
