"""Problem 4: sentence boundaries across languages and scripts.

Method: end marks give candidate boundaries; a maximum-entropy classifier decides the ambiguous ones from the
neighbouring tokens, their case, length, digits and script. It is trained on a bounded sample of texts, on the
candidates whose side is sure from how their tokens are used elsewhere in the sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import ship
from packloom.functions.text import not_blank
from packloom.llm import chars
from packloom.llm.sample import least_hashed

SAMPLE = 6000
"""Texts that the classifier is trained on, those of the least hashed keys; it is then applied to every text."""
EPOCHS, RATE, DECAY = 4, 0.5, 1e-5

BLANK_LINE = re.compile(r"\n\s*\n\s*")
ITEM = re.compile(r"(?:^|(?<=\n))[^\S\n]*(?:([-*•])|(\d{1,3})[.)]|([a-z])[.)])[^\S\n]+(?=\S)")
THAI = "ก-ฺเ-๎"
EVENT = re.compile(rf"[.!?…।。！？]+|[\"“”„«»‹›「」『』()\[\]（）【】]|(?<=[{THAI}])\s+(?=[{THAI}])")
OPENERS = {"„": "“”", "«": "»", "‹": "›", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）", "【": "】", "“": "”"}
QUOTES = frozenset("\"“”„«»‹›「」『』")
SURE = frozenset("!?।。！？")
WORD = re.compile(r"[^\s\"“”„«»‹›「」『』()\[\]（）【】]+")
WIDE = frozenset("。！？")


def _script(ch: str) -> str:
    o = ord(ch)
    if o < 0x250:
        return "latin"
    if o < 0x530:
        return "cyrillic" if o >= 0x400 else "greek"
    if 0x900 <= o < 0x980:
        return "devanagari"
    return "thai" if 0xE00 <= o < 0xE80 else "cjk" if o >= 0x2E80 else "other"


def _shape(token: str) -> str:
    if not token:
        return "none"
    if token.isdigit():
        return "digits"
    first = token[0]
    if any(c.isdigit() for c in token):
        return "mixed"
    if "." in token:
        return "dotted"
    if len(token) == 1:
        return "letter"
    return "upper" if token.isupper() else "title" if first.isupper() else "lower" if first.islower() else "plain"


def _starts(ch: str) -> str:
    """The kind of the character that follows a candidate."""
    return "digit" if ch.isdigit() else "upper" if ch.isupper() else "lower" if ch.islower() else "quote" if ch in QUOTES else "bracket" if ch in "([（" else "mark" if not ch.isalnum() else "plain"


class Candidate:
    """A possible boundary of a text at ``end``; what follows begins at ``then``."""

    __slots__ = ("before", "end", "features", "gap", "kind", "next", "then", "upper")

    def __init__(self, kind: str, end: int, then: int, before: str, after: str, gap: str, features: tuple[str, ...]) -> None:
        self.kind, self.end, self.then, self.before, self.next, self.gap, self.features = kind, end, then, before, after, gap, features


def _pairs(text: str, events: list[re.Match], first: bool, last: bool) -> dict[int, tuple[int, int]]:
    """Event number of each opening and closing sign -> the (opening, closing) offsets it belongs to.

    A quotation that the text is cut in begins at the text's start or ends at its end.
    """
    out: dict[int, tuple[int, int]] = {}
    stack: list[tuple[str, int, int]] = []
    for i, m in enumerate(events):
        s = m.group()
        if len(s) != 1 or s in ".!?…।。！？" or s.isspace():
            continue
        at = m.start()
        if s == '"':
            closing = any(x[0] == '"' for x in stack) or not ((at == 0 or text[at - 1].isspace() or text[at - 1] in "([—–") and at + 1 < len(text) and not text[at + 1].isspace())
            match = "\"" if closing else None
        elif s == "“":
            match = "„" if any(x[0] == "„" for x in stack) else None
            closing = match is not None
        else:
            closing = s in "”»›」』)]）】"
            match = next((x[0] for x in reversed(stack) if s in OPENERS.get(x[0], "")), None) if closing else None
        if not closing:
            stack.append((s, i, at))
            continue
        if match and any(x[0] == match for x in stack):
            while stack:
                t, j, start = stack.pop()
                if t == match:
                    out[i] = out[j] = (start, m.end())
                    break
        elif first and s in QUOTES and not out:
            out[i] = (-1, m.end())
    for t, j, start in stack:
        if last and t in QUOTES:
            out[j] = (start, len(text) + 1)
    return out


def _unit_starts(block: str) -> list[int]:
    """Where list items begin; numbers and letters count only in their order."""
    out, number, letter = [], None, None
    for m in ITEM.finditer(block):
        if m.group(1):
            out.append(m.start())
        elif m.group(2):
            n = int(m.group(2))
            if m.start() == 0 or n == 1 or n - 1 == number:
                out.append(m.start())
                number = n
        elif m.start() == 0 or m.group(3) == "a" or (letter and ord(letter) + 1 == ord(m.group(3))):
            out.append(m.start())
            letter = m.group(3)
    return out


_plain: dict[str, str] = {}


def _norm(token: str) -> str:
    if token.isascii():
        return token.lower()
    known = _plain.get(token)
    if known is None:
        if len(_plain) > 200_000:
            _plain.clear()
        known = _plain[token] = chars.canonical(token).lower()
    return known


def blocks(text: str) -> list[tuple[int, int]]:
    """Parts between blank lines."""
    out, at = [], 0
    for m in BLANK_LINE.finditer(text):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def scan(text: str, a: int, b: int) -> tuple[list[int], list[Candidate]]:
    """The sure boundaries of block [a, b) of ``text``, and the candidates to be classified."""
    block = text[a:b]
    sure = [0, *_unit_starts(block)] if "\n" in block or ITEM.match(block) else [0]
    items = set(sure)
    marker_ends = {m.end() for m in ITEM.finditer(block) if m.start() in items} if len(sure) > 1 or (len(sure) == 1 and ITEM.match(block)) else set()
    events = list(EVENT.finditer(block))
    pairs = _pairs(block, events, a == 0, b == len(text)) if any(m.group() in OPENERS or m.group() in QUOTES for m in events) else {}
    candidates, until, inside = [], -1, None
    if pairs:
        cut = min((p for p in pairs.values() if p[0] < 0), default=None)
        if cut:
            until, inside = cut[1], cut
    n = len(block)
    for i, m in enumerate(events):
        s, at, end = m.group(), m.start(), m.end()
        if i in pairs and at >= until - 1:
            p = pairs[i]
            if p[0] == at and at >= until:
                until, inside = p[1], p
            elif p[1] == end == until:
                quoted, inside = inside, None
                if s in QUOTES and end < n:
                    body = block[max(quoted[0], 0) : at].rstrip()
                    if body and body[-1] in ".!?…।。！？":
                        then = end
                        while then < n and block[then].isspace():
                            then += 1
                        if then < n and (then > end or _script(block[end]) == "cjk"):
                            lead = block[max(0, quoted[0] - 3) : max(quoted[0], 0)].rstrip()
                            opened = "cut" if quoted[0] < 0 else "start" if quoted[0] == 0 or any(x + 2 >= quoted[0] for x in sure[-1:]) or (candidates and candidates[-1].then == quoted[0]) or not lead or lead[-1] in ".!?…।。！？" else "colon" if lead[-1] in ":：" else "middle"
                            word = WORD.match(block, then)
                            kind, w = _starts(block[then]), _norm(word.group()) if word else block[then]
                            w = w[:1] if _script(block[then]) == "cjk" else w
                            f = ("quote", f"q:{opened}", f"qm:{body[-1]}", f"qn:{kind}", f"q:{opened}:{kind}", f"q:{opened}:{body[-1]}", f"qw:{w}", f"qs:{_script(block[then])}")
                            candidates.append(Candidate("quote", end, then, opened, w, block[end:then], f))
            continue
        if at < until or s in OPENERS or s in QUOTES or s in ")]）】":
            continue
        if s.isspace():
            sure.append(end)
            continue
        # closing signs without a partner stay with the mark
        while end < n and block[end] in "\"”»’」』)]）】" and not (block[end] == '"' and end + 1 < n and not block[end + 1].isspace()):
            end += 1
        then = end
        while then < n and block[then].isspace():
            then += 1
        if then >= n:
            break
        if not SURE.isdisjoint(s):
            if then > end or s[-1] in WIDE:
                sure.append(then)
            continue
        if then == end or then in items or (marker_ends and then in marker_ends):
            continue
        k = at
        while k > 0 and not block[k - 1].isspace() and block[k - 1] not in "\"“”„«»‹›「」『』([（【":
            k -= 1
        before = block[k:at]
        word = WORD.match(block, then)
        after, kind = (_norm(word.group().rstrip(".,;:!?")) if word else block[then]), _starts(block[then])
        low, shape, gap = _norm(before), _shape(before), block[end:then]
        long = min(len(before), 7)
        f = (
            "dot", f"w:{low}", f"s:{shape}", f"l:{long}", f"n:{kind}", f"sn:{shape}:{kind}", f"wn:{low}:{kind}", f"ln:{long}:{kind}",
            f"a:{after}", f"sa:{shape}:{after}", f"e:{len(s)}:{kind}" if s != "." else "e:1", f"g:{'line' if '\n' in gap else len(gap)}", f"c:{_script(block[at - 1]) if at else 'none'}",
        )
        candidates.append(Candidate("dot", end, then, low, after, gap, f))
        candidates[-1].upper = kind
    return sure, candidates


class Model:
    """Weights of the features; a candidate is a boundary if they add up to more than zero."""

    def __init__(self, weights: dict[str, float]) -> None:
        self.weights, self.known = weights, {}

    def score(self, features: tuple[str, ...]) -> float:
        w = self.weights
        return sum([w.get(f, 0.0) for f in features])

    def boundary(self, c: Candidate) -> bool:
        return self.score(c.features) > 0

    def probability(self, c: Candidate) -> float:
        return 1 / (1 + math.exp(-self.score(c.features)))

    def sentences(self, text: str) -> list[tuple[int, int]]:
        """Offsets of the sentences, without blanks at either end."""
        out = []
        for a, b in blocks(text):
            sure, candidates = scan(text, a, b)
            starts = sorted({*sure, *(c.then for c in candidates if self.boundary(c))})
            for x, y in zip(starts, [*starts[1:], b - a], strict=True):
                part = text[a + x : a + y]
                bare = part.strip()
                if bare:
                    lead = len(part) - len(part.lstrip())
                    out.append((a + x + lead, a + x + lead + len(bare)))
        return out


def _labels(found: list[tuple[str, list[Candidate]]]) -> tuple[list[tuple[str, ...]], list[int]]:
    """The candidates whose side is sure, judged by how their tokens are used in all the texts."""
    plain, dotted, ended = Counter(), Counter(), Counter()
    low_next, digit_next, start_next, starters = Counter(), Counter(), Counter(), Counter()
    for text, candidates in found:
        for a, b in blocks(text):
            block = text[a:b]
            if block[-1] in ".!?…।。！？)”\"»」":
                if w := WORD.match(block):
                    starters[_norm(w.group())[:1] if _script(block[0]) == "cjk" else _norm(w.group())] += 1
            if block[-1] == "." and b < len(text):
                ended[_norm(block.rstrip(".").split()[-1] if block.rstrip(".").split() else "")] += 1
            plain.update(_norm(w) for w in WORD.findall(block) if w[-1] not in ".…")
    known = {w for w, n in starters.items() if n >= 3}
    for _, candidates in found:
        for c in candidates:
            if c.kind == "dot":
                dotted[c.before] += 1
                low_next[c.before] += c.upper == "lower"
                digit_next[c.before] += c.upper == "digit"
                start_next[c.before] += c.next in known and c.upper in ("upper", "plain", "quote")
    features, labels = [], []
    for _, candidates in found:
        for c in candidates:
            side = None
            if c.kind == "quote":
                nxt = c.features[3][3:]
                if nxt == "mark" or c.next[:1] in "とはがをにのでもって" or (nxt == "lower" and c.before != "colon"):
                    side = 0
                elif nxt == "upper":
                    side = 1 if c.next in known else None
                elif c.before == "colon" and nxt != "lower":
                    side = 1
            else:
                w, a, e = c.before, dotted[c.before], ended[c.before]
                s, low, dig = start_next[w] / a, low_next[w] / a, digit_next[w] / a
                number = w[-1:].isdigit()
                if c.upper == "digit":
                    side = 0 if dig >= 0.3 and a >= 3 and not number else None
                elif c.upper == "lower":
                    if number:
                        side = 1 if c.next in known else 0
                    elif low + dig >= 0.4 and a >= 3:
                        side = 0
                    elif a < 4 and len(w) >= 5 and c.next in known:
                        side = 1
                    elif plain[w] >= 2 and low < 0.25:
                        side = 1
                elif number:
                    side = 1 if c.next in known else 0 if plain[c.next] >= 5 and not starters[c.next] else None
                elif a >= 4 and e == 0 and (s <= 0.05 or len(w) == 1):
                    side = 0
                elif e or s >= 0.3 or (plain[w] >= 2 and len(w) > 2) or (len(w) >= 5 and c.next in known):
                    side = 1
            if side is not None:
                features.append(c.features)
                labels.append(side)
    return features, labels


def train(texts: list[str]) -> Model:
    """A maximum-entropy model of the sure candidates in ``texts``, by stochastic gradient descent with decay."""
    found = []
    for text in texts:
        all_of = [c for a, b in blocks(text) for c in scan(text, a, b)[1]]
        found.append((text, all_of))
    features, labels = _labels(found)
    counts = Counter(f for fs in features for f in fs)
    names = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= 2))}
    if not names:
        return Model({})
    rows = [[names[f] for f in fs if f in names] for fs in features]
    y = np.array(labels, np.float64)
    w, squares = np.zeros(len(names)), np.full(len(names), 1e-6)
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            take = order[at : at + 64]
            flat = np.concatenate([rows[i] for i in take]).astype(np.int64)
            owner = np.repeat(np.arange(len(take)), [len(rows[i]) for i in take])
            p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[flat], len(take)), -30, 30)))
            used, inverse = np.unique(flat, return_inverse=True)
            g = np.bincount(inverse, (p - y[take])[owner]) + DECAY * len(take) * w[used]
            squares[used] += g * g
            w[used] -= RATE * g / np.sqrt(squares[used])
    return Model({f: float(w[i]) for f, i in names.items()})


def fitted(df: DataFrame, key: str, text: str = "text", sample: int = SAMPLE) -> Model:
    """A model trained on the ``sample`` texts of the least hashed keys."""
    rows = df.where(not_blank(text)).select(F.col(key).alias("k"), F.col(text).alias("t"))
    return train([r.t for r in least_hashed(rows, df.count(), sample)])


def _split(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, starts, ends = [], [], []
        for text in batch.column(1).to_pylist():
            spans = model.sentences(text)
            counts.append(len(spans))
            starts += [s for s, _ in spans]
            ends += [e for _, e in spans]
        at = pa.array(np.repeat(np.arange(batch.num_rows), counts))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["k", "start_char", "end_char"])


def sentences(df: DataFrame, model: Model, key: str, text: str = "text") -> DataFrame:
    """All sentences of all texts: (``key``, ``start_char``, ``end_char``), offsets in code points, half open.

    Null and blank texts have no sentences; very long ones are split whole, part by part between blank lines.
    Repeated rows are split each. An empty table gives no rows; extra columns, whatever their names, are not read.
    """
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    rows = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(lambda it: _split(it, sent.value), "k long, start_char long, end_char long").withColumnRenamed("k", key)
