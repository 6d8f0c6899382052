"""Personal data: fixed rules, and a linear-chain conditional random field over word shapes that adds what they miss.

The field is trained on a small labelled table when the query is built and decoded by Viterbi for all lines of a batch at once,
wherever a word is not plain and around it.
Emission scores depend on a word and its neighbours only through their types, so they are looked up, not computed anew.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.pii_examples import SENTENCES
from fitlens.llm.registry import query, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
EPOCHS, RATE, DECAY = 250, 0.1, 0.01
# Words without digits, signs or cues are plain; stretches reach so many words beyond the others.
PLAIN = ("any", "plain")
AROUND = 6
# Characters decoded together, and word types kept per worker.
SCAN = 1 << 19
TYPES = 1 << 18

# Patterns of the base rules. Behind a digit a number cannot start anew, which keeps the search linear.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")

WORD = re.compile(r"[^\s]+")
# Words that stand near personal data or near numbers that are none.
CUES = frozenset(
    "at dot [at] [dot] (at) (dot) phone tel tel. telefon mobile call fax number ring dial reach contact email mail mail: address card "
    "visa mastercard credit ip host server ping version license, chapter page order invoice isbn room price commit token key".split()
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, place of the kind, end)`` of the base rules, in order."""
    out = []
    at, upto = text.find("@"), 0
    while at >= 0:
        start = at
        while start > upto and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            upto = match.end()
            out.append((start, 0, upto))
        else:
            upto = max(upto, at)
        at = text.find("@", max(at + 1, upto))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(word: str) -> str:
    """Capitals as X, other letters as x, digits as 9, runs of three or more as one with a plus, at most 16 signs."""
    signs = "".join("9" if c in "0123456789" else "X" if c.isupper() else "x" if c.isalpha() else c for c in word[:48])
    return re.sub(r"(.)\1{2,}", r"\1+", signs)[:16]


def features(word: str) -> list[str]:
    """Features of a word by itself; words without digits, ``@`` or ``:`` differ by cue and coarse shape only."""
    low = word.lower()
    digits = sum(c in "0123456789" for c in word)
    out = ["any"]
    if low in CUES:
        out.append("cue=" + low)
    if digits:
        out += ["shape=" + shape(word), f"digits={min(digits, 4) if digits < 5 else 8 if digits < 9 else 11 if digits < 12 else 16 if digits < 20 else 20}"]
        letters = sum(c.isalpha() for c in word)
        out.append(f"letters={min(letters, 3)}")
    else:
        out.append("plain" if low.strip(".,;:!?()\"'").isalpha() else "shape=" + shape(word))
    for sign in "@+(":
        if sign in word:
            out.append("has" + sign)
    if "at)" in low or "at]" in low:
        out.append("atsign")
    if word.count(":") > 1:
        out.append("colons" + ("hex" if not re.sub(r"[0-9a-f:.,]", "", low) else ""))
    if word.count(".") > 2:
        out.append("dots")
    if "=" in word:
        out.append("assign")
    return out


def parsed(sentence: str) -> tuple[list[str], list[int]]:
    """Words and labels of a marked sentence."""
    words, labels, at = [], [], 0
    for m in re.finditer(r"\[(email|ip|card|phone)\|((?:\[(?:at|dot)\]|[^\]\[])+)\](\S*)", sentence):
        plain = sentence[at : m.start()].split()
        parts = m.group(2).split()
        parts[-1] += m.group(3)
        words += plain + parts
        labels += [0] * len(plain) + [LABELS.index("B-" + m.group(1))] + [LABELS.index("I-" + m.group(1))] * (len(parts) - 1)
        at = m.end()
    plain = sentence[at:].split()
    return words + plain, labels + [0] * len(plain)


def _allowed() -> np.ndarray:
    """No inside label without its beginning; the first row is the start."""
    out = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            out[:, j] = -1e4
            for i, before in enumerate(LABELS):
                if before[1:] == label[1:] and before != "O":
                    out[i + 1, j] = 0
    return out


class Field:
    """Weights: by offset (-1, 0, 1), feature and label, and of transitions (first row: from the start)."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray) -> None:
        self.names, self.weights, self.moves = names, weights, moves

    def rows(self, word: str) -> np.ndarray:
        """What a word adds to the scores of the next, its own and the previous place."""
        some = [self.names[f] for f in features(word) if f in self.names]
        return self.weights[:, some].sum(1) if some else np.zeros((3, len(LABELS)))


@lru_cache(4)
def train(sentences: Sequence[str] = SENTENCES) -> Field:
    """Maximum likelihood with a small square penalty by gradient steps on the whole table."""
    data = [parsed(s) for s in sentences]
    names = {f: i for i, f in enumerate(sorted({f for words, _ in data for w in words for f in features(w)}))}
    k, longest = len(LABELS), max(len(w) for w, _ in data)
    n = len(data)
    x = np.zeros((n, longest, 3, len(names)))
    y = np.zeros((n, longest), int)
    mask = np.zeros((n, longest))
    for s, (words, labels) in enumerate(data):
        for i, w in enumerate(words):
            some = [names[f] for f in features(w)]
            for o, place in ((0, i + 1), (1, i), (2, i - 1)):
                if 0 <= place < len(words):
                    x[s, place, o, some] = 1
        y[s, : len(words)], mask[s, : len(words)] = labels, 1
    allowed = _allowed()
    weights, moves = np.zeros((3, len(names), k)), np.zeros((k + 1, k))
    flat = x.reshape(n, longest, -1)
    gold = np.eye(k)[y] * mask[..., None]
    gold_moves = np.zeros((k + 1, k))
    np.add.at(gold_moves, (0, y[:, 0]), mask[:, 0])
    for i in range(1, longest):
        np.add.at(gold_moves, (y[:, i - 1] + 1, y[:, i]), mask[:, i])
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves)]
    total = lambda a, axis: np.log(np.exp(a - a.max(axis, keepdims=True)).sum(axis)) + a.max(axis)
    for epoch in range(1, EPOCHS + 1):
        emit = flat @ weights.reshape(-1, k)
        m = moves + allowed
        forward = np.zeros((longest, n, k))
        forward[0] = emit[:, 0] + m[0]
        for i in range(1, longest):
            step = total(forward[i - 1][:, :, None] + m[None, 1:], 1) + emit[:, i]
            forward[i] = np.where(mask[:, i, None] > 0, step, forward[i - 1])
        whole = total(forward[-1], 1)
        backward = np.zeros((longest, n, k))
        pair_sum = np.zeros((k + 1, k))
        for i in range(longest - 1, 0, -1):
            after = emit[:, i] + backward[i]
            pair = np.exp(forward[i - 1][:, :, None] + m[None, 1:] + after[:, None] - whole[:, None, None]) * mask[:, i, None, None]
            pair_sum[1:] += pair.sum(0)
            backward[i - 1] = np.where(mask[:, i, None] > 0, total(m[None, 1:] + after[:, None], 2), 0)
        share = np.exp(forward.transpose(1, 0, 2) + backward.transpose(1, 0, 2) - whole[:, None, None]) * mask[..., None]
        pair_sum[0] = share[:, 0].sum(0)
        slopes = (
            np.einsum("nlf,nlk->fk", flat, gold - share).reshape(weights.shape) - DECAY * weights,
            (gold_moves - pair_sum) * (allowed == 0) - DECAY * moves,
        )
        for p, g, s in zip((weights, moves), slopes, state):
            s[0] += 0.1 * (g - s[0])
            s[1] += 0.01 * (g * g - s[1])
            p += RATE * (s[0] / (1 - 0.9**epoch)) / (np.sqrt(s[1] / (1 - 0.99**epoch)) + 1e-8)
    return Field(names, weights, moves + allowed)


class Tagger:
    """A field with the scores of the word types seen so far."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.forget()

    def forget(self) -> None:
        self.types: dict[str, int] = {}
        self.scores = np.zeros((1 << 12, 3, len(LABELS)), np.float32)
        self.marked = np.zeros(1 << 12, bool)
        self.made: dict[tuple, np.ndarray] = {}

    def place(self, word: str) -> int:
        n = self.types.get(word)
        if n is None:
            n = self.types[word] = len(self.types)
            if n == len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.marked = np.concatenate([self.marked, np.zeros_like(self.marked)])
            key = PLAIN if word.isalpha() and word.lower() not in CUES else tuple(features(word))
            self.marked[n] = key != PLAIN
            rows = self.made.get(key)
            if rows is None:
                rows = self.made[key] = self.field.rows(word).astype(np.float32)
            self.scores[n] = rows
        return n

    def labels(self, lines: list[list[str]]) -> list[np.ndarray]:
        """Best labels of each line. What lies within ``AROUND`` words of a marked one goes through the chain, stretches side by
        side and the longest first; all else is O."""
        if len(self.types) > TYPES:
            self.forget()
        sizes = np.array([len(words) for words in lines], np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        chosen = np.zeros(n, np.int8)
        if n:
            places = np.fromiter((self.types[w] if w in self.types else self.place(w) for words in lines for w in words), np.int32, n)
            line = np.repeat(np.arange(len(lines)), sizes)
            marks = np.flatnonzero(self.marked[places])
            live = np.zeros(n, bool)
            for o in range(-AROUND, AROUND + 1):
                near = np.clip(marks + o, 0, n - 1)
                live[near[line[near] == line[marks]]] = True
            words = np.flatnonzero(live)
            if len(words):
                self._decode(places, line, words, chosen)
        return np.split(chosen, ends[:-1])

    def _decode(self, places: np.ndarray, line: np.ndarray, words: np.ndarray, chosen: np.ndarray) -> None:
        emit = self.scores[places[words], 1]
        for o, row in ((-1, 0), (1, 2)):
            there = np.clip(words + o, 0, len(places) - 1)
            same = (line[there] == line[words]) & (there != words)
            emit[same] += self.scores[places[there[same]], row]
        heads = np.flatnonzero(np.concatenate([[True], (np.diff(words) != 1) | (np.diff(line[words]) != 0)]))
        sizes = np.diff(np.concatenate([heads, [len(words)]]))
        order = np.argsort(-sizes, kind="stable")
        heads, sizes = heads[order], sizes[order]
        moves = self.field.moves.astype(np.float32)
        back = np.zeros((len(words), len(LABELS)), np.int8)
        best = emit[heads] + moves[0]
        ends = best.copy()
        for t in range(1, int(sizes[0])):
            live = int(np.searchsorted(-sizes, -t, "left"))
            at = heads[:live] + t
            step = best[:live, :, None] + moves[None, 1:]
            back[at] = step.argmax(1)
            best = step.max(1) + emit[at]
            ends[:live] = best
        current = ends.argmax(1).astype(np.int8)
        for t in range(int(sizes[0]) - 1, -1, -1):
            live = int(np.searchsorted(-sizes, -t, "left"))
            at = heads[:live] + t
            chosen[words[at]] = current[:live]
            current[:live] = back[at, current[:live]]


def added_spans(text: str, lines: list[tuple[int, list[str]]], labels: list[np.ndarray], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of labelled words without the punctuation around them, as far as no base span overlaps."""
    out = []
    for (offset, words), tags in zip(lines, labels):
        if not tags.any():
            continue
        end = text.find("\n", offset)
        where = [(m.start(), m.end()) for m in WORD.finditer(text, offset, len(text) if end < 0 else end)]
        i = 0
        while i < len(tags):
            if tags[i] == 0:
                i += 1
                continue
            j = i + 1
            while j < len(tags) and LABELS[tags[j]][0] == "I":
                j += 1
            a, b = where[i][0], where[j - 1][1]
            span = text[a:b]
            left = span.lstrip("\"'<,;:[{")
            a += len(span) - len(left)
            b = a + len(left.rstrip("\"'>,;:.!?]}"))
            if b > a and all(b <= s or e <= a for s, _, e in base):
                out.append((a, KINDS.index(LABELS[tags[i]][2:]), b))
            i = j
    return out


def find_all(texts: list[str], tagger: Tagger) -> Iterator[tuple[list, list]]:
    """Base spans and all spans of each text."""
    i = 0
    while i < len(texts):
        # As many texts as fit, one at least.
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= SCAN):
            size += len(texts[j])
            j += 1
        cut = []
        for text in texts[i:j]:
            lines, at = [], 0
            for line in text.split("\n"):
                if line and not line.isspace():
                    lines.append((at, line.split()))
                at += len(line) + 1
            cut.append(lines)
        labels = iter(tagger.labels([words for lines in cut for _, words in lines]))
        for text, lines in zip(texts[i:j], cut):
            base = base_spans(text)
            yield base, sorted(base + added_spans(text, lines, [next(labels) for _ in lines], base))
        i = j


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_personal_data(docs: DataFrame, field: Field | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added)`` of every document.

    Counts and base_sha256 are of the base spans, spans holds these and the ``n_added`` that the field adds. Null counts as
    empty; an empty text has no spans. Repeated rows and null keys are treated one by one; extra columns are left out.
    """
    field = field or train()
    schema = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    @F.pandas_udf(schema)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(field)
        for batch in batches:
            rows = []
            for base, spans in find_all([t or "" for t in batch], tagger):
                tally = Counter(k for _, k, _ in base)
                digest = hashlib.sha256(spans_text(base).encode()).hexdigest()
                rows.append((*(tally[k] for k in range(len(KINDS))), digest, spans_text(spans), len(spans) - len(base)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return docs.select(F.col(key), found(F.col(text)).alias("found")).select(key, "found.*")


@query("op8_crf_spans")
def op8_crf_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_personal_data(table(spark, sf_dir, "documents"))
