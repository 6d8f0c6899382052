"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are grown on a bounded sample of labelled rows and flattened into arrays; scoring walks all trees for a batch of
documents at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table

# Labelled rows that the trees are grown on, at most: those with the smallest hash of their id.
MAX_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.15
# Least sum of second derivatives in a leaf, and the shrinkage of its value.
MIN_WEIGHT, SHRINK = 1.0, 1.0

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "the of and to in is that it for was on are as with be at by this from or an have not but they which you had were "
    "le la les de des du et en un une que qui dans pour par sur au est il ne pas ce se avec plus "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an "
    "el los las y del se con una su lo como más pero sus".split()
)
SYMBOLS = b"#$%&*<>=@\\^_`{|}~"
MARKS = "#$%&*|!"
_CLASS = np.full(256, 5, np.int64)  # other, among them all bytes of characters beyond ASCII
_CLASS[ord("A") : ord("Z") + 1] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[list(b" \t\n\r\x0b\x0c")] = 3
_CLASS[list(SYMBOLS)] = 4
_CLASS[list(b"!?")] = 6
_CLASS[list(b".,;:'\"()-")] = 7

FEATURES = (
    "words", "word_length", "upper", "lower", "digits", "spaces", "symbols", "exclaims", "stops", "beyond_ascii", "upper_words",
    "title_words", "alpha_words", "distinct_words", "top_word", "repeats", "near_repeats", "stop_words", "lines", "line_words", "distinct_lines",
    "worst_upper_line", "worst_symbol_line", "bars",
)


def statistics(text: str | None) -> tuple[float, ...]:
    """Values of ``FEATURES``; an empty text has zeros."""
    text = text or ""
    words = text.split()
    if not words:
        return (0.0,) * len(FEATURES)
    raw = text.encode()
    counts = np.bincount(_CLASS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 8) / len(raw)
    n = len(words)
    tally = Counter(words)
    lines = [line for line in text.split("\n") if line]
    worst_upper = worst_symbol = 0.0
    for line in lines:
        size = len(line)
        if size >= 20:
            worst_symbol = max(worst_symbol, sum(map(line.count, MARKS)) / size)
            if line.isupper():
                worst_upper = max(worst_upper, min(1.0, size / 200))
    return (
        float(np.log1p(n)),
        len(text) / n,
        counts[0], counts[1], counts[2], counts[3], counts[4], counts[6], counts[7], counts[5],
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        sum(map(str.isalpha, words)) / n,
        len(tally) / n,
        max(tally.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        sum(map(eq, words, words[2:])) / n,
        sum(c for w, c in tally.items() if w in STOP_WORDS) / n,
        float(np.log1p(len(lines))),
        n / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)),
        worst_upper,
        worst_symbol,
        tally.get("|", 0) / n,
    )


class Trees:
    """Flattened trees: per node the feature, the threshold (at most: left), the left child (the right one follows) or -1, and the value."""

    def __init__(self, base: float, nodes: list[tuple[int, float, int, float]], roots: list[int]) -> None:
        self.base = base
        self.roots = np.array(roots, np.int32)
        columns = zip(*nodes) if nodes else ([], [], [], [])
        self.feature, self.threshold, self.left, self.value = (np.array(list(c), k) for c, k in zip(columns, (np.int32, float, np.int32, float)))

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int32)
            for _ in range(DEPTH):
                left = self.left[at]
                down = left + (x[rows, self.feature[at]] > self.threshold[at])
                at = np.where(left >= 0, down, at).astype(np.int32)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for labels 0 and 1; without rows, or with one label only, the score is that label's share (of none: one half)."""
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    nodes: list[tuple[int, float, int, float]] = []
    roots: list[int] = []
    if n == 0 or y.min() == y.max():
        return Trees(base, nodes, roots)
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], 1)
    width = x.shape[1]
    cells = binned + np.arange(width) * BINS
    margin = np.full(n, base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append((0, 0.0, -1, 0.0))
        at = np.full(n, roots[-1])
        level = [roots[-1]]
        for depth in range(DEPTH + 1):
            place = np.full(len(nodes), -1)
            place[level] = np.arange(len(level))
            where = place[at]
            rows = np.flatnonzero(where >= 0)
            flat = (where[rows, None] * (width * BINS) + cells[rows]).ravel()
            size = len(level) * width * BINS
            g = np.bincount(flat, np.repeat(gradient[rows], width), size).reshape(len(level), width, BINS)
            h = np.bincount(flat, np.repeat(weight[rows], width), size).reshape(len(level), width, BINS)
            total_g, total_h = g[:, 0].sum(1), h[:, 0].sum(1)
            left_g, left_h = g.cumsum(2), h.cumsum(2)
            right_g, right_h = total_g[:, None, None] - left_g, total_h[:, None, None] - left_h
            gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - (total_g**2 / (total_h + SHRINK))[:, None, None]
            gain[(left_h < MIN_WEIGHT) | (right_h < MIN_WEIGHT)] = 0
            following = []
            for i, node in enumerate(level):
                best = int(gain[i].argmax())
                feature, cut = divmod(best, BINS)
                if depth == DEPTH or gain[i].flat[best] <= 1e-6 or cut >= len(cuts[feature]):
                    nodes[node] = (0, 0.0, -1, -RATE * total_g[i] / (total_h[i] + SHRINK))
                    continue
                nodes[node] = (feature, float(cuts[feature][cut]), len(nodes), 0.0)
                following += [len(nodes), len(nodes) + 1]
                nodes += [(0, 0.0, -1, 0.0)] * 2
                mine = rows[where[rows] == i]
                at[mine] = following[-2] + (binned[mine, feature] > cut)
            if not following:
                break
            level = following
        margin += np.array([v[3] for v in nodes])[at]
    return Trees(base, nodes, roots)


def _statistics_frame(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"label": batch["label"], "x": [list(map(float, statistics(t))) for t in batch["text"]]})


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> Trees:
    """Trees from at most ``max_rows`` labelled documents that are not held out. Equal labels of an id count once, and of the
    texts of an id the one with the smallest digest counts."""
    rows = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    sample = rows.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("label")).distinct().orderBy(F.xxhash64("_id"), "_id", "label").limit(max_rows)
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("text"))
    one = texts.join(F.broadcast(sample), "_id").groupBy("_id", "label").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    drawn = one.select("label", "text").mapInPandas(_statistics_frame, "label int, x array<double>").toPandas()
    x = np.array(drawn["x"].tolist(), float).reshape(len(drawn), len(FEATURES))
    y = drawn["label"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # the order in which tasks end must not matter
    return grow(x[order], y[order])


def _score(trees: Trees, text: str):
    """Score of a text; null counts as empty, and all empty texts have one score."""
    scores = F.pandas_udf(
        lambda texts: pd.Series(trees.scores(np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES)))), "double"
    )
    return scores(F.col(text))


def score_documents(docs: DataFrame, trees: Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)`` of every document.

    The score depends on the text alone; null counts as empty, and empty texts have one score. Repeated rows and null keys are
    scored one by one (a null key is not held out); other columns do not matter.
    """
    scored = docs.select(F.col(key), F.coalesce(held_out(key), F.lit(False)).alias("held_out"), _score(trees, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The documents with a score of ``THRESHOLD`` or more, with their own columns."""
    return docs.filter(_score(trees, text) >= THRESHOLD)


@query("op7_boosted_trees")
def op7_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
