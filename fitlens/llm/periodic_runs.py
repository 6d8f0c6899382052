"""Stretches of a text in which a passage repeats four times or more, found by block convolution.

At each dyadic scale the words are cut into blocks. A run whose period belongs to the scale holds a whole block and the same words
one period later, so every block is laid over the window that follows it, at all distances of the scale at once: the sum of
squared differences of the words' numbers is a convolution, computed by an exact number-theoretic transform, and a zero is an
occurrence. Its distance is the seed of a run, which is extended to both sides by hashes of prefixes and checked word by word. The
transform goes through a matrix of residues by two matrix products, whose sums stay far below the integers that doubles hold exactly.

Texts of a batch are laid end to end with marks between them that equal nothing, so scales with small blocks work on many texts.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table

# Least number of words of a run, and of its periods.
LENGTH, TIMES = 6, 4
# The prime of the transform, a number whose powers give all its residues, and the words of a block at most; larger blocks are tried by their first words.
PRIME, ROOT, LARGEST = 65537, 3, 1 << 15
# Words of a scan, texts together; a longer text is a scan of its own. Numbers of a transform that are worked on at once.
SCAN, CELLS = 1 << 18, 1 << 17
# The field and base of the hashes that tell how far a seed extends; words decide in the end.
FIELD, BASE = (1 << 31) - 1, 1_000_003


def _reduced(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2**48 as residues from -1 to PRIME."""
    return x - PRIME * np.floor(x * (1.0 / PRIME))


@lru_cache(64)
def _roots(size: int, rows: int, inverse: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matrices of a transform of ``size`` numbers in ``rows`` rows: over rows, between, over columns."""
    root = pow(ROOT, (PRIME - 1) // size * (size - 1 if inverse else 1), PRIME)
    powers = np.empty(size, np.int64)
    value = 1
    for i in range(size):
        powers[i] = value
        value = value * root % PRIME
    columns = size // rows
    r, c = np.arange(rows), np.arange(columns)
    over_rows = powers[np.outer(r, r) * columns % size]
    over_columns = powers[np.outer(c, c) * rows % size]
    if inverse:
        over_columns = over_columns * pow(size, -1, PRIME) % PRIME
    return over_rows.astype(float), powers[np.outer(r, c) % size].astype(float), over_columns.astype(float)


def _shape(size: int) -> int:
    """Rows of the matrix that a transform goes through; short ones are a single row."""
    return 1 if size <= 32 else 1 << (size.bit_length() - 1) // 2


def transform(x: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row of ``x``, as matrices in an order that ``inverse`` takes back."""
    size = x.shape[-1]
    rows = _shape(size)
    over_rows, between, over_columns = _roots(size, rows, False)
    x = x.reshape(len(x), rows, size // rows)
    if rows > 1:
        x = _reduced(_reduced(over_rows @ x) * between)
    return _reduced(x @ over_columns)


def inverse(x: np.ndarray) -> np.ndarray:
    size = x.shape[1] * x.shape[2]
    over_rows, between, over_columns = _roots(size, x.shape[1], True)
    x = _reduced(x @ over_columns)
    if x.shape[1] > 1:
        x = _reduced(over_rows @ _reduced(x * between))
    return x.reshape(len(x), size)


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Residues of ``sum((block - window[d : d + size]) ** 2)`` for d from 0 to the size of a block; windows are twice as long."""
    size = blocks.shape[1]
    flipped = np.zeros(windows.shape)
    flipped[:, :size] = blocks[:, ::-1]
    products = inverse(_reduced(transform(flipped) * transform(windows)))[:, size - 1 :]
    sums = np.concatenate([np.zeros((len(windows), 1)), np.cumsum(windows * windows, axis=1)], axis=1)
    return np.mod((blocks * blocks).sum(1)[:, None] + sums[:, size:] - sums[:, : size + 1] - 2 * products, PRIME)


def _codes(words: np.ndarray, size: int) -> np.ndarray:
    """Words as numbers so small that squared differences of ``size`` of them add up to less than the prime; equal words stay
    equal, some different ones become equal."""
    most = int(((PRIME - 1) / size) ** 0.5) + 1
    mixed = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(most)).astype(float)


def _occurrences(words: np.ndarray, starts: np.ndarray, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of the blocks of ``size`` words at ``starts`` that may occur again at a distance from low to high."""
    codes = _codes(words, size)
    near = np.lib.stride_tricks.sliding_window_view(codes, size)
    far = np.lib.stride_tricks.sliding_window_view(codes, 2 * size)
    found = [np.zeros((2, 0), np.int64)]
    step = max(1, CELLS // (2 * size))
    for i in range(0, len(starts), step):
        some = starts[i : i + step]
        blocks = near[some]
        for first in range(low, high, size + 1):
            at, distance = np.nonzero(squared_differences(blocks, far[some + first]) == 0)
            fits = first + distance < high
            found.append(np.stack([some[at[fits]], first + distance[fits]]))
    start, distance = np.concatenate(found, axis=1)
    return start, distance


class Prefixes:
    """Which of two stretches of words are the same, by hashes of all prefixes; different ones pass as equal once in ``FIELD``."""

    def __init__(self, words: np.ndarray) -> None:
        self.powers = np.ones(1, np.uint64)
        base = np.uint64(BASE % FIELD)
        while len(self.powers) <= len(words):
            self.powers = np.concatenate([self.powers, self.powers * base % np.uint64(FIELD)])
            base = base * base % np.uint64(FIELD)
        values = (words.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(20)) % np.uint64(FIELD)
        # Sums of numbers below 2**31 stay exact.
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.powers[: len(words)] % np.uint64(FIELD))])

    def same(self, a: np.ndarray, distance: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Whether the ``size`` words from each a on are those ``distance`` words later."""
        field, b = np.uint64(FIELD), a + distance
        left, right = (self.sums[a + size] - self.sums[a]) % field, (self.sums[b + size] - self.sums[b]) % field
        return left * self.powers[distance] % field == right

    def extended(self, a: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
        """How many words from a on to the right, or before a to the left, are those ``distance`` words later."""
        out = np.zeros(len(a), np.int64)
        room = len(self.sums) - 1 - a - distance if step > 0 else a
        width = 1 << int(room.max(initial=1)).bit_length()
        while width := width // 2:
            at = a + out if step > 0 else a - out - width
            fits = out + width <= room
            fits[fits] = self.same(at[fits], distance[fits], width)
            out[fits] += width
        return out


def _true_runs(words: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Runs by hashes as runs by words. Where hashes took different words for equal, the stretches between these words remain."""
    out = [np.zeros((0, 3), np.int64)]
    for s, e, q in np.unique(runs, axis=0).tolist():
        breaks = np.flatnonzero(words[s : e - q] != words[s + q : e]) + s
        edges = np.concatenate([[s - 1], breaks, [e - q]])
        parts = np.stack([edges[:-1] + 1, edges[1:] + q, np.full(len(edges) - 1, q)], 1)
        out.append(parts[parts[:, 1] - parts[:, 0] >= max(LENGTH, TIMES * q)])
    return np.concatenate(out)


def find_runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs in texts that stand end to end, by start and period.

    words: numbers from 0, and a negative number of its own behind each text and before the first. ends: for every place the end
    of its text.
    """
    longest = int((ends - np.arange(len(words))).max(initial=0))
    pad = 4 * longest + 4 * LENGTH
    padded = np.concatenate([words, -np.arange(pad) - len(words) - 2])
    # The run found so far that reaches farthest from each place, and its period.
    reach, period = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    found = np.zeros((0, 3), np.int64)
    prefixes = Prefixes(words)
    block = 2
    while TIMES * (low := (2 * block + 1) // 3) <= longest:
        high = (4 * block + 1) // 3
        starts = np.arange(0, len(words), block)
        starts = starts[(starts + block + low <= ends[starts]) & (words[starts] >= 0)]
        size = min(block, LARGEST)
        start, distance = _occurrences(padded, starts, size, low, high)
        # Within a run, distances that its period divides lead to the same run again.
        fresh = (start + size + distance <= ends[start]) & ((reach[start] < start + size + distance) | (distance % period[start] > 0))
        start, distance = start[fresh], distance[fresh]
        same = prefixes.same(start, distance, size)
        start, distance = start[same], distance[same]
        order = np.lexsort((start, distance))
        start, distance = start[order], distance[order]
        # Whole blocks that follow each other at one distance are extended together.
        joined = (distance[1:] == distance[:-1]) & (start[1:] - start[:-1] == block) & (size == block)
        heads = np.concatenate([[True], ~joined])[: len(start)]
        tails = np.concatenate([~joined, [True]])[: len(start)]
        first, last, distance = start[heads], start[tails] + size, distance[heads]
        first = first - prefixes.extended(first, distance, -1)
        last = last + prefixes.extended(last, distance, 1) + distance
        runs = np.stack([first, last, distance], 1)
        runs = _true_runs(words, runs[last - first >= np.maximum(LENGTH, TIMES * distance)])
        # A stretch that is found by several distances has the smallest of them as its period.
        both = np.concatenate([found, runs])
        both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
        alone = np.concatenate([[True], (both[1:, :2] != both[:-1, :2]).any(1)])[: len(both)]
        found = both[alone]
        for s, e, q in runs.tolist():
            longer = reach[s:e] < e
            period[s:e][longer] = q
            reach[s:e][longer] = e
        block *= 2
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def scan_texts(texts: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray, list[bytes]]:
    """Of texts, laid end to end: words of each, runs (start, length, period) of all, runs of each, collapsed texts."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    split = [t.split() for t in texts]  # bytes.split parts at space and \\x09-\\x0D only
    sizes = np.array([len(w) for w in split], np.int64)
    starts = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])
    words = np.empty(int(starts[-1]), np.int64)
    words[0] = -1
    words[starts[1:] - 1] = -2 - np.arange(len(texts))
    ends = np.repeat(starts[1:] - 1, sizes + 1)
    for s, own in zip(starts.tolist(), split):
        words[s : s + len(own)] = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
    runs = find_runs(words, np.concatenate([[1], ends]))
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change) == 0
    text_of = np.searchsorted(starts, runs[:, 0], "right") - 1
    counts = np.bincount(text_of, minlength=len(texts))
    collapsed = []
    for s, own, n in zip(starts.tolist(), split, counts.tolist()):
        stay = own if n == 0 else [own[i] for i in np.flatnonzero(kept[s : s + len(own)]).tolist()]
        collapsed.append(b" ".join(stay))
    out = np.stack([runs[:, 0] - starts[text_of], runs[:, 1] - runs[:, 0], runs[:, 2]], 1)
    return sizes.tolist(), out, counts, collapsed


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, runs, collapsed)`` of every whole text.

    Words are parted at space and \\x09-\\x0D and numbered from 0. A run is a stretch of words with smallest period q (words q apart
    are the same) and at least six words and four periods, that no neighbouring word continues. runs: array of (start, length,
    period) by start, then period. collapsed: the words, joined by one space, without those that some run holds beyond its first
    period.

    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows are scanned one by one, a null key
    stays, other columns are left out whatever their names. Batches are cut into scans, so memory follows the longest text.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            first, size, some = 0, 0, []
            for i in range(batch.num_rows):
                some.append((texts[i].as_py() or "").encode())
                size += some[-1].count(b" ") + some[-1].count(b"\n") + 1
                if size >= SCAN or i == batch.num_rows - 1:
                    n_words, runs, counts, collapsed = scan_texts(some)
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in runs.T], ["start", "length", "period"])
                    columns = [keys.slice(first, len(some)), pa.array(n_words, pa.int64()), pa.ListArray.from_arrays(offsets, rows), pa.array(collapsed, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, [key, "n_words", "runs", "collapsed"])
                    first, size, some = i + 1, 0, []

    source = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = source.schema["_key"].dataType.simpleString()
    schema = f"`{key}` {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return source.mapInArrow(scan, schema)


def restarted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` where about one text in ten begins again and again from some word on, as its key decides.

    Let h be the CRC of the key and g = h div 10. Where h ends in 0, each word i >= a becomes word a + (i - a) % p, with
    a = g % n and p = 1 + (n - a) div (3 + g % 8).
    """
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).withColumn("_h", F.crc32(F.col("_key").cast("string").cast("binary")))
    g = F.floor(F.col("_h") / 10)

    def again(words: Column) -> Column:
        # One-element arrays name a value once for all words.
        n = F.size(words).cast("long")
        shift = F.array(F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p")))
        place = lambda x, i: F.when(i >= x["a"], x["a"] + (i - x["a"]) % x["p"]).otherwise(i).cast("int")
        return F.transform(shift, lambda x: F.array_join(F.transform(words, lambda _, i: F.get(words, place(x, i))), " "))[0]

    words = F.split(F.btrim("_text", F.lit(" \t\n\x0b\x0c\r")), "[ \\t-\\r]+")
    changed = F.transform(F.array(words), again)[0]
    damaged = (F.col("_h") % 10 == 0) & F.col("_text").rlike("[^ \\t-\\r]")
    return source.select(F.col("_key").alias(key), F.when(damaged, changed).otherwise(F.col("_text")).alias(text))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, some of which are made to repeat themselves."""
    found = periodic_runs(restarted(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-1000 * best.less div best.period").alias("exponent_milli"),
        digest(F.array_join(F.transform(listed, lambda s: F.concat(s, F.lit("\n"))), "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
