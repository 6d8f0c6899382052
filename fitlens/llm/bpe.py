"""Byte-level BPE, encoding and decoding, with pre-tokenisation by array scans instead of regular expressions.

Code points become classes by one table look-up. Each class is a transition function of a small automaton; functions compose
associatively, so a blockwise scan over an array of function numbers gives the state before every code point, and with it
every boundary, for a whole batch of texts at once. The slices between boundaries go through a cache of merged pieces.

The pieces are those of
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table

# Code points per scan, texts of a batch together; a longer text is a scan of its own.
SCAN = 1 << 18
BLOCK = 64
# Pieces kept per worker; beyond that the cache starts anew.
CACHE = 1 << 17
# Bytes of pieces that are merged together; longer pieces are merged one by one.
WIDTHS = (8, 16, 32)
NEVER = np.int32(2**31 - 1)

LETTER, NUMBER, OTHER, SPACE, WHITE = range(5)
# Code points of White_Space; letters and numbers newer than Unicode 15.1 (first, last).
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


@lru_cache(1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for first, last in ranges:
            out[first : last + 1] = kind
    out[list(WHITE_SPACE)] = WHITE
    out[32] = SPACE
    return out


# States: in letters, numbers, other, white space; after a space that joins what follows; one or two letters of a contraction to
# come; nothing open, so that the next code point starts a piece.
IN_L, IN_N, IN_O, IN_W, JOIN, ONE, TWO, OPEN = range(8)
# Symbols: a letter, number or other; an apostrophe that could open a contraction of one or two letters; white space before more
# of it or the end; the last white space before something else, as a space or otherwise.
SYM_L, SYM_N, SYM_O, SYM_1, SYM_2, SYM_W, SYM_SPACE, SYM_LAST = range(8)


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, by (symbol, state before)."""
    after, starts = np.zeros((8, 8), np.uint8), np.ones((8, 8), bool)
    after[[SYM_L, SYM_N, SYM_O, SYM_W, SYM_SPACE, SYM_LAST]] = np.array([[IN_L], [IN_N], [IN_O], [IN_W], [JOIN], [OPEN]])
    after[SYM_1], after[SYM_2] = ONE, TWO
    for sym, state in ((SYM_L, IN_L), (SYM_N, IN_N), (SYM_O, IN_O)):
        starts[sym, [state, JOIN]] = False
    starts[SYM_W, IN_W] = False
    # Inside other characters, or behind a joining space, an apostrophe is one of them.
    for sym in (SYM_1, SYM_2):
        after[sym, [IN_O, JOIN]], starts[sym, [IN_O, JOIN]] = IN_O, False
    after[SYM_L, TWO], after[SYM_L, ONE] = ONE, OPEN
    starts[SYM_L, [TWO, ONE]] = False
    return after, starts


@lru_cache(1)
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All composed transition functions by number: their values, compositions (first, then), and the numbers of symbols within
    a text and at its start (where the state before does not matter)."""
    after, _ = _steps()
    known: dict[tuple, int] = {}
    number = lambda f: known.setdefault(tuple(int(x) for x in f), len(known))
    number(range(8))
    inside = [number(after[s]) for s in range(8)]
    at_start = [number([after[s][OPEN]] * 8) for s in range(8)]
    done = 0
    while done < len(known):
        f = list(known)[done]
        for s in range(8):
            number(after[s][list(f)])
        done += 1
    values = np.array(list(known), np.uint8)
    then = np.array([[known[tuple(int(x) for x in g[f])] for g in values] for f in values], np.uint8)
    return values, then, np.array(inside, np.uint8), np.array(at_start, np.uint8)


def _prefixes(functions: np.ndarray) -> np.ndarray:
    """Composition of all functions up to and with each place: within blocks at once, then over the blocks."""
    _, then, _, _ = _functions()
    n = len(functions)
    if n <= BLOCK:
        out = functions.copy()
        for i in range(1, n):
            out[i] = then[out[i - 1], out[i]]
        return out
    blocks = -(-n // BLOCK)
    grid = np.zeros((BLOCK, blocks), np.uint8)  # 0: nothing happens
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = functions
    grid[:] = padded.reshape(blocks, BLOCK).T
    for i in range(1, BLOCK):
        grid[i] = then[grid[i - 1], grid[i]]
    before = np.zeros(blocks, np.uint8)
    before[1:] = _prefixes(grid[-1])[:-1]
    return then[before[None, :], grid].T.reshape(-1)[:n]


def boundaries(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where pieces start, in texts laid end to end. points: code points; first: where texts start."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    begins[n] = True
    white = kind >= SPACE
    ends_white = np.ones(n, bool)  # what follows is white space or the end of the text
    ends_white[:-1] = white[1:]
    ends_white |= begins[1:]
    symbol = kind.copy()  # letter, number and other have the same numbers
    symbol[white] = np.where(ends_white[white], SYM_W, np.where(kind[white] == SPACE, SYM_SPACE, SYM_LAST))
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        reach = np.concatenate([points, [0, 0]])
        one, two = reach[quotes + 1], reach[quotes + 2]
        inside = lambda k: ~begins[np.minimum(quotes + k, n)]
        ok1, ok2 = inside(1), inside(1) & inside(2)
        pair = one.astype(np.int64) * 0x110000 + two
        twos = np.isin(pair, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")]) & ok2
        ones = np.isin(one, [ord(c) for c in "stmd"]) & ok1
        symbol[quotes] = np.where(twos, SYM_2, np.where(ones, SYM_1, SYM_O))
    values, _, inner, at_start = _functions()
    functions = np.where(begins[:n], at_start[symbol], inner[symbol])
    upto = _prefixes(functions)
    state = np.full(n, OPEN, np.uint8)
    state[1:] = values[upto[:-1], OPEN]
    state[begins[:n]] = OPEN
    _, starts = _steps()
    return np.flatnonzero(starts[symbol, state])


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank merges first, the leftmost of equal ones.

    Pairs wait in a heap and parts in a linked list, so a piece of n bytes takes n log n steps.
    """
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    from heapq import heapify, heappop, heappush

    n = len(piece)
    end = list(range(1, n + 1))  # part i is piece[i:end[i]]
    prev = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = end[i]
        if not alive[i] or j >= n or end[j] != stop or not alive[j]:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            prev[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if prev[i] >= 0 and (r := ranks.get(piece[prev[i] : stop])) is not None:
            heappush(heap, (r, prev[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class Vocabulary:
    """Ranks for merging, a cache of merged pieces, and all tokens in one byte array with offsets for decoding."""

    def __init__(self, path: str) -> None:
        self.ranks = read_ranks(path)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            tokens[i] = token
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        # Every way to merge two tokens into one: keys (left, right) in order, and the ids they give.
        self.base = len(tokens)
        pairs = sorted(
            (left * self.base + right, i)
            for token, i in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None and (right := self.ranks.get(token[cut:])) is not None
        )
        self.keys = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.merges = np.array([i for _, i in pairs] + [NEVER], np.int32)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        """Empty the cache: piece to place; by place the ids as text; where the ids of a place end in one array."""
        self.places: dict[str, int] = {}
        self.texts: list[str] = []
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.merges[at], NEVER)

    def learn(self, pieces: list[str]) -> None:
        """Merge pieces that are not in the cache and keep them there."""
        found: list[list[int]] = [[]] * len(pieces)
        raw = [p.encode() for p in pieces]
        long = [i for i, p in enumerate(raw) if len(p) > WIDTHS[-1]]
        for i in long:
            found[i] = merged(raw[i], self.ranks)
        low = 0
        for width in WIDTHS:
            some = [i for i, p in enumerate(raw) if low < len(p) <= width]
            low = width
            for i, ids in zip(some, self._merge_all([raw[i] for i in some], width)):
                found[i] = ids
        n = len(self.texts)
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.array([i for x in found for i in x], np.int32)
        ends = (self.ends[n - 1] if n else 0) + np.cumsum(sizes)
        start = int(self.ends[n - 1]) if n else 0
        while start + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(ends) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[start : start + len(flat)] = flat
        self.ends[n : n + len(ends)] = ends
        self.places.update(zip(pieces, range(n, n + len(pieces))))
        self.texts += [",".join(map(str, x)) for x in found]

    def _merge_all(self, raw: list[bytes], width: int) -> list[list[int]]:
        """Ids of short pieces: in every round each piece merges its leftmost pair of lowest rank."""
        if not raw:
            return []
        grid = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in raw), np.uint8).reshape(len(raw), width)
        size = np.array([len(p) for p in raw])
        parts = np.where(np.arange(width) < size[:, None], self.bytes[grid], -1)
        ranks = self.pair_ranks(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(raw), width - 1)
        done = np.full((len(raw), width), -1, np.int32)
        rows, columns = np.arange(len(raw)), np.arange(width)
        while len(rows):
            best = ranks.argmin(1)
            rank = ranks[np.arange(len(rows)), best]
            go = rank < NEVER
            done[rows[~go]] = parts[~go]
            rows, parts, ranks, best, rank = rows[go], parts[go], ranks[go], best[go], rank[go]
            if not len(rows):
                break
            at = np.arange(len(rows))
            shift = np.minimum(columns + (columns > best[:, None]), width - 1)
            parts = np.take_along_axis(parts, shift, 1)
            parts[:, -1] = -1
            parts[at, best] = rank
            shift = np.minimum(columns[:-1] + (columns[:-1] > best[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, shift, 1)
            ranks[:, -1] = NEVER
            right = parts[at, np.minimum(best + 1, width - 1)]
            after = np.minimum(best, width - 2)
            ranks[at, after] = np.where(best < width - 1, self.pair_ranks(rank, right), ranks[at, after])
            some = best > 0
            ranks[at[some], best[some] - 1] = self.pair_ranks(parts[at[some], best[some] - 1], rank[some])
        return [[i for i in row if i >= 0] for row in done.tolist()]

    def ids_of(self, places: np.ndarray) -> np.ndarray:
        """Ids of a row of cached pieces."""
        ends = self.ends[places]
        starts = np.where(places > 0, self.ends[places - 1], 0)
        return _ranges(self.ids, starts, ends - starts)

    def decode(self, ids: np.ndarray) -> bytes:
        return _ranges(self.data, self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]).tobytes()


def _ranges(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array, end to end."""
    if not len(size):
        return values[:0]
    ends = np.cumsum(size)
    return values[np.arange(ends[-1]) + np.repeat(start - ends + size, size)]


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(texts: list[str], vocab: Vocabulary) -> Iterator[tuple[str, np.ndarray]]:
    """Ids of each text, joined by commas, and as an array."""
    sizes = np.array([len(t) for t in texts], np.int64)
    i = 0
    while i < len(texts):
        # As many texts as fit into a scan, one at least.
        j = i + max(1, int(np.searchsorted(np.cumsum(sizes[i : i + 4096]), SCAN, "right")))
        joined = "".join(texts[i:j])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        edges = np.concatenate([[0], np.cumsum(sizes[i:j])])
        cuts = boundaries(points, edges[:-1][sizes[i:j] > 0])
        share = np.searchsorted(cuts, edges).tolist()
        cuts = [*cuts.tolist(), len(joined)]
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(vocab.texts) > CACHE:
            vocab.forget()
        if new := [p for p in set(pieces) if p not in vocab.places]:
            vocab.learn(new)
        places = list(map(vocab.places.__getitem__, pieces))
        numbers = np.array(places, np.int64)
        for a, b in zip(share, share[1:]):
            yield ",".join(map(vocab.texts.__getitem__, places[a:b])), vocab.ids_of(numbers[a:b])
        i = j


def bpe_round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """``(key, n_tokens, ids_sha256, decoded_sha256[, ids])`` of every whole text.

    ids_sha256: of the decimal ids joined by commas; decoded_sha256: of the bytes decoded from these ids. Null counts as empty;
    an empty text has no ids. Repeated rows are encoded one by one; a null key stays; extra columns are left out. Every executor
    has the vocabulary file at ``path``. Batches are cut into scans of about a quarter of a million code points, each given out
    before the next, so memory follows the longest text, not the batch.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            i = 0
            while i < len(texts):
                # Rows of one scan, one at least: only their texts and ids are in memory.
                done = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, done + SCAN, "right")))
                counts, digests, flat = [], [], []
                for ids, numbers in encode_texts([t or "" for t in texts.slice(i, j - i).to_pylist()], vocab):
                    digests.append((hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(vocab.decode(numbers)).hexdigest()))
                    counts.append(len(numbers))
                    if with_ids:
                        flat.append(numbers)
                columns = [keys.slice(i, j - i), pa.array(counts, pa.int64()), *[pa.array(d, pa.string()) for d in zip(*digests)]]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(offsets, np.concatenate(flat).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names)
                i = j

    source = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text"))
    kind = source.schema["_key"].dataType.simpleString()
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return source.mapInArrow(encode, schema)


@query("op3_bpe_round_trip")
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_round_trip(table(spark, sf_dir, "documents"), path, with_ids=False)
