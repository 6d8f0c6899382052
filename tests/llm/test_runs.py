"""Periodic runs against a search over all distances, and the transform against plain sums."""

from __future__ import annotations

import hashlib
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest

from fitlens.llm import periodic_runs as pr
from fitlens.llm.registry import table

SF = "/root/testdata/sf0.001"


def brute(words):
    """Runs (start, length, period): at every distance, the stretches of words that are the same so far apart."""
    found = {}
    for d in range(1, len(words) // 4 + 1):
        same = [i + d < len(words) and words[i] == words[i + d] for i in range(len(words))]
        i = 0
        while i < len(words):
            j = i
            while j < len(words) and same[j]:
                j += 1
            if j > i and j + d - i >= max(6, 4 * d):
                found.setdefault((i, j + d), d)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def repetitive(rng):
    out = []
    for _ in range(rng.randrange(6)):
        size, letters = rng.choice((1, 2, 3, 5, 9, 17)), "abcdefgh"[: rng.choice((1, 2, 8))]
        out += ([rng.choice(letters) for _ in range(size)] * 8)[: rng.randrange(1, 8 * size + 1)]
    return out


def test_brute_force_follows_the_definition():
    """The runs of short texts by the smallest period of every stretch."""
    rng = random.Random(3)
    for _ in range(60):
        words = [rng.choice("ab") for _ in range(rng.randrange(16))]
        smallest = lambda s, e: next(q for q in range(1, e - s + 1) if all(words[i] == words[i + q] for i in range(s, e - q)))
        want = []
        for s in range(len(words)):
            for e in range(s + 1, len(words) + 1):
                q = smallest(s, e)
                before, after = s > 0 and words[s - 1] == words[s - 1 + q], e < len(words) and words[e] == words[e - q]
                if e - s >= max(6, 4 * q) and not before and not after:
                    want.append((s, e - s, q))
        assert brute(words) == want


@pytest.mark.parametrize(("largest", "field"), [(1 << 15, 2**31 - 1), (2, 2**31 - 1), (4, 2**31 - 1), (1 << 15, 5), (2, 3)])
def test_runs_equal_brute_force(monkeypatch, largest, field):
    """Also with blocks that are cut short, and with hashes that take many different words for equal."""
    monkeypatch.setattr(pr, "LARGEST", largest)
    monkeypatch.setattr(pr, "FIELD", field)
    rng = random.Random(largest + field)
    for _ in range(30):
        texts = [repetitive(rng) for _ in range(20)]
        sizes, runs, counts, collapsed = pr.scan_texts([" \t".join(t).encode() for t in texts])
        ends = np.cumsum(counts)
        assert sizes == [len(t) for t in texts]
        for words, a, b, rest in zip(texts, ends - counts, ends, collapsed):
            want = brute(words)
            assert [tuple(r) for r in runs[a:b].tolist()] == want
            assert rest.decode() == " ".join(collapse(words, want))


@pytest.mark.parametrize("size", [2, 4, 16, 32, 64, 512, 4096])
def test_transform_gives_squared_differences(size):
    rng = np.random.default_rng(size)
    most = int(((pr.PRIME - 1) / size) ** 0.5) + 1
    blocks, windows = rng.integers(0, most, (3, size)).astype(float), rng.integers(0, most, (3, 2 * size)).astype(float)
    windows[1, 1 : size + 1] = blocks[1]
    want = np.array([[((b - w[d : d + size]) ** 2).sum() for d in range(size + 1)] for b, w in zip(blocks, windows)])
    assert (pr.squared_differences(blocks, windows) == want).all() and want.max() < pr.PRIME and want[1, 1] == 0
    assert (np.mod(pr.inverse(pr.transform(windows)), pr.PRIME) == windows).all()


def test_long_periods_and_long_texts():
    passage = [f"w{i}" for i in range(50_000)]
    words = ["x", *passage * 4, "w0", "y"]
    assert pr.scan_texts([" ".join(words).encode()])[1].tolist() == [[1, 200_001, 50_000]]
    assert pr.scan_texts([b"w " * 100_000])[1].tolist() == [[0, 100_000, 1]]


TIMED = """
import time
from fitlens.llm import periodic_runs as pr
for n in (1000, 8000, 64_000):
    text = b"a " * n + b" ".join(b"%d" % i for i in range(n)) + b" a" * n
    start = time.process_time()
    assert pr.scan_texts([text])[1].tolist() == [[0, n, 1], [2 * n, n, 1]]
    print(time.process_time() - start)
"""


def test_time_grows_with_the_text():
    """Two long runs of one word, far apart, match at very many distances. Matrix products take one thread, as in a task."""
    out = subprocess.run([sys.executable, "-c", TIMED], env=os.environ | {"OMP_NUM_THREADS": "1"}, capture_output=True, text=True, check=True)
    _, some, eight_times = map(float, out.stdout.split())
    assert eight_times < 16 * some + 0.5


def test_operator_on_odd_rows(frame):
    long = "again and " * 30_000
    rows = [(1, "a b " * 4, "x"), (1, "a b " * 4, "x"), (None, "c\n" * 6, None), (2, None, None), (3, "", "y"), (4, " \t\n", "y"), (5, long, "z"), (6, "é é é é é é\xa0é", "")]
    df = frame([(i, t, e, 0) for i, t, e in rows], "doc_id long, text string, runs string, n_words int")
    out = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(df).collect()), key=repr)
    assert out == sorted(
        [
            (1, 8, [(0, 8, 2)], "a b"), (1, 8, [(0, 8, 2)], "a b"), (None, 6, [(0, 6, 1)], "c"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""),
            (5, 60_000, [(0, 60_000, 2)], "again and"), (6, 6, [], "é é é é é é\xa0é"),
        ],
        key=repr,
    )
    assert pr.periodic_runs(df.limit(0)).count() == 0


def test_small_scans_give_the_same(frame, monkeypatch):
    rng = random.Random(9)
    texts = [" ".join(repetitive(rng)) for _ in range(50)]
    df = frame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: (r.runs, r.collapsed) for r in pr.periodic_runs(df).collect()}
    monkeypatch.setattr(pr, "SCAN", 10)
    monkeypatch.setattr(pr, "CELLS", 16)
    for i, text in enumerate(texts):
        _, runs, _, collapsed = pr.scan_texts([text.encode()])
        assert ([tuple(r) for r in whole[i][0]], whole[i][1]) == ([tuple(r) for r in runs.tolist()], collapsed[0].decode())


def restarted(i, words):
    h, n = zlib.crc32(str(i).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[a + (k - a) % p if k >= a else k] for k in range(n)]


def test_query_equals_brute_force(spark):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = {r.doc_id: r for r in pr.op11_periodic_runs(spark, SF).collect()}
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert len(out) == len(rows) and any(r.n_runs for r in out.values())
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        words = restarted(doc_id, words)
        runs, r = brute(words), out[doc_id]
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        want = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *want)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)) and r.collapsed_sha256 == sha(" ".join(collapse(words, runs)))


def test_restarted_texts_of_odd_rows(frame):
    rows = [(i, " one\ttwo  three\nfour five six seven ") for i in range(60)] + [(i, t) for i in (None, *range(100, 160)) for t in ("", None, " \n")]
    out = pr.restarted(frame(rows, "doc_id long, text string")).collect()
    want = [(i, restarted(i, (t or "").split()) if i is not None else (t or "").split()) for i, t in rows]
    assert sorted(((r.doc_id, (r.text or "").split()) for r in out), key=repr) == sorted(want, key=repr)
    assert any(len(set(w)) < 7 for _, w in want if w)
