"""Shared lines against brute force, with and without copied hashes."""

from __future__ import annotations

import collections
import random

import pytest

from fitlens.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(rows, chars, documents):
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= chars:
                holders[key_of(line)].add(i)
    keeper = {k: max(ids) for k, ids in holders.items() if len(ids) >= documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in keeper or keeper[key_of(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def varied(seed):
    rng = random.Random(seed)
    line = lambda: "".join(rng.choice("abÉ Z\t") for _ in range(rng.randrange(9)))
    common = [line() for _ in range(8)]
    rows = []
    for i in range(60):
        lines = [rng.choice((line(), rng.choice(common), f" {rng.choice(common).upper()}\r")) for _ in range(rng.randrange(12))]
        rows.append((rng.choice((i, i, i, 3, None)), "\n".join(lines)))
    rows += [(200, ""), (201, None), (None, None), (7, rows[7][1]), (7, rows[7][1]), (202, "\n" * 4)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("copied", [0, line_dedup.COPIED])
@pytest.mark.parametrize("seed", range(3))
def test_shared_lines_equal_brute_force(frame, monkeypatch, seed, copied):
    monkeypatch.setattr(line_dedup, "COPIED", copied)
    rows = varied(seed)
    df = frame([(i, t, "x", 0, 1, 2) for i, t in rows], "doc_id long, text string, line string, _place int, _key int, _id int").repartition(5)
    out = line_dedup.drop_shared_lines(df, chars=3, documents=4)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, 3, 4)


def test_lines_at_the_borders(frame):
    """40 code points and 5 documents are enough, 39 and 4 are not; the largest id keeps all of its own."""
    at, under, rare = "Ä" * 40, "é" * 39, "r" * 60
    rows = [(i, f"{at}\n{under}\nown {i}\n  {at.lower() if i == 9 else at}\t" + (f"\n{rare}" if i < 4 else "")) for i in (*range(5), 9)]
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_shared_lines(frame(rows, "doc_id long, text string")).collect()}
    assert out[4] == (f"{under}\nown 4\n  {at}\t".removesuffix(f"\n  {at}\t"), 4, 2)
    assert out[0] == (f"{under}\nown 0\n{rare}", 5, 2)
    # The key keeps letters beyond A-Z, so the lower-cased line of document 9 is another one, alone in its document.
    assert out[9] == (rows[-1][1], 4, 0)


def test_a_line_in_every_document_and_a_very_long_one(frame):
    line = "the same words at the foot of every single document"
    rows = [(i, f"text {i}\n{line}") for i in range(300)] + [(1000, f"{line}\n" * 20_000 + "end"), (2000, line)]
    out = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_shared_lines(frame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert out[1000] == ("end", 20_001, 20_000) and out[2000] == (line, 1, 0)
    assert all(out[i] == (f"text {i}", 2, 1) for i in range(300))


def test_lines_without_rows(frame):
    assert line_dedup.drop_shared_lines(frame([], "doc_id long, text string")).count() == 0
    out = line_dedup.drop_shared_lines(frame([("b", "A\nB"), ("a", None)], "doc_id string, text string")).collect()
    assert sorted(map(tuple, out)) == [("a", "", 1, 0), ("b", "A\nB", 2, 0)]


def test_plan_has_no_python(spark):
    plan = line_dedup.op13_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
