"""Repairs of conversations against a search over all edits and against interval parsing with every split."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from fitlens.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def faults(rows):
    """Rows of a conversation in order, each with its fault and role initial."""
    rows = sorted(((t, r or " " if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, out = set(), []
    for turn, role, text in rows:
        body = text.strip(WHITE)
        fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def cheapest(rows):
    """(cost, audit, repaired turns) by trying every edit of every row and up to two insertions in every gap."""
    ways = []
    for turn, role, text, fault in rows:
        own = [(2, "D", None)]
        if fault not in (1, 2):
            more = 5 if fault == 3 else 0
            own += [(more, "K", (role, text)), (1 + more, "R", ("user", text)), (1 + more, "R", ("assistant", text))]
        ways.append(own)
    filler = [(5 * len(p), "I" * len(p), p) for n in range(3) for p in itertools.product((("user", ""), ("assistant", "")), repeat=n)]
    states = {"": (0, "", ())}  # turns so far by their initials, shortened to what matters
    def grow(states, options):
        out = {}
        for cost, audit, turns in states.values():
            for c, a, more in options:
                new = (cost + c, audit + a, turns + tuple(more))
                initials = "".join(r[:1] for r, _ in new[2])
                if not re.fullmatch("(s?(ua)*u?)?", initials):
                    continue
                key = initials[:1] + str(len(initials)) if len(initials) < 2 else initials[-1] + str(len(initials) % 2)
                if key not in out or new[:2] < out[key][:2]:
                    out[key] = new
        return out
    states = grow(states, filler)
    for own in ways:
        states = grow(states, [(c, a, () if t is None else (t,)) for c, a, t in own])
        states = grow(states, filler)
    done = [s for s in states.values() if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in s[2]))]
    return min(done, key=lambda s: s[:2])


def expected(rows):
    rows = faults(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    tally = [sum(r[3] == f for r in rows) for f in (1, 2, 3)]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, repaired = cheapest(rows)
    return (gaps, *tally, illegal, cost, audit), list(repaired)


def conversation(rng, n):
    text = lambda: rng.choice(("", " \t", "Yes.", "No!", "Why", "Well?  ", "é", "Long text. Cut", "w" * 40 + rng.choice("ab") + "."))
    return [(rng.choice((None, *range(n + 2))), rng.choice(("system", "user", "assistant", "assistant", "user", "tool", None)), rng.choice((text(), text(), None))) for _ in range(n)]


def check(frame, conversations, parts=4):
    rows = [(c, *r, "x", 0) for c, own in conversations.items() for r in own]
    random.Random(0).shuffle(rows)
    df = frame(rows, SCHEMA + ", audit string, place int").repartition(parts)
    report, turns = cr.repair(df)
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in report.collect()}
    repaired = {c: [] for c in found}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.place)):
        assert r.place == len(repaired[r.conv_id])
        repaired[r.conv_id].append((r.role, r.text))
    want = {c: expected(own) for c, own in conversations.items() if own}
    assert found == {c: w[0] for c, w in want.items()}
    assert repaired == {c: w[1] for c, w in want.items()}


def test_repairs_equal_all_edits(frame):
    rng = random.Random(4)
    conversations = {c: conversation(rng, rng.randrange(1, 9)) for c in range(250)}
    conversations[None] = conversation(rng, 5)
    conversations[1000] = [(i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(40)]
    conversations[1001] = [(i, "user", "the same") for i in range(30)]
    conversations[1002] = [(7, "user", "the same.")] * 30
    conversations[1003] = [(None, "assistant", f"{i}!") for i in range(20)]
    conversations[1004] = [(1, "user", "z" * 60_000 + "."), (2, "assistant", "z" * 60_000)]
    check(frame, conversations)


def test_a_conversation_in_many_pieces(frame, spark):
    """One conversation has most rows; it lies in all ranges and batches."""
    rng = random.Random(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = [(i // 2, rng.choice(("user", "assistant")), rng.choice((f"Text {i}.", f"Text {i}", "again."))) for i in range(900)]
        check(frame, {1: conversation(rng, 4), 2: hot, 3: conversation(rng, 6)}, parts=7)
        ordered = cr.in_order(frame([(2, *r) for r in hot], "_conv long, _turn long, _role string, _text string"))
        assert ordered.select((ordered["_id"] / 2**33).cast("int")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def full_table(kinds):
    """The cell of a row of kinds by interval parsing over all spans and all splits."""
    costs, audits = cr.row_cells()
    cell = {(i, i + 1): list(zip(costs[k].tolist(), [a.decode() for a in audits[k].tolist()])) for i, k in enumerate(kinds)}
    for size in range(2, len(kinds) + 1):
        for i in range(len(kinds) - size + 1):
            splits = [cr.joined(cell[i, k], cell[k, i + size]) for k in range(i + 1, i + size)]
            assert all(s == splits[0] for s in splits)  # every split gives the same cell
            cell[i, i + size] = splits[0]
    return cell[0, len(kinds)]


def test_levels_equal_all_splits():
    rng = random.Random(8)
    groups = [[rng.randrange(16) for _ in range(rng.randrange(1, 14))] for _ in range(60)]
    out = cr.parsed(np.array([k for g in groups for k in g]), np.repeat(np.arange(60), [len(g) for g in groups]))
    assert out == {i: full_table(g) for i, g in enumerate(groups)}
    assert cr.parsed(np.zeros(0, np.int64), np.zeros(0, np.int64)) == {}


@pytest.mark.parametrize(("initials", "cost", "audit"), [
    ("", 0, ""), ("ua", 0, "KK"), ("sua", 0, "KKK"), ("u", 2, "D"), ("a", 2, "D"), ("s", 2, "D"), ("us", 1, "KR"), ("uua", 2, "DKK"), ("au", 2, "RR"), ("su", 2, "RR"), ("suaua", 0, "KKKKK"), ("aa", 1, "RK"),
])
def test_small_repairs(initials, cost, audit):
    names = {"s": "system", "u": "user", "a": "assistant"}
    cell = cr.parsed(np.array(["sua".index(c) for c in initials], np.int64), np.zeros(len(initials), np.int64)).get(0)
    best = min(cell[cr.PAIRS.index((0, q))] for q in (0, 3)) if cell else (0, "")
    assert best == cheapest([(i, names[c], f"{i}.", 0) for i, c in enumerate(initials)])[:2] == (cost, audit)


def test_digests_of_turns(frame, spark):
    rows = [(c, i, "user", f"é {c}\n{i}") for c in (1, 2, None) for i in range(50)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = {r.conv_id: r.sha256 for r in cr.turn_digests(frame(rows, "conv_id long, place long, role string, text string").repartition(3)).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == {c: hashlib.sha256("\n".join(f"user:é {c}\n{i}" for i in range(50)).encode()).hexdigest() for c in (1, 2, None)}


def test_without_rows(frame):
    report, turns = cr.repair(frame([], SCHEMA))
    assert report.count() == turns.count() == cr.turn_digests(turns).count() == 0
    assert report.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def test_damage(frame):
    import zlib

    rows = [(c, t, r, x) for c in (None, *range(40)) for t in (None, *range(4)) for r, x in (("system", "A. B! C?"),)] + [(900, 1, None, None)]
    out = sorted((tuple(r) for r in cr.damaged(frame(rows, SCHEMA)).collect()), key=repr)
    want = []
    for c, t, r, x in rows:
        r, x = r or " ", x or " "
        dealt = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        new = (c, t, "user" if dealt == 4 else r, "" if dealt == 1 else re.sub("[.!?]", "", x) if dealt == 2 else x)
        want += [new] * (0 if dealt == 0 else 2 if dealt == 3 else 1)
    assert out == sorted(want, key=repr) and len({w[2:] for w in want}) >= 4
