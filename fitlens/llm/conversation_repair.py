"""Cheapest repairs of conversations, by weighted interval parsing.

A well-formed conversation is empty, or an optional system turn and then pairs of a user and an assistant turn. The repair grammar
in Chomsky normal form has a nonterminal X[p, q] for each two states of that pattern: "what this span is repaired to leads from p
to q". X[p, q] -> X[p, r] X[r, q] joins neighbouring spans; X[p, q] -> a row that is kept, given another role or deleted, with
inserted turns around it (the insertion closure). A cell holds the cheapest derivation of each nonterminal as (cost, audit), ties
by audit. Cells are combined bottom-up by span length. As the rules join states, not kinds of spans, every split of a span gives
the same cell, so one split is enough, spans double their length from level to level, and pieces of a conversation that lie in
several tasks are parsed apart: only their cells meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table
from fitlens.operators.joins import null_safe_join
from fitlens.session import stored

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 50
BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW = 1, 2, 3
# States: nothing yet; after system; after user; after assistant. Initials of roles and the states that a turn leads from and to.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}
# White space, and what a whole turn ends with.
WHITE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
# Nonterminals that some derivation has, and the rules that join two of them.
PAIRS = [(p, q) for p in range(4) for q in range(4) if p == q or q in (USER, ASSISTANT) or (p, q) == (START, SYSTEM)]
RULES = [(PAIRS.index((p, q)), PAIRS.index((p, r)), PAIRS.index((r, q))) for p, q in PAIRS for r in range(4) if (p, r) in PAIRS and (r, q) in PAIRS]
# Characters of a prefix by which rows of one turn and role are dealt to tasks; the whole texts order them.
PREFIX = 32

Cell = list[tuple[int, str]]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans in a row."""
    out = [(NEVER, "")] * len(PAIRS)
    for x, a, b in RULES:
        cost = left[a][0] + right[b][0]
        if cost <= out[x][0] and cost < NEVER:
            out[x] = min(out[x], (cost, left[a][1] + right[b][1]))
    return out


def _cell(steps: dict[tuple[int, int], tuple[int, str]]) -> Cell:
    return [steps.get(pair, (NEVER, "")) for pair in PAIRS]


@lru_cache(1)
def row_cells() -> tuple[np.ndarray, np.ndarray]:
    """Costs and audits of a row's cell, by fault * 4 + place of the initial in "sua" (3 for any other)."""
    stay = {(p, p): (0, "") for p in range(4)}
    insert = _cell(stay | {(START, USER): (INSERT, "I"), (START, ASSISTANT): (2 * INSERT, "II"), (SYSTEM, USER): (INSERT, "I"), (SYSTEM, ASSISTANT): (2 * INSERT, "II"), (USER, ASSISTANT): (INSERT, "I"), (ASSISTANT, USER): (INSERT, "I")})
    cells = []
    for fault in range(4):
        for initial in "sua-":
            steps = {(p, p): (DELETE, "D") for p in range(4)}
            if fault not in (BLANK_ROW, DUPLICATE_ROW):
                more = TRUNCATED if fault == TRUNCATED_ROW else 0
                for to in "ua":
                    steps |= {move: (REROLE + more, "R") for move in MOVES[to].items()}
                steps |= {move: (more, "K") for move in MOVES.get(initial, {}).items()}
            cells.append(joined(joined(insert, _cell(steps)), insert))
    costs = np.array([[c for c, _ in cell] for cell in cells], np.int64)
    return costs, np.array([[a.encode() for _, a in cell] for cell in cells])


def parsed(kinds: np.ndarray, groups: np.ndarray) -> dict[int, Cell]:
    """The cell of each group of rows that stand in a row, all groups level by level together. kinds: as in ``row_cells``."""
    costs, audits = (table[kinds] for table in row_cells())
    done: dict[int, Cell] = {}
    while len(groups):
        heads = np.concatenate([[True], groups[1:] != groups[:-1]])
        starts = np.flatnonzero(heads)
        sizes = np.diff(np.append(starts, len(groups)))
        for i in starts[sizes == 1].tolist():
            done[int(groups[i])] = list(zip(costs[i].tolist(), [a.decode() for a in audits[i].tolist()]))
        place = np.arange(len(groups)) - np.repeat(starts, sizes)
        going, size = np.repeat(sizes > 1, sizes), np.repeat(sizes, sizes)
        first = np.flatnonzero(going & (place % 2 == 0))
        if not len(first):
            break
        single = place[first] + 1 == size[first]
        left, alone = first[~single], first[single]
        new_costs = np.full((len(left), len(PAIRS)), NEVER, np.int64)
        new_audits = np.zeros((len(left), len(PAIRS)), f"S{2 * audits.dtype.itemsize}")
        for x, a, b in RULES:
            cost = costs[left, a] + costs[left + 1, b]
            may = np.flatnonzero((cost <= new_costs[:, x]) & (cost < NEVER))
            audit = np.strings.add(audits[left[may], a], audits[left[may] + 1, b])
            better = (cost[may] < new_costs[may, x]) | (audit < new_audits[may, x])
            new_costs[may[better], x] = cost[may[better]]
            new_audits[may[better], x] = audit[better]
        order = np.argsort(np.concatenate([left, alone]), kind="stable")
        groups = np.concatenate([groups[left], groups[alone]])[order]
        costs = np.concatenate([new_costs, costs[alone]])[order]
        audits = np.concatenate([new_audits, audits[alone]])[order]
        widest = int(np.strings.str_len(audits).max(initial=1))
        audits = audits.astype(f"S{max(1, widest)}")
    return done


def _edits(audit: str, rows: int) -> list[tuple[str, str, int]]:
    """For each row of a conversation its part of the audit, with insertions before it (after the last row, too), the initials of
    the turns that come of it ("k" for a role that is kept), and the place of the first of them."""
    total = sum(c != "D" for c in audit)
    system = total % 2
    out: list[tuple[str, str, int]] = []
    part, roles, place, first = "", "", 0, 0
    for c in audit:
        part += c
        if c != "D":
            roles += "k" if c == "K" else "ua"[(place - system) % 2]
            place += 1
        if c != "I" and len(out) < rows - 1:
            out.append((part, roles, first))
            part, roles, first = "", "", place
    return [*out, (part, roles, first)] if rows else out


def in_order(rows: DataFrame) -> DataFrame:
    """The stored rows ``(_conv, _turn, _role, _text)`` with an ``_id`` that grows along the order of conversations and turns.

    Rows are dealt to tasks by ranges, so a long conversation spreads over several of them. Rows of one turn (null first) are
    ordered by role and text.
    """
    keys = [F.asc_nulls_first("_conv"), F.asc_nulls_first("_turn"), F.asc("_role")]
    ranged = rows.repartitionByRange(*keys, F.asc(F.substring("_text", 1, PREFIX)))
    return stored(ranged.sortWithinPartitions(*keys, F.asc("_text")).withColumn("_id", F.monotonically_increasing_id()))


def with_faults(ordered: DataFrame) -> DataFrame:
    """``(_conv, _id, _turn, _role, _fault)`` of all rows, in order within tasks that hold a range of ids each."""
    stripped = F.btrim("_text", F.lit(WHITE))
    own = ordered.select("_conv", "_id", "_turn", "_role", F.unhex(F.md5("_text")).alias("_digest"), (stripped == "").alias("_blank"), F.substring(stripped, -1, 1).isin(*ENDS).alias("_ended"))
    same = ["_conv", "_role", "_digest"]
    # Only rows that are there more than once have to meet the first of them.
    firsts = own.groupBy(*same).agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    fault = F.when(F.col("_blank"), BLANK_ROW).when(F.col("_id") > F.col("_first"), DUPLICATE_ROW).when(~F.col("_ended"), TRUNCATED_ROW).otherwise(0)
    met = null_safe_join(own, firsts, same, "left").select("_conv", "_id", "_turn", "_role", fault.alias("_fault"))
    return met.repartitionByRange("_id").sortWithinPartitions("_id")


COUNTS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")
PIECE = "first long, n long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, head string, tail string, costs array<long>, audits array<string>"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``(conv, id, turn, role, fault)`` in order, each stretch of ids of one conversation as counts and one cell."""
    schema = None
    left: list[dict] = []

    def closed(pieces: list[dict]) -> pa.RecordBatch:
        rows = [p | {"costs": [c for c, _ in p["cell"]], "audits": [a for _, a in p["cell"]]} for p in pieces]
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in schema], schema=schema)

    for batch in batches:
        if schema is None:
            plain = [(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in PIECE.split(", ")[:-2]]
            schema = pa.schema([("conv", batch.schema.field(0).type), *plain, ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
        kinds, groups, pieces = [], [], []
        for conv, number, turn, role, fault in zip(*[c.to_pylist() for c in batch.columns]):
            initial = role[:1]
            if not pieces or pieces[-1]["conv"] != conv or pieces[-1]["first"] + pieces[-1]["n"] != number:
                pieces.append({"conv": conv, "first": number, **dict.fromkeys(COUNTS, 0), "low": None, "high": None, "head": initial, "tail": None})
            piece = pieces[-1]
            piece["n"] += 1
            if fault:
                piece[COUNTS[fault]] += 1
            piece["illegal"] += piece["tail"] is not None and piece["tail"] + initial not in LEGAL
            piece["tail"] = initial
            if turn is not None:
                piece["turns"] += piece["high"] != turn
                piece["low"], piece["high"] = turn if piece["low"] is None else piece["low"], turn
            kinds.append(fault * 4 + ("sua".find(initial) if initial and initial in "sua" else 3))
            groups.append(len(pieces) - 1)
        for i, cell in parsed(np.array(kinds, np.int64), np.array(groups, np.int64)).items():
            pieces[i]["cell"] = cell
        if left and pieces and left[0]["conv"] == pieces[0]["conv"] and left[0]["first"] + left[0]["n"] == pieces[0]["first"]:
            pieces[0] = together(left.pop(), pieces[0])
        pieces = left + pieces
        left = pieces[-1:]
        if pieces[:-1]:
            yield closed(pieces[:-1])
    if left:
        yield closed(left)


def together(a: dict, b: dict) -> dict:
    """Two pieces of a conversation, one after the other, as one."""
    out = {"conv": a["conv"], "first": a["first"], "head": a["head"], "tail": b["tail"], "cell": joined(a["cell"], b["cell"])}
    out |= {c: a[c] + b[c] for c in COUNTS}
    out["illegal"] += a["tail"] + b["head"] not in LEGAL
    out["turns"] -= a["high"] is not None and a["high"] == b["low"]
    out["low"] = b["low"] if a["low"] is None else a["low"]
    out["high"] = a["high"] if b["high"] is None else b["high"]
    return out


def _repaired(conv: object, pieces: list[dict]) -> tuple[dict, list[dict]]:
    """The report of a conversation and the edits of its rows, from its pieces."""
    pieces = [p | {"conv": conv, "cell": list(zip(p["costs"], p["audits"]))} for p in sorted(pieces, key=lambda p: p["first"])]
    rows = [(p["first"], p["n"]) for p in pieces]
    while len(pieces) > 1:
        pieces = [together(*pieces[i : i + 2]) if i + 1 < len(pieces) else pieces[i] for i in range(0, len(pieces), 2)]
    whole = pieces[0]
    cost, audit = min(whole["cell"][PAIRS.index((START, end))] for end in (START, ASSISTANT))
    gaps = 0 if whole["low"] is None else whole["high"] - whole["low"] + 1 - whole["turns"]
    report = {c: whole[c] for c in ("blank", "duplicate", "truncated", "illegal")} | {"gaps": gaps, "cost": cost, "audit": audit}
    numbers = (first + i for first, n in rows for i in range(n))
    return report, [{"row": i, "edits": e, "roles": r, "place": p} for i, (e, r, p) in zip(numbers, _edits(audit, whole["n"]))]


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
EDITS = "array<struct<row:long,edits:string,roles:string,place:long>>"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in REPORT.split(", ")]
    edit = pa.list_(pa.struct([("row", pa.int64()), ("edits", pa.string()), ("roles", pa.string()), ("place", pa.int64())]))
    for batch in batches:
        found = list(map(_repaired, batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        columns = [pa.array([report[c] for report, _ in found], pa.string() if c == "audit" else pa.int64()) for c in names]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array([e for _, e in found], edit)], ["conv", *names, "rows"])


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """What was wrong with each conversation, and its repaired turns.

    The first table has one row for each conversation: ``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``. Rows are
    taken by turn (null first), those of one turn by role and text. gaps: whole numbers without a row between the first and the
    last turn, null turns left out. A row's first fault counts: blank (nothing but space and \\x09-\\x0D), duplicate (role and
    text seen earlier in the conversation), truncated (its last other character is none of ``.!?``). illegal: neighbours whose
    roles' initials are not su, ua or au. cost and audit: of the cheapest repair, ties by audit: keep (K, 0), give the role of user
    or assistant (R, 1), delete (D, 2; the only edit for blank and duplicate rows), insert an empty user or assistant turn
    (I, 5); a truncated row that is not deleted costs 5 more. What results is empty, or an optional system turn and pairs of
    user and assistant by the roles' initials; an empty role has no initial and is never kept.

    The second table has the repaired turns ``(conv, place, role, text)``, place from 0; long conversations are never brought
    together in it. A null role or text counts as one space. Null conversations are one conversation. Repeated rows are
    duplicates. Other columns are left out whatever their names. An empty table gives two empty tables.
    """
    source = rows.select(
        F.col(conv).alias("_conv"), F.col(turn).cast("long").alias("_turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "_role"), (text, "_text"))],
    )
    kind = source.schema["_conv"].dataType.simpleString()
    ordered = in_order(source)
    pieces = with_faults(ordered).mapInArrow(_pieces, f"conv {kind}, {PIECE}")
    listed = pieces.groupBy("conv").agg(F.collect_list(F.struct(*[c for c in pieces.columns if c != "conv"])).alias("pieces"))
    found = stored(listed.mapInArrow(_parse, f"conv {kind}, {REPORT}, rows {EDITS}"))
    edits = found.select(F.inline("rows"))
    turns = ordered.join(edits, F.col("_id") == F.col("row"))
    each = turns.select("_conv", "_role", "_text", "place", "roles", F.posexplode(F.split(F.regexp_replace("edits", "D", ""), "")).alias("i", "edit")).filter("edit <> ''")
    initial = F.substring(F.col("roles"), F.col("i") + 1, F.lit(1))
    repaired = each.select(
        F.col("_conv").alias(conv),
        (F.col("place") + F.col("i")).alias("place"),
        F.when(initial == "u", NAMES["u"]).when(initial == "a", NAMES["a"]).otherwise(F.col("_role")).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("_text")).alias("text"),
    )
    return found.drop("rows").withColumnRenamed("conv", conv), repaired


def turn_digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``(conv, sha256)`` of the lines ``role:text`` of each conversation, by place and joined by newlines.

    A digest is made from its first byte to its last, so the lines of a conversation go through one task, in order and one by one;
    the task keeps none of them.
    """
    lines = turns.select(F.col(conv).alias("_conv"), "place", F.concat("role", F.lit(":"), "text").alias("line"))
    kind = lines.schema["_conv"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list = []
        for batch in batches:
            ids, values = [], []
            for own, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if state and state[0] == own:
                    state[1].update(b"\n")
                else:
                    if state:
                        ids.append(state[0])
                        values.append(state[1].hexdigest())
                    state = [own, hashlib.sha256()]
                state[1].update(line.encode())
            kind_of = batch.schema.field(0).type
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind_of), pa.array(values, pa.string())], [conv, "sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([state[0]], kind_of), pa.array([state[1].hexdigest()])], [conv, "sha256"])

    return lines.repartition("_conv").sortWithinPartitions("_conv", "place").mapInArrow(digest, f"`{conv}` {kind}, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, as the CRC of ``conv_id:turn`` modulo 20 decides: 0 drops a row, 1 empties its text, 2 takes its
    ``.!?`` away, 3 doubles it, 4 makes its role user. Nulls count as one space there, in role and in text."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), dealt.alias("_dealt")).filter("_dealt <> 0")
    text = F.when(F.col("_dealt") == 1, "").when(F.col("_dealt") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    role = F.when(F.col("_dealt") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _key(cost: str, audit: str) -> str:
    return f"lpad(({cost})::VARCHAR, 9, '0') || {audit}"


def _plus(key: str, cost: str, edit: str) -> str:
    """SQL for a derivation, as nine digits of cost and the audit, with one more edit. Null stays null."""
    return _key(f"substr({key}, 1, 9)::BIGINT + {cost}", f"substr({key}, 10) || '{edit}'")


def _step() -> str:
    """SQL for the four states after one more row, insertions apart: deleted, kept or with another role."""
    out = []
    for to in range(4):
        ways = [_plus(f"s.x{to}", str(DELETE), "D")]
        for initial, moves in MOVES.items():
            for p in (p for p, q in moves.items() if q == to):
                more = f"CASE WHEN fault = {TRUNCATED_ROW} THEN {TRUNCATED} ELSE 0 END"
                whole = f"fault IN (0, {TRUNCATED_ROW})"
                ways.append(f"CASE WHEN {whole} AND initial = '{initial}' THEN {_plus(f's.x{p}', more, 'K')} END")
                if initial in NAMES:
                    ways.append(f"CASE WHEN {whole} THEN {_plus(f's.x{p}', f'{REROLE} + {more}', 'R')} END")
        out.append(f"least({', '.join(ways)}) AS x{to}" if len(ways) > 1 else f"{ways[0]} AS x{to}")
    return ", ".join(out)


def _closed(rows: str) -> str:
    """SQL that adds insertions behind a row."""
    user = f"least(x2, {_plus('x0', str(INSERT), 'I')}, {_plus('x1', str(INSERT), 'I')}, {_plus('x3', str(INSERT), 'I')})"
    return f"SELECT conv_id, place, x0, x1, {user} AS x2, least(x3, {_plus(user, str(INSERT), 'I')}) AS x3 FROM ({rows})"


ORACLE = f"""WITH RECURSIVE
crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
named AS (SELECT row_number() OVER () AS n, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
dealt AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(name) + 1), lambda i: ascii(substr(name, i, 1))::BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d FROM named, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM dealt, (VALUES (0), (1)) c(copy) WHERE d <> 0 AND (copy = 0 OR d = 3)),
placed AS (SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
  trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
judged AS (SELECT *, CASE WHEN body = '' THEN {BLANK_ROW} WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN {DUPLICATE_ROW}
  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN {TRUNCATED_ROW} ELSE 0 END AS fault,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair FROM placed),
states AS (
  {_closed(f"SELECT DISTINCT conv_id, 0::BIGINT AS place, '000000000' AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM judged")}
  UNION ALL
  {_closed(f"SELECT j.conv_id, j.place, {_step()} FROM states s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.place = s.place + 1")}),
best AS (SELECT conv_id, substr(x, 1, 9)::BIGINT AS cost, substr(x, 10) AS audit FROM (
  SELECT conv_id, least(x0, x3) AS x, row_number() OVER (PARTITION BY conv_id ORDER BY place DESC) AS r FROM states) WHERE r = 1),
edits AS (SELECT conv_id, i, substr(audit, i, 1) AS edit, length(replace(audit, 'D', '')) AS total,
  length(replace(substr(audit, 1, i - 1), 'I', '')) + 1 AS place, length(replace(substr(audit, 1, i - 1), 'D', '')) AS nth
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM best)),
repaired AS (SELECT e.conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (nth - total % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
  || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS digest
  FROM edits e LEFT JOIN placed p ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND p.place = e.place AND edit <> 'I' WHERE edit <> 'D' GROUP BY 1),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = {BLANK_ROW}) AS blank,
  count(*) FILTER (fault = {DUPLICATE_ROW}) AS duplicate, count(*) FILTER (fault = {TRUNCATED_ROW}) AS truncated,
  count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query("op12_conversation_repair", ORACLE)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the table, damaged by rule, with its faults and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    report, turns = repair(damaged(rows))
    everyone = rows.select("conv_id").distinct()
    out = null_safe_join(null_safe_join(everyone, report, ["conv_id"], "left"), turn_digests(turns), ["conv_id"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))
