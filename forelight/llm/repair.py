"""Conversations brought into the order (system?)(user assistant)+ by the cheapest edits.

Edits keep a turn, give it the other role, delete it, or insert empty turns in
front of it. A run of inserts and the turn behind it are one macro edit, with a
code that ends in the turn's letter: I..K, I..R or D. No code is the prefix of
another, so strings of equally many macro edits are ordered by their first
different code. The dynamic programme over a conversation's turns therefore
holds no strings: a layer has, for each state (nothing yet, after a system,
user or assistant turn), the cost and the rank of its edits among the layer's
states, and each state points to its parent in the layer before. Layers look
alike but for a constant cost, so steps from layer to layer are remembered.

Conversations are sorted by ranges, not dealt by their ids, so one that holds a
large part of all rows is spread over many tasks. A task cuts what it has of a
conversation into blocks and sums up each block: cost and rank from every state
to every state. These few numbers are joined conversation by conversation; then
each block knows the states it begins and ends with and follows the parents
back. Only the digest of a conversation's text is taken in one task, block by
block, as it must be.

Defined results: rows of a conversation go by turn, nulls first, then by role
and text. A null role or text is one space. A null conversation id is a
conversation like others. Equal rows are counted and deleted but for one. Edits
that tie are the least as strings. A conversation without rows left has no
edits and an empty text. Long texts are read whole; empty tables give
empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm.common import Scratch, small_batches, table

#: States, by the role written last. A text may end in the first and in the last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of another role, of a deletion, of an insert, and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The state after a written turn of the alternating roles.
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}
_SPACE = " \t\n\x0b\x0c\r"
#: Rows and characters of a block.
BLOCK_ROWS, BLOCK_CHARS = 1_000, 1 << 20

#: For each state the cost, less the layer's least, and the rank; None where no edits lead there.
Layer = tuple[tuple[int, int] | None, ...]


def _macros(state: int, initial: str, truncated: bool) -> Iterator[tuple[str, int, int]]:
    """(code, cost, next state) of all macro edits of one turn."""
    yield "D", DELETE, state
    for run in range(3):
        cost = INSERT * run + TRUNCATED * truncated
        if initial == "s" and state == START:
            yield "I" * run + "K", cost, SYSTEM
        if initial == _ROLE[_NEXT[state]][0]:
            yield "I" * run + "K", cost, _NEXT[state]
        yield "I" * run + "R", cost + REROLE, _NEXT[state]
        state = _NEXT[state]


@cache
def _step(layer: Layer, initial: str, truncated: bool) -> tuple[int, Layer, tuple]:
    """What all costs rise by, the next layer, and each of its states' (parent, code). There are few layers, as costs differ by little."""
    best: dict[int, tuple] = {}
    for state, known in enumerate(layer):
        if known:
            for code, cost, to in _macros(state, initial, truncated):
                offer = (known[0] + cost, known[1], code, state)
                best[to] = min(best.get(to, offer), offer)
    least = min(o[0] for o in best.values())
    order = sorted(best, key=lambda s: best[s][1:3])
    ranks = {s: r for r, s in enumerate(order)}
    after = tuple((best[s][0] - least, ranks[s]) if s in best else None for s in range(4))
    return least, after, tuple((best[s][3], best[s][2]) if s in best else None for s in range(4))


def _entered(state: int) -> Layer:
    return tuple((0, 0) if s == state else None for s in range(4))


def summary(turns: list[tuple[str, bool]]) -> tuple[list[int | None], list[int | None]]:
    """Costs and ranks from each state to each state (16 of both) over (initial, truncated) turns that may stay."""
    costs, ranks = [], []
    for state in range(4):
        layer, spent = _entered(state), 0
        for turn in turns:
            more, layer, _ = _step(layer, *turn)
            spent += more
        costs += [spent + known[0] if known else None for known in layer]
        ranks += [known[1] if known else None for known in layer]
    return costs, ranks


def codes(turns: list[tuple[str, bool]], first: int, last: int) -> list[str]:
    """The macro edits that lead from the first state to the last, by following the parents back."""
    layer, parents = _entered(first), []
    for turn in turns:
        _, layer, back = _step(layer, *turn)
        parents.append(back)
    out = []
    for back in reversed(parents):
        last, code = back[last]
        out.append(code)
    return out[::-1]


def joined(blocks: list[tuple[list, list]]) -> tuple[list[int], int, str]:
    """The states between blocks (one more than blocks), the least cost, and the inserts at the end."""
    layer: list[tuple[int, int] | None] = list(_entered(START))
    parents = []
    for costs, ranks in blocks:
        best: dict[int, tuple] = {}
        for state, known in enumerate(layer):
            for to in range(4):
                if known and costs[4 * state + to] is not None:
                    offer = (known[0] + costs[4 * state + to], known[1], ranks[4 * state + to], state)
                    best[to] = min(best.get(to, offer), offer)
        order = sorted(best, key=lambda s: best[s][1:3])
        layer = [(best[s][0], order.index(s)) if s in best else None for s in range(4)]
        parents.append({s: o[3] for s, o in best.items()})
    tails = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    cost, _, state = min((known[0] + INSERT * len(tails[s]), known[1], s) for s, known in enumerate(layer) if known)
    path, tail = [state], tails[state]
    for back in reversed(parents):
        path.append(back[path[-1]])
    return path[::-1], cost, tail


def _fault(text: str, first: bool) -> str:
    body = text.rstrip(_SPACE)
    return "blank" if not body else "duplicate" if not first else "" if body[-1] in ".!?" else "truncated"


_BLOCK = "part long, seq long, rows long, blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, opens string, closes string, costs array<long>, ranks array<long>, role array<string>, text array<string>, copies array<long>, fault array<string>"


def _block(part: int, seq: int, rows: list[tuple]) -> dict:
    """One row for some rows (conversation, turn, role, text, copies, first) of a conversation."""
    faults = [_fault(r[3], r[5]) for r in rows]
    seen = {"blank": 0, "duplicate": 0, "truncated": 0}
    illegal, before, free = 0, None, []
    for (_, _, role, _, copies, _), fault in zip(rows, faults, strict=True):
        # Of equal rows all but the first are duplicates, unless they are blank.
        seen["duplicate"] += copies - 1 if fault != "blank" else 0
        seen["duplicate" if fault == "duplicate" else fault or "truncated"] += copies if fault == "blank" else bool(fault)
        illegal += copies - 1 + (before is not None and before + role[:1] not in _LEGAL)
        before = role[:1]
        if fault in ("", "truncated"):
            free.append((role[:1], fault == "truncated"))
    turns = [r[1] for r in rows if r[1] is not None]
    costs, ranks = summary(free)
    return {
        "part": part, "seq": seq, "rows": sum(r[4] for r in rows), **seen, "illegal": illegal,
        "turns": len(set(turns)), "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
        "opens": rows[0][2][:1], "closes": rows[-1][2][:1], "costs": costs, "ranks": ranks,
        "role": [r[2] for r in rows], "text": [r[3] for r in rows], "copies": [r[4] for r in rows], "fault": faults,
    }


def _blocks(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, rows, chars, out, held = TaskContext.get().partitionId(), 0, [], 0, [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (row[0] != rows[0][0] or len(rows) >= BLOCK_ROWS or chars >= BLOCK_CHARS):
                    out.append({"conv": rows[0][0], **_block(part, seq, rows)})
                    seq, rows, held, chars = seq + 1, [], held + chars, 0
                    if len(out) >= BLOCK_ROWS or held >= BLOCK_CHARS:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, held = [], 0
                rows.append(row)
                chars += len(row[3])
        if rows:
            out.append({"conv": rows[0][0], **_block(part, seq, rows)})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


_CHOICE = "part long, seq long, first int, last int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


_CHOICE_SCHEMA = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[c.split()[1]]) for c in _CHOICE.split(", ")])


def _chosen(rows: list[dict]) -> Iterator[dict]:
    """For each block of a conversation its first and last state; at the last block the inserts behind it and the conversation's totals."""
    path, cost, tail = joined([(r["costs"], r["ranks"]) for r in rows])
    held = [r for r in rows if r["low"] is not None]
    shared = sum(a["high"] == b["low"] for a, b in zip(held, held[1:], strict=False))
    gaps = held[-1]["high"] - held[0]["low"] + 1 - sum(r["turns"] for r in held) + shared if held else 0
    sums = {c: sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")}
    sums["illegal"] += sum(a["closes"] + b["opens"] not in _LEGAL for a, b in zip(rows, rows[1:], strict=False))
    # What must go is in no layer.
    cost += DELETE * (sums["blank"] + sums["duplicate"])
    for k, r in enumerate(rows):
        yield {"part": r["part"], "seq": r["seq"], "first": path[k], "last": path[k + 1], **({"tail": tail, "gaps": gaps, **sums, "cost": cost} if k == len(rows) - 1 else {})}


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks' choices; a conversation's blocks come one after the other."""
    rows: list[dict] = []
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if rows and row["conv"] != rows[0]["conv"]:
                out += _chosen(rows)
                rows = []
            rows.append(row)
        yield pa.RecordBatch.from_pylist(out, schema=_CHOICE_SCHEMA)
    if rows:
        yield pa.RecordBatch.from_pylist(list(_chosen(rows)), schema=_CHOICE_SCHEMA)


def _edited(block: dict) -> tuple[str, list[tuple[str, str]]]:
    """The edits of a block's rows and the (role, text) rows that they leave."""
    free = [(r[:1], f == "truncated") for r, f in zip(block["role"], block["fault"], strict=True) if f in ("", "truncated")]
    chosen = iter(codes(free, block["first"], block["last"]))
    audit, out, state = [], [], block["first"]
    for role, text, copies, fault in zip(block["role"], block["text"], block["copies"], block["fault"], strict=True):
        code = next(chosen) if fault in ("", "truncated") else "D"
        audit.append(code + "D" * (copies - 1))
        for letter in code:
            if letter == "K" and role[:1] == "s":
                state = SYSTEM
                out.append((role, text))
            elif letter != "D":
                state = _NEXT[state]
                out.append((role if letter == "K" else _ROLE[state], "" if letter == "I" else text))
    for _ in block["tail"] or "":
        audit.append("I")
        state = _NEXT[state]
        out.append((_ROLE[state], ""))
    return "".join(audit), out


def plan(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """A row for each block of a conversation: its rows, faults, and the states its edits lead from and to.

    ``turns`` has conv, turn, role and text, and may have ``copies``.
    """
    small_batches(turns.sparkSession)
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    cell = lambda c: F.coalesce(F.col(c), F.lit(" "))
    rows = turns.select("conv", F.col("turn").cast("long").alias("turn"), cell("role").alias("role"), cell("text").alias("text"), copies.cast("long").alias("copies"))
    rows = scratch.keep(rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")), "rows")
    # Where role and text are first seen; a join and no window, so that a text that one conversation has very often is split.
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = rows.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t")).agg(F.min(order).alias("earliest"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    rows = rows.join(firsts, same).select("conv", "turn", "role", "text", "copies", order.eqNullSafe(F.col("earliest")).alias("first"))
    keys = ("conv", "turn", "role", "text")
    spread = scratch.keep(rows, "faults").repartitionByRange(*keys).sortWithinPartitions(*keys)
    kind = turns.schema["conv"].dataType.simpleString()
    empty = turns.sparkSession.createDataFrame([], f"conv {kind}, {_BLOCK}")
    blocks = scratch.keep(spread.mapInArrow(_blocks(empty.toArrow().schema), empty.schema), "blocks")
    scratch.drop_others("blocks")
    sums = ["part", "seq", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "opens", "closes", "costs", "ranks"]
    # A few numbers for each block; a conversation's go to one task.
    chosen = blocks.select("conv", *sums).repartition("conv").sortWithinPartitions("conv", "part", "seq").mapInArrow(_choices, _CHOICE)
    return blocks.select("conv", "part", "seq", "role", "text", "copies", "fault").join(chosen, ["part", "seq"])


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv, part, seq, at, role, text): the rows that the edits leave, in the order of these numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                rows = _edited(block)[1]
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["conv"]] * n, batch.schema.field("conv").type), pa.array([block["part"]] * n, pa.int64()), pa.array([block["seq"]] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())],
                    names=["conv", "part", "seq", "at", "role", "text"],
                )

    planned = plan(turns, Scratch(turns.sparkSession, "repair"))
    return planned.mapInArrow(run, f"conv {turns.schema['conv'].dataType.simpleString()}, part long, seq long, at long, role string, text string")


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    kind = turns.schema["conv"].dataType.simpleString()
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, lines = [], hashlib.sha256(), 0
        for batch in batches:
            out = []
            for block in batch.to_pylist():
                edits, rows = _edited(block)
                audit.append(edits)
                for role, text in rows:
                    digest.update((f"\n{role}:{text}" if lines else f"{role}:{text}").encode())
                    lines += 1
                if block["tail"] is not None:  # a conversation's last block
                    out.append((block["conv"], *(block[c] for c in totals), "".join(audit), digest.hexdigest()))
                    audit, digest, lines = [], hashlib.sha256(), 0
            kinds = [batch.schema.field("conv").type, *[pa.int64()] * len(totals), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["conv", *totals, "audit", "repaired_sha256"])

    planned = plan(turns, Scratch(turns.sparkSession, "repair"))
    # A conversation's blocks come one after the other; the task holds one of them and the edits so far.
    ordered = planned.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    return ordered.mapInArrow(run, f"conv {kind}, {', '.join(f'{c} long' for c in totals)}, audit string, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, copies: rows that a checksum of their key has dropped, emptied, cut, doubled or given another role."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat_ws(":", text_of("conv_id"), text_of("turn")), "UTF-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, "user").otherwise(text_of("role"))
    return conversations.where(kind != 0).select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = audits(damaged(conversations))
    every = conversations.select("conv_id").distinct()
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        *(none(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


OP13_SQL = r"""
WITH RECURSIVE table8 AS (SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY x) AS t FROM (SELECT unnest(range(256)) AS x)),
keyed AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
summed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda c: CAST(ord(c) AS BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS d FROM keyed, table8),
spoilt AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM summed WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM spoilt),
faults AS (SELECT *, left(role, 1) AS c, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS f FROM placed),
pairs AS (SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS step FROM faults),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated,
  count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM pairs GROUP BY conv_id),
moves(q, code, cost, needs, q2) AS (VALUES (0,'D',3,'',0),(1,'D',3,'',1),(2,'D',3,'',2),(3,'D',3,'',3),
  (0,'K',0,'s',1),(0,'K',0,'u',2),(1,'K',0,'u',2),(2,'K',0,'a',3),(3,'K',0,'u',2),(0,'IK',2,'a',3),(1,'IK',2,'a',3),(2,'IK',2,'u',2),(3,'IK',2,'a',3),
  (0,'R',2,'',2),(1,'R',2,'',2),(2,'R',2,'',3),(3,'R',2,'',2),(0,'IR',4,'',3),(1,'IR',4,'',3),(2,'IR',4,'',2),(3,'IR',4,'',3)),
written(q, x, role) AS (VALUES (0,0,'user'),(1,0,'user'),(2,0,'assistant'),(3,0,'user'),(0,1,'assistant'),(1,1,'assistant'),(2,1,'user'),(3,1,'assistant')),
r(conv_id, i, q, cost, audit, made) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM faults
  UNION ALL
  SELECT conv_id, i, q2, (best).cost, (best).audit, (best).made FROM (
    SELECT r.conv_id, f.i, m.q2, min({'cost': r.cost + m.cost + CASE WHEN f.f = 'truncated' AND m.code <> 'D' THEN 1 ELSE 0 END, 'audit': r.audit || m.code,
      'made': r.made || CASE m.code WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [f.role || ':' || f.text] WHEN 'IK' THEN [w0.role || ':', f.role || ':' || f.text] WHEN 'R' THEN [w0.role || ':' || f.text] ELSE [w0.role || ':', w1.role || ':' || f.text] END}) AS best
    FROM r JOIN faults f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1 JOIN moves m ON m.q = r.q AND (m.code = 'D' OR f.f NOT IN ('blank', 'duplicate')) AND (m.needs = '' OR m.needs = f.c)
    JOIN written w0 ON w0.q = r.q AND w0.x = 0 JOIN written w1 ON w1.q = r.q AND w1.x = 1 GROUP BY r.conv_id, f.i, m.q2)),
ended AS (SELECT r.conv_id, s.gaps, s.blank, s.duplicate, s.truncated, s.illegal, min({'cost': r.cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'audit': audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'made': made || CASE q WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END}) AS best
  FROM r JOIN sums s ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.n = r.i GROUP BY ALL)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce((best).cost, 0) AS BIGINT) AS cost, coalesce((best).audit, '') AS audit, sha256(coalesce(array_to_string((best).made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""
