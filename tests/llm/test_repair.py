"""Repair of conversations: against a programme that holds the strings, and against SQL."""

import hashlib
import random
from collections import Counter
from zlib import crc32

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forelight.llm import registry, repair

SPACE = " \t\n\x0b\x0c\r"
NAMES = ("user", "assistant")


def by_hand(rows):
    """What the query returns, for (conv, turn, role, text) rows."""
    kept = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        spell = lambda v: " " if v is None else str(v)
        kind = crc32(f"{spell(conv)}:{spell(turn)}".encode()) % 20
        role, text = spell(role), spell(text)
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        kept[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, found in kept.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in found if t is not None}
        seen, faults = set(), []
        for _, role, text in found:
            body = text.strip(SPACE)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:], strict=False))
        cost, audit, text = finished([(r, t, f) for (_, r, t), f in zip(found, faults, strict=True)])
        n = Counter(faults)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return out


def finished(rows):
    """The cheapest edits that end after an assistant's turn or leave nothing."""
    best = {0: (0, "", ())}  # 0 nothing yet, 1 after a system turn, 2 user, 3 assistant
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def with_inserts(states):
        states = dict(states)
        for _ in range(3):
            for q, (cost, audit, out) in list(states.items()):
                for name in NAMES:
                    if name[0] in follow[q]:
                        offer = (cost + 2, audit + "I", (*out, f"{name}:"))
                        states[follow[q][name[0]]] = min(states.get(follow[q][name[0]], offer), offer)
        return states

    def every(states):
        """Also what costs more than the best of its state, as it may be the least string later: all runs of at most two inserts."""
        out = [(q, o) for q, o in states.items()]
        layer = out
        for _ in range(2):
            layer = [(follow[q][n[0]], (c + 2, a + "I", (*o, f"{n}:"))) for q, (c, a, o) in layer for n in NAMES if n[0] in follow[q]]
            out = out + layer
        return out

    for role, text, fault in rows:
        grown = {}
        for q, (cost, audit, out) in every(best):
            offers = [(q, (cost + 3, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                add = fault == "truncated"
                if role[:1] in follow[q]:
                    offers.append((follow[q][role[:1]], (cost + add, audit + "K", (*out, f"{role}:{text}"))))
                offers += [(follow[q][n[0]], (cost + 2 + add, audit + "R", (*out, f"{n}:{text}"))) for n in NAMES if n[0] in follow[q]]
            for to, offer in offers:
                grown[to] = min(grown.get(to, offer), offer)
        best = grown
    ends = with_inserts(best)
    return min(o for q, o in ends.items() if q in (0, 3))


ROLES = ["system", "user", "assistant", "tool", "", "User", None, "sister"]


def conversations(seed, n, roles=ROLES):
    r = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", "yes.", None, "Ends well! ", "é.\n", "…", "Yes."]
    rows = []
    for conv in [*range(n), None]:
        turns = [*range(r.randint(0, 9))] + r.choice([[], [None], [2, 2], [40], [None, None, 3]])
        rows += [(conv, t, r.choice(roles), r.choice(texts)) for t in turns]
    r.shuffle(rows)
    return rows


def written(spark, base, rows):
    data = spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], "conv_id long, turn long, role string, text string, conv int, copies int, part int, first string")
    data.repartition(3).write.parquet(f"{base}/conversations.parquet")
    return str(base)


def test_against_whole_strings(spark, tmp_path):
    rows = conversations(1, 120)
    base = written(spark, tmp_path, rows)
    assert Counter(map(tuple, registry.QUERIES["op13_repair"](spark, base).collect())) == Counter(by_hand(rows))


def test_blocks_make_no_difference(spark, tmp_path, monkeypatch):
    r = random.Random(3)
    rows = [(1, r.choice([t, t, None, 5]), r.choice(["user", "assistant", "system"]), f"text {r.randint(0, 150)}" + r.choice(["", ".", "?"])) for t in range(400)] + conversations(4, 20)
    base = written(spark, tmp_path, rows)
    monkeypatch.setattr(repair, "BLOCK_ROWS", 7)
    assert Counter(map(tuple, registry.QUERIES["op13_repair"](spark, base).collect())) == Counter(by_hand(rows))


def test_the_sql_twin(spark, tmp_path):
    base = written(spark, tmp_path, conversations(5, 80))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{base}/conversations.parquet/*.parquet'")
    out = registry.QUERIES["op13_repair"](spark, base)
    want = con.execute(registry.ORACLES["op13_repair"])
    assert out.columns == [d[0] for d in want.description]
    assert Counter(map(tuple, out.collect())) == Counter(want.fetchall())


def test_empty(spark, tmp_path):
    assert registry.QUERIES["op13_repair"](spark, written(spark, tmp_path, [])).count() == 0


def test_repaired_turns_are_in_order(spark):
    rows = [(1, t, role, f"{role} {t}.") for t, role in enumerate(["assistant", "user", "user", "assistant", "system"])]
    out = repair.repaired_turns(spark.createDataFrame(rows, "conv long, turn int, role string, text string")).orderBy("conv", "part", "seq", "at").collect()
    roles = [r.role for r in out]
    assert roles == ["user", "assistant"] * (len(roles) // 2) and [r.text for r in out if r.text]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x", ""]), st.booleans()), max_size=9), st.lists(st.integers(0, 9), max_size=3))
def test_ranks_stand_for_strings(turns, cuts):
    rows = [(role, "t", "truncated" if cut else "") for role, cut in turns]
    free = [(role[:1], cut) for role, cut in turns]
    cuts = [0, *sorted(min(c, len(free)) for c in cuts), len(free)]
    parts = [free[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
    path, cost, tail = repair.joined([repair.summary(p) for p in parts])
    audit = "".join("".join(repair.codes(p, path[k], path[k + 1])) for k, p in enumerate(parts)) + tail
    assert (cost, audit) == finished(rows)[:2]


@pytest.mark.parametrize("turns", [[], [("s", False)], [("a", True)], [("u", False), ("a", False)]])
def test_no_code_is_a_prefix(turns):
    codes = {c for q in range(4) for i in "sua" for c, _, _ in repair._macros(q, i, False)}
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
