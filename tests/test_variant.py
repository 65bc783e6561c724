"""Documents of any layout, and quantiles by selection."""

import json
import math
import random

import numpy as np
import pytest

from forelight.functions import quantile, variant

TEXTS = [
    '[{"name": "a", "low": 1, "high": "2.5"}, 3, null, {"low": null, "note": "x"}]',
    '{"biases": [{"name": "b"}, [], {"low": true}], "v": 2}',
    '{"biases": {"name": "no list"}}',
    '{"entries": [{"name": "other"}]}',
    '"text"',
    "17",
    "[]",
    "{}",
    "broken [",
    "",
    None,
    '[{"name": {"deep": 1}, "low": "1e2"}]',
]


def by_hand(text):
    """The entries of one document: those of a list, or of an object's list, that are objects."""
    try:
        data = json.loads(text or "")
    except ValueError:
        return []
    data = data.get("biases", []) if isinstance(data, dict) else data
    return [(i, e) for i, e in enumerate(data) if isinstance(e, dict)] if isinstance(data, list) else []


def test_both_layouts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {}
    for r in variant.elements(df, ["id"], "text", "biases").selectExpr("id", "pos", "to_json(entry) AS e").collect():
        got.setdefault(r.id, []).append((r.pos, json.loads(r.e)))
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in got.items()} == {i: e for i, t in enumerate(TEXTS) if (e := by_hand(t))}
    out = {(r.id, r.pos): (r.name, r.low, r.high, r.note) for r in variant.bias_entries(df, ["id"], "text").collect()}
    assert out[0, 0] == ("a", 1.0, 2.5, None) and out[0, 3] == (None, None, None, "x") and out[11, 0][1] == 100.0


def test_layouts_are_told(spark):
    df = spark.createDataFrame([("a", '{"x": 1}'), ("a", '{"y": "t"}'), ("b", "[1]"), ("b", "no"), ("b", None)], "k string, text string")
    out = {r.k: (r.layout, r.n, r.unreadable) for r in variant.layouts(df, ["k"], "text").collect()}
    assert out == {"a": ("OBJECT<x: BIGINT, y: STRING>", 2, 0), "b": ("ARRAY<BIGINT>", 1, 1)}


def test_metrics_that_gate_notes(spark):
    docs = [
        {"clusters": [{"id": 0, "fraction": 0.25}, {"id": 4, "kind": "null", "fraction": 0.25}, {"id": 1, "fraction": 0.5, "risk_profile": {"weighted_high": 0.7}}]},
        {"clusters": [{"id": 1, "risk_profile": 3}, "x", {"fraction": None, "kind": "scenario"}, {"id": 2, "fraction": 1, "risk_profile": {"weighted_high": -1}}]},
        {"clusters": {}},
        [],
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)] + [(9, None)], "id int, text string")
    out = {r.id: tuple(r)[1:] for r in variant.cluster_metrics(df, ["id"], "text").collect()}
    assert out == {0: (0.5, 0.5, 0.7), 1: (0.0, 1.0, 0.0), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 0.0), 9: (0.0, 0.0, 0.0)}


@pytest.mark.parametrize("parts", [1, 512])
def test_selection_of_several_quantiles(spark, parts):
    r = random.Random(6)
    kinds = [lambda: 0.0, lambda: -0.0, lambda: r.choice([0.0, 0.0, 0.0, 5.0, -5.0]), lambda: r.gauss(280, 5), lambda: r.lognormvariate(0, 9) * r.choice([1, -1]), lambda: None, lambda: math.nan, lambda: 5e-324 * r.randint(0, 3), lambda: r.choice([1e308, -1e308])]
    rows = [(g, k, make(), r.choice([make(), None])) for g, make in enumerate(kinds) for k in range(40)] + [(None, 1, 3.0, 4.0), (100, 1, 7.0, None)]
    wanted = {"low": ("a", 0.0), "mid": ("a", 0.5), "q": ("a", 0.75), "top": ("a", 1.0), "b": ("b", 0.9)}
    out = quantile.selected(spark.createDataFrame(rows, "g int, k int, a double, b double"), ["g"], wanted, parts).collect()
    got = {(x.g, x.name): (x.value, x.n) for x in out}
    assert len(got) == len(out) == 5 * len({x[0] for x in rows})
    for g in {x[0] for x in rows}:
        for name, (c, q) in wanted.items():
            v = [x for x in (row["kab".index(c) + 1] for row in rows if row[0] == g) if x is not None and not math.isnan(x)]
            assert got[g, name][1] == len(v)
            if v:
                h = min(max(len(v) * q - 0.5, 0), len(v) - 1)
                s, lo = sorted(v), int(h)
                assert got[g, name][0] == pytest.approx(s[lo] + (h - lo) * (s[min(lo + 1, len(s) - 1)] - s[lo]), rel=1e-12, abs=0), (g, name)
                if name in ("mid", "q") and max(map(abs, v)) < 1e300:
                    assert got[g, name][0] == pytest.approx(np.quantile(v, q, method="hazen"), rel=1e-12)
            else:
                assert got[g, name][0] is None
