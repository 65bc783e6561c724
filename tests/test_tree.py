"""Linkage trees: against the closest pair of all clusters, found anew before each merge."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forelight.operators import cluster, tree


def by_hand(x, method):
    """(the two sets of members, height) of each merge of points."""
    groups, out = [(i,) for i in range(len(x))], []
    while len(groups) > 1:
        best = None
        for i, a in enumerate(groups):
            for b in groups[i + 1 :]:
                if method == "ward":
                    gap = x[list(a)].mean(axis=0) - x[list(b)].mean(axis=0)
                    h = float(np.sqrt(2 * len(a) * len(b) / (len(a) + len(b)) * gap @ gap))
                else:
                    h = float(np.mean([np.linalg.norm(x[p] - x[q]) for p in a for q in b]))
                if best is None or h < best[0] - 1e-12:
                    best = h, a, b
        h, a, b = best
        groups = [g for g in groups if g not in (a, b)] + [tuple(sorted(a + b))]
        out.append(({a, b}, h))
    return out


def distances(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))


@pytest.mark.parametrize("method", tree.METHODS)
@pytest.mark.parametrize("n", [1, 2, 3, 8, 31])
def test_merges(method, n):
    x = np.random.default_rng(n).normal(size=(n, 4))
    got = tree.linkage(distances(x), method)
    want = by_hand(x, method)
    assert len(got) == n - 1
    for (left, right, height, size), (sets, h) in zip(got, want, strict=True):
        assert {tuple(sorted(tree.members(got, int(c)))) for c in (left, right)} == sets
        assert height == pytest.approx(h) and size == sum(map(len, sets)) and left < right


@pytest.mark.parametrize("method", tree.METHODS)
def test_cuts_and_meetings(method):
    x = np.random.default_rng(5).normal(size=(12, 3))
    merges, want = tree.linkage(distances(x), method), by_hand(x, method)
    groups = [{(i,) for i in range(12)}]
    for sets, _ in want:
        groups.append(groups[-1] - sets | {tuple(sorted(sum(sets, ())))})
    for k in range(1, 13):
        labels = tree.cut(merges, k)
        assert {tuple(np.flatnonzero(labels == c)) for c in set(labels)} == groups[12 - k]
        assert [labels[i] for i in sorted({int(np.flatnonzero(labels == c)[0]) for c in set(labels)})] == list(range(1, k + 1))
    meets = tree.cophenetic(merges)
    for sets, h in want:
        a, b = sets
        assert np.allclose(meets[np.ix_(a, b)], h)
    assert (meets == meets.T).all() and not meets.diagonal().any()


def test_a_drawn_tree_does_not_cross():
    merges = tree.linkage(distances(np.random.default_rng(2).normal(size=(20, 2))), "ward")
    order = tree.leaves(merges)
    assert sorted(order) == list(range(20))
    for c in range(20, 39):
        places = sorted(order.index(m) for m in tree.members(merges, c))
        assert places == list(range(places[0], places[0] + len(places)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=14), st.sampled_from(tree.METHODS))
def test_ties(points, method):
    """Equal points and equal gaps: heights rise, sizes add up, every cut has its number of clusters."""
    merges = tree.linkage(distances(np.array(points, float)), method)
    assert (np.diff(merges[:, 2]) >= 0).all() if len(merges) else True
    for k, (left, right, _, size) in enumerate(merges):
        assert left < right < len(points) + k and size == len(tree.members(merges, len(points) + k))
    for k in range(1, len(points) + 1):
        assert len(set(tree.cut(merges, k))) == k


def test_old_names_give_the_cuts():
    x = np.random.default_rng(8).normal(size=(15, 3))
    d = distances(x)
    for k in (1, 2, 5, 15, 20):
        assert (cluster.upgma(d, k) == tree.cut(tree.linkage(d, "average"), k)).all()
        assert (cluster.ward(x, k) == tree.cut(tree.linkage(d, "ward"), k)).all()


def test_tables(spark):
    r = np.random.default_rng(4)
    x = {g: r.normal(size=(n, 3)) for g, n in (("a", 7), ("b", 1), ("c", 2))}
    df = spark.createDataFrame([(g, m, [float(v) for v in x[g][m]]) for g in x for m in range(len(x[g]))], "init string, member int, x array<double>")
    merges = tree.merge_table(df, ["init"], "average", standardise=False).orderBy("init", "step").collect()
    assert [(r.init, r.step) for r in merges] == [("a", k) for k in range(6)] + [("c", 0)]
    want = tree.linkage(distances(x["a"]), "average")
    assert np.allclose([(m.left, m.right, m.height, m.size) for m in merges[:6]], want)
    out = tree.leaf_order(df, ["init"], "average", standardise=False).orderBy("init", "position").collect()
    assert [r.member for r in out if r.init == "a"] == tree.leaves(want)
    meets, d = tree.cophenetic(want), distances(x["a"])
    pairs = np.triu_indices(7, 1)
    assert out[0].correlation == pytest.approx(np.corrcoef(meets[pairs], d[pairs])[0, 1])
    assert all(r.joined == pytest.approx(np.delete(meets[r.member], r.member).min()) for r in out if r.init == "a")
    assert [(r.member, r.position, r.correlation) for r in out if r.init == "b"] == [(0, 0, None)]
    with pytest.raises(ValueError):
        tree.merge_table(df, ["init"], "single")
