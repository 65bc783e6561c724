"""Linkage trees of an ensemble's members as tables: merges, leaves, cophenetic distances.

Average and Ward linkage by chains of nearest neighbours: a chain goes from a
cluster to its nearest one until two are each other's nearest, which are merged;
the rest of the chain stays valid, so all merges take a time that grows with the
square of the members. An ensemble has some tens of members and is one group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

METHODS = ("average", "ward")


def linkage(d: np.ndarray, method: str = "average") -> np.ndarray:
    """(left, right, height, size) of each merge, by height; members are 0 to n - 1, and the k-th merge makes cluster n + k.

    ``d`` holds distances, for Ward of points. Of equals the cluster with the
    first member goes first; left is the smaller number.
    """
    n = len(d)
    # Ward's recurrence is one of squared distances.
    gap = np.array(d, float) ** (2 if method == "ward" else 1)
    np.fill_diagonal(gap, np.inf)
    size, alive, reached = np.ones(n), np.ones(n, bool), np.zeros(n)
    chain: list[int] = []
    merges: list[tuple[float, int, int]] = []
    while len(merges) < n - 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        row = np.where(alive, gap[chain[-1]], np.inf)
        near = int(row.argmin())
        if len(chain) > 1 and row[chain[-2]] <= row[near]:
            b, a = sorted((chain.pop(), chain.pop()), reverse=True)
            # Not below the merges it is made of, whatever the last digit says.
            reached[a] = max(gap[a, b], reached[a], reached[b])
            merges.append((float(reached[a]), a, b))
            na, nb = size[a], size[b]
            if method == "ward":
                new = ((na + size) * gap[a] + (nb + size) * gap[b] - size * gap[a, b]) / (na + nb + size)
            else:
                new = (na * gap[a] + nb * gap[b]) / (na + nb)
            # The merged cluster goes on under its first member's number.
            gap[a], gap[:, a], gap[a, a] = new, new, np.inf
            alive[b], size[a] = False, na + nb
        else:
            chain.append(near)
    out, root, count = np.zeros((max(n - 1, 0), 4)), list(range(n)), {i: 1 for i in range(n)}
    # A chain finds merges out of order; a cluster's name is that of its last merge.
    for k, (height, a, b) in enumerate(sorted(merges, key=lambda m: m[0])):
        left, right = sorted((root[a], root[b]))
        count[n + k] = count[left] + count[right]
        out[k] = left, right, height ** (0.5 if method == "ward" else 1), count[n + k]
        root[a] = n + k
    return out


def members(merges: np.ndarray, cluster: int) -> list[int]:
    """The members of a cluster, left ones first."""
    n, out, open_ = len(merges) + 1, [], [cluster]
    while open_:
        c = open_.pop()
        if c < n:
            out.append(c)
        else:
            open_ += [int(merges[c - n, 1]), int(merges[c - n, 0])]
    return out


def leaves(merges: np.ndarray) -> list[int]:
    """All members in the order in which a drawn tree has them."""
    return members(merges, 2 * len(merges)) if len(merges) else [0]


def cut(merges: np.ndarray, k: int) -> np.ndarray:
    """Labels of k clusters, from 1 in order of first members."""
    n = len(merges) + 1
    undone = merges[max(n - max(k, 1), 0) :]
    tops = set(undone[:, :2].astype(int).ravel()) if len(undone) else {2 * len(merges)}
    # What an undone merge joined stays, unless another undone merge made it.
    tops -= set(range(2 * n - 1 - len(undone), 2 * n - 1)) if len(undone) else set()
    labels = np.zeros(n, int)
    for label, group in enumerate(sorted((members(merges, c) for c in tops), key=min), 1):
        labels[group] = label
    return labels


def cophenetic(merges: np.ndarray) -> np.ndarray:
    """For each pair of members the height at which they meet."""
    n = len(merges) + 1
    out = np.zeros((n, n))
    for left, right, height, _ in merges:
        a, b = members(merges, int(left)), members(merges, int(right))
        out[np.ix_(a, b)] = out[np.ix_(b, a)] = height
    return out


def _correlation(x: np.ndarray, y: np.ndarray) -> float | None:
    """How well the tree keeps the distances; nothing is said of fewer than two different ones."""
    pairs = np.triu_indices(len(x), 1)
    a, b = x[pairs], y[pairs]
    return float(np.corrcoef(a, b)[0, 1]) if len(a) > 1 and a.std() > 0 and b.std() > 0 else None


def _each(vectors: DataFrame, group: list[str], method: str, standardise: bool, make, columns: str) -> DataFrame:
    """``make(names, distances, merges)`` of each group's members in order."""
    if method not in METHODS:
        raise ValueError(method)
    kinds = ", ".join(f"`{g}` {vectors.schema[g].dataType.simpleString()}" for g in group)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("member")
        x = np.stack(pdf["x"].map(np.asarray)).astype(float)
        if standardise:
            x = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
        out = make(pdf["member"].tolist(), d, linkage(d, method))
        for g in group:
            out[g] = pdf[g].iloc[0]
        return out[[*group, *(c for c in out.columns if c not in group)]]

    kind = vectors.schema["member"].dataType.simpleString()
    return vectors.select(*group, "member", "x").groupBy(*group).applyInPandas(run, f"{kinds}, {columns.format(member=kind)}")


def merge_table(vectors: DataFrame, group: list[str], method: str = "ward", standardise: bool = True) -> DataFrame:
    """(group, step, left, right, height, size): each group's merges by height.

    ``vectors``: group, member, x without missing values. A cluster's number is
    the place of its member in order, or the number of members and the step that made it.
    """

    def make(names, d, merges):
        return pd.DataFrame({"step": range(len(merges)), "left": merges[:, 0].astype(int), "right": merges[:, 1].astype(int), "height": merges[:, 2], "size": merges[:, 3].astype(int)})

    return _each(vectors, group, method, standardise, make, "step int, left int, right int, height double, size int")


def leaf_order(vectors: DataFrame, group: list[str], method: str = "ward", standardise: bool = True) -> DataFrame:
    """(group, member, position, joined, correlation): where a drawn tree has each member, the height at which it is joined first, and how well the tree keeps distances."""

    def make(names, d, merges):
        order, meets = leaves(merges), cophenetic(merges)
        first = [float(np.delete(meets[i], i).min()) if len(meets) > 1 else None for i in order]
        return pd.DataFrame({"member": [names[i] for i in order], "position": range(len(order)), "joined": first, "correlation": [_correlation(d, meets)] * len(order)}).astype({"joined": float, "correlation": float})

    return _each(vectors, group, method, standardise, make, "member {member}, position int, joined double, correlation double")
