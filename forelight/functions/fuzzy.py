"""Rule-based fuzzy inference: memberships and rules as column expressions, the area of the output in NumPy over Arrow batches.

The cumulative area has no built-in function: as an array expression it would
copy or revisit the 241 points of the output universe for each of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


def rise(x: Column, low: float, high: float) -> Column:
    """0 up to low, 1 from high on, linear between; null stays null."""
    if high <= low:
        raise ValueError("the right point must be greater than the left one")
    return F.when(x.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (high - low))))


def fall(x: Column, low: float, high: float) -> Column:
    return 1 - rise(x, low, high)


def trapezoid(x: Column, a: float, b: float, c: float, d: float, top: float = 1.0, bottom: float = 0.0) -> Column:
    """bottom outside a to d, top from b to c, linear between; null stays null."""
    shape = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - a) / (b - a), (d - x) / (d - c)))
    return F.when(x.isNotNull(), bottom + (top - bottom) * shape)


#: Fixed values of the frozen system: universes (first, last, step) and breakpoints.
UNIVERSES = {"snow": (0, 250, 2), "mslp": (950, 1070, 0.5), "wind": (0, 15, 0.25), "solar": (0, 800, 5), "ozone": (20, 140, 0.5)}
INPUTS = {
    "snow": {"negligible": (fall, 60, 90), "sufficient": (rise, 60, 90)},
    "wind": {"calm": (fall, 2, 4), "breezy": (rise, 2, 4)},
    "mslp": {"low": (fall, 1010, 1015), "moderate": (trapezoid, 1010, 1015, 1030, 1035), "high": (rise, 1025, 1035)},
    "solar": {"low": (fall, 200, 300), "moderate": (trapezoid, 200, 300, 500, 700), "high": (rise, 500, 700)},
}
OUTPUT = {"background": (20, 30, 40, 50), "moderate": (40, 50, 60, 70), "elevated": (50, 60, 75, 90), "extreme": (60, 75, 90, 125)}


@dataclass(frozen=True)
class Rule:
    """``then`` is as possible as all (or any) of the terms."""

    then: str
    terms: tuple[tuple[str, str], ...]
    any_of: bool = False

    def strength(self, memberships: dict[tuple[str, str], Column]) -> Column:
        found = [memberships[t] for t in self.terms]
        known = reduce(lambda a, b: a & b, (m.isNotNull() for m in found))
        return F.when(known, (F.greatest if self.any_of else F.least)(*found))


def _cold_pool(pressure: str, sun: str) -> tuple[tuple[str, str], ...]:
    return ("snow", "sufficient"), ("mslp", pressure), ("wind", "calm"), ("solar", sun)


RULES = (
    Rule("background", (("snow", "negligible"), ("mslp", "low"), ("wind", "breezy")), any_of=True),
    Rule("extreme", _cold_pool("high", "high")),
    Rule("elevated", _cold_pool("high", "moderate")),
    Rule("moderate", _cold_pool("high", "low")),
    Rule("elevated", _cold_pool("moderate", "high")),
    Rule("moderate", _cold_pool("moderate", "moderate")),
)


#: Rows whose output universes a worker holds at a time.
ROWS = 2048


def between_points(shares: np.ndarray, p: float, low: float, step: float) -> np.ndarray:
    """Where a share of the area is reached, by linear interpolation; whole numbers, halves to the even one."""
    i = (shares < p).sum(axis=1)
    row = np.arange(len(shares))
    before, after = shares[row, i - 1], shares[row, i]
    return np.rint(np.round(low + (i - 1) * step + (p - before) / (after - before) * step, 9))


def first_point(shares: np.ndarray, p: float, low: float, step: float) -> np.ndarray:
    return low + (np.round(shares, 9) < p).sum(axis=1) * step


@dataclass(frozen=True)
class System:
    """Universes, membership functions and rules; ``with_rule`` and ``with_term`` give extended copies."""

    universes: dict = field(default_factory=lambda: dict(UNIVERSES))
    inputs: dict = field(default_factory=lambda: dict(INPUTS))
    output: dict = field(default_factory=lambda: dict(OUTPUT))
    rules: tuple[Rule, ...] = RULES

    def with_rule(self, rule: Rule) -> System:
        return System(self.universes, self.inputs, self.output, (*self.rules, rule))

    def with_term(self, variable: str, name: str, shape: tuple) -> System:
        return System(self.universes, self.inputs | {variable: self.inputs.get(variable, {}) | {name: shape}}, self.output, self.rules)

    def membership(self, variable: str, name: str, x: Column | None = None) -> Column:
        """By linear interpolation on the universe, which ends where the universe does."""
        shape, *points = self.inputs[variable][name]
        low, high, _ = self.universes[variable]
        x = F.col(variable) if x is None else x
        return shape(F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high)))), *map(float, points))

    def guarded(self, df: DataFrame) -> DataFrame:
        """Inputs drawn into their universes, and ``<v>_clipped``: whether that changed them (true for missing ones)."""
        for v in self.inputs:
            low, high, _ = self.universes[v]
            df = df.withColumn(f"{v}_clipped", F.col(v).isNull() | (F.col(v) < low) | (F.col(v) > high))
            df = df.withColumn(v, F.when(F.col(v).isNotNull(), F.least(F.greatest(F.col(v), F.lit(float(low))), F.lit(float(high)))))
        return df

    def possibilities(self, df: DataFrame) -> DataFrame:
        """df with a possibility from 0 to 1 per output category; null where an input is missing."""
        terms = {(v, t): self.membership(v, t) for v, named in self.inputs.items() for t in named}
        strengths: dict[str, list[Column]] = {c: [] for c in self.output}
        for rule in self.rules:
            strengths[rule.then].append(rule.strength(terms))
        known = reduce(lambda a, b: a & b, (F.col(v).isNotNull() for v in self.inputs))
        return df.withColumns({c: F.when(known, F.greatest(*s) if len(s) > 1 else s[0]) if s else F.lit(0.0) for c, s in strengths.items()})

    def grid(self) -> list[float]:
        """The points of the output universe."""
        low, high, step = map(float, self.universes["ozone"])
        return [low + i * step for i in range(round((high - low) / step) + 1)]

    def aggregated(self, possibilities: np.ndarray) -> np.ndarray:
        """The output's membership on its universe: category shapes cut at their possibilities (rows by categories), the largest of them."""
        xs = np.array(self.grid())
        out = np.zeros((len(possibilities), len(xs)))
        for k, (a, b, c, d) in enumerate(self.output.values()):
            shape = np.clip(np.minimum((xs - a) / (b - a), (d - xs) / (d - c)), 0, 1)
            np.maximum(out, np.minimum(shape[None, :], possibilities[:, [k]]), out=out)
        return out

    def shares(self, possibilities: np.ndarray) -> np.ndarray:
        """The share of the aggregated area that lies to the left of each point; rows without an area are NaN."""
        y = self.aggregated(possibilities)
        area = np.zeros_like(y)
        np.cumsum((y[:, 1:] + y[:, :-1]) / 2 * float(self.universes["ozone"][2]), axis=1, out=area[:, 1:])
        total = area[:, -1:]
        return area / np.where(total > 0, total, np.nan)

    def _with_points(self, df: DataFrame, targets: dict[str, float], find: Callable) -> DataFrame:
        low, _, step = map(float, self.universes["ozone"])
        names = list(targets)

        @pandas_udf(", ".join(f"`{n}` double" for n in names))
        def points(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for columns in batches:
                x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
                out = np.full((len(x), len(names)), np.nan)
                for at in range(0, len(x), ROWS):
                    part = x[at : at + ROWS]
                    known = ~np.isnan(part).any(axis=1)
                    shares = self.shares(np.where(known[:, None], part, 0))
                    known &= ~np.isnan(shares[:, -1])
                    for k, p in enumerate(targets.values()):
                        out[at + np.flatnonzero(known), k] = find(shares[known], p, low, step)
                # A missing number is null and not NaN.
                yield pd.DataFrame(out, columns=names).astype(object).where(~np.isnan(out), None)

        found = df.withColumn("_points", points(*map(F.col, self.output)))
        return found.withColumns({n: F.col("_points")[n] for n in names}).drop("_points")

    def percentiles(self, df: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
        """df with the whole-number values at which given shares of the aggregated area lie to the left.

        Null where no rule fires (the area is zero) or an input is missing.
        Halves go to the even number, whatever the ninth decimal place says.
        """
        return self._with_points(df, targets or {"ozone_10pc": 0.1, "ozone_50pc": 0.5, "ozone_90pc": 0.9}, between_points)

    def first_points(self, df: DataFrame, targets: dict[str, float]) -> DataFrame:
        """df with the first points of the universe up to which given shares of the area lie: the older, coarser way."""
        return self._with_points(df, targets, first_point)

    def infer(self, df: DataFrame) -> DataFrame:
        """Guarded inputs, possibilities and percentiles."""
        return self.percentiles(self.possibilities(self.guarded(df)))


def normalised(df: DataFrame, categories: tuple[str, ...] = tuple(OUTPUT)) -> DataFrame:
    """Possibilities by their largest; null where all are zero."""
    most = F.greatest(*map(F.col, categories))
    return df.withColumns({c: F.try_divide(F.col(c), most) for c in categories})
