"""How queries and the SQL they are checked against are registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def registry() -> tuple[dict[str, Callable], dict[str, str], Callable]:
    """Two empty tables, and a decorator that fills them under the function's name.

    Days are given out as text on both sides, as engines differ in what they make of dates.
    """
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def query(sql: str | None = None, days: tuple[str, ...] = ()):
        def add(f: Callable) -> Callable:
            @wraps(f)
            def run(spark, sf_dir) -> DataFrame:
                out = f(spark, sf_dir)
                return out.withColumns({d: F.col(d).cast("string") for d in days})

            queries[f.__name__] = run
            if sql:
                oracles[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({d} AS VARCHAR) AS {d}' for d in days)}) FROM ({sql}) answer" if days else sql
            return f

        return add

    return queries, oracles, query


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to some places and without negative zeros, so that engines agree."""
    return df.select(*((F.round(F.col(f.name), places) + F.lit(0.0)).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema))


def r(*names: str, places: int = 6) -> str:
    return ", ".join(f"round({n}, {places}) + 0.0 AS {n}" for n in names)
