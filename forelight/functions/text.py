"""Text rules of forecast discussions: markers, fields, checks."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

#: Fields that a discussion's summary block gives, one to a line.
FIELDS = ("ALERT", "CONFIDENCE", "HEADLINE", "SUMMARY")
#: Phrases by which a text talks about itself rather than the weather; fixed values.
META = r"(?i)\b(as an ai|i cannot|i can't|language model|here is the outlook)\b"


def version(text: Column) -> Column:
    """Versions without their leading v and in lower case."""
    return F.regexp_replace(F.lower(F.trim(text)), r"^v(?=[0-9])", "")


def field(text: Column, name: str) -> Column:
    """What follows NAME: on its line, null if there is none."""
    found = F.trim(F.regexp_extract(text, rf"(?im)^[ \t>*#-]*{name}[ \t*]*:[ \t*]*([^\n]*)", 1))
    return F.when(found != "", found)


def section(text: Column, header: str) -> Column:
    """Lines after a header up to the next one, null without the header."""
    found = F.regexp_extract(text, rf"(?is)(?:^|\n)#+[ \t]*{header}[^\n]*\n(.*?)(?=\n#|\z)", 1)
    return F.when(F.trim(found) != "", F.trim(found))


def paths(text: Column) -> Column:
    """File paths in back quotes, each once, in order of their first places."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"`([^`\s]+/[^`\s]+)`"), F.lit(1)))


def sentences(text: Column, n: int = 2) -> Column:
    """The first sentences."""
    found = F.regexp_extract_all(text, F.lit(r"[^.!?]+[.!?]+"), F.lit(0))
    return F.trim(F.array_join(F.slice(found, 1, n), ""))


def truncated(text: Column, n: int) -> Column:
    return F.when(F.char_length(text) > n, F.concat(F.substring(text, 1, n - 3), F.lit("..."))).otherwise(text)


def filled(template: Column, values: dict[str, Column]) -> Column:
    """{{NAME}} replaced by values; a missing value leaves nothing."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def line_count(text: Column) -> Column:
    return F.size(F.split(text, "\n"))


def failures(text: Column, markers: list[str], expected_version: Column, least_lines: int = 50) -> Column:
    """Names of the checks that a discussion fails; an empty array for a good one."""
    has = [F.contains(text, F.lit(m)) for m in markers]
    n = sum(h.cast("int") for h in has)
    checks = {
        "empty": F.trim(text) == "",
        "front matter": ~F.startswith(text, F.lit("---")),
        "version": ~version(F.coalesce(field(text, "version"), F.lit(""))).eqNullSafe(version(expected_version)),
        "markers": n != len(markers),
        "short": line_count(text) < least_lines,
        "meta": text.rlike(META),
    }
    return F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in checks.items())))


def plain(column: Column | str) -> Column:
    """Composed for compatibility (NFKC), without format characters; no built-in function does that."""
    return pandas_udf(_plain, "string")(column)


def _plain(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: t if t is None else "".join(c for c in unicodedata.normalize("NFKC", t) if unicodedata.category(c) != "Cf"))


def braces(text: str) -> list[str]:
    """a{b,c}d -> abd, acd; nested ones too; a group without a comma loses its braces, one without an end stays."""
    start = text.find("{")
    depth, parts, last = 0, [], start + 1
    for i in range(start, len(text)) if start >= 0 else ():
        depth += (text[i] == "{") - (text[i] == "}")
        if depth == 1 and text[i] == ",":
            parts.append(text[last:i])
            last = i + 1
        if depth == 0:
            parts.append(text[last:i])
            return [x for p in parts for x in braces(text[:start] + p + text[i + 1 :])]
    return [text]


def expanded(column: Column | str) -> Column:
    """Brace expansion of each path."""
    return pandas_udf(_expanded, "array<string>")(column)


def _expanded(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: None if t is None else braces(t))
