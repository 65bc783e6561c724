"""Personal data in texts: votes of patterns, gazetteers and contexts, in DataFrame operations only.

Candidates are the spans of four base patterns, valid or not, and of looser
ones: numbers written like a card or a phone, obfuscated mail addresses, secrets
given to a name. Labellers vote on each candidate by its form, by word lists and
by what stands in front of it. Vote patterns of all candidates are counted (a
few hundred different ones at most), expectation-maximisation estimates the
labellers' reliabilities from the counts, and a logistic span classifier is
trained on the posterior labels. Spans of the base patterns that pass their
checks are always kept; others are added where the classifier says so.

Offsets are code points, ends exclusive. Defined results: null and empty texts
have no spans. Long texts and long matches are read whole. Repeated rows are each
treated on their own; spans of equal start are ordered by kind, then end. Empty
tables give empty results. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forelight.llm import weak
from forelight.llm.common import Scratch, let, table

KINDS = ("email", "ip", "card", "phone", "secret")

# Fixed formats. Possessive loops and the lookbehinds (or the end of the match before, \G) keep long runs from being
# tried from each of their characters; matches are those of the plain patterns.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
#: Whole runs of 16 to 19 digits; those of other lengths never pass.
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
HIDDEN_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]++(?: ?[\[({] ?dot ?[\])}] ?[A-Za-z0-9-]++)++"
LOCAL_PHONE = r"(?<![0-9+).-])(?<![0-9+)] )\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9-])"
SECRET = r"(?i)(?<![a-z0-9_])(?:token|api_?key|secret|passwd|password)\s?[=:]\s?[\"'][^\s\"']{16,}+[\"']"

#: Word lists of the labellers.
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CONTEXT = {
    "email": r"(?:mail|contact|write|correo|courriel|kontakt)",
    "ip": r"(?:\bip\b|address|host|server|client|login)",
    "card": r"(?:card|visa|credit|payment|tarjeta|carte|karte)",
    "phone": r"(?:phone|call|tel|mobile|fax|telefon|llame)",
    "secret": r"(?:key|token|auth|login|secret)",
}


#: Matches whose places are found at a time: an array that grows by one is copied as often, so long ones grow by parts.
PART = 64
_PLACES = "array<struct<start:int,stop:int,hit:string>>"


def located(hits: Column, gaps: Column) -> Column:
    """Matches as (start, stop, hit), from the matches and the texts between them."""
    steps = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("hit"), F.char_length(g).alias("gap"), F.char_length(h).alias("len")))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        return F.struct((begin + x["len"]).alias("at"), F.array_append(acc["out"], F.struct(begin.alias("start"), (begin + x["len"]).alias("stop"), x["hit"].alias("hit"))).alias("out"))

    def places(steps: Column) -> Column:
        def add(acc: Column, k: Column) -> Column:
            part = F.aggregate(F.slice(steps, k * PART + 1, F.lit(PART)), F.struct(acc["at"].alias("at"), F.array().cast(_PLACES).alias("out")), step)
            return let(part, lambda x: F.struct(x["at"].alias("at"), F.array_append(acc["out"], x["out"]).alias("out")))

        parts = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / PART).cast("int"))
        return F.flatten(F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_PLACES}>").alias("out")), add)["out"])

    return F.when(F.size(hits) > 0, let(steps, places)).otherwise(F.array().cast(_PLACES))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1))),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.ascii(F.substring(back, i, F.lit(1))) - 48).otherwise((F.ascii(F.substring(back, i, F.lit(1))) - 48) * 2 - F.when(F.ascii(F.substring(back, i, F.lit(1))) > 52, 9).otherwise(0)),
    )
    return (F.char_length(digits) > 0) & (total % 10 == 0)


def _small_parts(hit: Column) -> Column:
    """No part of an address above 255; leading zeros don't matter."""
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")))


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out.when(no, -1) if no is not None else out).otherwise(0)


def _votes(kind: str, hit: Column, valid: Column, before: Column) -> list[Column]:
    """Five votes: form, gazetteer, context, length, variety."""
    digits = _digits(hit)
    if kind == "email":
        known = F.regexp_replace(F.lower(hit), r"^.*(?:\.| ?[\[({] ?dot ?[\])}] ?)", "").isin(*TOP_DOMAINS)
        size = F.char_length(hit).between(6, 64)
    elif kind == "ip":
        known = ~hit.rlike(r"^(?:0|127|255)\.") & valid
        size = F.char_length(hit).between(7, 15)
    elif kind == "card":
        known = digits.rlike(CARD_ISSUERS)
        size = F.char_length(digits) == 16
    elif kind == "phone":
        known = hit.rlike(r"^(?:\+[1-9]|\([2-9])")
        size = F.char_length(digits).between(10, 13)
    else:
        known = hit.rlike(r"(?i)^(?:token|api_?key|secret|passw)")
        size = F.char_length(hit).between(24, 96)
    same = hit.rlike(r"^[^0-9A-Za-z]*([0-9A-Za-z])(?:[^0-9A-Za-z]|\1)*$")
    return [_vote(valid, ~valid), _vote(known, ~known), _vote(F.lower(before).rlike(CONTEXT[kind])), _vote(size, ~size), _vote(F.lit(False), same)]


#: Votes of a candidate make one number: the kind's place, then three values for each vote.
N_VOTES = 5


def _candidates(kind: str, base: bool, found: Column, text: Column) -> Column:
    def describe(x: Column) -> Column:
        hit, start = x["hit"], x["start"]
        digits = _digits(hit)
        valid = {"email": F.lit(True), "ip": _small_parts(hit), "card": luhn(digits), "phone": F.char_length(digits).between(8, 15), "secret": hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")}[kind]
        before = F.substring(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24)))
        code = F.lit(KINDS.index(kind) * 2 + base)
        for v in _votes(kind, hit, valid, before):
            code = code * 3 + v + 1
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), x["stop"].alias("stop"), (valid & base).alias("base"), code.cast("int").alias("code"))

    return F.transform(found, describe)


_PATTERNS = (
    # kind, is it a base pattern, pattern, a text that any match contains
    ("email", True, EMAIL, "@"),
    ("ip", True, IP, "."),
    ("card", True, CARD, None),
    ("phone", True, PHONE, "+"),
    ("email", False, HIDDEN_EMAIL, "at"),
    ("phone", False, LOCAL_PHONE, "("),
    ("secret", False, SECRET, None),
)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): array of candidates by kind, then start."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    for n, (_, _, pattern, has) in enumerate(_PATTERNS):
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        df = df.withColumn(f"m{n}", F.when(F.contains("text", F.lit(has)), hits).otherwise(none) if has else hits)
    for n, (_, _, pattern, _) in enumerate(_PATTERNS):
        gaps = F.when(F.size(f"m{n}") > 0, F.split("text", pattern, -1)).otherwise(none)
        df = df.withColumn(f"m{n}", located(F.col(f"m{n}"), gaps))
    every = [_candidates(kind, base, F.col(f"m{n}"), F.col("text")) for n, (kind, base, _, _) in enumerate(_PATTERNS)]
    return df.select("doc_id", F.array_sort(F.concat(*every)).alias("found"))


def train(found: DataFrame) -> dict[int, float]:
    """Span classifier: probability by vote code, for every code that occurs."""
    # Two flavours of each kind and 3^5 votes: no more than 2,430 rows, whatever the corpus.
    rows = found.select(F.explode("found.code").alias("code")).groupBy("code").count().orderBy("code").collect()
    if not rows:
        return {}
    codes, counts = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    votes = np.stack([codes // 3 ** (N_VOTES - 1 - j) % 3 - 1 for j in range(N_VOTES)], axis=1)
    labels = weak.fit(votes, counts, prior=0.7).posterior(votes)
    flavour = codes // 3**N_VOTES
    features = np.hstack([votes == v for v in (-1, 1)] + [(flavour[:, None] == np.arange(2 * len(KINDS))[None, :])]).astype(float)
    w = weak.logistic(features, labels, counts)
    p = 1 / (1 + np.exp(-(features @ w[:-1] + w[-1])))
    return {int(c): float(x) for c, x in zip(codes, p, strict=True)}


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id and ``spans``, an array of (kind, start, stop, base) by kind, then start."""
    found = Scratch(docs.sparkSession, "pii").keep(candidates(docs, id_col, text_col), "candidates")
    taken = [c for c, p in train(found).items() if p >= threshold]
    return found.select("doc_id", _without_overlaps(F.filter("found", lambda x: x["base"] | x["code"].isin(taken))).alias("spans"))


def _without_overlaps(spans: Column) -> Column:
    """Base spans, and of the others those that no base span of their kind overlaps."""
    base = F.filter(spans, lambda x: x["base"])
    return F.filter(spans, lambda x: x["base"] | ~F.exists(base, lambda b: (b["kind"] == x["kind"]) & (b["start"] < x["stop"]) & (x["start"] < b["stop"])))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in angle brackets; overlapping spans by the first one's."""
    spans = personal_data(docs, id_col, text_col).select("doc_id", "spans")
    both = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(spans, "doc_id", "left")
    ordered = F.array_sort(F.transform("spans", lambda x: F.struct(x["start"], x["stop"], x["kind"])))
    names = F.array(*map(F.lit, KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, x: F.when(x["start"] < acc["at"], acc).otherwise(F.struct(x["stop"].alias("at"), F.concat(acc["out"], F.substring("text", acc["at"] + 1, x["start"] - acc["at"]), F.lit("<"), names[x["kind"]], F.lit(">")).alias("out")))
    done = F.aggregate(ordered, start, step)
    return both.withColumn("_d", done).select("doc_id", F.when(F.size("spans") > 0, F.concat(F.col("_d.out"), F.substring("text", F.col("_d.at") + 1, F.char_length("text")))).otherwise(F.col("text")).alias("text"))


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["base"])
    count = lambda k: F.size(F.filter("spans", lambda x: x["base"] & (x["kind"] == k))).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])),
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )
