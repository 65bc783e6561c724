import random

import pytest

#: Columns that a careless plan would mistake for its own.
CLASHES = ["k", "doc", "node", "n", "text_", "size", "label", "shard", "rank", "component", "key", "bits", "value", "score", "gone", "_row"]


def frame(spark, rows, clashes=True):
    """Documents from (doc_id, text) pairs, with the table's other columns and clashing ones."""
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), *([7] * len(CLASHES) if clashes else [])) for i, t in rows]
    extra = "".join(f", `{c}` int" for c in CLASHES) if clashes else ""
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long{extra}")


def prose(seed, words, vocabulary=400):
    r = random.Random(seed)
    names = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(vocabulary)]
    out = []
    for i in range(words):
        out.append(r.choice(names) + ("." if i % 11 == 10 else ""))
        if i % 40 == 39:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def corpus():
    """Texts with nulls, blanks, copies, near copies, shared passages, junk and personal data."""
    rows = [(i, prose(i, 60 + 13 * (i % 9))) for i in range(40)]
    rows += [(40 + i, rows[i][1]) for i in range(4)]
    near = rows[5][1].split(" ")
    rows += [(50 + i, " ".join(near[: 30 + i] + ["changed"] + near[31 + i :])) for i in range(4)]
    passage = prose(999, 60)
    rows += [(60 + i, prose(100 + i, 30) + "\n" + passage + "\n" + prose(200 + i, 30)) for i in range(4)]
    rows += [(70, None), (71, ""), (72, "   \n\t "), (73, "one"), (74, "one two"), (None, "a text without an id, which is rare"), (75, "x" * 5000)]
    rows += [(76, "mail jo.hn+x@mail.example.com or 10.20.30.40, card 4111 1111 1111 1111, phone +1 (743) 555-3824. token = \"0123456789abcdef0123456789abcdef\"")]
    rows += [(77, "É" * 60 + " çà et là " + "É" * 60), (77, "É" * 60 + " çà et là " + "É" * 60)]
    return rows
