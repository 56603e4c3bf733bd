"""Small documents with what an operator must bear: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random
import re

SPACE = "\x20\x09-\x0d"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Further columns, named as results and working columns of the operators are.
CLASH = ["kept", "id", "node", "n", "grp", "key", "h1", "n_bytes", "n_tokens", "hash", "rule", "verdict", "pieces", "n_lines", "n_words", "score"]


def words(text):
    return re.findall(f"[^{SPACE}]+", text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < .1 else "") for _ in range(n))


def documents(seed=1):
    """(doc_id, text, lang, source, n_chars) rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(60, 260)) for _ in range(20)]
    texts = [None, "", " \n\t ", "one", "one two three four", "one two three four", *base]
    for b in base[:8]:  # exact and near copies
        w = b.split(" ")
        texts += [b, b]
        for _ in range(3):
            v = list(w)
            for _ in range(rng.randrange(1, 6)):
                v[rng.randrange(len(v))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(v))
    passage = prose(rng, 90)
    line = "This line of boilerplate stands in very many of the documents, as such lines do."
    for i in range(12):
        texts.append("\n".join([prose(rng, 30), passage if i % 2 else line, prose(rng, 25), line.upper() + "  ", line]))
    texts += ["word " * 3000, "a" * 3000, "é" * 700 + " ü\n" * 300, "\n".join([prose(rng, 12)] * 40), prose(rng, 9000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[7], rows[7], (None, base[3], None, None, None), (None, None, None, None, None)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("other").alias(c) for c in CLASH])
