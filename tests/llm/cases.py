"""Documents with every awkward case, and plain Python versions of the contracts."""

import random
import re
from collections import Counter

from pyspark.sql import types as T

COLUMNS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        T.StructField("key", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("_id", T.StringType()),
        T.StructField("rep", T.StringType()),
    ]
)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts(seed=1):
    rng = random.Random(seed)
    base = prose(rng, 90, 5000)
    out = [
        None,
        None,
        "",
        " \t\n ",
        "one",
        "ONE",
        "one two three four",
        "one two three four five six seven",
        "ONE two three four five six seven eight",
        "naïve café ñandú straße 東京 word",
        prose(rng, 6_000),
        base,
        base,
        base.upper(),
    ]
    words = base.split(" ")
    for i in range(14):
        copy = list(words)
        for _ in range(i % 5):
            copy[rng.randrange(len(copy))] = f"edit{i}"
        out.append(" ".join(copy))
    passage = prose(rng, 60, 10_000)
    for i in range(8):
        out.append(prose(rng, 25 + i) + "\n" + passage + "\n" + prose(rng, 25))
    out += ["line one is here\n" * 12, "a b c d e f g h " * 30, "### && $$$ |||| word " * 20]
    for i in range(30):
        out.append(prose(rng, rng.randrange(1, 160)))
    return out


def documents(spark, rows=None):
    rng = random.Random(2)
    if rows is None:
        rows = []
        for i, t in enumerate(texts()):
            rows.append((100 - i, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "Z", "é", None])))
        rows.append((None, "no id but some words here", "en", "a"))
        rows.append((None, "no id but some words here", "en", "a"))
        rows += rows[11:14]  # repeated rows
        rows.append((100 - 11, "the same id with another text of several words", "en", "b"))
    extra = ("x", "x", "x", "x", "x", "x", "x")
    return spark.createDataFrame([(*r, len(r[1] or ""), *extra) for r in rows], COLUMNS)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})
