"""Benchmark decontamination by winnowing.

A text's fingerprints are, for every window of ``span`` words, the least hash of the
``gram``-word sequences inside the window. Two texts that share ``span`` words in a
row share the window, hence its fingerprint: no shared span of that length is
missed, while only about two of ``span - gram + 2`` positions are kept. Training and
test fingerprints are joined; for the texts that meet, the windows behind the
fingerprints are compared, which gives every shared window and so, by their union,
every maximal shared span. Only DataFrame operations are used.

Test items shorter than ``span`` words have no window; they are looked up whole, by
their first word and then by comparing the words that follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkvec.llm.common import A_TO_Z, free_prefix
from walkvec.stage import stage

#: Words consist of ASCII letters and digits and all characters beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
GRAM = 5
CONTAMINATED_SHARE = 20  # contaminated if one word in so many is hit


def item_words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; none for null."""
    parts = F.split(F.translate(text, A_TO_Z, A_TO_Z.lower()), SEPARATORS)
    return F.coalesce(F.filter(parts, lambda w: w != ""), F.array().cast("array<string>"))


def _runs(array: Column, length: int, f) -> Column:
    """``f`` of each run of ``length`` entries; empty if the array is shorter."""
    return F.when(
        F.size(array) >= length,
        F.transform(F.sequence(F.lit(1), F.size(array) - F.lit(length - 1)), lambda i: f(F.slice(array, i, length))),
    ).otherwise(F.array().cast("array<bigint>"))


def _hash(x: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), x)


def with_minima(texts: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``texts`` (with words) and ``minima``: the least gram hash of each window, by window start."""
    hashed = texts.withColumn("hashes", F.transform("words", lambda w: _hash(w, 1)))
    grams = hashed.withColumn("grams", _runs(F.col("hashes"), gram, lambda run: _hash(run, 2)))
    return grams.withColumn("minima", _runs(F.col("grams"), span - gram + 1, F.array_min)).drop("grams")


def item_windows(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(item, minimum, first, second): the windows of the test items, with two hashes of their words."""
    windows = with_minima(items.where(F.size("words") >= span), span, gram)
    return _exploded(windows, "item", span).select("item", "minimum", "first", "second").distinct()


def _exploded(windows: DataFrame, key: str, span: int) -> DataFrame:
    """(key, at, minimum, first, second), one row per window; ``at`` counts from 0."""
    both = windows.select(
        key,
        F.posexplode(
            F.arrays_zip(
                F.col("minima").alias("minimum"),
                _runs(F.col("hashes"), span, lambda run: _hash(run, 3)).alias("first"),
                _runs(F.col("hashes"), span, lambda run: _hash(run, 4)).alias("second"),
            )
        ).alias("at", "w"),
    )
    return both.select(key, "at", "w.minimum", "w.first", "w.second")


def decontaminate(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, share: int = CONTAMINATED_SHARE) -> DataFrame:
    """Every document with its words, the words hit, and the test items that occur in it.

    ``docs`` has doc_id and text, ``items`` has item_id and text; other columns are
    ignored. A null text has no words; a document or item without words hits
    nothing. Items with equal texts all occur. Items without an id hit words but
    are not listed. Each row of ``docs`` gives one row, repeated rows too; equal
    texts are compared once. Empty tables give no rows and no hits.
    """
    return _judged(docs, items, span, gram, share).drop("key")


def _judged(docs: DataFrame, items: DataFrame, span: int, gram: int, share: int) -> DataFrame:
    """The rows of ``decontaminate`` with ``key``, a hash of the text."""
    key = F.md5(F.coalesce("text", F.lit("")))
    tokens = docs.select("doc_id", key.alias("key"), item_words(F.col("text")).alias("words"))
    prints = with_minima(tokens, span, gram).select(
        "doc_id",
        "key",
        F.size("words").cast("bigint").alias("n_words"),
        F.array_distinct("minima").alias("prints"),
    )
    prints = stage(prints, "prints")

    test = stage(
        items.select(F.col("item_id").cast("string").alias("item"), item_words(F.col("text")).alias("words")).where(
            F.size("words") > 0
        ),
        "items",
    )
    windows = stage(item_windows(test, span, gram), "windows")
    met = (
        prints.select("key", F.explode("prints").alias("minimum"))
        .join(windows.select("minimum").distinct(), "minimum", "left_semi")
        .select("key")
        .distinct()
    )
    lengths = sorted(r[0] for r in test.where(F.size("words") < span).select(F.size("words")).distinct().collect())
    spans = None
    if lengths:
        spans = _short_hits(docs.select(key.alias("key"), "text"), test, lengths)

    # The texts that meet a test text, each once, read again with their words.
    near = docs.select(key.alias("key"), "text").join(met, "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    near = with_minima(near.select("key", item_words(F.col("text")).alias("words")), span, gram)
    long_hits = (
        _exploded(near, "key", span)
        .join(windows, ["minimum", "first", "second"])
        .select("key", "item", F.col("at").alias("start"), (F.col("at") + span).alias("stop"))
    )
    hits = stage(long_hits if spans is None else long_hits.unionByName(spans), "hits")

    found = hits.groupBy("key").agg(F.collect_set("item").alias("found"))
    before = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        hits.select("key", "start", "stop")
        .distinct()
        .withColumn("from", F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
        .groupBy("key")
        .agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.col("from"))).cast("bigint").alias("hit"))
    )
    ids = F.coalesce(F.array_sort("found"), F.array().cast("array<string>"))
    hit = F.coalesce("hit", F.lit(0).cast("bigint"))
    return (
        prints.select("doc_id", "key", "n_words")
        .join(found.join(covered, "key"), "key", "left")
        .select(
            "doc_id",
            "n_words",
            hit.alias("n_hit"),
            F.size(ids).cast("bigint").alias("n_items"),
            F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
            ((hit > 0) & (F.lit(share) * hit >= F.col("n_words"))).alias("contaminated"),
            F.col("key"),
        )
    )


def clean_documents(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM, share: int = CONTAMINATED_SHARE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are.

    Verdicts are looked up by text, so rows that share an id do not share a verdict.
    """
    bad = _judged(docs.select("doc_id", "text"), items, span, gram, share)
    bad = bad.where("contaminated").select(F.col("key").alias(f"{free_prefix(docs)}key")).distinct()
    key = F.md5(F.coalesce("text", F.lit("")))
    return docs.join(bad, key == F.col(bad.columns[0]), "left_anti")


def _short_hits(texts: DataFrame, test: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, item, start, stop) of the items of the given lengths, all below the span."""
    short = test.where(F.size("words").isin(lengths)).select(
        "item", F.col("words").alias("sought"), F.col("words")[0].alias("word")
    )
    words = texts.select("key", item_words(F.col("text")).alias("words"))
    starts = words.select("key", F.posexplode("words").alias("start", "word")).join(
        short.select("word").distinct(), "word", "left_semi"
    )
    starts = stage(starts.distinct(), "starts")
    own = words.join(starts.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("words").alias("words"))
    return (
        starts.join(short, "word")
        .join(own, "key")
        .where(F.slice("words", F.col("start") + 1, F.size("sought")) == F.col("sought"))
        .select("key", "item", "start", (F.col("start") + F.size("sought")).alias("stop"))
    )


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS words
  FROM benchmark),
sizes AS (SELECT DISTINCT least(len(words), 13) AS m FROM b WHERE len(words) > 0),
iw AS (
  SELECT DISTINCT item, m, array_to_string(words[i:i + m - 1], ' ') AS w
  FROM (SELECT item, words, least(len(words), 13) AS m, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS i
        FROM b WHERE len(words) > 0)),
dw AS (
  SELECT rid, m, i, array_to_string(words[i:i + m - 1], ' ') AS w
  FROM (SELECT rid, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM d, sizes WHERE len(words) >= m)),
hits AS (SELECT dw.rid, iw.item, dw.i, dw.m FROM dw JOIN iw ON dw.m = iw.m AND dw.w = iw.w),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""
