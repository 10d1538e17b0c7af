"""Quality rules as a ledger of failure bits.

``ledger`` evaluates every rule once per document: it stores the measurements and one
integer whose bit i says that rule i failed. Policies are named sets of rules with a
version; applying one is a bitwise AND of its mask with the stored bits, so a changed
policy needs no second pass over the texts. ``ablation`` counts, for each rule of a
policy, the documents that fail it, and those that only it removes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.llm.textnum import BLANKS, U, Chunk, chunks, grams, prefix_hashes, span_hashes, words

WINDOW = 8
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between each offset and the next."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(text: np.ndarray, hashes: np.ndarray, n: int, window: int) -> np.ndarray:
    """Per text: words inside a window of words that occurs in the text twice or more."""
    h = grams(hashes, window)
    count = len(h)
    out = np.zeros(n, np.int64)
    if not count:
        return out
    whole = np.flatnonzero(text[window - 1 :] == text[:count])
    order = whole[np.lexsort((h[whole], text[whole]))]
    if len(order) < 2:
        return out
    same = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
    repeated = np.zeros(len(order), bool)
    repeated[1:] |= same
    repeated[:-1] |= same
    starts = order[repeated]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=n)


def _dup_lines(chunk: Chunk, n: int, word_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them equal to an earlier line."""
    breaks = np.flatnonzero(chunk.data == 10)
    # A line starts at a text's start and after each line break, and ends before the next.
    starts = np.concatenate([chunk.offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, chunk.offsets[1:]])
    text = np.concatenate([np.arange(n), np.searchsorted(chunk.offsets, breaks, "right") - 1])
    order = np.lexsort((starts, text))
    starts, text = starts[order], text[order]
    ends = ends[np.lexsort((ends, np.concatenate([np.searchsorted(chunk.offsets, breaks, "right") - 1, np.arange(n)])))]
    filled = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, text = starts[filled], ends[filled], text[filled]
    lines = np.bincount(text, minlength=n)
    if not len(starts):
        return lines, np.zeros(n, np.int64)
    h = span_hashes(prefix_hashes(chunk.data), starts, ends) * U(2) + (ends - starts).astype(U)
    order = np.lexsort((starts, h, text))
    later = np.zeros(len(h), bool)
    later[order[1:]] = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
    return lines, np.bincount(text[later], minlength=n)


def measured(column: pa.Array, window: int = WINDOW) -> dict[str, np.ndarray]:
    """All measurements of a column of texts."""
    parts: dict[str, list] = {m: [] for m in MEASURES}
    for chunk in chunks(column):
        n = len(chunk.offsets) - 1
        w = words(chunk)
        heads = (chunk.data & 0xC0) != 0x80  # first bytes of code points
        lines, dup = _dup_lines(chunk, n, w.starts)
        values = (
            np.bincount(w.text, minlength=n),
            _sums(heads & ~BLANKS[chunk.data], chunk.offsets),
            _sums(_SYMBOLS[chunk.data], chunk.offsets),
            lines,
            dup,
            _repeat_words(w.text, w.hashes, n, window),
        )
        for m, v in zip(MEASURES, values):
            parts[m].append(v)
    return {m: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for m, v in parts.items()}


def measurements(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the measurements; a null text has none of anything."""
    kept = [c for c in docs.columns if c != text]
    fields = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{m} bigint" for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = measured(batch.column(batch.schema.get_field_index(text)))
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(values[m]) for m in MEASURES)], names=[*kept, *MEASURES])

    return docs.select(*kept, text).mapInArrow(run, schema)


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # a condition on the measurements


#: The order is the order of the bits; rules are only ever added at the end.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("short_words", "10 * word_chars < 25 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("symbols", "10 * n_symbols > 4 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
)


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
#: Word lengths stay out: they are kept in the ledger, but no reason to drop a text.
STANDARD = Policy("standard", 2, ("few_words", "repeated_windows", "symbols", "duplicate_lines"))


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[name] for name in policy.rules)


def ledger(measures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measurements with ``failed``: bit i is set if rule i fails."""
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits + F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
    return measures.withColumn("failed", bits)


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("bigint")) == 0


def ablation(ledgered: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it, and that the policy would keep without it.

    Equal bit patterns are counted first, so the work after the one shuffle does not
    follow the number of documents but that of patterns, 2^rules at most.
    """
    patterns = ledgered.select(
        F.col("failed").bitwiseAND(F.lit(mask(policy, rules)).cast("bigint")).alias("failed")
    ).groupBy("failed").agg(F.count("*").alias("n"))
    places = {r.name: i for i, r in enumerate(rules)}
    each = F.explode(
        F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << places[name]).cast("bigint").alias("bit")) for name in policy.rules])
    )
    rows = patterns.select("failed", "n", each.alias("r"))
    has = F.col("failed").bitwiseAND(F.col("r.bit")) != 0
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(has, F.col("n")).otherwise(F.lit(0))).cast("bigint").alias("n_failed"),
        F.sum(F.when(F.col("failed") == F.col("r.bit"), F.col("n")).otherwise(F.lit(0))).cast("bigint").alias("n_only"),
    )


def judged_documents(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Every document with its measurements, failure bits and the verdicts of two policies.

    A null or empty text has no words and fails the base policy. Repeated rows are
    judged each for themselves, columns other than doc_id and text are ignored, and
    an empty table gives no rows.
    """
    rows = ledger(measurements(docs.select("doc_id", "text")))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(policy)).alias("kept"),
        "n_lines",
        "failed",
    )


RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8)),
twice AS (SELECT rid, w FROM win GROUP BY rid, w HAVING count(*) > 1),
rep AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (rid, w)) GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
f AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * word_chars < 25 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 4 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
  failed & 51 = 0 AS kept, n_lines, CAST(failed AS BIGINT) AS failed FROM f
"""
