"""A quality classifier: gradient-boosted trees over document statistics.

Statistics of every text are computed once, in numpy over Arrow batches, and staged
(a few numbers per document). The trees are fitted on a bounded sample of labelled
rows; features are cut at quantiles into bins, and a node's best split comes from
histograms of gradients over the bins. A fitted model is four flat arrays, one row per
tree in heap order, so that a batch moves down all levels of a tree by indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkvec.llm.common import pieces
from walkvec.llm.quality_rules import measured
from walkvec.llm.textnum import BLANKS, Chunk, chunks, words
from walkvec.stage import stage

#: Labelled rows used for fitting, at most; those with the least hash of their id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_WEIGHT = 80, 4, 64, 0.15, 1.0, 2.0

_SHARES = {
    "upper": range(0x41, 0x5B),
    "lower": range(0x61, 0x7B),
    "digit": range(0x30, 0x3A),
    "comma": b",;:",
    "stop": b".",
    "shout": b"!?",
    "pipe": b"|",
    "mark": b"#*$%&<>=_/\\",
    "high": range(0x80, 0x100),
}
FEATURES = (
    "words",
    "bytes_per_word",
    "distinct_words",
    "repeats_previous",
    "longest_word",
    "lines_per_word",
    "duplicate_lines",
    "repeated_windows",
    "symbols",
    "commonest_word",
    *_SHARES,
)


def _table(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_TABLES = {name: _table(v) for name, v in _SHARES.items()}


def _chunk_statistics(chunk: Chunk) -> np.ndarray:
    """A row of statistics per text, without those that the quality rules measure."""
    n = len(chunk.offsets) - 1
    w = words(chunk)
    count = np.bincount(w.text, minlength=n)
    per_word = 1.0 / np.maximum(count, 1)
    lengths = w.ends - w.starts
    total = np.bincount(w.text, lengths, n)
    longest = np.zeros(n)
    np.maximum.at(longest, w.text, lengths)
    previous = np.zeros(n)
    if len(w.text) > 1:
        again = (w.hashes[1:] == w.hashes[:-1]) & (w.text[1:] == w.text[:-1])
        previous = np.bincount(w.text[1:][again], minlength=n)
    order = np.lexsort((w.hashes, w.text))
    text, hashes = w.text[order], w.hashes[order]
    first = np.ones(len(order), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    distinct = np.bincount(text[first], minlength=n)
    commonest = np.zeros(n)
    starts = np.flatnonzero(first)
    np.maximum.at(commonest, text[starts], np.diff(np.append(starts, len(order))))
    inked = np.concatenate([[0], np.cumsum(~BLANKS[chunk.data])])
    inked = np.maximum(1, inked[chunk.offsets[1:]] - inked[chunk.offsets[:-1]])
    shares = []
    for table in _TABLES.values():
        sums = np.concatenate([[0], np.cumsum(table[chunk.data])])
        shares.append((sums[chunk.offsets[1:]] - sums[chunk.offsets[:-1]]) / inked)
    return np.column_stack(
        [count, total * per_word, distinct * per_word, previous * per_word, longest, commonest * per_word, *shares]
    )


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; zeros for a null or empty one."""
    parts = [_chunk_statistics(c) for c in chunks(column)]
    own = np.concatenate(parts) if parts else np.zeros((0, 6 + len(_SHARES)))
    m = measured(column)
    per_word, per_line = 1.0 / np.maximum(m["n_words"], 1), 1.0 / np.maximum(m["n_lines"], 1)
    rules = [m["n_lines"] * per_word, m["n_dup_lines"] * per_line, m["n_repeat_words"] * per_word, m["n_symbols"] * per_word]
    return np.column_stack([own[:, :5], *rules, own[:, 5:]]).astype(np.float32)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with an array of ``FEATURES``."""
    kept = [c for c in docs.columns if c != text]
    fields = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "features array<float>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = text_statistics(batch.column(batch.schema.get_field_index(text)))
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            ends = np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)
            rows = pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*own, rows], names=[*kept, "features"])

    return docs.select(*kept, text).mapInArrow(run, schema)


class Model(NamedTuple):
    """Trees in heap order: node i has children 2i + 1 and 2i + 2; leaves fill the last level."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); greater values go right
    value: np.ndarray  # (trees, leaves)


def _best_split(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """Gain, feature and bin of the best split, from histograms (features, bins)."""
    left_g, left_h = np.cumsum(g, 1), np.cumsum(h, 1)
    all_g, all_h = left_g[:, -1:], left_h[:, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h

    def score(a, b):
        return a * a / (b + RIDGE)

    gain = score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)
    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0.0
    at = int(np.argmax(gain))
    return float(gain.flat[at]), at // g.shape[1], at % g.shape[1]


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Model:
    """Boosted trees for log loss. Without rows, or with one class, a constant near the class's share."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((trees, inner), np.int32)
    threshold = np.full((trees, inner), np.inf, np.float32)
    value = np.zeros((trees, leaves))
    if not len(y) or y.min() == y.max():
        return Model(base, feature, threshold, value)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    places = binned + np.arange(x.shape[1]) * bins
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for i in range(inner):
            rows = np.flatnonzero(node == i)
            if not len(rows):
                continue
            size = x.shape[1] * bins
            flat = places[rows].ravel()
            hist_g = np.bincount(flat, np.repeat(g[rows], x.shape[1]), size).reshape(-1, bins)
            hist_h = np.bincount(flat, np.repeat(h[rows], x.shape[1]), size).reshape(-1, bins)
            gain, j, b = _best_split(hist_g, hist_h)
            if gain > 1e-6 and b < len(cuts[j]):
                feature[t, i], threshold[t, i] = j, cuts[j][b]
            right = x[rows, feature[t, i]] > threshold[t, i]
            node[rows] = 2 * i + 1 + right
        leaf = node - inner
        sums_g, sums_h = np.bincount(leaf, g, leaves), np.bincount(leaf, h, leaves)
        value[t] = -RATE * sums_g / (sums_h + RIDGE)
        margin += value[t][leaf]
    return Model(base, feature, threshold, value)


def predict(model: Model, x: np.ndarray) -> np.ndarray:
    """Scores between 0 and 1."""
    margin = np.full(len(x), model.base)
    rows = np.arange(len(x))
    inner = model.feature.shape[1]
    depth = int(np.log2(inner + 1))
    for feature, threshold, value in zip(model.feature, model.threshold, model.value):
        node = np.zeros(len(x), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        margin += value[node - inner]
    return 1 / (1 + np.exp(-margin))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from fitting: crc32 of its id as text, mod 5, is 0 (a null id is empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(FOLDS) == 0


def train(stats: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows outside the held-out fold.

    ``labels`` has doc_id and quality. A document with several labels counts by their
    mean, at least a half meaning 1; null labels and ids are left out.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .where(~held_out(F.col("doc_id")))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    sample = stats.join(known, "doc_id").select("doc_id", "features", "label")
    # A repeated id may have several texts: still no more rows than the bound.
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(rows).toArrow()
    x = np.array(sample["features"].to_pylist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, np.array(sample["label"].to_pylist(), np.float64))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with score in place of features."""
    kept = [c for c in stats.columns if c != "features"]
    fields = [f for f in stats.schema.fields if f.name != "features"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("features")).flatten().to_numpy(zero_copy_only=False)
            own = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, pa.array(predict(model, x.reshape(-1, len(FEATURES))))], names=[*kept, "score"])

    return stats.mapInArrow(run, schema)


def scored_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every document with its fold, score and prediction.

    Null and empty texts have statistics of zero and a score like others. Repeated
    rows get equal scores; other columns are ignored. Without labels every score is
    a half; an empty table gives no rows.
    """
    stats = stage(statistics(docs.select("doc_id", "text")), "statistics")
    model = train(stats, labels, rows)
    return score(stats, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose prediction is 1, all columns as they are.

    The model is fitted first, from staged statistics of the same rows; then each row
    is scored where it is read, so that no text is shuffled.
    """
    model = train(stage(statistics(docs.select("doc_id", "text")), "statistics"), labels, rows)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            good = predict(model, text_statistics(batch.column(batch.schema.get_field_index("text")))) >= THRESHOLD
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, schema)
