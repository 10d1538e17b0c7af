"""Hard negatives of anchors by exact integer inner products, with coordinate pruning.

Rows fall into buckets of similar length, longest first, and buckets into parts of
bounded size. Each part meets each block of anchors in one task. There a part is cut
into runs, and a run holds, for every coordinate, the list of its rows sorted by that
coordinate of their unit vectors.

What an anchor still needs is a score: that of the last row it keeps, or the lower end
of its positives' ranges. Divided by both lengths it is a cosine t, and a row at an
angle of at most arccos t to the anchor has its coordinate f between cos(a + arccos t)
and cos(a - arccos t), where cos a is the anchor's. For the anchor's few largest
coordinates these ranges are slices of the sorted lists; only rows in all of them are
verified by their exact scores. Where the slices hold most of a run, as at wide angles,
the run is verified whole in one product.

The search takes two rounds: the best rows of the anchor's label are its positives, and
their scores are the ranges of the second round, over the rows of all other labels.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkvec.operators.cells import with_blocks
from walkvec.operators.skew import lookup
from walkvec.stage import stage

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least so many hundredths of its positive, and not more than it.
LEAST_PERCENT = 80
ANCHOR_BLOCK = 8_192
PART_ROWS = 8_192
RUN_ROWS = 2_048
#: Coordinates looked up per anchor; any number gives the same result.
FOCUS = 4
#: Lengths within a bucket differ by this factor at most; there are under 900 buckets.
BUCKET_FACTOR = 0.9
_EXACT = float(1 << 53)
_SLACK = 1e-9


def prepared(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, vec_id, label, v, length, bucket): the rows that take part, with integer components."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("bigint"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    rows = vectors.where(F.col("label").isNotNull() & x.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        whole.alias("v"),
    )
    bucket = F.when(F.col("length") > 0, F.floor(-F.log("length") / math.log(BUCKET_FACTOR))).otherwise(-1)
    return rows.withColumn("length", length).withColumn("bucket", bucket.cast("int"))


# --- one part against one block of anchors ------------------------------------


class _Rows:
    """Rows of a table as arrays; shorter vectors count as filled up with zeros."""

    def __init__(self, table: pa.Table, width: int):
        self.id = table["vec_id"].fill_null(0).to_numpy()
        self.null = np.asarray(table["vec_id"].is_null())
        self.label = table["label"].to_numpy()
        self.length = table["length"].to_numpy()
        sizes = table["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        values = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        self.v = np.zeros((len(sizes), width), np.int64)
        self.v[np.arange(width) < sizes[:, None]] = values

    def take(self, at: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        for name, value in vars(self).items():
            setattr(out, name, value[at])
        return out


def _products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products; ``most`` bounds their absolute values."""
    if most < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Best:
    """The first ``k`` rows seen by falling score, ties by id (null last)."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.score, self.id, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def needed(self) -> int | None:
        """The least score that can still enter; None if any can."""
        return int(self.score[-1]) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        need = self.needed()
        keep = np.ones(len(score), bool) if need is None else score >= need
        if self.high is not None:
            keep &= score <= self.high
        at = np.flatnonzero(keep)
        if len(at) > self.k:
            at = at[score[at] >= np.partition(score[at], -self.k)[-self.k]]
        if not len(at):
            return
        s, i, n = (np.concatenate(x) for x in ((self.score, score[at]), (self.id, ids[at]), (self.null, null[at])))
        first = np.lexsort((i, n, -s))[: self.k]
        self.score, self.id, self.null = s[first], i[first], n[first]


class Run:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, rows: _Rows):
        self.rows = rows
        self.longest, self.shortest = float(rows.length.max()), float(rows.length.min())
        self.unit = rows.v / np.maximum(rows.length, 1e-300)[:, None]
        self.order = np.argsort(self.unit, axis=0)
        self.sorted = np.take_along_axis(self.unit, self.order, 0)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, needed: int | None) -> np.ndarray | None:
        """Rows that may reach the needed score with the anchor; None for all of them."""
        if needed is None or length == 0 or self.shortest == 0:
            return None
        cosine = needed / (length * (self.longest if needed > 0 else self.shortest))
        if cosine > 1 + _SLACK:
            return np.zeros(0, np.int64)
        if cosine <= -1 or not len(focus):
            return None
        widest, angle = math.acos(min(1.0, cosine)), np.arccos(np.clip(unit[focus], -1, 1))
        low = np.cos(np.minimum(math.pi, angle + widest)) - _SLACK
        high = np.cos(np.maximum(0.0, angle - widest)) + _SLACK
        lo = np.array([np.searchsorted(self.sorted[:, f], x, "left") for f, x in zip(focus, low)])
        hi = np.array([np.searchsorted(self.sorted[:, f], x, "right") for f, x in zip(focus, high)])
        best = int(np.argmin(hi - lo))
        if 2 * (hi - lo)[best] > len(self.unit):
            return None
        at = self.order[lo[best] : hi[best], focus[best]]
        for i, f in enumerate(focus):
            if i != best:
                x = self.unit[at, f]
                at = at[(x >= low[i]) & (x <= high[i])]
        return at


def _search(anchors: _Rows, kept: list[list[Best]], rows: _Rows, same_label: bool, run_rows: int, focus: int) -> tuple[int, int]:
    """Offer the rows to what each anchor keeps; the numbers of rows verified and of all pairs."""
    order = np.argsort(-rows.length, kind="stable")
    units = anchors.v / np.maximum(anchors.length, 1e-300)[:, None]
    largest = np.argsort(-np.abs(units), axis=1)[:, :focus]
    verified = 0
    for first in range(0, len(order), run_rows):
        run = Run(rows.take(order[first : first + run_rows]))
        own = run.rows

        def offer(i: int, at: np.ndarray, score: np.ndarray, own: _Rows = own) -> None:
            if same_label:
                ok = (own.label[at] == anchors.label[i]) & (own.null[at] | (own.id[at] != anchors.id[i]))
            else:
                ok = own.label[at] != anchors.label[i]
            for best in kept[i]:
                best.add(score[ok], own.id[at][ok], own.null[at][ok])

        whole = []
        for i, bests in enumerate(kept):
            needs = [b.needed() for b in bests]
            needed = None if None in needs else min(needs)
            at = run.candidates(units[i], largest[i], anchors.length[i], needed)
            if at is None:
                whole.append(i)
            elif len(at):
                most = anchors.length[i] * run.longest
                offer(i, at, _products(own.v[at], anchors.v[i : i + 1], most)[:, 0])
                verified += len(at)
        everything = np.arange(len(own.id))
        for low in range(0, len(whole), 256):
            some = whole[low : low + 256]
            score = _products(anchors.v[some], own.v, float(anchors.length[some].max()) * run.longest)
            for k, i in enumerate(some):
                offer(i, everything, score[k])
            verified += score.size
    return verified, len(anchors.id) * len(order)


def _both(anchors: pa.Table, rows: pa.Table) -> tuple[_Rows, _Rows]:
    width = max(int(t["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max()) for t in (anchors, rows))
    return _Rows(anchors, width), _Rows(rows, width)


FOUND = "row bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, found_id bigint, score bigint"


def _found(columns: list[list], nulls: np.ndarray) -> pa.Table:
    row, anchor, place, positive, positive_score, ids, score = columns
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    ids = pa.array(np.array(ids, np.int64), mask=nulls)
    arrays = [pa.array(c, t) for c, t in zip((row, anchor, place, positive, positive_score), types)]
    names = [part.split()[0] for part in FOUND.split(", ")]
    return pa.table([*arrays, ids, pa.array(score, pa.int64())], names=names)


def _collected(table: pa.Table, kept: list[list[Best]], positives: list[list[dict]] | None) -> pa.Table:
    columns: list[list] = [[] for _ in range(7)]
    nulls: list[bool] = []
    rows, ids = table["row"].to_pylist(), table["vec_id"].to_pylist()
    for i, bests in enumerate(kept):
        for place, best in enumerate(bests):
            positive = positives[i][place] if positives else {"id": None, "score": None}
            n = len(best.score)
            own = (rows[i], ids[i], place, positive["id"], positive["score"])
            for column, value in zip(columns, own):
                column.extend([value] * n)
            columns[5].extend(best.id.tolist())
            columns[6].extend(best.score.tolist())
            nulls.extend(best.null.tolist())
    return _found(columns, np.array(nulls, bool))


#: Before the names of the anchors' columns, where these meet rows of the same table.
_ANCHOR = "anchor_"


def _meet(anchors: DataFrame, rows: DataFrame, keys: list[str], run) -> DataFrame:
    """What ``run`` finds in each part for each block of anchors."""
    own = anchors.toDF(*[_ANCHOR + c for c in anchors.columns])
    return own.groupBy(*[_ANCHOR + k for k in keys]).cogroup(rows.groupBy(*keys)).applyInArrow(run, FOUND)


def _searcher(k: int, same_label: bool, least_percent: int, run_rows: int, focus: int):
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        anchors = anchors.rename_columns([c.removeprefix(_ANCHOR) for c in anchors.column_names])
        if not anchors.num_rows or not rows.num_rows:
            return _found([[] for _ in range(7)], np.zeros(0, bool))
        positives = None if same_label else anchors["positives"].to_pylist()
        if same_label:
            kept = [[Best(k)] for _ in range(anchors.num_rows)]
        else:
            kept = [
                [Best(k, -(-least_percent * p["score"] // 100), p["score"]) for p in own] for own in positives
            ]
        asked, offered = _both(anchors, rows)
        _search(asked, kept, offered, same_label, run_rows, focus)
        return _collected(anchors, kept, positives)

    return run


# --- the search ---------------------------------------------------------------


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows found for each of the keys, with their place from 1 as ``rank``."""
    order = [F.desc("score"), F.col("found_id").isNull(), "found_id"]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _numbers(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def best_of_label(rows: DataFrame, anchors: DataFrame, k: int, run_rows: int = RUN_ROWS, focus: int = FOCUS) -> DataFrame:
    """(row, positives): the first ``k`` other rows of each anchor's label, as (score, id) in order."""
    columns = ["row", "vec_id", "label", "v", "length"]
    parts = with_blocks(rows, ["label", "bucket"], "row", PART_ROWS)
    per_bucket = parts.groupBy("label", "bucket").agg(F.max("_blocks").alias("parts"))
    per_label = per_bucket.groupBy("label").agg(F.collect_list(F.struct("bucket", "parts")).alias("buckets"))
    blocks = with_blocks(anchors, ["label"], "row", ANCHOR_BLOCK)
    per_anchor = blocks.groupBy("label").agg(F.max("_blocks").alias("blocks"))
    keys = ["label_of", "bucket_of", "part_of", "block_of"]
    left = (
        lookup(blocks.select(*columns, F.col("_block").alias("block_of")), per_label, ["label"], "row", "inner")
        .select(*columns, "block_of", F.explode("buckets").alias("b"))
        .select(*columns, F.col("label").alias("label_of"), F.col("b.bucket").alias("bucket_of"), _numbers(F.col("b.parts")).alias("part_of"), "block_of")
    )
    right = lookup(
        parts.select(*columns, F.col("bucket").alias("bucket_of"), F.col("_block").alias("part_of")), per_anchor, ["label"], "row", "inner"
    ).select(*columns, F.col("label").alias("label_of"), "bucket_of", "part_of", _numbers(F.col("blocks")).alias("block_of"))
    found = _meet(left, right, keys, _searcher(k, True, 0, run_rows, focus))
    return (
        _first(found, ["row"], k)
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "score", F.col("found_id").alias("id")))).alias("found"))
        .select("row", F.transform("found", lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"))).alias("positives"))
    )


def hard_negatives(
    vectors: DataFrame,
    anchor: Column | None = None,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    run_rows: int = RUN_ROWS,
    focus: int = FOCUS,
) -> DataFrame:
    """The first negatives of every positive of every anchor, exactly.

    ``vectors`` has vec_id, label and embedding; other columns are ignored. ``anchor``
    is a condition on vec_id (every hundredth by default). Rows with a null label, a null
    vector, or a null or non-finite component take no part. A positive is a row of the
    anchor's label with another vec_id, a negative one of another label whose score
    lies between ``least_percent`` hundredths of the positive's and the positive's. Falling score, ties
    by vec_id, null last; a row without id can be found but is no anchor. Repeated rows
    are rows of their own, anchors too. Vectors of different lengths are
    filled up with zeros; a vector without components scores 0. Components and
    scores beyond 64 bits stop at the largest such number. An empty table, and an anchor without
    positives or negatives, gives no rows.
    """
    rows = stage(prepared(vectors, scale), "vectors")
    chosen = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    anchors = rows.where(F.col("vec_id").isNotNull() & chosen)
    own = stage(best_of_label(rows, anchors, positives, run_rows, focus), "positives")
    asking = stage(anchors.join(own, "row").select("row", "vec_id", "label", "v", "length", "positives"), "anchors")
    blocks = -(-asking.count() // ANCHOR_BLOCK)
    parts = with_blocks(rows, ["bucket"], "row", PART_ROWS)
    # A bucket is a rounded logarithm of a length, so this list has under 900 entries.
    buckets = [tuple(r) for r in parts.groupBy("bucket").agg(F.max("_blocks")).collect()]
    keys = ["bucket_of", "part_of", "block_of"]
    if not blocks:
        return rows.limit(0).select(*_result(F.lit(None)))
    listed = F.array(*[F.struct(F.lit(b).alias("bucket"), F.lit(n).alias("parts")) for b, n in buckets])
    left = (
        asking.withColumn("block_of", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        .withColumn("b", F.explode(listed))
        .select(*asking.columns, F.col("b.bucket").alias("bucket_of"), _numbers(F.col("b.parts")).alias("part_of"), "block_of")
    )
    right = parts.select(
        "row", "vec_id", "label", "v", "length", F.col("bucket").alias("bucket_of"), F.col("_block").alias("part_of"), _numbers(F.lit(blocks)).alias("block_of")
    )
    found = _meet(left, right, keys, _searcher(negatives, False, least_percent, run_rows, focus))
    return _first(found, ["row", "place"], negatives).select(*_result())


def _result(instead: Column | None = None) -> list[Column]:
    named = {
        "anchor_id": ("anchor_id", "bigint"),
        "positive_id": ("positive_id", "bigint"),
        "rank": ("rank", "int"),
        "negative_id": ("found_id", "bigint"),
        "positive_score": ("positive_score", "bigint"),
        "negative_score": ("score", "bigint"),
    }
    return [(F.col(c) if instead is None else instead).cast(t).alias(name) for name, (c, t) in named.items()]


def shifted_labels(vectors: DataFrame) -> DataFrame:
    """The rows with the label moved on by one (modulo 10) where vec_id is divisible by 7."""
    return vectors.select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        "embedding",
    )


NEGATIVES_SQL = """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND (a.label <> b.label OR a.vec_id IS DISTINCT FROM b.vec_id)),
p AS (
  SELECT rid, anchor_id, id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY rid ORDER BY score DESC, id NULLS LAST) AS place
  FROM s WHERE same QUALIFY place <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.id NULLS LAST) AS rank
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same
    AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
  QUALIFY rank <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n
"""
