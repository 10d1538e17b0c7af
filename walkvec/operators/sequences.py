"""Training examples from sequences: skip-gram pairs, context rows, negatives, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkvec.functions.draws import with_uniforms
from walkvec.operators.dense_index import dense_index, running_total
from walkvec.operators.skew import lookup
from walkvec.stage import stage

BLOCK_POSITIONS = 4_096
SHUFFLE_BUCKETS = 4_096  # three hex digits
SHUFFLE_ROWS = 1_000_000  # about as many per task


def positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Tokens (seq_id, pos, token) from rows in ``order`` within each ``seq_id``."""
    indexed = dense_index(rows, ["seq_id"], order, "pos", many_groups=True)
    return indexed.select("seq_id", "pos", "token")


def array_positions(sequences: DataFrame) -> DataFrame:
    """Tokens (seq_id, pos, token) from rows (seq_id, tokens array)."""
    return sequences.select("seq_id", F.posexplode("tokens").alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def long_enough(sequences: DataFrame) -> DataFrame:
    """Sequences of more than one token."""
    return sequences.where(F.size("tokens") > 1)


def pairs_from_arrays(sequences: DataFrame, window: int) -> DataFrame:
    """Skip-gram pairs of short sequences (walks): one pass, no shuffle."""
    tokens = F.col("tokens")

    def around(center: Column, i: Column) -> Column:
        begin = F.greatest(i - window, F.lit(0))
        context = F.slice(tokens, begin + 1, F.lit(2 * window) + 1 - (window - i + begin))
        return F.transform(
            context,
            lambda c, j: F.struct(
                i.cast("bigint").alias("center_pos"),
                (begin + j).cast("bigint").alias("context_pos"),
                center.alias("center"),
                c.alias("context"),
            ),
        )

    pairs = F.flatten(F.transform(tokens, around))
    return (
        sequences.select("seq_id", F.explode(pairs).alias("p"))
        .select("seq_id", "p.*")
        .where(F.col("center_pos") != F.col("context_pos"))
    )


def _blocks_with_margin(tokens: DataFrame, window: int, block: int, both: bool) -> DataFrame:
    """Cut sequences into blocks; each block also sees ``window`` positions beyond its end
    (and, if ``both``, before its start), so that a long sequence spans many tasks."""
    if block < window:
        raise ValueError("a block must not be shorter than the window")
    own = F.floor(F.col("pos") / block)
    offset = F.col("pos") - own * block
    seen = [own, F.when((offset < window) & (own > 0), own - 1)]
    if both:
        seen.append(F.when(offset >= block - window, own + 1))
    return tokens.select(
        "seq_id",
        "pos",
        "token",
        own.alias("_own"),
        F.explode(F.array_compact(F.array(*seen))).alias("_block"),
    )


def skipgram_pairs(tokens: DataFrame, window: int, block: int = BLOCK_POSITIONS) -> DataFrame:
    """One row per (center, context) occurrence within ``window`` positions.

    Each pair of positions is found once, looking ahead, and emitted in both
    directions. One shuffle of the tokens, however long a sequence is.
    """
    spec = Window.partitionBy("seq_id", "_block").orderBy("pos")
    ahead = [
        F.struct(
            F.lit(d).alias("d"),
            F.lead("token", d).over(spec).alias("t"),
            F.lead("pos", d).over(spec).isNotNull().alias("there"),
        )
        for d in range(1, window + 1)
    ]
    rows = (
        _blocks_with_margin(tokens, window, block, both=False)
        .withColumn("ahead", F.array(*ahead))
        .where(F.col("_own") == F.col("_block"))
        .select("seq_id", "pos", "token", F.explode("ahead").alias("a"))
        .where("a.there")
    )
    here, there = F.col("pos"), F.col("pos") + F.col("a.d")
    both = F.array(
        F.struct(
            here.alias("center_pos"),
            there.alias("context_pos"),
            F.col("token").alias("center"),
            F.col("a.t").alias("context"),
        ),
        F.struct(
            there.alias("center_pos"),
            here.alias("context_pos"),
            F.col("a.t").alias("center"),
            F.col("token").alias("context"),
        ),
    )
    return rows.select("seq_id", F.explode(both).alias("p")).select("seq_id", "p.*")


def context_rows(tokens: DataFrame, window: int, block: int = BLOCK_POSITIONS) -> DataFrame:
    """All contexts of a position in one row (seq_id, pos, center, n_left, contexts), in
    order; the first ``n_left`` lie before it. Positions without contexts are left out.

    What is joined or numbered per center is so done once, not once per pair;
    :func:`context_pairs` gives the rows of :func:`skipgram_pairs`.
    """
    spec = Window.partitionBy("seq_id", "_block").orderBy("pos")

    def near(d: int):
        move = F.lead if d > 0 else F.lag
        token, there = move("token", abs(d)).over(spec), move("pos", abs(d)).over(spec).isNotNull()
        return F.struct(token.alias("t"), there.alias("there"))

    def present(near_ones: Column) -> Column:
        return F.transform(F.filter(near_ones, lambda a: a["there"]), lambda a: a["t"])

    before = F.array(*[near(d) for d in range(-window, 0)])
    after = F.array(*[near(d) for d in range(1, window + 1)])
    return (
        _blocks_with_margin(tokens, window, block, both=True)
        .withColumn("before", before)
        .withColumn("after", after)
        .where(F.col("_own") == F.col("_block"))
        .select(
            "seq_id",
            "pos",
            F.col("token").alias("center"),
            F.size(present(F.col("before"))).alias("n_left"),
            F.concat(present(F.col("before")), present(F.col("after"))).alias("contexts"),
        )
        .where(F.size("contexts") > 0)
    )


def context_pairs(rows: DataFrame, *extra: str, place: str = "place") -> DataFrame:
    """Pairs of :func:`context_rows`, with each context's number in its row and the
    columns ``extra``."""
    return rows.select(
        "seq_id", "pos", "center", "n_left", *extra, F.posexplode("contexts").alias(place, "context")
    ).select(
        "seq_id",
        F.col("pos").alias("center_pos"),
        (F.col("pos") - F.col("n_left") + F.col(place) + F.when(F.col(place) >= F.col("n_left"), 1).otherwise(0)).alias(
            "context_pos"
        ),
        "center",
        "context",
        *extra,
        place,
    )


def cbow_rows(tokens: DataFrame, window: int, block: int = BLOCK_POSITIONS) -> DataFrame:
    """Each position's context, left then right, padded with null to 2 * window."""
    spec = Window.partitionBy("seq_id", "_block").orderBy("pos")

    def near(d: int):
        shifted = F.lead("token", d) if d > 0 else F.lag("token", -d)
        return shifted.over(spec)

    around = F.array(*[near(d) for d in (*range(-window, 0), *range(1, window + 1))])
    context = F.array_compact(F.col("around"))
    missing = F.lit(2 * window) - F.size(context)
    return (
        _blocks_with_margin(tokens, window, block, both=True)
        .withColumn("around", around)
        .where((F.col("_own") == F.col("_block")) & (F.size(context) > 0))
        .select(
            "seq_id",
            "pos",
            F.col("token").alias("center"),
            F.concat(
                context, F.array_repeat(F.when(F.lit(False), F.col("token")), missing)
            ).alias("context"),
        )
    )


def attach_side(
    pairs: DataFrame, side: DataFrame, tokens: DataFrame | None = None
) -> DataFrame:
    """Add the encoded side features of each pair's center; safe for hot centers.

    With the ``tokens`` the pairs came from, their frequencies are taken from them.
    """
    table = side.withColumnRenamed("node", "center")
    counts = None if tokens is None else _token_counts(tokens)
    return lookup(pairs, table, ["center"], spread="context", how="inner", counts=counts)


def _token_counts(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy(F.col("token").alias("center")).agg(F.count("*").alias("_rows"))


def pairs_with_side(tokens: DataFrame, side: DataFrame, window: int) -> DataFrame:
    """:func:`skipgram_pairs` with the side features of their center: the features meet the
    positions, a tenth of the pairs at a window of 5."""
    rows = context_rows(tokens, window)
    table = side.withColumnRenamed("node", "center")
    extra = [c for c in table.columns if c != "center"]
    found = lookup(rows, table, ["center"], ["seq_id", "pos"], how="inner", counts=_token_counts(tokens))
    return context_pairs(found, *extra).drop("place")


def token_ranks(tokens: DataFrame, min_count: int = 1) -> DataFrame:
    """Tokens with their rank by descending frequency (ties by token), from 0."""
    counts = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    ordered = counts.withColumn("_neg", -F.col("n"))
    return dense_index(ordered, [], ["_neg", "token"], "rank").drop("_neg")


def log_uniform_rank(u: Column, vocab_size: Column) -> Column:
    """A rank in [0, vocab_size), drawn with probability ln((r + 2)/(r + 1)) / ln(vocab_size + 1)."""
    drawn = F.floor(F.exp(u * F.log(vocab_size + 1))).cast("bigint") - 1
    return F.least(drawn, vocab_size.cast("bigint") - 1)


def negatives(
    pairs: DataFrame, key: Sequence[str], vocab_size: Column, count: int, seed: int
) -> DataFrame:
    """``count`` negative ranks per pair; ``key`` identifies a pair."""
    drawn = with_uniforms(pairs, "_drawn", list(range(1, count + 1)), seed, *[F.col(k) for k in key])
    return drawn.select(*pairs.columns, F.posexplode("_drawn").alias("_at", "_u")).select(
        *pairs.columns, (F.col("_at") + 1).alias("draw"), log_uniform_rank(F.col("_u"), vocab_size).alias("negative")
    )


def _shuffled(
    examples: DataFrame, key: Sequence[str], seed: int, ties: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """:func:`shuffled`, with equal keys in the order of ``ties``, and the number of examples."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *key))
    bucket = F.conv(F.substring(order, 1, 3), 16, 10).cast("int").alias("_bucket")
    counts = stage(examples.groupBy(bucket).agg(F.count("*").alias("_rows")), "buckets")
    total = counts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    tasks = min(max(total // SHUFFLE_ROWS, examples.sparkSession.sparkContext.defaultParallelism), SHUFFLE_BUCKETS)
    # Order and bucket are made again behind the shuffle, which carries the bare examples.
    dealt = examples.repartition(tasks, bucket).select("*", bucket, order.alias("_order"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", *key, *ties)) - 1
    numbered = dealt.withColumn("_place", place).join(F.broadcast(starts), "_bucket")
    return numbered.select(*examples.columns, (F.col("_start") + F.col("_place")).cast("bigint").alias("idx")), total


def shuffled(examples: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    """Number all examples in a reproducible random order (column ``idx``).

    The order is that of an md5. Its first digits name one of 4096 buckets, whose
    counts are taken first; then the examples are shuffled once, each bucket to
    one task. ``examples`` is computed twice and must give the same rows.
    """
    return _shuffled(examples, key, seed)[0]


def shuffled_batches(
    examples: DataFrame, key: Sequence[str], seed: int, batch_size: int, epochs: int = 1
) -> DataFrame:
    """:func:`batches` of the :func:`shuffled` examples, which are not counted again."""
    indexed, total = _shuffled(examples, key, seed)
    return batches(indexed, batch_size, epochs, F.lit(total).cast("bigint"))


def batches(
    indexed: DataFrame, batch_size: int, epochs: int = 1, total: Column | None = None
) -> DataFrame:
    """Repeat the indexed examples and cut them into full batches.

    The last, short batch is dropped, after the repetition. ``total`` is the
    number of examples, which are counted if it is not given.
    """
    if total is None:
        total = indexed.agg(F.count("*")).scalar()
    place = F.col("epoch") * total + F.col("idx")
    full = F.floor(total * epochs / batch_size)
    return (
        indexed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("batch_id", F.floor(place / batch_size))
        .where(F.col("batch_id") < full)
    )


def training_batches(
    tokens: DataFrame,
    side: DataFrame | None,
    window: int,
    batch_size: int,
    epochs: int = 1,
    seed: int | None = 42,
) -> DataFrame:
    """Tokens to batches: pairs, side features, shuffle, repeat, batch.

    ``seed=None`` keeps the order of the sequences, as evaluation does.
    """
    key = ["seq_id", "center_pos", "context_pos"]
    rows, columns = context_rows(tokens, window), []
    if side is None:
        rows = rows.withColumn("_items", F.lit(1)).withColumn("_item", F.lit(0))
    else:
        # Items of one node in a fixed order; a pair has one row per item of its center.
        table = side.withColumnRenamed("node", "center")
        columns = [c for c in table.columns if c != "center"]
        number = F.row_number().over(Window.partitionBy("center").orderBy(*columns)) - 1
        table = stage(table.withColumn("_item", number), "side")
        counts = _token_counts(tokens)
        items = table.groupBy("center").agg(F.count("*").cast("int").alias("_items"))
        rows = lookup(rows, items, ["center"], ["seq_id", "pos"], how="inner", counts=counts)

    def with_side(found: DataFrame, spread: Sequence[str]) -> DataFrame:
        return found if side is None else lookup(found, table, ["center", "_item"], spread, how="inner")

    each_item = F.explode(F.sequence(F.lit(0), F.col("_items") - 1))
    if seed is None:
        sized = rows.withColumn("_n", F.size("contexts").cast("bigint") * F.col("_items"))
        started = running_total(sized, ["seq_id", "pos"], "_n", "_start")
        total = started.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
        if side is not None:
            started = started.withColumn("_item", each_item)
        pairs = context_pairs(with_side(started, ["seq_id", "pos"]), *columns, "_start", "_items", "_item")
        index = F.col("_start") + F.col("place") * F.col("_items") + F.col("_item")
        indexed = pairs.withColumn("idx", index.cast("bigint"))
    else:
        if side is not None:
            rows = rows.withColumn("_item", each_item)
        pairs = context_pairs(rows, "_item").drop("place")
        indexed, number = _shuffled(pairs, key, seed, ["_item"])
        total = F.lit(number).cast("bigint")
        indexed = with_side(indexed, key)
    names = [*key, "center", "context", *columns, "idx"]
    return batches(indexed.select(*names), batch_size, epochs, total)
