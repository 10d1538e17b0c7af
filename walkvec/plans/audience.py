"""The whole job: log to selected records and nodes, to graph, walks and vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.config import Config
from walkvec.operators import embed, graph, interactions, segments, sequences, similar, train, tree_softmax, walks
from walkvec.stage import stage


@dataclass(frozen=True)
class Origin:
    """Selected records and node index of a log."""

    selected: DataFrame
    nodes: DataFrame


def selected_records(log: DataFrame, cfg: Config) -> DataFrame:
    cleaned = interactions.clean(log, cfg.rating_min)
    kept = cleaned
    if cfg.item_user_cap is not None:
        kept = interactions.drop_hot_items(cleaned, cfg.item_user_cap)
    return interactions.select_items(kept, cfg.items_per_member)


def process_origin(
    log: DataFrame, base: DataFrame, cfg: Config, statis_date: str | None = None
) -> Origin:
    """Clean, select and index. The selected records are written once and used twice."""
    selected = stage(selected_records(log, cfg), "selected")
    members = interactions.member_history(selected)
    segmented = segments.assign_segments(
        members, base, cfg.segment_labels, cfg.segment_aliases, statis_date
    )
    return Origin(selected, segments.node_index(segmented))


def node_records(origin: Origin, cfg: Config) -> DataFrame:
    records = graph.node_records(origin.selected, origin.nodes)
    return stage(graph.drop_items_of_size(records, cfg.drop_exact), "records")


def build_transitions(records: DataFrame, cfg: Config) -> DataFrame:
    edges = graph.both_directions(graph.member_edges(records))
    degree = graph.weighted_degree_of_records(records)
    return graph.transitions(edges, cfg.neighbours, degree)


def build_walks(trans: DataFrame, cfg: Config, **options) -> DataFrame:
    return walks.random_walks(
        trans,
        cfg.walk_steps,
        cfg.walks_per_node,
        strategy=options.get("strategy", cfg.strategy),
        dead_end=options.get("dead_end", cfg.dead_end),
        seed=cfg.seed,
        keep_sentinel=options.get("keep_sentinel", False),
        stage_every=cfg.stage_every,
    )


def node_vectors(node_walks: DataFrame, cfg: Config) -> DataFrame:
    """Vectors (seg_id, node_id, vector) from walks, all segments in one model.

    Words are "segment|node"; walks never leave a segment.
    """
    word = F.transform("nodes", lambda n: F.concat_ws("|", "seg_id", n))
    # Longer sentences are cut into pieces, which are sentences of their own.
    most = cfg.max_sentence_length
    pieces = F.transform(
        F.sequence(F.lit(0), F.floor((F.greatest(F.size(word), F.lit(1)) - 1) / most)),
        lambda i: F.slice(word, (i * most + 1).cast("int"), most),
    )
    sentences = node_walks.select("walk_id", F.posexplode(pieces).alias("piece", "tokens"))
    sentences = sentences.select(F.concat_ws("|", "walk_id", "piece").alias("seq_id"), "tokens")
    sentences = stage(sequences.long_enough(sentences), "sentences")
    ranks = stage(sequences.token_ranks(sequences.array_positions(sentences), cfg.min_count), "ranks")
    uid = F.concat_ws("|", "seq_id", "center_pos", "context_pos")
    pairs = sequences.pairs_from_arrays(sentences, cfg.window)
    pairs = pairs.select(uid.alias("uid"), "center", "context")
    shared = {"size": cfg.vector_size, "epochs": cfg.iterations, "seed": cfg.seed, "learning_rate": cfg.learning_rate}
    if cfg.softmax == "tree":
        words = tree_softmax.trained_tree_vectors(pairs, ranks, tree_softmax.TreeTraining(**shared))
    else:
        words = train.trained_word_vectors(pairs, ranks, train.Training(**shared))
    parts = F.split("token", "[|]")
    return words.select(
        F.get(parts, 0).cast("int").alias("seg_id"),
        F.get(parts, 1).cast("bigint").alias("node_id"),
        "vector",
    )


def member_vectors(origin: Origin, cfg: Config) -> DataFrame:
    """Records to graph, walks, vectors and names: (seg_id, member_id, vector)."""
    trans = build_transitions(node_records(origin, cfg), cfg)
    vectors = node_vectors(build_walks(trans, cfg), cfg)
    return embed.name_vectors(vectors, origin.nodes)


def expand_audience(named: DataFrame, cfg: Config, exact: bool = False) -> DataFrame:
    """Rows of the result table: each member's nearest members of its segment, by hashing
    or, at quadratic cost, exactly."""
    vectors = stage(named.withColumnRenamed("member_id", "id"), "vectors")
    if exact:
        pairs = similar.similar_topk(vectors, cfg.neighbours_out)
    else:
        pairs = similar.similar_ann(
            vectors, cfg.vector_size, cfg.neighbours_out, cfg.lsh_tables, cfg.lsh_hashes_per_table
        )
    return similar.result_rows(similar.scored(pairs))


def similar_members(named: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """Members nearer than ``cfg.lsh_threshold``: rows of the result table for distinct
    vectors, in both orders, and (seg_id, rep, id) for the members that share a vector."""
    vectors = stage(named.withColumnRenamed("member_id", "id"), "vectors")
    found, copies = similar.distinct_pairs(
        vectors, cfg.vector_size, cfg.lsh_threshold, cfg.lsh_tables, cfg.lsh_hashes_per_table
    )
    orders = F.explode(
        F.array(F.struct(F.col("lo").alias("user1"), F.col("hi").alias("user2")), F.struct(F.col("hi").alias("user1"), F.col("lo").alias("user2")))
    )
    both = found.select("seg_id", orders.alias("p"), "distance").select("seg_id", "p.*", "distance")
    return similar.result_rows(similar.scored(both)), copies


@dataclass(frozen=True)
class SideFit:
    examples: train.Examples
    ranks: DataFrame
    initial: DataFrame
    params: DataFrame


def train_side_vectors(
    tokens: DataFrame, encoded: DataFrame, window: int, t: train.Training
) -> SideFit:
    """Train item side vectors on the pairs of token sequences."""
    ranks = stage(sequences.token_ranks(tokens), "ranks")
    references = train.side_references(encoded)
    return _fit(train.sequence_examples(tokens, references, ranks, window, t), ranks, references, t)


def train_side_pairs(
    pairs: DataFrame, ranks: DataFrame, encoded: DataFrame, t: train.Training
) -> SideFit:
    """Train item side vectors on pairs (uid, center, context)."""
    references = train.side_references(encoded)
    return _fit(train.prepare_examples(pairs, references, ranks, t), ranks, references, t)


def _fit(examples: train.Examples, ranks: DataFrame, references: DataFrame, t: train.Training) -> SideFit:
    initial = train.initial_parameters(references, ranks, t)
    return SideFit(examples, ranks, initial, train.train(examples, ranks, initial, t))
