"""Whole jobs from files and tables to files and tables.

    python -m walkvec.plans.jobs LOG BASE_TABLE DATE OUT [--result-table T]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkvec.config import Config
from walkvec.operators import embed, sequences, similar, train, vocab
from walkvec.plans import audience
from walkvec.sources import readers, writers
from walkvec.stage import stage, staging


def run_audience_job(
    spark: SparkSession,
    log_path: str,
    base_table: str,
    date: str,
    out: str,
    cfg: Config | None = None,
    result_table: str | None = None,
    pairs_table: str | None = None,
) -> None:
    """Interaction log to selected records, node index, walks, vectors and similar members.

    ``result_table`` gets each member's nearest members, ``pairs_table`` all pairs of
    distinct vectors below the threshold, with ``copies`` for the members that share one.
    All segments are processed together; walks and vectors have one
    directory per segment. An empty segment simply has none. The session is left to the
    caller; tables staged on the way are removed.
    """
    cfg = cfg or Config()
    with staging(spark):
        _audience(spark, log_path, base_table, date, out, cfg, result_table, pairs_table)


def _audience(
    spark: SparkSession,
    log_path: str,
    base_table: str,
    date: str,
    out: str,
    cfg: Config,
    result_table: str | None,
    pairs_table: str | None,
) -> None:
    log = readers.read_interaction_log(spark, f"{log_path}/{date}")
    base = readers.read_member_base(spark, base_table, date)
    origin = audience.process_origin(log, base, cfg)
    nodes = stage(origin.nodes, "nodes")
    origin = audience.Origin(origin.selected, nodes)
    writers.write_selected_records(origin.selected, f"{out}/selected_records")
    writers.write_node_index(nodes, f"{out}/nodes")

    trans = audience.build_transitions(audience.node_records(origin, cfg), cfg)
    walked = stage(audience.build_walks(trans, cfg), "walks")
    writers.write_walks(walked, f"{out}/walks")

    vectors = audience.node_vectors(walked, cfg)
    named = stage(embed.name_vectors(vectors, nodes), "named")
    writers.write_embeddings(named, f"{out}/embeddings")
    if result_table:
        writers.append_result(audience.expand_audience(named, cfg), result_table, date)
    if pairs_table:
        pairs, copies = audience.similar_members(named, cfg)
        writers.append_result(pairs, pairs_table, date)
        writers.write_parquet(copies, f"{out}/copies")


def load_recommendations(spark: SparkSession, root: str, table: str, date: str) -> None:
    """Recommendation files of all segments into one date of the result table."""
    found = readers.read_recommendations(spark, root)
    writers.overwrite_result(similar.result_rows(found), table, date)


def train_items(
    spark: SparkSession, side_path: str, sequence_path: str, out: str, t: train.Training, window: int = 5
) -> None:
    """Side information and sequences to a vocabulary, known items and trained tables."""
    items = readers.read_side_information(spark, side_path)
    vocabulary = stage(vocab.build_vocabulary(items), "vocabulary")
    encoded = stage(vocab.encode(items, vocabulary), "encoded")
    lines = readers.read_sequences(spark, sequence_path)
    # A line may be of any length, so its pairs are formed block by block.
    tokens = stage(sequences.array_positions(lines), "tokens")
    pairs = sequences.skipgram_pairs(tokens, window)
    uid = F.concat_ws("|", "seq_id", "center_pos", "context_pos").alias("uid")
    ranks = stage(sequences.token_ranks(tokens), "ranks")
    fit = audience.train_side_pairs(pairs.select(uid, "center", "context"), ranks, encoded, t)
    writers.write_vocabulary(vocabulary, f"{out}/vocabulary")
    writers.write_parquet(train.parameter_tables(fit.params), f"{out}/tables")
    writers.write_parquet(fit.ranks, f"{out}/ranks")


def _model(spark: SparkSession, model: str) -> tuple[DataFrame, DataFrame]:
    return readers.read_vocabulary(spark, f"{model}/vocabulary"), spark.read.parquet(f"{model}/tables")


def export_known(spark: SparkSession, side_path: str, model: str, out: str, size: int) -> None:
    """Vectors of items whose every feature is in the vocabulary."""
    vocabulary, tables = _model(spark, model)
    encoded = stage(vocab.encode(readers.read_side_information(spark, side_path), vocabulary), "encoded")
    writers.write_item_vectors(embed.export_items(embed.attention_embed(encoded, tables, size)), out)


def export_cold(
    spark: SparkSession, side_path: str, model: str, out: str, size: int, node_count: int
) -> None:
    """Vectors of new items from the features they share with known ones."""
    vocabulary, tables = _model(spark, model)
    items = readers.read_side_information(spark, side_path)
    encoded = stage(vocab.encode_cold(items, vocabulary, node_count), "encoded")
    writers.write_item_vectors(embed.export_items(embed.mean_embed(encoded, tables, size)), out)


def main() -> None:
    parser = argparse.ArgumentParser(description="Interaction log to member vectors")
    for name in ("log", "base_table", "date", "out"):
        parser.add_argument(name)
    parser.add_argument("--result-table")
    parser.add_argument("--pairs-table")
    parser.add_argument("--drop-exact", type=int)
    parser.add_argument("--segment-labels", nargs="+", default=list(Config.segment_labels))
    for name, default in vars(Config()).items():
        if isinstance(default, (int, float, str)):
            parser.add_argument(f"--{name.replace('_', '-')}", type=type(default), default=default)
    args = vars(parser.parse_args())
    job = {k: args.pop(k) for k in ("log", "base_table", "date", "out", "result_table", "pairs_table")}
    args["segment_labels"] = tuple(args["segment_labels"])
    spark = SparkSession.builder.appName("walkvec").getOrCreate()
    run_audience_job(
        spark,
        job["log"],
        job["base_table"],
        job["date"],
        job["out"],
        Config(**args),
        job["result_table"],
        job["pairs_table"],
    )


if __name__ == "__main__":
    main()
