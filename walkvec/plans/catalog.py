"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkvec.functions import scalar, sql_functions
from walkvec.operators import (
    embed,
    graph,
    interactions,
    segments,
    sequences,
    set_join,
    similar,
    train,
    tree_softmax,
    vocab,
    walks,
)
from walkvec.plans import audience, inputs
from walkvec.sources import readers, writers
from walkvec.stage import last_staged, stage, stage_path

CFG = inputs.CONFIG

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- cleaning and selection -------------------------------------------------


def _cleaned(spark, d):
    return interactions.clean(inputs.interactions(spark, d), CFG.rating_min)


@query
def clean_interactions(spark, d):
    return _cleaned(spark, d)


@query
def item_users(spark, d):
    return interactions.item_users(_cleaned(spark, d))


@query
def hot_items(spark, d):
    return interactions.hot_items(_cleaned(spark, d), inputs.FEWER_USERS)


@query
def drop_hot_items(spark, d):
    return interactions.drop_hot_items(_cleaned(spark, d), inputs.FEWER_USERS)


@query
def selected_records(spark, d):
    return audience.selected_records(inputs.interactions(spark, d), CFG)


@query
def member_history(spark, d):
    return interactions.member_history(selected_records(spark, d))


@query
def item_pairs(spark, d):
    rows = selected_records(spark, d).withColumn("units", interactions.share_units())
    return interactions.symmetric_item_pairs(rows, "units")


# --- segments and nodes -----------------------------------------------------


def _segmented(spark, d):
    return segments.assign_segments(
        interactions.member_history(selected_records(spark, d)),
        inputs.member_base(spark, d),
        CFG.segment_labels,
        CFG.segment_aliases,
    )


@query
def segment_members(spark, d):
    return _segmented(spark, d)


@query
def node_index(spark, d):
    return segments.node_index(_segmented(spark, d))


# --- graph ------------------------------------------------------------------


def _records(spark, d):
    origin = audience.process_origin(inputs.interactions(spark, d), inputs.member_base(spark, d), CFG)
    return audience.node_records(origin, CFG)


@query
def user_graph(spark, d):
    edges = graph.both_directions(graph.member_edges(_records(spark, d)))
    return edges.select("seg_id", "src", "dst", graph.published_weight().alias("weight"))


@query
def weighted_degree(spark, d):
    degree = graph.weighted_degree_of_records(_records(spark, d))
    return degree.select(
        "seg_id", "node_id", (F.col("degree_units") / float(graph.WEIGHT_UNIT)).alias("degree")
    )


def _transitions(spark, d, cfg=CFG):
    return audience.build_transitions(_records(spark, d), cfg)


@query
def transitions(spark, d):
    return _transitions(spark, d).select("seg_id", "src", "dst", F.round("prob", 9).alias("prob"))


@query
def adjacency_lists(spark, d):
    rows = graph.adjacency(_transitions(spark, d, replace(CFG, neighbours=10)))
    return rows.select(
        "seg_id",
        "node_id",
        F.size("nbrs").alias("n_neighbours"),
        F.array_join(F.transform("nbrs", lambda n: n["dst"]), ",").alias("neighbours"),
        F.array_join(F.transform("nbrs", lambda n: n["cum"]), ",").alias("running_units"),
    )


# --- walks ------------------------------------------------------------------


def _published_walks(rows):
    return rows.select("seg_id", "walk_id", F.array_join("nodes", " ").alias("nodes"))


@query
def walks_weighted(spark, d):
    return _published_walks(audience.build_walks(_transitions(spark, d), CFG))


@query
def walks_greedy(spark, d):
    return _published_walks(audience.build_walks(_transitions(spark, d), CFG, strategy="greedy"))


@query
def walks_greedy_leak(spark, d):
    trans = _transitions(spark, d, replace(CFG, neighbours=10))
    return _published_walks(
        audience.build_walks(trans, CFG, strategy="greedy", dead_end="leak", keep_sentinel=True)
    )


@query
def walks_weighted_leak(spark, d):
    trans = _transitions(spark, d, replace(CFG, neighbours=10))
    return _published_walks(audience.build_walks(trans, CFG, dead_end="leak"))


@query
def walks_uniform(spark, d):
    return _published_walks(audience.build_walks(_transitions(spark, d), CFG, strategy="uniform"))


@query
def walks_single(spark, d):
    return _published_walks(walks.single_walks(_transitions(spark, d), 8, seed=7))


@query
def visit_histogram(spark, d):
    trans = _transitions(spark, d)
    return walks.visit_histogram(audience.build_walks(trans, CFG, strategy="greedy"))


# --- sequences --------------------------------------------------------------


def _tokens(spark, d):
    rows = inputs.purchase_rows(spark, d)
    return last_staged(spark, lambda: stage(sequences.positions(rows, inputs.PURCHASE_ORDER), "tokens"))


def _greedy_walks(spark, d):
    return audience.build_walks(_transitions(spark, d), CFG, strategy="greedy")


@query
def purchase_sequences(spark, d):
    return sequences.positions(inputs.purchase_rows(spark, d), inputs.PURCHASE_ORDER)


@query
def skipgram_pairs(spark, d):
    return sequences.skipgram_pairs(_tokens(spark, d), CFG.window)


@query
def cbow_rows(spark, d):
    rows = sequences.cbow_rows(_tokens(spark, d), CFG.window)
    return rows.withColumn("context", F.array_join("context", ",", "-"))


@query
def walk_pairs(spark, d):
    rows = _greedy_walks(spark, d).select(
        F.col("walk_id").alias("seq_id"), F.col("nodes").alias("tokens")
    )
    return sequences.pairs_from_arrays(sequences.long_enough(rows), CFG.window)


@query
def token_ranks(spark, d):
    return sequences.token_ranks(_tokens(spark, d))


@query
def huffman_codes(spark, d):
    """Each token's code and inner nodes in the tree of the hierarchical softmax."""
    codes = tree_softmax.tree_codes(stage(sequences.token_ranks(_tokens(spark, d)), "ranks"))
    return codes.select(
        "token", "n", "rank", F.array_join(F.col("code").cast("array<string>"), "").alias("code"), F.array_join(F.col("path").cast("array<string>"), ",").alias("path")
    )


@query
def negatives(spark, d):
    tokens = _tokens(spark, d)
    size = sequences.token_ranks(tokens).agg(F.count("*")).scalar()
    pairs = sequences.skipgram_pairs(tokens, CFG.window)
    key = ["seq_id", "center_pos", "context_pos"]
    return sequences.negatives(pairs, key, size, 5, CFG.seed)


# --- side information -------------------------------------------------------


def _known_items(spark, d):
    """Parts that some member selected."""
    chosen = selected_records(spark, d).select(F.col("item_id").alias("gds")).distinct()
    return stage(inputs.side_information(spark, d).join(chosen, "gds", "left_semi"), "items")


def _vocabulary(items):
    return stage(vocab.build_vocabulary(items), "vocabulary")


def _published_codes(encoded):
    return encoded.withColumn("sal_idx", F.array_join("sal_idx", "|"))


@query
def side_vocab(spark, d):
    return vocab.build_vocabulary(inputs.side_information(spark, d))


@query
def side_cardinality(spark, d):
    return vocab.cardinalities(vocab.build_vocabulary(inputs.side_information(spark, d)))


@query
def side_encode(spark, d):
    items = inputs.side_information(spark, d)
    return _published_codes(vocab.encode(items, _vocabulary(items)))


@query
def side_encode_rejects(spark, d):
    known = _known_items(spark, d)
    rejects = vocab.encode_rejects(inputs.side_information(spark, d), _vocabulary(known))
    return _published_codes(rejects)


def _cold(spark, d, known, vocabulary, **options):
    count = known.agg(F.count("*")).scalar()
    return vocab.encode_cold(inputs.side_information(spark, d), vocabulary, count, **options)


@query
def side_encode_cold(spark, d):
    known = _known_items(spark, d)
    return _published_codes(_cold(spark, d, known, _vocabulary(known)))


@query
def side_encode_cold_index0(spark, d):
    known = _known_items(spark, d)
    return _published_codes(_cold(spark, d, known, _vocabulary(known), index0_is_oov=True))


@query
def vocabulary_size(spark, d):
    return readers.vocabulary_size(inputs.side_information(spark, d))


def _encoded(spark, d):
    items = inputs.side_information(spark, d)
    return stage(vocab.encode(items, _vocabulary(items)), "encoded")


@query
def pairs_with_side(spark, d):
    return _published_codes(sequences.pairs_with_side(_tokens(spark, d), _encoded(spark, d), CFG.window))


@query
def shuffle_batches(spark, d):
    pairs = sequences.skipgram_pairs(_tokens(spark, d), CFG.window)
    key = ["seq_id", "center_pos", "context_pos"]
    return sequences.shuffled_batches(pairs, key, CFG.seed, 100, epochs=2)


@query
def training_batches(spark, d):
    rows = sequences.training_batches(_tokens(spark, d), _encoded(spark, d), CFG.window, 100)
    return _published_codes(rows)


@query
def evaluation_batches(spark, d):
    rows = sequences.training_batches(_tokens(spark, d), _encoded(spark, d), CFG.window, 100, seed=None)
    return _published_codes(rows)


# --- item vectors -----------------------------------------------------------

SIZE = 16  # as in the SQL; queries without SQL have TRAINING.size


def _components(vectors, *keys):
    """One row per component, rounded."""
    return vectors.select(*keys, F.posexplode_outer(scalar.round_vector("vector")).alias("dim", "value"))


def _tables(vocabulary, items):
    return stage(embed.initial_tables(vocabulary, items.select("node"), SIZE, CFG.seed), "tables")


def _attention(spark, d):
    items = inputs.side_information(spark, d)
    vocabulary = _vocabulary(items)
    encoded = stage(vocab.encode(items, vocabulary), "encoded")
    return embed.attention_embed(encoded, _tables(vocabulary, items), SIZE)


def _mean(spark, d):
    known = _known_items(spark, d)
    vocabulary = _vocabulary(known)
    cold = stage(_cold(spark, d, known, vocabulary), "encoded")
    return embed.mean_embed(cold, _tables(vocabulary, known), SIZE)


@query
def attention_embed(spark, d):
    return _components(_attention(spark, d), "item_key")


@query
def coldstart_embed(spark, d):
    return _components(_mean(spark, d), "item_key")


@query
def attention_export(spark, d):
    return _components(embed.export_items(_attention(spark, d)), "item_key")


@query
def coldstart_export(spark, d):
    return _components(embed.export_items(_mean(spark, d)), "item_key")


@query
def normalize_vectors(spark, d):
    rows = inputs.vectors(spark, d)
    # Scaled by the label first, so that there is something to normalise.
    scaled = F.transform("vector", lambda x: x.cast("double") * F.col("seg_id"))
    return _components(embed.normalised(rows.withColumn("vector", scaled)), "id")


# --- similarity -------------------------------------------------------------

VECTOR_SIZE = 64


def _pairs_out(rows, *keys):
    return rows.select(*keys, "user1", "user2", F.round("distance", 6).alias("distance"))


def _one_segment(spark, d):
    return inputs.vectors(spark, d).withColumn("seg_id", F.lit(0))


@query
def similar_topk(spark, d):
    return _pairs_out(similar.similar_topk(inputs.vectors(spark, d), 10), "seg_id")


def _lsh(spark, d):
    return similar.similar_pairs(_one_segment(spark, d), VECTOR_SIZE, CFG.lsh_threshold)


@query
def similar_lsh(spark, d):
    return _pairs_out(_lsh(spark, d))


@query
def similar_ann(spark, d):
    return _pairs_out(similar.similar_ann(inputs.vectors(spark, d), VECTOR_SIZE, 10), "seg_id")


@query
def nearest_to_key(spark, d):
    key = [1.0 / 8.0] * VECTOR_SIZE
    rows = similar.nearest_to(inputs.vectors(spark, d), key, 10)
    return rows.withColumn("distance", F.round("distance", 6))


def _item_sets(spark, d):
    return _cleaned(spark, d).select(F.col("member_id").alias("id"), F.col("item_id").alias("element"))


SET_DISTANCE = 0.95  # a Jaccard similarity above 0.05
SET_TABLES = 45  # at the threshold a pair is met with probability 1 - 0.95^45 = 90 %


@query
def similar_minhash(spark, d):
    rows = similar.similar_sets(stage(_item_sets(spark, d), "sets"), SET_DISTANCE, tables=SET_TABLES)
    return _pairs_out(rows)


@query
def overlapping_sets(spark, d):
    """All pairs of different item sets below the distance, exactly; copies are in ``item_set_classes``."""
    pairs, _ = set_join.overlapping_sets(_item_sets(spark, d), SET_DISTANCE)
    return pairs.select("lo", "hi", "common", F.round("distance", 6).alias("distance"))


@query
def item_set_classes(spark, d):
    return set_join.set_classes(stage(_item_sets(spark, d), "sets"))


def _scored(spark, d):
    return similar.scored(_lsh(spark, d)).withColumn("score", F.round("score", 6))


@query
def result_table(spark, d):
    return similar.result_rows(_scored(spark, d))


@query
def cosine_scores(spark, d):
    rows = _lsh(spark, d)
    cosine = F.round(scalar.cosine_from_distance(F.col("distance")), 6)
    return rows.select("user1", "user2", cosine.alias("score"))


# --- functions --------------------------------------------------------------


@query
def md5_functions(spark, d):
    name = F.col("c_name")
    return inputs.table(spark, d, "customer").select(
        "c_custkey", scalar.md5_hex(name).alias("md5"), scalar.md5_hex16(name).alias("md5_16")
    )


@query
def date_functions(spark, d):
    day = F.col("o_orderdate")
    key = F.date_format(day, "yyyyMMdd")
    return inputs.table(spark, d, "orders").select(
        "o_orderkey",
        key.alias("date_key"),
        scalar.date_key_diff(F.lit("19950615"), key).alias("days"),
        scalar.date_key_add(key, 40).alias("later"),
        scalar.next_sunday(day).alias("week_end"),
    )


@query
def minute_functions(spark, d):
    return inputs.table(spark, d, "events").select(
        "event_id",
        scalar.minute_of_day(F.col("ts")).alias("minute"),
        scalar.minute_of_day(F.col("ts"), hour12=True).alias("minute12"),
    )


@query
def sql_function_scores(spark, d):
    sql_functions.register_sql_functions(spark)
    view = "walkvec_pairs"
    writers.register_view(_pairs_out(_lsh(spark, d)), view)
    return spark.sql(
        f"""SELECT user1, user2, round(getScore(distance), 6) AS score,
                   md5Handle(CAST(user1 AS STRING)) AS user1_md5, tpId() AS tp, eMode() AS emode
            FROM {view} WHERE user1 <> user2"""
    )


# --- files: written by Spark from the tables, then read back ----------------


@query
def interaction_log_scan(spark, d):
    path = stage_path(spark, "log")
    line = F.concat_ws(" ", F.concat(F.lit('"'), "member_id", F.lit('"')), "item_id", "rating", "vip")
    inputs.interactions(spark, d).select(line.alias("value")).write.text(path)
    return interactions.clean(readers.read_interaction_log(spark, path), CFG.rating_min)


@query
def selected_records_files(spark, d):
    path = stage_path(spark, "records")
    writers.write_selected_records(selected_records(spark, d), path)
    return readers.read_selected_records(spark, path)


@query
def node_index_files(spark, d):
    path = stage_path(spark, "nodes")
    writers.write_node_index(node_index(spark, d), path)
    return readers.read_node_index(spark, path)


@query
def walk_files(spark, d):
    path = stage_path(spark, "walks")
    writers.write_walks(_greedy_walks(spark, d), path)
    rows = readers.read_walks(spark, path)
    return rows.select("seg_id", F.array_join("nodes", " ").alias("nodes"))


@query
def sequence_files(spark, d):
    path = stage_path(spark, "walks")
    writers.write_walks(_greedy_walks(spark, d), path)
    rows = readers.read_sequences(spark, path)
    return rows.select(F.array_join("tokens", " ").alias("tokens"))


@query
def edge_list_files(spark, d):
    path = stage_path(spark, "edges")
    line = F.concat_ws(" ", "lo", "hi", graph.published_weight()).alias("value")
    edges = graph.member_edges(_records(spark, d)).select("seg_id", line)
    edges.write.partitionBy("seg_id").text(path)
    directed = graph.edges_from_list(readers.read_edge_list(spark, path))
    return directed.select("seg_id", "src", "dst", graph.published_weight().alias("weight"))


@query
def side_information_files(spark, d):
    path = stage_path(spark, "side")
    columns = ["node", *vocab.SINGLE, F.array_join(vocab.MULTI, "|")]
    inputs.side_information(spark, d).select(F.concat_ws(" ", *columns).alias("value")).write.text(path)
    rows = readers.read_side_information(spark, path)
    return rows.withColumn("sal", F.array_join("sal", "|"))


@query
def recommendation_files(spark, d):
    root = stage_path(spark, "rec")
    rows = similar.scored(similar.similar_topk(inputs.vectors(spark, d), 5))
    line = F.concat_ws("\t", "user1", "user2", F.round("score", 6))
    rows.select(line.alias("value"), F.col("seg_id").alias("rec")).write.partitionBy("rec").text(root)
    return similar.result_rows(readers.read_recommendations(spark, root, "rec="))


@query
def embedding_files(spark, d):
    path = stage_path(spark, "embeddings")
    named = embed.normalised(inputs.vectors(spark, d)).withColumn("member_id", F.col("id").cast("string"))
    writers.write_embeddings(named, path)
    rows = readers.read_embeddings(spark, path)
    return _components(rows, "seg_id", "member_id")


# --- training (no SQL equivalent) -------------------------------------------


def _origin(spark, d):
    return audience.process_origin(inputs.interactions(spark, d), inputs.member_base(spark, d), CFG)


@query
def member_vectors(spark, d):
    """The whole job up to named member vectors."""
    return audience.member_vectors(_origin(spark, d), CFG)


@query
def member_vectors_distributed(spark, d):
    """Which members have vectors, their length and norm, after a whole training."""
    rows = member_vectors(spark, d)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    return rows.select("seg_id", "member_id", F.size("vector").alias("size"), F.round(norm, 6).alias("norm"))


TRAINING = train.Training(size=160, epochs=1)
STARTING = train.Training(size=SIZE)


def _side_training(spark, d):
    tokens = _tokens(spark, d)
    encoded = _encoded(spark, d)
    return audience.train_side_vectors(tokens, encoded, CFG.window, TRAINING)


@query
def side_training(spark, d):
    """Mean loss before and after training."""
    fit = _side_training(spark, d)
    before = train.evaluate(fit.examples, fit.ranks, fit.initial, TRAINING)
    after = train.evaluate(fit.examples, fit.ranks, fit.params, TRAINING)
    named = [r.withColumn("stage", F.lit(n)) for r, n in ((before, "before"), (after, "after"))]
    return named[0].unionByName(named[1])


def _side_start(spark, d):
    """Examples, ranks and starting parameters of the side training."""
    tokens, encoded = _tokens(spark, d), _encoded(spark, d)
    ranks = stage(sequences.token_ranks(tokens), "ranks")
    references = train.side_references(encoded)
    examples = train.sequence_examples(tokens, references, ranks, CFG.window, STARTING)
    return examples, ranks, train.initial_parameters(references, ranks, STARTING)


@query
def side_initial_loss(spark, d):
    """Number of examples, and their mean loss at the starting parameters."""
    rows = train.evaluate(*_side_start(spark, d), STARTING)
    return rows.select("examples", F.round("mean_loss", 6).alias("mean_loss"))


@query
def side_first_round(spark, d):
    """Every parameter after the first round of training."""
    params = train.parameter_tables(train.first_round(*_side_start(spark, d), STARTING))
    return _components(params.withColumnRenamed("vec", "vector"), "tbl", "row_id")


@query
def side_vectors(spark, d):
    """Trained item vectors."""
    fit = _side_training(spark, d)
    tables = train.parameter_tables(fit.params)
    return embed.export_items(embed.attention_embed(_encoded(spark, d), tables, TRAINING.size))


# --- more file and table ends -----------------------------------------------


def _table_name(spark, label):
    return stage_path(spark, label).rsplit("/", 1)[1].replace("-", "_")


@query
def member_base_partition(spark, d):
    """Two dates of a base table; the second, in which every age group is renamed, is read."""
    name = _table_name(spark, "member_base")
    base = inputs.member_base(spark, d)
    renamed = base.withColumn("age_group", F.concat("age_group", F.lit(" later")))
    days = base.withColumn("statis_date", F.lit("20260101")).unionByName(
        renamed.withColumn("statis_date", F.lit("20260102"))
    )
    days.write.partitionBy("statis_date").format("parquet").saveAsTable(name)
    return readers.read_member_base(spark, name, "20260102")


def _result_in_table(spark, d, write_again):
    name = _table_name(spark, "result")
    # The names of a row are hashes of its numbers: only the numbers are kept for the three writes.
    rows = similar.result_rows(stage(_scored(spark, d), "scored"))
    writers.append_result(rows, name, "20260101")
    writers.append_result(rows, name, "20260102")
    write_again(rows, name, "20260102")
    return spark.table(name)


@query
def result_table_appended(spark, d):
    """The second date is added to, so it holds every row twice."""
    return _result_in_table(spark, d, writers.append_result)


@query
def result_table_overwritten(spark, d):
    """The second date is replaced by the rows with a score above 0; the first stays."""
    return _result_in_table(
        spark, d, lambda rows, name, dt: writers.overwrite_result(rows.where("score > 0"), name, dt)
    )


@query
def csv_files(spark, d):
    path = stage_path(spark, "csv")
    writers.write_csv(selected_records(spark, d), path)
    return spark.read.option("header", True).schema("member_id string, item_id string, share double").csv(path)


@query
def vector_text_files(spark, d):
    """Word-vector text read back: the header line and one row per component."""
    path = stage_path(spark, "vectors")
    rows = inputs.vectors(spark, d).select(F.col("id").cast("string").alias("token"), scalar.round_vector("vector").alias("vector"))
    writers.write_vector_text(rows, path, VECTOR_SIZE)
    f = F.split("value", " ")
    header = spark.read.text(f"{path}/header").select(
        F.lit("header").alias("token"), F.get(f, 1).cast("int").alias("dim"), F.get(f, 0).cast("double").alias("value")
    )
    lines = spark.read.text(f"{path}/vectors").select(
        F.get(f, 0).alias("token"), F.posexplode(F.slice(f, 2, VECTOR_SIZE)).alias("dim", "value")
    )
    return header.unionByName(lines.withColumn("value", F.col("value").cast("double")))


@query
def item_vector_files(spark, d):
    path = stage_path(spark, "item_vectors")
    writers.write_item_vectors(embed.export_items(_attention(spark, d)), path)
    return _components(spark.read.parquet(path), "item_key")


@query
def vocabulary_files(spark, d):
    path = stage_path(spark, "vocabulary")
    writers.write_vocabulary(vocab.build_vocabulary(inputs.side_information(spark, d)), path)
    return readers.read_vocabulary(spark, path)


@query
def few_record_files(spark, d):
    """Records written to three files: how many files there are, and rows in all."""
    path = stage_path(spark, "records")
    writers.write_selected_records(selected_records(spark, d), path, files=3)
    lines = spark.read.text(path).select(F.input_file_name().alias("file"))
    return lines.agg(F.countDistinct("file").alias("files"), F.count("*").alias("records"))


@query
def drop_exact_items(spark, d):
    """Records without the (segment, item) groups of exactly two members."""
    return graph.drop_items_of_size(_records(spark, d), 2)


@query
def day_keys(spark, d):
    """Orders with the days from their date to today's key: both ends of the key functions."""
    today = scalar.today_key()
    days = scalar.date_key_diff(F.date_format("o_orderdate", "yyyyMMdd"), today)
    back = scalar.date_key_add(today, -days)
    return inputs.table(spark, d, "orders").select("o_orderkey", back.alias("date_key"))


def _with_bad_lines(lines, key, bad):
    """Every tenth line in a form that does not parse."""
    return lines.select(F.when(F.pmod(F.col(key).cast("bigint"), F.lit(10)) == 0, bad).otherwise(F.col("value")).alias("value"))


def _rejected(spark, label, rows, line, key, bad, read):
    path = stage_path(spark, label)
    lines = rows.withColumn("value", line)
    _with_bad_lines(lines, key, bad).write.text(path)
    return read(spark, path)


@query
def log_rejects(spark, d):
    line = F.concat_ws(" ", "member_id", "item_id", "rating", "vip")
    bad = F.concat_ws(" ", "member_id", "item_id", F.lit("much"), "vip")
    rows = inputs.interactions(spark, d)
    return _rejected(spark, "log", rows, line, "item_id", bad, readers.interaction_log_rejects)


@query
def record_rejects(spark, d):
    rows = selected_records(spark, d)
    line = F.concat_ws(",", "member_id", "item_id", "share")
    bad = F.concat_ws(",", "member_id", "item_id")
    return _rejected(spark, "records", rows, line, "item_id", bad, readers.selected_record_rejects)


@query
def node_rejects(spark, d):
    line = F.concat_ws("\t", "member_id", "node_id", "seg_id")
    bad = F.concat_ws("\t", "member_id", F.lit("x"), "seg_id")
    return _rejected(spark, "nodes", node_index(spark, d), line, "member_id", bad, readers.node_index_rejects)


@query
def token_line_rejects(spark, d):
    """Lines of walks and of sequences with something that is no number."""
    rows = inputs.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    line = F.concat_ws(" ", "l_partkey", "l_suppkey")
    bad = F.concat_ws(" ", "l_partkey", F.lit("x"), "l_orderkey")
    walk = _rejected(spark, "walks", rows, line, "l_orderkey", bad, readers.walk_rejects)
    sequence = _rejected(spark, "sequences", rows, line, "l_orderkey", bad, readers.sequence_rejects)
    return walk.withColumn("kind", F.lit("walk")).unionByName(sequence.withColumn("kind", F.lit("sequence")))


@query
def edge_rejects(spark, d):
    rows = inputs.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    line = F.concat_ws(" ", "l_partkey", "l_suppkey", "l_quantity")
    bad = F.concat_ws(" ", "l_partkey", "l_suppkey")
    return _rejected(spark, "edges", rows, line, "l_orderkey", bad, readers.edge_list_rejects)


@query
def side_rejects(spark, d):
    rows = inputs.side_information(spark, d)
    line = F.concat_ws(" ", "node", *vocab.SINGLE, F.array_join(vocab.MULTI, "|"))
    bad = F.concat_ws(" ", "node", "gds")
    return _rejected(spark, "side", rows, line, "node", bad, readers.side_information_rejects)


@query
def embedding_rejects(spark, d):
    rows = inputs.vectors(spark, d)
    line = F.concat_ws("\t", "id", F.array_join("vector", ","))
    bad = F.concat_ws("\t", "id", F.lit("1.0,x"))
    return _rejected(spark, "embeddings", rows, line, "id", bad, readers.embedding_rejects)


@query
def recommendation_line_rejects(spark, d):
    rows = inputs.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_discount")
    line = F.concat_ws("\t", "l_partkey", "l_suppkey", "l_discount")
    bad = F.concat_ws("\t", "l_partkey", "l_suppkey")
    root = stage_path(spark, "rec")
    lines = _with_bad_lines(rows.withColumn("value", line), "l_orderkey", bad)
    lines.write.text(f"{root}/rec_0")
    return readers.recommendation_rejects(spark, root)


@query
def equal_lines(spark, d):
    """Sequences and items written twice: every line is one of its own."""
    path = stage_path(spark, "sequences")
    lines = inputs.table(spark, d, "lineitem").select(F.concat_ws(" ", "l_partkey", "l_suppkey").alias("value"))
    lines.unionByName(lines).write.text(path)
    rows = readers.read_sequences(spark, path)
    items = inputs.side_information(spark, d)
    twice = vocab.encode(items.unionByName(items), _vocabulary(items))
    return rows.agg(
        F.lit("sequences").alias("kind"), F.count("*").alias("rows"), F.countDistinct("seq_id").alias("ids"), F.sum(F.size("tokens")).alias("tokens")
    ).unionByName(
        twice.agg(
            F.lit("items").alias("kind"), F.count("*").alias("rows"), F.countDistinct("node").alias("ids"), F.sum(F.size("sal_idx")).alias("tokens")
        )
    )
