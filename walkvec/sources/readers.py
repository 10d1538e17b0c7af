"""Readers. Text is split in the JVM; rows that do not parse are kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkvec.operators.vocab import MULTI, SINGLE
from walkvec.stage import stage


def _fields(column: str = "value", pattern: str = "\\s+"):
    return F.split(F.trim(F.col(column)), pattern)


def _parsed_log(spark: SparkSession, path: str) -> DataFrame:
    cleaned = F.regexp_replace(F.trim(F.replace("value", F.lit('"'), F.lit(""))), "\\s+", " ")
    f = F.col("f")
    vip = F.when(F.get(f, 3) == "1", 1).when(F.get(f, 3) == "0", 0)
    ok = F.size(f).between(4, 6) & F.col("rating").isNotNull() & F.col("vip").isNotNull()
    return (
        spark.read.text(path)
        .withColumn("f", F.split(cleaned, " "))
        .select(
            "value",
            "f",
            F.get(f, 0).alias("member_id"),
            F.get(f, 1).alias("item_id"),
            F.get(f, 2).try_cast("double").alias("rating"),
            vip.alias("vip"),
        )
        .withColumn("_ok", F.coalesce(ok, F.lit(False)))
    )


def read_interaction_log(spark: SparkSession, path: str) -> DataFrame:
    """``user item rating vip [x [y]]`` lines, quotes ignored."""
    return _parsed_log(spark, path).where("_ok").select("member_id", "item_id", "rating", "vip")


def interaction_log_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines :func:`read_interaction_log` leaves out."""
    return _parsed_log(spark, path).where("NOT _ok").select("value")


RECORDS = (("member_id", "string"), ("item_id", "string"), ("share", "double"))
NODES = (("member_id", "string"), ("node_id", "bigint"), ("seg_id", "int"))
RECOMMENDATIONS = (("user1", "string"), ("user2", "string"), ("score", "double"))
Paths = str | Sequence[str]


def _extra(rows: DataFrame) -> list[str]:
    """Columns that stem from the folders' names."""
    return [c for c in rows.columns if c != "value"]


def _delimited(spark: SparkSession, path: Paths, pattern: str, columns: Sequence[tuple[str, str]]):
    """Lines with their fields, and whether there are as many as columns and all of them parse."""
    rows = spark.read.text(path).withColumn("f", F.split("value", pattern, -1))
    typed = [F.get("f", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(columns)]
    ok = F.size("f") == len(columns)
    for name, _ in columns:
        ok = ok & F.col(name).isNotNull()
    return rows.select("value", "f", *typed).withColumn("_ok", F.coalesce(ok, F.lit(False)))


def _good(rows: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    return rows.where("_ok").select(*[name for name, _ in columns])


def _bad(rows: DataFrame) -> DataFrame:
    return rows.where("NOT _ok").select("value")


def read_selected_records(spark: SparkSession, path: str) -> DataFrame:
    return _good(_delimited(spark, path, ",", RECORDS), RECORDS)


def selected_record_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_delimited(spark, path, ",", RECORDS))


def read_node_index(spark: SparkSession, path: str) -> DataFrame:
    return _good(_delimited(spark, path, "\t", NODES), NODES)


def node_index_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_delimited(spark, path, "\t", NODES))


def recommendation_paths(spark: SparkSession, root: str, prefix: str = "rec_") -> list[str]:
    """The files or folders ``prefix``0, 1, 2, … that exist below ``root``; 0 must be there."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/{prefix}*")
    system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().toString() for s in (system.globStatus(pattern) or ())]
    numbered = [p for p in found if p.rsplit("/", 1)[1][len(prefix) :].isdigit()]
    if not any(p.endswith(f"/{prefix}0") for p in numbered):
        raise FileNotFoundError(f"{root}/{prefix}0")
    return sorted(numbered)


def read_recommendations(spark: SparkSession, root: str, prefix: str = "rec_") -> DataFrame:
    """``user1 \\t user2 \\t score`` files of all segments below ``root``."""
    paths = recommendation_paths(spark, root, prefix)
    return _good(_delimited(spark, paths, "\t", RECOMMENDATIONS), RECOMMENDATIONS)


def recommendation_rejects(spark: SparkSession, root: str, prefix: str = "rec_") -> DataFrame:
    return _bad(_delimited(spark, recommendation_paths(spark, root, prefix), "\t", RECOMMENDATIONS))


def _parsed_tokens(spark: SparkSession, path: str, kind: str) -> DataFrame:
    tokens = F.transform(_fields(), lambda x: x.try_cast(kind))
    rows = spark.read.text(path)
    return rows.withColumn("tokens", tokens).withColumn("_ok", ~F.exists("tokens", lambda x: x.isNull()))


def read_walks(spark: SparkSession, path: str) -> DataFrame:
    """Space-separated node ids per line: (seg_id if partitioned, nodes)."""
    rows = _parsed_tokens(spark, path, "bigint").where("_ok")
    return rows.select(*[c for c in _extra(rows) if c not in ("tokens", "_ok")], F.col("tokens").alias("nodes"))


def walk_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_parsed_tokens(spark, path, "bigint"))


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """Sequences of two or more integers, one per line: (seq_id, tokens).

    Every line has an id of its own, fixed when the lines are written down here.
    """
    rows = _parsed_tokens(spark, path, "int").where("_ok").where(F.size("tokens") > 1)
    numbered = rows.select(F.monotonically_increasing_id().cast("string").alias("seq_id"), "tokens")
    return stage(numbered, "sequences")


def sequence_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Lines with something else than integers; blank lines and single tokens are no sequences, but no errors."""
    return _bad(_parsed_tokens(spark, path, "int").where(F.length(F.trim("value")) > 0))


def _parsed_edges(spark: SparkSession, path: str) -> DataFrame:
    f = _fields()
    rows = spark.read.text(path)
    named = rows.select(
        "value",
        *_extra(rows),
        F.get(f, 0).try_cast("bigint").alias("src"),
        F.get(f, 1).try_cast("bigint").alias("dst"),
        F.get(f, 2).try_cast("double").alias("weight"),
    )
    return named.withColumn("_ok", F.expr("src IS NOT NULL AND dst IS NOT NULL AND weight IS NOT NULL"))


def read_edge_list(spark: SparkSession, path: str) -> DataFrame:
    """``a b weight`` lines: (src, dst, weight), with seg_id if partitioned by it."""
    return _parsed_edges(spark, path).where("_ok").drop("value", "_ok")


def edge_list_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_parsed_edges(spark, path))


def _parsed_side(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.text(path).select("value", _fields().alias("f"))
    node = F.get("f", 0).try_cast("int")
    ok = (F.size("f") >= len(SINGLE) + 2) & node.isNotNull()
    return rows.withColumn("node", node).withColumn("_ok", F.coalesce(ok, F.lit(False)))


def read_side_information(spark: SparkSession, path: str) -> DataFrame:
    """Nine blank-separated fields, the last one split on ``|``. A bad line does
    not end the file."""
    return _parsed_side(spark, path).where("_ok").select(
        "node",
        *[F.get("f", F.lit(i)).alias(name) for i, name in enumerate(SINGLE, start=1)],
        F.split(F.get("f", F.lit(len(SINGLE) + 1)), "[|]").alias(MULTI),
    )


def side_information_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _parsed_side(spark, path).where("NOT _ok").select("value")


def read_member_base(spark: SparkSession, table: str, statis_date: str) -> DataFrame:
    """One date of the member base table; only its partition is read."""
    return (
        spark.table(table)
        .where(F.col("statis_date") == statis_date)
        .select("memb_id", "gender_cd", "age_group")
    )


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature string, value string, idx bigint").parquet(path)


def vocabulary_size(items: DataFrame) -> DataFrame:
    """Number of items, counted from the data."""
    return items.agg(F.countDistinct("node").alias("vocab_size"))


def _parsed_embeddings(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t", -1)
    parts = F.transform(F.split(F.get(f, 1), ","), lambda x: x.try_cast("double"))
    vector = F.when(F.get(f, 1) != "", parts)
    rows = spark.read.text(path)
    ok = (F.size(f) == 2) & (vector.isNull() | ~F.exists(vector, lambda x: x.isNull()))
    named = rows.select("value", *_extra(rows), F.get(f, 0).alias("member_id"), vector.alias("vector"), ok.alias("_ok"))
    return named.withColumn("_ok", F.coalesce("_ok", F.lit(False)))


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``name \\t v,v,…`` lines: (member_id, vector); a name alone has a null vector."""
    return _parsed_embeddings(spark, path).where("_ok").drop("value", "_ok")


def embedding_rejects(spark: SparkSession, path: str) -> DataFrame:
    return _bad(_parsed_embeddings(spark, path))
