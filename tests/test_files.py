import pytest
from conftest import rows
from pyspark.sql import functions as F

from walkvec.operators import similar
from walkvec.sources import readers, writers
from walkvec.stage import stage, stage_root


def test_selected_records(spark, tmp_path):
    df = spark.createDataFrame([("u", "i", 0.12346), ("v", "j", 1.0)], "member_id string, item_id string, share double")
    writers.write_selected_records(df, str(tmp_path / "r"), files=1)
    (tmp_path / "r" / "extra.txt").write_text("too,few\na,b,c,d\nx,y,notanumber\n")
    assert rows(readers.read_selected_records(spark, str(tmp_path / "r"))) == rows(df)


def test_node_index(spark, tmp_path):
    df = spark.createDataFrame([("u", 5, 1)], "member_id string, node_id bigint, seg_id int")
    writers.write_node_index(df, str(tmp_path / "n"))
    assert rows(readers.read_node_index(spark, str(tmp_path / "n"))) == [("u", 5, 1)]


def test_walks_and_sequences(spark, tmp_path):
    df = spark.createDataFrame([(0, [1, 2, 3]), (2, [4]), (2, [5, 6])], "seg_id int, nodes array<bigint>")
    writers.write_walks(df, str(tmp_path / "w"), files=1)
    back = readers.read_walks(spark, str(tmp_path / "w"))
    assert rows(back, "seg_id", F.concat_ws(" ", "nodes")) == [(0, "1 2 3"), (2, "4"), (2, "5 6")]
    sequences = readers.read_sequences(spark, str(tmp_path / "w"))
    assert rows(sequences, F.concat_ws(" ", "tokens")) == [("1 2 3",), ("5 6",)]


def test_sequences_skip_blank_and_bad_lines(spark, tmp_path):
    (tmp_path / "s.txt").write_text("  1 2  \n\n7\n3 x\n8 9 10\n")
    got = readers.read_sequences(spark, str(tmp_path))
    assert rows(got, F.concat_ws(" ", "tokens")) == [("1 2",), ("8 9 10",)]


def test_embeddings_and_vector_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", [0.5, -1.25])], "seg_id int, member_id string, vector array<double>")
    writers.write_embeddings(df, str(tmp_path / "e"))
    assert rows(readers.read_embeddings(spark, str(tmp_path / "e"))) == [(1, "u", [0.5, -1.25])]
    writers.write_vector_text(df.withColumnRenamed("member_id", "token"), str(tmp_path / "v"), 2)
    assert spark.read.text(str(tmp_path / "v" / "header")).first().value == "1 2"
    assert spark.read.text(str(tmp_path / "v" / "vectors")).first().value == "u 0.5 -1.25"


def test_csv_with_header(spark, tmp_path):
    writers.write_csv(spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).collect()[0].asDict() == {"a": "1", "b": "x"}


def test_vocabulary_and_item_vectors(spark, tmp_path):
    df = spark.createDataFrame([("gds", "a", 0)], "feature string, value string, idx bigint")
    writers.write_vocabulary(df, str(tmp_path / "d"))
    assert rows(readers.read_vocabulary(spark, str(tmp_path / "d"))) == [("gds", "a", 0)]
    items = spark.createDataFrame([("g_s", [1.0])], "item_key string, vector array<double>")
    writers.write_item_vectors(items, str(tmp_path / "i"))
    assert rows(spark.read.parquet(str(tmp_path / "i"))) == [("g_s", [1.0])]


def test_recommendations_need_the_first_file_only(spark, tmp_path):
    (tmp_path / "rec_0").write_text("a\tb\t0.5\nbad line\n")
    (tmp_path / "rec_2").write_text("c\tc\t1.0\nc\td\t0.25\n")
    (tmp_path / "rec_39").write_text("e\tf\t0.5\n")
    (tmp_path / "rec_old").write_text("x\ty\t0.5\n")
    got = similar.result_rows(readers.read_recommendations(spark, str(tmp_path)))
    assert rows(got, "user1", "user2", "score") == [("a", "b", 0.5), ("c", "d", 0.25), ("e", "f", 0.5)]
    assert rows(readers.recommendation_rejects(spark, str(tmp_path))) == [("bad line",)]
    (tmp_path / "rec_0").unlink()
    with pytest.raises(FileNotFoundError):
        readers.read_recommendations(spark, str(tmp_path))


def test_rejects(spark, tmp_path):
    def lines(text):
        path = tmp_path / f"f{len(list(tmp_path.iterdir()))}"
        path.write_text(text)
        return spark, str(path)

    assert rows(readers.selected_record_rejects(*lines("a,b,0.5\na,b\na,b,x\n"))) == [("a,b",), ("a,b,x",)]
    assert rows(readers.node_index_rejects(*lines("m\t1\t2\nm\tx\t2\n"))) == [("m\tx\t2",)]
    assert rows(readers.edge_list_rejects(*lines("1 2 0.5\n1 b 0.5\n1 2\n"))) == [("1 2",), ("1 b 0.5",)]
    bad = lines("1 2 3\n4 x\n")
    assert rows(readers.walk_rejects(*bad)) == [("4 x",)]
    assert rows(readers.read_walks(*bad), F.concat_ws(" ", "nodes")) == [("1 2 3",)]
    assert rows(readers.sequence_rejects(*lines("1 2\n\n7\n3 x\n"))) == [("3 x",)]
    vectors = lines("u\t0.5,x\nv\nw\t1.0,2.0\n")
    assert rows(readers.embedding_rejects(*vectors)) == [("u\t0.5,x",), ("v",)]
    assert rows(readers.read_embeddings(*vectors)) == [("w", [1.0, 2.0])]


def test_equal_lines_are_sequences_of_their_own(spark, tmp_path):
    (tmp_path / "s.txt").write_text("1 2\n1 2\n1 2\n")
    got = readers.read_sequences(spark, str(tmp_path))
    assert got.select("seq_id").distinct().count() == got.count() == 3


def test_a_null_vector_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", None), (1, "v", [1.0])], "seg_id int, member_id string, vector array<double>")
    writers.write_embeddings(df, str(tmp_path / "e"))
    assert rows(readers.read_embeddings(spark, str(tmp_path / "e")), "member_id", F.size("vector")) == [("u", None), ("v", 1)]


def _result(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "user1 string, user2 string, score double")
    return similar.result_rows(df)


def test_result_table_append_and_overwrite(spark):
    table = "similar_pairs_test"

    def content():
        return rows(spark.table(table), "user1", "user2", "dt")

    writers.append_result(_result(spark, ("a", "b", 0.1)), table, "20200101")
    writers.append_result(_result(spark, ("c", "d", 0.2)), table, "20200101")
    writers.append_result(_result(spark, ("e", "f", 0.3)), table, "20200102")
    assert content() == [("a", "b", "20200101"), ("c", "d", "20200101"), ("e", "f", "20200102")]
    writers.overwrite_result(_result(spark, ("x", "y", 0.9)), table, "20200101")
    assert content() == [("e", "f", "20200102"), ("x", "y", "20200101")]
    spark.sql(f"DROP TABLE {table}")


def test_member_base_reads_one_partition(spark):
    df = spark.createDataFrame(
        [("m", "g", "60q", "20200101"), ("m", "g", "70h", "20200102")],
        "memb_id string, gender_cd string, age_group string, statis_date string",
    )
    df.write.partitionBy("statis_date").format("parquet").saveAsTable("member_base_test")
    got = readers.read_member_base(spark, "member_base_test", "20200102")
    assert rows(got) == [("m", "g", "70h")]
    assert "statis_date" in got._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    spark.sql("DROP TABLE member_base_test")


def test_stage_uses_the_configured_folder(spark):
    root = stage_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    df = stage(spark.range(3), "numbers")
    assert df.count() == 3 and df.inputFiles()[0].startswith("file://" + root)
