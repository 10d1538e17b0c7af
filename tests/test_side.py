import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from walkvec.functions.scalar import l2_normalise, softmax
from walkvec.operators import embed, vocab
from walkvec.sources import readers

ITEM = "node int, gds string, gen_gds string, l4 string, l3 string, l2 string, big_brand string, shop string, sal array<string>"
KNOWN = [
    (0, "g0", "n0", "a", "a", "a", "b0", "s0", ["x", "y"]),
    (1, "g1", "n1", "a", "b", "a", "b1", "s1", ["y"]),
]


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame(KNOWN, ITEM)


@pytest.fixture(scope="module")
def vocabulary(known):
    return vocab.build_vocabulary(known).persist()


def _cold(spark, *items, **options):
    df = spark.createDataFrame(list(items), ITEM)
    return lambda v: {r.item_key: r for r in vocab.encode_cold(df, v, 2, **options).collect()}


def test_vocabulary_in_value_order(vocabulary):
    got = rows(vocabulary.where("feature IN ('gds', 'sal', 'l3')"))
    assert got == [("gds", "g0", 0), ("gds", "g1", 1), ("l3", "a", 0), ("l3", "b", 1), ("sal", "x", 0), ("sal", "y", 1)]
    assert dict(rows(vocab.cardinalities(vocabulary)))["l4"] == 1


def test_strict_encoding_and_rejects(spark, known, vocabulary):
    other = spark.createDataFrame([(7, "g0", "n0", "a", "a", "a", "b0", "s0", ["x", "zz"])], ITEM)
    items = known.union(other)
    got = {r.node: r for r in vocab.encode(items, vocabulary).collect()}
    assert set(got) == {0, 1}
    assert got[0].item_key == "g0_s0" and got[0].sal_idx == [0, 1]
    assert [got[1][f"{f}_idx"] for f in vocab.SINGLE] == [1, 1, 0, 1, 0, 1, 1]
    assert [r.node for r in vocab.encode_rejects(items, vocabulary).collect()] == [7]


def test_cold_start_admission(spark, vocabulary):
    run = _cold(
        spark,
        (0, "new", "new", "a", "a", "a", "b0", "s0", ["x", "zz"]),
        (9, "g1", "n1", "a", "b", "a", "b1", "s1", ["y"]),
        (1, "g1", "n1", "a", "b", "a", "unknown", "s0", ["y"]),
        (1, "g1", "n1", "a", "b", "a", "b1", "s2", ["y"]),
        (1, "g0", "n1", "a", "b", "a", "b1", "s1", ["zz"]),
    )
    got = run(vocabulary)
    assert set(got) == {"new_s0", "g1_s1"}
    assert got["new_s0"].gds_idx is None and got["new_s0"].gen_gds_idx is None
    assert got["new_s0"].sal_idx == [0] and got["new_s0"].node == 0
    assert got["g1_s1"].node is None and got["g1_s1"].gds_idx == 1


def test_cold_start_index_zero_flag(spark, vocabulary):
    item = (0, "g0", "n0", "a", "a", "a", "b0", "s0", ["x"])
    assert set(_cold(spark, item)(vocabulary)) == {"g0_s0"}
    assert _cold(spark, item, index0_is_oov=True)(vocabulary) == {}


def test_bad_line_does_not_end_the_file(spark, tmp_path):
    path = tmp_path / "side.txt"
    path.write_text("0 g0 n0 a a a b0 s0 x|y\n\n1 g1 n1 a b a b1 s1 y\n")
    got = rows(readers.read_side_information(spark, str(path)), "node", "gds", F.concat_ws(",", "sal"))
    assert got == [(0, "g0", "x,y"), (1, "g1", "y")]
    assert readers.side_information_rejects(spark, str(path)).count() == 1


def test_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<float>")
    assert [r[0] for r in df.select(l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], None]


def test_softmax(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([math.log(3), 0.0],), ([1000.0, 1000.0],)], "v array<double>")
    got = [r[0] for r in df.select(softmax(F.col("v"))).collect()]
    assert got[0] == [0.5, 0.5] and got[1] == pytest.approx([0.75, 0.25]) and got[2] == [0.5, 0.5]


def _tables(spark, attention=None):
    """One-hot vectors per slot, so that a result shows the weight of each slot."""
    data = []
    for slot, f in enumerate(vocab.SLOTS):
        for row in (0, 1):
            vec = [0.0] * 8
            vec[slot] = 1.0 + row
            data.append((f, row, vec))
    for node in (0, 1):
        data.append((embed.ATTENTION, node, attention or [0.0] * 8))
    return spark.createDataFrame(data, "tbl string, row_id bigint, vec array<double>")


def test_attention(spark, known, vocabulary):
    encoded = vocab.encode(known, vocabulary)
    got = {r.item_key: r.vector for r in embed.attention_embed(encoded, _tables(spark), 8).collect()}
    # gds gen_gds shop l4 l3 l2 brand sal; the vector of value 1 is twice that of value 0
    assert got["g0_s0"] == pytest.approx([1 / 8] * 7 + [1.5 / 8])
    assert got["g1_s1"] == pytest.approx([x / 8 for x in (2, 2, 2, 1, 2, 1, 2, 2)])
    heavy = _tables(spark, [math.log(9.0)] + [0.0] * 7)
    got = {r.item_key: r.vector for r in embed.attention_embed(encoded, heavy, 8).collect()}
    assert got["g0_s0"][:2] == pytest.approx([9 / 16, 1 / 16])


def test_cold_start_mean(spark, vocabulary):
    df = spark.createDataFrame([(9, "new", "new", "a", "a", "a", "b0", "s0", ["x", "y"])], ITEM)
    cold = vocab.encode_cold(df, vocabulary, 2)
    got = embed.mean_embed(cold, _tables(spark), 8).first().vector
    assert got == pytest.approx([0, 0, 1 / 6, 1 / 6, 1 / 6, 1 / 6, 1 / 6, 1.5 / 6])
    unit = embed.export_items(embed.mean_embed(cold, _tables(spark), 8)).first()
    assert unit.item_key == "new_s0" and sum(x * x for x in unit.vector) == pytest.approx(1.0)


def test_names_drop_tokens_that_are_no_node(spark):
    vectors = spark.createDataFrame([(0, 1, [3.0, 4.0]), (0, -1, [1.0, 0.0])], "seg_id int, node_id bigint, vector array<double>")
    nodes = spark.createDataFrame([("u", 1, 0)], "member_id string, node_id bigint, seg_id int")
    assert [(r.member_id, r.vector) for r in embed.name_vectors(vectors, nodes).collect()] == [("u", [0.6, 0.8])]


def test_equal_rows_stay_items_of_their_own(spark, vocabulary):
    df = spark.createDataFrame([KNOWN[0], KNOWN[0], KNOWN[1]], ITEM)
    got = [tuple(r.sal_idx) for r in vocab.encode(df, vocabulary).collect()]
    assert sorted(got) == [(0, 1), (0, 1), (1,)]
    tables = spark.createDataFrame(
        [(f, i, [1.0, float(i)]) for f in vocab.FEATURES for i in (0, 1)], "tbl string, row_id bigint, vec array<double>"
    )
    mean = embed.mean_embed(vocab.encode(df, vocabulary), tables, 2).collect()
    assert len(mean) == 3 and all(abs(r.vector[0] - 1.0) < 1e-9 for r in mean)
