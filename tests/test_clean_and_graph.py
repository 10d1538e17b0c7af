import random
from collections import defaultdict

import pytest
from conftest import rows

from walkvec.config import Config
from walkvec.operators import graph, interactions, segments, skew
from walkvec.operators.cells import join_pairs
from walkvec.operators.dense_index import dense_index
from walkvec.plans import audience
from walkvec.sources import readers

LOG = """u1 i1 0.5 1
u1 i1 0.7 1
u1 i2 0.3 0
u1 i3 0.00004 1
"u2" i1 0.6 1 x
u2 i2 0.8 1
u3 i2 0.2 1 a b
u3 i1 0.4 2
bad line
u8 i8 abc 1
 u9 i9 0.5 0
"""


@pytest.fixture(scope="module")
def log_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "log.txt"
    path.write_text(LOG)
    return str(path)


def test_parse_and_clean(spark, log_path):
    cleaned = interactions.clean(readers.read_interaction_log(spark, log_path), 0.00005)
    assert rows(cleaned, "member_id", "item_id", "rating") == [
        ("u1", "i1", 0.7), ("u2", "i1", 0.6), ("u2", "i2", 0.8), ("u3", "i2", 0.2),
    ]
    rejected = [r.value for r in readers.interaction_log_rejects(spark, log_path).collect()]
    assert sorted(rejected) == ["bad line", "u3 i1 0.4 2", "u8 i8 abc 1"]


def _fixture_edges(spark, log_path):
    cfg = Config()
    selected = audience.selected_records(readers.read_interaction_log(spark, log_path), cfg)
    base = spark.createDataFrame([], "memb_id string, gender_cd string, age_group string")
    segmented = segments.assign_segments(
        interactions.member_history(selected), base, cfg.segment_labels, cfg.segment_aliases
    )
    nodes = segments.node_index(segmented)
    records = graph.node_records(selected, nodes)
    return selected, nodes, records


def test_log_to_transitions(spark, log_path):
    selected, nodes, records = _fixture_edges(spark, log_path)
    assert rows(selected) == [
        ("u1", "i1", 1.0), ("u2", "i1", 0.36), ("u2", "i2", 0.64), ("u3", "i2", 1.0),
    ]
    assert rows(nodes) == [("u1", 0, 7), ("u2", 1, 7), ("u3", 2, 7)]
    edges = graph.both_directions(graph.member_edges(records))
    weighted = edges.select("src", "dst", graph.published_weight().alias("w"))
    assert rows(weighted) == [(0, 1, 0.36), (1, 0, 0.36), (1, 2, 0.64), (2, 1, 0.64)]
    trans = graph.transitions(edges, 100, graph.weighted_degree_of_records(records))
    assert rows(trans, "src", "dst", "prob") == [
        (0, 1, 1.0), (1, 0, 0.36), (1, 2, 0.64), (2, 1, 1.0),
    ]


def test_hot_item_is_dropped(spark, log_path):
    log = readers.read_interaction_log(spark, log_path)
    extra = spark.createDataFrame([("u3", "i1", 0.4, 1)], log.schema)
    cleaned = interactions.clean(log.union(extra), 0.00005)
    assert rows(interactions.hot_items(cleaned, 2)) == [("i1", 3)]
    left = interactions.drop_hot_items(cleaned, 2)
    assert rows(left, "member_id", "item_id") == [("u2", "i2"), ("u3", "i2")]


def test_segments_alias_unknown_and_duplicates(spark):
    members = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "member_id string")
    base = spark.createDataFrame(
        [
            ("a", "124000000010", "60q", "20200101"),
            ("b", "x", "05h", "20200101"),
            ("c", None, "zzz", "20200101"),
            ("c", None, "70h", "20191231"),
            ("a", "124000000010", "80h", "20200101"),
        ],
        "memb_id string, gender_cd string, age_group string, statis_date string",
    )
    cfg = Config()
    args = (members, base, cfg.segment_labels, cfg.segment_aliases, "20200101")
    assert rows(segments.assign_segments(*args)) == [
        ("a", "60q", "124000000010", 0), ("b", "00h", "-", 6), ("c", "-", "-", 7), ("d", "-", "-", 7),
    ]
    assert segments.assign_segments(*args, dedupe_base=False).count() == 5


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize("partitions", ["1", "4", "13"])
def test_dense_index_is_the_rank(spark, many, partitions):
    rng = random.Random(3)
    data = [(rng.choice("aaaaaab"), i) for i in rng.sample(range(10_000), 500)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(data, "g string, v int")
        got = rows(dense_index(df, ["g"], ["v"], many_groups=many))
        whole = rows(dense_index(df, [], ["v"], many_groups=many), "v", "idx")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = defaultdict(list)
    for g, v in sorted(data):
        groups[g].append(v)
    assert got == sorted((g, v, i) for g, vs in groups.items() for i, v in enumerate(vs))
    assert whole == list(zip(sorted(v for _, v in data), range(len(data))))


def _random_records(spark, members=60, items=12, seed=1):
    rng = random.Random(seed)
    # One item is held by most members.
    data = [(0, "hot", m, rng.randint(1, 100)) for m in range(members) if m % 5]
    data += [
        (0, f"i{i}", m, rng.randint(1, 100)) for i in range(items) for m in rng.sample(range(members), 4)
    ]
    return data, spark.createDataFrame(data, "seg_id int, item_id string, node_id bigint, share_units bigint")


def _brute_edges(data):
    by_item = defaultdict(list)
    for _, item, m, s in data:
        by_item[item].append((m, s))
    out = defaultdict(int)
    for held in by_item.values():
        for a, s in held:
            for b, t in held:
                if a < b:
                    out[a, b] += s * t
    return out


@pytest.mark.parametrize("block_rows", [1, 5, 1000])
def test_edges_do_not_depend_on_the_splitting(spark, block_rows):
    data, records = _random_records(spark)
    got = {(r.lo, r.hi): r.units for r in graph.member_edges(records, block_rows).collect()}
    assert got == _brute_edges(data)


def test_join_pairs_keeps_values_with_their_row(spark):
    df = spark.createDataFrame([("g", i, i * 10) for i in range(9)], "g string, id int, v int")
    got = rows(join_pairs(df, ["g"], "id", ["v"], block_rows=2))
    assert got == [("g", a, b, a * 10, b * 10) for a in range(9) for b in range(a + 1, 9)]


def test_degree_without_pairs_equals_degree_of_edges(spark):
    data, records = _random_records(spark)
    lonely = spark.createDataFrame([(0, "solo", 999, 7)], records.schema)
    records = records.union(lonely)
    edges = graph.both_directions(graph.member_edges(records))
    assert rows(graph.weighted_degree_of_records(records)) == rows(graph.weighted_degree(edges))


def test_items_of_exact_size(spark):
    data = [(0, f"n{n}", 10_000 * n + m, 1) for n in (9, 10, 11) for m in range(n)]
    records = spark.createDataFrame(data, "seg_id int, item_id string, node_id bigint, share_units bigint")
    assert graph.member_edges(records).count() == 36 + 45 + 55
    kept = graph.drop_items_of_size(records, 10)
    assert graph.member_edges(kept).count() == 36 + 55


def test_symmetric_pairs(spark):
    df = spark.createDataFrame([("u", "a", 2.0), ("u", "b", 3.0)], "member_id string, item_id string, v double")
    assert rows(interactions.symmetric_item_pairs(df, "v")) == [("u", "a", "b", 6.0), ("u", "b", "a", 6.0)]


@pytest.mark.parametrize("hot_rows", [3, 1_000])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_equals_a_join(spark, hot_rows, how):
    data = [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(200)] + [(500, None), (501, "absent")]
    data += [(600 + i, "hot_absent") for i in range(50)]
    big = spark.createDataFrame(data, "id int, k string")
    small = spark.createDataFrame([("hot", 1.0), ("k0", 2.0), ("k3", 3.0)], "k string, v double")
    got = rows(skew.lookup(big, small, ["k"], "id", how, hot_rows).select("id", "v").fillna(-1.0))
    want = rows(big.join(small, "k", how).select("id", "v").fillna(-1.0))
    assert got == want


def test_none_means_no_cut(spark):
    from walkvec.operators import graph, interactions

    cleaned = spark.createDataFrame([("u", f"i{k}", float(k + 1)) for k in range(30)], "member_id string, item_id string, rating double")
    assert interactions.select_items(cleaned, 10).count() == 10
    assert interactions.select_items(cleaned, None).count() == 30
    edges = spark.createDataFrame([(0, 0, d, d) for d in range(1, 150)], "seg_id int, src bigint, dst bigint, units bigint")
    assert graph.transitions(edges, 100).count() == 100
    whole = graph.transitions(edges, None)
    assert whole.count() == 149 and abs(whole.agg({"prob": "sum"}).first()[0] - 1) < 1e-9


def test_a_hot_item_is_spread(spark, monkeypatch):
    from walkvec.operators import graph, skew

    monkeypatch.setattr(skew, "HOT_PARTS", 4)
    rows = [(0, "hot", n, 10 + n % 3) for n in range(60)] + [(0, f"i{n % 7}", n, 5) for n in range(60)]
    records = spark.createDataFrame(rows, "seg_id int, item_id string, node_id bigint, share_units bigint")
    real = skew.lookup
    monkeypatch.setattr(graph, "lookup", lambda *a, **k: real(*a, **(k | {"hot_rows": 5})))
    got = {(r.node_id): r.degree_units for r in graph.weighted_degree_of_records(records).collect()}
    want = {r.node_id: r.degree_units for r in graph.weighted_degree(graph.both_directions(graph.member_edges(records))).collect()}
    assert got == want
    assert graph.drop_items_of_size(records, 60).where("item_id = 'hot'").count() == 0
    assert graph.drop_items_of_size(records, 60).count() == 60
