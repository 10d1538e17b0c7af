"""The registered queries as plain SQL over the same tables, for comparison."""

from __future__ import annotations

# Named steps; each statement pulls in the ones it needs, in this order.
_STEPS = {
    "inter": """
        SELECT CAST(o_custkey AS VARCHAR) AS member_id, CAST(l_partkey AS VARCHAR) AS item_id,
               l_quantity AS rating, CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS vip
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cleaned": """
        SELECT member_id, item_id, max(rating) AS rating FROM inter
        WHERE vip = 1 AND length(item_id) > 0
        GROUP BY member_id, item_id HAVING max(rating) >= 0.00005""",
    "hot": "SELECT item_id, count(*) AS users FROM cleaned GROUP BY item_id HAVING count(*) > 28",
    "kept": """
        SELECT * FROM cleaned WHERE item_id NOT IN (
            SELECT item_id FROM cleaned GROUP BY item_id HAVING count(*) > 10000)""",
    "ranked": """
        SELECT member_id, item_id, rating * rating AS w,
               row_number() OVER (PARTITION BY member_id ORDER BY rating * rating DESC, item_id) AS rn
        FROM kept""",
    "selected": """
        SELECT member_id, item_id,
               CAST(floor(w / sum(w) OVER (PARTITION BY member_id) * 100000 + 0.5) AS BIGINT) AS units
        FROM ranked WHERE rn <= 10""",
    "segmented": """
        SELECT member_id,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN c_mktsegment
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'FURNITURE' ELSE '-' END AS segment,
               CASE c_nationkey % 3 WHEN 0 THEN '124000000020' WHEN 1 THEN '124000000010'
                    ELSE '-' END AS gender,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1
                    WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 2 ELSE 3 END AS seg_id
        FROM (SELECT DISTINCT member_id FROM selected) m
        LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = member_id""",
    "nodes": """
        SELECT member_id, seg_id,
               row_number() OVER (PARTITION BY seg_id ORDER BY member_id) - 1 AS node_id
        FROM segmented""",
    "records": "SELECT seg_id, item_id, node_id, units FROM selected JOIN nodes USING (member_id)",
    "edges": """
        SELECT a.seg_id, a.node_id AS src, b.node_id AS dst,
               CAST(sum(a.units * b.units) AS BIGINT) AS units
        FROM records a JOIN records b
          ON a.seg_id = b.seg_id AND a.item_id = b.item_id AND a.node_id <> b.node_id
        GROUP BY 1, 2, 3""",
    "degree": """
        SELECT seg_id, src, CAST(sum(units) AS BIGINT) AS degree_units FROM edges GROUP BY 1, 2""",
    "strongest": """
        SELECT *, row_number() OVER (PARTITION BY seg_id, src ORDER BY units DESC, dst) AS rn
        FROM edges JOIN degree USING (seg_id, src)""",
}

_ADJACENCY = """
    SELECT seg_id, src, dst, units, degree_units,
           CAST(sum(units) OVER (PARTITION BY seg_id, src ORDER BY {order}
                                 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum,
           row_number() OVER (PARTITION BY seg_id, src ORDER BY {order}) AS place,
           CAST(sum(units) OVER (PARTITION BY seg_id, src) AS BIGINT) AS kept_units,
           count(*) OVER (PARTITION BY seg_id, src) AS n
    FROM strongest WHERE rn <= {top}"""


def _uniform(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 13))::BIGINT / 4503599627370496.0)"


def _with(
    last: str | None, body: str, extra: dict[str, str] | None = None, recursive: bool = False
) -> str:
    """``body`` after all steps up to ``last`` and the extra ones."""
    names = list(_STEPS)
    steps = {k: _STEPS[k] for k in (names[: names.index(last) + 1] if last else [])} | (extra or {})
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(f"{k} AS ({v})" for k, v in steps.items()) + "\n" + body


def _walks(
    strategy: str,
    steps: int,
    per_node: int,
    top: int = 100,
    leak: bool = False,
    seed: int = 42,
    sentinel: bool = False,
) -> tuple[dict[str, str], str]:
    """Steps and a statement for walks; dead walks carry -1 as the current node."""
    u = _uniform(f"'{seed}|' || w.walk_id || '|' || (w.step + 1)")
    total = "a.degree_units" if leak else "a.kept_units"
    if strategy == "weighted":
        pick = f"arg_min(a.dst, a.cum) FILTER (WHERE {u} * {total} < a.cum)"
    elif strategy == "greedy":
        pick = f"max(a.dst) FILTER (WHERE a.place = a.n AND {u} * {total} < a.kept_units)"
    else:
        pick = f"max(a.dst) FILTER (WHERE a.place = floor({u} * a.n) + 1)"
    order = "dst" if strategy == "uniform" else "units, dst"
    extra = {
        "adj": _ADJACENCY.format(order=order, top=top),
        "walk": f"""
            SELECT seg_id, seg_id || '|' || src || '|' || k AS walk_id, src AS cur,
                   0 AS step, CAST(src AS VARCHAR) AS nodes
            FROM (SELECT DISTINCT seg_id, src FROM adj), range(1, {per_node + 1}) r(k)
            UNION ALL
            SELECT seg_id, walk_id, nxt, step + 1,
                   CASE WHEN nxt = -1 AND {'FALSE' if sentinel else 'TRUE'} THEN nodes
                        ELSE nodes || ' ' || nxt END
            FROM (SELECT w.seg_id, w.walk_id, w.step, w.nodes, coalesce({pick}, -1) AS nxt
                  FROM walk w JOIN adj a ON a.seg_id = w.seg_id AND a.src = w.cur
                  WHERE w.step < {steps} GROUP BY ALL)""",
    }
    return extra, f"SELECT seg_id, walk_id, nodes FROM walk WHERE step = {steps}"


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    out["clean_interactions"] = _with("cleaned", "SELECT * FROM cleaned")
    out["item_users"] = _with(
        "cleaned", "SELECT item_id, count(*) AS users FROM cleaned GROUP BY item_id"
    )
    out["hot_items"] = _with("hot", "SELECT * FROM hot")
    out["drop_hot_items"] = _with(
        "hot", "SELECT * FROM cleaned WHERE item_id NOT IN (SELECT item_id FROM hot)"
    )
    out["selected_records"] = _with(
        "selected", "SELECT member_id, item_id, units / 100000.0 AS share FROM selected"
    )
    out["member_history"] = _with(
        "selected", "SELECT member_id, count(*) AS his_length FROM selected GROUP BY member_id"
    )
    out["item_pairs"] = _with(
        "selected",
        """SELECT a.member_id, a.item_id AS item_a, b.item_id AS item_b, a.units * b.units AS weight
           FROM selected a JOIN selected b USING (member_id) WHERE a.item_id <> b.item_id""",
    )
    out["segment_members"] = _with("segmented", "SELECT * FROM segmented")
    out["node_index"] = _with("nodes", "SELECT member_id, node_id, seg_id FROM nodes")
    out["user_graph"] = _with(
        "edges", "SELECT seg_id, src, dst, units / 1e10 AS weight FROM edges"
    )
    out["weighted_degree"] = _with(
        "degree", "SELECT seg_id, src AS node_id, degree_units / 1e10 AS degree FROM degree"
    )
    out["transitions"] = _with(
        "strongest",
        """SELECT seg_id, src, dst, round(units / degree_units, 9) AS prob
           FROM strongest WHERE rn <= 100""",
    )
    out["adjacency_lists"] = _with(
        "strongest",
        """SELECT seg_id, src AS node_id, count(*) AS n_neighbours,
                  string_agg(CAST(dst AS VARCHAR), ',' ORDER BY place) AS neighbours,
                  string_agg(CAST(cum AS VARCHAR), ',' ORDER BY place) AS running_units
           FROM adj GROUP BY 1, 2""",
        {"adj": _ADJACENCY.format(order="units, dst", top=10)},
    )
    for name, options in {
        "walks_weighted": dict(strategy="weighted", steps=10, per_node=10),
        "walks_greedy": dict(strategy="greedy", steps=10, per_node=10),
        "walks_greedy_leak": dict(
            strategy="greedy", steps=10, per_node=10, top=10, leak=True, sentinel=True
        ),
        "walks_weighted_leak": dict(strategy="weighted", steps=10, per_node=10, top=10, leak=True),
        "walks_uniform": dict(strategy="uniform", steps=10, per_node=10),
        "walks_single": dict(strategy="weighted", steps=7, per_node=1, seed=7),
    }.items():
        extra, body = _walks(**options)
        out[name] = _with("strongest", body, extra, recursive=True)
    extra, body = _walks("greedy", 10, 10)
    extra["visits"] = f"""
        SELECT seg_id, node, count(*) AS visits
        FROM (SELECT seg_id, unnest(string_split(nodes, ' ')) AS node FROM ({body})) GROUP BY 1, 2"""
    out["visit_histogram"] = _with(
        "strongest",
        "SELECT visits, count(*) AS vertices FROM visits GROUP BY visits",
        extra,
        recursive=True,
    )
    out |= _sequence_statements()
    out |= _side_statements()
    out |= _similarity_statements()
    out |= _function_statements()
    out |= _file_statements(out)
    out |= _more_file_statements(out)
    out |= _training_statements()
    out["member_vectors_distributed"] = _with(
        "edges",
        """SELECT DISTINCT nodes.seg_id, member_id, 128 AS size, 1.0 AS norm
           FROM nodes JOIN edges ON edges.seg_id = nodes.seg_id AND edges.src = nodes.node_id""",
    )
    return out


_TOKENS = """
    SELECT o_custkey AS seq_id, l_partkey AS token,
           row_number() OVER (PARTITION BY o_custkey
                              ORDER BY o_orderdate, l_orderkey, l_linenumber, l_partkey) - 1 AS pos
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _pairs(window: int, tokens: str = "tokens") -> str:
    """Both directions of every pair; positions have no gaps, so no join is needed."""
    ahead = ", ".join(f"lead(token, {d}) OVER w AS t{d}" for d in range(1, window + 1))
    both = [
        f"SELECT seq_id, {c} AS center_pos, {o} AS context_pos, {x} AS center, {y} AS context FROM near WHERE t{d} IS NOT NULL"
        for d in range(1, window + 1)
        for c, o, x, y in (("pos", f"pos + {d}", "token", f"t{d}"), (f"pos + {d}", "pos", f"t{d}", "token"))
    ]
    return f"""
        SELECT * FROM (WITH near AS MATERIALIZED (
            SELECT seq_id, pos, token, {ahead} FROM {tokens} WINDOW w AS (PARTITION BY seq_id ORDER BY pos))
        {" UNION ALL ".join(both)})"""


_PAIR_KEY = "seq_id || '|' || center_pos || '|' || context_pos"
_RANKS = """
    SELECT token, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS rank
    FROM tokens GROUP BY token"""


# Two nodes at a time from two queues, rarest first, leaves before merged nodes of equal weight.
# Nodes are numbered: leaves from 0, then inner nodes in the order in which they are made.
_MERGING = {
    "leaves": "SELECT list(n ORDER BY n, token DESC) AS lw, count(*) AS v FROM ranks",
    "merging": """
        SELECT 0 AS made, 0 AS i, 0 AS h, []::BIGINT[] AS mw, NULL::BIGINT AS c0, NULL::BIGINT AS c1
        UNION ALL
        SELECT made + 1, i2, h2, list_append(mw, w0 + w1), c0, c1
        FROM (
            SELECT *, i1 + CASE WHEN leaf1 THEN 1 ELSE 0 END AS i2, h1 + CASE WHEN leaf1 THEN 0 ELSE 1 END AS h2,
                   CASE WHEN leaf1 THEN lw[i1 + 1] ELSE mw[h1 + 1] END AS w1,
                   CASE WHEN leaf1 THEN i1 ELSE v + h1 END AS c1
            FROM (
                SELECT *, h1 >= len(mw) OR (i1 < v AND lw[i1 + 1] <= mw[h1 + 1]) AS leaf1
                FROM (
                    SELECT *, i + CASE WHEN leaf0 THEN 1 ELSE 0 END AS i1, h + CASE WHEN leaf0 THEN 0 ELSE 1 END AS h1,
                           CASE WHEN leaf0 THEN lw[i + 1] ELSE mw[h + 1] END AS w0,
                           CASE WHEN leaf0 THEN i ELSE v + h END AS c0
                    FROM (
                        SELECT made, i, h, mw, lw, v, h >= len(mw) OR (i < v AND lw[i + 1] <= mw[h + 1]) AS leaf0
                        FROM merging, leaves WHERE made < v - 1))))""",
    "children": """
        SELECT c0 AS child, made - 1 AS parent, '0' AS bit FROM merging WHERE made > 0
        UNION ALL SELECT c1, made - 1, '1' FROM merging WHERE made > 0""",
    "climbing": """
        SELECT v - 1 - rank AS leaf, v - 1 - rank AS node, '' AS code, '' AS path FROM ranks, leaves
        UNION ALL
        SELECT leaf, v + parent, bit || code, parent || CASE WHEN path = '' THEN '' ELSE ',' || path END
        FROM climbing, leaves, children WHERE child = node""",
}
_CODES = """
    SELECT token, n, rank, code, path FROM ranks, leaves, climbing
    WHERE leaf = v - 1 - rank AND node = CASE WHEN v = 1 THEN 0 ELSE 2 * v - 2 END"""


def _batched(source: str, order: str, epochs: int) -> dict[str, str]:
    return {
        "indexed": f"SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS idx FROM {source}",
        "total": "SELECT count(*) AS n FROM indexed",
        "placed": f"""
            SELECT indexed.*, epoch, (epoch * n + idx) // 100 AS batch_id, n
            FROM indexed, total, range(0, {epochs}) e(epoch)""",
        "batched": f"SELECT * EXCLUDE (n) FROM placed WHERE batch_id < (n * {epochs}) // 100",
    }


def _sequence_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    tokens = {"tokens": _TOKENS}
    out["purchase_sequences"] = _with(None, "SELECT seq_id, pos, token FROM tokens", tokens)
    out["skipgram_pairs"] = _with(None, _pairs(5), tokens)
    out["cbow_rows"] = _with(
        None,
        """SELECT seq_id, center_pos AS pos, center,
                  string_agg(CAST(context AS VARCHAR), ',' ORDER BY context_pos)
                  || repeat(',-', 10 - CAST(count(*) AS INTEGER)) AS context
           FROM pairs GROUP BY 1, 2, 3""",
        tokens | {"pairs": _pairs(5)},
    )
    extra, body = _walks("greedy", 10, 10)
    extra["walked"] = f"""
        SELECT walk_id AS seq_id, unnest(range(len(string_split(nodes, ' ')))) AS pos,
               CAST(unnest(string_split(nodes, ' ')) AS BIGINT) AS token FROM ({body})"""
    out["walk_pairs"] = _with("strongest", _pairs(5, "walked"), extra, recursive=True)
    out["token_ranks"] = _with(None, _RANKS, tokens)
    out["huffman_codes"] = _with(None, _CODES, tokens | {"ranks": _RANKS} | _MERGING, recursive=True)
    u = _uniform(f"'42|' || {_PAIR_KEY} || '|' || draw")
    out["negatives"] = _with(
        None,
        f"""SELECT pairs.*, draw,
                   least(CAST(floor(exp({u} * ln(size + 1))) AS BIGINT) - 1, size - 1) AS negative
            FROM pairs, range(1, 6) r(draw), (SELECT count(DISTINCT token) AS size FROM tokens)""",
        tokens | {"pairs": _pairs(5)},
    )
    shuffle = f"md5('42|' || {_PAIR_KEY}), seq_id, center_pos, context_pos"
    out["shuffle_batches"] = _with(
        None, "SELECT * FROM batched", tokens | {"pairs": _pairs(5)} | _batched("pairs", shuffle, 2)
    )
    codes = tokens | _encoding() | {"coded": _CODED, "pairs": _pairs(5)}
    sided = "SELECT pairs.*, coded.* EXCLUDE (node) FROM pairs JOIN coded ON node = center"
    out["training_batches"] = _with(
        None, "SELECT * FROM batched", codes | {"sided": sided} | _batched("sided", shuffle, 1)
    )
    in_order = "seq_id, center_pos, context_pos"
    out["evaluation_batches"] = _with(
        None, "SELECT * FROM batched", codes | {"sided": sided} | _batched("sided", in_order, 1)
    )
    out["pairs_with_side"] = _with(
        None, sided, tokens | _encoding() | {"coded": _CODED, "pairs": _pairs(5)}
    )
    return out


_ITEMS = """
    SELECT p_partkey AS node, CAST(p_partkey AS VARCHAR) AS gds, replace(p_name, ' ', '_') AS gen_gds,
           CAST(p_size AS VARCHAR) AS l4, replace(p_type, ' ', '_') AS l3,
           substr(p_type, 1, 1) AS l2, p_brand AS big_brand, CAST(p_partkey % 10 AS VARCHAR) AS shop,
           string_split(p_name, ' ') AS sal
    FROM part"""
_SINGLE = ("gds", "gen_gds", "l4", "l3", "l2", "big_brand", "shop")
_SLOTS = ("gds", "gen_gds", "shop", "l4", "l3", "l2", "big_brand", "sal")


def _values(items: str) -> str:
    single = [f"SELECT node, '{f}' AS feature, 0 AS ord, {f} AS value FROM {items}" for f in _SINGLE]
    multi = f"""SELECT node, 'sal', unnest(range(len(sal))), unnest(sal) FROM {items}"""
    return " UNION ALL ".join([*single, multi])


def _encoding(known: str = "items") -> dict[str, str]:
    """Vocabulary of the ``known`` items and the encoding of all items with it."""
    return {
        "items": _ITEMS,
        "known": "SELECT * FROM items" + (
            "" if known == "items" else " WHERE gds IN (SELECT item_id FROM selected)"
        ),
        "known_values": _values("known"),
        "vocab": """
            SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS idx
            FROM (SELECT DISTINCT feature, value FROM known_values)""",
        "all_values": _values("items"),
        "usable": "SELECT * FROM vocab",
        "pivoted": "SELECT node, gds || '_' || shop AS item_key, "
        + ", ".join(f"max(idx) FILTER (WHERE feature = '{f}') AS {f}_idx" for f in _SINGLE)
        + """,
               coalesce(string_agg(CAST(idx AS VARCHAR), '|' ORDER BY ord)
                        FILTER (WHERE feature = 'sal' AND idx IS NOT NULL), '') AS sal_idx,
               count(*) FILTER (WHERE feature = 'sal' AND idx IS NULL) AS unknown_sal
            FROM all_values LEFT JOIN usable USING (feature, value) JOIN items USING (node)
            GROUP BY ALL""",
    }


_ALL_KNOWN = " AND ".join(f"{f}_idx IS NOT NULL" for f in _SINGLE) + " AND unknown_sal = 0"
_CODED = f"SELECT * EXCLUDE (unknown_sal) FROM pivoted WHERE {_ALL_KNOWN}"
_ADMITTED = " AND ".join(
    f"{f}_idx IS NOT NULL" for f in _SINGLE if f not in ("gds", "gen_gds")
) + " AND sal_idx <> ''"
_COLD = f"""
    SELECT CASE WHEN node < (SELECT count(*) FROM known) THEN node END AS node,
           * EXCLUDE (node, unknown_sal)
    FROM pivoted WHERE {_ADMITTED}"""


def _embedding(coded: str, weights: str, codes: bool = False) -> dict[str, str]:
    """Weighted sums of hash-initialised vectors of 16 components; with ``codes`` tables
    are hashed by their number."""
    number = "CASE tbl " + " ".join(f"WHEN '{f}' THEN '{i}'" for i, f in enumerate(_SLOTS)) + " END"
    u = _uniform(f"'42|' || {number if codes else 'tbl'} || '|' || row_id || '|' || i")
    logit = _uniform(f"'42|{8 if codes else 'attention'}|' || node || '|' || s")
    slots = [
        f"SELECT item_key, node, {_SLOTS.index(f)} AS slot, '{f}' AS tbl, {f}_idx AS row_id, 1.0 AS part "
        f"FROM coded WHERE {f}_idx IS NOT NULL"
        for f in _SINGLE
    ]
    slots.append(
        """SELECT item_key, node, 7, 'sal', CAST(unnest(string_split(sal_idx, '|')) AS BIGINT),
                  1.0 / len(string_split(sal_idx, '|')) FROM coded"""
    )
    weight = {
        "attention": f"""
            SELECT item_key, node, s AS slot, exp({logit} * 2 - 1) AS w
            FROM coded, range(0, 8) r(s)""",
        "mean": """
            SELECT item_key, node, s AS slot, 1.0 AS w FROM coded, range(0, 8) r(s)
            WHERE NOT (s = 0 AND gds_idx IS NULL) AND NOT (s = 1 AND gen_gds_idx IS NULL)""",
    }[weights]
    return {
        "coded": coded,
        "slots": " UNION ALL ".join(slots),
        "raw": weight,
        "weights": "SELECT item_key, slot, w / sum(w) OVER (PARTITION BY item_key) AS w FROM raw",
        "used": "SELECT DISTINCT tbl, row_id FROM slots",
        "params": f"SELECT tbl, row_id, i, {u} * 2 - 1 AS x FROM used, range(0, 16) r(i)",
        "embedded": """
            SELECT item_key, i AS dim, sum(x * w * part) AS value
            FROM slots JOIN weights USING (item_key, slot) JOIN params USING (tbl, row_id)
            GROUP BY 1, 2""",
        "unit": """
            SELECT item_key, dim,
                   value / sqrt(sum(value * value) OVER (PARTITION BY item_key)) AS value
            FROM embedded""",
    }


def _side_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    whole, chosen = _encoding(), _encoding("selected")
    out["side_vocab"] = _with(None, "SELECT feature, value, idx FROM vocab", whole)
    out["side_cardinality"] = _with(
        None, "SELECT feature, count(*) AS size FROM vocab GROUP BY feature", whole
    )
    out["vocabulary_size"] = "SELECT count(DISTINCT p_partkey) AS vocab_size FROM part"
    out["side_encode"] = _with(None, _CODED, whole)
    out["side_encode_rejects"] = _with(
        "selected",
        f"SELECT * EXCLUDE (unknown_sal) FROM pivoted WHERE NOT ({_ALL_KNOWN})",
        chosen,
    )
    out["side_encode_cold"] = _with("selected", _COLD, chosen)
    out["side_encode_cold_index0"] = _with(
        "selected", _COLD, chosen | {"usable": "SELECT * FROM vocab WHERE idx > 0"}
    )
    rounded = "SELECT item_key, dim, round(value, 6) AS value FROM "
    attention = whole | _embedding(_CODED, "attention")
    mean = chosen | _embedding(_COLD, "mean")
    out["attention_embed"] = _with(None, rounded + "embedded", attention)
    out["attention_export"] = _with(None, rounded + "unit", attention)
    out["coldstart_embed"] = _with("selected", rounded + "embedded", mean)
    out["coldstart_export"] = _with("selected", rounded + "unit", mean)
    return out


_UNIT_VECTORS = """
    SELECT id, label, dim, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS value
    FROM (SELECT vec_id AS id, label, unnest(range(len(embedding))) AS dim,
                 CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""
_VECTORS = "SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
_SIGN = _uniform("'123|' || h || '|' || i")
_BUCKETS = {
    "vecs": _VECTORS,
    "signs": f"""
        SELECT h, i, CASE WHEN {_SIGN} < 0.5 THEN -1 ELSE 1 END / 8.0 AS s
        FROM range(0, 40) a(h), range(0, 64) b(i)""",
    "parts": "SELECT id, unnest(range(64)) AS i, unnest(v) AS x FROM vecs",
    "cuts": """
        SELECT id, h, CAST(floor(sum(x * s) / 0.5) AS BIGINT) + 500 AS cut
        FROM parts JOIN signs USING (i) GROUP BY 1, 2""",
    "buckets": """
        SELECT id, h // 4 AS tbl, string_agg(CAST(cut AS VARCHAR), ',' ORDER BY h) AS bucket
        FROM cuts GROUP BY 1, 2""",
}


def _met(extra_condition: str = "") -> str:
    return f"""
        SELECT DISTINCT a.id AS user1, b.id AS user2, va.label AS seg_id,
               list_distance(va.v, vb.v) AS distance
        FROM buckets a JOIN buckets b ON a.tbl = b.tbl AND a.bucket = b.bucket AND a.id <> b.id
        JOIN vecs va ON va.id = a.id JOIN vecs vb ON vb.id = b.id {extra_condition}"""


def _similarity_statements() -> dict[str, str]:
    out: dict[str, str] = {}
    out["normalize_vectors"] = f"""
        SELECT id, dim, round(value, 6) AS value FROM ({_UNIT_VECTORS}) WHERE label <> 0
        UNION ALL SELECT vec_id, NULL, NULL FROM embeddings WHERE label = 0"""
    exact = """
        SELECT a.label AS seg_id, a.id AS user1, b.id AS user2, list_distance(a.v, b.v) AS distance
        FROM vecs a JOIN vecs b ON a.label = b.label AND a.id <> b.id"""
    ranked = "SELECT *, row_number() OVER (PARTITION BY user1 ORDER BY distance, user2) AS rn FROM met"
    nearest = "SELECT seg_id, user1, user2, round(distance, 6) AS distance FROM near WHERE rn <= {k}"
    out["similar_topk"] = _with(
        None, nearest.format(k=10), {"vecs": _VECTORS, "met": exact, "near": ranked}
    )
    out["similar_ann"] = _with(
        None, nearest.format(k=10), _BUCKETS | {"met": _met("AND va.label = vb.label"), "near": ranked}
    )
    pairs = _BUCKETS | {"met": _met(), "pairs": "SELECT * FROM met WHERE distance < 1.2"}
    out["similar_lsh"] = _with(
        None, "SELECT user1, user2, round(distance, 6) AS distance FROM pairs", pairs
    )
    shaped = """
        SELECT CAST(user1 AS VARCHAR) AS user1, md5(CAST(user1 AS VARCHAR)) AS user1_md5,
               CAST(user2 AS VARCHAR) AS user2, '0' AS user2_tp_id,
               md5(CAST(user2 AS VARCHAR)) AS user2_md5, round(1 - distance, 6) AS score,
               '4' AS emode FROM """
    out["result_table"] = _with(None, shaped + "pairs", pairs)
    out["recommendation_files"] = _with(
        None, shaped + "near WHERE rn <= 5", {"vecs": _VECTORS, "met": exact, "near": ranked}
    )
    out["cosine_scores"] = _with(
        None, "SELECT user1, user2, round(1 - distance * distance / 2, 6) AS score FROM pairs", pairs
    )
    out["sql_function_scores"] = _with(
        None,
        """SELECT user1, user2, round(1 - round(distance, 6), 6) AS score,
                  md5(CAST(user1 AS VARCHAR)) AS user1_md5, '0' AS tp, '4' AS emode FROM pairs""",
        pairs,
    )
    out["nearest_to_key"] = f"""
        SELECT id, round(list_distance(v, list_transform(range(64), lambda i: 0.125)), 6) AS distance
        FROM ({_VECTORS}) ORDER BY list_distance(v, list_transform(range(64), lambda i: 0.125)), id
        LIMIT 10"""
    coefficient = _uniform("'123|{}|' || j")
    out["similar_minhash"] = _with(
        "cleaned",
        """SELECT user1, user2, round(1 - common / (s1.size + s2.size - common), 6) AS distance
           FROM common JOIN sizes s1 ON s1.member_id = user1 JOIN sizes s2 ON s2.member_id = user2
           WHERE 1 - common / (s1.size + s2.size - common) < 0.95""",
        {
            "sizes": "SELECT member_id, count(*) AS size FROM cleaned GROUP BY 1",
            "functions": f"""
                SELECT j, 1 + CAST(floor({coefficient.format('a')} * 2147483646) AS BIGINT) AS a,
                       CAST(floor({coefficient.format('b')} * 2147483647) AS BIGINT) AS b
                FROM range(0, 45) r(j)""",
            "minima": """
                SELECT member_id, j,
                       min((('0x' || substr(md5(item_id), 1, 8))::BIGINT % 2147483647 * a + b)
                           % 2147483647) AS m
                FROM cleaned, functions GROUP BY 1, 2""",
            "met": """
                SELECT DISTINCT x.member_id AS user1, y.member_id AS user2
                FROM minima x JOIN minima y ON x.j = y.j AND x.m = y.m
                  AND x.member_id <> y.member_id""",
            "common": """
                SELECT user1, user2, count(*) AS common
                FROM met JOIN cleaned p ON p.member_id = user1
                JOIN cleaned q ON q.member_id = user2 AND q.item_id = p.item_id GROUP BY 1, 2""",
        },
    )
    classes = {
        "lists": "SELECT member_id, list(item_id ORDER BY item_id) AS items FROM cleaned GROUP BY 1",
        "classes": """
            SELECT member_id AS id, min(member_id) OVER (PARTITION BY items) AS rep, len(items) AS size
            FROM lists""",
    }
    out["item_set_classes"] = _with("cleaned", "SELECT * FROM classes", classes)
    out["overlapping_sets"] = _with(
        "cleaned",
        """SELECT lo, hi, common, round(1 - common / (a.size + b.size - common), 6) AS distance
           FROM common JOIN classes a ON a.id = lo JOIN classes b ON b.id = hi
           WHERE 1 - common / (a.size + b.size - common) < 0.95""",
        classes
        | {
            "firsts": "SELECT id, item_id FROM classes JOIN cleaned ON member_id = id WHERE id = rep",
            "common": """
                SELECT p.id AS lo, q.id AS hi, count(*) AS common
                FROM firsts p JOIN firsts q ON p.item_id = q.item_id AND p.id < q.id GROUP BY 1, 2""",
        },
    )
    return out


def _function_statements() -> dict[str, str]:
    return {
        "md5_functions": """
            SELECT c_custkey, md5(c_name) AS md5, substr(md5(c_name), 9, 16) AS md5_16 FROM customer""",
        "date_functions": """
            SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_key,
                   date_diff('day', DATE '1995-06-15', CAST(o_orderdate AS DATE)) AS days,
                   strftime(CAST(o_orderdate AS DATE) + 40, '%Y%m%d') AS later,
                   strftime(CAST(o_orderdate AS DATE) + CAST(7 - dayofweek(o_orderdate) AS INTEGER),
                            '%Y-%m-%d') AS week_end
            FROM orders""",
        "minute_functions": """
            SELECT event_id, hour(ts) * 60 + minute(ts) AS minute,
                   hour(ts) % 12 * 60 + minute(ts) AS minute12 FROM events""",
    }


def _file_statements(so_far: dict[str, str]) -> dict[str, str]:
    """What was written and read back equals what was written."""
    extra, body = _walks("greedy", 10, 10)
    walked = _with("strongest", body, extra, recursive=True)
    return {
        "interaction_log_scan": so_far["clean_interactions"],
        "selected_records_files": so_far["selected_records"],
        "node_index_files": so_far["node_index"],
        "walk_files": f"SELECT seg_id, nodes FROM ({walked})",
        "sequence_files": f"SELECT nodes AS tokens FROM ({walked})",
        "edge_list_files": so_far["user_graph"],
        "side_information_files": f"""
            SELECT * EXCLUDE (sal), array_to_string(sal, '|') AS sal FROM ({_ITEMS})""",
        "embedding_files": f"""
            SELECT label AS seg_id, CAST(id AS VARCHAR) AS member_id, dim, round(value, 6) AS value
            FROM ({_UNIT_VECTORS})""",
    }


def _more_file_statements(so_far: dict[str, str]) -> dict[str, str]:
    result = so_far["result_table"]
    tenth = "CAST({} AS BIGINT) % 10 = 0"
    inter = _with("inter", "SELECT * FROM inter WHERE " + tenth.format("item_id"))
    lines = "SELECT l_partkey || ' ' || {} AS value FROM lineitem WHERE l_orderkey % 10 = 0"
    return {
        "member_base_partition": """
            SELECT CAST(c_custkey AS VARCHAR) AS memb_id,
                   CASE c_nationkey % 3 WHEN 0 THEN '124000000020' WHEN 1 THEN '124000000010'
                        ELSE 'unknown' END AS gender_cd,
                   c_mktsegment || ' later' AS age_group
            FROM customer""",
        "result_table_appended": f"""
            SELECT r.*, dt FROM ({result}) r,
                (SELECT unnest(['20260101', '20260102', '20260102']) AS dt)""",
        "result_table_overwritten": f"""
            SELECT r.*, dt FROM ({result}) r, (SELECT unnest(['20260101', '20260102']) AS dt)
            WHERE dt = '20260101' OR score > 0""",
        "csv_files": so_far["selected_records"],
        "vector_text_files": """
            SELECT 'header' AS token, 64 AS dim, CAST(count(*) AS DOUBLE) AS value FROM embeddings
            UNION ALL
            SELECT CAST(vec_id AS VARCHAR), unnest(range(64)),
                   round(CAST(unnest(embedding) AS DOUBLE), 6) FROM embeddings""",
        "item_vector_files": so_far["attention_export"],
        "vocabulary_files": so_far["side_vocab"],
        "few_record_files": _with("selected", "SELECT 3 AS files, count(*) AS records FROM selected"),
        "drop_exact_items": _with(
            "records",
            """SELECT seg_id, item_id, node_id, units AS share_units FROM records
               WHERE (seg_id, item_id) NOT IN (
                   SELECT (seg_id, item_id) FROM records GROUP BY seg_id, item_id HAVING count(*) = 2)""",
        ),
        "day_keys": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_key FROM orders",
        "log_rejects": f"SELECT member_id || ' ' || item_id || ' much ' || vip AS value FROM ({inter})",
        "record_rejects": _with(
            "selected", f"SELECT member_id || ',' || item_id AS value FROM selected WHERE {tenth.format('item_id')}"
        ),
        "node_rejects": _with(
            "nodes",
            f"SELECT member_id || chr(9) || 'x' || chr(9) || seg_id AS value FROM nodes WHERE {tenth.format('member_id')}",
        ),
        "token_line_rejects": f"""
            SELECT value, kind FROM ({lines.format("'x ' || l_orderkey")}),
                (SELECT unnest(['walk', 'sequence']) AS kind)""",
        "edge_rejects": lines.format("l_suppkey"),
        "side_rejects": "SELECT p_partkey || ' ' || p_partkey AS value FROM part WHERE p_partkey % 10 = 0",
        "embedding_rejects": "SELECT vec_id || chr(9) || '1.0,x' AS value FROM embeddings WHERE vec_id % 10 = 0",
        "recommendation_line_rejects": """
            SELECT l_partkey || chr(9) || l_suppkey AS value FROM lineitem WHERE l_orderkey % 10 = 0""",
        "equal_lines": """
            SELECT 'sequences' AS kind, 2 * count(*) AS rows, 2 * count(*) AS ids, 4 * count(*) AS tokens
            FROM lineitem
            UNION ALL
            SELECT 'items', 2 * count(*), count(*), 2 * sum(len(string_split(p_name, ' '))) FROM part""",
    }


def _training_statements() -> dict[str, str]:
    """Loss at the starting parameters, and the parameters after one round, in exact sums."""
    size = 16

    def normal(i: str) -> str:
        a = _uniform(f"'42|context|' || rank || '|' || {i} || '|a'")
        b = _uniform(f"'42|context|' || rank || '|' || {i} || '|b'")
        z = f"sqrt(-2 * ln(1.0 - {a})) * cos({b} * 2 * pi())"
        return f"greatest(least({z}, 2.0), -2.0) / sqrt({size}.0)"

    uid = "seq_id || '|' || center_pos || '|' || context_pos"

    def steps(epoch: int, where: str) -> dict[str, str]:
        drawn = _uniform(f"'42|neg|{epoch}|' || uid || '|' || j")
        return (
            {"tokens": _TOKENS, "ranks": _RANKS, "pairs": _pairs(5)}
            | _encoding()
            | _embedding(_CODED, "attention", codes=True)
            | {
                "total": "SELECT count(*) AS vocab_size FROM ranks",
                "examples": f"""
                    SELECT uid, coded.item_key, coded.node, ranks.rank
                    FROM (SELECT {uid} AS uid, center, context FROM pairs) p
                    JOIN coded ON coded.node = p.center JOIN ranks ON ranks.token = p.context
                    WHERE {where}""",
                "outs": f"""
                    SELECT uid, item_key, node, 0 AS k, rank FROM examples
                    UNION ALL
                    SELECT uid, item_key, node, j, least(
                        CAST(floor(exp({drawn} * ln(vocab_size + 1))) AS BIGINT) - 1, vocab_size - 1)
                    FROM examples, total, range(1, 6) r(j)""",
                "context": f"SELECT rank, i, {normal('i')} AS x FROM ranks, range(0, {size}) r(i)",
                "item_lists": "SELECT item_key, list(value ORDER BY dim) AS v FROM embedded GROUP BY 1",
                "context_lists": "SELECT rank, list(x ORDER BY i) AS c FROM context GROUP BY 1",
                "scored": """
                    SELECT uid, item_key, node, k, rank,
                           list_inner_product(v, c)
                           - ln(5 * ln((rank + 2.0) / (rank + 1.0)) / ln(vocab_size + 1.0)) AS s
                    FROM outs JOIN item_lists USING (item_key) JOIN context_lists USING (rank), total""",
            }
        )

    loss = """
        SELECT count(DISTINCT uid) AS examples,
               round(sum(greatest(s, 0) - CASE WHEN k = 0 THEN s ELSE 0 END + ln(1 + exp(-abs(s))))
                     / count(DISTINCT uid), 6) AS mean_loss
        FROM scored"""
    in_round = _uniform("'42|round|0|' || uid")
    moved = "round(x - coalesce(least(0.025, 1.0 / uses) * g, 0), 6) AS value"
    round_steps = {
        "gs": "SELECT *, 1 / (1 + exp(-s)) - CASE WHEN k = 0 THEN 1 ELSE 0 END AS g FROM scored",
        "by_both": "SELECT item_key, rank, sum(g) AS g, count(*) AS uses FROM gs GROUP BY 1, 2",
        "context_uses": "SELECT rank, sum(uses) AS uses, sum(g) AS bias FROM by_both GROUP BY 1",
        "context_g": """
            SELECT rank, dim AS i, sum(g * value) AS g
            FROM by_both JOIN embedded USING (item_key) GROUP BY 1, 2""",
        "item_g": """
            SELECT item_key, i, sum(g * x) AS g FROM by_both JOIN context USING (rank) GROUP BY 1, 2""",
        "item_uses": "SELECT item_key, node, count(*) AS uses FROM gs WHERE k = 0 GROUP BY 1, 2",
        "row_g": """
            SELECT tbl, row_id, i, sum(w * part * g) AS g
            FROM slots JOIN weights USING (item_key, slot) JOIN item_g USING (item_key) GROUP BY 1, 2, 3""",
        "row_uses": """
            SELECT tbl, row_id, sum(uses) AS uses FROM slots JOIN item_uses USING (item_key) GROUP BY 1, 2""",
        "alpha_g": """
            SELECT item_key, slot, sum(part * g * x) AS g
            FROM slots JOIN item_g USING (item_key) JOIN params USING (tbl, row_id, i) GROUP BY 1, 2""",
        "logit_g": """
            SELECT item_key, slot, w * (g - sum(w * g) OVER (PARTITION BY item_key)) AS g
            FROM alpha_g JOIN weights USING (item_key, slot)""",
        "logits": f"""
            SELECT item_key, node, s AS slot, {_uniform("'42|8|' || node || '|' || s")} * 2 - 1 AS x
            FROM coded, range(0, 8) r(s)""",
    }
    parameters = f"""
        SELECT tbl, row_id, i AS dim, {moved}
        FROM params LEFT JOIN row_g USING (tbl, row_id, i) LEFT JOIN row_uses USING (tbl, row_id)
        UNION ALL
        SELECT 'attention', node, slot, {moved}
        FROM logits LEFT JOIN logit_g USING (item_key, slot)
        LEFT JOIN (SELECT item_key, uses FROM item_uses) USING (item_key)
        UNION ALL
        SELECT 'context', rank, i, {moved}
        FROM context LEFT JOIN context_g USING (rank, i) LEFT JOIN context_uses USING (rank)
        UNION ALL
        SELECT 'context', rank, {size}, round(-coalesce(least(0.025, 1.0 / uses) * bias, 0), 6)
        FROM ranks LEFT JOIN context_uses USING (rank)"""
    return {
        "side_initial_loss": _with(None, loss, steps(-1, "TRUE")),
        "side_first_round": _with(None, parameters, steps(0, f"floor({in_round} * 5) = 0") | round_steps),
    }
