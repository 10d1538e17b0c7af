"""Similarity join of documents on their word shingles, by a size-aware heavy-light split.

Two sets of sizes a <= b with Jaccard similarity s or more share ceil(s * b) elements.
The join uses this in two ways:

* Light sets, up to a boundary size, list all their subsets of the size that a partner
  of each possible size must share; partners have a subset in common.
* Heavy sets, beyond the boundary, scan inverted lists. With all elements in one order
  it is enough to list the first n - ceil(s * n) + 1 of each set, since similar sets
  meet there. The order is by hash, with elements that are frequent (as seen in the
  lists themselves) behind all others, the most frequent ones last; so lists stay short
  except among sets of frequent elements only. Lists are split by size, as similar sets
  differ little in size.

The boundary is the size with the least total cost, subsets listed against list
entries read, both counted on the data. Light sets near the boundary take part in the
lists as well, for their partners beyond it.

Equal sets are joined once. For components, lists are not expanded into pairs: first
every set is compared with the least set of each of its lists, then with some members,
of other components, of a long list. Lists that still hold more than one component are searched within, in
cells of two blocks, by parity bitmaps of the sets: the bits in which two bitmaps
differ are never more than the elements in which the sets do, so only sets that can
still be similar to one of another component come out. All comparisons that count are
exact, on whole sets, by one sparse product per cell, which returns a spanning forest of
the cell's links: no step returns pairs by the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.llm.common import components, free_prefix, pieces, small_batches
from walkvec.llm.textnum import U, chunks, finish, shingle_sets
from walkvec.operators.cells import cell_members, with_blocks
from walkvec.stage import stage

SHINGLE = 5
PERCENT = 80
#: Largest size for which the light side is considered; sets up to it are kept whole.
MOST_LIGHT = 24
#: Elements listed more often than this come late in the order, up to so many of them, the most
#: frequent first. The order is a matter of cost alone: any values give the same result.
FREQUENT = 16
MOST_FREQUENT = 200_000
BLOCK = 256
#: Members of a long list that its sets are compared with before the list is searched; a matter of cost alone.
HUBS = 16
#: Up to so many ids a table of ids is sent to every task (under 100 bytes each), beyond that it is a shuffle join.
BROADCAST_IDS = 500_000

_SECOND = U(0xA0761D6478BD642F)


def shared_by(size: int, percent: int) -> int:
    """Elements that a set of ``size`` shares with any similar set that is not larger."""
    return -(-percent * size // 100)


def prefix_length(size: np.ndarray, percent: int) -> np.ndarray:
    return size - -(-percent * size // 100) + 1


# --- sets -------------------------------------------------------------------


def _set_keys(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set, whatever the order of its elements."""
    sums = [np.concatenate([np.zeros(1, U), np.cumsum(m, dtype=U)]) for m in (finish(h), finish(h ^ _SECOND))]
    k1, k2 = (finish(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums)
    return k1, k2


def shingled(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, whole: bool = False, bitmap: bool = False
) -> DataFrame:
    """The columns of ``docs`` but text, with n, k1, k2 and elements of each text's set.

    (k1, k2) identify the set. ``elements`` are hashes in the common order: the prefix,
    or the whole set if it is light or ``whole`` is asked for. With ``bitmap`` the parity
    bitmap of the whole set takes their place.
    """
    kept = [c for c in docs.columns if c != "text"]
    fields = [f for f in docs.schema.fields if f.name != "text"]
    last = ("bitmap", "binary") if bitmap else ("elements", "array<bigint>")
    added = f"n bigint, k1 bigint, k2 bigint, {' '.join(last)}"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            own = [batch.column(i) for i in range(len(kept))]
            for chunk in chunks(batch.column(len(kept))):
                h, first = shingle_sets(chunk, shingle)
                n = np.diff(first)
                k1, k2 = _set_keys(h, first)
                rows = [c.slice(chunk.first, len(n)) for c in own] + [pa.array(n.astype(np.int64)), pa.array(k1), pa.array(k2)]
                if bitmap:
                    maps = [parity_bitmap(h[a:b]).tobytes() for a, b in zip(first[:-1], first[1:])]
                    yield pa.RecordBatch.from_arrays([*rows, pa.array(maps, pa.binary())], names=[*kept, "n", "k1", "k2", "bitmap"])
                    continue
                take = n if whole else np.where(n <= MOST_LIGHT, n, prefix_length(n, percent))
                inside = np.arange(len(h)) - np.repeat(first[:-1], n) < np.repeat(take, n)
                ends = np.concatenate([[0], np.cumsum(take)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[inside].view(np.int64)))
                yield pa.RecordBatch.from_arrays([*rows, lists], names=[*kept, "n", "k1", "k2", "elements"])

    return docs.select(*kept, "text").mapInArrow(run, schema)


def _first_rows(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """What identifies the text of each wanted set (rep): id and set key of its first row."""
    return stage(
        sets.join(wanted, "rep", "left_semi").select(
            F.col("rep"), F.col("n").alias("_n"), F.col("first_id").alias("_id"), "id_rows", F.col("k1").alias("_k1"), F.col("k2").alias("_k2")
        ),
        "wanted",
    )


def _bounded(table: DataFrame, n: int) -> DataFrame:
    return F.broadcast(table) if n <= BROADCAST_IDS else table


def _whole_sets(docs: DataFrame, ids: DataFrame, shingle: int, percent: int, bitmap: bool = False) -> DataFrame:
    """(rep, n, elements) of the sets that ``ids`` lists, or (rep, n, bitmap)."""
    last = "bitmap" if bitmap else "elements"
    size = ids.count()
    own = docs.join(_bounded(ids.select("_id"), size), docs.doc_id.eqNullSafe(ids["_id"]), "left_semi")
    found = shingled(own, shingle, percent, True, bitmap).select("doc_id", "k1", "k2", last)
    same = found.doc_id.eqNullSafe(ids["_id"]) & (found.k1 == ids["_k1"]) & (found.k2 == ids["_k2"])
    found = found.join(_bounded(ids, size), same).select("rep", F.col("_n").alias("n"), last, "id_rows")
    alone = found.where("id_rows = 1")
    repeated = found.where("id_rows > 1").dropDuplicates(["rep"])
    return alone.unionByName(repeated).drop("id_rows")


def _extensions(docs: DataFrame, ids: DataFrame, frequent: pa.Table, shingle: int, percent: int) -> DataFrame:
    """(element, rep): what sets list beyond the infrequent part of their first elements by hash.

    ``frequent`` (element, level) is a bounded table. Elements are ordered by level, 0
    for all others, then by hash.
    """
    order = np.argsort(frequent["element"].to_numpy().view(U))
    known = frequent["element"].to_numpy().view(U)[order]
    levels = frequent["level"].to_numpy()[order]
    size = ids.count()
    own = docs.join(_bounded(ids.select("_id"), size), docs.doc_id.eqNullSafe(ids["_id"]), "left_semi")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            for chunk in chunks(batch.column(1)):
                h, first = shingle_sets(chunk, shingle)
                n = np.diff(first)
                owner = np.repeat(np.arange(len(n)), n)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                level = np.where(known[at] == h, levels[at], 0)
                cut = prefix_length(n, percent)[owner]
                rank = np.arange(len(h)) - first[owner]
                listed = (level == 0) & (rank < cut)
                new = np.lexsort((rank, level, owner))
                new = new[(rank < cut) & ~listed[new]]  # ranks run alike within the owner
                counts = np.bincount(owner[new], minlength=len(n))
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                k1, k2 = _set_keys(h, first)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[new].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, len(n)), pa.array(k1), pa.array(k2), lists],
                    names=["doc_id", "k1", "k2", "elements"],
                )

    found = own.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, k1 bigint, k2 bigint, elements array<bigint>")
    same = found.doc_id.eqNullSafe(ids["_id"]) & (found.k1 == ids["_k1"]) & (found.k2 == ids["_k2"])
    found = found.join(_bounded(ids, size), same).select("rep", "elements", "id_rows")
    found = found.where("id_rows = 1").unionByName(found.where("id_rows > 1").dropDuplicates(["rep"]))
    return found.select(F.explode("elements").alias("element"), "rep")


# --- lists ------------------------------------------------------------------


def _subsets(light: DataFrame, percent: int) -> DataFrame:
    """(element, rep): a hash for every subset that a light set lists, marked by the partner's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keys, reps = [], []
            for rep, elements in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mixed = finish(np.array(elements, np.int64).view(U) ^ _SECOND)
                size = len(elements)
                for larger in range(size, size * 100 // percent + 1):
                    take = shared_by(larger, percent)
                    if take > size:
                        continue
                    places = np.array(list(combinations(range(size), take)), np.int64)
                    sums = mixed[places].sum(1, dtype=U)
                    keys.append(finish(sums + np.array([larger], U) * _SECOND).view(np.int64))
                    reps.append(np.full(len(sums), rep, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(reps))], names=["element", "rep"]
                )

    return light.select("rep", "elements").mapInArrow(run, "element bigint, rep bigint")


def boundary(entries: DataFrame, counts: DataFrame, percent: int) -> int:
    """The size up to which listing subsets costs less in total than reading lists.

    Lists of frequent elements will be left by most of their sets, so they count as short.
    """
    small = entries.where(F.col("n") <= MOST_LIGHT)
    length = F.least(F.coalesce("entries", F.lit(1)), F.lit(FREQUENT + 1))
    read = small.join(counts, "element", "left").groupBy("n").agg(F.sum(length).alias("read"))
    sets = small.groupBy("n").agg(F.countDistinct("rep").alias("sets"))
    gains, best, x = 0, 0, 0
    for size, lists, number in sorted(tuple(r) for r in read.join(sets, "n").collect()):
        listed = sum(
            comb(size, shared_by(b, percent))
            for b in range(size, size * 100 // percent + 1)
            if shared_by(b, percent) <= size
        )
        gains += lists - number * listed
        if gains > best:
            best, x = gains, size
    return x


def lists_of(docs: DataFrame, sets: DataFrame, prefixes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Lists (element, rep, n), of two entries or more, in which any two similar sets meet."""

    def firsts(rows: DataFrame, elements) -> DataFrame:
        cut = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1
        return rows.select("rep", "n", F.explode(F.slice(elements, F.lit(1), cut.cast("int"))).alias("element"))

    entries = firsts(prefixes, F.col("elements"))
    counts = stage(entries.groupBy("element").agg(F.count("*").alias("entries")).where("entries > 1"), "counts")
    x = boundary(entries, counts, percent)
    frequent = (
        counts.where(F.col("entries") > FREQUENT)
        .orderBy(F.desc("entries"), "element")
        .limit(MOST_FREQUENT)
        .select("element", F.ceil(F.log2("entries")).cast("int").alias("level"))
    )
    frequent = stage(frequent, "frequent")
    marks = F.broadcast(frequent.select("element"))

    # Sets with a frequent element among their first list more, in the order by level.
    late = stage(entries.join(marks, "element", "left_semi").select("rep").distinct(), "late")
    large = F.col("n") >= shared_by(x + 1, percent)
    ids = _first_rows(sets.where(large), late)
    more = entries.select("element", "rep").limit(0)
    if not ids.isEmpty():
        more = stage(_extensions(docs, ids, frequent.toArrow(), shingle, percent), "more")
    early = entries.where(large).select("element", "rep").join(marks, "element", "left_anti")
    # Entries that no second set can share are left out.
    met = counts.select("element").unionByName(more.select("element")).distinct()
    rows = early.join(met, "element", "left_semi").unionByName(more)
    if x:
        rows = rows.unionByName(_subsets(prefixes.where(F.col("n") <= x), percent))
    rows = stage(rows, "entries")
    several = rows.groupBy("element").agg(F.count("*").alias("entries")).where("entries > 1").select("element")
    rows = rows.join(several, "element").join(sets.select("rep", "n"), "rep")
    # Sizes fall into classes in which similar sets are at most one apart: two classes to a list.
    top = F.floor(F.log(F.col("n").cast("double")) / F.lit(log(100 / percent) * (1 + 1e-9))).cast("bigint")
    keyed = rows.select("rep", "n", F.explode(F.array(top, top + 1)).alias("class"), F.col("element").alias("own"))
    keyed = stage(keyed.select(F.xxhash64("own", "class").alias("element"), "rep", "n"), "keyed")
    several = keyed.groupBy("element").agg(F.count("*").alias("entries")).where("entries > 1").select("element")
    lists = stage(keyed.join(several, "element"), "lists")
    return lists


# --- cells ------------------------------------------------------------------


def forest(
    reps: np.ndarray, sets: list[np.ndarray], percent: int, roots: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links between similar sets, compared exactly, that join what ``roots`` tells apart, none more than needed.

    Without roots every set is a component of its own.
    """
    roots = reps if roots is None else roots
    m = len(reps)
    sizes = np.array([len(s) for s in sets], np.int64)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        close = 100 * both >= percent * (sizes[0] + sizes[1] - both)
        return [(int(reps[0]), int(reps[1]))] if close else []
    values, place, number = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), sizes)
    kept = number[place] > 1
    column = (np.cumsum(number > 1) - 1)[place[kept]]
    owner = owner[kept]
    overlap = np.zeros((m, m), np.float32)
    width = 4096
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, int((number > 1).sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((m, width), np.float32)
        part[owner[a:b], column[a:b] - low] = 1.0
        overlap += part @ part.T
    overlap = overlap.astype(np.int64)
    close = 100 * overlap >= percent * (sizes[:, None] + sizes[None, :] - overlap)
    np.fill_diagonal(close, False)
    names, of = np.unique(roots, return_inverse=True)
    i, j = np.nonzero(np.triu(close & (of[:, None] != of[None, :])))
    _, first = np.unique(np.minimum(of[i], of[j]) * len(names) + np.maximum(of[i], of[j]), return_index=True)
    parent = list(range(len(names)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    links: list[tuple[int, int]] = []
    for k in first:
        x, y = top(int(of[i[k]])), top(int(of[j[k]]))
        if x != y:
            parent[y] = x
            links.append((int(reps[i[k]]), int(reps[j[k]])))
    return links


def parity_bitmap(elements: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of elements fall on i; four to eight bits per element.

    Places are low bits of the hash, so halves of a bitmap folded by XOR give the smaller one.
    """
    bits = max(64, 1 << int(4 * len(elements) - 1).bit_length())
    odd = np.bincount((elements.view(U) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def search_cells(cells: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(keys, rep, root): members of a cell with a member of another component whose bitmaps let them be similar.

    ``cells`` has the keys, rep, root, n and bitmap. What comes out of a cell is bounded
    by its members, however many of their pairs are possible.
    """
    sorted_cells = cells.select(*keys, "rep", "root", "n", "bitmap").repartition(*keys).sortWithinPartitions(*keys, "rep")
    count = len(keys)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_cells.schema.fields[: count + 2])

    def marked(rows: list[tuple]) -> list[tuple[int, int]]:
        reps, roots, n = (np.array(x, np.int64) for x in list(zip(*rows))[:3])
        if (roots == roots[0]).all():
            return []
        maps = [np.frombuffer(r[3], U) for r in rows]
        width = min(len(m) for m in maps)
        table = np.stack([np.bitwise_xor.reduce(m.reshape(-1, width), 0) for m in maps])
        near = np.zeros(len(rows), bool)
        for i in range(len(rows) - 1):
            other = np.flatnonzero(roots[i + 1 :] != roots[i]) + i + 1
            most = _most_shared(n[i], n[other], table[i], table[other])
            other = other[100 * most >= percent * (n[i] + n[other] - most)]
            near[other] = True
            near[i] |= len(other) > 0
        return list(zip(reps[near].tolist(), roots[near].tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        found: list[tuple] = []

        def close() -> None:
            if len(rows) > 1:
                found.extend((*current, *own) for own in marked(rows))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * (count + 2)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[*keys, "rep", "root"])

        types: list[pa.DataType] = []
        for batch in pieces(batches):
            types = types or [c.type for c in batch.columns[: count + 2]]
            columns = [c.to_pylist() for c in batch.columns]
            for mark, row in zip(zip(*columns[:count]), zip(*columns[count:])):
                if mark != current:
                    close()
                    current, rows = mark, []
                if not rows or rows[-1][0] != row[0]:
                    rows.append(row)
            if found:
                yield batch_of()
        close()
        if found:
            yield batch_of()

    return sorted_cells.mapInArrow(run, schema)


def _most_shared(a: np.ndarray, b: np.ndarray, maps_a: np.ndarray, maps_b: np.ndarray) -> np.ndarray:
    """At most so many elements are shared by sets of sizes a and b, from bitmaps of equal width."""
    differ = np.bitwise_count(maps_a ^ maps_b).sum(-1).astype(np.int64)
    return np.minimum((a + b - differ) // 2, np.minimum(a, b))


def near_enough(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, rep) whose bitmaps let them be similar."""
    own = maps.select("rep", F.col("n").alias("n1"), F.col("bitmap").alias("m1"))
    other = maps.select(F.col("rep").alias("hub"), F.col("n").alias("n2"), F.col("bitmap").alias("m2"))
    both = pairs.join(own, "rep").join(other, "hub").select("hub", "rep", "n1", "m1", "n2", "m2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            keep = []
            for _, _, n1, m1, n2, m2 in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(m1, U), np.frombuffer(m2, U)
                width = min(len(a), len(b))
                a, b = (np.bitwise_xor.reduce(m.reshape(-1, width), 0) for m in (a, b))
                most = _most_shared(n1, n2, a, b)
                keep.append(100 * most >= percent * (n1 + n2 - most))
            yield batch.select(["hub", "rep"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "hub bigint, rep bigint")


def compare_cells(cells: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b): links among the sets of each cell that join different roots; ``cells`` has the keys, rep, root and elements.

    Rows are shuffled and sorted by cell and streamed, so that many small cells cost
    no call each; one cell is held at a time, two blocks of sets at most.
    """
    sorted_cells = cells.select(*keys, "rep", "root", "elements").repartition(*keys).sortWithinPartitions(*keys, "rep")
    count = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reps, roots, sets, links = None, [], [], [], []

        def close() -> None:
            if len(reps) > 1:
                links.extend(forest(np.array(reps), sets, percent, np.array(roots)))

        for batch in pieces(batches):
            marks = list(zip(*(batch.column(i).to_pylist() for i in range(count))))
            ids, own = batch.column(count).to_pylist(), batch.column(count + 1).to_pylist()
            column = batch.column(count + 2)
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            for i, mark in enumerate(marks):
                if mark != current:
                    close()
                    current, reps, roots, sets = mark, [], [], []
                if not reps or reps[-1] != ids[i]:
                    reps.append(ids[i])
                    roots.append(own[i])
                    sets.append(values[offsets[i] : offsets[i + 1]].copy())
            if len(links) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])
                links = []
        close()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=["a", "b"])

    return sorted_cells.mapInArrow(run, "a bigint, b bigint")


# --- the join ---------------------------------------------------------------


def _unsettled(lists: DataFrame, known: DataFrame) -> DataFrame:
    """(element, rep, root) of the lists with several components, each set of members once."""
    labelled = lists.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    several = (
        labelled.groupBy("element")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.count("*").alias("entries"),
            F.bit_xor(F.xxhash64("rep")).alias("x1"),
            F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("x2"),
        )
        .where("low < high")
        .groupBy("entries", "x1", "x2")
        .agg(F.min("element").alias("element"))
        .select("element")
    )
    return stage(labelled.join(several, "element").select("element", "rep", "root"), "unsettled")


def _random_pairs(left: DataFrame) -> DataFrame:
    """(hub, rep): each set with ``HUBS`` members, of other components, of one of its longest lists.

    Most of a group of copies is one component by now, and one of these members is likely
    to link the set to it. This settles most lists and decides nothing else.
    """
    drawn = [F.min_by(F.struct("rep", "root"), F.xxhash64(F.lit(i), "rep")) for i in range(HUBS)]
    hubs = left.groupBy("element").agg(F.count("*").alias("entries"), F.array_distinct(F.array(*drawn)).alias("hubs"))
    long = left.join(hubs.where(F.col("entries") > 2 * HUBS).select("element", "entries"), "element")
    chosen = long.groupBy("rep", "root").agg(F.max_by("element", F.struct("entries", "element")).alias("element"))
    pairs = chosen.join(hubs, "element").select(
        "rep", F.explode(F.filter("hubs", lambda h: h["root"] != F.col("root"))["rep"]).alias("hub")
    )
    return pairs.select("hub", "rep").distinct()


def similar_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, text_key, n, k1, k2) and sets (k1, k2, root, component_id).

    ``root`` names the component of a set, ``component_id`` is its least doc_id.
    """
    with small_batches(docs.sparkSession):  # every step with Python ends in here
        return _similar_groups(docs, shingle, percent)


def _similar_groups(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    docs = docs.select("doc_id", "text")
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.md5("text").alias("text_key"), "text"
    )
    rows = stage(shingled(numbered, shingle, percent), "shingled")
    numbers = rows.groupBy("doc_id").agg(F.count("*").alias("id_rows"))
    equal = (
        rows.where("n > 0")
        .groupBy("k1", "k2")
        .agg(
            F.min("row").alias("rep"),
            F.min("doc_id").alias("least_id"),
            F.min_by("doc_id", "row").alias("first_id"),
            F.first("n").alias("n"),
        )
    )
    sets = stage(
        equal.join(numbers, F.col("first_id").eqNullSafe(F.col("doc_id"))).drop("doc_id"),
        "sets",
    )
    of_reps = rows.join(_bounded(sets.select("rep"), sets.count()), rows.row == sets.rep, "left_semi")
    prefixes = of_reps.select(F.col("row").alias("rep"), "n", "elements")
    lists = lists_of(docs, sets, prefixes, shingle, percent)
    listed = _first_rows(sets, lists.select("rep").distinct())
    # One Python worker a task: sets become bitmaps where they are made.
    maps = stage(_whole_sets(docs, listed, shingle, percent, bitmap=True), "bitmaps")

    def linked(cells: DataFrame, keys: list[str]) -> DataFrame:
        """Links of the similar sets in each cell, as many as its roots need."""
        wanted = _first_rows(sets, cells.select("rep").distinct())
        whole = stage(_whole_sets(docs, wanted, shingle, percent).select("rep", "elements"), "whole")
        return stage(compare_cells(cells.join(whole, "rep"), keys, percent), "links")

    def compared(pairs: DataFrame) -> DataFrame:
        """Links among the pairs (hub, rep), each hub with its partners in blocks."""
        near = stage(with_blocks(near_enough(pairs, maps, percent), ["hub"], "rep", BLOCK).drop("_blocks"), "near")
        members = near.unionByName(near.select("hub", F.col("hub").alias("rep"), "_block").distinct())
        return linked(members.withColumn("root", F.col("rep")), ["hub", "_block"])

    # Every set against the least of each of its lists.
    hubs = lists.groupBy("element").agg(F.min("rep").alias("hub"), F.min_by("n", "rep").alias("hub_n"))
    apart = F.lit(100) * F.least("n", "hub_n") < F.lit(percent) * F.greatest("n", "hub_n")
    near = lists.join(hubs, "element").where((F.col("rep") != F.col("hub")) & ~apart).select("hub", "rep").distinct()
    links = compared(stage(near, "hubs"))
    known = stage(components(links), "components")

    # Lists that still hold several components: first each set against some others of its lists, at random.
    left = _unsettled(lists, known)
    more = stage(_random_pairs(left), "hubs")
    if not more.isEmpty():
        links = links.unionByName(compared(more))
        known = stage(components(links), "components")
        left = _unsettled(left.select("element", "rep"), known)

    # What is left is searched within, in cells of two blocks.
    keys = ["element", "_b1", "_b2"]
    cells = cell_members(with_blocks(left, ["element"], "rep", BLOCK)).drop("_block")
    marked = stage(search_cells(cells.join(maps, "rep"), keys, percent), "marked")
    known = stage(components(links.unionByName(linked(marked, keys))), "components")

    rooted = sets.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "root", F.coalesce("root", "rep")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rows.drop("elements"), stage(rooted.select("k1", "k2", "root").join(least, "root"), "groups")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Every document with the size of its shingle set and the least doc_id of its component.

    A text that is null or has no words has an empty set and is linked with nothing:
    its component is its own doc_id. Equal sets are always linked. Repeated rows are
    rows of their own in the same component. Rows without an id share components like
    others; a component none of whose rows has an id has a null component_id. Columns
    other than doc_id and text are ignored; an empty table gives no rows.
    """
    rows, groups = similar_groups(docs, shingle, percent)
    return rows.join(groups, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least id.

    Texts without words all stay. Among rows of equal id and text one stays.
    """
    rows, groups = similar_groups(docs, shingle, percent)
    kept = (
        rows.where("n > 0")
        .join(groups, ["k1", "k2"])
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("w"))
        .select(F.col("w.doc_id").alias("_id"), F.col("w.text_key").alias("_key"))
    )
    bare = rows.where("n = 0").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    numbers = rows.groupBy("doc_id", "text_key").agg(F.count("*").alias("_rows"))
    winners = stage(
        kept.join(numbers, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key")))
        .select("_id", "_key", "_rows")
        .unionByName(bare.distinct().withColumn("_rows", F.lit(1).cast("bigint"))),
        "winners",
    )
    own = free_prefix(docs)
    winners = winners.toDF(f"{own}id", f"{own}key", f"{own}rows")
    same = F.col("doc_id").eqNullSafe(F.col(f"{own}id")) & F.md5("text").eqNullSafe(F.col(f"{own}key"))
    stay = docs.join(winners, same)
    alone = stay.where(F.col(f"{own}rows") == 1).select(*docs.columns)
    repeated = stay.where(F.col(f"{own}rows") > 1).dropDuplicates([f"{own}id", f"{own}key"]).select(*docs.columns)
    return alone.unionByName(repeated)


COMPONENT_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') END AS words
  FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(words[i:i + 4], ' ') AS g
  FROM (SELECT rid, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM d WHERE len(words) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.rid AS a, y.rid AS b, count(*) AS meet FROM s x JOIN s y ON x.g = y.g AND x.rid <> y.rid GROUP BY ALL) p
  JOIN sizes sa ON sa.rid = p.a JOIN sizes sb ON sb.rid = p.b
  WHERE 100 * meet >= 80 * (sa.n + sb.n - meet)),
reach AS (
  SELECT rid AS a, rid AS b FROM d
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a, min(d.doc_id) AS component_id FROM reach JOIN d ON d.rid = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d JOIN least ON least.a = d.rid LEFT JOIN sizes USING (rid)
"""
