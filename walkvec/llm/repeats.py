"""Removal of long passages that occur more than once, with a logarithmic family of suffix arrays.

Two equal strings of ``LENGTH`` bytes choose equal anchors: the place inside them whose
``GRAM`` bytes have the least hash. So it is enough to index the suffixes that start
at anchors, about one in seventy. An entry stands for the run of strings of LENGTH
bytes that share an anchor; it is sorted by the hash of the suffix's first GRAM bytes
and carries a hash of the whole run.

Entries arrive in batches. A batch is written as one sorted array, bucketed by suffix
hash. It is merge-scanned with itself and with each existing level (a sort-merge join
of tables that are already partitioned and sorted alike, so without a shuffle), which
finds the entries that share an anchor. Then levels of equal size merge, and so on
upwards, so there are never more levels than the logarithm of the number of batches.

What shares an anchor is settled exactly by content. Equal runs are covered whole.
Runs that differ are cut into cells of ``CELL`` strings: a cell whose union of bytes
occurs again is covered, one whose intersection of bytes is unique is not, and only
cells in between are listed string by string. Counting uses partial aggregation
throughout, so a passage may occur any number of times.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walkvec.llm.textnum import U, chunks, finish, prefix_hashes, span_hashes
from walkvec.stage import remove, stage

LENGTH = 200
GRAM = 64
CELL = 16
BATCHES = 4
#: Up to so many keys a filter by text is sent to every task (about 40 bytes each), beyond that it is a shuffle join.
BROADCAST_KEYS = 1_000_000

_PLACE = U((1 << 24) - 1)
_M1, _M2, _M3 = U(0x8CB92BA72F3D8DD7), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from running minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, U)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """The entries of a chunk: (text, g, c, lo, span, off), one per run of strings with one anchor.

    Strings start at lo .. lo + span (from the text's start); the anchor is at lo + off.
    ``g`` hashes the anchor's bytes, ``c`` all bytes of the run and its shape. Ties
    between equal hashes go to the first place, which depends on the string alone.
    """
    if len(data) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32, np.int32))
    parts = []
    # The place takes 24 bits of the compared value, so longer data goes piece by piece.
    piece = int(_PLACE) - length
    sums = prefix_hashes(data)
    for begin in range(0, len(data) - length + 1, piece):
        end = min(len(data), begin + piece + length - 1)
        places = np.arange(begin, end - gram + 1)
        hashes = finish(span_hashes(sums, places, places + gram))
        least = _least_in_windows((hashes & ~_PLACE) | (places - begin).astype(U), length - gram + 1)
        anchor = (least & _PLACE).astype(np.int64) + begin
        starts = np.arange(begin, end - length + 1)
        text = np.searchsorted(offsets, starts, "right") - 1
        inside = starts + length <= offsets[text + 1]
        parts.append((starts[inside], anchor[inside], text[inside]))
    starts, anchor, text = (np.concatenate(p) for p in zip(*parts))
    if not len(starts):
        return anchored_runs(data[:0], offsets, length, gram)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    lo, hi = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    at, text = anchor[first], text[first]
    g = finish(span_hashes(sums, at, at + gram))
    shape = ((at - lo) << 16 | (hi - lo)).astype(U)
    c = finish(span_hashes(sums, lo, hi + length) * _M1 + shape * _M2 + g)
    base = offsets[text]
    return text, g.view(np.int64), c.view(np.int64), *((x).astype(np.int32) for x in (lo - base, hi - lo, at - lo))


def indexed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(row, doc_id, key, n_bytes, sha, entries) of every document; ``docs`` has row, doc_id, key, text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    entry = "struct<g:bigint,c:bigint,lo:int,span:int,off:int>"
    schema = f"row bigint, doc_id {id_type}, key string, n_bytes bigint, sha string, entries array<{entry}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(3)):
                n = len(chunk.offsets) - 1
                text, *values = anchored_runs(chunk.data, chunk.offsets, length, gram)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(v) for v in values], names=["g", "c", "lo", "span", "off"])
                raw = memoryview(chunk.data)
                sums = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:])]
                own = [batch.column(i).slice(chunk.first, n) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.diff(chunk.offsets)), pa.array(sums), pa.ListArray.from_arrays(pa.array(ends), rows)],
                    names=["row", "doc_id", "key", "n_bytes", "sha", "entries"],
                )

    return docs.select("row", "doc_id", "key", "text").mapInArrow(run, schema)


# --- the family -------------------------------------------------------------


class SuffixFamily:
    """Sorted arrays of entries whose sizes, in batches, are distinct powers of two.

    ``add`` returns the entries, old and new, that share an anchor within the batch or
    between the batch and a level. Arrays are bucketed tables of the session's
    warehouse; ``drop`` removes them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"walkvec_suffixes_{uuid.uuid4().hex}"
        self.levels: dict[int, str] = {}  # size in batches: table
        self.made = 0

    def _write(self, entries: DataFrame) -> str:
        self.made += 1
        name = f"{self.name}_{self.made}"
        (
            entries.repartition(self.buckets, "g")
            .sortWithinPartitions("g")
            .write.bucketBy(self.buckets, "g")
            .sortBy("g")
            .saveAsTable(name)
        )
        return name

    def add(self, entries: DataFrame) -> DataFrame:
        name = self._write(entries)
        batch = self.spark.table(name)
        again = batch.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
        found = batch.join(again, "g", "left_semi")
        for level in self.levels.values():
            old = self.spark.table(level)
            found = found.unionByName(batch.join(old.select("g"), "g", "left_semi"))
            found = found.unionByName(old.join(batch.select("g"), "g", "left_semi"))
        found = stage(found, "met")
        size = 1
        while size in self.levels:
            other = self.levels.pop(size)
            merged = self._write(self.spark.table(name).unionByName(self.spark.table(other)))
            for table in (name, other):
                self.spark.sql(f"DROP TABLE {table}")
            name, size = merged, 2 * size
        self.levels[size] = name
        return found

    def drop(self) -> None:
        for table in self.levels.values():
            self.spark.sql(f"DROP TABLE {table}")
        self.levels = {}


# --- differing runs ---------------------------------------------------------


def _texts(docs: DataFrame, rows: DataFrame, lists: DataFrame) -> DataFrame:
    """(row, text, and the columns of ``lists``) for the listed rows; read again by id and text key."""
    wanted = stage(
        lists.join(rows.select("row", F.col("doc_id").alias("_id"), F.col("key").alias("_key")), "row"), "lists"
    )
    keys = wanted.select("_key").distinct()
    n = keys.count()
    own = docs.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, docs.key == keys["_key"], "left_semi")
    same = own.doc_id.eqNullSafe(F.col("_id")) & (own.key == F.col("_key"))
    return own.join(wanted, same).select("text", *lists.columns)


def _bytes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(t.encode(), np.uint8) for t in column.to_pylist()]


def _cells(texts: DataFrame, length: int, cell: int) -> DataFrame:
    """Cells of runs: (core, union, row, at, low, high), from texts with lists of (g, lo, span, off).

    ``core`` hashes what all strings of a full cell have in common, with the anchor and
    the cell's place; ``union`` hashes all bytes of a cell, and is null for a cell that
    the run does not fill. Strings of the cell start at ``at`` - high .. ``at`` - low.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, row, runs in zip(_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2)):
                sums = prefix_hashes(data)
                g, lo, span, off = (runs.values.field(f).to_numpy() for f in ("g", "lo", "span", "off"))
                first, last = (off - span) // cell, off // cell
                count = last - first + 1
                owner = np.repeat(np.arange(len(g)), count)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner]
                at = (lo + off)[owner].astype(np.int64)
                low = np.maximum((off - span)[owner], number * cell)
                high = np.minimum(off[owner], number * cell + cell - 1)
                start = at - number * cell
                mark = g[owner].view(U) * _M1 + number.astype(U) * _M2
                core = finish(span_hashes(sums, start, start + length - cell + 1) + mark)
                full = high - low == cell - 1
                head, tail = np.where(full, start - cell + 1, 0), np.where(full, start + length, 0)
                union = finish(span_hashes(sums, head, tail) * _M3 + mark)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(core.view(np.int64)),
                        pa.array(union.view(np.int64), mask=~full),
                        pa.array(np.full(len(owner), row, np.int64)),
                        pa.array(at.astype(np.int32)),
                        pa.array(low.astype(np.int32)),
                        pa.array(high.astype(np.int32)),
                    ],
                    names=["core", "union", "row", "at", "low", "high"],
                )

    return texts.select("text", "row", "runs").mapInArrow(
        run, "core bigint, union bigint, row bigint, at int, low int, high int"
    )


def _strings(texts: DataFrame, length: int) -> DataFrame:
    """Single strings (hash, row, start) of cells, from texts with lists of (core, at, low, high)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, row, cells in zip(_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2)):
                sums = prefix_hashes(data)
                core, at, low, high = (cells.values.field(f).to_numpy() for f in ("core", "at", "low", "high"))
                count = high - low + 1
                owner = np.repeat(np.arange(len(core)), count)
                shift = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + low[owner]
                start = (at[owner] - shift).astype(np.int64)
                mark = core[owner].view(U) + shift.astype(U) * _M3
                h = finish(span_hashes(sums, start, start + length) * _M1 + mark)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(np.full(len(owner), row, np.int64)), pa.array(start.astype(np.int32))],
                    names=["hash", "row", "start"],
                )

    return texts.select("text", "row", "cells").mapInArrow(run, "hash bigint, row bigint, start int")


def _settle(docs: DataFrame, rows: DataFrame, met: DataFrame, length: int, cell: int) -> DataFrame:
    """(row, start, stop): bytes covered by repeated strings, from the entries that share an anchor."""
    twice = met.groupBy("g", "c").agg(F.count("*").alias("n")).where("n > 1").select("g", "c")
    whole = met.join(twice, ["g", "c"], "left_semi").select(
        "row", F.col("lo").alias("start"), (F.col("lo") + F.col("span") + F.lit(length)).alias("stop")
    )

    # One run of each content; anchors with several go on to cells.
    runs = stage(met.dropDuplicates(["g", "c"]), "runs")
    several = runs.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g")
    lists = runs.join(several, "g").groupBy("row").agg(F.collect_list(F.struct("g", "lo", "span", "off")).alias("runs"))
    cells = stage(_cells(_texts(docs, rows, lists), length, cell).distinct(), "cells")

    shared = cells.where("union is not null").groupBy("core", "union").agg(F.count("*").alias("n")).where("n > 1")
    covered = cells.join(shared.select("core", "union"), ["core", "union"], "left_semi").select(
        "row", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + F.lit(length)).alias("stop")
    )
    mixed = (
        cells.groupBy("core")
        .agg(
            F.count("*").alias("n"),
            F.min("union").alias("least"),
            F.max("union").alias("most"),
            F.count("union").alias("full"),
        )
        .where("n > 1 and (least < most or full < n)")
        .select("core")
    )
    open_cells = cells.join(mixed, "core", "left_semi")
    open_cells = open_cells.where("union is null").unionByName(
        open_cells.where("union is not null").dropDuplicates(["core", "union"])
    )
    lists = open_cells.groupBy("row").agg(F.collect_list(F.struct("core", "at", "low", "high")).alias("cells"))
    strings = stage(_strings(_texts(docs, rows, lists), length).distinct(), "strings")
    again = strings.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    single = strings.join(again, "hash", "left_semi").select(
        "row", "start", (F.col("start") + F.lit(length)).alias("stop")
    )
    return whole.unionByName(covered).unionByName(single)


# --- the operator -----------------------------------------------------------


def _merged(covered: DataFrame) -> DataFrame:
    """(row, starts, stops): maximal runs of covered bytes of each row."""
    lists = covered.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, stops = [], []
            for spans in batch.column(1):
                a, b = (spans.values.field(f).to_numpy() for f in ("start", "stop"))
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order])
                new = np.concatenate([[True], a[1:] > b[:-1]])
                starts.append(a[new])
                stops.append(b[np.append(np.flatnonzero(new)[1:], len(a)) - 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(starts, pa.list_(pa.int32())), pa.array(stops, pa.list_(pa.int32()))],
                names=["row", "starts", "stops"],
            )

    return lists.mapInArrow(run, "row bigint, starts array<int>, stops array<int>")


def _cut(texts: DataFrame) -> DataFrame:
    """(row, kept): each text's bytes outside its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for data, starts, stops in zip(_bytes(batch.column(0)), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                edges = [0, *(x for pair in zip(starts, stops) for x in pair), len(data)]
                kept.append(b"".join(data[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(kept, pa.binary())], names=["row", "kept"])

    return texts.select("text", "row", "starts", "stops").mapInArrow(run, "row bigint, kept binary")


def without_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, cell: int = CELL, batches: int = BATCHES
) -> DataFrame:
    """Every document with its bytes, the bytes and runs removed, and the checksum of the rest.

    Bytes are those of the UTF-8 text; a null text is empty. Texts shorter than
    ``length`` keep everything. All copies of a repeated passage go, so a text that
    occurs twice, also as a repeated row, loses every byte. Columns other than doc_id
    and text are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.md5("text").alias("key"), "text")
    index = stage(indexed(docs.withColumn("row", F.monotonically_increasing_id()), length, gram), "index")
    rows = stage(index.drop("entries"), "rows")
    family = SuffixFamily(spark)
    met = None
    for number in range(batches):
        batch = index.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == number)
        entries = batch.select("row", F.explode("entries").alias("e")).select("row", "e.*")
        found = family.add(entries)
        met = found if met is None else met.unionByName(found)
    family.drop()
    for path in {p.rsplit("/", 1)[0] for p in index.inputFiles()}:
        remove(spark, path)
    met = stage(met.distinct(), "met")

    spans = stage(_merged(_settle(docs, rows, met, length, cell)), "spans")
    removed = F.aggregate(
        F.zip_with("stops", "starts", lambda b, a: (b - a).cast("bigint")), F.lit(0).cast("bigint"), lambda x, y: x + y
    )
    spans = spans.withColumn("n_removed", removed).withColumn("n_spans", F.size("starts").cast("bigint"))
    partly = spans.join(rows.select("row", "n_bytes"), "row").where("n_removed < n_bytes").select("row", "starts", "stops")
    rest = _cut(_texts(docs, rows, partly)).select("row", F.sha2("kept", 256).alias("rest")).dropDuplicates(["row"])
    zero = F.lit(0).cast("bigint")
    return (
        rows.join(spans.select("row", "n_removed", "n_spans"), "row", "left")
        .join(stage(rest, "rest"), "row", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.coalesce("n_removed", zero).alias("n_removed"),
            F.coalesce("n_spans", zero).alias("n_spans"),
            F.when(F.col("n_removed").isNull(), F.col("sha"))
            .otherwise(F.coalesce("rest", F.sha2(F.lit(b""), 256)))
            .alias("kept_sha256"),
        )
    )
