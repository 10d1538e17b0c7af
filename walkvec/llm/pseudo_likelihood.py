"""Language-model scores by masked pseudo-likelihood.

A small network predicts a word from the ``WINDOW`` words on either side: embeddings
of the neighbours, one table per place, are summed and squashed; the word follows from
a softmax over groups of words and one within the group. A document's score is the sum
of the log-probabilities of all its words, each given both sides.

The vocabulary counts every word of the corpus; the most frequent ones have entries of
their own, all others share entries by hash. Within a shared entry a word has its share
of the entry's occurrences in the corpus, so every word has a probability of its own and
the table of words grows with the corpus. That table stays distributed: documents lie in
blocks, a block lists each of its rarer words once, and the lists are joined with the
table.

Every document is encoded once and written out. Training masks a fixed share of the positions, chosen by hash, in every
document. Documents fall into rounds by a hash of their words; a round sums the
gradients of all its masked positions at the current parameters, over all tasks, and
then the parameters move once. So the partitioning does not change the model, up to
rounding, and what a round sends is one vector of parameters per task, summed in
slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.llm.textnum import LOWER, U, chunks, finish, words
from walkvec.stage import stage, stage_path

WINDOW = 2
GROUPS, PER_GROUP = 32, 32
VOCABULARY = GROUPS * PER_GROUP
SHARED = 128  # entries that rarer words share
SIZE = 16
ROUNDS = 24
MASKED = 15  # percent of the positions
LEARNING_RATE = 0.05
SLICES = 16
BLOCK_WORDS = 1 << 21  # words of the documents that share a list of rarer words

_PAD = VOCABULARY  # stands beyond both ends of a text
_SEED = U(0x5851F42D4C957F2D)


# --- words to numbers -------------------------------------------------------


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of all lower-cased words of the corpus and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                h, n = np.unique(words(chunk, LOWER[chunk.data]).hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, size: int = VOCABULARY - SHARED) -> np.ndarray:
    """The hashes of the ``size`` most frequent words, by frequency; ties by hash."""
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    return np.array([r["word"] for r in top], np.int64).view(U)


def encode(hashes: np.ndarray, known: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Entry numbers of words; ``known`` is sorted, ``order`` gives its entries."""
    shared = (VOCABULARY - SHARED + (hashes % U(SHARED)).astype(np.int64)).astype(np.int16)
    if not len(known):
        return shared
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, order[at], shared).astype(np.int16)


_Held = tuple[pa.Array, list[bytes], np.ndarray, np.ndarray, np.ndarray]


def _block(held: list[_Held], number: int) -> pa.RecordBatch:
    """Rows of documents as one block; its first row has the list of the block's rarer words."""
    listed, at = np.unique(np.concatenate([rare for *_, rare in held]), return_inverse=True)
    n = np.concatenate([n for *_, n, _ in held])
    ends = np.cumsum(n)
    at = at.astype(np.int32)
    lists = [listed.view(np.int64).tobytes()] + [None] * (len(n) - 1)
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([h[0] for h in held]),
            pa.array([x for h in held for x in h[1]], pa.binary()),
            pa.array([at[a:b].tobytes() for a, b in zip(ends - n, ends)], pa.binary()),
            pa.array(lists, pa.binary()),
            pa.array(np.full(len(n), number)),
            pa.array(np.concatenate([h[2] for h in held])),
        ],
        names=["doc_id", "ids", "rare", "list", "block", "round"],
    )


def _encoded_schema(docs: DataFrame) -> str:
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return f"doc_id {id_type}, ids binary, rare binary, list binary, block bigint, round int"


def encoded(docs: DataFrame, top: np.ndarray, rounds: int = ROUNDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, ids, rare, list, block, round): documents as entries and as rarer words.

    ``ids`` are the entries of a document's words as 16-bit numbers, ``rare`` the places
    of its words in shared entries in the list of its block, as 32-bit numbers. Block
    numbers differ from run to run: write the rows out once.
    """
    sorting = np.argsort(top)
    known, order = top[sorting], sorting.astype(np.int16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                n = len(chunk.offsets) - 1
                w = words(chunk, LOWER[chunk.data])
                ids = encode(w.hashes, known, order)
                shared = ids >= VOCABULARY - SHARED
                first = np.concatenate([[0], np.cumsum(np.bincount(w.text, minlength=n))])
                sums = np.concatenate([np.zeros(1, U), np.cumsum(w.hashes, dtype=U)])
                mark = finish((sums[first[1:]] - sums[first[:-1]]) ^ _SEED)
                blobs = [ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                rounds_of = (mark % U(rounds)).astype(np.int32)
                in_rare = np.bincount(w.text[shared], minlength=n)
                held.append((batch.column(0).slice(chunk.first, n), blobs, rounds_of, in_rare, w.hashes[shared]))
                size += len(ids) + n
                if size >= block_words:
                    yield _block(held, number)
                    number, size, held = number + 1, 0, []
        if held:
            yield _block(held, number)

    return docs.select("doc_id", "text").mapInArrow(run, _encoded_schema(docs))


def listed_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, place, n): occurrences in the corpus of the words in each block's list, where above 1.

    A word has one row per block however often it occurs there, so no key is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                listed = np.frombuffer(blob, np.int64)
                for a in range(0, len(listed), 1 << 16):
                    part = listed[a : a + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array(np.full(len(part), block)), pa.array(np.arange(a, a + len(part), dtype=np.int32))],
                        names=["word", "block", "place"],
                    )

    lists = rows.where(F.col("list").isNotNull()).select("block", "list")
    listed = lists.mapInArrow(run, "word bigint, block bigint, place int")
    return listed.join(counts.where("n > 1"), "word").select("block", "place", "n")


# --- the network ------------------------------------------------------------

Parameters = dict[str, np.ndarray]
_SHAPES = {
    "near": (2 * WINDOW, VOCABULARY + 1, SIZE),
    "bend": (SIZE,),
    "group": (GROUPS, SIZE),
    "group_bias": (GROUPS,),
    "word": (GROUPS, PER_GROUP, SIZE),
    "word_bias": (GROUPS, PER_GROUP),
}


def start(frequency: np.ndarray, seed: int = 7) -> Parameters:
    """Random weights, and biases that give the words' frequencies (by entry)."""
    rng = np.random.default_rng(seed)
    p = {k: rng.normal(0, 0.1, shape).astype(np.float32) for k, shape in _SHAPES.items()}
    by_group = (frequency + 0.5).reshape(GROUPS, PER_GROUP)
    p["bend"][:] = 0
    p["group_bias"] = np.log(by_group.sum(1) / by_group.sum()).astype(np.float32)
    p["word_bias"] = np.log(by_group / by_group.sum(1, keepdims=True)).astype(np.float32)
    return p


def _softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(1, keepdims=True)
    return x


def _neighbours(ids: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Entries at each place of the window; ``ids`` is padded at both ends of every text."""
    return [ids[at + k] for k in (*range(-WINDOW, 0), *range(1, WINDOW + 1))]


def log_probabilities(p: Parameters, ids: np.ndarray, at: np.ndarray, gradient: Parameters | None = None) -> np.ndarray:
    """Log-probability of the word at each place given its neighbours.

    With ``gradient`` the gradient of their sum is added to it.
    """
    target = ids[at].astype(np.int64)
    order = np.argsort(target // PER_GROUP, kind="stable")
    at, target = at[order], target[order]
    near = _neighbours(ids, at)
    total = p["bend"] + sum(table[n] for table, n in zip(p["near"], near))
    hidden = np.tanh(total)
    group, within = target // PER_GROUP, target % PER_GROUP
    rows = np.arange(len(at))
    of_group = _softmax(hidden @ p["group"].T + p["group_bias"])
    out = np.log(np.maximum(of_group[rows, group], 1e-30))
    back = None
    if gradient is not None:
        of_group = -of_group
        of_group[rows, group] += 1
        gradient["group"] += of_group.T @ hidden
        gradient["group_bias"] += of_group.sum(0)
        back = of_group @ p["group"]
    edges = np.searchsorted(group, np.arange(GROUPS + 1))
    for g in range(GROUPS):
        a, b = edges[g], edges[g + 1]
        if a == b:
            continue
        part = _softmax(hidden[a:b] @ p["word"][g].T + p["word_bias"][g])
        own = np.arange(b - a)
        out[a:b] += np.log(np.maximum(part[own, within[a:b]], 1e-30))
        if gradient is not None:
            part = -part
            part[own, within[a:b]] += 1
            gradient["word"][g] += part.T @ hidden[a:b]
            gradient["word_bias"][g] += part.sum(0)
            back[a:b] += part @ p["word"][g]
    if gradient is not None:
        back *= 1 - hidden * hidden
        gradient["bend"] += back.sum(0)
        for k, n in enumerate(near):
            # Sums of rows by entry: sort once, then add up runs.
            by = np.argsort(n, kind="stable")
            entries, first = np.unique(n[by], return_index=True)
            gradient["near"][k][entries] += np.add.reduceat(back[by], first, axis=0)
    result = np.empty(len(at))
    result[order] = out
    return result


def _padded(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array with pads between; the places of their words, and their numbers of words."""
    texts = [np.frombuffer(b, np.int16) for b in blobs]
    pad = np.full(WINDOW, _PAD, np.int16)
    n = np.array([len(t) for t in texts], np.int64)
    ids = np.concatenate([pad, *(x for t in texts for x in (t, pad))])
    places = np.arange(n.sum()) + np.repeat(np.arange(1, len(n) + 1) * WINDOW, n)
    return ids, places, n


def _pieces(column: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in pieces of about ``most`` bytes: the number of the first one, and their entries."""
    first, size, out = 0, 0, []
    for i, blob in enumerate(column.to_pylist()):
        if out and size + len(blob) > most:
            yield first, out
            first, size, out = i, 0, []
        out.append(blob)
        size += len(blob)
    if out:
        yield first, out


def _masked(ids: np.ndarray, places: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """The places that are masked: by a hash of the place in its text and the words around."""
    inner = np.arange(len(places)) - np.repeat(np.cumsum(n) - n, n)
    mark = inner.astype(U) * _SEED + ids[places].astype(U) + ids[places - 1].astype(U) * U(4099)
    return places[finish(mark) % U(100) < U(percent)]


def _flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in _SHAPES])


def _shaped(flat: np.ndarray) -> Parameters:
    ends = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()])
    return {k: part.reshape(s).astype(np.float32) for (k, s), part in zip(_SHAPES.items(), np.split(flat, ends[:-1]))}


def round_gradient(rows: DataFrame, p: Parameters, percent: int = MASKED) -> tuple[np.ndarray, float, int]:
    """Sum of the gradients over the masked places of ``rows``, of the log-probabilities, and their number."""
    spark = rows.sparkSession
    shipped = spark.sparkContext.broadcast(_flat(p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _shaped(shipped.value)
        gradient = {k: np.zeros(s) for k, s in _SHAPES.items()}
        total, count = 0.0, 0
        for batch in batches:
            for _, blobs in _pieces(batch.column(0)):
                ids, places, n = _padded(blobs)
                at = _masked(ids, places, n, percent)
                if len(at):
                    total += float(log_probabilities(own, ids, at, gradient).sum())
                    count += len(at)
        if count:
            flat = np.concatenate([_flat(gradient), [total, count]])
            parts = np.array_split(flat, SLICES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([x.tobytes() for x in parts], pa.binary())],
                names=["slice", "part"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(part)
                sums[k] = sums[k] + part if k in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["slice", "part"]
            )

    parts = rows.select("ids").mapInArrow(run, "slice int, part binary")
    summed = parts.repartition(SLICES, "slice").mapInArrow(add, "slice int, part binary").collect()
    shipped.destroy()
    if not summed:
        return np.zeros(sum(int(np.prod(s)) for s in _SHAPES.values())), 0.0, 0
    flat = np.concatenate([np.frombuffer(r["part"]) for r in sorted(summed, key=lambda r: r["slice"])])
    return flat[:-2], float(flat[-2]), int(flat[-1])


def train(path: str, spark, frequency: np.ndarray, rounds: int = ROUNDS, rate: float = LEARNING_RATE) -> tuple[Parameters, list[float]]:
    """Parameters after one pass over all rounds (tables below ``path``), and each round's mean log-probability."""
    flat = _flat(start(frequency)).astype(np.float64)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    means = []
    done = 0
    every = spark.read.parquet(path)
    for r in range(rounds):
        gradient, total, n = round_gradient(every.where(F.col("round") == r), _shaped(flat))
        if not n:
            continue
        done += 1
        means.append(total / n)
        gradient /= n
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        step = first / (1 - 0.9**done) / (np.sqrt(second / (1 - 0.99**done)) + 1e-8)
        flat += rate * step * (1 - r / (2 * rounds))
    return _shaped(flat), means


def entry_counts(counts: DataFrame, top: np.ndarray) -> np.ndarray:
    """Occurrences in the corpus of each entry; one aggregated row per entry reaches the driver."""
    n = len(top)
    listed = counts.sparkSession.createDataFrame(
        [(int(h), i) for i, h in enumerate(top.view(np.int64).tolist())], "word bigint, entry int"
    )
    # Hashes are unsigned; their remainder must be the one that encode() takes.
    shared = F.lit(VOCABULARY - SHARED) + F.col("word").bitwiseAND(F.lit(SHARED - 1)).cast("int")
    own = counts.join(F.broadcast(listed), "word", "left").select(F.coalesce("entry", shared).alias("entry"), "n")
    out = np.zeros(VOCABULARY)
    for r in own.groupBy("entry").agg(F.sum("n").alias("n")).collect():
        out[r["entry"]] = r["n"]
    assert n <= VOCABULARY - SHARED
    return out


def scores(rows: DataFrame, p: Parameters, frequency: np.ndarray | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, *keep) from encoded documents.

    Words in shared entries count as their entries, divided by the entries' occurrences
    if ``frequency`` is given.
    """
    less = np.zeros(VOCABULARY)
    if frequency is not None:
        less[VOCABULARY - SHARED :] = np.log(np.maximum(frequency[VOCABULARY - SHARED :], 1))
    shipped = rows.sparkSession.sparkContext.broadcast(_flat(p))
    kept = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep]
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _shaped(shipped.value)
        for batch in batches:
            for first, blobs in _pieces(batch.column(1)):
                ids, places, n = _padded(blobs)
                logs = log_probabilities(own, ids, places) - less[ids[places]] if len(places) else np.zeros(0)
                sums = np.concatenate([[0.0], np.cumsum(logs)])
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(n)),
                        pa.array(n),
                        pa.array(sums[ends] - sums[ends - n]),
                        *(batch.column(k).slice(first, len(n)) for k in range(2, batch.num_columns)),
                    ],
                    names=["doc_id", "n_tokens", "log_likelihood", *keep],
                )

    return rows.select("doc_id", "ids", *keep).mapInArrow(
        run, ", ".join([f"doc_id {id_type}, n_tokens bigint, log_likelihood double", *kept])
    )


def with_own_shares(scored: DataFrame, counted: DataFrame) -> DataFrame:
    """``scored`` (with ``block``, ``rare``) plus the logarithm of each rarer word's occurrences."""
    id_type = scored.schema["doc_id"].dataType.simpleString()

    def run(docs: pa.Table, listed: pa.Table) -> pa.Table:
        blobs = docs.column("rare").to_pylist()
        at = np.frombuffer(b"".join(blobs), np.int32)
        logs = np.zeros(at.max(initial=-1) + 1)
        logs[listed.column("place").to_numpy()] = np.log(listed.column("n").to_numpy())
        of = np.repeat(np.arange(len(blobs)), [len(b) // 4 for b in blobs])
        own = np.bincount(of, logs[at], len(blobs))
        total = docs.column("log_likelihood").to_numpy() + own
        return pa.table({"doc_id": docs.column("doc_id"), "n_tokens": docs.column("n_tokens"), "log_likelihood": total})

    return (
        scored.groupBy("block").cogroup(counted.groupBy("block"))
        .applyInArrow(run, f"doc_id {id_type}, n_tokens bigint, log_likelihood double")
    )


def scored_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Every document with its words, their summed conditional log-probabilities, and the mean.

    A word in a shared entry has the entry's probability times its own share of the entry's
    occurrences in the corpus.

    A null text, and one without words, has score 0 and a null mean. Repeated rows get
    equal scores and count in training as often as they occur; other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    counts = stage(word_counts(docs), "words")
    top = vocabulary(counts)
    frequency = entry_counts(counts, top)
    path = stage_path(spark, "encoded")
    encoded(docs, top, rounds).write.partitionBy("round").parquet(path)
    schema = _encoded_schema(docs)
    if not frequency.sum():
        model = start(frequency)
    else:
        model, _ = train(path, spark, frequency, rounds)
    rows = spark.read.schema(schema).parquet(path)
    scored = with_own_shares(scores(rows, model, frequency, ("block", "rare")), listed_counts(rows, counts))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return scored.withColumn("log_likelihood", F.round("log_likelihood", 3)).withColumn("mean_log_likelihood", mean)
