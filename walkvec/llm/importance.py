"""Importance resampling towards a target: hashed word runs, log ratios, Gumbel draws.

Texts are handled as UTF-8 bytes: a table of 256 bytes lower-cases A-Z and turns every
separator into a space, bytes.split gives the words, and the checksum of a run of words is
that of the run before it, carried on over a space and the next word. A Counter per
task sums the buckets of all its texts, and only its at most ``buckets`` entries leave
the task.

The number of buckets is a parameter, so the table of their gains has a fixed size and
goes to every task. Weights plus Gumbel noise from each document's id make the scores;
the highest scores are a weighted draw without replacement. Ranks come from a range
partitioning, so no task sorts all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.llm.textnum import chunks
from walkvec.operators.dense_index import dense_index
from walkvec.stage import stage

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: A text is split piece by piece of about so many bytes.
PIECE = 1 << 20


def _table() -> bytes:
    """Words consist of ASCII letters and digits and all bytes beyond ASCII."""
    kept = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
    out = bytearray(b" " * 256)
    for b in kept:
        out[b] = b
    for b in range(0x41, 0x5B):
        out[b] = b + 32
    return bytes(out)


TABLE = _table()


def run_checksums(text: bytes, longest: int = LONGEST_RUN, piece: int = PIECE) -> Iterator[list[list[int]]]:
    """For each piece of a text the checksums of its runs of 1, 2, … ``longest`` words.

    A run belongs to the piece that holds its last word.
    """
    flat = text.translate(TABLE)
    before: list[bytes] = []
    at = 0
    while at < len(flat):
        end = flat.find(b" ", at + piece)
        end = len(flat) if end < 0 else end
        words = before + flat[at:end].split()
        spaced = [b" " + w for w in words]
        known = len(before)
        sums = [list(map(crc32, words))]
        for n in range(1, longest):
            sums.append(list(map(crc32, spaced[n:], sums[-1])))
        yield [s[max(known - n, 0) :] for n, s in enumerate(sums)]
        before = words[len(words) - min(len(words), longest - 1) :]
        at = end


def _texts(batch: pa.RecordBatch, at: int) -> Iterator[bytes]:
    for chunk in chunks(batch.column(at)):
        data = chunk.data.tobytes()
        for low, high in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist()):
            yield data[low:high]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """(bucket, n): how many runs of words of all texts fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in _texts(batch, 0):
                for piece in run_checksums(text, longest):
                    for sums in piece:
                        counts.update((np.array(sums, np.uint32) % buckets).tolist())
        columns = [pa.array(list(x), pa.int64()) for x in (counts.keys(), counts.values())]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n"])

    own = texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """What each bucket adds to a weight: a thousand times its log ratio, rounded down."""
    all_raw, all_target = sum(raw.values()), sum(target.values())

    def gain(b: int) -> int:
        wanted = float(target.get(b, 0) + 1) * float(all_raw + buckets)
        return math.floor(1000 * math.log(wanted / (float(raw.get(b, 0) + 1) * float(all_target + buckets))))

    return np.array([gain(b) for b in range(buckets)], np.int64)


def learned_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """Gains from the counts over all documents and all target texts; the driver gets ``buckets`` numbers of each."""
    counts = [{r.bucket: r.n for r in bucket_counts(t, buckets, longest).collect()} for t in (docs, target)]
    return gains(*counts, buckets)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in _texts(batch, 1):
                words = features = weight = 0
                for piece in run_checksums(text, longest):
                    words += len(piece[0])
                    for sums in piece:
                        features += len(sums)
                        weight += int(gain[np.array(sums, np.uint32) % buckets].sum())
                rows.append((words, features, weight))
            numbers = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(numbers[:, i]) for i in range(3))], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_words bigint, n_features bigint, weight bigint")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    longest: int = LONGEST_RUN,
) -> DataFrame:
    """Every document with its weight towards the target texts, its score, and its rank in the draw.

    ``docs`` has doc_id and text, ``target`` has text; other columns are ignored. A null
    text has no words, so no features and weight 0. Of the documents with
    ``least_words`` words the ``percent`` hundredths with the highest scores are drawn,
    ties to the smaller doc_id (null last); rank counts from 1 and is null for all others.
    Repeated rows are rows of their own with equal scores. A null id counts as an empty one in
    the noise. Empty tables give no rows, or gains from an empty target.
    """
    gain = learned_gains(docs, target, buckets, longest)
    noise = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(noise, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")
    scored = stage(weighed(docs, gain, longest).withColumn("score", F.col("weight") + gumbel), "scored")
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    # One order for all rows that may be drawn; equal rows may take each other's place.
    ordered = scored.where(enough).select("*", F.lit(0).alias("_all"), (-F.col("score")).alias("_low"), F.col("doc_id").isNull().alias("_bare"))
    order = ["_low", "_bare", "doc_id", "n_features", "weight", "n_words"]
    ranked = dense_index(ordered, ["_all"], order, "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1).cast("bigint").alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(~enough).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked.select(*columns, rank).unionByName(rest)
