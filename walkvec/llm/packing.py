"""Packing of tokenized examples into sequences, as vector bin packing.

An example demands three things of a sequence: tokens, one segment, and loss-bearing
tokens, and a sequence has a limit on each. Sequences are filled one at a time: of the
pieces that fit, the one comes next whose demand has the largest dot product with the room left,
each dimension weighed by its mean demand, so that the scarce one counts most.

Examples longer than a sequence are cut; a full sequence of one example needs no
packing. The rest waits in a pool of bounded size in the task that has read it. Sequences
that are nearly full leave the pool. What does not fill up is cut at a power of two,
the largest within its tokens, so that nothing is padded at the end either. No rows are shuffled and a task
depends on its own rows only, so a lost one is done again with the same result.

Very long texts are tokenized in parts, between a character and the white space that follows it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkvec.llm.textnum import chunks

END = 1
#: Pieces that wait in a task at most.
POOL = 1_024
#: Longer texts are tokenized in parts of about so many characters.
PIECE = 1 << 20
#: Sequence numbers of a task begin at its number times this.
_SEQUENCES = 1 << 33


class Limits(NamedTuple):
    """What one sequence may hold; up to ``slack`` unused tokens count as full."""

    tokens: int = 2_048
    segments: int = 256
    loss: int = 2_048
    slack: int = 16


# --- token ids ----------------------------------------------------------------

# White space as the pattern knows it (U+001C to U+001F are not in it), the
# pattern that parts a text before the merges, and the special token.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}

#: A text parts here without changing its ids: white space never ends a piece of the pattern that begins otherwise.
BORDER = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")


class Tokenizer:
    """Ids of texts, as unsigned little-endian 32-bit numbers."""

    def __init__(self, path: str | None):
        import tiktoken

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.tiktoken")
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def ids(self, text: str) -> bytes:
        return b"".join(self._ids(part) for part in parts(text))

    def _ids(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def parts(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE`` characters whose ids, one after another, are the text's."""
    at = 0
    while len(text) - at > PIECE and (cut := BORDER.search(text, at + PIECE)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


_tokenizers: dict[str | None, Tokenizer] = {}


def tokenizer(path: str | None) -> Tokenizer:
    """The worker's tokenizer of these ranks; it stays for the worker's next tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


# --- packing ------------------------------------------------------------------


class Piece(NamedTuple):
    """A run of an example's ids from ``start``; the first ``prompt`` ids of the example bear no loss."""

    doc_id: object
    start: int
    ids: bytes
    prompt: int
    doc_tokens: int

    @property
    def tokens(self) -> int:
        return len(self.ids) // 4

    @property
    def free(self) -> int:
        """Ids at the beginning without loss: the rest of the prompt, and the first in any case."""
        return max(1, self.prompt - self.start)

    @property
    def loss(self) -> int:
        return max(0, self.tokens - self.free)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * n]), self._replace(start=self.start + n, ids=self.ids[4 * n :])


def filled(demand: np.ndarray, limits: Limits) -> list[list[int]]:
    """Rows of ``demand`` (tokens, segments, loss) by sequence, one sequence after another."""
    limit = np.array(limits[:3], float)
    demand = np.ascontiguousarray(demand.T)
    value = demand / limit[:, None]
    value *= value.mean(1)[:, None]
    left = np.ones(demand.shape[1], bool)
    out = []
    while len(at := np.flatnonzero(left)):
        room, own = limit.copy(), []
        d, v = demand[:, at], value[:, at]
        while True:
            fits = (d[0] <= room[0]) & (d[1] <= room[1]) & (d[2] <= room[2])
            if not fits.all():
                d, v, at = d[:, fits], v[:, fits], at[fits]
            if not len(at):
                break
            best = int(np.argmax((room / limit) @ v))
            own.append(int(at[best]))
            room -= d[:, best]
            d[0, best] = limit[0] + 1  # taken
        left[own] = False
        out.append(own)
    return out


class Packer:
    """Sequences (lists of pieces) from examples, with a pool of waiting pieces."""

    def __init__(self, limits: Limits = Limits(), pool: int = POOL):
        self.limits, self.most = limits, pool
        self.pool: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        tokens = self.limits.tokens
        while piece.tokens > (n := min(tokens, piece.free + self.limits.loss)):
            head, piece = piece.cut(n)
            if n == tokens:
                yield [head]
            else:
                self.pool.append(head)
        self.pool.append(piece)
        while len(self.pool) >= self.most:
            yield from self._pack(more=True)

    def close(self) -> Iterator[list[Piece]]:
        while self.pool:
            yield from self._pack(more=False)

    def _pack(self, more: bool) -> Iterator[list[Piece]]:
        pieces, self.pool = self.pool, []
        demand = np.array([(p.tokens, 1, p.loss) for p in pieces], float)
        under = []
        for rows in filled(demand, self.limits):
            if self.limits.tokens - demand[rows, 0].sum() <= self.limits.slack:
                yield [pieces[i] for i in rows]
            else:
                under.append([pieces[i] for i in rows])
        if more and 2 * sum(map(len, under)) <= len(pieces):
            self.pool = [p for own in under for p in own]
            return
        # Too little was filled up, or nothing more comes.
        for own in under:
            room = 1 << (sum(p.tokens for p in own).bit_length() - 1)
            sequence = []
            for p in own:
                if room == 0:
                    self.pool.append(p)
                    continue
                if p.tokens > room:
                    p, rest = p.cut(room)
                    self.pool.append(rest)
                sequence.append(p)
                room -= p.tokens
            yield sequence


def packed(
    docs: DataFrame, limits: Limits = Limits(), path: str | None = None, prompt: str | None = None, end: int = END, pool: int = POOL
) -> DataFrame:
    """Every document's ids, in pieces, each at its place in a sequence.

    Columns: doc_id, start (the document's ids before the piece), ids (unsigned
    little-endian 32-bit numbers), n_loss, doc_tokens, sequence_id, offset (ids before the
    piece in its sequence). ``docs`` has doc_id and text and, if ``prompt`` names one, a column of texts
    that come first and bear no loss; other columns are ignored. An example's ids are
    those of prompt and text, each tokenized by itself, and ``end``; null texts count as empty, so
    every row has one id at least. Repeated rows and rows without an id are examples of
    their own. Sequences hold up to ``limits``; those with more unused tokens than
    ``limits.slack`` have a power of two of them. Sequence numbers are unique, not
    consecutive. An empty table gives no rows. ``path`` names the file of token ranks.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start bigint, ids binary, n_loss bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    names = [part.strip().split()[0] for part in ("doc_id", *schema.split(", ")[1:])]
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, packer = tokenizer(path).ids, Packer(limits, pool)
        number = TaskContext.get().partitionId() * _SEQUENCES
        rows: list[tuple] = []
        kind = None

        def place(sequence: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for p in sequence:
                rows.append((p.doc_id, p.start, p.ids, p.loss, p.doc_tokens, number, offset))
                offset += p.tokens
            number += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows))
            types = [kind, pa.int64(), pa.binary(), *[pa.int64()] * 4]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            kind = batch.column(0).type
            ids = batch.column(0).to_pylist()
            asked = batch.column(2).to_pylist() if prompt else None
            for i, text in enumerate(_texts(batch.column(1))):
                before = find(asked[i] or "") if asked else b""
                own = before + find(text) + last
                for sequence in packer.add(Piece(ids[i], 0, own, len(before) // 4, len(own) // 4)):
                    place(sequence)
                if len(rows) >= POOL:
                    yield batch_of()
        for sequence in packer.close():
            place(sequence)
        if rows:
            yield batch_of()

    return docs.select("doc_id", "text", *([F.col(prompt).alias("_prompt")] if prompt else [])).mapInArrow(run, schema)


def _texts(column: pa.Array) -> Iterator[str]:
    for chunk in chunks(column):
        data = chunk.data.tobytes()
        for low, high in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist()):
            yield data[low:high].decode()


def digested(pieces: DataFrame) -> DataFrame:
    """The pieces with their length and checksum instead of their ids."""
    return pieces.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("bigint").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
