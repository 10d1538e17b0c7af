"""Secret scans through a trigram inverted index.

From every rule's regular expression a Boolean query over trigrams is derived: an AND
of clauses, each an OR of trigram sets one of which every match must contain. The
documents are indexed in segments, the chunks in which a task reads them: a segment
has one posting list per trigram that some rule asks for. A rule's candidates come
from intersecting and uniting the posting lists, and only they meet the regular
expression itself. Rules without a mandatory trigram scan every text.

A segment is built, searched and dropped within its task, so nothing is shuffled and
memory follows the size of a chunk.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from walkvec.llm.textnum import LOWER, Chunk, chunks

try:  # the parser's name since Python 3.11
    from re import _parser as parser
except ImportError:  # pragma: no cover
    import sre_parse as parser

#: Alternatives of one run of literals that are followed one by one.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the group that ``least`` measures
    least: int = 0  # matches whose group has fewer code points are dropped


#: Base rules, in the order of the contract, then those that this operator adds.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
ADDED = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED

#: AND of clauses; a clause is an OR of sets of trigrams that must all occur.
Query = tuple[frozenset[frozenset[int]], ...]


def _code(gram: bytes) -> int:
    return gram[0] << 16 | gram[1] << 8 | gram[2]


def _grams(text: bytes) -> frozenset[int]:
    return frozenset(_code(text[i : i + 3]) for i in range(len(text) - 2))


def _literal(char: int) -> bytes:
    text = chr(char)
    return (text.lower() if "A" <= text <= "Z" else text).encode()


def trigram_query(pattern: str) -> Query:
    """The clauses that every match of ``pattern`` satisfies, over texts with A-Z lower-cased.

    Runs of literals are followed as sets of possible strings; a set is closed, and
    becomes a clause, where something unbounded follows. An empty result means that
    the pattern has no mandatory trigram.
    """
    clauses: list[frozenset[frozenset[int]]] = []

    def close(strings: set[bytes]) -> set[bytes]:
        options = {_grams(s) for s in strings}
        if all(options):
            clauses.append(frozenset(options))
        return {b""}

    def exact(nodes) -> set[bytes] | None:
        """All strings the nodes can match, or None if there are too many."""
        found = {b""}
        for op, arg in nodes:
            own = exact_node(op, arg)
            if own is None or len(found) * len(own) > MOST_STRINGS:
                return None
            found = {a + b for a, b in product(found, own)}
        return found

    def exact_node(op, arg) -> set[bytes] | None:
        name = str(op)
        if name == "LITERAL":
            return {_literal(arg)}
        if name == "IN":
            chars: set[bytes] = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    chars.add(_literal(value))
                elif str(kind) == "RANGE" and value[1] - value[0] < MOST_STRINGS:
                    chars |= {_literal(c) for c in range(value[0], value[1] + 1)}
                else:
                    return None
            return chars
        if name == "BRANCH":
            options = [exact(branch) for branch in arg[1]]
            if any(o is None for o in options):
                return None
            return set().union(*options)
        if name == "SUBPATTERN":
            return exact(arg[3])
        if name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = arg
            own = exact(body)
            if own is None or high > 4:
                return None
            out: set[bytes] = set()
            for n in range(low, high + 1):
                out |= {b"".join(p) for p in product(own, repeat=n)}
            return out
        if name == "AT":
            return {b""}
        return None

    def follow(nodes, strings: set[bytes]) -> set[bytes]:
        for op, arg in nodes:
            own = exact_node(op, arg)
            if own is not None and len(own) * len(strings) <= MOST_STRINGS:
                strings = {a + b for a, b in product(strings, own)}
                continue
            strings = close(strings)
            if own is not None and len(own) <= MOST_STRINGS:
                strings = own
            elif str(op) == "SUBPATTERN":
                strings = follow(arg[3], strings)
            elif str(op) in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
                strings = close(follow(arg[2], strings))
        return strings

    close(follow(parser.parse(pattern), {b""}))
    return tuple(dict.fromkeys(clauses))


def postings(chunk: Chunk, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """The inverted index of a chunk: for each wanted trigram the texts that contain it, ascending."""
    data = LOWER[chunk.data].astype(np.int32)
    if len(data) < 3 or not len(wanted):
        return {}
    # Few trigrams are wanted: their first two bytes select the places worth a closer look.
    pairs = np.zeros(1 << 16, bool)
    pairs[wanted >> 8] = True
    places = np.flatnonzero(pairs[data[:-2] << 8 | data[1:-1]])
    codes = data[places] << 16 | data[places + 1] << 8 | data[places + 2]
    known = np.isin(codes, wanted)
    places, codes = places[known], codes[known]
    text = np.searchsorted(chunk.offsets, places, "right") - 1
    within = places + 2 < chunk.offsets[text + 1]
    entries = np.unique(codes[within].astype(np.int64) << 32 | text[within])
    codes, text = entries >> 32, entries & 0xFFFFFFFF
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else []
    return {int(codes[s]): part for s, part in zip(starts, np.split(text, starts[1:]))} if len(codes) else {}


def candidates(query: Query, index: dict[int, np.ndarray], n: int) -> np.ndarray:
    """The texts of a segment that satisfy a query; all ``n`` if it has no clause."""
    none = np.zeros(0, np.int64)
    found = None
    for clause in query:
        options = [reduce(np.intersect1d, (index.get(g, none) for g in sorted(grams))) for grams in clause]
        united = reduce(np.union1d, options)
        found = united if found is None else np.intersect1d(found, united)
    return np.arange(n) if found is None else found.astype(np.int64)


def spans(rule: Rule, expression: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, in code points, without those that are too short."""
    return [m.span() for m in expression.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """Every document with its numbers of base matches, their checksum and all spans.

    ``docs`` has doc_id and text; other columns are ignored. A null text counts as
    empty, a text without matches has the checksum of an empty string. Spans are
    kind:start:end, ordered by start, then kind as listed. Rows are scanned each for
    themselves, so repeated rows give equal results; an empty table gives no rows.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = np.array(sorted({g for q in queries for clause in q for option in clause for g in option}), np.int32)
    kinds = [r.kind for r in rules[:base]]
    names = ["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_type}", *(f"n_{k} bigint" for k in kinds), "base_sha256 string", "spans string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expressions = [re.compile(r.pattern, re.ASCII) for r in rules]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            found: dict[int, list[tuple[int, int, int]]] = {}
            for chunk in chunks(texts):
                n = len(chunk.offsets) - 1
                index = postings(chunk, wanted)
                raw = chunk.data.tobytes()
                decoded: dict[int, str] = {}
                for k, (rule, query) in enumerate(zip(rules, queries)):
                    for i in candidates(query, index, n).tolist():
                        if i not in decoded:
                            decoded[i] = raw[chunk.offsets[i] : chunk.offsets[i + 1]].decode()
                        for start, end in spans(rule, expressions[k], decoded[i]):
                            found.setdefault(chunk.first + i, []).append((start, k, end))
            n = len(ids)
            counts = np.zeros((base, n), np.int64)
            sums, listed = [], []
            for i in range(n):
                own = sorted(found.get(i, ()))
                for _, k, _ in own:
                    if k < base:
                        counts[k, i] += 1
                named = [(k, f"{rules[k].kind}:{s}:{e}") for s, k, e in own]
                sums.append(hashlib.sha256(",".join(t for k, t in named if k < base).encode()).hexdigest())
                listed.append(",".join(t for _, t in named))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c) for c in counts), pa.array(sums, pa.string()), pa.array(listed, pa.string())], names=names
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
