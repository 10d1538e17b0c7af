import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import documents, prose
from tokenizers import Tokenizer as Reference

from walkvec.llm.packing import Limits, Packer, Piece, Tokenizer, digested, filled, packed, parts

SPACES = "\t\n\x0b\x0c\r \x85\xa0        　"


@pytest.fixture(scope="module")
def reference():
    own = Reference.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: own.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_reference(reference):
    rng = random.Random(3)
    letters = [*map(chr, range(0x30)), *SPACES, *"\x1c\x1f᠎​﻿̀٣", "a", "é", "京", "'s", "'", "𝒳", "<|endoftext|>", "word", "12"]
    own = Tokenizer(None)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(9)))
        assert np.frombuffer(own.ids(text), "<u4").tolist() == reference(text), ascii(text)


def test_long_texts_are_parted(monkeypatch, reference):
    monkeypatch.setattr("walkvec.llm.packing.PIECE", 64)
    rng = random.Random(1)
    own = Tokenizer(None)
    for _ in range(200):
        text = "".join(rng.choice([*SPACES, "<|endoftext|>", "\x1c", "!", "é", *("word", "12") * 20]) for _ in range(rng.randrange(200)))
        assert "".join(parts(text)) == text and (len(text) < 300 or len(list(parts(text))) > 1)
        assert np.frombuffer(own.ids(text), "<u4").tolist() == reference(text)


@pytest.mark.parametrize("text", ["y" * 300_000, " " * 300_000, "\n" * 300_000 + "x", "!" * 300_000])
def test_texts_without_a_border(text):
    ids = np.frombuffer(Tokenizer(None).ids(text), "<u4").tolist()
    assert Tokenizer(None).encoding.decode(ids) == text


def check(rows, limits, sizes):
    """Rows (doc, start, length, loss, sequence, offset): whole documents, gapless sequences, limits, padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, loss, sequence, offset in rows:
        by_doc[doc].append((start, length))
        by_sequence[sequence].append((offset, length, loss))
    assert by_doc.keys() == sizes.keys()
    for doc, own in by_doc.items():
        at = 0
        for start, length in sorted(own):
            assert start == at and length > 0
            at += length
        assert at == sizes[doc]
    padding = 0
    for own in by_sequence.values():
        at = 0
        for offset, length, _ in sorted(own):
            assert offset == at
            at += length
        assert at <= limits.tokens and len(own) <= limits.segments and sum(x[2] for x in own) <= limits.loss
        assert at & (at - 1) == 0 or limits.tokens - at <= limits.slack
        padding += limits.tokens - at if at & (at - 1) else 0
    return padding


@pytest.mark.parametrize("limits", [Limits(), Limits(64, 4, 50, 1), Limits(64, 64, 20, 0), Limits(128, 2, 128, 3)])
@pytest.mark.parametrize("pool", [8, 100])
def test_limits_hold(limits, pool):
    rng = random.Random(pool)
    packer, out, sizes = Packer(limits, pool), [], {}
    lengths = [rng.choice([1, 2, 3, rng.randrange(1, 90), rng.randrange(1, 3 * limits.tokens)]) for _ in range(400)]
    lengths += [limits.tokens // 2 + 3] * 60 + [1] * 100
    for i, n in enumerate(lengths):
        sizes[i] = n
        out += packer.add(Piece(i, 0, bytes(4 * n), rng.randrange(n + 1), n))
    out += packer.close()
    rows = []
    for number, sequence in enumerate(out):
        at = 0
        for p in sequence:
            rows.append((p.doc_id, p.start, p.tokens, p.loss, number, at))
            at += p.tokens
    padding = check(rows, limits, sizes)
    assert padding <= 0.02 * sum(lengths)


def test_scarce_dimension_counts():
    """Two kinds, long ones without loss and short ones full of it: the heuristic mixes them."""
    demand = np.array([(90, 1, 0)] * 10 + [(10, 1, 100)] * 10, float)
    bins = filled(demand, Limits(100, 10, 100, 0))
    assert sorted(sorted(d // 10 for d in own) for own in bins) == [[0, 1]] * 10


def test_documents_round_trip(spark, reference):
    docs = documents(spark)
    got = packed(docs).collect()
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(tuple([*reference(r.text or ""), 1]))
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        found[r.doc_id].append((r.start, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.doc_tokens))
    for doc, own in found.items():
        assert sum(len(ids) for _, ids, _ in own) == sum(map(len, texts[doc]))
        for start, ids, total in own:
            assert any(t[start : start + len(ids)] == ids and len(t) == total for t in texts[doc])
    assert found.keys() == texts.keys()
    by_sequence = defaultdict(int)
    for r in got:
        by_sequence[r.sequence_id] += len(r.ids) // 4
    assert all(n <= 2048 and (n & (n - 1) == 0 or n >= 2032) for n in by_sequence.values())


def test_distinct_documents_are_whole(spark, reference):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.choice([0, 3, 40, 400, 3000])), "en", "a") for i in range(60)]
    docs = documents(spark, rows).repartition(3)
    got = [tuple(r) for r in packed(docs).selectExpr("doc_id", "start", "cast(length(ids) / 4 as bigint)", "n_loss", "sequence_id", "offset").collect()]
    check(got, Limits(), {r[0]: len(reference(r[1])) + 1 for r in rows})


def test_digest(spark, reference):
    r = digested(packed(documents(spark, [(7, "Hello world, again", None, None)]))).collect()
    data = np.array([*reference("Hello world, again"), 1], "<u4").tobytes()
    assert sum(x.length for x in r) == len(data) // 4
    assert all(x.ids_crc32 == zlib.crc32(data[4 * x.start : 4 * (x.start + x.length)]) for x in r)
    assert r[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


def test_prompts_bear_no_loss(spark, reference):
    df = spark.createDataFrame([(1, "the question is", " answer"), (2, None, " answer only"), (3, "only a question", None)], "doc_id bigint, ask string, text string")
    loss = defaultdict(int)
    for r in packed(df, limits=Limits(4096), prompt="ask").collect():
        loss[r.doc_id] += r.n_loss
    n = {1: len(reference(" answer")) + 1, 2: len(reference(" answer only")), 3: 1}
    # A cut at a power of two takes the loss of a piece's first id.
    assert all(n[i] - 3 <= loss[i] <= n[i] for i in n)


def test_empty_table(spark):
    assert packed(documents(spark).limit(0)).count() == 0
