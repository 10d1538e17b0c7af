import hashlib
import math
import random
import re
import zlib
from collections import Counter

from cases import bag, documents, lower, prose

from walkvec.llm.importance import resampled, run_checksums

COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(rows, target):
    """The contract in plain Python, for rows (doc_id, text); undrawn first by rank."""
    own = [(i, *features(t)) for i, t in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10_000)]
    out = []
    for i, words, f in own:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append((i, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((x for x in out if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2], x[3]))
    drawn = 5 * len(enough) // 100
    rest = [x for x in out if x[1] < 20]
    return [(x[0], *x[2:], k + 1 if k < drawn else None) for k, x in enumerate(enough)] + [(x[0], *x[2:], None) for x in rest]


def test_matches_plain_python(spark):
    rng = random.Random(9)
    passages = [prose(rng, 60, 3000) for _ in range(5)] + [None, "", "ÜBER Straße: naïve, test-case 3.14"]
    rows = [(1000 + i, prose(rng, rng.randrange(10, 120), 3000), "en", "a") for i in range(120)]
    rows += [(2000 + i, passages[i % 5].upper() + "\n" + prose(rng, 20), "en", "b") for i in range(20)]
    docs = documents(spark).unionByName(documents(spark, rows)).repartition(5)
    target = spark.createDataFrame([(i, t) for i, t in enumerate(passages)], "item_id bigint, text string")
    got = resampled(docs, target)
    want = plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], passages)
    assert bag(got, *COLUMNS) == Counter(want)
    ranks = sorted(r for *_, r in want if r)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) >= 5
    assert sum(1 for r in got.collect() if r["rank"] and r.doc_id and 2000 <= r.doc_id < 2020) >= 5


def test_pieces_change_nothing():
    rng = random.Random(2)
    for text in (b"", b" ,;", b"one", prose(rng, 50).encode(), "é, ß! A-b\tc".encode() * 9):
        whole = [x for piece in run_checksums(text) for sums in piece for x in sums]
        for piece in (1, 2, 7, 30):
            assert Counter(x for p in run_checksums(text, 3, piece) for sums in p for x in sums) == Counter(whole)


def test_equal_scores_of_repeated_rows(spark):
    rows = [(5, "word " * 30, None, None)] * 40 + [(None, "word " * 25, None, None)] * 40
    got = resampled(documents(spark, rows), documents(spark, rows[:1]))
    want = plain([(r[0], r[1]) for r in rows], [rows[0][1]])
    assert bag(got, *COLUMNS) == Counter(want)


def test_empty_tables(spark):
    docs = documents(spark)
    assert resampled(docs.limit(0), docs).count() == 0
    assert bag(resampled(docs, docs.limit(0)), *COLUMNS) == Counter(plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], []))
