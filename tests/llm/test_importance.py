import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from provfin.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buckets(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def expected(rows, target, least_words=20, percent=5):
    made = [buckets(t) for _, t in rows]
    s, t = Counter(b for _, f in made for b in f), Counter(b for x in target for b in buckets(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for (doc_id, _), (n, f) in zip(rows, made):
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def planted(rng):
    words = [f"w{i}" for i in range(300)] + ["É", "日本", "Straße", "x" * 63, "y" * 64, "Z" * 65, "q" * 500, "A"]
    line = lambda: rng.choice([" ", ", ", " - "]).join(rng.choice(words) for _ in range(rng.randint(0, 12)))
    pool = [line() for _ in range(30)]
    return [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else line() for _ in range(rng.randint(0, 9)))) for i in range(150)]


@pytest.mark.parametrize("percent", [5, 60])
def test_matches_a_plain_count(spark, odd_docs, percent):
    made = planted(random.Random(8))
    docs = spark.createDataFrame(made, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text")).repartition(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = [made[3][1], None, "", "w1 w2 w3\nw4", made[3][1]]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    want = expected(rows, target, percent=percent)
    assert sorted((tuple(r) for r in importance.report(docs, aim, percent=percent).collect()), key=str) == want
    drawn = sorted((r.doc_id for r in importance.resample(docs, aim, percent=percent).collect()), key=str)
    assert set(drawn) == {r[0] for r in want if r[4] is not None} and len(drawn) >= sum(r[4] is not None for r in want)


def test_segments_count_what_whole_texts_have(spark):
    texts = [t for _, t in planted(random.Random(4))] + ["a\nb\nc", "a\n\n\nb", "\n", "", None, "one", "a b\nc"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    want = Counter(b for t in texts for b in buckets(t)[1])
    found = importance.features(docs)
    assert {i: int(n) for i, n in enumerate(found) if n} == want


def test_checksums_of_joined_texts():
    rng = random.Random(2)
    for _ in range(200):
        a, b = rng.randbytes(rng.randint(0, 90)), rng.randbytes(rng.randint(0, importance.SHORT))
        made = importance._joined(np.array([zlib.crc32(a)], np.uint32), np.array([zlib.crc32(b)], np.uint32), np.array([len(b)]))
        assert int(made[0]) == zlib.crc32(a + b)


def test_drawing_keeps_columns_and_equal_rows(spark, odd_docs):
    rows = [(7, "one two three " * 9, "x", 1, 2)] * 300 + [(i, "four five " * 15, "y", 3, 4) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, n_words int, part int")
    aim = spark.createDataFrame([("one two three",)], "text string")
    drawn = importance.resample(docs, aim)
    assert drawn.schema == docs.schema and {tuple(r) for r in drawn.collect()} == {rows[0]} and drawn.count() == 300
    ranks = sorted(r.rank for r in importance.report(docs, aim).where("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 31))


def test_no_documents_and_no_target(spark, no_docs):
    aim = spark.createDataFrame([], "text string")
    assert importance.report(no_docs, aim).collect() == [] and importance.resample(no_docs, aim).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted((tuple(r) for r in importance.report(docs, aim).collect()), key=str) == expected([(1, "a b"), (2, None)], [])
