import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from provfin.llm import substrings

WORD = re.compile("[^\x20\x09-\x0d]+")


def expected(rows, window):
    split = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, split):
        gone = {p for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def planted(rng):
    word = lambda: f"w{rng.randint(0, 2000)}"
    passage = [word() for _ in range(60)]
    docs = []
    for i in range(120):
        w = [word() for _ in range(rng.randint(0, 200))]
        if i % 3 == 0:
            cut = rng.randint(0, 20)
            at = rng.randint(0, len(w))
            w[at:at] = passage[cut : cut + rng.randint(30, 60)]
        if i % 10 == 1:
            w = docs[-1][1].split()
            w[len(w) // 2 : len(w) // 2] = ["edited"]
        if i % 10 == 2:
            w = w + w
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(w)))
    return docs + [(500, "again and " * 100), (501, "again and " * 18), (502, docs[3][1])]


@pytest.mark.parametrize(("window", "gram", "bits"), [(35, 8, None), (35, 8, 20), (5, 2, None), (8, 8, None)])
def test_matches_a_plain_search(spark, window, gram, bits, odd_docs):
    made = spark.createDataFrame(planted(random.Random(2)), "doc_id long, text string")
    docs = made.unionByName(odd_docs.select("doc_id", "text")).repartition(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in substrings.report(docs, window, gram, bits).collect()), key=str) == expected(rows, window)


def test_a_full_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "sketch", lambda docs, bits, *_: np.full(substrings.ROWS << (bits - 3), 255, np.uint8))
    docs = spark.createDataFrame(planted(random.Random(4)), "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in substrings.report(docs).collect()), key=str) == expected(rows, 35)


def test_removal_keeps_columns_and_other_texts(spark, odd_docs):
    left = substrings.remove(odd_docs)
    assert left.schema == odd_docs.schema and left.count() == odd_docs.count()
    before = {r.doc_id: r for r in odd_docs.collect()}
    for r in left.collect():
        if r.text != before[r.doc_id].text:
            assert r.n_chars == len(r.text) < before[r.doc_id].n_chars
    made = spark.createDataFrame([(1, "a  b\n" + "x y " * 40 + "c"), (2, "clean\ttext")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in substrings.remove(made).collect()} == {1: "a  b\nc", 2: "clean\ttext"}


def test_no_documents(no_docs):
    assert substrings.report(no_docs).collect() == []


def test_many_rows_of_one_text(spark):
    """A text that is repeated is joined to its stretches once a row, whatever the number of rows; other rows of its id are untouched."""
    rng = random.Random(11)
    text = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(300))
    docs = spark.range(2000).selectExpr("CASE WHEN id % 2 = 0 THEN 7L ELSE NULL END AS doc_id", f"'{text}' AS text").repartition(6)
    docs = docs.unionByName(spark.createDataFrame([(7, "a text of its own " + text[:60]), (8, None)], "doc_id long, text string"))
    stretches = substrings.covers(docs.selectExpr("xxhash64(text) AS body", "xxhash64(7, text) AS twin", "text"))
    joined, name = substrings._with_covers(docs, 35, 8, None)
    assert joined.selectExpr(f"max(size({name})) AS n").first().n <= stretches.distinct().count() <= 300
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in substrings.report(docs).collect()), key=str) == expected(rows, 35)
