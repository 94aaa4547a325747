import hashlib
import random
from collections import defaultdict

import pytest

from provfin.llm import linededup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def kept(rows, least_chars=10, least_docs=2):
    """(doc_id, number of lines, of dropped ones, what stays) of every row."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        split = (text or "").split("\n")
        stays = []
        for line in split:
            who = holders[key(line)]
            first = min((i for i in who if i is not None), default=None)
            if len(key(line)) < least_chars or len(who) < least_docs or doc_id == first:
                stays.append(line)
        out.append((doc_id, len(split), len(split) - len(stays), "\n".join(stays)))
    return out


def planted(rng):
    pool = ["  Shared Line of words \t", "shared line of words", "short", "é" * 9, "É" * 10, "é" * 10, "ten chars!", "\x0bten chars!\x0c", "", " ", "nine char", "İ" * 12, " wide blank kept "]
    made = []
    for i in range(80):
        parts = [rng.choice(pool) if rng.random() < 0.4 else f"own line {rng.randint(0, 60)} {'x' * rng.randint(0, 9)}" for _ in range(rng.randint(0, 12))]
        made.append((i if i % 9 else 5, "\n".join(parts)))
    return made + [(None, "shared line of words\nonly here, no id"), (None, "only here, no id"), (900, "\n\n"), (901, "tail line here\n"), (902, "tail line here")]


def answers(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def digests(rows, **bounds):
    return sorted(((d, n, lost, hashlib.sha256(t.encode()).hexdigest()) for d, n, lost, t in kept(rows, **bounds)), key=str)


@pytest.mark.parametrize("bounds", [{}, {"least_chars": 1, "least_docs": 3}])
def test_matches_a_plain_search(spark, odd_docs, bounds):
    made = spark.createDataFrame(planted(random.Random(3)), "doc_id long, text string")
    docs = made.unionByName(odd_docs.select("doc_id", "text")).repartition(5)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answers(linededup.report(docs, **bounds)) == digests(rows, **bounds)


def test_removal_keeps_columns_and_nulls(spark, odd_docs):
    left = linededup.remove(odd_docs, least_chars=1)
    assert left.schema == odd_docs.schema
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    found = sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str)
    assert found == sorted(((d, t) for d, _, _, t in kept(rows, 1)), key=str)
    assert left.where("text IS NULL").count() == odd_docs.where("text IS NULL").count()
    assert left.where("n_chars <> char_length(text)").count() == odd_docs.where("n_chars <> char_length(text)").count()


def test_extra_columns_with_names_of_its_own(spark):
    docs = spark.createDataFrame([(1, "the same line", 7, "x", 1), (2, "the same line\nrest", 8, "y", 2)], "doc_id long, text string, body long, dropped string, at int")
    assert {tuple(r) for r in linededup.remove(docs).collect()} == {(1, "the same line", 7, "x", 1), (2, "rest", 8, "y", 2)}


def test_one_line_in_most_documents_and_many_equal_rows(spark):
    docs = spark.range(3000).selectExpr("CASE WHEN id < 1000 THEN 7 ELSE id END AS doc_id", "CASE WHEN id < 1000 THEN 'the common line\nsecond line of it' ELSE concat('the common line\nline of ', id) END AS text")
    made = linededup.report(docs)
    assert made.where("doc_id = 7 AND n_dropped = 0").count() == 1000
    assert made.where("doc_id <> 7 AND n_dropped = 1 AND n_lines = 2").count() == 2000


def test_lines_of_texts():
    import numpy as np

    data = np.frombuffer(b"a\nb\n\nc", np.uint8)
    begin, end, first = linededup.cut(data, np.array([0, 2, 2, 6]))
    assert [bytes(data[a:b]) for a, b in zip(begin, end)] == [b"a", b"", b"", b"b", b"", b"c"] and first.tolist() == [0, 2, 3, 6]


def test_no_documents(no_docs):
    assert linededup.report(no_docs).collect() == [] and linededup.remove(no_docs).collect() == []
