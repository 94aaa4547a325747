import math
import random
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from provfin.llm import columns, language


def plain_length(text, samples):
    """Bits of a text after samples, byte by byte, with counts by context."""
    follow = defaultdict(Counter)
    for s in samples:
        raw = b"\n\n\n" + s.encode()
        for i in range(3, len(raw)):
            for order in range(4):
                follow[raw[i - order : i]][raw[i]] += 1
    raw, bits = b"\n\n\n" + text.encode(), 0.0
    for i in range(3, len(raw)):
        for order in range(3, -1, -1):
            seen = follow.get(raw[i - order : i])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if seen[raw[i]]:
                bits -= math.log2(seen[raw[i]] / whole)
                break
            bits -= math.log2(len(seen) / whole)
        else:
            bits += 8
    return bits


def counted(samples):
    languages = sorted(samples)
    by = {}
    for k, name in enumerate(languages):
        for s in samples[name]:
            raw = b"\n\n\n" + s.encode()
            for i in range(3, len(raw)):
                for order in range(4):
                    gram = int.from_bytes(raw[i - order : i + 1], "big")
                    by.setdefault((order, gram), Counter())[k] += 1
    return language.grow(by, languages)


def test_code_lengths_match_a_plain_coder():
    rng = random.Random(1)
    samples = {"xx": ["".join(rng.choices("abcd é", k=300)) for _ in range(3)], "yy": ["".join(rng.choices("cdef\nß", k=200)) for _ in range(3)]}
    trees = counted(samples)
    texts = ["", "a", "abc", "zzz", "日本", *["".join(rng.choices("abcdefé ßz\n", k=rng.randint(1, 80))) for _ in range(50)]]
    made = trees.lengths(*columns.flat(pa.array(texts)))
    for row, text in zip(made, texts):
        assert row.tolist() == pytest.approx([plain_length(text, samples["xx"]), plain_length(text, samples["yy"])], rel=1e-4, abs=1e-3)


@pytest.fixture(scope="module")
def made(spark, odd_docs):
    rng = random.Random(2)
    stock = {"aa": ["lorem", "ipsum", "dolor", "sit"], "bb": ["straße", "über", "nicht", "und"], "cc": ["où", "est", "la", "plume"]}
    rows = []
    for i in range(600):
        lang = rng.choice(list(stock))
        rows.append((i, " ".join(rng.choices(stock[lang], k=rng.randint(2, 50))), None if i % 11 == 0 else lang))
    odd = odd_docs.where("text IS NULL OR text NOT RLIKE '[a-zA-Zéİ日]'").selectExpr("doc_id + 7000 AS doc_id", "text", "'aa' AS lang")
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").unionByName(odd), {r[0]: r[2] for r in rows}


def test_held_out_documents(made):
    docs, truth = made
    rows = language.report(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.doc_id >= 7000:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    judged = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and truth.get(r.doc_id)]
    assert len(judged) > 80 and all(judged)


def test_without_languages(spark, no_docs):
    assert language.report(no_docs).collect() == []
    rows = language.report(spark.createDataFrame([(1, "text", None), (None, None, None)], "doc_id long, text string, lang string")).collect()
    assert [r.lang_pred for r in rows] == ["und", "und"]


def test_long_texts_are_followed_in_steps(monkeypatch):
    rng = random.Random(5)
    trees = counted({"xx": ["".join(rng.choices("abcd é", k=300))], "yy": ["".join(rng.choices("cdef\nß", k=200))]})
    texts = pa.array(["".join(rng.choices("abcdefé ßz\n", k=n)) for n in (0, 900, 3, 50, 1)])
    whole = trees.lengths(*columns.flat(texts))
    for step in (1, 2, 3, 4, 7, 64):
        monkeypatch.setattr(language, "STEP", step)
        assert trees.lengths(*columns.flat(texts)).tolist() == [pytest.approx(r, rel=1e-9) for r in whole.tolist()]


def test_the_whole_query_against_a_plain_coder(spark):
    """Learning, counting and scores: all documents are learnt from, as there are fewer than the sample takes."""
    rng = random.Random(7)
    stock = {"aa": "lorem ipsum dolor sit".split(), "bb": "straße über nicht und".split()}
    rows = [(i, " ".join(rng.choices(stock[k], k=rng.randint(1, 9))), k) for i in range(60) for k in [rng.choice(["aa", "bb"])]] + [(90, "ipsum nicht", None), (None, "über", "bb")]
    learnt = {k: [t for i, t, lang in rows if lang == k and (i is None or zlib.crc32(str(i).encode()) % 5)] for k in stock}
    for r in language.report(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)).collect():
        text = next(t for i, t, _ in rows if i == r.doc_id)
        bits = [plain_length(text, learnt[k]) for k in ("aa", "bb")]
        gain = [(min(bits) - b) * math.log(2) * min(1, language.EVIDENCE / len(text.encode())) for b in bits]
        assert r.lang_pred == ("aa", "bb")[bits.index(min(bits))], (r, text, bits)
        assert r.score == pytest.approx(1 / sum(map(math.exp, gain)), rel=1e-3)


def test_bounds_of_what_is_learnt(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    rows = [(i, "some text here", f"l{i % 3}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2 different values of lang"):
        language.report(docs)
    monkeypatch.setattr(language, "BYTES_PER_LANGUAGE", 1)
    trees = language.learn(docs.where("lang <> 'l2'"), lambda c: c.isNotNull())
    assert trees is None or trees.languages == ["l0", "l1"]
