import hashlib
import random
import re

from provfin.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def planted(odd_texts):
    long = odd_texts[-1].split()
    items = [(1, "One Two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item"), (3, None), (4, ""),
             (5, " ".join(long[500:520])), (6, "x1"), (1, "One Two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
             (7, "short item"), (None, "nameless item here")]
    texts = ["one, two THREE four five six seven eight nine ten eleven twelve thirteen and more", "a short, ITEM", "short-item short item", "nameless item here"]
    return texts, items


def test_matches_a_plain_search(spark, odd_docs, odd_texts, monkeypatch):
    texts, items = planted(odd_texts)
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(900 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = expected([(r.doc_id, r.text) for r in docs.collect()], {i for i in items})
    assert sorted((tuple(r) for r in decontaminate.report(docs, bench).collect()), key=str) == plain
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)  # the benchmark in several blocks
    monkeypatch.setattr(decontaminate, "PART_BYTES", 90)  # and long items in parts
    assert len(list(decontaminate._blocks(bench))) > 3
    assert sorted((tuple(r) for r in decontaminate.report(docs, bench).collect()), key=str) == plain


def test_removal_keeps_columns_and_clean_rows(spark, odd_docs, odd_texts):
    texts, items = planted(odd_texts)
    bench = spark.createDataFrame(items[:1], "item_id long, text string")
    extra = spark.createDataFrame([(900, texts[0], "en", "s", 5, 1, "x")], odd_docs.schema)
    docs = odd_docs.unionByName(extra)
    left = decontaminate.remove(docs, bench)
    assert left.schema == docs.schema
    assert sorted(map(str, left.collect())) == sorted(map(str, odd_docs.collect()))
    cut = {r.doc_id: r for r in decontaminate.remove(docs, bench, whole=False).collect()}
    assert cut[900].text == "and more" and cut[900].n_chars == 8
    assert len(cut) == len({r.doc_id for r in docs.collect()})


def test_empty_tables(spark, no_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(no_docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r.n_hit for r in decontaminate.report(one, bench).collect()] == [0]


def test_a_block_holds_what_it_says():
    """Bytes of the arrays against the bound, for texts of short and of long words."""
    rng = random.Random(3)
    for letters in (1, 6, 40):
        rows = [(i, " ".join("".join(rng.choice("abcdefgh") for _ in range(letters)) for _ in range(3000))) for i in range(20)]
        items = decontaminate.Items(rows)
        held = sum(x.nbytes for x in (items.text, items.at, items.end, items.first_word, items.owner)) + sum(k.nbytes + p.nbytes for _, k, p in items.lengths)
        assert held <= sum(len(t) + decontaminate.WORD_COST * (t.count(" ") + len(t) // 8 + 1) for _, t in rows)


def test_long_items_in_parts():
    words_ = [f"w{i}" for i in range(500)]
    text = " ".join(words_)
    decontaminate_parts = list(decontaminate._parts(1, text))
    assert decontaminate_parts == [(1, text)]
    before, decontaminate.PART_BYTES = decontaminate.PART_BYTES, 100
    try:
        parts = list(decontaminate._parts(1, text))
    finally:
        decontaminate.PART_BYTES = before
    windows = {tuple(p[1].split()[i : i + 13]) for p in parts for i in range(len(p[1].split()) - 12)}
    assert windows == {tuple(words_[i : i + 13]) for i in range(488)} and {p[2] for p in parts} == {500}
    one, cut = decontaminate.Items([(1, text)]), decontaminate.Items(parts)
    assert [(n, sorted(set(k.tolist()))) for n, k, _ in one.lengths] == [(n, sorted(set(k.tolist()))) for n, k, _ in cut.lengths]


def test_many_rows_of_one_text_meet_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    items = [(i, f"item {i} has a phrase of its own that nobody else has in the whole set") for i in range(6)]
    docs = spark.range(500).selectExpr("CAST(NULL AS LONG) AS doc_id", f"'before {items[0][1]} and {items[5][1]} after' AS text")
    found = decontaminate.report(docs, spark.createDataFrame(items, "item_id long, text string")).distinct().collect()
    assert [tuple(r) for r in found] == expected([(None, f"before {items[0][1]} and {items[5][1]} after")], items)
