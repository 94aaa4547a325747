import hashlib
import random
import struct

import pytest
import xxhash
from pyspark.errors import PySparkException

from provfin.llm import orderminhash


def chained(*values):
    """Spark's 64-bit hash of several values: each is hashed with the last hash as seed; nulls are passed over."""
    h = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i" if isinstance(v, Int) else "<q", v)
            h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


class Int(int):
    pass


def numbered_kmers(text):
    """Hash of every numbered word pair, in text order."""
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words, seen, out = [w for w in text.split(" ") if w], {}, []
    for i, w in enumerate(words):
        kmer = chained(w, words[i + 1] if i + 1 < len(words) else None) >> 24
        n = seen[kmer] = seen.get(kmer, -1) + 1
        out.append(chained(kmer, Int(n)) >> 24 if n else kmer)
    return out


def ranked_fingerprint(text):
    """Each slot's two smallest of all numbered k-mers, over all 64 rounds."""
    slots = {}
    for i, h in enumerate(numbered_kmers(text)):
        for r in range(64):
            p = (r * (h & 62 | 1) + (h >> 6 & 63)) & 63
            p = ((p ^ p >> 3) * (h >> 12 & 62 | 1) + (h >> 18 & 63)) & 63
            slots.setdefault(p, []).append((r, chained(h, r) & (2**28 - 1), i))
    assert all(len(v) == len(next(iter(slots.values()))) for v in slots.values()) and len(slots) in (0, 64)
    out = ""
    for slot in [*range(32, 64), *range(32)]:
        if mine := sorted(slots.get(slot, []))[:2]:
            high = [(slot - 64 if slot > 31 else slot) << 34 | r << 28 | v for r, v, _ in sorted(mine, key=lambda x: x[2])]
            out += f"{slot:02x}{chained(*high) & 0xFFFF:04x}"
    return out


def likeness(a, b):
    a, b = ({x[i : i + 2]: x[i : i + 6] for i in range(0, len(x), 6)} for x in (a, b))
    return sum(a[k] == b.get(k) for k in a) / len(a.keys() | b.keys()) if a or b else 1.0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = ranked_fingerprint(text), ranked_fingerprint(edited), ranked_fingerprint(after)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)))
    return sorted(out, key=str)


def test_matches_a_plain_version(spark, odd_docs, monkeypatch):
    docs = odd_docs.where("length(text) < 5000 OR text IS NULL")
    plain = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in orderminhash.report(docs).collect()), key=str) == plain
    monkeypatch.setattr(orderminhash, "RANGE_ROWS", 4)  # many ranges of ids
    assert sorted((tuple(r) for r in orderminhash.report(docs).collect()), key=str) == plain


def test_equal_texts_order_and_counts(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    swapped = words[150:] + words[:150]
    texts = {1: words, 2: words, 3: swapped, 4: rng.sample(words, 300), 5: words + words[:200], 6: words[:290] + ["new"] + words[290:]}
    frame = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id long, text string")
    made = {r.doc_id: r.f for r in orderminhash.with_signature(frame, "text", "s").select("doc_id", orderminhash.spelled("s").alias("f")).collect()}
    assert made[1] == made[2]
    near = {k: likeness(made[1], v) for k, v in made.items()}
    assert near[6] > 0.85 and near[4] < 0.1 and near[5] < near[6] and near[4] < near[3] < near[6]


def test_few_documents(spark, no_docs):
    assert orderminhash.report(no_docs).collect() == []
    one = orderminhash.report(spark.createDataFrame([(5, "ab cd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest() and one.near_next == 1.0


def test_plan_has_no_python(odd_docs):
    plan = orderminhash.report(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_long_text_with_repeats(spark):
    text = "same words here " * 20000
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = orderminhash.with_signature(frame, "text", "s").select(orderminhash.spelled("s").alias("f")).first()
    assert row.f == ranked_fingerprint(text)


def independent(text):
    """Order MinHash under 64 hashes that have nothing in common."""
    kmers = numbered_kmers(text)
    out = {}
    for slot in range(64):
        mine = sorted((hashlib.blake2b(struct.pack("<qi", h, slot), digest_size=8).digest(), i, h) for i, h in enumerate(kmers))[:2]
        out[slot] = tuple(h for _, i, h in sorted(mine, key=lambda x: x[1]))
    return out


def test_every_slot_ranks_all_kmers(spark, odd_docs):
    docs = odd_docs.where("length(text) < 5000 OR text IS NULL")
    rng = random.Random(4)
    more = spark.createDataFrame([(i, " ".join(f"w{rng.randint(0, 40)}" for _ in range(n))) for i, n in enumerate([1, 2, 3, 5, 63, 64, 200, 400, 767, 900, 1535, 1536, 4000])], "doc_id long, text string")
    rows = orderminhash.with_signature(docs.select("doc_id", "text").union(more), "text", "s").select("text", orderminhash.spelled("s").alias("f")).collect()
    assert len(rows) > 20
    for r in rows:
        assert r.f == ranked_fingerprint(r.text or ""), r.text


def test_swapped_halves_of_short_texts_are_no_likelier_than_under_independent_hashes(spark):
    rng = random.Random(6)
    for n in (30, 80):
        pairs = []
        for _ in range(40):
            words = [f"w{rng.randint(0, 5000)}" for _ in range(n)]
            pairs.append((" ".join(words), " ".join(words[n // 2 :] + words[: n // 2])))
        frame = spark.createDataFrame([(i, t) for i, p in enumerate(pairs) for t in p], "doc_id long, text string")
        made = {r.text: r.f for r in orderminhash.with_signature(frame, "text", "s").select("text", orderminhash.spelled("s").alias("f")).collect()}
        ours = [likeness(made[a], made[b]) for a, b in pairs]
        true = [sum(x == y for x, y in zip(independent(a).values(), independent(b).values())) / 64 for a, b in pairs]
        assert abs(sum(ours) - sum(true)) / len(pairs) < 0.05


def test_query_gives_these_fingerprints(spark, tmp_path):
    from provfin.llm import queries

    spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.fingerprint for r in queries.op8_order_minhash(spark, str(tmp_path)).collect()}
    assert found == {1: ranked_fingerprint("a b c"), 2: ranked_fingerprint("d e")}


def test_slots_that_small_hashes_leave_unfilled(spark, monkeypatch):
    """With far fewer visits than slots need, the first tries fail and the last one takes all rounds."""
    monkeypatch.setattr(orderminhash, "VISITS", 70)
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(n)) for n in (1, 40, 139, 140, 150, 600)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = orderminhash.with_signature(frame, "text", "s").select("text", orderminhash.spelled("s").alias("f")).collect()
    assert {r.text: r.f for r in rows} == {t: ranked_fingerprint(t) for t in texts}


def test_more_words_than_positions_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(orderminhash, "_LOW", 15)
    made = lambda n: orderminhash.with_signature(spark.createDataFrame([("a " * n,)], "text string"), "text", "s").collect()
    assert len(made(16)) == 1
    with pytest.raises(PySparkException, match="a text has 17 words; positions have room for 16"):
        made(17)
