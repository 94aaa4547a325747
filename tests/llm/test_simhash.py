import random
import re

import pyarrow as pa
import xxhash

from provfin.llm import columns, components, simhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                label[max(top(i), top(j))] = min(top(i), top(j))
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(top(i), []).append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return sorted(((d, f"{p:016x}", least[top(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=str)


def near_copies(rng):
    docs = []
    for i in range(150):
        w = [f"w{rng.randint(0, 900)}" for _ in range(rng.choice([1, 2, 3, 5, 80, 300]))]
        docs.append((100 + i, " ".join(w)))
        if i % 4 == 0:
            copy = list(w)
            copy[rng.randrange(len(copy))] = "other"
            docs.append((1000 + i, " ".join(copy)))
        if i % 7 == 0:
            docs.append((2000 + i, "\n".join(w).upper()))
    return docs


def test_fingerprints(odd_texts):
    made = simhash.fingerprints(*columns.flat(pa.array(odd_texts)))
    assert made.tolist() == [fingerprint(t) for t in odd_texts]


def test_groups_match_all_pairs(spark, odd_docs):
    docs = spark.createDataFrame(near_copies(random.Random(1)), "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    plain = plain_groups(rows)
    assert sorted((tuple(r) for r in simhash.groups(docs).collect()), key=str) == plain
    assert len({c for _, _, c in plain}) < len(rows) - 40
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    kept = [r.doc_id for r in left.collect()]
    assert sorted(kept, key=str) == sorted({c for _, _, c in plain}, key=str)


def test_links_find_every_pair_within_two_bits(spark):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(30)}
    for p in list(prints):
        prints |= {p ^ 1 << rng.randrange(64), p ^ (1 << rng.randrange(64)) ^ (1 << 63), p ^ 7}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "print long")
    found = {r.node: r.root for r in components.roots(simhash.links(frame)).collect()}
    plain = [(a[0], b[0]) for a in signed for b in signed if a < b and ((a[0] ^ b[0]) & (2**64 - 1)).bit_count() <= 2]
    assert plain and all(found[a] == found[b] for a, b in plain)
    assert set(found) == {x for pair in plain for x in pair}


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(i, i) for i in range(5)] + [(100, 103), (103, 101), (101, 100), (None, 3)]
    found = {r.node: r.root for r in components.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_keeping_one_row_of_each_group(spark, odd_docs, no_docs):
    left = simhash.one_of_each(odd_docs)
    assert left.schema == odd_docs.schema
    rows = [r.doc_id for r in left.collect()]
    assert len(rows) == len(set(rows)) == len({c for _, _, c in plain_groups([(r.doc_id, r.text) for r in odd_docs.collect()])})
    assert simhash.groups(no_docs).collect() == [] and simhash.one_of_each(no_docs).collect() == []
