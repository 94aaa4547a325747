import random
import re

import pyarrow as pa

from provfin.llm import columns, licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_base(text):
    w, out = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), len(out), min((i for i, _ in out), default=None), max((i for i, _ in out), default=None), ",".join(sorted({x for _, x in out}))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_labels(text):
    """Labels of notices within their errors of any stretch of whole words."""
    w, out = words(text), set()
    for notice, (label, k) in licenses.NOTICES.items():
        for i in range(len(w)):
            for j in range(i + 1, len(w) + 1):
                stretch = " ".join(w[i:j])
                if len(stretch.encode()) > len(notice) + k + 3:
                    break
                if distance(notice, stretch) <= k:
                    out.add(label)
    return out


def noisy(rng):
    out = []
    for _ in range(400):
        notice = rng.choice([*licenses.NOTICES, *licenses.PHRASES])
        letters = list(notice)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(letters))
            kind = rng.randrange(3)
            letters[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice("abcelx ")]
        around = [rng.choice(["the", "Über", "limit", "日本", "x", "license"]) for _ in range(rng.randint(0, 6))]
        at = rng.randint(0, len(around))
        text = rng.choice([" ", ", ", "\n"]).join([*around[:at], "".join(letters), *around[at:]])
        out.append(text.title() if rng.random() < 0.3 else text)
    return out


def test_fuzzy_labels_match_all_stretches():
    texts = noisy(random.Random(4))
    found, counts = licenses.scan(*columns.flat(pa.array(texts)))
    assert counts.tolist() == [len(words(t)) for t in texts]
    for text, spans in zip(texts, found):
        plain = plain_labels(text) | {x for x in plain_base(text)[4].split(",") if x}
        assert {s["label"] for s in spans} == plain, text
        for s in spans:
            notice = [n for n, (label, _) in licenses.NOTICES.items() if label == s["label"]]
            stretch = " ".join(words(text)[s["first_word"] : s["last_word"] + 1])
            assert s["exact"] or min(distance(n, stretch) for n in notice) <= s["errors"]
    assert sum(any(not s["exact"] and s["errors"] for s in f) for f in found) > 80


def test_a_place_is_told_once():
    rng = random.Random(8)
    pieces = ["gnu lesser general public license", "gnu general public licens", "gnu", "general public", "public license", "general public licens", "mozilla publik license"]
    search, several = licenses.Search(), 0
    for _ in range(300):
        text = "\n" + " ".join(rng.choices(pieces, k=rng.randint(1, 8))) + " "
        by_notice = {}
        for label, a, b, _ in search.fuzzy(text):
            by_notice.setdefault(label, []).append((a, b))
        for spans in by_notice.values():
            spans.sort()
            several += len(spans) > 1
            assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:])), text
    assert several > 30


def test_places_end_with_their_text():
    texts = ["the mozilla public licens", "e mozilla public license", "gnu general publi", "c license", "apache", "license apache license"]
    found, _ = licenses.scan(*columns.flat(pa.array(texts)))
    fuzzy = [[(s["label"], s["first_word"], s["last_word"], s["errors"]) for s in f if not s["exact"]] for f in found]
    assert fuzzy == [[("mpl", 1, 3, 1)], [("mpl", 1, 3, 0)], [], [], [], [("apache", 1, 2, 0)]]


def test_base_columns_match_a_plain_search(spark, odd_docs):
    rng = random.Random(5)
    texts = noisy(rng) + ["MIT license, mit-license; Apache\nLicense cc by cc by cc by-nc"] + ["a b " * 9000 + "mit license " * 3]
    docs = odd_docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    known = {(r.doc_id, r.text) for r in docs.collect()}
    plain = sorted([(d, *plain_base(t)) for d, t in known], key=str)
    rows = licenses.report(docs.distinct()).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows], key=str) == plain
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score == 1.0) == (r.n_base > 0 or any(f.errors == 0 for f in r.found)) and (r.score > 0) == bool(r.labels)


def test_no_documents(no_docs):
    assert licenses.report(no_docs).collect() == []
