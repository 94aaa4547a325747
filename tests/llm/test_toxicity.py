import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from provfin.llm import toxicity


def plain_segments(values):
    """Maximal segments by their definition: cut at the best segment, then look left and right of it."""
    if not values:
        return []
    best, at = 0.0, None
    for a in range(len(values)):
        total = 0.0
        for b in range(a, len(values)):
            total += values[b]
            if total > best + 1e-9:
                best, at = total, (a, b + 1)
    if at is None:
        return []
    a, b = at
    right = [(x + b, y + b, s) for x, y, s in plain_segments(values[b:])]
    return plain_segments(values[:a]) + [(a, b, best)] + right


@pytest.mark.parametrize("seed", range(40))
def test_segments_match_the_definition(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 60)
    scored = {i: rng.choice([0.37, 1.91, 3.03, 0.83]) * rng.uniform(0.9, 1.1) for i in range(n) if rng.random() < 0.3}
    values = [scored.get(i, -0.71) for i in range(n)]
    found = toxicity.segments(list(scored), list(scored.values()), drift=-0.71)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in plain_segments(values)]
    assert [s for *_, s in found] == pytest.approx([s for *_, s in plain_segments(values)])


def corpus(rng, n=1200):
    clean = [f"word{i}" for i in range(400)]
    bad = ["scoundrel", "knave", "wretch", "villainous", "villainy"]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(clean) for _ in range(rng.randint(5, 200))]
        toxic = i % 5 == 0
        if toxic:
            at = rng.randrange(len(w))
            w[at:at] = [rng.choice(bad) for _ in range(rng.randint(2, 4))]
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def made(spark, odd_docs):
    docs, labels = corpus(random.Random(1))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    odd = odd_docs.select((odd_docs.doc_id + 5000).alias("doc_id"), "text")
    known = spark.createDataFrame(labels + [(1, None), (5000, 1), (None, 1), (2, 0)], "doc_id long, toxic int")
    return frame.unionByName(odd), known, dict(labels)


def test_held_out_documents(made):
    docs, labels, truth = made
    rows = toxicity.report(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (r.doc_id is not None and held(r.doc_id)) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in judged) >= 0.99 * len(judged)
    assert all(r.predicted == 0 for r in rows if r.doc_id is None or r.doc_id >= 5000)


def test_labels_held_out_do_not_matter(spark, made):
    docs, labels, truth = made
    turned = [(k, 1 - v if held(k) else v) for k, v in truth.items()]
    turned = spark.createDataFrame(turned + [(5000, 1)], "doc_id long, toxic int")
    same = lambda f: sorted((r.doc_id or -1, r.score) for r in f.collect())
    assert same(toxicity.report(docs, labels)) == same(toxicity.report(docs, turned))


def test_rejecting_keeps_clean_rows_and_columns(spark, made, odd_docs):
    docs, labels, truth = made
    left = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert {k for k, v in truth.items() if not v} <= left and len([k for k, v in truth.items() if v and k in left]) <= 3
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert sorted(map(str, toxicity.without_toxic(odd_docs, none).collect())) == sorted(map(str, odd_docs.collect()))


def test_no_documents(spark, no_docs):
    assert toxicity.report(no_docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")).collect() == []


def test_scale_is_the_root():
    for seen, scores in (({2.0: 3, -0.2: 5000, -1.0: 40}, [2.0, -1.0, 5.0]), ({-0.2: 10**6}, [8.0]), ({3.0: 400, -0.2: 9000}, [3.0])):
        scale = toxicity.chance_scale(seen, np.array(scores))
        weights = Counter(seen)
        for s in scores:
            weights[s] += 0.5
        weights[toxicity.DRIFT] += 1
        mean = lambda x: sum(n * math.exp(x * s) for s, n in weights.items()) / sum(weights.values())
        assert mean(scale) == pytest.approx(1, abs=1e-9) and mean(scale * 0.99) < 1 < mean(scale * 1.01)
    assert toxicity.chance_scale({3.0: 10, -0.2: 10}, np.array([3.0])) == toxicity.LEAST_SCALE
    assert toxicity.chance_scale({}, np.zeros(0)) == toxicity.LEAST_SCALE


def plain_model(rows):
    """Scores of words by their definition, from (words, label) of the counted documents: significant log-odds of document counts."""
    total = Counter(label for _, label in rows)
    have = {label: Counter(w for words, l in rows if l == label for w in set(words)) for label in (0, 1)}
    out = {}
    for w in {*have[0], *have[1]}:
        t, c = have[1][w], have[0][w]
        odds = lambda y, n: math.log(y + 0.5) - math.log(n - y + 0.5)
        delta = odds(t, total[1]) - odds(c, total[0])
        z = delta / math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        if z >= 3 and delta >= 2 and t > 1 or z <= -3 and delta <= -0.5:
            out[w] = max(min(delta, 8), -8)
    return out


def test_learning_and_scores_against_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PREFIXES", ())  # whole words alone, so that the plain version stays short
    rng = random.Random(4)
    word = lambda: f"w{rng.randint(0, 60)}"
    docs, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        words = [word() for _ in range(rng.randint(3, 30))] + (["vile", "mean"] if toxic else [])[: rng.randint(1, 2)] + (["kind"] if not toxic and rng.random() < 0.6 else [])
        rng.shuffle(words)
        docs.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    kept = toxicity._distinct_texts(frame).collect()
    monkeypatch.setattr(toxicity, "_distinct_texts", lambda sample: spark.createDataFrame(kept, "doc_id long, text string, toxic int, back boolean"))
    model = toxicity.learn(frame.drop("toxic"), frame.select("doc_id", "toxic"), lambda c: c.isNotNull())
    want = plain_model([(r.text.split(), r.toxic) for r in kept if not r.back])
    hashed = {int(toxicity.columns.hash_words([w.encode()])[0]): w for w in {w for _, t, _ in docs for w in t.split()}}
    assert {hashed[int(k)]: s for k, s in zip(model.keys, model.scores)} == pytest.approx(want)
    assert any(s < 0 for s in want.values()) and any(s > 0 for s in want.values())
    # the whole report, document by document
    def plain_excess(text):
        words = text.split()
        values = [want.get(w, toxicity.DRIFT) for w in words]
        best, total, noise = -99.0, 0.0, math.log(max(len(words), 1))
        found = plain_segments(values)
        for r, s in enumerate(sorted((s for *_, s in found), reverse=True), 1):
            total += model.scale * s - noise + math.log(r)
            best = max(best, total)
        return best, [(a, b) for a, b, s in found if len(words) * math.exp(-model.scale * s) < 0.05]

    back = [(plain_excess(r.text)[0], r.toxic) for r in kept if r.back]
    f1 = lambda cut: 2 * sum(t for e, t in back if e >= cut) / (sum(e >= cut for e, _ in back) + sum(t for _, t in back))
    assert f1(model.cut) == pytest.approx(max(f1(e) for e, _ in back))
    monkeypatch.setattr(toxicity, "learn", lambda *_: model)
    for r in toxicity.report(frame, frame.select("doc_id", "toxic")).collect():
        excess, passages = plain_excess(docs[r.doc_id][1])
        assert r.score == pytest.approx(model.score(excess)) and [(p.begin, p.end) for p in r.passages] == passages and r.n_segments == len(passages)
