import random
from collections import defaultdict

import pytest
from test_decontaminate import words as item_words
from test_packing import pieces_are_whole
from test_simhash import plain_groups
from test_substrings import WORD
from tokenizers import Tokenizer

import corpus_pipeline
from provfin.llm.queries import tokenizer_path

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 3000)}"
    bench = [(i, " ".join(word() for _ in range(30))) for i in range(5)]
    passage = [word() for _ in range(60)]
    docs, labels = [], []
    for i in range(400):
        w = [word() for _ in range(rng.randint(60, 200))]
        if i % 5 == 0:
            w[7:7] = [rng.choice(["scoundrel", "knave", "wretch"]) for _ in range(3)]
        if i % 7 == 1:
            w[20:20] = passage
        if i % 11 == 2:
            w[30:30] = bench[i % 5][1].split()
        docs.append((i, " ".join(w), None if i % 3 else "en", f"s{i % 4}", None))
        labels.append((i, 1, int(i % 5 == 0)))
        if i % 13 == 3:
            docs.append((1000 + i, docs[-1][1].upper(), "en", None, 3))
    return docs + [(5000, None, None, None, None), (5001, "", "en", "s", 0)], labels, bench


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs, labels, bench = corpus()
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_stage(name, rows, bench):
    """What a stage leaves, by a plain version of it; rows: doc_id to text."""
    if name == "simhash_dedup":
        keep = {c for *_, c in plain_groups(sorted(rows.items()))}
        return {k: v for k, v in rows.items() if k in keep}
    if name == "substring_dedup":
        seen = defaultdict(int)
        split = {k: WORD.findall(t or "") for k, t in rows.items()}
        for w in split.values():
            for i in range(len(w) - 34):
                seen[tuple(w[i : i + 35])] += 1
        out = {}
        for k, w in split.items():
            gone = {p for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for p in range(i, i + 35)}
            out[k] = " ".join(x for p, x in enumerate(w) if p not in gone) if gone else rows[k]
        return out
    windows = {tuple(w[i : i + 13]) for _, t in bench for w in [item_words(t)] for i in range(len(w) - 12)}
    out = {}
    for k, t in rows.items():
        w = item_words(t)
        hit = {p for i in range(len(w) - 12) if tuple(w[i : i + 13]) in windows for p in range(i, i + 13)}
        if not hit or 20 * len(hit) < len(w):
            out[k] = t
    return out


def test_every_stage_against_a_plain_version(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    _, labels, bench = corpus()
    toxic = {i for i, _, t in labels if t}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = {r.doc_id: r.text for r in docs.collect()}
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        made.write.parquet(path := str(tmp_path / str(k)))
        docs = spark.read.parquet(path)
        after = {r.doc_id: r.text for r in docs.collect()}
        if name == "toxicity":
            gone = before.keys() - after.keys()
            assert {i % 1000 for i in gone} <= toxic and len(gone) >= 0.97 * sum(i % 1000 in toxic for i in before if i < 5000)
            assert all(after[i] == before[i] for i in after)
        else:
            assert {i: (t or "").rstrip() for i, t in after.items()} == {i: (t or "").rstrip() for i, t in plain_stage(name, before, bench).items()}
        assert before != after
    rows = corpus_pipeline.run(spark, folder).collect()
    model = Tokenizer.from_file(tokenizer_path())
    model.encode_special_tokens = True
    pieces_are_whole(rows, list(after.items()), model, 1024)
