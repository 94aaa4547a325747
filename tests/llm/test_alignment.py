import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from provfin.llm import alignment
from provfin.llm.tokens import _byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b


def plain(libraries, text):
    """Groups of a text as lists of (A ids, B ids), token by token."""
    a, b = libraries
    byte = {letter: code for code, letter in enumerate(_byte_letters())}
    if not text:
        return []
    whole = (" " + text).encode()
    found = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(byte[c] for c in token)) for i, token in zip(found.ids, found.tokens)]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return []
    out, i, j, x, y = [], 0, 0, 0, 0
    while i < len(left):
        group = ([], [])
        while not group[0] or x != y:
            if x <= y:
                group[0].append(left[i][0])
                x += len(left[i][1])
                i += 1
            else:
                group[1].append(right[j][0])
                y += len(right[j][1])
                j += 1
        out.append(group)
    return out


def expected(libraries, rows):
    made = [plain(libraries, t) for _, t in rows]
    links = [Counter((a, b) for x, y in g for a in x for b in y) for g in made]
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (doc_id, _), g, c in zip(rows, made, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        top = sum(n for (a, b), n in c.items() if count[a, b] == best[a])
        out.append((doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), top, sum(n * count[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=str), count, best


ODD = [
    "it's <|endoftext|> and </s><s> <0x41> [INST]", "a▁b", "▁", "  lead and trail  ", "\t\ttabs\n\n\nfeeds\r\n", "日本語のテキスト と 한국어", "a b　c", "\x00nul",
    "🙂👩‍👩‍👧 é ﬁ ǅ", "1234567890 3.14 $%^&*", "x" * 300, " " * 50, "ab" * 200, "wordwordword" * 30, "=" * 80 + "-" * 80, "нет да " * 20, "﻿bom", "ÿþ", "don't we'll I'M",
]


@pytest.mark.parametrize("limits", [{}, {"RUN_LINKS": 50, "FAN_IN": 2, "BLOCK": 7, "PLAIN_LINKS": 2}])
def test_matches_a_plain_alignment(spark, odd_docs, libraries, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    rng = random.Random(1)
    words = "the of Wörter naïve code_point foo.bar( x+=1; 日 мир 12,5 http://a.b/c?d=e".split()
    made = [(1000 + i, rng.choice(["", " ", "  "]).join(rng.choice(words) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(1, 80)))) for i in range(60)]
    docs = spark.createDataFrame([*enumerate(ODD, 500), *made, made[0]], "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text")).repartition(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, count, best = expected(libraries, rows)
    if not limits:
        assert sorted((tuple(r) for r in alignment.report(docs, A, B).collect()), key=str) == want
        found = {(r.a, r.b): (r.documents, r.best) for r in alignment.pairs(docs, A, B).collect()}
        assert found == {p: (n, n == best[p[0]]) for p, n in count.items()}
        shown = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in alignment.groups(docs.where("doc_id >= 500"), A, B).collect()}
        assert shown == {d: plain(libraries, t) for d, t in rows if d is not None and d >= 500}
    else:  # workers do not see the patched limits, so the parts are called here
        a_side, b_side = alignment.sides(A, B)
        rank, edges, sums = alignment.side_major(len(a_side.width)), alignment._edges(len(a_side.width), len(b_side.width)), alignment.Sums()
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.string())], ["doc_id", "text"])
        seen = Counter()
        for at in range(0, len(rows), 9):
            run = alignment.Run(at)
            run.add(batch.slice(at, 9), alignment.Aligned(batch.slice(at, 9).column("text"), a_side, b_side), len(b_side.width), rank)
            for row in run.close(edges, sums):
                if row["kind"] == "records":
                    steps, holders, doc, links = alignment._unpacked(row["blocks"][0])
                    for key, n in zip(np.cumsum(steps.astype(np.int64)).tolist(), holders.tolist()):
                        seen[key] += n
        keys, counts = sums.whole()
        assert dict(zip(keys.tolist(), counts.tolist())) == seen == {int(rank[a]) * len(b_side.width) + b: n for (a, b), n in count.items()}


def test_merge_adds_equal_keys():
    rng = np.random.default_rng(3)
    runs = [np.unique(rng.integers(0, 500, n)) for n in (0, 1, 40, 400, 7)]
    blocks = lambda keys: iter([(keys[i : i + 6], np.full(len(keys[i : i + 6]), 2)) for i in range(0, len(keys), 6)])
    found = list(alignment.merged([blocks(k) for k in runs]))
    keys, counts = np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
    want = Counter(np.concatenate(runs).tolist())
    assert keys.tolist() == sorted(want) and dict(zip(keys.tolist(), counts.tolist())) == {k: 2 * n for k, n in want.items()}


def test_one_text_in_most_rows_and_clashing_columns(spark, libraries):
    docs = spark.range(400).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS doc_id", "CASE WHEN id % 3 = 0 THEN 'ok then' ELSE concat('ok ', id) END AS text", "id AS run", "'x' AS part", "1 AS blocks")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in alignment.report(docs, A, B).collect()), key=str) == expected(libraries, rows)[0]


def test_no_documents(no_docs):
    assert alignment.report(no_docs, A, B).collect() == [] and alignment.pairs(no_docs, A, B).collect() == []
