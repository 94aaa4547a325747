import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from provfin.llm import columns, packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def test_ids_are_those_of_the_tokenizer(model, odd_texts):
    rng = random.Random(1)
    texts = ["it's they're I'll 'sx 'reel  'll  x's''s' 'S", "²³ 12a3 ½", "a<|endoftext|>b", "\x1f a\x85b", *[t or "" for t in odd_texts]]
    texts += ["".join(rng.choice("abst're  '\n\t1.é l²日v!") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    ids, at = tokens.Encoder(PATH).encode(*columns.flat(pa.array(texts)))
    for i, known in enumerate(model.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == known.ids, texts[i]


def test_hilbert_curve_visits_every_cell_by_single_steps():
    bits = 2
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * 3), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def pieces_are_whole(rows, docs, model, length):
    """Every id in exactly one piece, sequences without gaps, padding nowhere."""
    expected = defaultdict(list)
    for doc_id, text in docs:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        expected[(doc_id, len(ids))].append(ids)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.doc_tokens)].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(expected)
    for key, pieces in by_doc.items():
        assert sum(p.length for p in pieces) == sum(map(len, expected[key]))
        texts = {tuple(x) for x in expected[key]}
        for p in pieces:
            assert any(zlib.crc32(np.array(x[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for x in texts)
        if len(expected[key]) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length and at & (at - 1) == 0


def test_pieces_of_odd_documents(odd_docs, model):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    pieces_are_whole(packing.pack(odd_docs, PATH).collect(), docs, model, 1024)
    pieces_are_whole(packing.pack(odd_docs, PATH, length=8).collect(), docs, model, 8)


def test_pieces_of_a_table_with_many_copies(spark, model):
    docs = [(i, "the same text again and again" if i % 3 else f"text number {i}") for i in range(3000)]
    pieces_are_whole(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, 64).collect(), docs, model, 64)


def test_no_documents(no_docs):
    assert packing.pack(no_docs, PATH).collect() == []


def test_likely_neighbours_share_sequences(spark):
    rng = random.Random(3)
    topics = [[f"t{t}w{i}" for i in range(40)] for t in range(6)]
    docs = [(i, " ".join(rng.choices(topics[i % 6], k=60))) for i in range(600)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()
    of = defaultdict(list)
    for r in rows:
        of[r.sequence_id].append(r.doc_id % 6)
    together = [max(map(x.count, x)) / len(x) for x in of.values() if len(x) > 2]
    assert np.mean(together) > 0.6


def test_added_tokens_are_those_of_the_unaltered_tokenizer(spark):
    end, rng = "<|endoftext|>", random.Random(2)
    texts = ["a<|endoftext|>b", end, end * 3, f"a  {end}  b's", "<|endof", "text|>", f"é{end}", "", f"<|{end}|>", f"x {end}\n"]
    texts += ["".join(rng.choice([end, "<|endof", "text|>", " ", "ab", "日", "'s", "\n"]) for _ in range(rng.randint(0, 9))) for _ in range(500)]
    plain = Tokenizer.from_file(PATH)
    ids, at = tokens.encoder(PATH).encode(*columns.flat(pa.array(texts)))
    for i, known in enumerate(plain.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i] : at[i + 1]].tolist() == known.ids, texts[i]
    docs = list(enumerate(texts))
    pieces_are_whole(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, 8).collect(), docs, plain, 8)


@pytest.mark.parametrize("length", [8, 1024])
def test_pieces_have_their_ids(odd_docs, model, length):
    rows = packing.pack(odd_docs, PATH, length).collect()
    whole = {(r.doc_id, tuple([*model.encode(r.text or "", add_special_tokens=False).ids, 0])) for r in odd_docs.collect()}
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        assert any(d == r.doc_id and list(x[r.start : r.start + r.length]) == r.ids for d, x in whole)
