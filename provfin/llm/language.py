"""Language identification by prediction by partial matching.

For every language a context tree holds how often each byte follows each context of up to three bytes. A byte costs the code length
of its longest known context's prediction; where that context has not seen it, the cost of an escape and of the shorter context, down
to a uniform byte. Statistics are frozen after learning. The trees of all languages share one trie of arrays, so a task follows all
bytes of a slice in step: each byte is one look-up per order and a row of code lengths, one for each language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.llm import columns

#: Documents, and bytes of text, of each language to learn from, about; a share of all by the hash of doc_id. Bytes of a context, and bytes whose
#: evidence counts in the confidence.
ROWS_PER_LANGUAGE, BYTES_PER_LANGUAGE, ORDER, EVIDENCE = 1500, 16 << 20, 3, 48
#: Languages that trees may have, as a node has a number for each; and bytes of a text that are followed at once.
MOST_LANGUAGES, STEP = 32, 1 << 19
_LETTER = re.compile(r"[^\W\d_]")
_PAD = b"\n" * ORDER


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with line feeds before every text as its first context; where each text's own bytes begin and end there."""
    shift = ORDER * np.arange(1, len(offsets), dtype=np.int64)
    out = np.full(len(data) + ORDER * (len(offsets) - 1), 10, np.uint8)
    out[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
    return out, offsets[:-1] + shift, offsets[1:] + shift


@dataclass
class Trees:
    """Frozen statistics: children of every node by byte, code lengths by node and language, escapes by node and language."""

    languages: list[str]
    children: list[np.ndarray]
    costs: list[np.ndarray]
    escapes: list[np.ndarray]

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of every text (rows) in every language."""
        text, begin, end = padded(data, offsets)
        out = np.zeros((len(begin), len(self.languages)))
        for at in range(0, len(text), STEP):  # a byte's cost depends on the ORDER bytes before it
            before = min(at, ORDER)
            costs = self._byte_costs(text[at - before : at + STEP])[before:]
            total = np.zeros((len(costs) + 1, len(self.languages)))
            np.cumsum(costs, axis=0, out=total[1:])
            out += total[np.clip(end - at, 0, len(costs))] - total[np.clip(begin - at, 0, len(costs))]
        return out

    def _byte_costs(self, text: np.ndarray) -> np.ndarray:
        """Cost of every byte after those before it."""
        byte = text.astype(np.int64)
        node = [byte + 1]  # the byte alone, then with one byte more before it
        for order in range(1, ORDER + 1):
            longer = np.zeros(len(byte), np.int32)
            if len(byte) > 1:
                before = node[-1][:-1].astype(np.int64)
                longer[1:] = self.children[order][before * 256 + byte[1:]]
                longer[1:][before == 0] = 0
            node.append(longer)
        cost = np.zeros((len(byte), len(self.languages)), np.float32)
        open_ = np.arange(len(byte))
        for order in range(ORDER, -1, -1):
            here = node[order][open_]
            known = here > 0
            cost[open_[known]] += self.costs[order][here[known]]
            open_ = open_[~known]
            if order and len(open_):
                context = node[order - 1][np.maximum(open_ - 1, 0)]
                cost[open_] += self.escapes[order][np.where(open_ > 0, context, 0)]
        return cost


def grow(counts: dict[tuple[int, int], dict[int, int]], languages: list[str]) -> Trees:
    """Trees from counts by (order, gram as a number) and language."""
    n = len(languages)
    for order in range(1, ORDER):  # the line feeds before a text are contexts though nobody counts them
        counts.setdefault((order, int.from_bytes(_PAD[: order + 1])), {})
    children, costs, escapes = [np.zeros(0, np.int32)], [np.zeros((257, n), np.float32)], [np.zeros((1, n), np.float32)]
    table = np.zeros((256, n))
    for (order, gram), by in counts.items():
        if order == 0:
            for k, c in by.items():
                table[gram, k] = c
    total, kinds = table.sum(axis=0), (table > 0).sum(axis=0)
    share = np.where(table > 0, table, kinds / 256) / np.maximum(total + kinds, 1)
    share[:, total == 0] = 1 / 256
    costs[0][1:] = -np.log2(share)
    ids = {g: g + 1 for g in range(256)}
    for order in range(1, ORDER + 1):
        grams = sorted(g for o, g in counts if o == order and (g >> 8) in ids)
        child = np.zeros((max(ids.values(), default=0) + 1) * 256, np.int32)
        seen = np.zeros((len(grams) + 1, n))
        context = np.array([0] + [ids[g >> 8] for g in grams])
        # the same byte after a context that is one byte shorter
        suffix = np.zeros(len(grams) + 1, np.int64)
        fresh = {}
        lower = (1 << (8 * order)) - 1
        for i, g in enumerate(grams, 1):
            fresh[g] = i
            child[context[i] * 256 + (g & 255)] = i
            suffix[i] = ids.get(g & lower, 0)
            for k, c in counts[(order, g)].items():
                seen[i, k] = c
        total, kinds = np.zeros((max(ids.values(), default=0) + 1, n)), np.zeros((max(ids.values(), default=0) + 1, n))
        np.add.at(total, context[1:], seen[1:])
        np.add.at(kinds, context[1:], seen[1:] > 0)
        whole = np.maximum(total + kinds, 1)
        escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / whole), 0.0)
        own = -np.log2(np.maximum(seen, 1) / whole[context])
        cost = np.where(seen > 0, own, escape[context] + costs[order - 1][suffix])
        cost[0] = 0
        escape[0] = 0
        children.append(child)
        costs.append(cost.astype(np.float32))
        escapes.append(escape.astype(np.float32))
        ids = fresh
    return Trees(languages, children, costs, escapes)


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, gram) in slices; a gram's number carries its length in front."""
    for batch in columns.slices(batches, "text"):
        text, begin, end = padded(*columns.flat(batch.column("text")))
        own = np.zeros(len(text) + 1, np.int64)
        np.add.at(own, begin, 1)
        np.add.at(own, end, -1)
        at = np.flatnonzero(np.cumsum(own)[:-1] > 0)
        names, which = np.unique(batch.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        language = np.repeat(which, end - begin).astype(np.uint64)
        gram, parts = np.zeros(len(at), np.uint64), []
        for order in range(ORDER + 1):
            gram = gram | (text[at - order].astype(np.uint64) << np.uint64(8 * order))
            parts.append(np.unique((language << np.uint64(40)) | (np.uint64(order) << np.uint64(36)) | gram, return_counts=True))
        key, count = (np.concatenate(x) for x in zip(*parts))
        lang = pa.array(names.tolist()).take(pa.array((key >> np.uint64(40)).astype(np.int64)))
        code = (key & np.uint64((1 << 40) - 1)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([lang, pa.array(code), pa.array(count.astype(np.int64))], ["lang", "gram", "n"])


def learn(docs: DataFrame, among) -> Trees | None:
    """Trees of the languages of documents whose id fulfils ``among``; None if there are none. More than MOST_LANGUAGES are an error."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & among(F.col("doc_id")))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).limit(MOST_LANGUAGES + 1).collect()
    if not sizes:
        return None
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different values of lang; learn them in groups")
    share = {r.lang: min(1.0, ROWS_PER_LANGUAGE / r.n, BYTES_PER_LANGUAGE / max(r.bytes, 1)) for r in sizes}
    languages = sorted(share)
    limits = F.create_map(*(F.lit(x) for k in languages for x in (k, share[k])))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / float(1 << 20) < limits[F.col("lang")])
    counts = sample.select("text", "lang").mapInArrow(_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    index = {k: i for i, k in enumerate(languages)}
    by: dict[tuple[int, int], dict[int, int]] = {}
    for r in counts.toLocalIterator():  # of a bounded sample
        by.setdefault((r.gram >> 36, r.gram & ((1 << 32) - 1)), {})[index[r.lang]] = r.n
    return grow(by, languages)


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score.

    Only documents whose crc32(doc_id) mod 5 is not 0 are learnt from. Null texts and texts without a letter are ``und`` with score
    0, as is everything if no language is known; of equal code lengths the first language in order counts. Ids may be null or repeated.
    A text of any length is followed in steps; a task holds some 20 bytes a byte of it and 100 a byte of a step.
    """
    held = lambda c: F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(5)) == 0, F.lit(False))
    trees = docs.sparkSession.sparkContext.broadcast(learn(docs, lambda c: ~held(c)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = trees.value
        for batch in columns.slices(batches, "text"):
            data, offsets = columns.flat(batch.column("text"))
            lettered = [t is not None and _LETTER.search(t) is not None for t in batch.column("text").to_pylist()]
            if known is None:
                best, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            else:
                bits = known.lengths(data, offsets)
                size = np.maximum(np.diff(offsets), 1)
                gain = (bits.min(axis=1)[:, None] - bits) * np.log(2) * np.minimum(1, EVIDENCE / size)[:, None]
                score = np.where(lettered, 1 / np.exp(gain).sum(axis=1), 0.0)
                best = [known.languages[k] if ok else "und" for k, ok in zip(bits.argmin(axis=1).tolist(), lettered)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(best), pa.array(score)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
