"""Toxic passages as maximum-scoring segments.

Tokens are words, with their first bytes as a fallback for rare word forms. A token whose log-odds between toxic and clean documents,
with a Dirichlet prior, are significant scores them, above zero or below; any other word scores DRIFT. A linear-time scan finds every
maximal segment of positive sum.

Chance is calibrated on the clean words of the sample: the scale is the positive root of ``mean of exp(scale * score) = 1`` over them, so
that a segment as good as s is expected ``words * exp(-scale * s)`` times in a clean text (extreme-value theory of such sums). Segments
expected less than SIGNIFICANT times are the passages that are reported. The sum of the best segments above chance makes a document's
score, set so that 0.7 is the cut that separates documents kept back from the counting best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provfin.functions.session import stored
from provfin.llm import columns

#: Labelled documents to learn from, at most, of either label; smallest hashes of doc_id first.
TOXIC_ROWS, CLEAN_ROWS = 8000, 16000
#: Bytes of the fallback tokens, prior count of a token in either kind, least z of a token that scores, least log-odds of one that speaks for and of
#: one that speaks against toxicity, largest score either way, and the score of other words.
PREFIXES, PRIOR, LEAST_Z, LEAST_ODDS, LEAST_AGAINST, MOST_ODDS, DRIFT = (5, 4), 0.5, 3.0, 2.0, 0.5, 8.0, -0.2
#: The score that makes a document toxic, how often chance may give a passage that is reported, and the scale if clean words do not score below zero.
CUT, SIGNIFICANT, LEAST_SCALE = 0.7, 0.05, 0.05
PASSAGES = "array<struct<begin: int, end: int, score: double>>"
_PASSAGES = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For every word its token and its fallbacks (zero for words that are not longer), and each text's first word."""
    data = columns.LOWER[data]
    starts, ends, first = columns.words(data, offsets, columns.ALNUM)
    rolled = columns.Rolling(columns._SEEDS[0][data])
    out = [rolled.spans(starts, ends) if len(starts) else np.zeros(0, np.uint64)]
    for size in PREFIXES:
        longer = ends - starts > size
        key = np.zeros(len(starts), np.uint64)
        at = starts[longer]
        key[longer] = columns.mix(rolled.spans(at, at + size) + np.uint64(size))
        out.append(key)
    return out, first


@dataclass
class Model:
    """Scored tokens in order, the scale of chance segments, and the calibrated cut."""

    keys: np.ndarray
    scores: np.ndarray
    scale: float = 1.0
    cut: float = 0.0

    def __post_init__(self):
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.keys >> np.uint64(48)).astype(np.int64)] = True

    def found(self, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Words with a score of their own, and these: the word's if it has one, else its longest fallback's."""
        at = np.flatnonzero(np.logical_or.reduce([self.gate[(k >> np.uint64(48)).astype(np.int64)] for k in kinds]))
        score = np.full(len(at), np.nan)
        for key in kinds:
            place = np.minimum(np.searchsorted(self.keys, key[at]), max(len(self.keys) - 1, 0))
            if len(self.keys):
                known = (self.keys[place] == key[at]) & np.isnan(score)
                score[known] = self.scores[place[known]]
        keep = ~np.isnan(score)
        return at[keep], score[keep]

    def excess(self, segments: list[tuple[int, int, float]], words: int) -> float:
        """How far the best segments are above what chance gives in so many words, for the best number of them."""
        best, total, noise = -math.inf, 0.0, math.log(max(words, 1))
        for r, score in enumerate(sorted((s for _, _, s in segments), reverse=True), 1):
            total += self.scale * score - noise + math.log(r)
            best = max(best, total)
            if self.scale * score < noise - math.log(r):
                break
        return best

    def significant(self, segments: list[tuple[int, int, float]], words: int) -> list[tuple[int, int, float]]:
        """The segments that chance gives less than SIGNIFICANT times in a clean text of so many words."""
        least = math.log(max(words, 1) / SIGNIFICANT) / self.scale
        return [s for s in segments if s[2] > least]

    def score(self, excess: float) -> float:
        """From 0 to 1; the cut of the excess is at CUT."""
        odds = min(max(excess - self.cut, -30.0), 30.0) + math.log(CUT / (1 - CUT))
        return 1 / (1 + math.exp(-odds))


def segments(places: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal segments (first word, end, score) of a text, given its scoring words; others score the drift.

    Every candidate keeps the sums before and after it; a new one absorbs those before it as long as that raises its score.
    """
    out: list[tuple[int, int, float, float]] = []  # begin, end, sum before, sum after
    total, seen = 0.0, 0
    for place, score in zip(places, scores):
        before = total + drift * (place - seen)
        total, seen = before + score, place + 1
        if score <= 0:
            continue
        now = (place, place + 1, before, total)
        while out:
            k = len(out) - 1
            while k >= 0 and out[k][2] >= now[2]:
                k -= 1
            if k < 0 or out[k][3] >= now[3]:
                break
            now = (out[k][0], now[1], out[k][2], now[3])
            del out[k:]
        out.append(now)
    return [(a, b, after - before) for a, b, before, after in out]


def _chosen(labels: DataFrame, among) -> DataFrame:
    """doc_id, toxic of a bounded sample of the labelled rows; equal labels of a document are one, null labels none."""
    labels = labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    labels = labels.where(among(F.col("of"))).groupBy("of").agg(F.max("toxic").alias("toxic"))
    pick = lambda label, rows: labels.where(F.col("toxic") == label).orderBy(F.xxhash64("of"), "of").limit(rows)
    return pick(1, TOXIC_ROWS).unionByName(pick(0, CLEAN_ROWS))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in columns.slices(batches, "text"):
        kinds, first = tokens(*columns.flat(batch.column("text")))
        toxic = batch.column("toxic").to_numpy() == 1
        owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
        parts = []
        for key in kinds:
            pair = np.unique(np.stack([owner[key > 0].astype(np.uint64), key[key > 0]], axis=1), axis=0)
            parts.append(pair)
        pair = np.concatenate(parts)
        key, back = np.unique(pair[:, 1], return_inverse=True)
        label = toxic[pair[:, 0].astype(np.int64)]
        count = lambda x: pa.array(np.bincount(back, x, len(key)).astype(np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), count(label), count(~label)], ["key", "toxic", "clean"])


def _distinct_texts(sample: DataFrame) -> DataFrame:
    """The sample without copies (of texts that share one of three smallest word-pair hashes one stays), and what is kept back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            kinds, first = tokens(*columns.flat(batch.column("text")))
            word = kinds[0]
            pair = columns.mix(word + np.uint64(3) * np.append(word[1:], word[:1])) if len(word) else word
            alike = []
            for base in (1, 2, 3):
                key = columns.mix(pair + np.uint64(base))
                least = [int(key[a : max(b - 1, a + 1)].min()) if b > a else 0 for a, b in zip(first[:-1], first[1:])]
                alike.append(pa.array(np.array(least, np.uint64).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "text", "toxic")), *alike], ["doc_id", "text", "toxic", "a", "b", "c"])

    marked = sample.mapInArrow(run, "doc_id long, text string, toxic int, a long, b long, c long")
    for key in "abc":  # the sample is bounded, and so are its groups
        first = Window.partitionBy(key, "toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        marked = marked.withColumn("place", F.row_number().over(first)).where("place = 1")
    return marked.select("doc_id", "text", "toxic", (F.pmod(F.xxhash64("a"), F.lit(4)) == 0).alias("back"))


def learn(docs: DataFrame, labels: DataFrame, among) -> Model:
    """A model of the labels of documents whose id fulfils ``among``; without any, one that finds nothing."""
    chosen = F.broadcast(_chosen(labels, among))  # bounded by TOXIC_ROWS + CLEAN_ROWS
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    sample = sample.join(chosen, F.col("doc_id") == F.col("of")).select("doc_id", "text", "toxic")
    sample = stored(_distinct_texts(sample))
    counting = sample.where("NOT back")
    totals = {r.toxic: r.n for r in counting.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return Model(np.zeros(0, np.uint64), np.zeros(0), cut=100.0)
    counts = counting.mapInArrow(_counted, "key long, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n_t, n_c = float(totals[1]), float(totals[0])
    odds = lambda y, n: f"(ln({y} + {PRIOR}D) - ln({n}D - {y} + {PRIOR}D))"
    delta = f"({odds('toxic', n_t)} - {odds('clean', n_c)})"
    z = f"{delta} / sqrt(1D / (toxic + {PRIOR}D) + 1D / (clean + {PRIOR}D))"
    telling = counts.selectExpr("key", f"{delta} AS delta", f"{z} AS z", "toxic")
    telling = telling.where(f"z >= {LEAST_Z} AND delta >= {LEAST_ODDS} AND toxic > 1 OR z <= -{LEAST_Z} AND delta <= -{LEAST_AGAINST}")
    rows = sorted((r.key % (1 << 64), r.delta) for r in telling.select("key", "delta").collect())  # significant tokens of a bounded sample
    model = Model(np.array([k for k, _ in rows], np.uint64), np.clip(np.array([d for _, d in rows]), -MOST_ODDS, MOST_ODDS))
    clean = counting.where("toxic = 0").select("text").mapInArrow(_score_counts(lambda: model), "score double, n long")
    seen = {r.score: r.n for r in clean.groupBy("score").agg(F.sum("n").alias("n")).collect()}
    model.scale = chance_scale(seen, model.scores)
    back = sample.where("back").select("toxic", "text").mapInArrow(_scorer(lambda: model, ["toxic"], raw=True), f"toxic int, score double, passages {PASSAGES}")
    judged = back.select("toxic", "score").collect()
    model.cut = _best_cut(np.array([r.score for r in judged]), np.array([r.toxic for r in judged]), len(rows))
    return model


def _score_counts(get):
    """How many words of a slice have each score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = get()
        for batch in columns.slices(batches, "text"):
            kinds, _ = tokens(*columns.flat(batch.column("text")))
            _, score = model.found(kinds)
            value, count = np.unique(np.append(score, DRIFT), return_counts=True)
            count[value == DRIFT] += len(kinds[0]) - len(score) - 1
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count)], ["score", "n"])

    return run


def chance_scale(seen: dict[float, int], scores: np.ndarray) -> float:
    """The positive root of ``mean of exp(scale * score) = 1`` over clean words, ``seen`` times each score; every token counts half a time more."""
    value = np.array([*seen, *scores.tolist(), DRIFT])
    weight = np.array([*seen.values(), *[0.5] * len(scores), 1.0])
    weight /= weight.sum()
    if (weight * value).sum() >= 0 or value.max() <= 0:
        return LEAST_SCALE
    above = lambda x: float((weight * np.expm1(x * value)).sum())
    low, high = 1e-6, 1.0
    while above(high) <= 0:
        low, high = high, 2 * high
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) < 0 else (low, middle)
    return high


def _best_cut(excess: np.ndarray, toxic: np.ndarray, tokens_known: int) -> float:
    """The cut with the best F1, in the middle of the gap where it lies."""
    if not len(excess) or not toxic.any():
        return 0.0
    order = np.argsort(-excess, kind="stable")
    value, hit = excess[order], np.cumsum(toxic[order])
    f1 = 2 * hit / (np.arange(1, len(hit) + 1) + toxic.sum())
    ends = np.append(value[1:] != value[:-1], True)
    best = int(np.argmax(np.where(ends, f1, -1)))
    below = value[best + 1] if best + 1 < len(value) else value[best] - 2
    return float((value[best] + max(below, value[best] - 4)) / 2)


def _scorer(get, keys: list[str], raw: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = get()
        for batch in columns.slices(batches, "text"):
            kinds, first = tokens(*columns.flat(batch.column("text")))
            at, score = model.found(kinds)
            edge = np.searchsorted(at, first)
            words = np.diff(first).tolist()
            excess, told = [], []
            speaks = np.concatenate([[0], np.cumsum(score > 0)])[edge]
            for i, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
                found = segments((at[a:b] - first[i]).tolist(), score[a:b].tolist()) if speaks[i + 1] > speaks[i] else []
                excess.append(max(model.excess(found, words[i]), -99.0))
                told.append([dict(zip(("begin", "end", "score"), s)) for s in model.significant(found, words[i])])
            made = excess if raw else [model.score(x) for x in excess]
            arrays = [*(batch.column(k) for k in keys), pa.array(made, pa.float64()), pa.array(told, _PASSAGES)]
            yield pa.RecordBatch.from_arrays(arrays, [*keys, "score", "passages"])

    return run


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, n_segments, passages (first word, end and score of every significant passage).

    Labels count for rows whose crc32(doc_id) mod 3 is not 1. Texts without a passage, null and blank ones too, score next to 0;
    ids may be null or repeated; without labels of both kinds nothing is toxic. A text of any length is one slice of a task, which
    holds some 150 bytes a byte of it.
    """
    held = lambda c: F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(3)) == 1, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, lambda c: ~held(c)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(_scorer(lambda: model.value, ["doc_id"]), f"doc_id long, score double, passages {PASSAGES}")
    predicted = (F.col("score") >= CUT).cast("int").alias("predicted")
    return scored.select("doc_id", held(F.col("doc_id")).alias("held_out"), "score", predicted, F.size("passages").alias("n_segments"), "passages")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the cut, with their columns."""
    held = lambda c: F.coalesce(F.pmod(F.crc32(c.cast("string")), F.lit(3)) == 1, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, lambda c: ~held(c)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(lambda: model.value, [])
        for batch in columns.slices(batches, "text"):
            (made,) = score(iter([batch]))
            yield batch.filter(pa.array(made.column("score").to_numpy() < CUT))

    return docs.mapInArrow(run, docs.schema)
