"""Target-distribution importance resampling: documents whose word n-grams look like a target's are drawn more often.

Features are runs of one to three words, hashed into buckets by CRC-32. A bucket's gain is the log-ratio of its smoothed shares in
the target and in the corpus; a document's weight is the sum of its features' gains, and weight plus Gumbel noise of its id ranks it.

Corpus counts come from deduplicated segments: line feeds cut texts into lines, equal lines are grouped and counted, a distinct
line's features are counted once and multiplied by its occurrences. N-grams that reach over a line feed belong to no line; a task adds
them up for its own documents in one array of the bucket table's size, which travels as a segment of its own.

A checksum of words joined by blanks comes from the words' own: appending n bytes to a text is a linear map of its checksum, one
table of four times 256 entries for each n, so that features are hashed in numpy without ever being spelled.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from provfin.functions.session import stored
from provfin.llm import columns

#: Buckets of the feature table, words of the longest feature, seed of the noise, words a document needs to be drawn, and the share drawn in percent.
BUCKETS, LONGEST, SEED, LEAST_WORDS, PERCENT = 10_000, 3, 42, 20, 5
#: Bytes of a word (and its blank) up to which tables do; checksums with longer words are taken from their bytes.
SHORT = 64


def _bytewise() -> np.ndarray:
    """What one more byte makes of a checksum register's low byte: the reflected polynomial of CRC-32."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_BYTE = _bytewise()


def _appended() -> np.ndarray:
    """For n = 0 ... SHORT, by byte of a checksum and its value: what n more bytes make of it."""
    now = np.arange(256, dtype=np.uint32) << np.array([[0], [8], [16], [24]], np.uint32)
    out = [now]
    for _ in range(SHORT):
        now = _BYTE[now & 0xFF] ^ (now >> 8)
        out.append(now)
    return np.stack(out)


_APPENDED = _appended()


def _joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Checksums of texts put together, from those of both parts and the bytes of the right one."""
    out = right.copy()
    for k in range(4):
        out ^= _APPENDED[size, k, (left >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


class Features:
    """All features of a slice of texts: for each length from one word on its buckets and the word it begins with; and each text's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, longest: int = LONGEST):
        data = columns.LOWER[data]
        self.starts, ends, self.first = columns.words(data, offsets, columns.ALNUM)
        size = ends - self.starts
        n = len(size)
        long = size >= SHORT
        plain = np.where(long, 0, size)
        own, after = np.full(n, 0xFFFFFFFF, np.uint32), np.full(n, 0xFFFFFFFF, np.uint32)
        after = _BYTE[(after ^ 32) & 0xFF] ^ (after >> np.uint32(8))  # words with a blank before them
        at = np.flatnonzero(plain)
        for k in range(int(plain.max(initial=0))):
            at = at[plain[at] > k]
            byte = data[self.starts[at] + k]
            own[at] = _BYTE[(own[at] ^ byte) & 0xFF] ^ (own[at] >> np.uint32(8))
            after[at] = _BYTE[(after[at] ^ byte) & 0xFF] ^ (after[at] >> np.uint32(8))
        own, after = ~own, ~after
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        raw = data.tobytes() if long.any() else b""
        spelled = lambda i, m: zlib.crc32(b" ".join([raw[self.starts[j] : ends[j]] for j in range(i, i + m)]))
        own[long] = [spelled(i, 1) for i in np.flatnonzero(long).tolist()]
        self.buckets, self.begin, sums, at, odd = [], [], own, np.arange(n), long
        self.buckets.append((sums % np.uint32(buckets)).astype(np.int64))
        self.begin.append(at)
        for m in range(2, longest + 1):
            at = np.arange(max(n - m + 1, 0))
            last = at + m - 1
            sums = _joined(sums[: len(at)], after[last], np.where(long[last], 0, size[last] + 1))
            odd = odd[: len(at)] | long[last]
            same = owner[at] == owner[last]
            by_hand = np.flatnonzero(odd & same)
            sums[by_hand] = [spelled(i, m) for i in by_hand.tolist()]
            self.begin.append(at[same])
            self.buckets.append((sums[same] % np.uint32(buckets)).astype(np.int64))

    def counts(self) -> np.ndarray:
        """Features of every text."""
        words = np.diff(self.first)
        return sum(np.maximum(words - m, 0) for m in range(len(self.buckets)))

    def sums(self, gain: np.ndarray) -> np.ndarray:
        """The gains of every text's features, added up."""
        out = np.zeros(len(self.first) - 1, np.int64)
        for bucket, begin in zip(self.buckets, self.begin):
            total = np.concatenate([[0], np.cumsum(gain[bucket])])
            out += np.diff(total[np.searchsorted(begin, self.first)])
        return out

    def table(self, times: np.ndarray, buckets: int) -> np.ndarray:
        """Features by bucket, those of each text counted as often as ``times`` says."""
        out = np.zeros(buckets, np.int64)
        for bucket, begin in zip(self.buckets, self.begin):
            text = np.searchsorted(self.first, begin, side="right") - 1
            np.add.at(out, bucket, times[text])
        return out

    def across(self, breaks: np.ndarray, buckets: int) -> np.ndarray:
        """Features by bucket of those that reach over one of the ``breaks`` (byte positions in order)."""
        line = np.searchsorted(breaks, self.starts)
        out = np.zeros(buckets, np.int64)
        for m, (bucket, begin) in enumerate(zip(self.buckets, self.begin)):
            if m:
                out += np.bincount(bucket[line[begin] != line[begin + m]], minlength=buckets)
        return out


def segments(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """One row per line (lower-cased, without its line feed), and one per task with the features that reach over line feeds: line, across."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = np.zeros(buckets, np.int64)
        for batch in columns.slices(batches, "text"):
            data, offsets = columns.flat(batch.column("text"))
            breaks = np.flatnonzero(data == 10)
            over += Features(data, offsets, buckets, longest).across(breaks, buckets)
            # every line but the empty ones is a stretch of the bytes without line feeds
            plain = columns.LOWER[np.delete(data, breaks)]
            gone = lambda at: at - np.searchsorted(breaks, at)
            edge = np.unique(gone(np.concatenate([offsets, breaks])))
            if len(plain):
                column = pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(plain)])
                yield pa.RecordBatch.from_arrays([column, pa.nulls(len(edge) - 1, pa.binary())], ["line", "across"])
        if over.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.binary()), pa.array([over.tobytes()], pa.binary())], ["line", "across"])

    return texts.select(F.col("text").cast("string").alias("text")).where("text IS NOT NULL").mapInArrow(run, "line binary, across binary")


def features(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each bucket; the table has a fixed size."""
    distinct = segments(texts, buckets, longest).groupBy("line", "across").agg(F.count(F.lit(1)).alias("times"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(buckets, np.int64)
        for batch in batches:
            for own, times in zip(batch.column("across").to_pylist(), batch.column("times").to_pylist()):
                if own is not None:
                    out += times * np.frombuffer(own, np.int64)
            for part in columns.slices(iter([batch]), "line"):
                times = np.where(part.column("line").is_valid().to_numpy(zero_copy_only=False), part.column("times").to_numpy(), 0)
                out += Features(*columns.flat(part.column("line")), buckets, longest).table(times, buckets)
        filled = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(out[filled])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in distinct.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the log-ratio of a bucket's smoothed shares, rounded down."""
    size, s, t = len(corpus), corpus.tolist(), target.tolist()
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + size) / ((a + 1) * (all_t + size)))) for a, b in zip(s, t)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id in thousandths, rounded down; a null id counts as an empty text."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """The documents with n_words, n_features, weight and score in columns of new names (in this order, the last four)."""
    names = columns.fresh(docs.columns, "n_words", "n_features", "weight", "score")
    gain = docs.sparkSession.sparkContext.broadcast(gains(features(docs, buckets, longest), features(target, buckets, longest)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            found = Features(*columns.flat(batch.column("text")), buckets, longest)
            weight = found.sums(gain.value)
            chance = np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64)
            made = [np.diff(found.first), found.counts(), weight, weight + chance]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.astype(np.int64)) for x in made)], [*batch.schema.names, *names])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *(StructField(name, LongType()) for name in names)]))


def _ranked(rows: DataFrame, least_words: int, percent: int) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score) with their rank among those drawn, else null.

    Candidates are sorted in ranges of (score, doc_id, a number of the row) and written, so that a large group of equal rows spreads
    over ranges; a row's rank is the size of the ranges before it and its place in its own.
    """
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = rows.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumn("place", F.monotonically_increasing_id())).withColumn("part", F.shiftright("place", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    before = sizes.select("part", F.coalesce(F.sum("size").over(every), F.lit(0)).alias("before"))
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.join(before, "part").join(F.broadcast(total)).withColumn("rank", rank)  # total: one row
    ranked = ranked.withColumn("rank", F.expr(f"IF(rank <= total * {int(percent)} div 100, rank, NULL)"))
    names = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.select(*names).unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")).select(*names))


def report(docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank (from 1 for drawn documents, null for others).

    Null and empty texts have no features, weight 0 and the score of their noise. Of N rows with ``least_words`` words or more the
    floor(percent * N / 100) best are drawn, ties to the smaller doc_id, null ids last; repeated rows are candidates each, in any order. An empty
    table gives no row, an empty target counts no feature, other columns do not matter. A text of any length is one slice of a task, which
    holds some 200 bytes a byte of it.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = scored(plain, target, seed=seed).drop("text")
    return _ranked(made, least_words, percent).drop("n_words")


def resample(docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """The drawn documents with their columns. Rows that equal the last one drawn in score and doc_id stay with it.

    The limit is the last drawn row of the ranking, so texts are neither sorted nor shuffled.
    """
    made = scored(docs, target, seed=seed)
    doc_id, figures = F.col("doc_id").cast("long"), made.columns[-4:]
    words, score = figures[0], figures[3]
    rows = made.select(doc_id.alias("doc_id"), *(F.col(c).alias(n) for c, n in zip(figures, ("n_words", "n_features", "weight", "score"))))
    last = _ranked(rows, least_words, percent).where("rank IS NOT NULL").orderBy(F.col("rank").desc()).limit(1).collect()
    if not last:
        return docs.limit(0)
    least = F.lit(last[0].score)
    if last[0].doc_id is None:
        tie = F.lit(True)
    else:
        tie = F.coalesce(doc_id <= F.lit(last[0].doc_id), F.lit(False))
    return made.where((F.col(words) >= least_words) & ((F.col(score) > least) | ((F.col(score) == least) & tie))).select(*docs.columns)
