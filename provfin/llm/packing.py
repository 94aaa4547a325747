"""Packing along a space-filling curve: neighbouring documents share training sequences.

Every document becomes a hashed bag-of-words vector, projected to a few dimensions and placed on a Hilbert curve. Documents
are sorted by their place, encoded, and cut into sequences of a fixed number of ids. What is left at the end of a partition
goes into sequences whose lengths are powers of two, so that no padding is needed at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.llm import columns

#: Dimensions of the curve, bits of each, and slots of the hashed vector before projection.
DIMENSIONS, BITS, SLOTS = 4, 12, 4096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates (rows) of ``bits`` bits each.

    The axes are turned step by step from the highest bit down (Skilling's transform), then their bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for axis in range(n):
            high = (x[axis] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(high, low, swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] & (1 << bit)) != 0, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> bit) & 1)
    return key


def _projection() -> np.ndarray:
    """A fixed random direction for each slot of the hashed vector."""
    bits = columns.mix(np.arange(1, SLOTS * DIMENSIONS + 1, dtype=np.uint64))
    return np.where(bits & np.uint64(1), 1.0, -1.0).reshape(SLOTS, DIMENSIONS)


def curve_keys(data: np.ndarray, offsets: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Place on the curve of every text; texts without words lie in the middle of all axes."""
    starts, ends, first = columns.words(data, offsets, columns.SPACED)
    slot = (columns.word_hashes(data, starts, ends) >> np.uint64(52)).astype(np.int64)
    sums = np.zeros((len(starts) + 1, DIMENSIONS))
    np.cumsum(projection[slot], axis=0, out=sums[1:])
    count = np.diff(first)
    point = (sums[first[1:]] - sums[first[:-1]]) / np.sqrt(np.maximum(count, 1))[:, None]
    share = 0.5 + 0.5 * np.tanh(0.8 * point)  # about the share of documents below
    return hilbert_keys(np.minimum(share * (1 << BITS), (1 << BITS) - 1).astype(np.int64))


def _place(df: DataFrame, edges: list[tuple[int, int]] | None = None) -> DataFrame:
    """doc_id, text, curve, and with ``edges`` the range of (curve, doc_id) that a document falls into."""
    shape = "doc_id long, text string, curve long" + (", part int" if edges is not None else "")
    bounds = np.array(edges or [], np.int64).reshape(-1, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projection = _projection()
        for batch in columns.slices(batches, "text"):
            curve = curve_keys(*columns.flat(batch.column("text")), projection)
            arrays = [batch.column("doc_id"), batch.column("text"), pa.array(curve)]
            if edges is not None:
                ids = batch.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
                low = np.searchsorted(bounds[:, 0], curve, side="left")
                part = np.empty(len(curve), np.int32)
                high = np.searchsorted(bounds[:, 0], curve, side="right")
                for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):  # edges of one place on the curve differ by doc_id
                    part[i] = a + np.searchsorted(bounds[a:b, 1], ids[i], side="right") if a < b else a
                arrays.append(pa.array(part))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text", "curve", "part"][: len(arrays)])

    return df.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, shape)


def _cut(
    ids: np.ndarray, docs: list[tuple[int | None, int, int, int]], bounds: np.ndarray, first_sequence: int
) -> list[tuple]:
    """Pieces of a run of documents cut at ``bounds`` (the end of each sequence); docs: doc_id, its length, start, and place in the run."""
    where = np.array([d[3] for d in docs], np.int64)
    cuts = np.unique(np.concatenate([where, bounds[:-1], [0]]))
    cuts = cuts[cuts < bounds[-1]]
    ends = np.append(cuts[1:], bounds[-1])
    doc = np.searchsorted(where, cuts, side="right") - 1
    sequence = np.searchsorted(bounds, cuts, side="right")
    opens = np.concatenate([[0], bounds])[sequence]
    memory = memoryview(ids.astype("<u4", copy=False))
    out = []
    for a, b, d, s, o in zip(cuts.tolist(), ends.tolist(), doc.tolist(), sequence.tolist(), opens.tolist()):
        name, total, start, at = docs[d]
        out.append((name, start + a - at, b - a, zlib.crc32(memory[a:b]), total, first_sequence + s, a - o))
    return out


def _batch(rows: list[tuple], run: np.ndarray) -> pa.RecordBatch:
    """Pieces, which stand in ``run`` one after another, with their ids."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    ends = np.cumsum([0, *(r[2] for r in rows)])
    ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(run[: ends[-1]].astype(np.int32)))
    return pa.RecordBatch.from_arrays([*(pa.array(list(c), pa.int64()) for c in zip(*rows)), ids], names)


def pack_rows(batches: Iterator[pa.RecordBatch], path: str, length: int, partition: int) -> Iterator[pa.RecordBatch]:
    """Pieces of the documents of one partition, in their order; holds one slice and one open sequence."""
    from provfin.llm.tokens import encoder

    encode = encoder(path).encode
    sequence = partition << 40
    rest, open_docs = np.zeros(0, np.uint32), []  # the open sequence: its ids, and the documents in it
    for batch in columns.slices(batches, "text"):
        ids, at = encode(*columns.flat(batch.column("text")))
        count = np.diff(at) + 1
        run = np.zeros(len(rest) + len(ids) + len(count), np.uint32)
        run[: len(rest)] = rest
        begin = len(rest) + np.cumsum(count) - count
        run[np.arange(len(ids)) + np.repeat(begin - at[:-1], count - 1)] = ids
        docs = open_docs + [(d, n, 0, w) for d, n, w in zip(batch.column("doc_id").to_pylist(), count.tolist(), begin.tolist())]
        full = len(run) // length
        if full:
            if rows := _cut(run, docs, np.arange(1, full + 1) * length, sequence):
                yield _batch(rows, run)
            sequence += full
        cut = full * length
        keep = max(int(np.searchsorted([d[3] for d in docs], cut, side="right")) - 1, 0)
        rest = run[cut:].copy()
        open_docs = [(d, n, s + max(cut - w, 0), max(w - cut, 0)) for d, n, s, w in docs[keep:]] if len(rest) else []
    if len(rest):
        sizes = [1 << b for b in range(length.bit_length(), -1, -1) if len(rest) >> b & 1]
        yield _batch(_cut(rest, open_docs, np.cumsum(sizes), sequence), rest)


def pack(docs: DataFrame, tokenizer: str, length: int = 1024, parts_per_task: int = 8) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A sequence is its pieces' ids in the order of offsets; ids_crc32 is that of the piece's ids as little-endian 32-bit numbers. Ranges of (place on the curve, doc_id) are bounded by a sample of places, as a range sort does it, so copies of one text
    spread over as many ranges as they need; every range is sorted and its documents are packed one after another.
    Null texts are empty (one id, 0); null ids stay null; repeated rows are packed each; an empty table gives no row. Extra
    columns do not matter. A text of any length is cut over as many sequences as it fills.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    rows = docs.count()
    parts = parts_per_task * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, 20 * parts / max(rows, 1))
    drawn = _place(docs.sample(False, share, 7) if share < 1 else docs).select("curve", "doc_id").fillna(-(1 << 63), ["doc_id"])
    found = sorted((r[0], r[1]) for r in drawn.collect())  # some 20 for each range
    edges = sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []
    placed = _place(docs, edges).repartition("part")
    order = ["part", "curve", F.col("doc_id").asc_nulls_first(), "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from pack_rows(batches, tokenizer, length, TaskContext.get().partitionId())

    return placed.sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, PIECES)
