"""Substring deduplication: passages of many words that stand anywhere else are taken out of every text.

A window is a fixed number of consecutive words. Its anchor is the short word gram with the smallest hash in it, so equal windows
have equal anchors, and neighbouring windows mostly share one; the windows of one anchor are a run.

1. Every task counts anchors in a count-min sketch of its partition. The sketches are merged block by block. A merged count is
   never below the number of times that a window with this anchor occurs, whatever collides.
2. A second pass writes only runs whose anchor is estimated to occur twice or more. Runs of equal words are grouped exactly; what
   has equals is repeated as a whole, of the others each window is grouped exactly, by hashes of 128 bits.

Copies and hot passages are counted before they are shuffled, and joined by keys that Spark may split; no group is ever gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.session import stored
from provfin.llm import columns
from provfin.llm.decontaminate import cut_words

#: Words of a window and of the gram that anchors it.
WINDOW, GRAM = 35, 8
#: Cells of a sketch row: these many times the anchors expected, between the bounds; at the upper bound (128 MB for both rows)
#: the sketch fills up, and the exact pass gets more runs but misses none.
CELLS_PER_ANCHOR, LEAST_BITS, MOST_BITS = 6, 20, 29
BLOCK_BITS, ROWS, PENDING, TOLD = 20, 2, 1 << 19, 1 << 17


def runs(data: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of all texts: owner, first window (word index in its text), number of windows, anchor; and the rolling hashes."""
    starts, ends, first = columns.words(data, offsets, columns.SPACED)
    n = len(starts)
    none = np.zeros(0, np.int64)
    if n < window:
        return {"owner": none, "at": none, "begin": none, "count": none, "anchor": none.astype(np.uint64), "first": first, "starts": starts}
    one = columns.Rolling(columns.word_hashes(data, starts, ends, 0), 0)
    position = np.arange(n - gram + 1)
    value = one.spans(position, position + gram)
    where, low, width, span = position, value, 1, window - gram + 1
    while width < span:  # smallest gram of ever wider stretches, the leftmost of equals
        step = min(width, span - width)
        right = low[step:] < low[:-step]
        low = np.where(right, low[step:], low[:-step])
        where = np.where(right, where[step:], where[:-step])
        width += step
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    valid = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    if len(valid) == 0:
        return {"owner": none, "at": none, "begin": none, "count": none, "anchor": none.astype(np.uint64), "first": first, "starts": starts}
    anchor = where[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[valid[1:]] != owner[valid[:-1]])
    edge = np.flatnonzero(new)
    begin = valid[edge]
    count = np.diff(np.append(edge, len(valid)))
    return {"owner": owner[begin], "at": begin - first[owner[begin]], "begin": begin, "count": count, "anchor": value[anchor[edge]],
            "first": first, "starts": starts, "ends": ends}


def _cells(anchor: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (columns.mix(anchor + np.uint64(columns.BASES[row])) >> np.uint64(64 - bits)).astype(np.int64)


def _partial(anchors: np.ndarray, bits: int) -> pa.RecordBatch:
    """A sketch of some anchors: for each block its touched cells, the top bit set where two or more anchors meet."""
    block, packed = [], []
    for row in range(ROWS):
        cell, count = np.unique(_cells(anchors, row, bits), return_counts=True)
        code = (cell & ((1 << BLOCK_BITS) - 1)).astype(np.uint32) | ((count > 1).astype(np.uint32) << np.uint32(31))
        number = cell >> BLOCK_BITS
        edge = np.flatnonzero(np.diff(number, prepend=-1))
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(cell)]):
            block.append((row << (bits - BLOCK_BITS)) + int(number[a]))
            packed.append(code[a:b].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(packed, pa.binary())], ["block", "cells"])


def sketch(docs: DataFrame, bits: int, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Bits of the merged sketch: set where an anchor's cell counts two or more. Its size is fixed by ``bits`` alone."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in columns.slices(batches, "text"):
            held.append(runs(*columns.flat(batch.column("text")), window, gram)["anchor"])
            size += len(held[-1])
            if size >= PENDING:
                yield _partial(np.concatenate(held), bits)
                held, size = [], 0
        if size:
            yield _partial(np.concatenate(held), bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count = None, np.zeros(1 << BLOCK_BITS, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(count > 1).tobytes()], pa.binary())], ["block", "cells"])

        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("cells")):
                if block != now:
                    if now is not None:
                        yield done()
                    now = block
                    count[:] = 0
                code = np.frombuffer(packed.as_buffer(), np.uint32)
                cell = (code & np.uint32(0x7FFFFFFF)).astype(np.int64)
                count[cell] = np.minimum(count[cell] + 1 + (code >> np.uint32(31)).astype(np.uint8), 2)
        if now is not None:
            yield done()

    shape = "block int, cells binary"
    merged = docs.select("text").mapInArrow(partial, shape).repartition("block").sortWithinPartitions("block").mapInArrow(merge, shape)
    out = np.zeros(ROWS << (bits - 3), np.uint8)
    for row in merged.toLocalIterator():
        at = row["block"] << (BLOCK_BITS - 3)
        out[at : at + len(row["cells"])] = np.frombuffer(row["cells"], np.uint8)
    return out


def repeated_runs(docs: DataFrame, bits: int, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Runs whose anchor is estimated to occur twice or more: body, twin (two hashes of the text), at, size, anchor, another hash of all its words,
    and the hashes of its windows, which a task writes once for runs of equal words (else null)."""
    merged = docs.sparkSession.sparkContext.broadcast(sketch(docs, bits, window, gram))
    names = ["body", "twin", "at", "size", "anchor", "words", "windows"]
    shape = "body long, twin long, at int, size int, anchor long, words long, windows array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = merged.value
        told: set[int] = set()
        for batch in columns.slices(batches, "text"):
            data, offsets = columns.flat(batch.column("text"))
            found = runs(data, offsets, window, gram)
            keep = np.ones(len(found["anchor"]), bool)
            for row in range(ROWS):
                cell = _cells(found["anchor"], row, bits) + (row << bits)
                keep &= (flags[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
            pick = np.flatnonzero(keep)
            if not len(pick):
                continue
            begin, count = found["begin"][pick], found["count"][pick]
            other = columns.Rolling(columns.word_hashes(data, found["starts"], found["ends"], 1), 1)
            end = begin + count + window - 1
            equal = other.spans(begin, end)
            new = np.zeros(len(pick), bool)
            _, once = np.unique(equal, return_index=True)
            new[[i for i, w in zip(once.tolist(), equal[once].tolist()) if w not in told]] = True
            if len(told) > TOLD:
                told.clear()
            told.update(equal[new].tolist())
            total = np.concatenate([[0], np.cumsum(np.where(new, count, 0))])
            each = np.arange(total[-1]) + np.repeat(begin - total[:-1], np.diff(total))
            windows = pa.ListArray.from_arrays(
                pa.array(total.astype(np.int32), mask=np.append(~new, False)), pa.array(other.spans(each, each + window).view(np.int64))
            )
            who = pa.array(found["owner"][pick])
            arrays = [batch.column("body").take(who), batch.column("twin").take(who), pa.array(found["at"][pick].astype(np.int32)),
                      pa.array(count.astype(np.int32)), pa.array(found["anchor"][pick].view(np.int64)), pa.array(equal.view(np.int64)), windows]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select("body", "twin", "text").mapInArrow(run, shape)


def sketch_bits(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> int:
    """Width of a sketch row for these texts, as a power of two."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    anchors = size / 6 * 2 / (window - gram + 2)
    return min(max(int(anchors * CELLS_PER_ANCHOR).bit_length(), LEAST_BITS), MOST_BITS)


def covers(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """Stretches of repeated windows: body, twin (two hashes of the text), at, size (first window and number of windows).

    Equal texts have equal stretches, so they are told by text, not by row; a text that stands in many rows gives each stretch as often.
    """
    found = stored(repeated_runs(docs, bits or sketch_bits(docs, window, gram), window, gram))
    alike = ["anchor", "words"]
    distinct = found.groupBy(*alike).agg(
        F.count(F.lit(1)).alias("n"), *(F.first(c, ignorenulls=True).alias(c) for c in ("body", "twin", "at", "windows"))
    )
    distinct = stored(distinct.withColumn("row", F.monotonically_increasing_id()))
    whole = found.select("body", "twin", "at", "size", *alike)
    whole = whole.join(distinct.where("n > 1").select(*alike), alike, "left_semi")
    each = distinct.select("anchor", "n", "row", F.posexplode("windows").alias("step", "window"))
    again = each.groupBy("anchor", "window").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "window")
    single = each.where("n = 1").select("anchor", "window", (F.col("row") * 64 + F.col("step")).alias("place"))
    single = single.join(again, ["anchor", "window"], "left_semi")
    single = single.groupBy(F.expr("place div 64").alias("row")).agg(F.collect_list(F.expr("CAST(place % 64 AS INT)")).alias("steps"))
    parts = single.join(distinct.where("n = 1").select("row", "body", "twin", "at"), "row")
    parts = parts.select("body", "twin", F.explode("steps").alias("step"), "at").select("body", "twin", F.expr("at + step").alias("at"), F.lit(1).alias("size"))
    return whole.select("body", "twin", "at", "size").unionByName(parts)


def _with_covers(docs: DataFrame, window: int, gram: int, bits: int | None) -> tuple[DataFrame, str]:
    """The documents with the packed stretches of covered words (null if none), and the name of that column."""
    body, twin, name, of, alike = columns.fresh(docs.columns, "body", "twin", "covered", "of", "alike")
    keyed = docs.withColumns({body: F.xxhash64("text"), twin: F.xxhash64(F.lit(7), "text")})
    plain = keyed.select(F.col(body).alias("body"), F.col(twin).alias("twin"), F.col("text").cast("string").alias("text"))
    found = covers(plain, window, gram, bits).groupBy(F.col("body").alias(of), F.col("twin").alias(alike))
    found = found.agg(F.collect_set(F.struct("at", "size")).alias(name))  # of one text; its copies add nothing
    joined = keyed.join(found, (F.col(body) == F.col(of)) & (F.col(twin) == F.col(alike)), "left")
    return joined.select(*docs.columns, name), name


def _flags(stretches, words: int, window: int) -> np.ndarray:
    """Which words of a text its stretches cover."""
    edge = np.zeros(words + 1, np.int64)
    at = np.array([s["at"] for s in stretches], np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + np.array([s["size"] for s in stretches], np.int64) + window - 1, -1)
    return np.cumsum(edge)[:-1] > 0


def report(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by blanks).

    Null texts have no words. A repeated row is an occurrence of its own, so its long texts go altogether; ids may be null or repeated.
    A text of any length is one slice of a task, which holds some 120 bytes a byte of it.
    """
    joined, name = _with_covers(docs.select("doc_id", "text"), window, gram, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            data, offsets = columns.flat(batch.column("text"))
            starts, ends, first = columns.words(data, offsets, columns.SPACED)
            raw, gone, digest = data.tobytes(), [], []
            for i, stretches in enumerate(batch.column(name).to_pylist()):
                a, b = int(first[i]), int(first[i + 1])
                span = list(zip(starts[a:b].tolist(), ends[a:b].tolist()))
                gone.append(0)
                if stretches:
                    flags = _flags(stretches, b - a, window)
                    gone[-1] = int(flags.sum())
                    span = [s for s, f in zip(span, flags.tolist()) if not f]
                digest.append(hashlib.sha256(b" ".join([raw[s:e] for s, e in span])).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(np.diff(first)), pa.array(gone, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int | None = None) -> DataFrame:
    """The documents, with their columns; covered words go with what stands before the next word, and ``n_chars`` is counted anew."""
    joined, name = _with_covers(docs, window, gram, bits)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            data, offsets = columns.flat(batch.column("text"))
            starts, _, first = columns.words(data, offsets, columns.SPACED)
            packed = []
            for i, stretches in enumerate(batch.column(name).to_pylist()):
                edge = np.diff(_flags(stretches, int(first[i + 1] - first[i]), window).astype(np.int8), prepend=0, append=0) if stretches else []
                packed.append(np.flatnonzero(edge).astype("<i8").tobytes())
            yield cut_words(batch.select(names), data, offsets, starts, first, packed)

    return joined.mapInArrow(run, docs.schema)
