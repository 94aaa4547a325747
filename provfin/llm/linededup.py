"""Line deduplication: lines that many documents hold stay in one of them.

Texts are cut at line feeds. A line's key is the line without ASCII white space at its ends and with A-Z lowered. Every line whose
key is long enough becomes a row of its key's hash (128 bits), its document and its position. Hashes are counted by distinct
documents; a hash over the threshold keeps the lines of the smallest doc_id that holds it, and the positions of all its other
lines go back to their documents, where the rest of the lines are joined again in order.

Lines that stand in a large share of all documents are counted with partial sums before they are shuffled, and the join that
brings decisions back to lines is one that Spark may split. A group that is gathered holds the positions of one text.
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

#: Code points of a key from which on it counts, and documents from which on a key loses lines.
LEAST_CHARS, LEAST_DOCS = 10, 2


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of every line, and the index of each text's first line (one entry more than texts); a text has one line at least."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, offsets)
    texts = len(offsets) - 1
    first = before + np.arange(texts + 1)
    owner = np.repeat(np.arange(texts), np.diff(before))
    begin, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    begin[first[:-1]], end[first[1:] - 1] = offsets[:-1], offsets[1:]
    at = np.arange(len(breaks)) + owner
    end[at], begin[at + 1] = breaks, breaks + 1
    return begin, end, first


def keys(data: np.ndarray, offsets: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines whose key has ``least_chars`` code points or more: the text, the position in it, and the key's hash as two numbers."""
    from xxhash import xxh3_128_digest

    begin, end, first = cut(data, offsets)
    solid = np.flatnonzero(columns.SPACED[data])
    low, high = np.searchsorted(solid, begin), np.searchsorted(solid, end)
    line = np.flatnonzero(high > low)
    a, b = solid[low[line]], solid[high[line] - 1] + 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = points[b] - points[a] >= least_chars
    line, a, b = line[long], a[long], b[long]
    raw = columns.LOWER[data].tobytes()
    digest = b"".join([xxh3_128_digest(raw[i:j]) for i, j in zip(a.tolist(), b.tolist())])
    owner = np.searchsorted(first, line, side="right") - 1
    return owner, line - first[owner], np.frombuffer(digest, "<i8").reshape(-1, 2)


def lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per line that counts: key1, key2 (its key's hash), doc_id, body, at (position). docs: doc_id, body (any number that tells texts of one id apart), text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            owner, at, key = keys(*columns.flat(batch.column("text")), least_chars)
            who = pa.array(owner)
            arrays = [pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()), batch.column("doc_id").take(who), batch.column("body").take(who), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["key1", "key2", "doc_id", "body", "at"])

    return docs.select("doc_id", "body", "text").mapInArrow(run, "key1 long, key2 long, doc_id long, body long, at int")


def repeated(found: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """key1, key2, n_docs, first_id of every key that ``least_docs`` documents or more hold; null ids are one document, the last."""
    each = found.groupBy("key1", "key2", "doc_id").agg(F.lit(1).alias("one"))
    counted = each.groupBy("key1", "key2").agg(F.count("one").alias("n_docs"), F.min("doc_id").alias("first_id"))
    return counted.where(F.col("n_docs") >= least_docs)


def _with_drops(docs: DataFrame, least_chars: int, least_docs: int) -> tuple[DataFrame, str]:
    """The documents with the positions of the lines they lose (null if none), and the name of that column."""
    body, name, of, hashed = columns.fresh(docs.columns, "body", "dropped", "of", "hash")
    keyed = docs.withColumn(body, F.xxhash64("text"))
    plain = keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(body).alias("body"), F.col("text").cast("string").alias("text"))
    found = stored(lines(plain, least_chars))
    # written, so that both sides of the join are plain shuffles and Spark may split the lines of a hot key
    lost = found.join(stored(repeated(found, least_docs)), ["key1", "key2"]).where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    lost = lost.groupBy(F.col("doc_id").alias(of), F.col("body").alias(hashed)).agg(F.collect_set("at").alias(name))  # positions of one text
    joined = keyed.join(lost, F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.col(body) == F.col(hashed)), "left")
    return joined.select(*docs.columns, name), name


def _kept(batch: pa.RecordBatch, name: str) -> Iterator[tuple[bytes, int, int]]:
    """For each text of a slice the lines that stay, joined again, and how many lines it had and loses."""
    data, offsets = columns.flat(batch.column("text"))
    begin, end, first = cut(data, offsets)
    raw = data.tobytes()
    for i, gone in enumerate(batch.column(name).to_pylist()):
        a, b = int(first[i]), int(first[i + 1])
        if not gone:
            yield raw[offsets[i] : offsets[i + 1]], b - a, 0
            continue
        stays = np.ones(b - a, bool)
        stays[gone] = False
        at = a + np.flatnonzero(stays)
        yield b"\n".join([raw[s:e] for s, e in zip(begin[at].tolist(), end[at].tolist())]), b - a, len(gone)


def report(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Per row: doc_id, n_lines (before dropping), n_dropped, kept_sha256.

    Null and empty texts are one empty line. Rows of one doc_id are one document: they lose no line to one another. Null ids are
    one document, which comes after all others. Repeated rows are reported each, an empty table gives no row, other columns do
    not matter. A text of any length is one slice of a task, which holds some 40 bytes a byte of it.
    """
    joined, name = _with_drops(docs.select("doc_id", "text"), least_chars, least_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            made = [(n, lost, hashlib.sha256(text).hexdigest()) for text, n, lost in _kept(batch, name)]
            total, lost, digest = zip(*made) if made else ((), (), ())
            arrays = [batch.column("doc_id").cast("int64"), pa.array(total, pa.int64()), pa.array(lost, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def remove(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents with their columns, without the lines they lose; ``n_chars``, if there, is counted anew for changed texts. Null texts stay null."""
    joined, name = _with_drops(docs, least_chars, least_docs)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            own = batch.select(names)
            changed = {i: text.decode() for i, (text, _, lost) in enumerate(_kept(batch, name)) if lost}
            new = {"text": pa.array([changed.get(i, t) for i, t in enumerate(own.column("text").to_pylist())], own.schema.field("text").type)}
            if "n_chars" in names:
                counts = [len(changed[i]) if i in changed else n for i, n in enumerate(own.column("n_chars").to_pylist())]
                new["n_chars"] = pa.array(counts, own.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([new.get(c, own.column(c)) for c in names], schema=own.schema)

    return joined.mapInArrow(run, docs.schema)
