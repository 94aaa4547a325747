"""SimHash near-duplicates by meeting in the middle.

A text's fingerprint has a bit for each bit of 64-bit shingle hashes, set where over half of them have it. Two fingerprints that
differ in at most two bits have a common variant within one bit of each. So every distinct fingerprint emits itself and its 64
one-bit variants, and those that meet at a variant are neighbours. At most 65 fingerprints can meet there, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provfin.functions.session import stored
from provfin.llm import columns, components

#: Words of a shingle, seed of their hash, and bits in which near-duplicates may differ (twice the emitted radius of one).
SHINGLE, SEED, DISTANCE = 3, 42, 2
#: A byte's bits in the eight bytes of a number, the lowest bit first: up to 255 such numbers add up without carry.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprint of every text; zero for texts without words."""
    from xxhash import xxh64_intdigest

    data = columns.LOWER[data]
    starts, ends, first = columns.words(data, offsets, columns.SPACED)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not len(starts):
        return out
    # words with one blank after each, and where they stand then
    length = ends - starts
    begin = np.cumsum(length + 1) - length - 1
    spaced = np.full(int(begin[-1] + length[-1] + 1), 32, np.uint8)
    source = np.arange(int(length.sum()))
    before = np.cumsum(length) - length
    spaced[source + np.repeat(begin - before, length)] = data[source + np.repeat(starts - before, length)]
    end = begin + length
    words = np.diff(first)
    owner = np.flatnonzero(words)
    count = np.maximum(words[owner] - shingle + 1, 1)
    total = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(total[-1]) + np.repeat(first[owner] - total[:-1], count)
    last = np.minimum(at + shingle, np.repeat(first[owner + 1], count)) - 1
    raw = spaced.tobytes()
    hashes = np.fromiter((xxh64_intdigest(raw[a:b], seed) for a, b in zip(begin[at].tolist(), end[last].tolist())), np.uint64, len(at))
    lanes = _SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    # stretches of up to 255 shingles, then documents
    parts = -(-count // 255)
    part = np.concatenate([[0], np.cumsum(parts)])
    cut = np.repeat(total[:-1], parts) + 255 * (np.arange(part[-1]) - np.repeat(part[:-1], parts))
    sums = np.add.reduceat(lanes, cut, axis=0).view(np.uint8).reshape(-1, 64)
    sums = np.add.reduceat(sums, part[:-1], axis=0, dtype=np.int64)
    bits = (2 * sums > count[:, None]).astype(np.uint8)
    out[owner] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprinted(docs: DataFrame, keys: list[str]) -> DataFrame:
    """The key columns with ``print``, the fingerprint as a signed number."""
    kept = docs.select(*keys, F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            made = pa.array(fingerprints(*columns.flat(batch.column("text"))).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), made], [*keys, "print"])

    return kept.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in kept.select(*keys).dtypes) + ", print long")


def links(prints: DataFrame) -> DataFrame:
    """Links between distinct fingerprints that differ in at most two bits: all that meet at a variant are linked to its smallest.

    Any two that meet are themselves linked, so leaving out the pairs in between loses no connection.
    """
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)))
    met = prints.select("print").distinct().select("print", F.explode(flips).alias("flip")).select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("variant"))
    met = met.withColumn("other", F.min("print").over(Window.partitionBy("variant")))
    pairs = met.where(F.col("print") != F.col("other")).select("other", "print").distinct()
    return pairs.where(F.bit_count(F.col("other").bitwiseXOR(F.col("print"))) <= DISTANCE)


def groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (hex digits), component_id (the smallest doc_id of its group).

    Null and blank texts have fingerprint zero and are linked as any other; null ids stay null and are the smallest of a group
    only if it has no other; repeated rows are members each; no documents give no row.
    """
    prints = stored(fingerprinted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"]))
    return labelled(prints).select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def rooted(prints: DataFrame) -> DataFrame:
    """print and root (a fingerprint of its group) for every distinct fingerprint."""
    distinct = prints.select("print").distinct()
    found = components.roots(links(prints))
    return distinct.join(found, F.col("print") == F.col("node"), "left").select("print", F.coalesce("root", "print").alias("root"))


def labelled(prints: DataFrame) -> DataFrame:
    """The rows with component_id."""
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    least = least.join(rooted(prints), "print")
    group = least.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(least.join(group, "root").select("print", "component_id"), "print")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates, with their columns: of each group the row with the smallest doc_id (nulls last) stays.

    Rows of equal doc_id are told apart by their text; of rows equal in both, one stays.
    """
    body, unnamed = columns.fresh(docs.columns, "body", "unnamed")
    keyed = docs.withColumn(body, F.xxhash64(F.col("doc_id").cast("long"), "text")).withColumn(unnamed, F.col("doc_id").isNull())
    rows = keyed.select(F.col(unnamed).alias("unnamed"), F.col("doc_id").cast("long").alias("doc_id"), F.col(body).alias("body"), "text")
    prints = stored(fingerprinted(rows, ["unnamed", "doc_id", "body"]))
    least = F.min(F.struct("unnamed", "doc_id", "body")).alias("least")
    first = prints.groupBy("print").agg(least).join(rooted(prints), "print").groupBy("root").agg(F.min("least").alias("least"))
    chosen = first.select(F.col("least.body").alias("chosen"))
    left = keyed.join(chosen, F.col(body) == F.col("chosen"), "left_semi")
    place, = columns.fresh(left.columns, "place")
    left = left.withColumn(place, F.row_number().over(Window.partitionBy(body).orderBy("doc_id"))).where(F.col(place) == 1)
    return left.select(*docs.columns)
