"""Benchmark decontamination: word n-grams of test items found in training texts.

The n-grams of the items, lower-cased and cut into words, form a hash set that every task holds. A task rolls a hash over the
word windows of whole slices, looks it up, and compares the bytes of each hit with the item's before it counts.

The set is broadcast in blocks of a bounded size in memory, whatever the size of the benchmark: a block is a few flat arrays, its
bytes are counted before it is filled, and long items are cut between blocks. A benchmark of one block is searched for in one pass. With
more, each block's findings, which are few, are written before the next block is built, and the documents meet them at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.session import stored
from provfin.llm import columns

#: Words of a window, bytes that a block may hold, what a word costs there beside its own bytes, and bytes of an item that are read at once.
WINDOW, BLOCK_BYTES, WORD_COST, PART_BYTES = 13, 96 << 20, 40, 4 << 20


class Items:
    """The windows of a block of items: their words one after another, and by length a sorted table of hashes with the windows' first words.

    ``rows`` has (item, text) or, for a part of an item, (item, text, words of the whole item); equal items may come several times.
    """

    def __init__(self, rows: list[tuple], window: int = WINDOW):
        known: dict[object, int] = {}
        numbers = np.array([known.setdefault(r[0], len(known)) for r in rows], np.int32)
        self.names = list(known)
        spelled, hashes, sizes, counts, held, waiting = [], [], [], [], [], 0
        for i, row in enumerate(rows):
            held.append(row[1])
            waiting += len(row[1])
            if i == len(rows) - 1 or waiting > columns.SLICE_BYTES:
                text, hashed, size, count = self._spelled(held)
                spelled.append(text)
                hashes.append(hashed)
                sizes.append(size)
                counts.append(count)
                held, waiting = [], 0
        none = np.zeros(0, np.int64)
        size, count = (np.concatenate([none, *x]) for x in (sizes, counts))
        self.text = np.concatenate([np.zeros(0, np.uint8), *spelled])
        self.at = (np.cumsum(size + 1) - size - 1).astype(np.int32)
        self.end = (self.at + size).astype(np.int32)
        first = np.concatenate([[0], np.cumsum(count)])
        whole = np.array([r[2] if len(r) > 2 else n for r, n in zip(rows, count.tolist())], np.int64)
        rolled = columns.Rolling(np.concatenate([none.astype(np.uint64), *hashes]))
        self.first_word, self.owner = first[:-1], numbers
        self.lengths = []
        size = np.minimum(whole, window)
        for n in np.unique(size[count > 0]).tolist():
            here = np.flatnonzero((size == n) & (count >= n))
            windows = count[here] - n + 1
            total = np.concatenate([[0], np.cumsum(windows)])
            at = np.arange(total[-1]) + np.repeat(first[here] - total[:-1], windows)
            key = rolled.spans(at, at + n)
            order = np.argsort(key, kind="stable")
            self.lengths.append((int(n), key[order], at[order].astype(np.int32)))
        self.spelled: dict[tuple[int, int], list[tuple[bytes, np.ndarray]]] = {}

    @staticmethod
    def _spelled(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of some texts with a blank after each, their hashes and lengths, and how many each text has."""
        data, offsets = columns.flat(pa.array(texts, pa.large_string()))
        data = columns.LOWER[data]
        starts, ends, first = columns.words(data, offsets, columns.ALNUM)
        size = ends - starts
        out = np.full(int(size.sum()) + len(size), 32, np.uint8)
        source = np.flatnonzero(columns.ALNUM[data])
        out[np.arange(len(source)) + np.repeat(np.arange(len(size)), size)] = data[source]
        return out, columns.word_hashes(data, starts, ends), size, np.diff(first)

    def item_of(self, place: np.ndarray) -> np.ndarray:
        return self.owner[np.searchsorted(self.first_word, place, side="right") - 1]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "spelled"} | {"spelled": {}}

    def phrases(self, k: int, low: int, high: int) -> list[tuple[bytes, np.ndarray]]:
        """The different windows among entries ``low`` to ``high`` of the k-th table, which have one hash, and the items of each."""
        if (k, low) not in self.spelled:
            if len(self.spelled) > 100_000:
                self.spelled.clear()
            n, _, place = self.lengths[k]
            places = place[low:high]
            by_text: dict[bytes, list[int]] = {}
            for p, item in zip(places.tolist(), self.item_of(places).tolist()):
                by_text.setdefault(self.text[self.at[p] : self.end[p + n - 1]].tobytes(), []).append(item)
            self.spelled[k, low] = [(text, np.unique(items)) for text, items in by_text.items()]
        return self.spelled[k, low]


def scan(data: np.ndarray, offsets: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[set]]:
    """Of lowered texts: starts and ends of the words, each text's first word, which words are hit, and the items found in each text."""
    starts, ends, first = columns.words(data, offsets, columns.ALNUM)
    hashes = columns.word_hashes(data, starts, ends)
    rolled = columns.Rolling(hashes)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    hits = np.zeros(len(starts) + 1, np.int64)
    found: list[set] = [set() for _ in range(len(offsets) - 1)]
    told: set[tuple[int, int, int, int]] = set()  # text, table, entry and phrase whose items have been added
    whole = None
    for k, (n, keys, _) in enumerate(items.lengths):
        if len(starts) < n:
            continue
        at = np.arange(len(starts) - n + 1)
        key = rolled.spans(at, at + n)
        # the top bits answer for nearly all windows
        gate = np.zeros(1 << 16, bool)
        gate[(keys >> np.uint64(48)).astype(np.int64)] = True
        at = at[gate[(key >> np.uint64(48)).astype(np.int64)]]
        low, high = (np.searchsorted(keys, key[at], side=side) for side in ("left", "right"))
        same = (high > low) & (owner[at] == owner[at + n - 1])
        at, low, high = at[same], low[same], high[same]
        if len(at) and whole is None:
            whole = data.tobytes()
        for i, a, b in zip(at.tolist(), low.tolist(), high.tolist()):
            seen = b" ".join([whole[x:y] for x, y in zip(starts[i : i + n].tolist(), ends[i : i + n].tolist())])
            for which, (text, who) in enumerate(items.phrases(k, a, b)):
                if text == seen:
                    hits[i] += 1
                    hits[i + n] -= 1
                    mark = (int(owner[i]), k, a, which)
                    if mark not in told:
                        told.add(mark)
                        found[owner[i]].update(items.names[j] for j in who.tolist())
    return starts, ends, first, np.cumsum(hits)[:-1] > 0, found


def _parts(item: object, text: str) -> Iterator[tuple]:
    """A text as it is, or a long one in parts that overlap by a window less a word, with the number of words of the whole."""
    raw = text.encode()
    if len(raw) <= PART_BYTES:
        yield item, text
        return
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = columns.words(data, np.array([0, len(data)]), columns.ALNUM)
    begin = 0
    while begin < len(starts):
        end = max(int(np.searchsorted(ends, starts[begin] + PART_BYTES, side="right")), min(begin + WINDOW, len(starts)))
        yield item, raw[starts[begin] : ends[end - 1]].decode(), len(starts)
        if end == len(starts):
            return
        begin = end - WINDOW + 1


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of bounded size, one at a time."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    held, size = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        for part in _parts(row[0], row[1]):
            cost = len(part[1].encode()) + WORD_COST * (part[1].count(" ") + len(part[1]) // 8 + 1)
            if held and size + cost > BLOCK_BYTES:
                yield Items(held)
                held, size = [], 0
            held.append(part)
            size += cost
    if held:
        yield Items(held)


def _runs(flags: np.ndarray, first: np.ndarray) -> list[bytes]:
    """For each text the begin and end of every run of flagged words, packed as 64-bit numbers."""
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flags[a:b].astype(np.int8), [0]])))
        out.append(edge.astype("<i8").tobytes())
    return out


def find(docs: DataFrame, benchmark: DataFrame, finish: Callable, shape) -> DataFrame:
    """What ``finish`` makes of slices of the documents (a batch with their columns, bytes of lowered text, offsets, first words,
    packed runs of hit words, and item ids as sorted strings of each text), under the schema ``shape``.

    Null texts and items have no words and hit nothing; items of fewer words than a window are one window; repeated items are
    one. A task holds one block, at most BLOCK_BYTES, and some 100 bytes a byte of the longest text.
    """
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark)
    block, following = next(blocks, Items([])), next(blocks, None)
    hits, named, body, twin, of, alike = columns.fresh(docs.columns, "hits", "hit_items", "body", "twin", "of", "alike")
    if following is None:
        sent = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in columns.slices(batches, "text"):
                data, offsets, starts, first, flags, found = _searched(batch, sent.value)
                yield finish(batch, data, offsets, starts, first, _runs(flags, first), [sorted(map(str, f)) for f in found])

        return docs.mapInArrow(run, shape)
    keyed = docs.withColumns({body: F.xxhash64("text"), twin: F.xxhash64(F.lit(7), "text")})
    plain = keyed.select(F.col(body).alias(of), F.col(twin).alias(alike), "text")
    findings = []
    while block is not None:
        sent = context.broadcast(block)
        findings.append(stored(plain.mapInArrow(_finder(sent, of, alike), f"`{of}` long, `{alike}` long, runs binary, items array<string>")))
        sent.destroy()
        block, following = following, next(blocks, None)
    # of equal texts all findings are equal, so those of a text are as many as blocks
    met = reduce(DataFrame.unionByName, findings).groupBy(of, alike).agg(F.collect_set("runs").alias(hits), F.array_distinct(F.flatten(F.collect_set("items"))).alias(named))
    own = docs.columns
    joined = keyed.join(met, (F.col(body) == F.col(of)) & (F.col(twin) == F.col(alike)), "left").select(*own, hits, named)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            data, offsets = columns.flat(batch.column("text"))
            data = columns.LOWER[data]
            starts, _, first = columns.words(data, offsets, columns.ALNUM)
            flags = np.zeros(len(starts), bool)
            for i, packed in enumerate(batch.column(hits).to_pylist()):
                for a, b in np.frombuffer(b"".join(packed or []), "<i8").reshape(-1, 2).tolist():
                    flags[first[i] + a : first[i] + b] = True
            yield finish(batch.select(own), data, offsets, starts, first, _runs(flags, first), [sorted(x or []) for x in batch.column(named).to_pylist()])

    return joined.mapInArrow(merge, shape)


def _searched(batch: pa.RecordBatch, items: Items) -> tuple:
    """Bytes of lowered text, offsets, starts of words, first words, hit words and found items of a slice."""
    data, offsets = columns.flat(batch.column("text"))
    data = columns.LOWER[data]
    starts, _, first, flags, found = scan(data, offsets, items)
    return data, offsets, starts, first, flags, found


def _finder(sent, of: str, alike: str):
    """A pass over the documents that gives the findings of one block alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            _, _, _, first, flags, found = _searched(batch, sent.value)
            hit = np.flatnonzero([bool(f) for f in found])
            if len(hit):
                runs = _runs(flags, first)
                who = pa.array(hit)
                arrays = [batch.column(of).take(who), batch.column(alike).take(who), pa.array([runs[i] for i in hit.tolist()], pa.binary()),
                          pa.array([sorted(map(str, found[i])) for i in hit.tolist()], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, [of, alike, "runs", "items"])

    return run


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (a twentieth of its words or more are hit)."""
    shape = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def finish(batch, data, offsets, starts, first, runs, ids) -> pa.RecordBatch:
        words, hit = np.diff(first), _lengths(runs)
        digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids]
        count = np.array([len(x) for x in ids], np.int64)
        arrays = [batch.column("doc_id"), *map(pa.array, (words, hit, count, digest, (hit > 0) & (20 * hit >= words)))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return find(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), benchmark, finish, shape)


def remove(docs: DataFrame, benchmark: DataFrame, whole: bool = True) -> DataFrame:
    """The documents without contamination, with the columns they came with.

    With ``whole``, contaminated documents go and the others stay as they are; without, every hit word goes with what stands
    between it and the next word, in all documents, and ``n_chars``, if there, is counted anew for changed texts.
    """

    def finish(batch, data, offsets, starts, first, runs, ids) -> pa.RecordBatch:
        if whole:
            hit = _lengths(runs)
            return batch.filter(pa.array(~((hit > 0) & (20 * hit >= np.diff(first)))))
        return cut_words(batch, columns.flat(batch.column("text"))[0], offsets, starts, first, runs)

    return find(docs, benchmark, finish, docs.schema)


def _lengths(runs: list[bytes]) -> np.ndarray:
    """Words in the packed runs of each text."""
    return np.array([int(np.diff(np.frombuffer(x, "<i8").reshape(-1, 2), axis=1).sum()) for x in runs], np.int64)


def cut_words(batch: pa.RecordBatch, data, offsets, starts, first, packed: list[bytes | None]) -> pa.RecordBatch:
    """A batch whose texts lack the packed runs of words, each with what stands before the next word."""
    if not any(packed):
        return batch
    texts, raw = batch.column("text").to_pylist(), data.tobytes()
    changed = {}
    for i, runs in enumerate(packed):
        if not runs:
            continue
        at, out = int(offsets[i]), []
        end = int(offsets[i + 1])
        for a, b in np.frombuffer(runs, "<i8").reshape(-1, 2).tolist():
            out.append(raw[at : starts[first[i] + a]])
            at = int(starts[first[i] + b]) if first[i] + b < first[i + 1] else end
        changed[i] = (b"".join(out) + raw[at:end]).decode()
    texts = [changed.get(i, t) for i, t in enumerate(texts)]
    new = {"text": pa.array(texts, batch.schema.field("text").type)}
    if "n_chars" in batch.schema.names:
        old = batch.column("n_chars").to_pylist()
        new["n_chars"] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(old)], batch.schema.field("n_chars").type)
    return pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], schema=batch.schema)
