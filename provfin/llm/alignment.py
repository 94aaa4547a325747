"""Cross-tokenizer alignment: which ids of two vocabularies stand for the same bytes, counted over the whole corpus.

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). Byte offsets where tokens of both end cut it into
groups; within a group every A token is linked to every B token. A pair of ids counts the documents that hold it linked.

1. A task encodes slices of texts and gathers the (pair, document, links) records of some megabytes of text, a run. A run is sorted
   side-major (all pairs of an A id together), radix-partitioned by A id, and each part is written as one zstd block. Next to it stand
   the documents' own figures, and, summed over the whole task, the number of documents of each pair.
2. Only those sums are shuffled to be counted: a k-way merge on a heap adds the sums of all tasks up, part by part, and the
   side-major order yields the highest count of each A id on the way. Whatever is hot has been summed up before.
3. The zstd blocks meet the counts of their part, each part in several shares so that a hot one is no task's burden alone, and give
   what each document of a run gets from that part. These contributions are added to the documents' figures run by run.

Texts are never shuffled, documents are known by their place in a run, and no task holds more than a run, a part's counts, or a
block of each merged run.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.functions.session import stored
from provfin.llm import columns
from provfin.llm.tokens import Encoder, _byte_letters

#: Parts of the pair space; text bytes, links and documents from which on a run is closed; runs that are merged at once; entries of a block.
PARTS, RUN_BYTES, RUN_LINKS, RUN_DOCS, FAN_IN, BLOCK = 64, 4 << 20, 4_000_000, 60_000, 32, 1 << 15
#: Links of a group that are listed one by one; larger groups are counted by their distinct ids.
PLAIN_LINKS = 64
_SPACE = 32


class ByteSide(Encoder):
    """Side A: a byte-level vocabulary without added tokens, and the bytes of every id."""

    def __init__(self, path: str):
        super().__init__(path, added=False)
        with open(path, encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        letters = set(_byte_letters())
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token) if letters.issuperset(token) else 0


class PieceSide(Encoder):
    """Side B: a sentencepiece vocabulary, applied to chunks that begin at a blank after another character.

    A piece has its blanks in front, so merges never reach over such a place and chunks give the ids of the whole text (checked for
    the vocabulary when it is loaded). A distinct chunk is encoded once and remembered.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("vocabularies with blanks inside pieces are not supported")
        self.spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.width = np.array([len(x) for x in self.spelled], np.int64)
        self.encode_chunk, self.blank = model.encode, [model.piece_to_id("▁")]
        self.find_added = None
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.wrong = np.zeros(1 << 14, bool)

    def merge(self, chunk: bytes) -> list[int]:
        return self.encode_chunk(chunk[1:].decode()) if len(chunk) > 1 else self.blank  # the library puts the blank in front of what is not empty

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        slots = super()._learn(pieces)
        while len(self.wrong) < len(self.begin):
            self.wrong = np.concatenate([self.wrong, np.zeros_like(self.wrong)])
        for slot, piece in zip(slots.tolist(), pieces):
            a = self.begin[slot]
            self.wrong[slot] = b"".join([self.spelled[i] for i in self.ids[a : a + self.count[slot]].tolist()]) != piece
        return slots

    def encode_checked(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, where each text begins, and whether a text's tokens spell it. Every text begins with a blank."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64), np.ones(len(offsets) - 1, bool)
        blank = data == _SPACE
        begin = blank.copy()
        begin[1:] &= ~blank[:-1]
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(data))
        keys = columns.word_hashes(data, starts, ends)
        slot = self._slots(keys, data, starts, ends)
        counts = self.count[slot]
        total = np.concatenate([[0], np.cumsum(counts)])
        source = np.arange(total[-1]) + np.repeat(self.begin[slot] - total[:-1], counts)
        first = np.searchsorted(starts, offsets)
        wrong = np.concatenate([[0], np.cumsum(self.wrong[slot])])
        return self.ids[source], total[first], wrong[first[1:]] == wrong[first[:-1]]


_SIDES: dict[tuple[str, str], tuple[ByteSide, PieceSide]] = {}


def sides(a_path: str, b_path: str) -> tuple[ByteSide, PieceSide]:
    """The worker's two encoders; they live as long as the worker."""
    key = (a_path, b_path)
    if key not in _SIDES:
        _SIDES[key] = ByteSide(a_path), PieceSide(b_path)
    return _SIDES[key]


def spaced(data: np.ndarray, offsets: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept texts with a blank in front of each; the others are empty."""
    size = np.diff(offsets)
    where = np.concatenate([[0], np.cumsum(np.where(keep, size + 1, 0))])
    out = np.full(where[-1], _SPACE, np.uint8)
    inside = np.repeat(keep, size)
    source = np.flatnonzero(inside)
    out[source + np.repeat(where[:-1] + 1 - offsets[:-1], np.where(keep, size, 0))] = data[source]
    return out, where


class Aligned:
    """The tokens and groups of a slice: ids ``a`` and ``b``, each text's first token of either (``a_at``, ``b_at``), the group of every
    token, whether a token ends its group, and each text's first group."""

    def __init__(self, column: pa.Array, a_side: ByteSide, b_side: PieceSide):
        data, offsets = columns.flat(column)
        keep = np.diff(offsets) > 0
        whole, where = spaced(data, offsets, keep)
        self.b, self.b_at, same = b_side.encode_checked(whole, where)
        if not same.all():
            keep &= same
            whole, where = spaced(data, offsets, keep)
            self.b, self.b_at, _ = b_side.encode_checked(whole, where)
        self.a, self.a_at = a_side.encode(whole, where)
        a_end, b_end = np.cumsum(a_side.width[self.a]), np.cumsum(b_side.width[self.b])
        if len(a_end) != 0 and a_end[-1] != b_end[-1]:
            raise ValueError("tokens do not spell the texts")
        near = lambda x, y: y[np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))] == x if len(y) else np.zeros(len(x), bool)
        self.a_last, self.b_last = near(a_end, b_end), near(b_end, a_end)
        before = np.concatenate([[0], np.cumsum(self.a_last)])
        self.a_group = before[:-1]
        self.b_group = np.cumsum(self.b_last) - self.b_last
        self.group_at = before[self.a_at]
        groups = int(before[-1])
        self.a_size, self.b_size = np.bincount(self.a_group, minlength=groups), np.bincount(self.b_group, minlength=groups)

    def links(self) -> np.ndarray:
        """Links of every text."""
        total = np.concatenate([[0], np.cumsum(self.a_size * self.b_size)])
        return np.diff(total[self.group_at])

    def spelled(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text: ids of either side in order, group by group."""
        n = len(self.a) + len(self.b)
        a_place = np.arange(len(self.a)) + (np.cumsum(self.b_size) - self.b_size)[self.a_group]
        b_place = np.arange(len(self.b)) + np.cumsum(self.a_size)[self.b_group]
        ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[a_place], ids[b_place] = self.a, self.b
        mark[a_place[self.a_last]], mark[b_place[self.b_last]] = ord("|"), ord(";")
        digits, width = _decimals(int(ids.max(initial=0)))
        size = width[ids]
        cells = digits[ids]
        cells[np.arange(n), size] = mark
        text = cells[np.arange(cells.shape[1]) <= size[:, None]].tobytes()
        end = np.concatenate([[0], np.cumsum(size + 1)])[self.a_at + self.b_at].tolist()
        return [text[x : max(y - 1, x)] for x, y in zip(end, end[1:])]

    def pairs(self, b_ids: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Text, pair (``rank`` of the A id times ``b_ids`` plus the B id) and number of links (None: one each); a pair may come several times."""
        owner = np.repeat(np.arange(len(self.group_at) - 1), np.diff(self.group_at))
        links = self.a_size * self.b_size
        plain = links <= PLAIN_LINKS
        at = np.flatnonzero(plain[self.a_group])
        group = self.a_group[at]
        times = self.b_size[group]
        total = np.concatenate([[0], np.cumsum(times)])
        b_first = np.cumsum(self.b_size) - self.b_size
        other = np.arange(total[-1]) + np.repeat(b_first[group] - total[:-1], times)
        text = np.repeat(owner[group], times)
        pair = np.repeat(rank[self.a[at]] * b_ids, times) + self.b[other]
        large = np.flatnonzero(~plain)
        if not len(large):
            return text, pair, None
        a_first = np.cumsum(self.a_size) - self.a_size
        texts, pairs, counts = [text], [pair], [np.ones(len(pair), np.int64)]
        for g in large.tolist():
            x, nx = np.unique(rank[self.a[a_first[g] : a_first[g] + self.a_size[g]]], return_counts=True)
            y, ny = np.unique(self.b[b_first[g] : b_first[g] + self.b_size[g]], return_counts=True)
            pairs.append((x[:, None] * b_ids + y).ravel())
            counts.append((nx[:, None] * ny).ravel())
            texts.append(np.full(len(pairs[-1]), owner[g]))
        return np.concatenate(texts), np.concatenate(pairs), np.concatenate(counts)


_DECIMALS: list[tuple[np.ndarray, np.ndarray]] = []


def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers up to ``most`` or more, left-aligned with room for a mark, and how many there are."""
    if not _DECIMALS or len(_DECIMALS[0][1]) <= most:
        top = 10 ** max(5, len(str(most)))
        width = len(str(top - 1))
        number = np.arange(top)
        size = np.ones(top, np.int64)
        for k in range(1, width):
            size += number >= 10**k
        digits = np.zeros((top, width + 1), np.uint8)
        for k in range(width):
            inside = size > k
            digits[inside, k] = 48 + number[inside] // 10 ** (size[inside] - 1 - k) % 10
        _DECIMALS[:] = [(digits, size)]
    return _DECIMALS[0]


def side_major(a_ids: int) -> np.ndarray:
    """Rank of every A id such that part ``p`` of PARTS is a range of ranks; frequent ids, which are the small ones, are dealt out."""
    i = np.arange(a_ids, dtype=np.int64)
    return i % PARTS * -(-a_ids // PARTS) + i // PARTS


def _edges(a_ids: int, b_ids: int) -> np.ndarray:
    """First pair of every part, and the end."""
    return np.arange(PARTS + 1, dtype=np.int64) * (-(-a_ids // PARTS) * b_ids)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one zstd block: their lengths, kinds and bytes."""
    import zstandard

    head = b"".join(len(x).to_bytes(4, "little") + x.dtype.str.encode().ljust(4) for x in arrays)
    return zstandard.ZstdCompressor(level=1).compress(len(arrays).to_bytes(4, "little") + head + b"".join(x.tobytes() for x in arrays))


def _unpacked(block: bytes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(block)
    count, out = int.from_bytes(raw[:4], "little"), []
    at = 4 + 8 * count
    for k in range(count):
        n, kind = int.from_bytes(raw[4 + 8 * k : 8 + 8 * k], "little"), np.dtype(raw[8 + 8 * k : 12 + 8 * k].decode().strip())
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * kind.itemsize
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need."""
    top = int(x.max(initial=0))
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def _steps(x: np.ndarray) -> np.ndarray:
    return _small(np.diff(x, prepend=0))


def written(keys: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """A sorted run of keys with counts, as zstd blocks."""
    return [_packed(_steps(keys[i : i + BLOCK]), _small(counts[i : i + BLOCK])) for i in range(0, len(keys), BLOCK)]


def read(blocks: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for block in blocks:
        steps, counts = _unpacked(block)
        yield np.cumsum(steps.astype(np.int64)), counts.astype(np.int64)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], np.add.reduceat(counts, edge) if len(edge) else counts


def merged(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """K-way merge of sorted runs that come in blocks; equal keys are added up. Holds one block of each run.

    The heap has the last key of each run's open block. Nothing below the smallest of them can come any more, so all open blocks
    are consumed up to it at once.
    """
    now, heap = {}, []

    def advance(i: int) -> None:
        block = next(runs[i], None)
        if block is None:
            now.pop(i, None)
        else:
            now[i] = block
            heapq.heappush(heap, (int(block[0][-1]), i))

    for i in range(len(runs)):
        advance(i)
    while heap:
        cut, parts = heap[0][0], []
        for i, (keys, counts) in now.items():
            n = int(np.searchsorted(keys, cut, side="right"))
            if n:
                parts.append((keys[:n], counts[:n]))
                now[i] = keys[n:], counts[n:]
        while heap and heap[0][0] <= cut:
            advance(heapq.heappop(heap)[1])
        yield _summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


class Sums:
    """Counts by pair that grow run by run: zstd runs, merged on a heap whenever there are FAN_IN of them."""

    def __init__(self):
        self.runs: list[list[bytes]] = []

    def add(self, blocks: list[bytes]) -> None:
        self.runs.append(blocks)
        if len(self.runs) >= FAN_IN:
            self.runs = [[x for keys, counts in self.blocks() for x in written(keys, counts)]]

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return merged([read(run) for run in self.runs])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        found = list(self.blocks())
        none = np.zeros(0, np.int64)
        return (np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])) if found else (none, none)


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_ENCODED = "kind string, run long, part int, blocks array<binary>, doc_id array<long>, digest array<string>, " + ", ".join(f"{c} array<long>" for c in _FIGURES)
_ENCODED_ARROW = pa.schema([("kind", pa.string()), ("run", pa.int64()), ("part", pa.int32()), ("blocks", pa.list_(pa.binary())), ("doc_id", pa.list_(pa.int64())), ("digest", pa.list_(pa.string()))]
                           + [(c, pa.list_(pa.int64())) for c in _FIGURES])


class Run:
    """The open run of a task: figures and links of its documents."""

    def __init__(self, number: int):
        self.number, self.bytes, self.links = number, 0, 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray | None] = []
        self.docs: dict[str, list] = {c: [] for c in ("doc_id", "digest", *_FIGURES)}

    def full(self, rows: int) -> bool:
        return self.bytes >= RUN_BYTES or self.links >= RUN_LINKS or len(self.docs["doc_id"]) + rows > RUN_DOCS

    def add(self, batch: pa.RecordBatch, made: Aligned, b_ids: int, rank: np.ndarray) -> None:
        text, pair, count = made.pairs(b_ids, rank)
        self.keys.append(pair << 16 | (text + len(self.docs["doc_id"])))
        self.counts.append(count)
        self.bytes += batch.column("text").nbytes
        self.links += len(pair)
        self.docs["doc_id"] += batch.column("doc_id").to_pylist()
        self.docs["digest"] += [hashlib.sha256(x).hexdigest() if x else "" for x in made.spelled()]
        for name, figure in zip(_FIGURES, (np.diff(made.a_at), np.diff(made.b_at), np.diff(made.group_at), made.links())):
            self.docs[name] += figure.tolist()

    def close(self, edges: np.ndarray, sums: Sums) -> Iterator[dict]:
        """The run's rows: its documents, and a block of records for every part that has some. Adds its counts to the task's."""
        yield {"kind": "docs", "run": self.number, **self.docs}
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        if not len(keys):
            return
        if all(c is None for c in self.counts):
            keys, count = np.unique(keys, return_counts=True)
        else:
            keys, count = _summed(keys, np.concatenate([np.ones(len(k), np.int64) if c is None else c for k, c in zip(self.keys, self.counts)]))
        pair, doc = keys >> 16, keys & 0xFFFF
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        holders = np.diff(np.append(first, len(pair)))
        distinct = pair[first]
        sums.add(written(distinct, holders))
        cut = np.searchsorted(distinct, edges)
        at = np.append(first, len(pair))[cut].tolist()
        for part, (x, y) in enumerate(zip(cut.tolist(), cut[1:].tolist())):
            if x < y:
                i, j = at[part], at[part + 1]
                block = _packed(_steps(distinct[x:y]), _small(holders[x:y]), doc[i:j].astype("<u2"), _small(count[i:j]))
                yield {"kind": "records", "run": self.number, "part": part, "blocks": [block]}


def encoded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of three kinds: the documents of a run, the records of a run's part, and a task's counts of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(a_path, b_path)
        a_ids, b_ids = len(a_side.width), len(b_side.width)
        rank, edges, sums = side_major(a_ids), _edges(a_ids, b_ids), Sums()
        number = TaskContext.get().partitionId() << 32
        now = Run(number)
        for batch in columns.slices(batches, "text"):
            if now.full(batch.num_rows):
                yield pa.RecordBatch.from_pylist(list(now.close(edges, sums)), _ENCODED_ARROW)
                now = Run(now.number + 1)
            now.add(batch, Aligned(batch.column("text"), a_side, b_side), b_ids, rank)
        if now.docs["doc_id"]:
            yield pa.RecordBatch.from_pylist(list(now.close(edges, sums)), _ENCODED_ARROW)
        rows: dict[int, list[bytes]] = {}
        for keys, counts in sums.blocks():
            cut = np.searchsorted(keys, edges).tolist()
            for part in range(PARTS):
                if cut[part] < cut[part + 1]:
                    rows.setdefault(part, []).extend(written(keys[cut[part] : cut[part + 1]], counts[cut[part] : cut[part + 1]]))
        if rows:
            yield pa.RecordBatch.from_pylist([{"kind": "counts", "run": number, "part": p, "blocks": x} for p, x in rows.items()], _ENCODED_ARROW)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, _ENCODED)


def counted(parts: DataFrame, b_path: str) -> DataFrame:
    """part, table: the counts of all pairs of a part, with the highest of each A id, as one zstd block. Bounded by the pairs of the two vocabularies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b_ids, part, sums = _b_ids(b_path), None, Sums()

        def table() -> pa.RecordBatch:
            keys, counts = sums.whole()
            side = keys // b_ids
            first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
            top = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(keys))))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([_packed(_steps(keys), _small(counts), (counts == top).astype("<u1"))], pa.binary())], ["part", "table"])

        for batch in batches:
            for p, blocks in zip(batch.column("part").to_pylist(), batch.column("blocks").to_pylist()):
                if p != part:
                    if part is not None:
                        yield table()
                    part, sums = p, Sums()
                sums.add(blocks)
        if part is not None:
            yield table()

    return parts.select("part", "blocks").repartition(PARTS, "part").sortWithinPartitions("part").mapInArrow(run, "part int, table binary")


def _b_ids(b_path: str) -> int:
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=b_path).vocab_size()


def contributions(records: DataFrame, tables: DataFrame, shares: int) -> DataFrame:
    """run, blocks: what the documents of a run get from one part, the links with the highest count of their A id and the sum of counts over links.

    A part's records are dealt to ``shares`` tasks by run, and its counts go to each of them.
    """
    share = F.pmod(F.xxhash64("run"), F.lit(shares)).cast("int")
    left = records.select("part", share.alias("share"), F.lit(1).alias("rank"), "run", F.col("blocks")[0].alias("block"))
    right = tables.select("part", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("rank"), F.lit(None).cast("long").alias("run"), F.col("table").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = counts = best = None
        for batch in batches:
            out = []
            for rank, number, block in zip(*(batch.column(c).to_pylist() for c in ("rank", "run", "block"))):
                if rank == 0:
                    steps, counts, best = _unpacked(block)
                    keys, counts, best = np.cumsum(steps.astype(np.int64)), counts.astype(np.int64), best.astype(np.int64)
                    continue
                steps, holders, doc, links = _unpacked(block)
                at = np.repeat(np.searchsorted(keys, np.cumsum(steps.astype(np.int64))), holders)
                links = links.astype(np.int64)
                add = lambda x: np.bincount(doc, x).astype(np.int64)  # noqa: E731  doubles, exact below 2 ** 53
                out.append((number, [_packed(_small(add(links * best[at])), _small(add(links * counts[at])))]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([b for _, b in out], pa.list_(pa.binary()))], ["run", "blocks"])

    dealt = left.unionByName(right).repartition("part", "share").sortWithinPartitions("part", "share", "rank")
    return dealt.mapInArrow(run, "run long, blocks array<binary>")


def report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best has the links whose pair has the highest count of its A id (ties included), count_sum the counts over all links.
    Null and empty texts, and texts that the tokens of B do not spell, have no tokens: zeros and an empty digest. Every row is a
    document of its own, repeated rows and null ids too; an empty table gives no row; other columns do not matter. A text of any
    length is one slice of a task, which holds some 150 bytes a byte of it, and its distinct linked pairs.
    """
    spark = docs.sparkSession
    found = stored(encoded(docs, a_path, b_path))
    kind = lambda x: found.where(F.col("kind") == x)
    shares = max(-(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTS), 2)
    added = contributions(kind("records"), counted(kind("counts"), b_path), shares)
    names = ["doc_id", *_FIGURES, "digest"]
    empty = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in names]
    both = kind("docs").select("run", F.lit(0).alias("rank"), *names, "blocks").unionByName(added.select("run", F.lit(1).alias("rank"), *empty, "blocks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def row() -> pa.RecordBatch:
            *figures, digest = own
            arrays = [pa.array(x, pa.int64()) for x in figures] + [pa.array(best), pa.array(total), pa.array(digest, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"])

        for batch in batches:
            for i, rank in enumerate(batch.column("rank").to_pylist()):
                if rank == 0:
                    if own is not None:
                        yield row()
                    own = [batch.column(c)[i].as_py() for c in names]
                    best, total = np.zeros(len(own[0]), np.int64), np.zeros(len(own[0]), np.int64)
                else:
                    for into, x in zip((best, total), _unpacked(batch.column("blocks")[i].as_py()[0])):
                        into[: len(x)] += x.astype(np.int64)
        if own is not None:
            yield row()

    shape = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return both.repartition("run").sortWithinPartitions("run", "rank").mapInArrow(run, shape)


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The alignment itself: doc_id and, for every row, the ids of each group in order (arrays of ``a`` and ``b``)."""
    shape = "doc_id long, groups array<struct<a: array<int>, b: array<int>>>"
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(a_path, b_path)
        for batch in columns.slices(batches, "text"):
            made = Aligned(batch.column("text"), a_side, b_side)
            nested = lambda ids, size: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(ids.astype(np.int32)))
            cells = pa.StructArray.from_arrays([nested(made.a, made.a_size), nested(made.b, made.b_size)], ["a", "b"])
            arrays = [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(made.group_at.astype(np.int32)), cells).cast(kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, shape)


def pairs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The dictionary that the corpus gives: a, b, documents (that hold the pair linked), best (whether no pair of this A id has more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = sides(a_path, b_path)
        rank, b_ids = side_major(len(a_side.width)), len(b_side.width)
        by_rank = np.zeros(int(rank.max()) + 1, np.int64)
        by_rank[rank] = np.arange(len(rank))
        for batch in batches:
            for block in batch.column("table").to_pylist():
                steps, counts, best = _unpacked(block)
                keys = np.cumsum(steps.astype(np.int64))
                arrays = [by_rank[keys // b_ids].astype(np.int32), (keys % b_ids).astype(np.int32), counts.astype(np.int64), best.astype(bool)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["a", "b", "documents", "best"])

    tables = counted(encoded(docs, a_path, b_path).where("kind = 'counts'"), b_path)
    return tables.mapInArrow(run, "a int, b int, documents long, best boolean")
