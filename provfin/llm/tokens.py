"""Byte-level BPE ids of whole Arrow slices: pieces are found in numpy, encoded once and remembered.

The ids are those that the tokenizers library gives with ``add_special_tokens=False`` (tests hold the two against each
other). Texts are split by the vocabulary's pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
over code points. A distinct piece is merged once, by tiktoken's merger over the merge order in the tokenizers file, as that is
ten times quicker for single pieces. With ``added``, texts are first split at the file's added tokens, which get their own ids, as
the library does it unless ``encode_special_tokens`` is set; without, their strings are ordinary text.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np

from provfin.llm import columns

#: Pieces a worker remembers (some 30 MB); when full it starts anew. The table that finds them has 2 ** TABLE_BITS places.
REMEMBERED = 500_000
TABLE_BITS = 20
#: The endings that the pattern splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
_KINDS: list[np.ndarray] = []


def _byte_letters() -> list[str]:
    """The letters by which byte-level vocabularies write the bytes 0 to 255: printable ones as they are, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(code if code in plain else next(rest)) for code in range(256)]


def _kinds() -> np.ndarray:
    """Class of every code point."""
    if not _KINDS:
        table = np.full(0x110000, _OTHER, np.uint8)
        for code in range(0x110000):
            kind = unicodedata.category(chr(code))[0]
            if kind == "L":
                table[code] = _LETTER
            elif kind == "N":
                table[code] = _NUMBER
        white = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
        table[white] = _SPACE
        _KINDS.append(table)
    return _KINDS[0]


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions of code points at which a piece begins; ``first`` has where each text begins, and the end."""
    n = len(points)
    kind = _kinds()[points]
    new = np.ones(n + 1, bool)  # a run of one class begins here
    new[1:n] = kind[1:] != kind[:-1]
    new[first] = True
    begin = new[:n].copy()
    space = kind == _SPACE
    ends_run = new[1:]
    ends_text = np.zeros(n + 1, bool)
    ends_text[first] = True
    # the last white space before other text stands for itself, or leads the next piece if it is a blank
    lead = space & ends_run & ~ends_text[1:]
    begin |= lead
    after = np.flatnonzero(lead & (points == 32)) + 1
    begin[after] = False
    # an apostrophe that begins a piece takes its ending along
    mark = np.flatnonzero(begin & (points == 39))
    if len(mark):
        left = np.searchsorted(first, mark, side="right")
        room = first[left] - mark - 1
        at = lambda k: points[np.minimum(mark + k, n - 1)]
        taken = np.zeros(len(mark), np.int64)
        for ending in ENDINGS:
            fits = (room >= len(ending)) & (taken == 0)
            for k, letter in enumerate(ending, 1):
                fits &= at(k) == ord(letter)
            taken[fits] = len(ending)
        mark, taken = mark[taken > 0], taken[taken > 0]
        begin[mark + 1] = False
        rest = mark + 1 + taken
        inside = rest < n
        begin[rest[inside]] |= kind[rest[inside]] == _LETTER
    return np.flatnonzero(begin)


class Encoder:
    """Ids of texts; one per worker."""

    def __init__(self, path: str, added: bool = False):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        tokens = whole.get("added_tokens") or [] if added else []
        if any(t.get(flag) for t in tokens for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take white space or whole words only are not supported")
        self.added = {t["content"].encode(): t["id"] for t in tokens if t["content"]}
        self.find_added = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        byte = {letter: code for code, letter in enumerate(_byte_letters())}
        ranks = {bytes(map(byte.__getitem__, x)): i for x, i in model["vocab"].items() if all(c in byte for c in x)}
        self.merge = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.clear()

    def clear(self) -> None:
        self.known = 0
        self.table_key, self.table_slot = np.zeros(1 << TABLE_BITS, np.uint64), np.full(1 << TABLE_BITS, -1, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Slots of new pieces."""
        encoded = list(map(self.merge, pieces))
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        fresh = np.fromiter(chain.from_iterable(encoded), np.uint32, int(counts.sum()))
        while self.used + len(fresh) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        at = self.known
        while at + len(pieces) > len(self.begin):
            self.begin, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.count))
        self.ids[self.used : self.used + len(fresh)] = fresh
        self.begin[at : at + len(pieces)] = self.used + np.cumsum(counts) - counts
        self.count[at : at + len(pieces)] = counts
        self.used += len(fresh)
        self.known += len(pieces)
        return np.arange(at, self.known, dtype=np.int32)

    def _slots(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of every piece: from the table, else learnt; a later piece may take the place of an earlier one in the table."""
        if self.known > REMEMBERED:
            self.clear()
        place = (keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        slot = self.table_slot[place]
        lost = np.flatnonzero((self.table_key[place] != keys) | (slot < 0))
        if len(lost):
            distinct, where, which = np.unique(keys[lost], return_index=True, return_inverse=True)
            whole = data.tobytes()
            where = lost[where]
            fresh = self._learn([whole[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
            slot[lost] = fresh[which]
            self.table_key[place[where]], self.table_slot[place[where]] = distinct, fresh
        return slot

    def _added_spans(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """Start, end and id of every added token; none reaches over the end of a text."""
        whole, out, at = data.tobytes(), [], 0
        while m := self.find_added.search(whole, at):
            if m.end() <= offsets[np.searchsorted(offsets, m.start(), side="right")]:
                out.append((m.start(), m.end(), self.added[m[0]]))
                at = m.end()
            else:
                at = m.start() + 1
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text begins (one entry more than texts)."""
        spans = self._added_spans(data, offsets) if self.find_added is not None else []
        if not spans:
            return self._encode(data, offsets)
        begin, end, ids = (np.array(x, np.int64) for x in zip(*spans))
        inside = np.zeros(len(data), bool)
        inside[np.concatenate([np.arange(a, b) for a, b, _ in spans])] = True
        gone = np.concatenate([[0], np.cumsum(inside)])  # bytes of added tokens before each byte
        texts, places = offsets - gone[offsets], begin - gone[begin]
        bounds = np.sort(np.concatenate([texts, places]))
        plain, at = self._encode(data[~inside], bounds)
        before = lambda x: at[np.searchsorted(bounds, x)]
        return np.insert(plain, before(places), ids.astype(np.uint32)), before(texts) + np.searchsorted(begin, offsets)

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without added tokens."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        whole = data.tobytes().decode("utf-8")
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        leading = (data & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(leading)])
        first = before[offsets]
        starts = piece_starts(points, first)
        ends = np.append(starts[1:], len(points))
        keys = columns.Rolling(columns.mix(points.astype(np.uint64) + np.uint64(1))).spans(starts, ends)
        byte = np.append(np.flatnonzero(leading), len(data))
        slot = self._slots(keys, data, byte[starts], byte[ends])
        counts = self.count[slot]
        total = np.concatenate([[0], np.cumsum(counts)])
        source = np.arange(total[-1]) + np.repeat(self.begin[slot] - total[:-1], counts)
        return self.ids[source], total[np.searchsorted(starts, first)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, with its added tokens; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, added=True)
    return _ENCODERS[path]
