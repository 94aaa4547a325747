r"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>[role]text</s>`` and a line feed, where ``<``, ``[``, ``]`` and ``\`` of roles and texts get a ``\`` in front, so
that no text can pass for a mark and all can be read back. For a whole slice of turns the lengths of all segments, their cumulative
offsets and the place of every byte are computed in numpy, and the bytes are scattered into one preallocated Arrow buffer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.llm import columns

OPEN, AFTER_ROLE, CLOSE = b"<s>[", b"]", b"</s>\n"
_ESCAPED = np.zeros(256, bool)
_ESCAPED[list(b"<[]\\")] = True
_TURN = re.compile(rb"<s>\[((?:[^\\\]]|\\.)*)\]((?:[^\\<]|\\.)*)</s>\n", re.DOTALL)
_BACK = re.compile(rb"\\(.)", re.DOTALL)


def _escaped_lengths(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Special bytes before each byte (and in all), and the escaped length of every value."""
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_ESCAPED[data], out=before[1:])
    return before, np.diff(offsets) + np.diff(before[offsets])


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, before: np.ndarray, begin: np.ndarray) -> None:
    """Put every value, escaped, where it begins."""
    place = np.arange(len(data)) + before[1:] + np.repeat(begin - offsets[:-1] - before[offsets[:-1]], np.diff(offsets))
    out[place] = data
    out[place[_ESCAPED[data]] - 1] = ord("\\")


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer; where each begins (one entry more), and where its text begins and ends."""
    (r, r_at), (t, t_at) = columns.flat(roles), columns.flat(texts)
    r_before, r_length = _escaped_lengths(r, r_at)
    t_before, t_length = _escaped_lengths(t, t_at)
    start = np.concatenate([[0], np.cumsum(len(OPEN) + r_length + len(AFTER_ROLE) + t_length + len(CLOSE))])
    buffer = pa.allocate_buffer(int(start[-1]), resizable=False)
    out = np.frombuffer(buffer, np.uint8)
    role = start[:-1] + len(OPEN)
    text = role + r_length + len(AFTER_ROLE)
    for mark, at in ((OPEN, start[:-1]), (AFTER_ROLE, role + r_length), (CLOSE, text + t_length)):
        for k, byte in enumerate(mark):
            out[at + k] = byte
    _scatter(out, r, r_at, r_before, role)
    _scatter(out, t, t_at, t_before, text)
    return buffer, start, text, text + t_length


def formatted(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """Pieces of formatted conversations: conv_id, piece (from 0), formatted, loss (begin and end byte of every text to learn from).

    Turns of a conversation are in the order of turn, then role and text; a long conversation is several pieces, which one task
    writes one after another without holding more than one. Null roles and texts are empty; turns without conv_id or turn are a
    conversation, or come first; repeated rows are turns each; no turns give no row.
    """
    shape = "conv_id long, piece long, formatted string, loss array<int>"
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, piece = object(), 0
        for batch in columns.slices(batches, "text"):
            buffer, start, begin, end = assemble(batch.column("role"), batch.column("text"))
            conv = batch.column("conv_id")
            ids, missing = conv.fill_null(0).to_numpy(zero_copy_only=False), conv.is_null().to_numpy(zero_copy_only=False)
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (missing[1:] != missing[:-1])
            edge = np.flatnonzero(new)
            names = conv.take(pa.array(edge)).to_pylist()
            first = piece + 1 if names[0] == last else 0
            pieces = [first, *[0] * (len(edge) - 1)]
            last, piece = names[-1], pieces[-1]
            turn = np.flatnonzero(batch.column("role").to_numpy(zero_copy_only=False) == learn_from)
            owner = np.searchsorted(edge, turn, side="right") - 1
            spans = np.stack([begin[turn], end[turn]], axis=1) - start[edge[owner]][:, None]
            counts = np.concatenate([[0], np.cumsum(2 * np.bincount(owner, minlength=len(edge)))])
            where = pa.py_buffer(np.append(start[edge], start[-1]).astype(np.int32))
            made = pa.Array.from_buffers(pa.string(), len(edge), [None, where, buffer])
            loss = pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), pa.array(spans.ravel().astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(pieces, pa.int64()), made, loss], ["conv_id", "piece", "formatted", "loss"])

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, shape)


def _plain(raw: bytes) -> bytes:
    return _BACK.sub(rb"\1", raw) if b"\\" in raw else raw


def _points(raw: bytes) -> int:
    return int(((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80).sum())


class _Digest:
    """What one conversation's output says when it is read back."""

    def __init__(self):
        self.turns, self.learnt, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, raw: bytes, loss: list[int]) -> None:
        at = 0
        for turn in _TURN.finditer(raw):
            if turn.start() != at:
                raise ValueError("the output has something other than turns")
            at = turn.end()
            self.turns.update(_plain(turn[1]) + b"\n" + _plain(turn[2]) + b"\n")
            self.n += 1
        if at != len(raw):
            raise ValueError("the output has something other than turns")
        for a, b in zip(loss[::2], loss[1::2]):
            text = _plain(raw[a:b])
            self.learnt.update(text)
            self.loss_chars += _points(text)
        self.chars += _points(raw)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.learnt.hexdigest(), self.chars


def read_back(pieces: DataFrame) -> DataFrame:
    """Per conversation, read from its formatted pieces: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The pieces come as ``formatted`` gives them: those of a conversation one after another in one partition.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for conv, piece, raw, loss in zip(*(batch.column(c) for c in ("conv_id", "piece", "formatted", "loss"))):
                if piece.as_py() == 0:
                    if digest:
                        done.append((now, *digest.row()))
                    now, digest = conv.as_py(), _Digest()
                digest.add(raw.as_buffer().to_pybytes(), loss.as_py())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(list(c)) if i else pa.array(list(c), pa.int64()) for i, c in enumerate(zip(*done))], names)
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([v]) if i else pa.array([v], pa.int64()) for i, v in enumerate((now, *digest.row()))], names)

    return pieces.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
