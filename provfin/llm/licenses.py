"""Short licence notices, exact and with a few typing errors.

Texts are lower-cased and cut into words, which are written with one blank in between. A notice with k allowed errors is split into
k + 1 parts, one of which must then stand unchanged in every approximate place (pigeonhole). One automaton finds the parts of all
notices; around each find, the regex library looks for the notice with at most k insertions, deletions and substitutions, at word
borders, and reports the span and its errors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.llm import columns

#: The phrases of the base search and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices searched for with errors: label, and how many errors are allowed.
NOTICES = {
    "gnu general public license": ("gpl", 3),
    "gnu lesser general public license": ("lgpl", 3),
    "gnu affero general public license": ("agpl", 3),
    "apache license": ("apache", 2),
    "mit license": ("mit", 1),
    "creative commons attribution": ("cc-by", 3),
    "cc by nc": ("cc-by-nc", 0),
    "cc by sa": ("cc-by-sa", 0),
    "mozilla public license": ("mpl", 2),
    "redistribution and use in source and binary forms": ("bsd", 5),
    "permission is hereby granted free of charge to any person": ("mit", 6),
}


def parts(notice: str, errors: int) -> list[tuple[str, int]]:
    """The notice in errors + 1 parts of about equal length, each with its place."""
    cut = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(notice[a:b], a) for a, b in zip(cut, cut[1:])]


class Search:
    """What a task needs: the automaton of all parts, and a pattern for every notice."""

    def __init__(self):
        import ahocorasick
        import regex

        self.notices = [(n, label, k) for n, (label, k) in NOTICES.items()]
        self.patterns = [regex.compile(rf"(?b)(?<=[ \n])(?:{regex.escape(n)}){{e<={k}}}(?=[ \n])" if k else rf"(?<=[ \n]){regex.escape(n)}(?=[ \n])") for n, _, k in self.notices]
        self.base = [(p, label, regex.compile(rf"(?<=[ \n]){regex.escape(p)}(?=[ \n])")) for p, label in PHRASES.items()]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _, k) in enumerate(self.notices):
            for part, at in parts(notice, k):
                found.setdefault(part, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for part, of in found.items():
            self.automaton.add_word(part, (len(part), of))
        self.automaton.make_automaton()

    def fuzzy(self, text: str) -> list[tuple[str, int, int, int]]:
        """Label, begin, end and errors of every notice in texts of words between blanks, best first where they overlap.

        A line feed parts two texts, and no place reaches over one. Overlapping windows of a notice are searched as one, so a place is
        told once, whichever of its parts were found.
        """
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (size, of) in self.automaton.iter(text):
            for i, at in of:
                notice, _, k = self.notices[i]
                begin = max(last + 1 - size - at - k - 1, 0)
                end = min(last + 1 - size - at + len(notice) + k + 1, len(text))
                before, after = text.rfind("\n", begin, last + 1 - size), text.find("\n", last + 1, end)
                windows.setdefault(i, []).append((begin if before < 0 else before + 1, end if after < 0 else after + 1))
        out = []
        for i, found in windows.items():
            _, label, k = self.notices[i]
            places: list[tuple[int, int]] = []
            for begin, end in sorted(found):
                if places and begin < places[-1][1]:
                    places[-1] = (places[-1][0], max(places[-1][1], end))
                else:
                    places.append((begin, end))
            while places:
                begin, end = places.pop()
                if (m := self.patterns[i].search(text, begin, end)) is not None:
                    out.append((label, m.start(), m.end(), sum(m.fuzzy_counts) if k else 0))
                    places += [(begin, m.start()), (m.end(), end)]  # what is left on either side of the best
        return out


_SEARCH: list[Search] = []


def _search() -> Search:
    if not _SEARCH:
        _SEARCH.append(Search())
    return _SEARCH[0]


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of lower-cased texts with one blank after each, a line feed before every text; where each word begins, and each text."""
    data = columns.LOWER[data]
    starts, ends, first = columns.words(data, offsets, columns.ALNUM)
    length = ends - starts
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    begin = np.cumsum(length + 1) - length - 1 + text + 1
    texts = np.arange(len(first)) + np.concatenate([[0], np.cumsum(length + 1)])[first]
    out = np.full(int(texts[-1]), 32, np.uint8)
    out[texts[:-1]] = 10
    before = np.cumsum(length) - length
    source = np.arange(int(length.sum()))
    out[source + np.repeat(begin - before, length)] = data[source + np.repeat(starts - before, length)]
    return out.tobytes(), begin, texts


FOUND = "array<struct<label:string,first_word:int,last_word:int,errors:int,exact:boolean>>"
_KIND = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int32()), ("last_word", pa.int32()), ("errors", pa.int32()), ("exact", pa.bool_())]))


def scan(data: np.ndarray, offsets: np.ndarray) -> tuple[list[list[dict]], np.ndarray]:
    """For each text its notices (exact ones of the base phrases first), with the words they cover; and how many words it has."""
    search = _search()
    raw, begin, texts = spaced(data, offsets)
    words = np.diff(np.searchsorted(begin, texts))
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    if not len(begin):
        return out, words
    # one search over the whole slice; a text's words stand between its line feed and the next
    lines = raw.decode("utf-8", "surrogateescape")
    ascii_only = len(lines) == len(raw)
    to_byte = None if ascii_only else np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
    place = (lambda p: p) if ascii_only else (lambda p: int(to_byte[p]))

    def note(label: str, a: int, b: int, errors: int, exact: bool) -> None:
        a, b = place(a), place(b)
        text = int(np.searchsorted(texts, a, side="right")) - 1
        origin = int(np.searchsorted(begin, texts[text]))
        first, last = int(np.searchsorted(begin, a)) - origin, int(np.searchsorted(begin, b)) - 1 - origin
        out[text].append({"label": label, "first_word": first, "last_word": last, "errors": errors, "exact": exact})

    for _, label, pattern in search.base:
        for m in pattern.finditer(lines):
            note(label, m.start(), m.end(), 0, True)
    for label, a, b, errors in search.fuzzy(lines):
        note(label, a, b, errors, False)
    return out, words


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and ``found``, all spans.

    first_word and last_word are the smallest and largest word at which a base phrase begins (null without one). The score is 1 with
    a base phrase, else one less the share of errors in the best span, else 0. Null texts are empty; every row is searched whole.
    """
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
    lengths = {}
    for notice, (label, _) in NOTICES.items():
        lengths[label] = min(lengths.get(label, len(notice)), len(notice))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "text"):
            found, words = scan(*columns.flat(batch.column("text")))
            base = [[x for x in f if x["exact"]] for f in found]
            starts = [[x["first_word"] for x in b] for b in base]
            best = [max((1 - x["errors"] / lengths[x["label"]] for x in f), default=0.0) for f in found]
            arrays = [
                batch.column("doc_id"), pa.array(words), pa.array([len(b) for b in base], pa.int64()),
                pa.array([min(s, default=None) for s in starts], pa.int64()), pa.array([max(s, default=None) for s in starts], pa.int64()),
                pa.array([",".join(sorted({x["label"] for x in b})) for b in base]), pa.array([",".join(sorted({x["label"] for x in f})) for f in found]),
                pa.array([1.0 if b else s for b, s in zip(base, best)], pa.float64()), pa.array(found, _KIND),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    shape = f"doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, found {FOUND}"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, shape)
