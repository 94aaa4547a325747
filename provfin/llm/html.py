"""Main text of web pages by two-pass block rules.

A page is cut into blocks at its block elements. The first pass weighs the evidence of each block: stop-word density, length, link
density, whether it is a paragraph or heading, and, as one prior among these, what the elements around it are called. Blocks of clear
evidence are text or not; short and contradictory ones stay undecided, and the second pass gives them the label of the nearest
decided neighbours. Pages are parsed one by one, whole, in one go over their marks.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provfin.llm import columns

#: Characters below which a block is short (on its own, and outside paragraphs and headings) and from which it is long; shares of linked characters
#: and of stop words.
SHORT, SHORT_BARE, LONG, MOST_LINKED, ALL_LINKED, STOP_LOW, STOP_HIGH = 70, 100, 200, 0.33, 0.9, 0.08, 0.16
#: Evidence: of a block that is not short and of a long one; of few and many stop words, of none in a long block, and of a language they do not
#: cover; of a paragraph or heading, and of a short block that is neither; of links, and of links alone outside paragraphs and headings; of a
#: copyright line; of a paragraph or heading, and of another block, in an article, and of standing in a menu, form, advert and so on. From
#: TEXT_FROM on a block is text, up to NOT_UP_TO not.
E_SIZE, E_LONG, E_FEW, E_MANY, E_NONE, E_UNKNOWN, E_OWN, E_BARE, E_LINKED, E_LINKS, E_NOTICE, E_ARTICLE, E_INSIDE, E_ASIDE = (
    0.5, 1.0, 0.5, 1.0, -2.5, 0.5, 0.5, -0.5, -1.5, -3.5, -2.0, 0.4, 1.25, -4.0
)
TEXT_FROM, NOT_UP_TO = 1.0, -1.0
# Frequent words of four languages, elements, and words of class and id names.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on are this from an or at not have he his they which you but had were "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "de la le les et des en un une du dans est que pour qui pas sur avec par au plus ce il sont se ou ne sa "
    "el y los del las por con no su al lo como más pero sus este entre cuando muy sin sobre ser también me hasta hay".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
BARE = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("nav aside form menu button select dialog footer fieldset option label".split())
TEXT = frozenset("article main".split())
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments comentarios commentaires kommentare cookie "
    "cookies consent disclaimer disqus footer gdpr header legal links login masthead menu menus modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promoted promotion recommended related replies respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|svg|math|textarea|title|object|canvas|audio|video)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>"
    r"|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_PARTS = re.compile(r"[^a-z]+")
#: Characters that stand for some three letters: ideographs, kana, Hangul.
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
#: Copyright lines.
_NOTICE = re.compile(r"(?:©|\(c\)\s|copyright\b)", re.IGNORECASE)
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.IGNORECASE)
#: Names that inside an article rule out only blocks without a heading; header rules out nothing there.
SOFT_NAMES = frozenset("legal links notice notices share sharing tags".split())


@dataclass
class Block:
    """A block's text, how many of its characters are linked, and what its elements say (True, False or None)."""

    text: str
    linked: int
    inside: bool | None
    heading: bool = False
    paragraph: bool = False


class Soft:
    """What an element with one of SOFT_NAMES says inside an article: text if there is a heading in it."""

    def __init__(self, outer: Soft | None):
        self.outer, self.heads = outer, False


def _says(tag: str, rest: str, outer: bool | None | Soft) -> bool | None | Soft:
    """What an element says of its blocks, after what the elements around it say."""
    if outer is False or tag in NEVER:
        return False
    soft = False
    if rest:
        names: list[str] = []
        for m in _ATTRIBUTE.finditer(rest):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NOT_SHOWN.search(value):
                return outer if tag == "header" else False
            if name in ("class", "id", "role"):
                names += _PARTS.split(value.lower())
        ruled = NOT_TEXT_NAMES.intersection(names) if tag not in ("header", "body", "html") else ()
        if ruled and not (outer is None and tag in TEXT and "comment" not in names):
            if outer is None:
                return False
            ruled = ruled - {"header"}
            if ruled - SOFT_NAMES:
                return False
            soft = bool(ruled)
    if tag == "header":
        return outer  # an article's own header has its title
    if soft:
        return Soft(outer if isinstance(outer, Soft) else None)
    return True if tag in TEXT and outer is None else outer


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; blocks without text are left out."""
    out: list[Block] = []
    open_: list[tuple[str, bool | None | Soft]] = []  # elements around, with what they say
    text: list[str] = []
    linked, links, says, heading, paragraph, breaks = 0, 0, None, False, False, 0

    def close() -> None:
        nonlocal linked, heading, paragraph, breaks
        if text:
            whole = " ".join(references.unescape("".join(text)).split())
            if whole:
                out.append(Block(whole, min(linked, len(whole)), says, heading, paragraph))
                soft = says if heading and isinstance(says, Soft) else None
                while soft is not None:
                    soft.heads, soft = True, soft.outer
            text.clear()
        linked, heading, paragraph, breaks = 0, False, False, 0

    for m in _MARK.finditer(page):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                text.append(piece)
                if links:
                    linked += len(" ".join(references.unescape(piece).split()))
                if not piece.isspace():
                    breaks = 0
            continue
        tag, rest = tag.lower(), m[4]
        if m[2]:
            if tag == "a":
                links = max(links - 1, 0)
            if tag in BLOCKS:
                close()
                links = 0
                for i in range(len(open_) - 1, -1, -1):
                    if open_[i][0] == tag:
                        del open_[i:]
                        break
                says = open_[-1][1] if open_ else None
            continue
        if tag == "br":
            breaks += 1
            text.append(" ")
            if breaks > 1:
                close()
            continue
        if tag == "a":
            links += 1
        elif tag in BLOCKS:
            close()
            links = 0
            if tag == "p" or tag == "li":  # the one before ends here
                if open_ and open_[-1][0] == tag:
                    open_.pop()
            elif open_ and open_[-1][0] == "p":
                open_.pop()
            if tag not in BARE:
                outer = open_[-1][1] if open_ else None
                says = _says(tag, rest, outer)
                open_.append((tag, says))
                heading, paragraph = tag[0] == "h" and tag[1:].isdigit(), tag == "p"
    close()
    for block in out:
        soft = block.inside
        while isinstance(soft, Soft):
            block.inside, soft = soft.heads, soft.outer if soft.heads else None
    return out


def _stop_share(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / len(words)


def covered(found: list[Block]) -> bool:
    """Whether a page is in one of the languages of the stop words: some unlinked block that is not short has many."""
    return any(len(b.text) >= SHORT and b.linked <= MOST_LINKED * len(b.text) and _stop_share(b.text) >= STOP_HIGH for b in found)


def _other_script(text: str) -> bool:
    """Whether most letters are not Latin."""
    letters = [c for c in text if c.isalpha()]
    return 2 * sum(c > "\u024f" and not "\u1e00" <= c <= "\u1eff" for c in letters) > len(letters)


def evidence(block: Block, known: bool = True, prior: bool = True) -> float:
    """How much speaks for a block's being main text, below zero how much against; without ``prior`` whatever elements are around it.

    Stop words tell only in the languages they cover: on other pages (not ``known``) and in other scripts they do not count. A block too
    short to tell has only its element and its links.
    """
    own, size, text = block.heading or block.paragraph, len(block.text), block.text
    if not text.isascii():
        size += 2 * len(_WIDE.findall(text))
    share = _stop_share(text)
    covered_here = known and not (share < STOP_LOW and _other_script(text))
    out = E_OWN if own else 0.0
    if size >= (SHORT if own or not covered_here else SHORT_BARE):
        out += E_LONG if size >= LONG else E_SIZE
        if not covered_here:
            out += E_UNKNOWN
        elif share >= STOP_LOW:
            out += E_MANY if share >= STOP_HIGH else E_FEW
        elif share == 0 and size >= LONG:
            out += E_NONE
    if not own and covered_here and size < LONG:
        out += E_BARE
    if block.linked > MOST_LINKED * len(text) and not (prior and own and block.inside):  # an article's paragraph may be one link
        out += E_LINKS if not own and block.linked >= ALL_LINKED * len(text) else E_LINKED
    if _NOTICE.match(text):
        out += E_NOTICE
    if prior and block.inside is not None:
        out += E_ASIDE if not block.inside else E_ARTICLE if own else E_INSIDE
    return out


def first_pass(block: Block, known: bool = True, prior: bool = True) -> bool | None:
    """Whether a block is main text; None where its evidence does not tell."""
    weight = evidence(block, known, prior)
    return True if weight >= TEXT_FROM else False if weight <= NOT_UP_TO else None


def second_pass(labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of both nearest decided neighbours, or of the nearer one; with none at all they are text."""
    n = len(labels)
    before, after, last = [(n, None)] * n, [(n, None)] * n, None
    for places, note in ((range(n), before), (range(n - 1, -1, -1), after)):
        last = None
        for i in places:
            if labels[i] is not None:
                last = i
            elif last is not None:
                note[i] = (abs(i - last), labels[last])
    out = []
    for label, (a, left), (b, right) in zip(labels, before, after):
        if label is None:
            label = left if right is None else right if left is None or left == right else right if b <= a else left
        out.append(True if label is None else label)
    return out


def judged(page: str, prior: bool = True) -> list[tuple[Block, bool | None, bool]]:
    """Every block of a page with the label of the first pass and the final one.

    Blocks that are out in a place of their own (a menu, a form, a list of links in an article) or as a copyright line end a page's text or
    interrupt it; they say nothing of the blocks beside them, so the second pass looks past them.
    """
    found = blocks(page)
    known = covered(found)
    first = [first_pass(b, known, prior) for b in found]
    apart = [label is False and bool(prior and b.inside is not None or _NOTICE.match(b.text)) for b, label in zip(found, first)]
    spread = iter(second_pass([label for label, away in zip(first, apart) if not away]))
    return [(b, label, False if away else next(spread)) for b, label, away in zip(found, first, apart)]


def main_text(page: str, prior: bool = True) -> str:
    """The main text of a page: its blocks joined by line feeds."""
    return "\n".join(b.text for b, _, keep in judged(page, prior) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars. Null pages are empty and have an empty text; rows are taken one by one, repeated ones too.

    A page of any length is one slice of a task, which holds some 20 bytes a byte of it, more where it has many tiny blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns.slices(batches, "html"):
            texts = [main_text(p or "") for p in batch.column("html").to_pylist()]
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
