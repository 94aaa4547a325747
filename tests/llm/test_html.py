import random

import pytest

from provfin.llm import html

ARTICLE = "The house of the man was in the town and it was for all of them to see that the door had been left open by the wind."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a</p><p>b<p>c", "a\nb\nc"),
        (f"<nav><a href=x>Home</a></nav><p>{ARTICLE}</p><p>Short.</p><footer>&copy; all rights</footer>", f"{ARTICLE}\nShort."),
        (f"<div class='sidebar x'><p>{ARTICLE}</p></div><article><h1>Title</h1><p>{ARTICLE}</p><p>End</p></article>", f"Title\n{ARTICLE}\nEnd"),
        (f"<article><h1>A &amp; B</h1><p>x\n\t y&nbsp;z<br>w</p></article><section id=comments><p>{ARTICLE}</p></section>", "A & B\nx y z w"),
        ("<script>var t='</p>';if (a<b) {}</script><style>p{}</style><p>kept</p><!-- <p>gone</p> -->", "kept"),
        ("<form><label>Name</label><input value='a>b'><select><option>1</select></form><main><p>text</p></main>", "text"),
        ("<article><header><h2>Head</h2></header><p>one</p><footer>share this</footer></article>", "Head\none"),
        (f"<div><a href='1'>link one</a> <a href='2'>link two</a></div><div>{ARTICLE}</div>", ARTICLE),
        ("<article><p>see <a href='x'>this page</a></p></article>", "see this page"),
        ("<article><p>&#233;&#x4e2d;&lt;b&gt; 1 < 2", "é中<b> 1 < 2"),
        ("<article><p hidden>no</p><p>yes</p><div class=\"ad-banner\">buy</div></article>", "yes"),
        ("<p>unclosed <b>bold<p>next</article></div>end", "unclosed bold\nnext\nend"),
        (f"<p>Lead.</p><p>{ARTICLE}</p><p>{'q ' * 150}</p><p>Tail.</p>", f"Lead.\n{ARTICLE}"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


def test_labels_spread_to_the_nearest():
    plain = [None, True, None, None, False, None, None, None, True]

    def nearest(i):
        left = next((j for j in range(i, -1, -1) if plain[j] is not None), None)
        right = next((j for j in range(i, len(plain)) if plain[j] is not None), None)
        if left is None or right is None:
            return plain[right if left is None else left]
        return plain[right] if right - i <= i - left else plain[left]

    assert html.second_pass(plain) == [nearest(i) for i in range(len(plain))]
    assert html.second_pass([None, None]) == [True, True] and html.second_pass([]) == []


def plain_text(page):
    """The rules once more, block by block, over the blocks of a page: evidence as a plain sum, then the nearest label by search."""
    found = html.blocks(page)
    words = lambda t: [w.strip(".,;:!?()\"'") for w in t.lower().split()]
    share = lambda t: sum(w in html.STOP_WORDS for w in words(t)) / len(words(t))
    latin = lambda c: c <= "\u024f" or "\u1e00" <= c <= "\u1eff"
    known = any(len(b.text) >= 70 and b.linked <= 0.33 * len(b.text) and share(b.text) >= 0.16 for b in found)
    labels, away = [], []
    for b in found:
        own, letters = b.heading or b.paragraph, [c for c in b.text if c.isalpha()]
        size = len(b.text) + 2 * sum("\u3040" <= c <= "\u30ff" or "\u3400" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7af" for c in b.text)
        foreign = not known or share(b.text) < 0.08 and 2 * sum(not latin(c) for c in letters) > len(letters)
        told = size >= (70 if own or foreign else 100)
        notice = b.text.lower().startswith(("©", "(c) ", "copyright"))
        parts = [
            0.5 * own, 0.5 * told, 0.5 * (told and size >= 200), 0.5 * (told and foreign), 0.5 * (told and not foreign and share(b.text) >= 0.08),
            0.5 * (told and not foreign and share(b.text) >= 0.16), -2.5 * (told and not foreign and size >= 200 and share(b.text) == 0),
            -0.5 * (not own and not foreign and size < 200), -1.5 * (b.linked > 0.33 * len(b.text) and not (own and b.inside)), -2 * (not own and b.linked >= 0.9 * len(b.text)),
            -2 * notice, {None: 0, False: -4, True: 0.4 if own else 1.25}[b.inside],
        ]
        labels.append(None if -1 < sum(parts) < 1 else sum(parts) > 0)
        away.append(sum(parts) <= -1 and (notice or b.inside is not None))
    kept = []
    rest = [i for i in range(len(found)) if not away[i]]
    for place, i in enumerate(rest):
        near = [(abs(k - place), k < place, labels[j]) for k, j in enumerate(rest) if labels[j] is not None]
        if labels[i] if labels[i] is not None else not near or min(near)[2]:
            kept.append(found[i].text)
    return "\n".join(kept)


def test_every_given_page_follows_the_rules(spark, sf_dir):
    pages = [r.html or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    rng = random.Random(6)
    cut = [page.replace("article", rng.choice(["div", "section"])).replace('class="ad"', rng.choice(['class="x"', ""])) for page in pages]
    assert [html.main_text(p) for p in [*pages, *cut]] == [plain_text(p) for p in [*pages, *cut]]


def test_most_pages_need_no_names(spark, sf_dir):
    pages = [r.html or "" for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("html").collect()]
    assert sum(html.main_text(p) == html.main_text(p, prior=False) for p in pages) > 0.75 * len(pages)


def test_any_bytes_parse():
    rng = random.Random(1)
    parts = ["<", ">", "<p", "</p>", "<a href='", '"', "<!--", "-->", "<script>", "</script>", "&amp", "x ", "<nav>", "</nav>", "<br/>", "é", "<article class=\"", "\x00"]
    for _ in range(3000):
        html.main_text("".join(rng.choices(parts, k=rng.randint(0, 30))))
    assert html.main_text("<p>a" * 20000 + "<div>" * 20000) == "\n".join(["a"] * 20000)


def test_every_row_is_extracted(spark):
    rows = [(1, "u", None, 7), (2, None, "", 7), (None, "v", "<article><p>é</p></article>", 7), (2, None, "", 7), (3, "w", "<p>" + "of the and " * 20000 + "</p>", 7)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    found = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in html.extract(frame).collect()), key=str)
    long = ("of the and " * 20000).strip()
    assert found == sorted([(1, "u", "", 0), (2, None, "", 0), (0, "v", "é", 1), (2, None, "", 0), (3, "w", long, len(long))], key=str)
    assert html.extract(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "text",
    [
        "Дом стоял у реки, и каждое утро люди выходили к воде, чтобы посмотреть на лодки. " * 4,
        "Talo seisoi joen rannalla, ja joka aamu ihmiset tulivat katsomaan veneitä, joita vesi kantoi kohti merta. " * 3,
        "Dom stał nad rzeką i każdego ranka ludzie wychodzili nad wodę, by popatrzeć na łodzie płynące z prądem. " * 3,
        "河边有一座房子，每天早晨人们都到水边看船，孩子们在树下唱歌，老人坐在门口晒太阳。" * 6,
        "川のそばに家があり、毎朝人々は船を見に来て、子どもたちは木の下で歌いました。" * 6,
    ],
)
def test_languages_without_stop_words_keep_their_text(text):
    links = "<div><a href=1>one two three</a> <a href=2>four five six</a></div>"
    page = f"<html><body>{links}<div>{text}</div><div>{text[:90]}</div>{links}</body></html>"
    assert html.main_text(page) == f"{text.strip()}\n{text[:90].strip()}"


def test_other_scripts_on_a_page_with_english():
    text = "Дом стоял у реки, и каждое утро люди выходили к воде, чтобы посмотреть на лодки. " * 4
    assert html.main_text(f"<div>{text}</div><div>{ARTICLE}</div>") == f"{text.strip()}\n{ARTICLE}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article class='content overflow-hidden'><p>one</p></article>", "one"),
        ("<article style='overflow:hidden'><p>one</p></article>", "one"),
        ("<article aria-hidden='false' data-x='hidden' id='not-hidden'><p>one</p></article>", "one"),
        ("<article><p style='color:red; display : none'>no</p><p aria-hidden=true>no</p><p hidden=''>no</p><p>one</p></article>", "one"),
        ("<article><div class='article-header'><h1>Title</h1><p>By A</p></div><p>one</p></article>", "Title\nBy A\none"),
        ("<article><div class='entry-header tags'><div class='share'><h1>Title</h1></div></div><p>one</p><div class='share'>tell all</div></article>", "Title\none"),
        ("<article><h2><a href=x>Linked title</a></h2><p><a href=y>Linked words</a></p><ul><li><a href=z>list</a></ul><p>one</p></article>", "Linked title\nLinked words\none"),
        ("<article><p>one</p><div class='related'><h3>More</h3><p>other</p></div></article>", "one"),
    ],
)
def test_text_of_articles_stays(page, text):
    assert html.main_text(page) == text
