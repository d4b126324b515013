"""Main text of HTML pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks at block-level tags. A block is described by its own number of words and
link density, those of the blocks before and after, and whether it lies in an element that is meant
for the article or for what surrounds it. A decision tree grown from a small labelled table of pages
says which blocks are main text. Most of the labelled pages have no such elements and no telling
classes, so that there words and links of a block and its neighbours decide.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from gridagro.llm.common import read

TEXTS = "page_id long, url string, text string, n_chars long"

# Names of HTML, fixed values.
_SKIPPED = frozenset("script style title noscript template textarea select button svg iframe object canvas datalist audio video".split())
_RAW = frozenset("script style title textarea noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_MAIN = frozenset("article main".split())
_AROUND = frozenset("nav header footer aside form menu dialog head".split())
_AROUND_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar header footer cookie"
    " cookies notice notices consent newsletter subscribe signup login comment comments discussion replies share sharing social related recommended popup modal"
    " widget legal copyright disclaimer toolbar pagination pager adsbygoogle".split()
)
#: Words that may stand before or after such names in one class; with others (has-sidebar, no-comments) it says something else.
_BEFORE = frozenset("site page main top bottom left right global primary secondary".split())
_AFTER = frozenset("list item items box bar area block section inner links buttons posts wrapper wrap container slot unit placeholder panel banner".split())
#: Elements of the page or the article as a whole, whose classes say what else is there.
_WHOLE = frozenset("html body main article".split())
#: Elements that may be left open: those that end when one begins, up to the element that holds them.
_ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())), "dt": (frozenset("dt dd".split()), frozenset(["dl"])), "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (frozenset("td th".split()), frozenset("tr table".split())), "th": (frozenset("td th".split()), frozenset("tr table".split())),
    "tr": (frozenset("tr td th".split()), frozenset(["table"])),
}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|=)*?)(?:>|\Z)|([^<]+|<)""", re.S
)
_HUMP = re.compile("(?<=[a-z])(?=[A-Z])")
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    main: bool
    around: bool


def _is_around(names: str) -> bool:
    """Whether any of the classes, ids or roles is as a whole the name of what surrounds an article."""
    for name in names.split():
        words = [word for word in re.split(r"[^a-z]+", _HUMP.sub("-", name).lower()) if word]
        while len(words) > 1 and words[0] in _BEFORE:
            del words[0]
        while len(words) > 1 and words[-1] in _AFTER:
            del words[-1]
        if words and _AROUND_NAMES.issuperset(words):
            return True
    return False


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, white space turned into single spaces; blocks without text are left out."""
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    open_tags: list[tuple[str, bool, bool]] = []  # name, main, around
    links = skipped = main = around = 0

    def end() -> None:
        words = " ".join("".join(piece for piece, _ in parts).split())
        if words:
            linked = sum(len(piece.split()) for piece, link in parts if link)
            out.append(Block(words, len(words.split()), linked, main > 0, around > 0))
        parts.clear()

    def close(k: int) -> None:
        nonlocal main, around, skipped
        for tag, was_main, was_around in open_tags[k:]:
            main, around, skipped = main - was_main, around - was_around, skipped - (tag in _SKIPPED)
        del open_tags[k:]

    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        if m[4]:
            if not skipped:
                parts.append((html.unescape(m[4]), links > 0))
            continue
        name = (m[2] or "").lower()
        if not name:
            continue
        if name == "br":
            parts.append((" ", False))
        if name in _VOID:
            if name not in _INLINE:
                end()
            continue
        if m[1]:
            if name == "a":
                links = max(0, links - 1)
            if name not in _INLINE:
                end()
            holders = _ENDS[name][1] if name in _ENDS else ()
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == name:
                    close(k)
                    break
                if open_tags[k][0] in holders:
                    break
            continue
        if name in _RAW:
            last = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = last.end() if last else len(page)
            continue
        if name == "a":
            links += 1
        if name in _INLINE:
            continue
        end()
        if name == "option":
            continue
        if open_tags and open_tags[-1][0] == "p":
            close(len(open_tags) - 1)
        if name in _ENDS:
            ended, holders = _ENDS[name]
            first = len(open_tags)
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] in holders:
                    break
                if open_tags[k][0] in ended:
                    first = k
            close(first)
        named = " ".join(x for found in _NAMED.findall(m[3]) for x in found) if m[3] and name not in _WHOLE else ""
        is_main = name in _MAIN
        # the header of an article holds its headline, that of a page does not
        is_around = name in _AROUND and not (name == "header" and main) or _is_around(named)
        open_tags.append((name, is_main, is_around))
        main, around, skipped = main + is_main, around + is_around, skipped + (name in _SKIPPED)
    end()
    return out


FEATURES = ("words before", "links before", "words", "links", "words after", "links after", "main", "around")


def features(blocks: Sequence[Block]) -> np.ndarray:
    own = np.array([(b.words, b.link_words / b.words) for b in blocks], float).reshape(-1, 2)
    none = np.array([[0.0, 1.0]])
    before, after = np.concatenate([none, own[:-1]]), np.concatenate([own[1:], none])
    kind = np.array([(b.main, b.around) for b in blocks], float).reshape(-1, 2)
    return np.concatenate([before[: len(own)], own, after[: len(own)], kind], axis=1)


def grow(x: np.ndarray, y: np.ndarray, depth: int) -> tuple | float:
    """A classification tree by Gini impurity: (feature, threshold, below, above) or a share of 1s."""
    if depth == 0 or len(set(y)) < 2:
        return float(y.mean())
    best = (len(y) * y.mean() * (1 - y.mean()) - 1e-9, None, None)
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, k] <= cut
            cost = sum(part.sum() * y[part].mean() * (1 - y[part].mean()) for part in (low, ~low))
            if cost < best[0]:
                best = (cost, k, cut)
    _, k, cut = best
    if k is None:
        return float(y.mean())
    low = x[:, k] <= cut
    return k, float(cut), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def chosen(tree: tuple | float, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree >= 0.5)
    k, cut, below, above = tree
    return np.where(x[:, k] <= cut, chosen(below, x), chosen(above, x))


# Labelled pages: invented layouts; a block is main text if it is listed.
_P = "The river rose in the night and by morning the lower fields stood under a sheet of brown water."
_Q = "Nobody in the village could remember a spring like it, and the old bridge did not last the day."
_R = "Repairs will begin next month."
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/c">Contact us</a></li></ul>'
LABELLED_PAGES = (
    (f"<body><nav>{_MENU}</nav><article><h1>The flood</h1><p>{_P}</p><p>{_Q}</p><p>So.</p></article><footer>&copy; The Paper, all rights reserved in all countries of the world</footer></body>", (_P, _Q, "The flood", "So.")),
    (f'<body><header>The Paper, since 1901</header><div class="ad">Buy now and save on everything for your garden this week only</div><main><h2>A spring</h2><p>{_Q}</p><ul><li>One field</li><li>Two barns</li></ul></main></body>', ("A spring", _Q, "One field", "Two barns")),
    (f"<body>{_MENU}<div><p>{_P}</p><p>{_R}</p><p>{_Q}</p></div><div><a href='/1'>More from the village and its river</a></div></body>", (_P, _R, _Q)),
    (f'<body><div id="menu">{_MENU}</div><div><h1>Bridge lost</h1><p>{_Q}</p><p>{_P}</p></div><div class="comments"><p>{_R}</p><p>I was there and saw the whole thing happen from the hill above the mill.</p></div></body>', ("Bridge lost", _Q, _P)),
    (f'<body><article><p>{_P}</p><form><p>Sign up</p><p>Your address will never be given to anybody else by us</p></form><p>{_R}</p><aside><p>{_Q}</p></aside><p>Yes.</p></article></body>', (_P, _R, "Yes.")),
    (f'<body><div class="cookie-notice">We use cookies to make this page work as well as it can for all of our readers.</div><main><p>{_R}</p></main><footer><p>{_P}</p></footer></body>', (_R,)),
    (f"<body><p><a href='/a'>Home</a> <a href='/b'>News</a></p><p>{_P} {_Q}</p><p>Read <a href='/x'>the report</a> of the council, which was given to us on Monday by the mayor.</p><p><a href='/t'>Terms</a></p></body>", (f"{_P} {_Q}", "Read the report of the council, which was given to us on Monday by the mayor.")),
    (f"<body><nav><a href='/a'>Home</a></nav><article><h1>On</h1><p>Well.</p><p>It rained and <a href='/w'>the weather</a> got worse.</p></article><footer>Imprint</footer></body>", ("On", "Well.", "It rained and the weather got worse.")),
    (f'<body class="home has-sidebar"><div class="content with-header"><h1>The mill</h1><p>{_P}</p><p>{_Q}</p></div><div class="sidebar"><p>{_R}</p><p>{_Q} {_R}</p></div></body>', ("The mill", _P, _Q)),
    (f'<body id="page" class="sidebar"><article class="post no-comments"><h1>Water</h1><p>{_P}</p><p class="notice">Prices rise for all readers in the coming month, as paper has become dear.</p><p>{_Q}</p><ul><li>Three roads</li><li class="comment">I saw it too, and it was the worst that I can remember here.</li></ul></article></body>', ("Water", _P, _Q, "Three roads")),
    (f'<body><main class="content comments"><table><tr><td><p>{_P}</p></td><td class="sidebar">Books of this paper can be had at the counter on every day of the week</td></tr></table><p>{_R}</p></main></body>', (_P, _R)),
    ("<body><nav>Start of the list</nav><article><p><a href='/only'>A linked line</a></p><p>Then words.</p></article></body>", ("A linked line", "Then words.")),
)


# Layouts of plain elements: what stands above the text, the text, what stands below it.
_LONG = (_P, _Q, "The mayor said on Monday that help had been promised, but that it would not come before the harvest was in and counted.", "For three days the only way across was by boat, and the ferryman, who is over eighty, took no money from anyone.")
_ABOVE = (
    "", f"<div>{_MENU}</div>", "<div><a href='/'>Home</a> | <a href='/n'>News</a> | <a href='/s'>Sport</a></div>",
    "<div>The Paper</div><div><a href='/n'>News</a></div><div><a href='/s'>Sport</a></div>", "<div><a href='/'>The Paper, news from the valley since 1901</a></div>",
)
_BELOW = (
    "", "<div>Copyright 2020 The Paper. All rights reserved.</div>", "<div>© 2021 Valley Media</div>", "<div><a href='/i'>Imprint</a></div><div><a href='/p'>Privacy</a></div>",
    "<div>Read more</div><ul><li><a href='/1'>A bridge too old</a></li><li><a href='/2'>What the river took from us that night</a></li></ul>",
    "<div><a href='/t'>Terms of use</a> and <a href='/p'>privacy</a></div><div>Copyright 2019 by the publisher of this paper</div>",
)
_BODIES = (
    (("h1", "The flood"), ("p", _LONG[0]), ("p", _LONG[1]), ("p", _LONG[2])),
    (("h1", "A bridge is lost in the night"), ("p", _LONG[3]), ("p", "Nobody was hurt."), ("p", _LONG[2])),
    (("p", _LONG[2]), ("li", "Three roads"), ("li", "Two barns and a mill"), ("li", "One school"), ("p", _LONG[3])),
    (("h2", "Rain"), ("p", _LONG[1]), ("h3", "What comes next"), ("p", _LONG[0]), ("p", _R), ("p", _LONG[3])),
    (("h1", "Help"), ("p", "Money has been promised for the roads and for the school too."), ("p", _LONG[2])),
)


_LAST = ("So.", "It was over by nine.", "Money has been promised for the roads and for the school too.", _Q, "<a href='/w'>The weather map</a>")


def layouts() -> list[tuple[str, Sequence[str]]]:
    """Every text between everything that may stand above and below it, in ``div`` and other plain elements.

    After them articles that end in blocks of all lengths, also behind an aside and before a form of any length.
    """
    marked = [
        (f"<body><nav>{above}</nav><article><h1>The flood</h1><p>{first}</p><aside>{aside}</aside><p>{last}</p><form>{aside}</form></article><footer>{below}</footer></body>", ["The flood", first, re.sub("<[^>]*>", "", last)])
        for above in _ABOVE[1:3] for below in _BELOW[:4] for first in _LONG[2:] for aside in ("", "Sign up", "Your address will never be given to anybody else by us", _P) for last in _LAST
    ]
    return marked + [
        (f"<body>{above}<div>{''.join(f'<{tag}>{text}</{tag}>' for tag, text in body)}</div>{below}</body>", [text for _, text in body])
        for above in _ABOVE for body in _BODIES for below in _BELOW
    ]


def trained_tree(pages: Sequence[tuple[str, Sequence[str]]] | None = None, depth: int = 8) -> tuple | float:
    """The tree of labelled (html, texts of the main blocks), ``LABELLED_PAGES`` and ``layouts`` by default."""
    x, y = [], []
    for page, main in (*LABELLED_PAGES, *layouts()) if pages is None else pages:
        blocks = blocks_of(page)
        x.append(features(blocks))
        y += [float(b.text in main) for b in blocks]
    return grow(np.concatenate(x), np.array(y), depth)


def main_text(page: str | None, tree: tuple | float) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, chosen(tree, features(blocks)), strict=True) if keep)


def extract_text(pages: DataFrame, tree: tuple | float | None = None) -> DataFrame:
    """One row per page: page_id, url, text and n_chars, its code points.

    The whole html is read, however long; a null or empty one gives an empty text. Pages may be cut off anywhere.
    Other columns are left out; rows that repeat are extracted each; an empty table gives no rows.
    """
    tree = trained_tree() if tree is None else tree

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(pages["page_id"].cast("long").alias("page_id"), "url", "html").mapInArrow(extract, TEXTS)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))
