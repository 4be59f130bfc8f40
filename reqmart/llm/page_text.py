"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at its block elements into flat blocks of text. Each has a word count and a link density (share of its
words in links), which together with those of its neighbours and with what the nearest elements say of themselves (their
names, classes and ids) are the features of a decision tree. The tree is grown from the small table of labelled blocks
below, when the operator is called; the blocks it takes for article text, in page order, are the page's text. Names are
weak or strong: a long text without links in an element of a weak name ("market-share") is the article's.

What encloses an article doesn't make it boilerplate, whatever its name ("layout-sidebar"): within <main> and <article>
only the elements from there on count. Articles in an element of another kind (<aside>), within another article, or
deeper in such names than others of the page are left to their names: they are comments and cards of other articles.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Elements whose content is never text, elements that end a block, and the words by which elements name
# themselves.
WITHOUT_TEXT = "script style noscript template svg math iframe object canvas audio video head select textarea button".split()
BLOCK_ELEMENTS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul"
).split()
CONTAINERS = (
    "article aside body center details dialog div dl fieldset figure footer form header hgroup html li main menu nav ol "
    "section span table tbody td th tr ul"
).split()
BOILERPLATE_ELEMENTS = "aside dialog footer form header menu nav".split()
ARTICLE_ELEMENTS = "article main".split()
#: An article in one of these isn't the page's.
OTHER_ELEMENTS = "aside dialog footer header menu nav".split()
ARTICLE_WORDS = "article content entry main post prose story".split()
BOILERPLATE_WORDS = (
    "ad ads adsense advert advertisement adverts alert banner breadcrumb breadcrumbs byline comment commentlist comments "
    "consent cookie cookies copyright disclaimer discussion disqus foot footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notification pagination popup promo promotion recommended related replies reply respond "
    "search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar trending widget"
).split()
#: Of those, the ones that are ordinary words of other names, too.
WEAK_WORDS = (
    "alert banner copyright disclaimer discussion header menu notice notification promotion related replies reply respond "
    "search share sharing social subscribe tags trending"
).split()
#: "has-sidebar" says what an element holds, not what it is.
HOLDING_WORDS = "has no with without".split()
#: The id of a section within an article may be its heading: these words are ordinary headings.
HEADING_WORDS = "copyright disclaimer discussion navigation notice promotion search sharing".split()
#: First words of the names of articles that aren't the page's.
OTHER_ARTICLES = "ad ads advert advertisement comment comments promo recommended related reply sponsored".split()

#: Comments, elements without text up to their end, and single tags. Quoted values may hold ">" but not "<".
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<raw>{'|'.join(WITHOUT_TEXT)})(?=[\s/>])(?:[^>\"']++|\"[^\"<]*+\"|[\"'])*+>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|(?=<)|\Z)",
    re.IGNORECASE | re.DOTALL,
)
RAW_END = {name: re.compile(rf"</{name}\s*>|</{name}(?=[\s/])[^>]*>", re.IGNORECASE) for name in WITHOUT_TEXT}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

BLOCKS, STARTS, BOILERPLATE = map(frozenset, (BLOCK_ELEMENTS, CONTAINERS, BOILERPLATE_WORDS))
ARTICLE = frozenset(ARTICLE_WORDS)
HEADINGS = BOILERPLATE - frozenset(HEADING_WORDS)
STRONG = BOILERPLATE - frozenset(WEAK_WORDS)
FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "in_article", "page_has_article", "boilerplate_name",
]


@dataclass
class Block:
    text: str
    offset: int
    linked_words: int
    in_article: bool
    boilerplate_name: int = 0


@dataclass
class Place:
    """An <article> or <main>: how many names around it are boilerplate's, and whether those count for it."""

    is_main: bool
    others: int
    strong: int
    outer: Place | None
    may_be_main_text: bool
    starts_anew: bool = False


@dataclass
class Open:
    """An open element: whether it is in an article, and how many elements, itself included, are boilerplate by name, and
    by a strong one.
    """

    name: str = ""
    in_article: bool = False
    others: int = 0
    strong: int = 0
    in_other_element: bool = False
    place: Place | None = None


def name_parts(rest: str) -> Iterator[tuple[bool, list[str]]]:
    """The words of each name that an element gives itself, and whether it is its id."""
    for m in NAMES.finditer(rest) if "=" in rest else ():
        for name in (m[1] or m[2] or m[3] or "").split():
            yield m[0][:2].lower() == "id", [part.lower() for part in NAME_PARTS.findall(name)]


def names_itself(tag: str, rest: str, within_article: bool = False) -> tuple[bool, int]:
    """Whether an element calls itself an article, and how clearly something else: 0 not, 1 by a weak name, 2."""
    if tag in BOILERPLATE_ELEMENTS or tag in ARTICLE_ELEMENTS:
        return tag in ARTICLE_ELEMENTS, 2 * (tag in BOILERPLATE_ELEMENTS)
    if tag in ("body", "html") or "=" not in rest:
        return False, 0
    names = [(is_id, parts) for is_id, parts in name_parts(rest) if parts and parts[0] not in HOLDING_WORDS]
    is_section = within_article and (tag == "section" or any(parts == ["section"] for _, parts in names))
    article = any(not ARTICLE.isdisjoint(parts) for _, parts in names)
    told = {p for is_id, parts in names for p in parts if p in (HEADINGS if is_id and is_section else BOILERPLATE)}
    # A single weak word is the whole name ("share"); within a longer one it may be anything ("market-share").
    whole = any(len(parts) == 1 and parts[0] in told for _, parts in names)
    return article, 2 if whole or not STRONG.isdisjoint(told) else int(bool(told) and not article)


def opened(name: str, rest: str, outer: Open) -> Open:
    article, other = names_itself(name, rest, outer.place is not None)
    others, strong, place = outer.others + (other > 0), outer.strong + (other == 2), outer.place
    if name == "main" or name == "article" and (place is None or place.is_main):
        others_article = any(parts and parts[0] in OTHER_ARTICLES for _, parts in name_parts(rest))
        place = Place(name == "main", others, strong, place, not outer.in_other_element and not others_article)
    in_other = outer.in_other_element or name in OTHER_ELEMENTS
    return Open(name, outer.in_article or article, others, strong, in_other, place)


def settle(places: list[Place]) -> None:
    """Find the places around which names don't count: <main>, and of the articles those with fewest such names.

    Several articles in one such element within <main> are cards, a single one is the page's.
    """
    for p in places:
        p.starts_anew = p.is_main and p.may_be_main_text
    articles = [p for p in places if not p.is_main and p.may_be_main_text]
    least = min((p.others for p in articles), default=0)
    first = [p for p in articles if p.others == least]
    for p in first:
        p.starts_anew = len(first) == 1 or p.outer is None or p.others == p.outer.others


def boilerplate_name(inner: Open) -> int:
    """How clearly the elements from the page's article on are named otherwise: 0 not, 1 by weak names, 2."""
    place = inner.place
    while place is not None and not place.starts_anew:
        place = place.outer
    others, strong = (place.others, place.strong) if place else (0, 0)
    return 2 if inner.strong > strong else int(inner.others > others)


def blocks_of(page: str) -> list[Block]:
    """Flat blocks of the page in order; a tag that is never closed ends with what encloses it."""
    blocks: list[Block] = []
    open_tags = [Open()]
    places: list[Place] = []
    around: list[Open] = []  # the innermost element of each block
    text: list[str] = []
    linked: list[str] = []
    in_link, start, at = False, 0, 0
    paragraph: Open | None = None  # a named block element that holds no others

    def finish() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            n_linked = len(html.unescape("".join(linked)).split())
            around.append(paragraph or open_tags[-1])
            blocks.append(Block(" ".join(words), start, min(n_linked, len(words)), open_tags[-1].in_article))
        text.clear()
        linked.clear()

    while m := TAG.search(page, at):
        if m.start() > at:
            part = page[at : m.start()]
            if not text:
                start = at
            text.append(part)
            if in_link:
                linked.append(part)
        at = m.end()
        if m["raw"]:
            end = RAW_END[m["raw"].lower()].search(page, at)
            at = end.end() if end else _unclosed(m["raw"].lower(), page, at)
            continue
        if not m["name"]:
            continue
        name, closing = m["name"].lower(), bool(m["close"])
        if name == "a":
            in_link = not closing
            if linked:
                linked.append(" ")
        elif name == "br":
            text.append(" ")
        if name in BLOCKS:
            finish()
            in_link = in_link and name not in ("li", "p")
            paragraph = None
            if name not in STARTS and not closing and "=" in m["rest"]:
                paragraph = opened(name, m["rest"], open_tags[-1])
        if name in STARTS:
            if closing:
                place = next((i for i in range(len(open_tags) - 1, 0, -1) if open_tags[i].name == name), None)
                if place is not None:
                    if open_tags[-1].strong > open_tags[place - 1].strong:
                        finish()
                    del open_tags[place:]
            elif not m["rest"].endswith("/"):
                inner = opened(name, m["rest"], open_tags[-1])
                if inner.strong > open_tags[-1].strong:
                    finish()  # an inline element that names itself ("advert") is a block of its own
                if inner.place is not open_tags[-1].place:
                    places.append(inner.place)
                open_tags.append(inner)
    rest = page[at:]
    if rest:
        if not text:
            start = at
        text.append(rest)
        if in_link:
            linked.append(rest)
    finish()
    settle(places)
    for block, inner in zip(blocks, around):
        block.boilerplate_name = boilerplate_name(inner)
    return blocks


def _unclosed(name: str, page: str, at: int) -> int:
    """Where an element without text ends that is never closed: the head with the body's start, others with the page."""
    if name == "head":
        body = re.compile(r"<body[\s>]", re.IGNORECASE).search(page, at)
        return body.start() if body else at
    return len(page)


def features_of(blocks: list[Block]) -> np.ndarray:
    words = np.array([len(b.text.split(" ")) for b in blocks], dtype=float)
    density = np.array([b.linked_words for b in blocks], dtype=float) / np.maximum(words, 1)
    in_article = np.array([b.in_article for b in blocks], dtype=float)

    def shifted(x: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate([np.zeros(1), x[:-1]]) if by > 0 else np.concatenate([x[1:], np.zeros(1)])

    has_article = np.full(len(blocks), float(in_article.any()))
    named = np.array([b.boilerplate_name for b in blocks], dtype=float)
    return np.stack(
        [words, density, shifted(words, 1), shifted(density, 1), shifted(words, -1), shifted(density, -1),
         in_article, has_article, named],
        axis=1,
    )


@dataclass
class Tree:
    """A node: a leaf's share of article blocks, or a feature, a bound, and the trees below."""

    share: float
    feature: int = -1
    bound: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def takes(self, features: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(features), self.share >= 0.5)
        low = features[:, self.feature] <= self.bound
        out = np.zeros(len(features), dtype=bool)
        out[low], out[~low] = self.low.takes(features[low]), self.high.takes(features[~low])
        return out


def grow(features: np.ndarray, labels: np.ndarray, depth: int = 9, least: int = 2) -> Tree:
    """Split by the feature and bound that lower the Gini impurity most; of equal ones by the first."""
    tree = Tree(float(labels.mean()))
    if depth == 0 or len(labels) < 2 * least or labels.min() == labels.max():
        return tree
    best = 2 * tree.share * (1 - tree.share) * len(labels) - 1e-9
    for k in range(features.shape[1]):
        values = np.unique(features[:, k])
        for bound in (values[1:] + values[:-1]) / 2:
            low = features[:, k] <= bound
            if least <= low.sum() <= len(labels) - least:
                left = sum(2 * s * (1 - s) * n for s, n in ((labels[i].mean(), i.sum()) for i in (low, ~low)))
                if left < best:
                    best, tree.feature, tree.bound = left, k, float(bound)
    if tree.feature >= 0:
        low = features[:, tree.feature] <= tree.bound
        tree.low, tree.high = (grow(features[i], labels[i], depth - 1, least) for i in (low, ~low))
    return tree


def _words(n: int) -> str:
    return " ".join(["word"] * n)


def _links(n: int, each: int = 1) -> str:
    return "".join(f"<li><a href=x>{_words(each)}</a></li>" for _ in range(n))


#: The labelled table: pages as pieces of markup, and whether the blocks of a piece are article text.
LABELLED_PAGES: list[list[tuple[str, int]]] = [
    [(f"<nav><ul>{_links(5)}</ul></nav><div class=ad>{_words(9)}</div>", 0),
     (f"<article><h1>{_words(8)}</h1><p>{_words(60)}</p><p>{_words(2)}</p><p>{_words(120)}</p></article>", 1),
     (f"<footer>{_words(12)}</footer>", 0)],
    [(f"<header>{_words(4)}<nav>{_links(7, 2)}</nav></header>", 0),
     (f"<article><h1>{_words(5)}</h1><p>{_words(1)}</p><p>{_words(30)} <a href=x>{_words(3)}</a></p>", 1),
     (f"<aside><p>{_words(25)}</p></aside>", 0), (f"<p>{_words(45)}</p></article>", 1),
     (f"<section id=comments><p>{_words(30)}</p><p>{_words(50)}</p></section><footer>{_words(20)}</footer>", 0)],
    [(f"<div class=cookie-notice><p>{_words(22)}</p></div><ul class=menu>{_links(4)}</ul>", 0),
     (f"<div id=content><h2>{_words(6)}</h2><p>{_words(70)}</p><p>{_words(35)}</p><p>{_words(14)}</p>", 1),
     (f"<p>{_words(90)}</p></div>", 1),
     (f"<div class=sidebar><h3>{_words(2)}</h3>{_links(6, 5)}</div><div id=footer>{_words(10)}</div>", 0)],
    [(f"<main><h1>{_words(7)}</h1><p>{_words(40)}</p><ul><li>{_words(6)}</li><li>{_words(9)}</li></ul>", 1),
     (f"<form>{_words(3)}<p>{_words(15)}</p></form></main>", 0), (f"<p>{_words(6)}</p><p>{_words(4)}</p>", 0)],
    [(f"<div><a href=x>{_words(1)}</a> <a href=x>{_words(1)}</a></div><div><a href=x>{_words(2)}</a></div>", 0),
     (f"<div><p>{_words(55)}</p><p>{_words(28)}</p><blockquote>{_words(33)}</blockquote></div>", 1),
     (f"<div><a href=x>{_words(3)}</a></div><div>{_words(3)}</div>", 0)],
    [(f"<article><p>{_words(12)}</p><p><a href=x>{_words(4)}</a></p><p>{_words(20)}</p><p>{_words(3)}</p>", 1),
     (f"<div class=share>{_words(4)}</div><div class=comments><p>{_words(64)}</p></div></article>", 0),
     (f"<div class=related>{_links(4, 8)}</div><div>{_words(30)}</div><p>{_words(50)}</p>", 0)],
    [(f"<div class='page has-sidebar with-comments'><div class=sidebar>{_links(5)}</div>", 0),
     (f"<article><h1>{_words(6)}</h1><p>{_words(80)}</p><section id=discussion><h2>{_words(1)}</h2>", 1),
     (f"<p>{_words(65)}</p></section></article>", 1), (f"<section id=comments><p>{_words(40)}</p></section></div>", 0)],
    [(f"<div class=layout-sidebar-right><header>{_words(3)}</header>", 0),
     (f"<main><h1>{_words(9)}</h1><p>{_words(50)}</p><p>{_words(2)}</p>", 1),
     (f"<div class=promo>{_words(30)}</div></main><div class=share>{_words(3)}</div></div>", 0)],
    [(f"<form class=search-page><div id=header>{_words(5)}</div>", 0),
     (f"<article><p>{_words(26)}</p><p>{_words(48)}</p></article>", 1),
     (f"<div class=comments><article class=comment><p>{_words(35)}</p></article></div>", 0),
     (f"<div class=related><article><p>{_words(20)}</p></article></div></form>", 0)],
    # Pages whose elements have no names: densities and neighbours tell.
    [(f"<div><a href=x>{_words(1)}</a><a href=x>{_words(2)}</a></div><ul>{_links(6)}</ul>", 0),
     (f"<div><h1>{_words(4)}</h1><p>{_words(50)}</p><p>{_words(1)}</p><p>{_words(3)}</p><p>{_words(40)}</p></div>", 1),
     (f"<div><a href=x>{_words(2)}</a> <a href=x>{_words(2)}</a></div><div>{_words(4)}</div><div><a href=x>{_words(1)}</a></div>", 0)],
    [(f"<ul>{_links(5, 2)}</ul>", 0),
     (f"<div><h2>{_words(3)}</h2><p>{_words(24)} <a href=x>{_words(8)}</a></p><p>{_words(2)}</p><p>{_words(31)}</p>", 1),
     (f"<p>{_words(9)}</p><p>{_words(1)}</p><p>{_words(66)}</p></div>", 1),
     (f"<div><p><a href=x>{_words(10)}</a></p><p><a href=x>{_words(12)}</a></p><p><a href=x>{_words(9)}</a></p></div>", 0)],
    [(f"<div><div><a href=x>{_words(22)}</a></div><div><a href=x>{_words(30)}</a></div><div><a href=x>{_words(19)}</a></div></div>", 0),
     (f"<div>{_words(2)}</div><div><a href=x>{_words(25)}</a></div><div><a href=x>{_words(40)}</a></div>", 0)],
    [(f"<p>{_words(6)}</p><p>{_words(9)}</p><p>{_words(4)}</p><p>{_words(12)}</p><p>{_words(1)}</p><p>{_words(7)}</p>", 1)],
    [(f"<h1>{_words(3)}</h1><div>{_words(11)}</div><div>{_words(5)}</div><div>{_words(15)}</div>", 1)],
    [(f"<div>{_links(8)}</div><div>{_words(2)}</div><div>{_links(5, 3)}</div>", 0),
     (f"<div><p>{_words(38)}</p><p>{_words(5)}</p></div>", 1),
     (f"<div><a href=x>{_words(3)}</a></div><div>{_words(5)}</div><div>{_links(6, 2)}</div>", 0)],
    # Weak names within an article, and names of paragraphs and inline elements.
    [(f"<article><h1>{_words(5)}</h1><div class=market-share><p>{_words(45)}</p><p>{_words(30)}</p></div><p>{_words(4)}</p>", 1),
     (f"<div class=share-bar>{_words(3)}</div><p class=advert>{_words(20)}</p><p><span class=sponsored>{_words(12)}</span>", 0),
     (f"<p>{_words(25)}</p></article>", 1)],
    [(f"<article><div class=social-science><p>{_words(38)}</p><p>{_words(52)}</p></div><p>{_words(11)}</p>", 1),
     (f"<div class=related-links>{_links(3, 4)}</div><div class=tags-list><a href=x>{_words(2)}</a> {_words(1)}</div></article>", 0)],
    [(f"<nav>{_links(1)}</nav>", 0), (f"<article><p>{_words(3)}</p><p><a href=x>{_words(2)}</a></p><p>{_words(9)}</p></article>", 1),
     (f"<footer><a href=x>{_words(1)}</a></footer>", 0)],
    [(f"<header><a href=x>{_words(2)}</a></header><nav>{_links(1, 2)}</nav>", 0),
     (f"<main><p>{_words(14)}</p><p><a href=x>{_words(5)}</a></p><p>{_words(41)}</p></main>", 1), (f"<div><a href=x>{_words(3)}</a></div>", 0)],
    [(f"<ul>{_links(4, 20)}</ul>", 0), (f"<p>{_words(50)}</p>", 1)],
    [(f"<div><a href=x>{_words(2)}</a> <a href=x>{_words(1)}</a></div>", 0), (f"<div>{_words(26)}</div>", 1),
     (f"<div><a href=x>{_words(4)}</a></div>", 0)],
    [(f"<ul>{_links(6, 3)}</ul>", 0), (f"<p>{_words(80)}</p>", 1), (f"<ul>{_links(3, 6)}</ul><div>{_words(6)}</div>", 0)],
    # Single link bars, short pages, and what follows an article in elements without names.
    [(f"<div><a href=x>{_words(10)}</a> <a href=x>{_words(10)}</a> <a href=x>{_words(10)}</a></div>", 0)],
    [(f"<div><a href=x>{_words(3)}</a> <a href=x>{_words(4)}</a></div>", 0)],
    [(f"<p>{_words(2)}</p><p>{_words(3)}</p><p>{_words(1)}</p>", 1)],
    [(f"<p>{_words(1)}</p><p>{_words(5)}</p><p>{_words(2)}</p><p>{_words(2)}</p><p>{_words(14)}</p>", 1)],
    [(f"<div>{_words(2)}</div>", 0), (f"<article><h1>{_words(3)}</h1><p>{_words(22)}</p><p>{_words(1)}</p><p>{_words(2)}</p>", 1),
     (f"<p>{_words(1)}</p><p>{_words(2)}</p></article>", 1), (f"<div><p>{_words(40)}</p><p>{_words(3)}</p></div><p>{_words(12)}</p>", 0)],
    [(f"<p>{_words(60)}</p><div>{_words(7)}</div>", 0),
     (f"<article><p>{_words(5)}</p><p>{_words(2)}</p><p>{_words(8)}</p></article>", 1), (f"<p>{_words(33)}</p>", 0)],
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of the labelled pages."""
    features, labels = [], []
    for pieces in LABELLED_PAGES:
        ends = np.cumsum([len(piece) for piece, _ in pieces])
        blocks = blocks_of("".join(piece for piece, _ in pieces))
        features.append(features_of(blocks))
        labels += [pieces[int(np.searchsorted(ends, b.offset, side="right"))][1] for b in blocks]
    return np.concatenate(features), np.array(labels)


def main_text(page: str, tree: Tree) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, taken in zip(blocks, tree.takes(features_of(blocks))) if taken)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text per page, from page_id, url and html; no other column is read.

    The text has one line per block, its character references decoded and its white space (any) turned into single
    blanks. A null, empty or textless page has an empty text. Repeated rows and null ids are kept as they are, an empty
    table gives an empty one, and a page of any length is read whole. Of two equal splits the tree takes the first.
    """
    tree = grow(*labelled_table())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "", tree) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(
        read, "page_id long, url string, text string"
    )
