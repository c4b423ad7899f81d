"""Main text of a page: the best-scoring contiguous region of its tokens.

A page is read as a sequence of tags and texts. Each word scores by how often words in such a place (nearest block, in a
link or not) were content in the labelled pages, always above zero; each tag scores below zero, the more so the more often
it stood outside the content. One linear scan finds the contiguous run of tokens with the highest sum. The
texts of that region are returned block by block.

Parts that the content goes on around score nothing and are not returned: menus, headers, footers, asides, forms, scripts and styles
by their element; notices, adverts and reader comments by a class, id or role, which is a whole listed name, a listed
last part of one, or a name whose elements held next to nothing but text outside the content of the labelled pages. Such a part is never html, body or main, nor an
element that holds the page's article or main, nor the page's only article; and where no page element is marked so, none that holds most of
the page's words.

Weights come from labelled pages: pages that mark their content themselves by an `article` or `main` element, up to
`label_pages` of them, taken by the hash of their id and counted in tasks. Without any, `DEFAULT` weights hold.

Reading takes time in proportion to the page, whatever its tags are like. Defined results: a null or empty page, an empty table, and a page
without words give an empty text or no row; texts of any length are read whole; unclosed tags end where their
parent ends; what follows a tag that is never closed is lost; repeated rows are extracted each; a null id is kept; ties between
regions go to the earliest and longest. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from iotlake.llm.tables import hash_sample, map_texts, plain, prepare, stored

# Element names and class words of HTML pages.
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
LEFT_OUT = frozenset(
    "aside button canvas datalist dialog footer form head header iframe menu nav noscript object script select style svg template "
    "textarea title".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer discussion disqus "
    "footer menu modal nav navbar navigation newsletter notice notices pagination popup promo reactions related replies responses share "
    "sharing sidebar social sponsor sponsored subscribe thread toolbar widget".split())
LEFT_OUT_FIRST = frozenset("comment comments".split())
LEFT_OUT_ROLES = frozenset("banner complementary contentinfo navigation search form dialog alert".split())
CONTENT = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body", "main"))
ENDS_ITSELF = frozenset("p li dt dd tr td th option".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_ATTRIBUTE = re.compile(r"([^\s=/\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"']++)))?+")
_PARTS = re.compile(r"[^a-z0-9]+")
_WHITE = re.compile(r"\s+")

#: A learned name stood over so many words at least, and over so large a share outside the content.
NAME_WORDS, NAME_SHARE = 50, 0.98


@dataclass
class Weights:
    """Scores of a word by its place and of a tag by its name; class and id names of what isn't content."""

    word: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)
    names: frozenset[str] = frozenset()

    def of_word(self, place: str) -> float:
        found = self.word.get(place)
        if found is None:
            found = self.word.get(place.split("/")[0], 0.5)
        return found

    def of_tag(self, name: str) -> float:
        return self.tag.get(name, -0.5)


@dataclass
class Token:
    tag: str = ""
    text: str = ""
    place: str = ""
    content: bool = False
    left_out: bool = False
    element: int = 0


@dataclass
class Element:
    """An element of a page; 0 is the page itself."""

    name: str
    parent: int
    names: tuple[str, ...] = ()
    #: What its element name or its names say it is.
    aside: bool = False
    content: bool = False
    block: str = ""
    link: bool = False
    words: int = 0
    #: Whether it holds the page's content by that content's own mark.
    holds: bool = False
    left_out: bool = False


def _named(attributes: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Class and id names, and roles."""
    names: list[str] = []
    roles: list[str] = []
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id"):
            names += (a or b or c).lower().split()
        elif key == "role":
            roles += (a or b or c).lower().split()
    return tuple(names), tuple(roles)


def _says_aside(names: tuple[str, ...], roles: tuple[str, ...], learned: frozenset[str]) -> bool:
    if not LEFT_OUT_ROLES.isdisjoint(roles) or not learned.isdisjoint(names):
        return True
    for name in names:
        parts = [p for p in _PARTS.split(name) if p]
        if parts and (parts[-1] in LEFT_OUT_WORDS or parts[0] in LEFT_OUT_FIRST):
            return True
    return False


def read(html: str, learned: frozenset[str] = frozenset()) -> tuple[list[Token], list[Element]]:
    """Tags and texts of a page, and its elements."""
    out: list[Token] = []
    elements = [Element("", 0)]
    stack, opened = [0], Counter()
    at, end, quotes = 0, len(html), True

    def add(text: str) -> None:
        if text:
            here = elements[stack[-1]]
            here.words += len(text.split())
            out.append(Token(text=text, place=here.block + "/a" if here.link else here.block, content=here.content, element=stack[-1]))

    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        add(html[at:lt])
        if html.startswith("<!--", lt):
            stop = html.find("-->", lt + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        if html.startswith(("<!", "<?"), lt):
            stop = html.find(">", lt)
            at = stop + 1 if stop >= 0 else end
            continue
        name_found = _NAME.match(html, lt)
        if not name_found:
            # No tag: a sign in the text, or what ends a page that is cut off.
            if html.startswith("</", lt) and html.find(">", lt) < 0:
                break
            add("<")
            at = lt + 1
            continue
        found = _TAG.match(html, lt) if quotes else None
        if found:
            attributes, at = found[3], found.end()
        else:
            # Quotes that never end: from here on a tag ends at its first >. So the page is run through to its end once only.
            quotes = False
            stop = html.find(">", name_found.end())
            if stop < 0:
                break
            attributes, at = html[name_found.end():stop], stop + 1
        name = name_found[2].lower()
        if name_found[1]:
            if opened[name]:
                while elements[stack[-1]].name != name:
                    opened[elements[stack.pop()].name] -= 1
                gone = stack.pop()
                opened[name] -= 1
                out.append(Token(tag=name, content=elements[gone].content and name not in CONTENT, element=gone))
            else:
                out.append(Token(tag=name, element=stack[-1]))
            continue
        if name in ENDS_ITSELF and elements[stack[-1]].name == name:
            opened[elements[stack.pop()].name] -= 1
        above = elements[stack[-1]]
        names, roles = _named(attributes) if attributes.strip() else ((), ())
        aside = name in LEFT_OUT and not (name == "header" and above.content) or _says_aside(names, roles, learned)
        elements.append(Element(name, stack[-1], names, aside, above.content or name in CONTENT, name if name in BLOCKS else above.block,
                                above.link or name == "a"))
        number = len(elements) - 1
        out.append(Token(tag=name, content=above.content, element=number))
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            continue
        stack.append(number)
        opened[name] += 1
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, at)
            stop = close.start() if close else end
            if name == "title":
                add(html[at:stop])
            at = stop
    return out, elements


def _leave_out(elements: list[Element]) -> None:
    """Decides which elements are left out."""
    for e in reversed(elements[1:]):
        elements[e.parent].words += e.words
    # The content's own marks: main, and articles that say nothing else; an article inside an article is a comment or a teaser.
    outer = [e for e in elements if e.name == "main" or e.name == "article" and not elements[e.parent].content]
    marked = [e for e in outer if not e.aside] or outer
    for e in marked:
        e.holds = True
    for e in reversed(elements[1:]):
        if e.holds:
            elements[e.parent].holds = True
    total = elements[0].words
    for e in elements[1:]:
        kept = e.name in WHOLE or e.holds or not marked and 2 * e.words > total
        e.left_out = elements[e.parent].left_out or e.aside and not kept


def tokens(html: str, learned: frozenset[str] = frozenset()) -> list[Token]:
    """Tags and texts of a page, with the place of each text and whether it is left out or inside marked content."""
    out, elements = read(html, learned)
    _leave_out(elements)
    for t in out:
        t.left_out = elements[t.element].left_out
    return out


def counts(html: str, learned: frozenset[str] = frozenset()) -> Counter:
    """(kind, name, inside content): tags, words by their place, and words by the class and id names they stand under."""
    found, elements = read(html, learned)
    _leave_out(elements)
    out: Counter = Counter()
    inside = [0] * len(elements)
    for t in found:
        here = elements[t.element]
        n = len(t.text.split())
        if t.content:
            inside[t.element] += n
        if here.left_out:
            continue
        if t.tag:
            out["tag", t.tag, t.content] += 1
        elif n:
            out["word", t.place, t.content] += n
    for i in range(len(elements) - 1, 0, -1):
        inside[elements[i].parent] += inside[i]
        for name in elements[i].names:
            out["name", name, True] += inside[i]
            out["name", name, False] += elements[i].words - inside[i]
    return out


def weighed(found: Counter) -> Weights:
    """Weights from the counts of labelled pages."""
    weights, names = Weights(), set()
    for kind, name, _ in list(found):
        inside, outside = found[kind, name, True], found[kind, name, False]
        if kind == "tag":
            weights.tag[name] = -0.05 - 3 * outside / (inside + outside)
        elif kind == "word":
            weights.word[name] = max(0.01, inside / max(inside + outside, 1))
        elif outside >= NAME_WORDS and outside >= NAME_SHARE * (inside + outside):
            names.add(name)
    weights.names = frozenset(names)
    return weights


#: A page that marks its content in the plainest way.
DEFAULT = weighed(counts(
    "<head><title>t</title></head><body><nav><ul><li><a>menu</a></li></ul></nav><div><article><h1>title</h1><p>some words</p>"
    "<ul><li>more words</li></ul><div><section><p>words</p></section></div></article></div><footer>end</footer></body>"))


def best_region(page: list[Token], weights: Weights) -> tuple[int, int]:
    """First token of the best-scoring run and the one after its last; equal if no run scores above zero."""
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(page):
        if t.left_out:
            score = 0.0
        elif t.tag:
            score = weights.of_tag(t.tag)
        else:
            score = weights.of_word(t.place) * len(t.text.split())
        if total < 0 or i == 0:
            total, start = 0.0, i
        total += score
        if total > best or total == best > 0 and found[0] == start:
            best, found = total, (start, i + 1)
    return found


def region_text(page: list[Token], start: int, end: int) -> str:
    """Blocks of the region, one to a line."""
    blocks, line = [], []

    def close():
        text = _WHITE.sub(" ", unescape("".join(line))).strip()
        if text:
            blocks.append(text)
        line.clear()

    for t in page[start:end]:
        if t.tag:
            if t.tag in BLOCKS:
                close()
        elif not t.left_out:
            line.append(t.text)
    close()
    return "\n".join(blocks)


def extract(html: str, weights: Weights) -> str:
    page = tokens(html, weights.names)
    return region_text(page, *best_region(page, weights))


def fit(pages: DataFrame, label_pages: int = 5_000, kinds: int = 20_000) -> Weights:
    """Weights from at most `label_pages` of the pages (page_id, html) that have an article or a main element.

    Names come first; tags and places are then counted outside of what they leave out. Counts are added up in tasks; of tags, places and
    names the `kinds` most frequent ones reach the driver.
    """
    prepare(pages.sparkSession)
    marked = plain(pages, "page_id", "html").where(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    chosen = F.broadcast(hash_sample(marked.select("page_id").distinct(), "page_id", label_pages))
    labelled = stored(marked.join(chosen, "page_id", "left_semi").select("html"), "labelled-pages")
    names = weighed(_summed(labelled, frozenset(), kinds)).names
    found = _summed(labelled, names, kinds)
    return replace(weighed(found), names=names) if any(kind == "word" for kind, _, _ in found) else DEFAULT


def _summed(labelled: DataFrame, learned: frozenset[str], kinds: int) -> Counter:
    """The counts of all labelled pages."""
    schema = pa.schema([("kind", pa.string()), ("name", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())])

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for html in batch.column(0):
                total.update(counts(html.as_py(), learned))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, n))) for key, n in total.items()], schema)

    rows = labelled.mapInArrow(run, "kind string, name string, inside boolean, n long")
    summed = rows.groupBy("kind", "name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n"))
    found: Counter = Counter()
    for r in summed.orderBy(F.desc("n"), "kind", "name").limit(kinds).collect():
        found[r.kind, r.name, True], found[r.kind, r.name, False] = r.inside, r.n - r.inside
    return found


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url and text of every row of `pages` (page_id, url, html)."""
    weights = weights or fit(pages)

    def rows(keys, values):
        return {"page_id": [k["page_id"] for k in keys], "url": [k["url"] for k in keys],
                "text": [extract(v, weights) for v in values]}

    return map_texts(plain(pages, "page_id", "url", "html").select(F.struct("page_id", "url").alias("k"), "html"), rows,
                     "page_id long, url string, text string", key="k", text="html")
