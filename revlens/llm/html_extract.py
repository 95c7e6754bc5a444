"""Main-text extraction: the maximum-scoring contiguous region of a page's words and tags.

Words score positive, tags negative. How much a tag costs is learned from labelled pages: those whose article is marked
up as such show how often each tag, in or out of page furniture, stands outside of the content. A linear scan finds the
region of the largest sum. Page furniture (menus, adverts, forms, comments and the like) scores nothing and is left out
wherever it stands, so a notice between two paragraphs does not break the region. What furniture is called is known in
part (MARKS); labelled pages add the classes, ids and roles that they only have outside of and not around their article.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blank, cut

MARKUP = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Elements whose content is not text, elements that are page furniture, and words in a class, id or role that mark furniture.
RAW = frozenset("script style noscript template svg iframe textarea select option canvas annotation annotation-xml title".split())
FURNITURE = frozenset("nav footer header aside form menu dialog button head".split())
MARKS = frozenset(
    """ad ads advert adverts advertisement sponsor sponsored promo banner menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead
    cookie cookies consent notice notices alert popup modal newsletter subscribe signup login search comment comments respond replies
    reply disqus discussion share sharing social related recommended widget toolbar pagination pager copyright complementary contentinfo""".split()
)
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr
    math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder munderover mstyle mspace semantics""".split()
)
#: Words that say of a layout what it has or has not; a name with one of them marks nothing.
ABOUT = frozenset("with without no not has have is hide hidden show layout single grid col cols".split())
#: Words that name the content. Inside of it (or of article and main), a mark is a whole class or role, or a name all of whose words
#: are marks or say what a mark stands on (CARRIERS), unless its marks are all among PARTS, which articles have too. Of ids without
#: a carrier, only OWN_IDS are marks there, since sections of an article are often called like the others.
CONTENT = frozenset("article main content post entry body text story prose".split())
CARRIERS = frozenset(
    """slot box bar block list section area wrap wrapper container unit inner outer holder frame panel group form links link buttons button icons
    icon posts thread user users reader readers site page top bottom left right id""".split()
)
PARTS = frozenset("discussion header masthead footer menu alert reply replies search copyright".split())
OWN_IDS = frozenset("ad ads advert adverts advertisement comments disqus newsletter sidebar breadcrumb breadcrumbs".split())
#: Elements of code, in which names mark nothing: highlighters call parts of it comment and the like.
CODE = frozenset(["pre", "code"])
#: What a form holds if it spans the page.
SPANNED = frozenset(["nav", "footer"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: HTML's implied end tags: an opening tag closes the open ones named, but none outside of the innermost bound.
BLOCKS = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup
    hr main menu nav ol p pre search section summary table ul li dd dt""".split()
)
CELLS = ("td", "th")
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": CELLS, "th": CELLS, "tr": ("tr", *CELLS)}
CLOSES |= dict.fromkeys(("thead", "tbody", "tfoot"), ("thead", "tbody", "tfoot", "tr", *CELLS))
BOUNDS = {"p": frozenset("table caption td th object button".split()), "li": frozenset("ul ol menu dir table".split()), "dt": frozenset(["dl", "table"])}
BOUNDS |= {"dd": BOUNDS["dt"]} | dict.fromkeys((*CELLS, "tr", "thead", "tbody", "tfoot"), frozenset(["table"]))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A word's score; a tag costs LEAST and up to MOST more by its share outside of content. Tags that labelled pages only have in
#: furniture cost that part of it elsewhere.
WORD, LEAST, MOST, ELSEWHERE = 1.0, 0.1, 4.0, 0.25
#: Tags and names count from this share of the labelled pages on; so there are at most 1 / SUPPORT times as many of them as a
#: page has on average. A name is furniture if at most MIXED of its pages have it in or around the article.
SUPPORT, MIXED = 0.001, 0.02


def read_names(attributes: str) -> list[tuple[str, str]]:
    return [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in NAMES.finditer(attributes)]


short_names = lru_cache(1 << 14)(read_names)


def names_of(attributes: str) -> list[tuple[str, str]]:
    """(attribute, value) of classes, ids and roles; short attributes, which pages repeat, are read once."""
    return (short_names if len(attributes) <= 200 else read_names)(attributes) if attributes else []


@lru_cache(1 << 16)
def words_of(name: str) -> tuple[str, ...]:
    """The words of a name; one that is a mark and a carrier written together (commentlist) is both."""
    out: list[str] = []
    for word in re.findall(r"[a-z]+", name):
        at = 0 if word in MARKS else next((k for k in range(2, len(word) - 1) if (word[:k] in MARKS and word[k:] in CARRIERS) or (word[:k] in CARRIERS and word[k:] in MARKS)), 0)
        out += (word[:at], word[at:]) if at else (word,)
    return tuple(out)


@lru_cache(1 << 16)
def is_marked_inside(name: str) -> bool:
    """Whether a name of several words says furniture even inside of the content: ad-slot, cookie-notice, user-comments, but
    not cookie-recipe or section-header."""
    words = words_of(name)
    return len(words) > 1 and any(w in MARKS and w not in PARTS for w in words) and all(w in MARKS or w in CARRIERS for w in words)


@lru_cache(1 << 16)
def is_marked(name: str) -> bool:
    """Whether a class, id or role names furniture by its first or last word: sidebar, ad-slot, site-comments, but not
    with-sidebar."""
    words = words_of(name)
    return bool(words) and (words[0] in MARKS or words[-1] in MARKS) and not ABOUT & set(words)


def is_furniture(tag: str, attributes: str, inside: bool = False, learned: frozenset[str] = frozenset()) -> bool:
    """``inside``: in the content, where fewer names mark furniture, and none on what is called content too."""
    if tag in FURNITURE:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    found = names_of(attributes)
    whole = {w for name, value in found if name != "id" for w in value.split()}
    if inside or tag in HEADINGS:
        if whole & CONTENT:
            return False
        own = {w for name, value in found if name == "id" for w in value.split()}
        return bool(whole & MARKS) or (tag not in HEADINGS and (bool(own & OWN_IDS) or any(map(is_marked_inside, whole | own))))
    if whole & CONTENT and not whole & MARKS:
        return False
    every = {w for _, value in found for w in value.split()}
    return bool(every & learned) or any(map(is_marked, every))


def is_content(tag: str, attributes: str) -> bool:
    if tag in ("article", "main"):
        return True
    return any(name != "class" and value in ("main", "article", "content") for name, value in names_of(attributes))


def is_called_content(tag: str, attributes: str) -> bool:
    """Whether a class, id or role is a word for content."""
    return any(w in CONTENT for _, value in names_of(attributes) for w in value.split())


def unclosed(page: str) -> set[int]:
    """Where tags open that are never closed, of those whose end tags may not be left out."""
    out, open_ = set(), {}
    for found in MARKUP.finditer(page):
        tag = (found[2] or "").lower()
        if not tag or tag in VOID or tag in CLOSES or tag == "p" or found[3].endswith("/"):
            continue
        if not found[1]:
            open_.setdefault(tag, []).append(found.start())
        elif open_.get(tag):
            open_[tag].pop()
    for places in open_.values():
        out.update(places)
    return out


class Open:
    """The open elements of a page. What an end tag or an implied end closes is found from the places of each tag's open
    elements, and only elements that are marked are looked at to unmark them, so a page takes linear time at any depth."""

    def __init__(self) -> None:
        self.stack: list[list] = []  # [tag, is furniture, is content]
        self.places: dict[str, list[int]] = defaultdict(list)
        self.depth = self.inside = self.code = 0
        self.named: list[list] = []  # elements that only a name marks
        self.short: list[list] = []  # those of them that end at the next block
        self.forms: list[list] = []

    def push(self, tag: str, mark: bool, content: bool, short: bool) -> None:
        element = [tag, mark, content]
        self.places[tag].append(len(self.stack))
        self.stack.append(element)
        self.depth += mark
        self.inside += content
        self.code += tag in CODE
        if mark and tag == "form":
            self.forms.append(element)
        elif mark and tag not in FURNITURE:
            (self.short if short else self.named).append(element)

    def close(self, k: int) -> None:
        while k >= 0 and len(self.stack) > k:
            element = self.stack.pop()
            self.places[element[0]].pop()
            self.depth -= element[1]
            self.inside -= element[2]
            self.code -= element[0] in CODE
            element[1] = False

    def bound(self, bounds: frozenset[str]) -> int:
        """Place of the innermost open element of ``bounds``, or -1."""
        return max((self.places[t][-1] for t in bounds if self.places.get(t)), default=-1)

    def outermost(self, tags: tuple[str, ...], bounds: frozenset[str]) -> int:
        """Place of the outermost open element of ``tags`` within the innermost of ``bounds``, or -1."""
        some = [self.places[t] for t in tags if self.places.get(t)]
        if not some:
            return -1
        edge = self.bound(bounds)
        return min((p[bisect_right(p, edge)] for p in some if p[-1] > edge), default=-1)

    def last(self, tag: str, bounds: frozenset[str]) -> int:
        """Place of the innermost open ``tag`` if no element of ``bounds`` is open in it, or -1."""
        found = self.places[tag][-1] if self.places.get(tag) else -1
        return found if found >= 0 and found >= self.bound(bounds) else -1

    def unmark(self, elements: list[list]) -> None:
        for element in elements:
            self.depth -= element[1]
            element[1] = False
        elements.clear()


def events(page: str, learned: frozenset[str] = frozenset(), lenient: bool = False) -> Iterator[tuple[str, str, bool]]:
    """("text", characters, in furniture), or (tag name, "open" or "close", in furniture), in page order.

    What only a name marks as furniture is none if an article or main element opens in it; if it is never closed, it ends
    at the next block. A form in which content, a menu or a footer opens spans the page and is no furniture. ``lenient``:
    any element that is called content unmarks what is around it, as an article does.
    """
    at, open_ = 0, Open()
    endless: set[int] | None = None
    no_end: set[str] = set()
    size = len(page)
    while at < size:
        found = MARKUP.search(page, at)
        if not found:
            yield "text", page[at:], open_.depth > 0
            return
        if found.start() > at:
            yield "text", page[at : found.start()], open_.depth > 0
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        closed = found[3].endswith("/")
        if found[1]:
            yield tag, "close", open_.depth > 0
            open_.close(open_.last(tag, BOUNDS.get(tag, frozenset())))
        elif tag in RAW:
            end = None if closed or tag in no_end else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif not closed:
                no_end.add(tag)
                at = size if tag in ("script", "style") else at
        else:
            if tag in BLOCKS:
                open_.close(open_.outermost(("p",), BOUNDS["p"]))
                open_.unmark(open_.short)
            if tag in CLOSES:
                open_.close(open_.outermost(CLOSES[tag], BOUNDS[tag]))
            content = is_content(tag, found[3])
            mark = is_furniture(tag, found[3], open_.inside > 0, learned) and (tag in FURNITURE or not open_.code)
            if tag in ("article", "main") or (lenient and is_called_content(tag, found[3])):
                open_.unmark(open_.named)
                open_.unmark(open_.short)
                open_.unmark(open_.forms)
            elif content or tag in SPANNED:
                open_.unmark(open_.forms)
            if tag not in VOID and not closed:
                short = False
                if mark and tag not in FURNITURE:
                    if endless is None:
                        endless = unclosed(page)
                    short = found.start() in endless
                open_.push(tag, mark, content, short)
            yield tag, "open", open_.depth > 0


def profile(page: str) -> Counter:
    """Of a labelled page, one with exactly one article: (tag, in furniture, in the article) counts, and ("name", name,
    in or around the article) once for each name. Empty for other pages."""
    out: Counter = Counter()
    inside, articles = False, 0
    for tag, kind, furniture in events(page):
        if tag == "article":
            articles += kind == "open"
            inside = kind == "open"
        elif tag != "text":
            out[tag, furniture, inside] += 1
    if articles != 1:
        return Counter()
    around, within, outside, open_, count = set(), set(), set(), [], Counter()
    inside = False
    for found in MARKUP.finditer(page):
        tag = (found[2] or "").lower()
        if tag == "article":
            inside = not found[1]
            around.update(*(names for _, names in open_))
        elif found[1]:
            while count[tag]:
                last = open_.pop()[0]
                count[last] -= 1
                if last == tag:
                    break
        elif tag:
            names = {w for _, value in names_of(found[3]) for w in value.split()}
            (within if inside else outside).update(names)
            if tag not in VOID and not found[3].endswith("/"):
                open_.append((tag, names))
                count[tag] += 1
    out.update(("name", name, True) for name in within | around)
    out.update(("name", name, False) for name in outside - within - around)
    return out


class Learned(dict):
    """Cost of each (tag, in furniture), with the learned ``names`` of furniture."""

    names: frozenset[str] = frozenset()


def learn_tag_costs(pages: DataFrame, *, html_col: str = "html") -> Learned:
    """Costs of tags and names of furniture, from all labelled pages. Both need the SUPPORT of these pages."""
    schema = "kind string, tag string, furniture boolean, inside boolean, n long, pages long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            seen: Counter = Counter()
            for page in batch.column(0).to_pylist():
                found = profile(page)
                total += found
                seen.update(found.keys())
                seen["pages", "", False] += bool(found)
            rows = [("name" if k[0] == "name" else "pages" if k[0] == "pages" else "tag", k[1] if k[0] == "name" else k[0], bool(k[1]) if k[0] != "name" else False, k[2], total[k], n) for k, n in seen.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["kind", "tag", "furniture", "inside", "n", "pages"])

    seen = pages.select(blank(html_col).alias("html")).mapInArrow(count, schema)
    table = seen.groupBy("kind", "tag", "furniture").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"), *[F.sum(F.when(~F.col("inside"), F.col(c)).otherwise(0)).alias(f"{c}_out") for c in ("n", "pages")])
    table = cut(table)
    labelled = table.filter("kind = 'pages'").agg(F.sum("pages")).first()[0] or 0
    rows = table.filter((F.col("kind") != "pages") & (F.col("pages") >= max(1, SUPPORT * labelled))).collect()  # bounded by SUPPORT
    out = Learned({(r["tag"], r["furniture"]): cost(r["n"], r["n_out"]) for r in rows if r["kind"] == "tag"})
    out.names = frozenset(r["tag"] for r in rows if r["kind"] == "name" and r["pages"] >= 3 and r["pages_out"] >= (1 - MIXED) * r["pages"])
    return out


def cost(n: int, outside: int) -> float:
    """Two occurrences in content are assumed of any tag, so a rare tag costs little."""
    return LEAST + MOST * outside / (n + 2)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the first contiguous region of the largest sum above 0; (0, 0) if there is none."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, region = total, (start, k + 1)
    return region


def main_text(page: str, costs: dict[tuple[str, bool], float]) -> str:
    """The text of the best-scoring region, blocks joined by one space.

    If all of a page's text is in furniture, the page is read again with elements that are called content taken as such.
    """
    return region_text(page, costs, False) or region_text(page, costs, True)


def region_text(page: str, costs: dict[tuple[str, bool], float], lenient: bool) -> str:
    items: list[tuple[float, str | None]] = []  # score; text, or None for the edge of a block
    for tag, what, furniture in events(page, getattr(costs, "names", frozenset()), lenient):
        if tag == "text":
            text = html.unescape(what)
            words = len(text.split())
            items.append((0.0, None) if furniture else (words * WORD, text))
        else:
            price = 0.0 if furniture else costs.get((tag, False)) or max(LEAST, ELSEWHERE * costs.get((tag, True), 0.0))
            items.append((-price, "" if tag in INLINE and not furniture else None))
    start, end = best_region([score for score, _ in items])
    pieces = (x if x is not None else "\n" for _, x in items[start:end])
    return " ".join("".join(pieces).split())


def extract(pages: DataFrame, costs: Learned | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars. Tag costs are learned from ``pages`` if none are given.

    Null or empty html, and pages without any content, give empty text. Other columns are ignored; repeated rows are
    extracted each; without labelled pages all tags outside of furniture cost the same.
    """
    costs = learn_tag_costs(pages, html_col=html_col) if costs is None else costs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, costs) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), blank(html_col).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
