"""Main text of web pages by site template removal.

A page is parsed once into element subtrees. Every block-level subtree is hashed over its tags, classes and text. Spark counts the
hashes per host, each over pages of different content and before any name is looked at; subtrees that recur across many pages of their
host are its template and are deleted before the text is read. What changes from page to page, such as adverts, reader comments and
stories beside the article, or stands on a host with few pages, shows no recurrence: there, elements that name themselves so are deleted. Names are
taken word by word outside a marked article, and only whole inside one; a name or a form around the article, or around most of the paragraphs of a
page without one, deletes nothing. Text blocks of a marked article are content even if other pages repeat them.
"""

from __future__ import annotations

import functools
import html as html_lib
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import join_counted, persisted, superseded

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
MARKUP = frozenset("script style noscript template iframe svg canvas object embed head title audio video map".split())
DROPPED = MARKUP | frozenset("form button input select textarea nav footer aside dialog menu".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption summary address".split())
BLOCKS = TEXT_BLOCKS | frozenset("html body div section article main header footer nav aside ul ol dl table thead tbody tfoot tr form fieldset figure details hr center".split())
CUES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay sidebar rail menu nav navbar navigation "
    "breadcrumb breadcrumbs pager pagination footer masthead topbar toolbar share sharing social related recommended newsletter subscribe signup login comment comments disqus respond reply replies widget copyright".split()
)
OUTSIDE_CUES = frozenset("header head top side".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
#: Whole names of classes and identifiers that delete an element inside an article too.
INSIDE_CUES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo share sharing social social-share share-buttons newsletter newsletter-signup subscribe signup related related-posts related-articles "
    "recommended comment comments comment-list reader-comments comments-area disqus disqus_thread respond replies sidebar breadcrumb breadcrumbs pagination cookie-notice".split()
)
#: What a start tag closes, up to the nearest of the listed boundaries.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

_TAG = re.compile(r"""<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)(>?))""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>?)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?|"[^"]*"|'[^']*'""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Element:
    __slots__ = ("tag", "parts", "names", "drop", "outer_drop", "cued", "inside_cued", "digest")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.parts, self.digest = tag, [], 0
        self.names, self.drop, self.outer_drop = "", tag in DROPPED and tag != "form", tag == "header"
        self.cued = tag == "form"  # dropped for a name or as a form, which may also stand around the content
        self.inside_cued = tag == "form"
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = (m[1] or "").lower(), (m[2] or "").strip("\"'")
            if name in ("class", "id"):
                tokens = {x.lower() for x in _TOKEN.findall(value)}
                self.names += f" {value}" if name == "class" else ""
                self.cued |= bool(tokens & CUES) and tag not in ("html", "body", "article", "main")
                self.outer_drop |= bool(tokens & OUTSIDE_CUES) and tag not in ("html", "body", "article", "main")
                self.inside_cued |= not INSIDE_CUES.isdisjoint(value.lower().split())
            elif name == "role":
                self.drop |= value.lower() in ROLES
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                self.drop |= tag not in ("html", "body")


#: Blocks that a stray inline end tag doesn't close.
_WALLS = frozenset("article main body table td section div".split())


@functools.cache
def _places(tag: str) -> tuple[str, ...]:
    """Under which names an open element is found: its tag, and # and a kind."""
    return (tag, *(["#block"] if tag in BLOCKS or tag == "button" else []), *(["#wall"] if tag in _WALLS else []))


class _Open:
    """The open elements, and where in their stack the last of each tag and kind stands, so that no tag is looked for element by element."""

    def __init__(self, root: Element):
        self.stack, self.at = [root], defaultdict(list)

    def last(self, *names: str) -> int:
        return max((self.at[x][-1] for x in names if self.at[x]), default=0)

    def push(self, element: Element) -> None:
        for name in _places(element.tag):
            self.at[name].append(len(self.stack))
        self.stack.append(element)

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            for name in _places(self.stack.pop().tag):
                self.at[name].pop()


def parse(page: str) -> Element:
    """The page as elements, in linear time; unclosed tags end where HTML says, an unfinished tag or comment at the end is left out."""
    root = Element("")
    open_ = _Open(root)
    stack = open_.stack
    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            close = page.find("-->", at) if m[0] == "<!--" else page.find(">", at)
            at = end if close < 0 else close + (3 if m[0] == "<!--" else 1)
            continue
        if not m[4]:  # a stray quote, or the page ends inside the tag
            m = _LOOSE.match(page, m.start())
            at = m.end()
            if not m[4]:
                break
        tag = m[2].lower()
        if m[1]:
            k = open_.last(tag)
            if k and (tag in BLOCKS or k > open_.last("#wall")):
                open_.cut(k)
            continue
        if tag in BLOCKS and (k := open_.last("#block")) and stack[k].tag == "p":
            open_.cut(k)
        if tag in CLOSES:
            ends, bounds = CLOSES[tag]
            if (k := open_.last(*ends)) > open_.last(*bounds):
                open_.cut(k)
        element = Element(tag, m[3])
        stack[-1].parts.append(element)
        if tag in RAW:
            close = _raw_end(tag).search(page, at)
            at = end if close is None else max(close.start(), at)
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCKS and tag != "hr":
            open_.push(element)
    return root


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}", re.I)


Order = list[tuple[Element, Element | None]]


def in_order(root: Element) -> Order:
    """Elements with their parents, parents first."""
    out, todo = [], [(root, None)]
    while todo:
        here, parent = todo.pop()
        out.append((here, parent))
        todo += [(x, here) for x in reversed(here.parts) if isinstance(x, Element)]
    return out


def _around_content(order: Order) -> set[int]:
    """id() of the elements that hold a marked article, or on a page without one over half of the text of paragraphs, in nothing that surely goes; names don't drop them."""
    root = order[0][0]
    alive, reached = [], {id(root)}
    for x, p in order[1:]:
        if id(p) in reached and not x.drop:
            reached.add(id(x))
            alive.append((x, p))
    marked = {id(x) for x, _ in alive if x.tag in ("article", "main") and not x.cued}
    if marked:
        # Articles inside a cued element (related stories, comments) don't count where others stand outside all cued ones.
        free = {id(root)}
        for x, p in alive:
            if id(p) in free and not (x.cued or x.outer_drop):
                free.add(id(x))
        if marked & free:
            return set()
    size: dict[int, int] = {}
    for x, p in reversed(alive):
        own = 0 if marked else sum(len(" ".join(t.split())) for t in x.parts if isinstance(t, str)) if x.tag in TEXT_BLOCKS else 0
        size[id(x)] = size.get(id(x), 0) + (int(id(x) in marked) if marked else own)
        size[id(p)] = size.get(id(p), 0) + size[id(x)]
    total = size.get(id(root), 0)
    return {id(x) for x, _ in alive if size[id(x)] and (marked or 2 * size[id(x)] > total)}


def _kept(order: Order, templates: frozenset[int] = frozenset(), names: bool = True) -> tuple[set[int], set[int]]:
    """id() of the elements that lie in nothing that drops them, given where the article is; and of those inside an article. Without names recurrence alone decides."""
    inside: set[int] = set()
    kept: set[int] = {id(order[0][0])}
    if not names:
        for here, parent in order[1:]:
            if id(parent) in kept and here.tag not in MARKUP and (here.digest not in templates or here.tag in ("body", "html")):
                kept.add(id(here))
        return kept, inside
    around = _around_content(order) if any(x.cued or x.outer_drop for x, _ in order) else set()
    for here, parent in order[1:]:
        if id(parent) in inside or here.tag in ("article", "main"):
            inside.add(id(here))
        in_article = id(parent) in inside
        template = here.digest in templates and here.tag not in ("article", "main", "body", "html") and not (in_article and here.tag in TEXT_BLOCKS)
        named = here.inside_cued if in_article else here.cued or here.outer_drop
        if id(parent) in kept and not (here.drop or named and id(here) not in around or template):
            kept.add(id(here))
    return kept, inside


def _main(order: Order, kept: set[int]) -> list[Element]:
    """The marked article: main if there is one, a single article inside it, else the outermost articles, else the whole page."""
    left = [(x, p) for x, p in order if id(x) in kept]

    def outermost(tag: str) -> tuple[list[Element], set[int]]:
        tops, nested = [], set()
        for x, p in left:
            if p is not None and id(p) in nested:
                nested.add(id(x))
            elif x.tag == tag:
                tops.append(x)
                nested.add(id(x))
        return tops, nested

    mains, within = outermost("main")
    articles, _ = outermost("article")
    if mains:
        own = [a for a in articles if id(a) in within]
        return own if len(own) == 1 else mains
    return articles or [order[0][0]]


def blocks_of(tops: list[Element], kept: set[int]) -> list[str]:
    """Text of every block, in page order, white space folded; blocks without text are left out."""
    out: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(piece)).split())
        if text:
            out.append(text)
        piece.clear()

    for top in tops:
        todo: list = [top]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                piece.append(x)
            elif id(x) in kept:
                if x.tag == "br":
                    piece.append(" ")
                if x.tag in BLOCKS or x is top:
                    flush()
                    todo.append(None)
                todo += reversed(x.parts)
        flush()
    return out


def _digest(order: Order) -> None:
    """Hashes of all subtrees, children first: tag, classes, child hashes and folded text."""
    for here, _ in reversed(order):
        h = xxhash.xxh3_64(f"{here.tag}\x00{here.names}\x00")
        for x in here.parts:
            h.update(x.digest.to_bytes(8, "little", signed=True) if isinstance(x, Element) else " ".join(x.split()).encode("utf-8", "surrogatepass"))
        here.digest = h.intdigest() - (1 << 63)


def _tops(order: Order, kept: set[int], names: bool) -> list[Element]:
    return _main(order, kept) if names else [order[0][0]]


def _telling(order: Order, kept: set[int], tops: list[Element]) -> set[int]:
    """id() of the elements without which the page may have another text: kept ones in the main text; all kept ones if an article could go with what holds it, as the main text is then elsewhere."""
    holds, within = set(), {id(x) for x in tops}
    for x, p in reversed(order):
        if p is not None and (id(x) in holds or x.tag in ("article", "main")):
            holds.add(id(p))
    if any(id(x) in holds and id(x) in kept and x.tag not in ("html", "body", "article", "main") for x, _ in order[1:]):
        return kept
    for x, p in order[1:]:
        if id(p) in within:
            within.add(id(x))
    return kept & within


def _subtrees(names: bool):
    """(host, page, content, digest): every block-level subtree of a page, once, under a fingerprint of the page's text; article and main and the text blocks inside them aren't counted, as they stay.

    The page is null where the subtree counts for its host, but the page's text is the same without it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, numbers, contents, digests = [], [], [], []
            host, number, page = b.column("host"), b.column("page"), b.column("html")
            for k in range(b.num_rows):
                order = in_order(parse(page[k].as_py() or ""))
                _digest(order)
                kept, inside = _kept(order, names=names)
                tops = _tops(order, kept, names)
                telling = _telling(order, kept, tops)
                content = xxhash.xxh3_64_intdigest("\n".join(blocks_of(tops, kept)).encode("utf-8", "surrogatepass")) - (1 << 63)
                whole = ("html", "body", "article", "main") if names else ("html", "body")
                found: dict[int, int | None] = {}
                for x, p in order[1:]:
                    if x.tag in BLOCKS and x.tag not in whole and x.parts and not (id(p) in inside and x.tag in TEXT_BLOCKS):
                        found[x.digest] = number[k].as_py() if id(x) in telling else found.get(x.digest)
                hosts += [host[k].as_py()] * len(found)
                numbers += found.values()
                contents += [content] * len(found)
                digests += found
            yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "page": pa.array(numbers, pa.int64()), "content": pa.array(contents, pa.int64()), "digest": pa.array(digests, pa.int64())})

    return run


def _found(pages: DataFrame, names: bool) -> DataFrame:
    """The subtrees of (host, page, html); written, as pages are parsed here and several sums read it."""
    return persisted(pages.where(F.col("host").isNotNull()).select("host", "page", "html").mapInArrow(_subtrees(names), "host string, page bigint, content bigint, digest bigint"))


def _recurring(found: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """(host, digest, n): subtrees on n pages of different content of their host, where these are enough."""
    contents = found.select("host", "content", "digest").distinct()
    sizes = contents.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    counts = contents.groupBy("host", "digest").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    return counts.join(sizes, "host").where(F.col("n") >= least_share * F.col("pages")).select("host", "digest", "n")


def site_templates(pages: DataFrame, *, least_pages: int = 4, least_share: float = 0.01, names: bool = True) -> DataFrame:
    """(host, templates array<bigint>) from (host, html): subtrees on at least least_pages pages of different content and that share of the host's.

    A host's array holds at most the mean number of subtrees of its pages / least_share.
    """
    found = _found(pages.withColumn("page", F.xxhash64("html")), names)
    return _recurring(found, least_pages, least_share).groupBy("host").agg(F.collect_list("digest").alias("templates"))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, least_pages: int = 4, least_share: float = 0.01, names: bool = True) -> DataFrame:
    """(id_col, url_col, text) for every page: its main text, blocks joined by two line breaks; "" where there is none.

    A page is read without what recurs on at least least_pages pages of different content, and that share of all pages, of its host; see above.
    Without names no tag, role, class or marked article says anything: recurrence alone decides, and only scripts, styles, heads and media go besides.
    Null html counts as empty. Pages whose URL is null or has no host are read without a template. Repeated rows and null
    identifiers keep a row each. An empty table gives an empty result. Other columns are ignored.

    A page meets the digests of those of its own templates that bear on its text, joined by host and a hash of the page: neither a large host nor its list of
    templates is a key or a value of that join, and where pages mark their articles hardly any page has a partner. (Pages of one host that share a hash share their templates, which does no harm.)
    """
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), F.lower(F.try_parse_url(F.col(url_col), F.lit("HOST"))).alias("host")).withColumn("page", F.xxhash64("html"))
    found = _found(base, names)
    templates = persisted(_recurring(found, least_pages, least_share).select(F.col("host").alias("on_host"), F.col("digest").alias("template"), "n"))
    telling = found.where(F.col("page").isNotNull()).select("host", "page", "digest")
    met = join_counted(telling, templates, lambda t: (F.col("host") == t["on_host"]) & (F.col("digest") == t["template"]), telling.count())
    # Written first, so that the join below deals both sides anew and can split what many copies of a page share.
    own = persisted(met.groupBy("host", "page").agg(F.collect_set("digest").alias("templates")))
    superseded(found, templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page, template, texts = b.column("html"), b.column("templates"), []
            for k in range(b.num_rows):
                order = in_order(parse(page[k].as_py() or ""))
                known = template[k].as_py()
                if known:
                    _digest(order)
                kept, _ = _kept(order, frozenset(known or ()), names)
                texts.append("\n\n".join(blocks_of(_tops(order, kept, names), kept)))
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "url": b.column("url"), "text": pa.array(texts, pa.string())})

    kinds = dict(base.dtypes)
    out = base.join(own, ["host", "page"], "left").select("id", "url", "html", "templates").mapInArrow(run, f"id {kinds['id']}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
