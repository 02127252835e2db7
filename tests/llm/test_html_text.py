import random
import re
import time
from collections import defaultdict
from html.parser import HTMLParser

from pyspark.sql import functions as F

from barloom.llm.html_text import blocks_of, extract_text, in_order, parse, site_templates, _digest, _kept, _main
from barloom.llm.queries import op9_html_text

PAGES = "page_id bigint, url string, html string, text string"


def text(page):
    order = in_order(parse(page))
    kept, _ = _kept(order)
    return "\n\n".join(blocks_of(_main(order, kept), kept))


def test_marked_article():
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li></ul></nav><!-- ad 0 -->'
        '<div class="ad">Buy</div><article><h1>Head &amp; more</h1><p><b>one\n  two<br><p>three &lt;x&gt; &eacute;&#8217;</p><section id="comments"><p>nice</p></section></article><footer>&copy; x</footer></body></html>'
    )
    assert text(page) == "Head & more\n\none two\n\nthree <x> é’"


def test_unmarked_and_broken_pages():
    assert text("") == "" and text("plain  text") == "plain text"
    assert text("<p>a<p>b<div>c</div>d") == "a\n\nb\n\nc\n\nd"
    assert text("<article><p>a &amp; b &am") == "a & b &am"
    assert text("<article><p>a</p><p>b</artic") == "a\n\nb"
    assert text("<article><p>a</p><!-- open <p>b") == "a"
    assert text('<p title="x>y">a</p><p title="open>b</p>') == "a\n\nb"
    assert text("<div class='cookie-notice'>c</div><main><header><h1>H</h1></header><p>t</p><aside>s</aside><form>f</form></main>") == "H\n\nt"
    assert text("<header>site</header><div>body &nbsp; text</div><div role=navigation>n</div><p hidden>no</p>") == "body text"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\n\nb\n\nc\n\nd"
    assert text("<article>" + "<b>" * 3000 + "deep" + "</b>" * 3000 + "</article>") == "deep"


def test_names_around_the_content_delete_nothing():
    article = "<article><h1>H</h1><p>t</p><div class='share'>s</div></article>"
    for around in ("div class='content has-sidebar'", "div id='page' class='no-sidebar'", "section class='social-science'", "form action='/'", "div class='top'"):
        assert text(f"<nav>n</nav><{around}>{article}<div class='ad'>Buy</div></{around.split()[0]}>") == "H\n\nt", around
    assert text("<div class='no-sidebar'><p>A long enough story.</p><div class='ad'><p>Buy</p></div></div><div class='related'><p>More</p></div>") == "A long enough story."
    assert text("<article><p>t</p></article><div class='related'><article><p>More</p></article></div>") == "t"
    assert text("<article><p>t</p></article><aside class='x'><article><p>More</p></article></aside>") == "t"


def test_inside_an_article_only_whole_names_count():
    article = "<article><p>a</p><section class='related-work'><p>b</p></section><table><tr><td class='notice'>c</td></tr></table><p class='social-science'>d</p>{}</article>"
    for own in ("<div class='ad'>x</div>", "<section class='x comments'><p>x</p></section>", "<article class='comment'><p>x</p></article>", "<form><p>x</p></form>"):
        assert text(article.format(own)) == "a\n\nb\n\nc\n\nd", own
    assert text("<form id='aspnetForm'><div>menu</div><article><p>a</p></article></form>") == "a"


def test_parsing_takes_linear_time():
    n = 50_000
    began = time.process_time()
    assert text("<b>" * n + "</i>" * n + "x") == "x"
    assert text("<article>" + "<b><div>" + "<i>" * n + "</b>" * n + "x") == "x"
    assert text("<main>" * n + "x") == "x" and text("<ul>" + "<li>x" * n).count("x") == n
    assert time.process_time() - began < 12
    assert text("<i>a<div>b</i>c</div>d</i>e<p>f<ul><li>g<ul><li>h</ul><li>i") == "a\n\nbc\n\nde\n\nf\n\ng\n\nh\n\ni"


def test_attributes_count_as_whole_names_only():
    for own in ("title='The hidden river'", "data-state='hidden'", "data-id='ad'", "data-hidden='false'", "data-class=ad", 'title="role=navigation"', "aria-hidden='false'"):
        assert text(f"<article><p>a</p><p {own}>b</p></article>") == "a\n\nb", own
    for own in ("hidden", "HIDDEN=''", "aria-hidden=true", "style='display: none'", "class = 'ad'", "data-x='y' id=ad", "role=\"navigation\""):
        assert text(f"<article><p>a</p><p {own}>b</p></article>") == "a", own


def test_templates_are_removed_per_host(spark):
    soup = lambda k: f"<html><body><div class='c1'>Our site for everything</div><div><p>Story {k} begins.</p><p>It ends {k}.</p></div><div class='c2'><p>All rights here</p></div></body></html>"
    pages = [(k, f"http://a.example/{k}", soup(k), "clash") for k in range(12)] + [(100 + k, f"http://b{k}.example/", soup(k), None) for k in range(3)]
    pages += [(200 + k, "http://copies.example/", "<article><p>Same text</p><p>again</p></article>", None) for k in range(9)]
    pages += [(300, None, soup(1), None), (301, "not a url", None, None), (None, "http://a.example/x", soup(99), None), (302, "http://a.example/y", "", None)]
    got = extract_text(spark.createDataFrame(pages, PAGES)).collect()
    assert len(got) == len(pages)
    by_id = {r.page_id: r.text for r in got}
    assert all(by_id[k] == f"Story {k} begins.\n\nIt ends {k}." for k in range(12)) and by_id[None] == "Story 99 begins.\n\nIt ends 99."
    assert by_id[100] == "Our site for everything\n\nStory 0 begins.\n\nIt ends 0.\n\nAll rights here"
    assert by_id[205] == "Same text\n\nagain" and by_id[301] == "" and by_id[302] == ""
    assert extract_text(spark.createDataFrame([], PAGES)).collect() == []


def test_templates_equal_a_count_per_host(spark):
    """Against a count of serialised elements of well-formed pages, host by host; what recurs is in no name list, and removal changes the text."""
    rng = random.Random(4)
    pages, seen, contents = [], defaultdict(lambda: defaultdict(set)), defaultdict(set)
    for k in range(120):
        host = f"h{k % 7 % 3}.example"
        parts = [f"<div class='k{j}'><p>Part {j} of {host}.</p></div>" for j in range(8) if rng.random() < 0.08 * j]
        story = f"<div><p>Story {rng.randint(0, 60)} starts.</p></div>"
        rng.shuffle(parts)
        html = "<body>" + "".join([*parts[:2], story, *parts[2:]]) + "</body>"
        pages.append((k, f"http://{host}/{k}", html, None))
        contents[host].add(html)
        for part in [*parts, story]:
            seen[host][part].add(html)
            seen[host][part[part.index("<p>") : -6]].add(html)
    least = {(h, part) for h, found in seen.items() for part, where in found.items() if len(where) >= max(4, 0.01 * len(contents[h]))}

    def digest(part):
        root = parse(part)
        _digest(in_order(root))
        return root.parts[0].digest

    df = spark.createDataFrame(pages, PAGES)
    got = site_templates(df.select(F.regexp_extract("url", "//([^/]+)", 1).alias("host"), "html"))
    assert {(r.host, d) for r in got.collect() for d in r.templates} == {(h, digest(part)) for h, part in least} and len(least) > 20
    whole = {r.page_id: r.text for r in extract_text(df, least_pages=10**6).collect()}
    for r in extract_text(df).collect():
        html, host = pages[r.page_id][2], pages[r.page_id][1].split("/")[2]
        left = [t for part, t in re.findall(r"(<div[^>]*><p>([^<]*)</p></div>)", html) if (host, part) not in least and (host, f"<p>{t}</p>") not in least]
        assert r.text == "\n\n".join(left)
    assert sum(len(whole[r.page_id]) > len(r.text) for r in extract_text(df).collect()) > 60


def test_recurring_parts_of_the_given_pages_are_templates(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = site_templates(pages.select(F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"), "html"))
    assert got.agg(F.sum(F.size("templates"))).first()[0] > 100


def test_query_returns_articles_whole(spark):
    got = op9_html_text(spark, "/root/testdata/sf0.01")
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert len(rows) == 250 and all(r.n_chars == len(r.text) > 0 for r in rows)
    assert not any("<p>" in r.text or "track(" in r.text or "©" in r.text for r in rows)


class Articles(HTMLParser):
    """A twin of its own for the given pages: the text between <article> and </article> without what is marked as an advert, a form, comments or a list of links, read by the standard parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.gone, self.blocks, self.piece = 0, [], [], ""
        self.feed(page)
        self.close()

    def cut(self):
        if words := self.piece.split():
            self.blocks.append(" ".join(words))
        self.piece = ""

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.depth += 1
        if tag == "br":
            self.piece += " "
        elif tag not in ("a", "b", "i", "em", "strong", "span"):
            self.cut()
        if self.gone:
            self.gone += [tag] * (tag == self.gone[0])
        elif tag in ("script", "style", "nav", "form", "aside", "footer") or {"ad", "comments", "share", "related"} & set((dict(attrs).get("class") or "").split()):
            self.gone = [tag]

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.cut()
        if self.gone and tag == self.gone[0]:
            self.gone.pop()
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth > 0 and not self.gone:
            self.piece += data


def test_query_equals_another_parser(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()}
    got = op9_html_text(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == len(pages) > 2000
    assert [r.page_id for r in got if r.text != "\n\n".join(Articles(pages[r.page_id]).blocks)] == []


def test_recurrence_alone_removes_templates_of_the_given_pages(spark):
    """With all names off, removal changes pages, and a block of text only goes where at least four pages of its host hold it."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    host = {r.page_id: r.host for r in pages.select("page_id", F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host")).collect()}
    whole = {r.page_id: r.text.split("\n\n") for r in extract_text(pages, names=False, least_pages=10**6).collect()}
    found = {r.page_id: r.text.split("\n\n") for r in extract_text(pages, names=False).collect()}
    on = defaultdict(int)
    for k, blocks in whole.items():
        for block in set(blocks):
            on[host[k], block] += 1
    lost = {k: set(blocks) - set(found[k]) for k, blocks in whole.items()}
    assert sum(bool(x) for x in lost.values()) > 500
    assert all(on[host[k], block] >= 4 for k, blocks in lost.items() for block in blocks)


def test_pages_of_one_host_share_no_list_of_templates(spark):
    """A page meets the digests that it holds itself, copies and pages of equal text included."""
    page = lambda k, j: f"<body><div><p>Welcome {j}</p></div><div><p>Story {k}</p></div></body>"
    rows = [(k, "http://a.example/", page(k, k % 5), None) for k in range(40)] + [(100 + k, "http://a.example/", page(7, 2), None) for k in range(30)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {**{k: f"Story {k}" for k in range(40)}, **{100 + k: "Story 7" for k in range(30)}}


def test_subtrees_that_do_not_bear_on_the_text_are_rightly_left_out(spark):
    """Pages with all host templates at hand have the text that the join of own and telling ones gives."""
    rng = random.Random(9)
    bits = ["<nav><ul><li>a</li></ul></nav>", "<div class='x'><article><p>T</p></article></div>", "<article><h1>H</h1><ul><li>s</li></ul><p>{}</p></article>", "<div><p>all {}</p></div>", "<main><div><p>m</p></div><article><p>{}</p></article></main>", "<section><div>u</div><p>{}</p></section>", "<footer><p>f</p></footer>", "<div class='ad'><p>b</p></div>"]
    rows = [(k, f"http://h{k % 3}.example/{k}", "<body>" + "".join(rng.choice(bits).format(rng.randint(0, 40)) for _ in range(rng.randint(1, 6))) + "</body>", None) for k in range(200)]
    df = spark.createDataFrame(rows, PAGES)
    known = {r.host: frozenset(r.templates) for r in site_templates(df.select(F.regexp_extract("url", "//([^/]+)", 1).alias("host"), "html")).collect()}
    changed = 0
    for r in extract_text(df).collect():
        order = in_order(parse(rows[r.page_id][2]))
        _digest(order)
        kept, _ = _kept(order, known[f"h{r.page_id % 3}.example"])
        assert r.text == "\n\n".join(blocks_of(_main(order, kept), kept)), rows[r.page_id]
        changed += r.text != text(rows[r.page_id][2])
    assert changed > 50
