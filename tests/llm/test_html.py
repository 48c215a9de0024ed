from __future__ import annotations

from html.parser import HTMLParser

from relievo.llm import html_text
from tests.llm.fixtures import prose

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">menu</a></li></ul></nav><!-- ad --><div class="ad">buy</div><header>site</header>
<article><h1>Head &amp; line</h1><p><b>One  two<br><p>three&nbsp;four</p><aside>side</aside><form><input>f</form>
<div class="comments"><p>first!</p></div><ul><li>x<li>y</ul><p>a < b</p></article><footer>&copy; foot</footer></body>"""


def test_article_without_noise():
    assert html_text.main_text(PAGE) == "Head & line\nOne two\nthree four\nx\ny\na < b"


def test_cut_off_pages_and_odd_input():
    for k in range(len(PAGE)):
        html_text.main_text(PAGE[:k])
    assert html_text.main_text("") == "" and html_text.main_text("plain &lt; text") == "plain < text"
    assert html_text.main_text("<p>a<p>b") == "a\nb"
    deep = "<div>" * 20000 + "x"
    assert html_text.main_text(deep) == "x"
    assert html_text.main_text("<article>" + "<p>word</p>" * 5000) == "\n".join(["word"] * 5000)


def test_only_whole_attribute_names_count():
    for kept in ("hidden", 'aria-hidden="true"', "class=share", "class=related", "role=search", 'style="overflow:hidden"', 'title="hidden gem"', "title='a id=ad'", 'data-id="comment-5"', "data-class=ad", "data-x=class"):
        page = f"<article><p>a</p><div {kept}><p>text</p></div></article>"
        assert html_text.main_text(page) == "a\ntext", kept
    for dropped in ("id=comments", "title='x' class = 'a ad'", "role=navigation", 'class="cookie-notice"'):
        assert html_text.main_text(f"<article><p>a</p><div {dropped}><p>text</p></div></article>") == "a", dropped


#: Pages that keep what a name, or a part of one, must not cost them.
KEPT = {
    "<div class='layout no-sidebar'><article><h1>T</h1><p>text</p></article></div>": "T\ntext",
    "<div id='page' class='has-comments'><article><p>text</p></article></div>": "text",
    "<div class='site-header-main'><article><p>text</p></article></div>": "text",
    "<div class='sidebar'><article><p>text</p></article></div>": "text",
    "<div class='sidebar'><article><p>teaser</p></article></div><article><p>text</p></article>": "text",
    "<div class='sidebar'><article><p>teaser</p></article></div><main><p>text</p></main>": "text",
    "<article><div class='article-header'><h1>Title</h1><p>Lead</p></div><p>a</p></article>": "Title\nLead\na",
    "<article><div class='header'><h1>Title</h1></div><p>a</p><div class='header'>menu</div></article>": "Title\na",
    "<article><table><tr class='header'><th>Year</th></tr><tr><td>1</td></tr></table></article>": "Year\n1",
    "<article><p class='safety-notice'>Mind the gap.</p><p class='notice'>We moved.</p></article>": "Mind the gap.",
    "<article><p>Let <math>x = 2</math> hold.</p></article>": "Let x = 2 hold.",
    "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p></article>": "Let x=2 hold.",
    "<article><p>The <label>big</label> one</p><form><label>Name</label></form></article>": "The big one",
    "<article><p>a</p><div class='user-reactions'><p>first!</p></div><section id=Disqus_Thread>x</section></article>": "a",
    "<article><p>a</p></article><div class=comments><article class=comment><p>first!</p></article></div>": "a",
    "<article><p>a</p></article><article class=comment><p>first!</p></article>": "a",
    "<div class=comments><article><p>first!</p></article></div><p>b</p>": "b",
    "<article><pre><span class='comment'># note</span> x = 1</pre><h2 class='ad'>b</h2></article>": "# note x = 1\nb",
    "<aside><article><p>teaser</p></article></aside><p>b</p>": "b",
    "<article><noscript>Switch scripts on</noscript><p>a</p></article>": "a",
}


def test_names_are_taken_whole():
    for page, text in KEPT.items():
        assert html_text.main_text(page) == text, page


class Plain(HTMLParser):
    """The article's text by the library's parser, for pages whose elements are closed and whose noise is named by one word."""

    LEFT_OUT = {"nav", "footer", "aside", "form", "script", "style", "head", "noscript"}
    SINGLE = {"br", "meta", "img", "hr", "input"}
    BREAKS = {"p", "li", "ul", "ol", "div", "h1", "h2", "h3", "br", "article", "section", "table", "tr", "td", "th", "body", "html", "nav", "footer"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.text, self.articles = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in self.BREAKS:
            self.text.append("\n")
        if tag not in self.SINGLE:
            names = set((dict(attrs).get("class") or "").split())
            self.open.append((tag, tag in self.LEFT_OUT or bool(names & {"ad", "comments", "sidebar"})))
            self.articles += tag == "article"

    def handle_endtag(self, tag):
        if tag in self.BREAKS:
            self.text.append("\n")
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.open) and not any(out for _, out in self.open):
            self.text.append(data.replace("\n", " "))

    @classmethod
    def of(cls, page):
        parser = cls()
        parser.feed(page)
        parser.close()
        lines = (" ".join(x.split()) for x in "".join(parser.text).split("\n"))
        return "\n".join(x for x in lines if x)


def test_given_pages_against_the_library_parser(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = {r["page_id"]: Plain.of(r["html"] or "") for r in table.collect()}
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(table).collect()}
    assert len(got) == 2500 and all(n == len(t) for t, n in got.values())
    assert {k: t for k, (t, _) in got.items()} == want and min(map(len, want.values())) > 0


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, hashes int, host string")


def test_templates_go_from_pages_without_an_article(spark):
    shared = "<div><p>Welcome to our site</p></div>"
    rows = [(k, f"http://Example.org:80/{k}", f"<body>{shared}<p>own text {k}</p></body>", "t", 1, "h") for k in range(8)]
    rows += [(100 + k, f"http://other.org/{k}", f"<article>{shared}<p>kept {k}</p></article>", None, 1, None) for k in range(8)]
    rows += [(200, None, None, None, None, None), (None, "x", "", None, None, None), (201, "http://one.org", shared, None, None, None)]
    rows += rows[-1:]
    out = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(pages(spark, rows)).collect()), key=repr)
    assert len(out) == len(rows)
    by = dict((p, t) for p, t, _ in out)
    assert by[3] == "own text 3" and by[103] == "Welcome to our site\nkept 3" and by[200] == "" and by[None] == ""
    assert by[201] == "Welcome to our site" and all(n == len(t) for _, t, n in out)
    assert html_text.extract(pages(spark, [])).count() == 0


def test_an_article_keeps_its_header():
    page = "<header><h1>Site</h1></header><article><header><h1>Title</h1><p>by</p></header><header>nav</header><p>a</p><h2 class=comments>b</h2></article>"
    assert html_text.main_text(page) == "Title\nby\na\nb"


def brute(rows):
    """Texts by page, with the templates counted in plain Python over all pages."""
    parsed = []
    for page_id, url, page, *_ in rows:
        page = page or ""
        root, nodes = html_text.parse(page)
        name = url.split("/")[2].split(":")[0].lower() if url and "://" in url else ""
        parsed.append((page_id, name, page, html_text.blocks_of(root, nodes, html_text.main_elements(nodes))[1]))
    host_pages, on, longest, second = {}, {}, {}, {}
    for _, name, page, blocks in parsed:
        host_pages.setdefault(name, set()).add(page)
        for kind, h, a, b in blocks:
            on.setdefault((name, kind, h), set()).add(page)
            longest.setdefault((name, kind, h), set()).update({a} - {None})
            second.setdefault((name, kind, h), set()).update({b} - {None})

    def is_template(key):
        name, kind, _ = key
        h, n = len(host_pages[name]), len(on[key])
        varied = kind == html_text.AROUND or min(len(longest[key]), len(second[key])) >= 0.5 * n
        if kind == html_text.INSIDE:
            return n >= 8 and n >= 0.5 * h and varied
        share = 0.2 if h <= 500 else 100 / h if h <= 5000 else 0.02
        return n >= 5 and n >= share * h and varied

    out = []
    for page_id, name, page, blocks in parsed:
        out.append((page_id, html_text.main_text(page, {h for kind, h, *_ in blocks if kind != html_text.AROUND and is_template((name, kind, h))})))
    return out


def site(seed, n, host, article, notice):
    """Pages of running text; most hold one more block at a place of its own."""
    out = []
    for k in range(n):
        parts = [f"<p>{prose(seed + 50 * k + i, 12 + i)}</p>" for i in range(4)]
        if notice and k % 5:
            parts.insert(k % 5, notice)
        body = "".join(parts)
        out.append((seed + k, f"https://{host}/{k}", f"<body>{'<article>' + body + '</article>' if article else body}</body>", None, None, None))
    return out


def test_templates_against_counts_in_plain_python(spark):
    notice = "<div><p>Read more on our site</p><p>Or write to us</p></div>"
    rows = site(1000, 30, "a.org", True, notice) + site(3000, 30, "b.org", False, notice) + site(5000, 6, "few.org", True, notice)
    rows += site(7000, 30, "c.org", True, None)
    base = [f"<p>{prose(90 + i, 20)}</p>" for i in range(5)]
    for k in range(40):  # near copies of one article: their paragraphs are no templates
        for article, host in ((True, "copies.org"), (False, "copies2.org")):
            parts = list(base)
            parts[k % 5] = f"<p>{prose(90 + k % 5, 20)} {prose(400 + k, 2)}</p>"
            body = "".join(parts)
            rows.append((9000 + k + 100 * article, f"https://{host}/{k}", f"<article>{body}</article>" if article else body, None, None, None))
    rows += [rows[0]] * 50  # one page many times
    got = sorted(((r["page_id"], r["text"]) for r in html_text.extract(pages(spark, rows)).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)
    texts = {}
    for page_id, text in got:
        texts.setdefault(page_id, text)
    for first, n, gone in ((1000, 30, True), (3000, 30, True), (5000, 6, False)):
        assert all(("Read more" in texts[first + k]) == (not gone and k % 5 > 0) for k in range(n))
    assert all(len(texts[7000 + k].split("\n")) == 4 for k in range(30))
    assert all(len(texts[p].split("\n")) == 5 for p in texts if p >= 9000)
    told = {(r["main"], r["kind"]): r["n_pages"] for r in html_text.decisions(pages(spark, rows)).collect()}
    assert told == {("article", html_text.INSIDE): 24, ("body", html_text.BODY): 24}


def test_a_hot_host(spark):
    """A third of all pages on one host; a notice on 3 % of them goes, a line on fewer stays."""
    rows = []
    for k in range(6000):
        extra = "<p>Rotating offer</p>" if k % 30 == 0 else "<p>Seldom seen</p>" if k % 100 == 1 else ""
        rows.append((k, f"https://{'hot.org' if k % 3 < 2 else f'h{k}.org'}/{k}", f"<p>{prose(k, 9)}</p>{extra}<p>{prose(k + 7, 7)}</p>", None, None, None))
    got = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    assert got == dict(brute(rows))
    assert not any("Rotating" in t for t in got.values()) and any("Seldom" in t for t in got.values())
