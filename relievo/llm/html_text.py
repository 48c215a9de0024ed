"""Main text of web pages, with site templates removed.

Every block element of a page is hashed with its subtree. Spark counts, for each
host, the distinct pages that a hash occurs in and how much these pages differ
otherwise, and the subtrees that recur across many different pages of their host
are deleted. There are three kinds of them, counted apart:

* around a page's main element (its article, or else main element): counted and
  reported, but such text is not part of the result anyway;
* in the body of pages without a main element: template from LEAST_PAGES pages and
  LEAST_SHARE of the host's pages on (for large hosts a smaller share, see
  :func:`templates`);
* inside the main element: template from INNER_PAGES pages and INNER_SHARE of the
  host's pages on, and never a heading.

In the last two kinds the pages must differ otherwise, or the articles of a host
that holds copies would be templates: a subtree's pages have to have as many
different longest other lines, and different second longest ones, as VARIED times
their number. What remains loses the elements that are never
main text by their kind (menus, headers, footers, asides, forms, scripts and so on)
or by their class, id or role where one of its names, taken whole, stands for such a kind, an
advert, a notice or comments: ``no-sidebar`` and ``safety-notice`` do not. Parts of tables, headings
and what stands in code are never noise by name. A header with a heading inside an article belongs to
the article. Formulas and labels in running text are text; the content of noscript, which is
shown in place of a script, is not.

An article inside of what is noise by its class or id counts if the page has no other article and no
main element, unless it stands among comments: a name never costs a page its article.

Defined cases: null html is the empty page, whose text is empty; a null or
malformed url shares the host ''; a null page_id is kept; repeated rows come back
as often as they went in and count once; of several main elements all count, in
page order; lines of equal length are taken in page order; an empty table gives an
empty result; pages are taken whole however long, and markup may be cut off
anywhere; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relievo.plans.storage import materialize
from relievo.plans.text import text_or_empty

#: A subtree is template when it occurs in so many pages of its host, and in this share of them.
LEAST_PAGES, LEAST_SHARE = 5, 0.2
#: On hosts from LEAST_PAGES / LEAST_SHARE pages on, so many pages do where they are this smaller share.
MANY_PAGES, MANY_SHARE = 100, 0.02
#: The same inside main elements.
INNER_PAGES, INNER_SHARE = 8, 0.5
#: Share of a template's pages that differ in their other text.
VARIED = 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg".split())
_NEVER = frozenset(
    "nav header footer aside form script style noscript template iframe svg canvas video audio object "
    "select button textarea input fieldset dialog menu head title xmp noembed noframes".split()
)
_BLOCK = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: These start tags end an open p.
_ENDS_P = _BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary form dialog alert menu menubar".split())
#: Whole names in class and id, with hyphens for underscores, of headers, of comments, and of all that is never main text.
_HEADS = frozenset("header masthead site-header page-header main-header".split())
_COMMENTS = frozenset(
    "comment comments comment-list comments-list commentlist comment-section comments-section comment-area comments-area comment-form comments-form "
    "reader-comments user-comments disqus disqus-thread replies reply-list reactions user-reactions".split()
)
_NOTED = _HEADS | _COMMENTS | frozenset(
    "ad ads adbox ad-box ads-box adslot ad-slot adunit ad-unit ad-banner ads-banner ad-container ad-wrapper adsbygoogle advert adverts advertisement advertisements advertising "
    "sponsor sponsors sponsored sponsored-content promo promos promotion promotions banner "
    "cookie cookies cookie-notice cookie-banner cookie-bar cookie-consent cookie-popup consent consent-banner consent-popup gdpr gdpr-notice gdpr-banner "
    "notice notices site-notice popup modal newsletter newsletter-signup newsletter-form subscribe signup sign-up "
    "menu menus main-menu nav-menu nav navbar nav-bar main-nav site-nav top-nav side-nav sidenav navigation main-navigation site-navigation breadcrumb breadcrumbs "
    "sidebar side-bar sidebars left-sidebar right-sidebar sidebar-left sidebar-right footer site-footer page-footer main-footer".split()
)
_TABLE = frozenset("table caption colgroup col thead tbody tfoot tr td th".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
#: A name and its value; quoted values are consumed whole, also where the page is cut off.
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "parent", "parts", "skip", "named", "at", "inside", "code", "header")

    def __init__(self, tag: str, parent: _Node | None, attributes: str, at: int):
        self.tag, self.parent, self.at, self.parts = tag, parent, at, []
        # whether it is or lies in an article or in code
        self.inside = tag == "article" or parent is not None and parent.inside
        self.code = tag in ("pre", "code") or parent is not None and parent.code
        names = _names(tag, attributes) if attributes and not self.code else frozenset()
        #: noise by its name, with the names that say so; or by its kind, which an article inside cannot undo
        self.named = names
        self.skip = tag in _NEVER or bool(names)
        # the outermost header within an article
        head = tag == "header" or bool(names) and names <= _HEADS
        self.header = None if tag == "article" or parent is None else parent.header or (self if head else None)


def _names(tag: str, attributes: str) -> frozenset[str]:
    """The names in class, id and role that stand for noise."""
    if tag in ("html", "body", "main") or tag in _HEADINGS or tag in _TABLE:
        return frozenset()
    lower = attributes.lower()
    if not ("class" in lower or "id" in lower or "role" in lower):
        return frozenset()
    found = set()
    for name, *values in _ATTR.findall(attributes):
        name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
        if name == "role" and value in _ROLES:
            found.add(value)
        elif name in ("class", "id"):
            found |= _NOTED.intersection(value.replace("_", "-").split())
    return frozenset(found & _COMMENTS if tag == "article" else found)


def parse(page: str) -> tuple[_Node, list[_Node]]:
    """The page's tree and its elements in page order."""
    root = _Node("", None, "", -1)
    nodes: list[_Node] = []
    here, at, seek = root, 0, 0
    while (seek := page.find("<", seek)) >= 0:
        m = _TOKEN.match(page, seek)
        if m is None:  # a bare sign is text
            seek += 1
            continue
        if seek > at:
            here.parts.append(page[at:seek])
        at = seek = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            up = here
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                here = up.parent
            elif tag == "p":
                here.parts.append(_Node("p", here, "", -1))
            continue
        if tag in _ENDS_P:
            up = here
            while up is not root and up.tag in ("p", "b", "i", "em", "strong", "a", "span", "u", "small", "font"):
                if up.tag == "p":
                    here = up.parent
                    break
                up = up.parent
        if tag in _SIBLINGS:
            up = here
            while up is not root and up.tag not in ("ul", "ol", "dl", "table", "select", "menu"):
                if up.tag in _SIBLINGS[tag]:
                    here = up.parent
                    break
                up = up.parent
        node = _Node(tag, here, m[3], len(nodes))
        here.parts.append(node)
        nodes.append(node)
        if tag in _VOID or m[3].endswith("/") and tag == "svg":
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*/?>|\Z", re.I).search(page, at)
            node.parts.append(page[at : end.start()])
            at = seek = end.end()
            continue
        here = node
    if at < len(page):
        here.parts.append(page[at:])
    for node in nodes:
        if node.tag in _HEADINGS and node.inside and node.header is not None:
            node.header.skip = False  # the article's own header
    return root, nodes


def main_elements(nodes: list[_Node]) -> list[_Node]:
    """The page's outermost article elements outside noise, or else its main elements, or else articles that only names would hide."""
    for tag, hidden in (("article", False), ("main", False), ("article", True)):
        found = []
        for node in nodes:
            if node.tag == tag:
                up = node
                while up is not None and (up is node or up.tag != tag) and not (up.named & _COMMENTS or up.tag in _NEVER if hidden else up.skip):
                    up = up.parent
                if up is None:
                    found.append(node)
        if found:
            return found
    return []


def _digests(tops: list[_Node]) -> dict[int, int]:
    """Hashes of the given elements and of those below them, by element."""
    done: dict[int, bytes] = {}
    found: dict[int, int] = {}
    stack = [(n, False) for n in tops]
    while stack:
        n, ready = stack.pop()
        if not ready:
            stack.append((n, True))
            stack += [(c, False) for c in n.parts if not isinstance(c, str)]
            continue
        h = xxhash.xxh3_64(n.tag)
        for c in n.parts:
            h.update(_SPACE.sub(" ", c) if isinstance(c, str) else done[id(c)])
        done[id(n)] = h.digest()
        if n.at >= 0:
            found[n.at] = h.intdigest() - (1 << 63)
    return found


def _outside(root: _Node, main: list[_Node]) -> list[_Node]:
    """The outermost elements that neither are, hold nor lie in a main element."""
    around = {id(root)}
    for m in main:
        while m is not None:
            around.add(id(m))
            m = m.parent
    ends = {id(m) for m in main}
    tops, stack = [], [root]
    while stack:
        for c in stack.pop().parts:
            if isinstance(c, str) or id(c) in ends:
                continue
            if id(c) in around or c.tag in ("html", "body"):
                stack.append(c)
            else:
                tops.append(c)
    return tops


def _lines(tops: list[_Node], dropped: set[int]) -> tuple[list[str], dict[int, tuple[int, int]]]:
    """The text block by block, some empty, and the range of blocks of each block element by its number."""
    blocks: list[list[str]] = [[]]
    ranges: dict[int, tuple[int, int]] = {}
    for top in tops:
        blocks.append([])
        stack: list = [top]
        while stack:
            n = stack.pop()
            if isinstance(n, tuple):
                ranges[n[0]] = n[1], len(blocks)
                blocks.append([])
            elif isinstance(n, str):
                blocks[-1].append(n)
            elif not (n.skip or n.at in dropped):
                if n.tag in _BLOCK:
                    blocks.append([])
                    stack.append((n.at, len(blocks) - 1))
                stack += reversed(n.parts)
    return [" ".join(entities.unescape("".join(b)).split()) for b in blocks], ranges


def _longest(lines: list[str], found: list[int]) -> list[int]:
    """The two longest of some lines, the first ones of equal length."""
    return sorted(found, key=lambda i: (-len(lines[i]), i))[:2]


def _rest(lines: list[str]) -> tuple[list[list[int]], list[list[int]]]:
    """The two longest lines before each place, and from it on."""
    before: list[list[int]] = [[]]
    for i, x in enumerate(lines):
        before.append(_longest(lines, [*before[-1], i]) if x else before[-1])
    after: list[list[int]] = [[]]
    for i in range(len(lines) - 1, -1, -1):
        after.append(_longest(lines, [*after[-1], i]) if lines[i] else after[-1])
    return before, after[::-1]


#: Kinds of subtrees by where they are.
AROUND, BODY, INSIDE = 0, 1, 2


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def blocks_of(root: _Node, nodes: list[_Node], main: list[_Node]) -> tuple[str, list[tuple[int, int, int | None, int | None]]]:
    """The page's text before templates go, and ``(kind, hash, longest, second)`` of its candidates for templates.

    The last two are hashes of the two longest lines of the text outside the
    subtree; in a body with one other line it is both, in a main element it has no
    second. A hash is given once for a page and kind.
    """
    lines, ranges = _lines(main or [root], set())
    before, after = _rest(lines)
    tops = {id(m) for m in main}
    seen: dict[tuple[int, int], tuple] = {}
    for at, h in _digests(main or [root]).items():
        n = nodes[at]
        if at in ranges and id(n) not in tops and n.tag not in ("html", "body", "main", "br", "hr") and not (main and n.tag in _HEADINGS):
            lo, hi = ranges[at]
            if any(lines[lo:hi]):
                others = [_number(lines[i]) for i in _longest(lines, [*before[lo], *after[hi]])]
                kind = INSIDE if main else BODY
                others += others[:1] if kind == BODY and len(others) == 1 else []
                seen.setdefault((kind, h), (kind, h, *[*others, None, None][:2]))
    if main:
        for at, h in _digests(_outside(root, main)).items():
            if nodes[at].tag in _BLOCK and nodes[at].tag not in ("br", "hr"):
                seen.setdefault((AROUND, h), (AROUND, h, None, None))
    return "\n".join(x for x in lines if x), list(seen.values())


def main_text(page: str, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text, without the subtrees whose hashes are in ``template``."""
    root, nodes = parse(page)
    tops = main_elements(nodes) or [root]
    dropped = {at for at, h in _digests(tops).items() if h in template and nodes[at] not in tops} if template else set()
    return "\n".join(x for x in _lines(tops, dropped)[0] if x)


def host(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


_PARSED = "page_id bigint, url string, host string, text string, main string, page binary, blocks array<struct<kind: int, hash: bigint, longest: bigint, second: bigint>>"
_BLOCKS_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("hash", pa.int64()), ("longest", pa.int64()), ("second", pa.int64())]))
_PARSED_ARROW = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("text", pa.string()), ("main", pa.string()), ("page", pa.binary()),
        ("blocks", _BLOCKS_ARROW),
    ]
)
_BLOCK_NAMES = ("kind", "hash", "longest", "second")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's text so far, what it is taken from, and its candidates for templates."""
    for batch in batches:
        texts, found, kinds = [], [], []
        for page in batch.column("html").to_pylist():
            root, nodes = parse(page)
            main = main_elements(nodes)
            text, blocks = blocks_of(root, nodes, main)
            texts.append(text)
            kinds.append(main[0].tag if main else "body")
            found.append([dict(zip(_BLOCK_NAMES, b, strict=True)) for b in blocks])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(texts, pa.string()), pa.array(kinds, pa.string()),
                batch.column("page"), pa.array(found, _BLOCKS_ARROW),
            ],
            schema=_PARSED_ARROW,
        )


def _whole(pages: DataFrame) -> DataFrame:
    """The pages with their hosts, and a 128-bit digest of their html that stands for equal pages of a host."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host().alias("host"), text_or_empty("html").alias("html"))
    return page.withColumn("page", F.unhex(F.md5(F.encode("html", "utf-8"))))


def parse_pages(pages: DataFrame) -> DataFrame:
    return _whole(pages).mapInArrow(_parsed, _PARSED)


def templates(parsed: DataFrame) -> DataFrame:
    """``(host, kind, hash, n_pages)`` of the subtrees that recur across a host's pages.

    The least number of a host's h pages is 0.2 h (5 at least) up to 500 pages, then
    100 up to 5,000 pages, then 0.02 h: a rotating notice of a large host is on a
    small share of it. Inside main elements it is 0.5 h throughout.
    """
    keys = ["host", "kind", "hash"]
    sizes = parsed.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("h"))
    blocks = parsed.select("host", "page", F.inline("blocks"))
    often = blocks.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES).select(*keys)
    told = F.array(*(F.struct(F.lit(c).alias("what"), (F.col(c) if c == "page" else F.to_binary(F.col(c).cast("string"), F.lit("utf-8"))).alias("value")) for c in ("page", "longest", "second")))
    distinct = blocks.join(often, keys).select(*keys, F.inline(told)).where("value is not null").distinct()
    counts = distinct.groupBy(*keys).agg(*(F.count_if(F.col("what") == c).alias(n) for c, n in (("page", "n_pages"), ("longest", "n_longest"), ("second", "n_second"))))
    least = F.greatest(F.lit(float(LEAST_PAGES)), F.least(LEAST_SHARE * F.col("h"), F.greatest(F.lit(float(MANY_PAGES)), MANY_SHARE * F.col("h"))))
    many = F.col("n_pages") >= F.when(F.col("kind") == INSIDE, F.greatest(F.lit(float(INNER_PAGES)), INNER_SHARE * F.col("h"))).otherwise(least)
    others = F.when(F.col("kind") == AROUND, F.col("n_pages")).otherwise(F.least("n_longest", "n_second"))
    return counts.join(sizes, "host").where(many & (others >= VARIED * F.col("n_pages"))).select(*keys, "n_pages")


_TEXTS = "host string, page binary, cleaned string"


def _without_templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = batch.column("hashes").to_pylist()
        texts = [main_text(h, frozenset(t)) for h, t in zip(batch.column("html").to_pylist(), marks, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("page"), pa.array(texts, pa.string())], names=["host", "page", "cleaned"])


def _marks(parsed: DataFrame, found: DataFrame) -> DataFrame:
    """``(host, page, main, kind, hash)`` of the templates on each different page."""
    blocks = parsed.select("host", "page", "main", F.inline("blocks").alias("kind", "hash", "longest", "second")).drop("longest", "second")
    return blocks.join(found.select("host", "kind", "hash"), ["host", "kind", "hash"]).distinct()


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars, main)`` of every page; ``main`` tells what the text is taken from (article, main or body).

    Every page is parsed once, and pages with templates in their text once more,
    from the table itself. Templates go by hash; a page's own list of them is all
    that travels to it.
    """
    parsed = materialize(parse_pages(pages), "pages")
    marks = _marks(parsed, templates(parsed).where(F.col("kind") != AROUND)).groupBy("host", "page").agg(F.collect_list("hash").alias("hashes"))
    marks = materialize(marks, "marks")
    again = _whole(pages).join(marks, ["host", "page"]).select("host", "page", "html", "hashes")
    again = materialize(again.mapInArrow(_without_templates, _TEXTS).dropDuplicates(["host", "page"]), "cleaned")
    text = F.coalesce("cleaned", "text")
    return parsed.select("host", "page", "page_id", "url", "text", "main").join(again, ["host", "page"], "left").select(
        "page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), "main"
    )


def decisions(pages: DataFrame) -> DataFrame:
    """``(main, kind, n_pages, n_subtrees)``: how many different pages have templates of each kind, by what their text is taken from."""
    parsed = materialize(parse_pages(pages), "pages")
    marks = _marks(parsed, templates(parsed))
    return marks.groupBy("main", "kind").agg(F.count_distinct("host", "page").alias("n_pages"), F.count("*").alias("n_subtrees"))
