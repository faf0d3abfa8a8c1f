"""Main text of web pages by removal of what a site repeats.

Every page becomes a tree of elements. A first scan hashes the subtrees that could be furniture and Spark counts, per host,
on pages of how many different main texts each of them stands; copies of one page count once, so that a text which
was published many times is no template. Subtrees that recur on many pages of their host are deleted in a second scan, with
menus, forms, adverts and other elements that their tag or class gives away, and what is left of the article is the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_hexdigest, xxh3_64_intdigest

from zerotally.llm.url_filter import split_url
from zerotally.workspace import materialise

#: A subtree recurs if it stands on this many different pages of its host, and on this share of them.
MANY_PAGES = 5
MANY_SHARE = 0.01
#: A run of text this long is a passage and not furniture, however many pages quote it.
PASSAGE_WORDS = 50
#: Template lists that may be joined by broadcasting; longer ones are left to a shuffle.
BROADCAST_BYTES = 64 << 20

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var br wbr img".split())
#: Elements whose text is no part of any article.
DROPPED = frozenset("head title xmp noembed noframes script style noscript template nav footer aside form button input select textarea option iframe "
                    "object svg canvas audio video dialog menu".split())
#: Words of a class, id or role that mark furniture.
MARKS = frozenset("ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion "
                  "sidebar menu nav navbar navigation breadcrumb breadcrumbs toolbar footer masthead cookie cookies consent "
                  "notice notices disclaimer popup modal overlay comment comments disqus respond reply replies newsletter "
                  "subscribe subscription signup login search share sharing social related recommended widget pagination "
                  "pager skip complementary contentinfo dialog form".split())
#: What an open element of the first kind is closed by.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"},
             "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
             "option": {"option", "optgroup"}, "tbody": {"tbody", "tfoot"}, "thead": {"tbody", "tfoot"}}
CLOSES = {tag: [kind for kind, by in CLOSED_BY.items() if tag in by] for by in CLOSED_BY.values() for tag in by}
#: Start tags that end an open paragraph.
BLOCKS = frozenset("address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tr td th tbody "
                   "thead tfoot ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of these kinds is not closed from inside by another element's tag.
SCOPES = frozenset("article aside body button div footer form header html main nav section table td th ul ol".split())
LISTS = frozenset("ul ol table select dl".split())
#: What can stand in a head; any other start tag ends it.
IN_HEAD = frozenset("html head title base link meta script style noscript template bgsound".split())


class Node:
    """An element. The slots from `hash` on are filled by `candidates`."""
    __slots__ = ("tag", "marked", "parent", "children", "hash", "words", "letters", "linked", "plain", "inside")

    def __init__(self, tag: str, marked: bool = False, parent: "Node | None" = None):
        self.tag, self.marked, self.parent, self.children = tag, marked, parent, []


#: Comments, declarations and tags as HTML reads them; a quote matters after = only.
TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|[="'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
#: Elements whose content is text up to their end tag.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in "script style textarea title xmp iframe noembed noframes".split()}


def marked(attributes: str) -> bool:
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role") and not MARKS.isdisjoint(re.split(r"[^a-z]+", "".join(values).lower())):
            return True
    return False


class TreeBuilder:
    """Elements and decoded text; unclosed elements end where an element after them, or the page, says so."""

    def __init__(self):
        self.root = Node("#page")
        self.open = [self.root]
        self.landmarks: dict[str, list[Node]] = {"article": [], "main": []}  # in page order
        self.with_links: set[int] = set()  # those that hold a link

    def start(self, tag: str, attributes: str) -> None:
        if tag not in IN_HEAD:
            self._close_to("head", SCOPES - {"html"})
        if tag in BLOCKS:
            self._close_to("p", SCOPES)
        for kind in CLOSES.get(tag, ()):
            self._close_to(kind, LISTS)
        node = Node(tag, "=" in attributes and marked(attributes), self.open[-1])
        self.open[-1].children.append(node)
        if tag in self.landmarks:
            self.landmarks[tag].append(node)
        elif tag == "a":
            self.with_links.update(id(n) for n in self.open if n.tag in self.landmarks)
        if tag not in VOID:
            self.open.append(node)

    def end(self, tag: str) -> None:
        self._close_to(tag, SCOPES - {tag} if tag in INLINE or tag == "p" else ())

    def text(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(unescape(data) if "&" in data else data)

    def _close_to(self, tag, limits):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in limits:
                return


def parse(html: str) -> TreeBuilder:
    """The page as a tree. What is open at the end is closed there; a tag that the end cuts off is no text."""
    tree, at = TreeBuilder(), 0
    while True:
        found = TOKEN.search(html, at)
        if found is None:
            break
        if found.start() > at:
            tree.text(html[at:found.start()])
        at = found.end()
        tag = found.group(2)
        if tag is None or html[at - 1] != ">":
            continue
        tag = tag.lower()
        if found.group(1):
            tree.end(tag)
            continue
        tree.start(tag, found.group(3))
        if tag in RAW:
            close = RAW[tag].search(html, at)
            tree.end(tag)
            at = close.start() if close else len(html)
    if at < len(html):
        tree.text(html[at:])
    return tree


def furniture(node: Node, inside: bool) -> bool:
    """Whether tag or mark give the element away; `inside` an article the head of the text may be in a header."""
    if node.tag in DROPPED or node.marked and node.tag not in ("html", "body", "article", "main", "#page"):
        return True
    return node.tag == "header" and not inside


def around(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def article_of(tree: TreeBuilder) -> list[Node]:
    """The outermost articles, or else main elements, that are not inside furniture and not marked; of marked or enclosed
    ones only if there are no others. Empty for a page without."""
    for tag, found in tree.landmarks.items():
        seen, outer = {id(n) for n in found}, []
        for n in found:
            if not any(id(a) in seen for a in around(n)):
                outer.append(n)
        clean = [n for n in outer if not n.marked and not any(furniture(a, False) for a in around(n))]
        if outer:
            return clean or outer
    return []


def candidates(tree: TreeBuilder, articles: list[Node]) -> dict[int, int]:
    """Hash of every element's subtree (tags and text), by the element's id, that may go if it recurs. Within an article that
    is a container made of links; elsewhere any element with text that holds no article and is not a passage of prose."""
    tops = {id(a) for a in articles}
    holds = {id(n) for a in articles for n in (a, *around(a))}
    order, todo, bare = [], [tree.root], []
    tree.root.inside = False
    while todo:
        node = todo.pop()
        order.append(node)
        inside = node.inside or id(node) in tops
        if id(node) in tops and id(node) not in tree.with_links:
            node.children, kept = (), node.children  # nothing in it can be made of links
            bare.append((node, kept))
        for c in node.children:
            if type(c) is Node:
                c.inside = inside
                todo.append(c)
    found = {}
    for node in reversed(order):
        parts, words, letters, linked, plain = [node.tag], 0, 0, 0, True
        link = node.tag == "a"
        for c in node.children:
            if type(c) is Node:
                parts.append(c.hash)
                words += c.words
                letters += c.letters
                linked += c.letters if link else c.linked
                plain = plain and c.plain and c.tag in INLINE
            else:
                own = c.split()
                if own:
                    text = " ".join(own)
                    parts.append(text)
                    words += len(own)
                    letters += len(text)
                    linked += len(text) if link else 0
        node.hash = xxh3_64_hexdigest("\0".join(parts).encode("utf-8", "surrogatepass"))
        node.words, node.letters, node.linked, node.plain = words, letters, linked, plain
        if not letters or id(node) in holds or node.tag in INLINE or node.tag in ("html", "body", "#page"):
            continue
        prose = node.tag in HEADINGS or node.tag == "p" or 2 * linked < letters if node.inside else plain and words >= PASSAGE_WORDS
        if not prose:
            found[id(node)] = int(node.hash, 16) - (1 << 63)
    for node, children in bare:
        node.children = children
    return found


def text_of(root: Node, articles: list[Node], templates: frozenset[int] = frozenset(), found: dict[int, int] | None = None) -> str:
    """Blocks of the articles (or else of the page) without furniture and templates, one line each."""
    lines: list[str] = []
    held: list[str] = []

    def flush():
        line = " ".join("".join(held).split())
        if line:
            lines.append(line)
        held.clear()

    for top in articles or [root]:
        skipped, heads = 0, 0  # inside furniture; inside an article's header, of which headings count
        stack: list[tuple[Node | str, bool]] = [(top, True)]
        while stack:
            at, opens = stack.pop()
            if isinstance(at, str):
                if not heads or heads == -1:
                    held.append(at)
                continue
            if not opens:
                if at.tag not in INLINE:
                    flush()
                if at.tag == "header":
                    heads = 0
                elif at.tag in HEADINGS and heads == -1:
                    heads = 1
                continue
            if at is not top and furniture(at, bool(articles)) or found and found.get(id(at)) in templates:
                held.append(" ")
                continue
            if at.tag in ("br", "img", "wbr"):
                held.append("" if at.tag == "wbr" else " ")
                continue
            if at.tag not in INLINE:
                flush()
            if at.tag == "header":
                heads = 1
            elif at.tag in HEADINGS and heads == 1:
                heads = -1
            stack.append((at, False))
            stack.extend((c, True) for c in reversed(at.children))
        flush()
    return "\n".join(lines)


def site_rows(html: str) -> tuple[int, list[int]]:
    """Digest of the main text that tags alone find, and the different hashes of the page's candidates."""
    tree = parse(html)
    articles = article_of(tree)
    main = xxh3_64_intdigest(text_of(tree.root, articles).encode("utf-8", "surrogatepass"))
    return main - (1 << 63), sorted(set(candidates(tree, articles).values()))


def main_text(html: str, templates: frozenset[int]) -> str:
    tree = parse(html)
    articles = article_of(tree)
    return text_of(tree.root, articles, templates, candidates(tree, articles) if templates else None)


def site_templates(pages: DataFrame, many_pages: int = MANY_PAGES, many_share: float = MANY_SHARE) -> DataFrame:
    """(host, templates): the hashes of the subtrees that recur on a host. `pages` has host and html.

    A subtree counts once for every different main text it stands beside. As a template takes `many_share` of its host's
    pages, a host has at most 1 / many_share times as many as a page has candidates.
    """
    spec = "host string, main long, hash long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, mains, found = [], [], []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1)):
                main, hashes = site_rows(html.as_py())
                hashes.append(None)  # the page itself
                hosts += [host] * len(hashes)
                mains += [main] * len(hashes)
                found += hashes
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(mains, pa.int64()), pa.array(found, pa.int64())],
                                             names=["host", "main", "hash"])

    known = pages.where("host <> '' AND html IS NOT NULL").select("host", "html").mapInArrow(run, spec)
    counts = known.distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
    counts = materialise(counts.where((F.col("n") >= many_pages) | F.col("hash").isNull()), "subtrees")
    of_host = counts.where("hash IS NULL").select("host", F.col("n").alias("pages"))
    return (counts.where("hash IS NOT NULL").join(of_host, "host").where(F.col("n") >= F.lit(many_share) * F.col("pages"))
            .groupBy("host").agg(F.sort_array(F.collect_list("hash")).alias("templates")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            many_pages: int = MANY_PAGES, many_share: float = MANY_SHARE) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The text is that of the page's `article` elements (else `main`, else of all of it) without templates of the host and
    other furniture: a line per block, character references decoded, white space as one space. Null html counts as
    empty and gives an empty text. Pages without a host in their url share no site, so only tags and marks count there.
    Pages of any length and depth are read whole; repeated rows are kept each, null ids too; an empty table gives none.
    Other columns are not looked at.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        split_url(F.col(url_col))[0].alias("host"))
    templates = materialise(site_templates(rows, many_pages, many_share), "templates")
    size = templates.agg(F.sum(F.size("templates") * 8 + F.length("host") + 16)).first()[0] or 0
    right = F.broadcast(templates) if size <= BROADCAST_BYTES else templates
    spec = f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, frozenset[int]] = {}
        for batch in batches:
            texts = []
            for host, html, found in zip(batch.column(3), batch.column(2), batch.column(4)):
                if host.as_py() not in held:
                    if len(held) > 1000:
                        held.clear()
                    held[host.as_py()] = frozenset(found.as_py() or ())
                texts.append(main_text(html.as_py() or "", held[host.as_py()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.join(right, "host", "left").select("page_id", "url", "html", "host", "templates").mapInArrow(run, spec)
