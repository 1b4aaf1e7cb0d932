"""Operator 6, HTML extraction: scores passed up a tree, the article around the best container kept.

A page is parsed into a tree that closes what HTML lets authors leave open.
Then parts that are never article text (menus, headers, footers, sidebars,
notices, adverts, forms, reader comments, hidden parts) are cut: by tag, role,
or the names that class and id give.  A name counts as a whole: beside words
for what is cut it may hold words of layout only, and none that negates
("has-sidebar", "ad-free" and "related-work" name nothing that is cut).  Some
names (`SOFT_WORDS`) cut only what is short or mostly links.  Nothing is cut
that holds all articles of the page, or nearly all of its plain text.

Each paragraph that is left passes points for its length and its commas to its
parent, and half of them to its grandparent; a container's sum is discounted by
the share of its text inside links.  If an article element encloses the best
container, all of it that was not cut gives the blocks, with the articles that
stand beside it.  If none does, everything does that stands in the enclosing
main element, or on the page, except what stands beside the best container or
one around it and is mostly links.

A page is one row and is handled alone: no shuffle, memory for one page's tree.

Defined results: null and empty html give empty text; a page with no paragraph
gives the text of what was not cut; a page cut off in the middle of a tag or
character reference keeps what came before; repeated rows each give a row;
null ids are carried; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm.common import map_batches, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of the page's text.
SILENT = frozenset("head script style noscript template svg iframe object select option button textarea input canvas audio video title annotation annotation-xml".split())
CUT = frozenset("nav aside footer form menu dialog".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
                  "li main nav aside ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes, and the elements beyond which it does not look.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
SCOPE = frozenset("table td th ul ol li blockquote div article section main body html".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
#: Words of class and id (lower case, split at hyphens, underscores and capitals) that name what is cut.
AD_WORDS = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors".split())
COMMENT_WORDS = frozenset("comment comments disqus".split())
HARD_WORDS = AD_WORDS | COMMENT_WORDS | frozenset("nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr popup modal newsletter "
                                                  "subscribe signup login pagination pager toolbar".split())
#: Words that cut only what is short or mostly links.
SOFT_WORDS = frozenset("share sharing social related promo promos promotion promotions menu banner notice notices widget widgets header".split())
#: Words of layout that say nothing about a part by themselves, and words that say that there is none.
LAYOUT_WORDS = frozenset("left right top bottom inner outer main primary secondary site page global post article entry user reader container wrapper wrap box list area "
                         "item items bar section block panel group row col column slot unit body content header links link buttons icons posts articles stories form text "
                         "first last sticky fixed mobile desktop js".split())
NEGATING = frozenset("has no not non without with hide free".split())
_SHORT, _LINKED, _NEARLY_ALL = 400, 0.3, 0.9
#: Elements in which class and id name parts of the text; of these, paragraphs may still be cut by name.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p pre".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "parent", "parts", "cut", "score", "chars", "linked", "prose", "silent", "names", "tops", "plain", "title")

    def __init__(self, tag: str, parent: Node | None, silent: bool = False, names: frozenset = frozenset()):
        self.tag, self.parent, self.cut, self.parts, self.score, self.chars, self.linked = tag, parent, False, [], 0.0, 0, 0
        self.prose = tag in PROSE or parent is not None and parent.prose
        self.silent, self.names, self.tops, self.plain, self.title = silent, names, 0, 0, False


def _named(tag: str, attrs, in_article: bool, prose: bool) -> frozenset:
    """What an element's tag, role and names say: `always` cut, or the words for what is cut that make up a name."""
    said = set()
    if tag in CUT or tag == "header" and not in_article:
        said.add("always")
    for name, value in attrs:
        value = value or ""
        if name == "role" and value.lower() in CUT_ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            said.add("always")
        elif name in ("class", "id"):
            for token in value.split():
                words = {w.lower() for w in _WORDS.findall(token) if not w.isdigit()}
                kind = words - LAYOUT_WORDS or words & SOFT_WORDS
                if kind and not words & NEGATING and kind <= HARD_WORDS | SOFT_WORDS:
                    said |= kind
    if tag in ("html", "body", "main"):
        return frozenset()
    if tag == "article":
        return frozenset(said & (COMMENT_WORDS | {"always"}))
    if tag in PROSE - {"p"} or prose:  # inside prose, names are anchors or mark up the text
        return frozenset(said & (AD_WORDS | {"always"}) if tag not in PROSE else said & {"always"})
    if tag not in BLOCK:
        return frozenset(said & (AD_WORDS | {"always"}))
    return frozenset(said)


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.paragraphs: list[Node] = []
        self.articles = 0

    def _close(self, names, scope) -> None:
        node = self.at
        while node.parent is not None and node.tag not in scope:
            if node.tag in names:
                self.at = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            return
        if tag in BLOCK:
            self._close({"p"}, SCOPE - {"li"})
        if tag in CLOSES:
            names, scope = CLOSES[tag]
            for _ in names:
                self._close(names, scope)
        if tag in VOID:
            if tag in ("br", "hr"):
                self.at.parts.append("\n" if tag == "br" else Node("hr", self.at))
            return
        node = Node(tag, self.at, self.at.silent or tag in SILENT, _named(tag, attrs, self.articles > 0, self.at.prose))
        self.articles += tag in ("article", "main")
        self.at.parts.append(node)
        self.at = node
        if tag in PARAGRAPHS and not node.silent:
            self.paragraphs.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag in ("article", "main", "table") and tag in ("p", "b", "i", "a", "span", "em", "strong", "li", "td"):
                return  # a stray end tag does not close what holds it
            node = node.parent
        if node.parent is not None:
            while self.at is not node.parent:
                self.articles -= self.at.tag in ("article", "main")
                self.at = self.at.parent

    def handle_data(self, data):
        if not self.at.silent:
            self.at.parts.append(data)


def _measure(root: Node) -> None:
    """Sums below each node over what is not cut; iterative, as pages may nest deeply.

    Characters of text, those inside links, those outside of links and of menus,
    sidebars and footers, outermost articles, and whether a title stands there.
    """
    todo = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done:
            todo.append((node, True))
            todo += [(x, False) for x in node.parts if isinstance(x, Node) and not x.cut]
            continue
        below = [x for x in node.parts if isinstance(x, Node) and not x.cut]
        own = sum(len(x.strip()) for x in node.parts if isinstance(x, str))
        node.chars = own + sum(x.chars for x in below)
        node.linked = node.chars if node.tag == "a" else sum(x.linked for x in below)
        node.plain = 0 if node.tag in ("a", "nav", "aside", "footer") else own + sum(x.plain for x in below)
        node.tops = 0 if node.names & COMMENT_WORDS else 1 if node.tag in ("article", "main") and not node.names else sum(x.tops for x in below)
        node.title = node.tag == "h1" or any(x.title for x in below)


def _holds_the_page(node: Node, root: Node, in_article: bool) -> bool:
    """Whether all outermost articles, or nearly all plain text, would go with the node."""
    if root.tops and not in_article:
        return node.tops == root.tops
    return node.plain > (0.99 if node.names & COMMENT_WORDS else _NEARLY_ALL) * root.plain


def _cut(root: Node) -> None:
    """Cut what tags, roles and names say, outermost first, with all below."""
    todo = [(root, False, False)]
    while todo:
        node, in_article, gone = todo.pop()
        hard = node.names - SOFT_WORDS
        if node.tag == "article":  # named a comment: only where there is another article
            named = "always" in hard or bool(hard) and (in_article or root.tops > 0)
        else:
            named = bool(hard) or bool(node.names) and not node.title and (node.chars < _SHORT or node.linked >= _LINKED * node.chars)
        node.cut = gone or node.silent or named and not _holds_the_page(node, root, in_article)
        in_article = in_article or node.tag == "article"
        todo += [(x, in_article, node.cut) for x in node.parts if isinstance(x, Node)]


def _text(nodes: list[Node]) -> list[str]:
    """Blocks of the nodes in page order, white space folded."""
    out: list[str] = []
    inline: list[str] = []

    def flush():
        if block := " ".join("".join(inline).split()):
            out.append(block)
        inline.clear()

    todo: list = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            inline.append(x)
        elif x is None:
            flush()
        elif not x.cut:
            if x.tag in BLOCK:
                flush()
                todo.append(None)
            todo += reversed(x.parts)
    flush()
    return out


def _parsed(html: str) -> _Tree:
    """The page's tree, without the comment or tag in which the page breaks off; the parser knows what is one."""
    tree = _Tree()
    tree.feed(html)
    while not tree.cdata_elem and re.match(r"<[a-zA-Z/!?]", tree.rawdata):
        end = tree.rawdata.find(">") + 1
        if not end or tree.rawdata.startswith("<!--"):
            tree.rawdata = ""
            break
        tree.handle_data(unescape(tree.rawdata[:end]))  # a tag that never ends, as by an open quote, is text
        tree.rawdata = tree.rawdata[end:]
        tree.feed("")
    tree.close()
    return tree


def _above(node: Node | None) -> Iterator[Node]:
    """The node and all around it."""
    while node is not None:
        yield node
        node = node.parent


def _density(parts: list) -> float:
    """The share of the parts' text that stands inside links."""
    chars = sum(len(x.strip()) if isinstance(x, str) else x.chars for x in parts)
    return sum(x.linked for x in parts if isinstance(x, Node)) / chars if chars else 0.0


def _beside(node: Node) -> list:
    """The parts of the node's parent without blocks and runs of inline parts that are mostly links."""
    keep: list = []
    for inline, run in itertools.groupby(node.parent.parts, lambda x: isinstance(x, str) or x.tag not in BLOCK and x is not node):
        run = list(run)
        for part in [run] if inline else [[x] for x in run]:
            if part[0] is node or _density([x for x in part if isinstance(x, str) or not x.cut]) < 0.5:
                keep += part
    return keep


def _held(node: Node) -> list:
    """The parts of a node that are not blank or cut."""
    return [x for x in node.parts if (x.strip() if isinstance(x, str) else not x.cut)]


def _only(node: Node) -> Node | None:
    """The article that is all of a node, if one is."""
    while node.tag != "article":
        held = _held(node)
        if len(held) != 1 or isinstance(held[0], str):
            return None
        node = held[0]
    return node


def _joined(article: Node) -> list[Node]:
    """The article with those that stand beside it, each perhaps alone in containers of its own."""
    unit = article
    while unit.parent is not None and unit.parent.tag != "main" and _held(unit.parent) == [unit]:
        unit = unit.parent
    if unit.parent is None:
        return [article]
    beside = [x for x in unit.parent.parts if isinstance(x, Node) and not x.cut]
    return [own for x in beside if (own := _only(x)) is article or own is not None and _density([own]) < 0.5]


def main_text(html: str | None) -> str:
    """Blocks of the page's article, joined by line feeds."""
    if not html:
        return ""
    tree = _parsed(html)
    root = tree.root
    _measure(root)
    _cut(root)
    _measure(root)
    scored: dict[int, Node] = {}
    for p in tree.paragraphs:
        if p.cut:
            continue
        points = 1 + sum(x.count(",") for x in _text([p])) + min(p.chars / 100, 3)
        for node, share in ((p.parent, 1), (p.parent.parent if p.parent else None, 0.5)):
            if node is not None:
                node.score += share * points
                scored[id(node)] = node
    for node in scored.values():
        node.score *= 1 - _density([node])
    if not scored:
        return "\n".join(_text([root]))
    best = max(scored.values(), key=lambda n: n.score)  # ties: the first paragraph's container
    around = list(_above(best))
    for tag in ("article", "main"):  # the outermost one: sections may be articles themselves
        if tops := [n for n in around if n.tag == tag]:
            top = tops[-1]
            break
    else:
        top = root
    if top.tag == "article":
        return "\n".join(_text(_joined(top)))
    for node in around[:around.index(top)]:
        node.parent.parts = _beside(node)
    return "\n".join(_text([top]))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars; a row per row of `pages` (page_id, url, html)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = [main_text(h) for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                                          names=["page_id", "url", "text", "n_chars"])

    pages = pages.select("page_id", "url", "html")
    return map_batches(pages, run, pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"), "html")


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 6 over the whole of `pages`."""
    return extract_main_text(table(spark, sf_dir, "pages"))
