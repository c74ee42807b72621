"""Main text of web pages by tree scoring.

A lenient parser builds the element tree. Menus, adverts, forms and the like are cut from it by element,
role and class. Paragraphs then earn points for length and commas and pass them to their ancestors, with
less for each level; a container's points are discounted by the share of its text inside links. The best
container, or the article or main element that it stands in, is the article, together with those of its
siblings that score well enough, are prose, or are headings, lists, tables and the like with few links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.session import bound_arrow_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
#: What a start tag ends first, if open within the nearest of the listed containers.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside iframe svg canvas object embed "
    "select textarea input menu dialog audio video math noembed noframes xmp".split()
)
#: Dropped too, unless they stand within a sentence.
CONTROLS = frozenset("label button".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert comment comments commentlist respond reply replies disqus sidebar "
    "sidebars side widget widgets related recommended share sharing social menu menus nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead popup modal overlay newsletter subscribe subscription signup login toolbar "
    "pagination pager skip hidden".split()
)
#: Words that may stand beside one of these in a name of several words: "share-buttons" is dropped, "share-price" isn't.
BOX_WORDS = frozenset(
    "area article articles bar block body bottom box button buttons center col column columns container content count "
    "feed fixed form global group has head heading icon icons in inner item items js lang layout left link links list lists "
    "main meta mobile module no off on outer page panel post posts primary reader readers right row secondary section "
    "site slot sticky stories story tab tags text thread title toggle top unit user users with wrap wrapper zone".split()
)
#: Elements whose id is an anchor, not the name of a box.
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6 p li a span".split())
#: Of these, the ones that never name a page's layout: a wrapper may say "has-sidebar", not "comments".
NEVER_LAYOUT = frozenset("comment comments commentlist respond reply replies disqus related recommended".split())
NEVER_DROPPED = frozenset("html body article main".split())
#: Points by element, besides what its paragraphs earn.
BONUS = {"article": 25.0, "main": 15.0, "div": 5.0, "section": 5.0, "pre": 3.0, "blockquote": 3.0, "td": 3.0}
#: A sibling of the best container is kept with this share of its points, and so many at least.
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0
#: Siblings that are kept whatever their points, if less than LINKED of their text is inside links.
SIBLING_TAGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup ul ol dl pre table figure section blockquote".split())
LINKED = 0.25
PARAGRAPHS = frozenset("p pre td blockquote li dd figcaption".split())
CONTAINERS = frozenset("article main section div body td blockquote".split())

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: The rest of a tag after its name: a quoted value may hold any character, and only a value is quoted.
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
_ATTR = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_WORDS = re.compile(r"[a-z0-9]+")
_COMMA = re.compile(r"[,،、，]")


class Node:
    """An element: its tag, its attributes' source, its children (elements and strings), its parent.

    size, commas, links (text inside links) and main (holds an article) count everything below it.
    """

    __slots__ = ("children", "commas", "links", "main", "parent", "points", "raw", "size", "tag")

    def __init__(self, tag: str, raw: str, parent: Node | None):
        self.tag, self.raw, self.parent = tag, raw, parent
        self.children: list[Node | str] = []
        self.points, self.size, self.links, self.commas, self.main = 0.0, 0, 0, 0, False


def _tag_end(html: str, at: int) -> int:
    """Where the tag whose name ends at `at` ends: the first > outside of quoted values, or -1 if the page ends before."""
    m = _REST.match(html, at)
    return m.end() - 1 if m else -1


def parse(html: str) -> Node:
    """The element tree of a page; open and misnested elements are closed as browsers would, roughly."""
    root = Node("#root", "", None)
    open_ = _Open([root])
    at, n = 0, len(html)
    while at < n:
        mark = html.find("<", at)
        if mark < 0:
            open_[-1].children.append(html[at:])
            break
        if mark > at:
            open_[-1].children.append(html[at:mark])
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 2)
            at = n if end < 0 else end + 3
            continue
        after = html[mark + 1 : mark + 2]
        if after in ("!", "?"):
            end = html.find(">", mark)
            at = n if end < 0 else end + 1
            continue
        m = _NAME.match(html, mark)
        if not m:
            if mark + 1 < n and after != "/":  # a lone < is text
                open_[-1].children.append("<")
                at = mark + 1
            else:
                end = html.find(">", mark)
                at = n if end < 0 else end + 1
            continue
        tag = m[1].lower()
        end = _tag_end(html, m.end())
        if end < 0:
            break  # the page ends within a tag
        if after == "/":
            if open_.count_of.get(tag):
                k = len(open_) - 1
                while open_[k].tag != tag:
                    k -= 1
                open_.close(k)
            at = end + 1
            continue
        _close_implied(open_, tag)
        node = Node(tag, html[m.end() : end], open_[-1])
        open_[-1].children.append(node)
        at = end + 1
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}", re.I).search(html, at)
            if tag == "textarea" or tag == "title":
                node.children.append(html[at : stop.start() if stop else n])
            if not stop:
                break
            end = html.find(">", stop.end())
            at = n if end < 0 else end + 1
        elif tag not in VOID and not node.raw.endswith("/"):
            open_.push(node)
        elif tag not in VOID and tag in BLOCK:
            open_.push(node)  # browsers ignore the slash
    return root


class _Open(list):
    """The open elements, and how many there are of each tag."""

    def __init__(self, nodes: list[Node]):
        super().__init__(nodes)
        self.count_of: dict[str, int] = {}

    def push(self, node: Node) -> None:
        self.append(node)
        self.count_of[node.tag] = self.count_of.get(node.tag, 0) + 1

    def close(self, k: int) -> None:
        for node in self[k:]:
            self.count_of[node.tag] -= 1
        del self[k:]


def _close_implied(open_: _Open, tag: str) -> None:
    """End what the start tag ends: an open paragraph, or the item, cell or row before."""
    if tag in BLOCK and open_.count_of.get("p"):
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag == "p":
                open_.close(k)
                break
            if open_[k].tag in BLOCK:
                break
    if tag in ENDS:
        ended, within = ENDS[tag]
        if not any(open_.count_of.get(x) for x in ended):
            return None
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag in within:
                break
            if open_[k].tag in ended:
                open_.close(k)
                if tag != "tr":
                    break
                return _close_implied(open_, tag)
    return None


def _named(value: str) -> set[str]:
    """The words of DROPPED_WORDS that the names in a class or id consist of, beside numbers and words for boxes."""
    out = set()
    for name in value.split():
        words = set(_WORDS.findall(name))
        found = words & DROPPED_WORDS
        if found and all(w in BOX_WORDS or w.isdigit() for w in words - found):
            out |= found
    return out


def _sentence(node: Node) -> range:
    """Places of a paragraph's children with text of its own before and after."""
    texts = [k for k, c in enumerate(node.children) if isinstance(c, str) and c.strip()] if node.tag == "p" else []
    return range(texts[0] + 1, texts[-1]) if texts else range(0)


def _unwanted(node: Node, wraps: bool, in_sentence: bool) -> bool:
    """Whether element, role, class, id or style say that this isn't part of an article.

    wraps: it holds most of the page, so words of layout among its classes don't count, and a form is layout.
    """
    if node.tag in DROPPED or (node.tag == "form" and not wraps) or (node.tag in CONTROLS and not in_sentence):
        return True
    if not node.raw or node.tag in NEVER_DROPPED:
        return False
    for m in _ATTR.finditer(node.raw):
        name, value = m[1].lower(), unescape(m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value.strip() in DROPPED_ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id"):
            words = _named(value) if name == "class" or node.tag not in ANCHORS else set()
            if words and not (wraps and words.isdisjoint(NEVER_LAYOUT)):
                return True
    return False


def prune(root: Node) -> list[Node]:
    """Cut what is unwanted; the elements that stay, in page order."""
    everything, rest = [], [root]
    while rest:
        node = rest.pop()
        everything.append(node)
        rest.extend(c for c in reversed(node.children) if isinstance(c, Node) and c.tag not in DROPPED)
    for node in reversed(everything):
        node.size = sum(c.size if isinstance(c, Node) else len(c) for c in node.children)
        node.main = any(isinstance(c, Node) and (c.main or c.tag in ("article", "main")) for c in node.children)
    kept, rest = [], [root]
    while rest:
        node = rest.pop()
        kept.append(node)
        children, sentence = [], _sentence(node)
        for k, c in enumerate(node.children):
            if isinstance(c, Node):
                if _unwanted(c, 2 * c.size > root.size, k in sentence) and (c.tag in DROPPED or not c.main):
                    continue
            children.append(c)
        node.children = children
        rest.extend(c for c in reversed(children) if isinstance(c, Node))
    return kept


def article(root: Node) -> list[Node]:
    """The best container or the article around it, and the siblings that are kept, in page order."""
    nodes = prune(root)
    in_link = {id(root): False}
    for node in nodes:
        if node.parent is not None:
            in_link[id(node)] = in_link[id(node.parent)] or node.tag == "a"
    for node in reversed(nodes):
        texts = [c for c in node.children if isinstance(c, str)]
        own = sum(len(" ".join(c.split())) for c in texts)
        inner = [c for c in node.children if isinstance(c, Node)]
        node.size = own + sum(c.size for c in inner)
        node.commas = sum(len(_COMMA.findall(c)) for c in texts) + sum(c.commas for c in inner)
        node.links = (own if in_link[id(node)] else 0) + sum(c.links for c in inner)
    for node in nodes:
        direct = "".join(c for c in node.children if isinstance(c, str))
        if node.tag not in PARAGRAPHS and not (node.tag in CONTAINERS and len(direct.strip()) >= 25):
            continue
        if not node.size:
            continue
        points = (1 + node.commas + min(node.size / 100, 3)) * (1 - node.links / node.size)
        level, up = 0, node if node.tag in CONTAINERS and node.tag not in PARAGRAPHS else node.parent
        while up is not None and level < 5:
            up.points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            up, level = up.parent, level + 1
    best, most = None, 0.0
    for node in nodes:
        if node.tag in CONTAINERS and node.size:
            node.points = (node.points + BONUS.get(node.tag, 0.0) * (node.points > 0)) * (1 - node.links / node.size)
            if node.points > most:
                best, most = node, node.points
    if best is None:  # no paragraph at all: what an article, the main part or the body says
        for tag in ("article", "main", "body", "#root"):
            if found := [x for x in nodes if x.tag == tag and x.size and x.links < x.size]:
                return found[:1]
        return []
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    best = around or best
    out = []
    for c in best.parent.children if best.parent is not None else [best]:
        if c is best:
            out.append(c)
        elif isinstance(c, Node) and c.size and best.tag != "body":
            density = c.links / c.size
            enough = c.tag in CONTAINERS and c.points >= max(SIBLING_LEAST, SIBLING_SHARE * most)
            prose = c.tag == "p" and ((c.size > 80 and density < LINKED) or (density == 0 and "." in _inner(c)))
            other = c.tag in SIBLING_TAGS and density < LINKED
            if enough or prose or other:
                out.append(c)
    return out


def _inner(node: Node) -> str:
    out, rest = [], [node]
    while rest:
        x = rest.pop()
        for c in x.children:
            if isinstance(c, Node):
                rest.append(c)
            else:
                out.append(c)
    return " ".join(out)


def blocks(nodes: list[Node]) -> list[str]:
    """The texts of the blocks within nodes, in page order, references decoded and white space made one space."""
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        if text := " ".join("".join(line).split()):
            out.append(text)
        line.clear()

    rest: list[Node | str | None] = list(reversed(nodes))  # None ends a block
    while rest:
        c = rest.pop()
        if c is None:
            end()
        elif isinstance(c, str):
            line.append(unescape(c))
        elif c.tag == "br":
            line.append(" ")
        else:
            if c.tag in BLOCK or c.tag == "#root":
                end()
                rest.append(None)
            rest.extend(reversed(c.children))
    end()
    return out


def extract(html: str | None) -> str:
    """The main text of a page: its blocks, one a line; empty for a null or empty page."""
    return "\n".join(blocks(article(parse(html)))) if html else ""


def extract_pages(pages: DataFrame) -> DataFrame:
    """The main text of every row of pages (page_id, url, html): page_id, url, text, n_chars.

    A null html counts as empty and gives an empty text; pages of any length are read whole, in time that
    follows their length; of containers that tie in points the first on the page wins; null ids and urls and
    repeated rows are kept as they are; an empty table gives no rows; other columns are ignored.
    """
    bound_arrow_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x) for x in batch.column(2).to_pylist()]
            sizes = [len(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
