"""Main text of HTML pages by composite text density.

Each page becomes a tree. Parts that are never article text (menus, forms, scripts, notices ...) are cut off first.
Every node left gets a density: characters per tag, weighed down by the share of linked characters and tags. The sum
of the densities of a node's children shows how much text it gathers. The lowest density on the way from the node with
the largest sum up to the body is the page's threshold: under every node that reaches it, the subtree with the largest
sum is content. The density's logarithm has itself a logarithm as base; that base is taken as e at least, so links count
for nothing in it where they are too few to lift it above e.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that hold no article text, wherever they stand.
CUT = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form frame frameset head iframe input label map menu "
    "meter nav noframes noscript object option output progress script select style svg template textarea title video".split())
#: Of these, the ones whose words are part of the sentence when they stand in one.
CONTROLS = frozenset("button label meter object output progress".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Start tags that end an open element of one of the named kinds, up to the nearest of the bounds.
_ITEMS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})), "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})), "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})), "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
_SCOPE = frozenset("article body button caption div html main object section table td th".split())
#: Words in class, id and role that mark such parts.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "complementary consent contentinfo cookie cookies dialog disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "related recommended recommendations replies reply search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toast toolbar topbar widget".split())
#: Words that go with them without saying what a part is.
_PLAIN = frozenset(
    "area bar block body bottom box button buttons container content form group icons inline inner item left link links list "
    "message msg page panel right section site slot stories story text thread title top unit wrap wrapper".split())
#: Elements of running text: such a word marks them only if nothing else is said in the same name ("ad-slot", not "ad-hoc").
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption".split())
#: Names that mark readers' comments, however long they are.
THREADS = frozenset("comment comments commentlist disqus replies reply".split())
_HEADER = frozenset("header banner masthead topbar".split())
_KEEP = frozenset("html body main article".split())


_COMMENT, _RAW = "<!--", frozenset("script style title textarea noscript noframes iframe template svg".split())
#: A tag; quoted values may hold ">", but not "<": an unclosed quote ends no later than the next tag.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z0-9]+")
_NAME = re.compile(r"[a-z]+")


class _Node:
    __slots__ = ("tag", "parent", "children", "cut", "marks", "chars", "links", "tags", "link_tags", "density", "total", "content", "best", "thread",
                 "inside", "says")

    def __init__(self, tag: str, parent: "_Node | None"):
        self.tag, self.parent = tag, parent
        self.children: list = []
        self.cut = False
        self.thread = False
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.says: bool | None = None
        self.marks: frozenset[str] = frozenset()


def _traits(attributes: str) -> tuple[frozenset[str], frozenset[str], bool]:
    """The marks among the words of class, id and role; those of names that say nothing else; whether the element is hidden."""
    found, whole, hidden = set(), set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            found.update(_WORD.findall(value))
            for token in value.split():
                parts = set(_NAME.findall(token))
                if parts <= MARKS | _HEADER | _PLAIN:
                    whole |= parts
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
    return frozenset(found & (MARKS | _HEADER)), frozenset(whole & (MARKS | _HEADER)), hidden


class _Tree:
    """The page's blocks, links and cut-off parts as nodes; other inline elements are part of the text around them."""

    def __init__(self, page: str):
        self.root = _Node("html", None)
        self.nodes, self.open = [self.root], [self.root]
        self.held: Counter[str] = Counter()  # open elements by tag
        at, n = 0, len(page)
        while at < n:
            lt = page.find("<", at)
            if lt < 0:
                lt = n
            if lt > at:
                self._text(page[at:lt])
            if lt >= n:
                break
            at = self._markup(page, lt)

    def _markup(self, page: str, lt: int) -> int:
        """Reads what begins with "<" at ``lt``; returns where it ends."""
        if page.startswith(_COMMENT, lt):
            end = page.find("-->", lt + 4)
            return len(page) if end < 0 else end + 3
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if m is None:
            if page[lt + 1:lt + 2] in ("!", "?", "/"):
                end = page.find(">", lt)
                return len(page) if end < 0 else end + 1
            self.open[-1].children.append("<")
            return lt + 1
        tag = m[2].lower()
        if m[1]:
            self._close(tag)
        elif tag in _RAW and not m[3].endswith("/"):
            end = re.compile("</" + re.escape(tag) + r"(?=[\s/>])", re.I).search(page, m.end())
            if end is None:
                return len(page) if tag != "template" else m.end()
            gt = page.find(">", end.end())
            return len(page) if gt < 0 else gt + 1
        else:
            self._start(tag, m[3])
        return m.end()

    def _text(self, data: str) -> None:
        self.open[-1].children.append(unescape(data) if "&" in data else data)

    def _leave(self, i: int) -> None:
        self.held.subtract(n.tag for n in self.open[i:])
        del self.open[i:]

    def _end(self, kinds: frozenset[str], bounds: frozenset[str]) -> None:
        if not any(self.held[k] for k in kinds):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in kinds:
                self._leave(i)
                return
            if tag in bounds:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.open[-1].children.append(" ")
            return
        if tag == "html" or tag == "body" and self.held["body"]:
            return
        marks, whole, hidden = _traits(attributes) if attributes else (frozenset(), frozenset(), False)
        if tag in _TEXT:
            marks = whole
        block = tag in BLOCK
        if not (block or tag == "a" or tag in CUT or marks or hidden) or tag in VOID:
            return
        if tag in _ITEMS:
            self._end(*_ITEMS[tag])
        elif tag == "a":
            self._end(frozenset("a"), BLOCK)
        elif block:
            if tag == "body":
                self._end(frozenset({"head"}), frozenset())
            self._end(frozenset({"p"}), _SCOPE)
        node = _Node(tag, self.open[-1])
        node.cut = hidden
        if tag not in _KEEP:
            node.marks = marks
        node.thread = bool(whole & THREADS) and tag not in ("html", "body", "main")
        self.open[-1].children.append(node)
        self.nodes.append(node)
        if not attributes.endswith("/") or block:
            self.open.append(node)
            self.held[tag] += 1

    def _close(self, tag: str) -> None:
        if not self.held[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            at = self.open[i].tag
            if at == tag:
                self._leave(i)
                return
            if at in ("article", "main", "body", "table") and tag not in BLOCK or tag == "p" and at in _SCOPE:
                return


def _spared(nodes: list[_Node], wraps: set[int]) -> set[int]:
    """Marked nodes that are no part to cut but hold the story, as in class="page has-sidebar": those that hold a main;
    those with an article or h1 in them and at least as much text as any of these beside them; and, if none is
    beside them, those with most of the page's text."""
    if not any(n.marks for n in nodes):
        return set()
    at = {id(n): i for i, n in enumerate(nodes)}
    end = list(range(1, len(nodes) + 1))  # nodes stand in page order: those below i are i + 1 .. end[i] - 1
    text, plain = [0] * len(nodes), [0] * len(nodes)
    main, off, head = [False] * len(nodes), [False] * len(nodes), [False] * len(nodes)
    for i, n in enumerate(nodes):
        up = at[id(n.parent)] if i else 0
        off[i] = n.cut or i > 0 and off[up] or n.tag in CUT and not (n.tag in ("form", "fieldset") and id(n) in wraps)
        head[i] = n.tag == "header" or i > 0 and head[up] and n.tag not in ("article", "main")
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        if not off[i]:
            text[i] += sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
        if i:
            up = at[id(n.parent)]
            text[up] += text[i]
            plain[up] += 0 if n.marks else text[i]
            end[up] = max(end[up], end[i])
            main[up] |= main[i] or n.tag == "main"
    named = [not off[i] and (n.tag in ("article", "main") or n.tag == "h1" and not head[i]) for i, n in enumerate(nodes)]
    # An h1 stands for what is beside it and not marked.
    weight = [plain[at[id(n.parent)]] if n.tag == "h1" and i else text[i] for i, n in enumerate(nodes)]
    before, after = [-1] * (len(nodes) + 1), [-1] * (len(nodes) + 1)
    for i, is_named in enumerate(named):
        if is_named:
            before[end[i]] = max(before[end[i]], weight[i])
    for i in range(len(nodes)):
        before[i + 1] = max(before[i + 1], before[i])
    for i in range(len(nodes) - 1, -1, -1):
        after[i] = max(after[i + 1], weight[i] if named[i] else -1)
    count = [0, *accumulate(named)]
    spared = set()
    for i, n in enumerate(nodes):
        if n.marks and text[i]:
            beside = max(before[i], after[end[i]])
            inside = count[end[i]] > count[i + 1]
            if main[i] or (text[i] >= beside if inside else beside < 0 and 2 * text[i] > text[0]):
                spared.add(id(n))
    return spared


def _prune(nodes: list[_Node]) -> None:
    """Marks the nodes that are cut off. A form stays if it wraps the page's article, a marked element if it holds the
    story; a header inside an article keeps its headings, a sentence its controls. Readers' comments go, however long."""
    wraps, mains = set(), set()
    for n in nodes:
        for names, above in ((("article", "main", "h1"), wraps), (("main",), mains)):
            up = n.parent if n.tag in names else None
            while up is not None and id(up) not in above:
                above.add(id(up))
                up = up.parent
    for n in nodes[1:]:
        n.cut |= n.thread and id(n) not in mains
    spared = _spared(nodes, wraps)
    for n in nodes[1:]:
        if n.cut or n.parent.cut:
            n.cut = True
            continue
        if id(n) in spared and n.tag not in CUT and n.tag != "header":
            continue
        head = n.tag == "header" or bool(n.marks & _HEADER)
        if n.tag in CONTROLS and not n.marks and _in_sentence(n):
            continue
        if n.tag in CUT:
            n.cut = not (n.tag in ("form", "fieldset") and id(n) in wraps)
        elif head:
            if n.inside and id(n) in wraps:
                n.children = [c for c in n.children if isinstance(c, _Node)]
                for c in n.children:
                    c.cut |= not (c.tag in HEADINGS or id(c) in wraps)
            else:
                n.cut = True
        elif n.marks:
            n.cut = True


def _in_sentence(n: _Node) -> bool:
    """Whether the element stands in a text element beside words."""
    up = n.parent
    if up is None or up.tag not in _TEXT:
        return False
    if up.says is None:
        up.says = any(isinstance(c, str) and not c.isspace() for c in up.children)
    return up.says


def _measure(nodes: list[_Node], body: _Node) -> None:
    for n in nodes:
        n.chars = n.links = n.tags = n.link_tags = 0
        n.total, n.content = 0.0, False
    for n in reversed(nodes):  # children come after their parents
        if n.cut:
            continue
        n.chars += sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
        if n.tag == "a":
            n.links = n.chars
        up = n.parent
        if up is not None:
            up.chars += n.chars
            up.links += n.links
            up.tags += n.tags + 1
            up.link_tags += n.link_tags + (n.tag == "a")
    share = body.links / max(body.chars, 1)
    for n in reversed(nodes):
        if n.cut or not n.chars:
            n.density = 0.0
        else:
            plain = max(n.chars - n.links, 1)
            base = math.log(n.chars / plain * n.links + share * n.chars + math.e)
            ratio = n.chars / max(n.links, 1) * max(n.tags, 1) / max(n.link_tags, 1)
            n.density = n.chars / max(n.tags, 1) * max(math.log(max(ratio, 1.0)) / max(math.log(max(base, math.e)), 1.0), 0.0)
        if n.parent is not None:
            n.parent.total += n.density
        if not any(isinstance(c, _Node) and not c.cut for c in n.children):
            n.total = max(n.total, n.density)
        # The node of its subtree with the largest sum; of equal ones the outermost, of those beside each other the last.
        n.best = n
        for c in reversed(n.children):
            if isinstance(c, _Node) and not c.cut and c.best.total > n.best.total:
                n.best = c.best


def main_text(html: str | None) -> str:
    """The article's blocks, white space turned into single spaces, joined by blank lines; empty if there is none."""
    if not html:
        return ""
    tree = _Tree(html)
    body = next((n for n in tree.nodes if n.tag == "body"), tree.root)
    _prune(tree.nodes)
    _measure(tree.nodes, body)
    best = body.best
    limit, up = best.density, best
    while up is not body and up.parent is not None:
        up = up.parent
        limit = min(limit, up.density)
    todo = [body]
    while todo:
        n = todo.pop()
        if n.density >= limit:
            n.best.content = True
            todo.extend(c for c in n.children if isinstance(c, _Node) and not c.cut)
    return "\n\n".join(_blocks(body))


def _blocks(body: _Node) -> Iterator[str]:
    """Blocks of text inside content nodes, in page order."""
    held: list[str] = []
    todo: list = [(body, body.content, False)]
    ends = object()
    while todo:
        item, inside, story = todo.pop()
        if item is ends:
            if text := " ".join("".join(held).split()):
                yield text
            held = []
        elif isinstance(item, str):
            if inside:
                held.append(item)
        elif not item.cut:
            inside = inside or item.content
            story = story or item.tag == "article" and 2 * item.links < item.chars
            block = item.tag in BLOCK
            if block:
                todo.append((ends, inside, story))
            if story or not _link_list(item):
                todo.extend((c, inside, story) for c in reversed(item.children))
            if block:
                todo.append((ends, inside, story))
    if text := " ".join("".join(held).split()):
        yield text


def _link_list(n: _Node) -> bool:
    """A list of links: three or more, and hardly any other text. Those of an article (sources, references) are its text."""
    return n.tag in ("ul", "ol", "div", "table", "dl", "section") and n.link_tags >= 3 and n.links >= 0.9 * n.chars


def extract(html: Column) -> Column:
    """Main text of a page, from the whole of it.

    Null and empty html, and pages without article text, give an empty string. Broken markup is read as browsers do as
    far as open and unclosed elements go; equal pages give equal texts. Each page is one tree in one task.
    """

    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pages.map(main_text, na_action=None)

    return text(html)
