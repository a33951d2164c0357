"""HTML main text by wrapper induction.

Pages of one host are dealt into layouts by the named elements near their root. All pages of a
layout are aligned two by two with simple tree matching. Text that is equal in aligned nodes is template; text that
differs is a slot. Slots inside menus, headers, footers, sidebars, notices, adverts, forms
and comments, by element and by name, are not content, nor are link lists. The wrapper of a
layout is the path of the deepest element over all its content slots; pages that are equal outside
that element need not be aligned to know it (see ``Induction``). Every page is read
through its wrapper. What is template is then decided over all pages: a block whose text
stands on ``CONSTANT`` of the different pages of a host that have the same wrapper is template
and dropped, the varying blocks are the content, in page order. A page that has no such
element, or whose host has a single page, falls back on its ``article``, ``main`` or
``body``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import stored
from corpusprep.sources.files import _hadoop_path

#: Characters of pages that a task holds for the wrappers it learns before it hands these on.
HELD_CHARS = 8 << 20
#: Outlines of a layout that are held at most, and pages of a block where all pairs are aligned.
OUTLINES = 64
BLOCK_PAGES = 128
#: Share of the different pages behind one wrapper that hold a template block, and how many such pages there must be.
CONSTANT = 0.95
MIN_PAGES = 5
#: Most bytes of the table of wrappers and templates, as stored, that is sent to all tasks.
BROADCAST_BYTES = 16 << 20

# Element names by their part in HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
UNSHOWN = RAW | frozenset("head svg math object canvas audio video map".split())
FRAME = frozenset("nav aside footer form button select menu dialog".split())
ENDS_P = BLOCK - frozenset("body html head optgroup option".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table body html div article section main aside nav footer header form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion promoted related replies respond share sharing sidebar sidenav "
    "social sponsor sponsored subscribe teaser teasers toolbar topbar widget widgets".split()
)
#: Words that an article may be named when it is not the main one; and first words of a name that say what an element has, not what it is.
MINOR = frozenset("ad advert comment comments promo related reply replies sponsored teaser teasers".split())
HAVING = frozenset("has no with without".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "sign", "framing", "named", "kids", "text")

    def __init__(self, tag: str, sign: str = "", framing: bool = False, named: bool = False, text: str = ""):
        self.tag, self.sign, self.framing, self.named, self.kids, self.text = tag, sign, framing, named, [], text


def _element(tag: str, attrs: str, in_article: bool) -> Node:
    values = {}
    if attrs:
        for m in _ATTR.finditer(attrs):
            values.setdefault(m.group(1).lower(), unescape(m.group(2) or m.group(3) or m.group(4) or ""))
    tokens = [[p.lower() for p in _NAME_PARTS.findall(t)] for k in ("class", "id") for t in values.get(k, "").split()]
    names = {p for t in tokens if t and t[0] not in HAVING for p in t}
    if in_article:
        names.discard("header")  # a header there is the article's own
    framing = tag in FRAME or tag in UNSHOWN or values.get("role", "").lower() in ROLES or (tag == "header" and not in_article)
    if tag == "article":
        framing = framing or any(len(t) == 1 and t[0] in MINOR for t in tokens)
    named = tag not in ("html", "body", "article", "main") and not framing and not names.isdisjoint(NAMES)
    return Node(tag, f"{tag}.{values.get('class', '').strip().lower()}", framing or named, named)


def _unframe(root: Node) -> Node:
    """A name does not frame an element that holds the main ``article`` or ``main`` of the page."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(k for k in n.kids if k.tag != "#text")
    holds: set[int] = set()
    for n in reversed(order):  # children before parents
        if n.tag in ("article", "main") and not n.framing or any(id(k) in holds for k in n.kids):
            if not n.framing or n.named:
                holds.add(id(n))
    for n in order:
        if n.named and id(n) in holds:
            n.framing = n.named = False
    return root


def parse(html: str | None) -> Node:
    """The element tree of a page, with end tags implied where HTML implies them."""
    root = Node("#root")
    stack = [root]
    articles = 0

    def close(to: int) -> None:
        nonlocal articles
        while len(stack) > to:
            articles -= stack.pop().tag == "article"

    def text(raw: str) -> None:
        if raw:
            stack[-1].kids.append(Node("#text", text=unescape(raw)))

    html = html or ""
    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            text(html[at:])
            break
        text(html[at : m.start()])
        at = m.end()
        if m.group(2) is None:
            if m.group(0).startswith("<![CDATA["):
                text(m.group(0)[9:-3])
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCK and stack[k].tag in BLOCK:
                    break  # an inline end tag does not close a block
            continue
        if tag in ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in SCOPE:
                    break
        for k in range(len(stack) - 1, 0, -1) if tag in CLOSES else ():
            if stack[k].tag in CLOSES[tag]:
                close(k)
                if tag != "tr":
                    break
            elif stack[k].tag in ("ul", "ol", "dl", "table", "select"):
                break
        node = _element(tag, m.group(3), articles > 0)
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else size
        elif tag not in VOID and not m.group(3).rstrip().endswith("/"):
            stack.append(node)
            articles += tag == "article"
        elif tag not in VOID and tag in BLOCK:
            stack.append(node)  # a slash does not close an element of HTML
            articles += tag == "article"
    return _unframe(root)


def blocks(node: Node, open_block: list[str] | None = None, out: list[str] | None = None) -> list[str]:
    """Texts of the blocks under ``node``, without framing elements; blank ones are left out."""
    out, parts = [], []

    def flush() -> None:
        line = " ".join("".join(parts).split())
        parts.clear()
        if line:
            out.append(line)

    todo: list = [(node, 0)]
    while todo:
        n, done = todo.pop()
        if done:
            flush()
            continue
        if n.tag == "#text":
            parts.append(n.text)
            continue
        if n.framing:
            if n.tag in BLOCK:
                flush()
            continue
        if n.tag == "br":
            parts.append(" ")
            continue
        if n.tag in BLOCK:
            flush()
            todo.append((n, 1))
        todo.extend((k, 0) for k in reversed(n.kids))
    flush()
    return out


def _leaf(n: Node) -> bool:
    return all(k.tag == "#text" or k.tag not in BLOCK for k in n.kids)


def _inner(n: Node) -> str:
    return " ".join("".join(_strings(n)).split())


def _strings(n: Node) -> Iterator[str]:
    todo = [n]
    while todo:
        x = todo.pop()
        if x.tag == "#text":
            yield x.text
        elif x.tag not in UNSHOWN:
            todo.extend(reversed(x.kids))


def _link_list(n: Node) -> bool:
    """An element most of whose text is links."""
    total, linked, todo = 0, 0, [(n, False)]
    while todo:
        x, inside = todo.pop()
        if x.tag == "#text":
            size = len(x.text.strip())
            total, linked = total + size, linked + size * inside
        else:
            todo.extend((k, inside or x.tag == "a") for k in x.kids)
    return total > 0 and 2 * linked > total


def match_trees(a: Node, b: Node) -> tuple[int, list]:
    """Simple tree matching: (matched nodes, aligned child pairs) for two nodes of one signature.

    Children are aligned in order by dynamic programming over the sizes of their own
    matchings; elements without blocks inside are leaves of the alignment. Pages may be
    nested to any depth: the matchings that wait for their children are kept on a list.
    """
    waiting, result = [_matching(a, b)], None
    while waiting:
        try:
            pair = waiting[-1].send(result)
            waiting.append(_matching(*pair))
            result = None
        except StopIteration as done:
            waiting.pop()
            result = done.value
    return result


def _matching(a: Node, b: Node):
    """Matching of two nodes; yields the pairs of children whose matchings it needs."""
    if a.sign != b.sign:
        return 0, []
    if _leaf(a) or _leaf(b):
        return 1, []
    ka = [k for k in a.kids if k.tag != "#text" and k.tag not in UNSHOWN]
    kb = [k for k in b.kids if k.tag != "#text" and k.tag not in UNSHOWN]
    n, m = len(ka), len(kb)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    inner: dict = {}
    for i in range(n):
        row, above = best[i + 1], best[i]
        for j in range(m):
            w = 0
            if ka[i].sign == kb[j].sign:
                inner[i, j] = yield ka[i], kb[j]
                w = inner[i, j][0]
            row[j + 1] = max(above[j + 1], row[j], above[j] + w)
    aligned, i, j = [], n, m
    while i and j:
        w, pairs = inner.get((i - 1, j - 1), (0, []))
        if w and best[i][j] == best[i - 1][j - 1] + w:
            aligned.append((ka[i - 1], kb[j - 1], pairs))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[n][m], aligned[::-1]


def slot_paths(a: Node, b: Node) -> list[tuple[str, ...]]:
    """Paths (signatures from the root) of the elements that hold content slots, seen from page ``a``."""
    found: list[tuple[str, ...]] = []
    todo = [(a, match_trees(a, b)[1], ())]
    while todo:
        x, pairs, path = todo.pop()
        partner = {id(p[0]): p for p in pairs}
        for k in x.kids:
            if k.tag in ("#text",) or k.tag in UNSHOWN or k.framing or _link_list(k):
                continue
            pair = partner.get(id(k))
            if pair is None:
                if _inner(k):
                    found.append(path)  # a node of one page only: its parent is what varies
            elif _leaf(k) or _leaf(pair[1]):
                if _inner(k) != _inner(pair[1]):
                    found.append(path)
            else:
                todo.append((k, pair[2], (*path, k.sign)))
    return found


def _meet(path: tuple[str, ...] | None, others) -> tuple[str, ...] | None:
    """What ``path`` and ``others`` begin with alike; an ``article`` or ``main`` on a path ends it. None is no path yet."""
    for other in others:
        end = next((k + 1 for k, sign in enumerate(other) if sign.split(".")[0] in ("article", "main")), len(other))
        if path is None:
            path = tuple(other[:end])
            continue
        n = 0
        while n < min(len(path), end) and path[n] == other[n]:
            n += 1
        path = path[:n]
    return path


def content_path(pages: list[Node]) -> tuple[str, ...] | None:
    """Path of the deepest element over all content slots of aligned pages; an ``article`` or ``main`` on it ends it."""
    return _meet(None, (p for i, a in enumerate(pages) for j, b in enumerate(pages) if i != j for p in slot_paths(a, b))) or None


class Page:
    """A parsed page, with the elements that are link lists and those that show text."""

    __slots__ = ("html", "root", "linked", "shown")

    def __init__(self, html: str, root: Node | None = None):
        self.html, self.root = html, parse(html) if root is None else root
        order, todo, sizes = [], [self.root], {}
        while todo:
            n = todo.pop()
            order.append(n)
            todo.extend(n.kids)
        self.linked, self.shown = set(), set()
        for n in reversed(order):  # children before parents
            if n.tag == "#text":
                total, linked, shows = len(n.text.strip()), 0, bool(n.text.strip())
            else:
                total, linked, shows = 0, 0, False
                for k in n.kids:
                    own = sizes[id(k)]
                    total, linked = total + own[0], linked + own[1]
                    shows = shows or id(k) in self.shown
                linked, shows = total if n.tag == "a" else linked, shows and n.tag not in UNSHOWN
                if total > 0 and 2 * linked > total:
                    self.linked.add(id(n))
            sizes[id(n)] = total, linked
            if shows:
                self.shown.add(id(n))

    def skipped(self, n: Node) -> bool:
        return n.framing or id(n) in self.linked


def _elements(n: Node) -> list[Node]:
    """The children that are aligned."""
    return [k for k in n.kids if k.tag != "#text" and k.tag not in UNSHOWN]


def _skeleton(n: Node) -> list[str]:
    """All that an alignment depends on."""
    out, todo = [], [n]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        out.append(f"<{x.sign}")
        if not _leaf(x):
            todo.append(">")
            todo.extend(reversed(_elements(x)))
    return out


#: Kinds of elements that are not read: leaves and others.
SKIPPED = frozenset(["still", "shut"])


class Outline:
    """What a page is outside the elements at ``path``, as ``key``: pages of one key have no slot elsewhere.

    Elements whose inside is left out (those at ``path``, framing ones and link lists) can only meet their
    like in an alignment, as their signature and those of the elements around them are the only ones among
    their siblings with blocks inside, or one of a row of siblings that are not read, or those have no signature in common one level below, so that
    matching one with the other counts least; then what is read of two pages of one key is aligned one to one.
    Elsewhere the skeleton of the inside is part of the key. ``kinds``: how the elements outside are read; ``open``: those with a left out part in them;
    ``below``: signatures one level below, where they are part of the key.
    """

    __slots__ = ("key", "kinds", "open", "below")

    def __init__(self, page: Page, path: tuple[str, ...] | None):
        self.kinds, self.open, self.below = {}, set(), {}
        kinds, parts, order, todo = self.kinds, {}, [], [(page.root, 0)]
        while todo:
            n, at = todo.pop()
            order.append(n)
            parts[id(n)] = _elements(n)
            for k in parts[id(n)]:
                skip, below = page.skipped(k), None
                if path and at is not None and at < len(path) and k.sign == path[at]:
                    below = at + 1
                if _leaf(k):
                    kinds[id(k)] = "still" if skip else "text"
                elif skip:
                    kinds[id(k)] = "shut"
                elif path and below == len(path):
                    kinds[id(k)] = "slot"
                else:
                    kinds[id(k)] = "read"
                    todo.append((k, below))
        whole = set()
        for n in reversed(order):  # children before parents
            signs: dict = {}
            for i, k in enumerate(parts[id(n)]):
                signs.setdefault(k.sign, []).append(i)
            for k in parts[id(n)]:
                if kinds[id(k)] in ("shut", "slot") or id(k) in self.open:
                    same = [parts[id(n)][i] for i in signs[k.sign]]
                    row = signs[k.sign][-1] - signs[k.sign][0] < len(same) and all(kinds[id(x)] in SKIPPED for x in same)
                    inside = {id(x): frozenset(y.sign for y in _elements(x)) for x in same if not _leaf(x)}
                    if not row and len(inside) > 1:
                        self.below.update(inside)
                    if not row and sum(map(len, inside.values())) > len(frozenset().union(*inside.values())):
                        whole.add(id(k))
                        self.open.discard(id(k))
                    else:
                        self.open.add(id(k))
                        self.open.add(id(n))
        key: list[str] = [] if not _leaf(page.root) else [f"alone {shows_apart(page)}"]
        todo = [page.root]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                key.append(n)
                continue
            kind = kinds.get(id(n), "read")
            key.append(f"{kind} {id(n) in page.shown and kind != 'shut' and kind != 'still'} {n.sign}")
            if id(n) in whole:
                key.extend(_skeleton(n))
            elif id(n) in self.below:
                key.extend(["", *sorted(self.below[id(n)]), ""])
            if kind == "text":
                key.append(_inner(n))
            elif kind == "read":
                todo.append(">")
                todo.extend(reversed(parts[id(n)]))
        self.key = tuple(key)


def shows_apart(page: Page) -> bool:
    """Whether a page without blocks has elements that are slots beside any other page, as nothing there is aligned."""
    return _leaf(page.root) and any(id(k) in page.shown and not page.skipped(k) for k in _elements(page.root))


def settled(a: Page, b: Page, path: tuple[str, ...]) -> bool:
    """Whether the pages that have the key of ``a`` and those that have the key of ``b`` have their slots outside ``path``
    where ``a`` and ``b`` have them: no left out part can change how the others are aligned."""
    first, second = Outline(a, path), Outline(b, path)

    def least(p: Node, q: Node) -> bool:
        return _leaf(p) or _leaf(q) or id(p) in first.below and id(q) in second.below and first.below[id(p)].isdisjoint(second.below[id(q)])

    todo = [(a.root, b.root, match_trees(a.root, b.root)[1])]
    while todo:
        x, y, aligned = todo.pop()
        ka, kb = _elements(x), _elements(y)
        alike = [(i, j) for i, p in enumerate(ka) for j, q in enumerate(kb) if p.sign == q.sign]
        kinds = [first.kinds[id(k)] for k in ka], [second.kinds[id(k)] for k in kb]
        for sign in {ka[i].sign for i, j in alike if id(ka[i]) in first.open or id(kb[j]) in second.open}:
            own, others = [p for p in alike if ka[p[0]].sign == sign], [p for p in alike if ka[p[0]].sign != sign]
            if len(own) > 1 and not SKIPPED.issuperset([kinds[0][i] for i, _ in own] + [kinds[1][j] for _, j in own]):
                rows, columns = sorted({i for i, _ in own}), sorted({j for _, j in own})
                own = list(zip(rows, columns))  # one to one, if to match any others counts least
                if len(rows) != len(columns) or not all(least(ka[i], kb[j]) for i in rows for j in columns if (i, j) not in own):
                    return False
            if any((i < k) != (j < m) for i, j in own for k, m in others):
                return False
        for p, q, inside in aligned:
            both = {first.kinds[id(p)], second.kinds[id(q)]}
            if _leaf(p) or _leaf(q):
                if both != {"text"} and not both <= SKIPPED and _inner(p) == _inner(q):
                    return False
            elif both == {"read"}:
                todo.append((p, q, inside))
            elif "read" in both:
                return False
    return True


class Induction:
    """The path over all content slots of all pairs of the pages that were added, without keeping or aligning them all.

    Once a slot is known the path can only become shorter, and only by a pair with a slot outside its element. Pages with one
    ``Outline`` have none, so one page is kept for each outline, and aligned with those of the other outlines.
    ``stuck``: an alignment may depend on what the outlines leave out, or there are more than ``OUTLINES``, so that all pairs have to be aligned;
    then no pages are kept, and the path is that of the slots found until then.
    """

    __slots__ = ("path", "pages", "stuck")

    def __init__(self, path: tuple[str, ...] | None = None, stuck: bool = False):
        self.path, self.pages, self.stuck = path, {}, stuck

    def add(self, page: Page) -> None:
        if self.path == () or self.stuck:
            return
        key = Outline(page, self.path).key
        if key in self.pages and not (shows_apart(page) and page.html != self.pages[key].html):
            return
        for other in list(self.pages.values()):
            if other.html != page.html:
                self.shorten(_meet(self.path, (*slot_paths(page.root, other.root), *slot_paths(other.root, page.root))))
                if self.path == ():
                    return
                if Outline(page, self.path).key != Outline(other, self.path).key and not settled(page, other, self.path):
                    self.give_up()
                    return
        self.pages.setdefault(Outline(page, self.path).key, page)
        if len(self.pages) > OUTLINES:
            self.give_up()

    def give_up(self) -> None:
        self.stuck, self.pages = True, {}

    def shorten(self, path: tuple[str, ...] | None) -> None:
        if path != self.path:
            self.path = path
            kept, self.pages = self.pages.values(), {}
            for page in kept if path != () else ():
                self.pages.setdefault(Outline(page, path).key, page)

    def join(self, path: list[str] | None, stuck: bool, pages: list[str]) -> None:
        """Adds what was learnt elsewhere."""
        if path is not None:
            self.shorten(_meet(self.path, [path]))
        if stuck:
            self.give_up()
        for html in pages:
            self.add(Page(html))


def _at_path(root: Node, path: tuple[str, ...]) -> list[Node]:
    found = [root]
    for sign in path:
        found = [k for n in found for k in n.kids if k.sign == sign and not k.framing]
    return found


def _by_tag(root: Node, tag: str) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.tag == tag:
            out.append(n)
        elif n.tag != "#text" and not n.framing:
            todo.extend(reversed(n.kids))
    return out


def main_blocks(root: Node, path: tuple[str, ...] | None) -> tuple[str, list[str]]:
    """(wrapper, blocks) of a page: the elements that were read, as a name, and the texts in them in page order."""
    mains = [n for n in (_at_path(root, path) if path else []) if blocks(n)]
    wrapper = "/".join(path) if mains else ""
    if not any(n.tag in ("article", "main") for n in mains):
        # an element that names itself the article is never left for a wider one
        own = _by_tag(root, "article") or _by_tag(root, "main")
        if own or not mains:
            mains = own or _by_tag(root, "body") or [root]
            wrapper = mains[0].sign
    return wrapper, [line for n in mains for line in blocks(n)]


def block_hash(wrapper: str, line: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{wrapper}\n{line}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def extract(html: str | None, path: tuple[str, ...] | None, template: frozenset[int] = frozenset()) -> str:
    """Main text of a page read through a wrapper path, without the blocks of the template."""
    return _kept(parse(html), path, template)


def _kept(root: Node, path: tuple[str, ...] | None, template: frozenset[int]) -> str:
    wrapper, lines = main_blocks(root, path)
    return "\n".join(line for line in lines if not template or block_hash(wrapper, line) not in template)


def layout(root: Node) -> int:
    """Layout of a page: the signatures of the elements on the two levels below ``body`` that frame nothing."""
    level = _by_tag(root, "body") or [root]
    signs = set()
    for depth in range(2):
        level = [k for n in level for k in n.kids if k.tag in BLOCK and not k.framing]
        signs |= {f"{depth}{k.sign}" for k in level if not _leaf(k)}
    return block_hash("layout", "\n".join(sorted(signs)))


LEARNT = "host string, layout long, path array<string>, stuck boolean, pages array<string>"


def _learnt(found: dict) -> pa.RecordBatch:
    """Rows of ``LEARNT`` for inductions by (host, layout)."""
    columns = [(host, own, None if x.path is None else list(x.path), x.stuck, [p.html for p in x.pages.values()]) for (host, own), x in found.items()]
    types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([c[k] for c in columns], t) for k, t in enumerate(types)], names=["host", "layout", "path", "stuck", "pages"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pages (host, html) of a task teach about each layout."""
    found: dict = {}
    held = 0
    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            root = parse(html)
            own = found.setdefault((host, layout(root)), Induction())
            before = len(own.pages)
            own.add(Page(html, root))
            held += len(html) * (len(own.pages) > before)
            if held > HELD_CHARS:
                yield _learnt(found)
                found, held = {}, 0
    yield _learnt(found)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``LEARNT`` in the order of host and layout, joined."""
    last, found = None, Induction()
    for batch in batches:
        for host, own, *learnt in zip(*(c.to_pylist() for c in batch.columns)):
            if last is not None and last != (host, own):
                yield _learnt({last: found})
                found = Induction()
            last = host, own
            found.join(*learnt)
    if last is not None:
        yield _learnt({last: found})


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the pairs of two blocks of pages (host, layout, one, other, pages with their block) teach; of equal blocks the pairs inside it."""
    for batch in batches:
        for host, own, one, other, held in zip(*(c.to_pylist() for c in batch.columns)):
            found, pages = Induction(), [(x["block"], Page(x["html"])) for x in held]
            path, keys = None, []
            for i, (_, a) in enumerate(pages):
                for j, (block, b) in enumerate(pages[:i]):
                    if found.path != path or not keys:
                        path, keys = found.path, [Outline(x, found.path).key for _, x in pages]
                    if found.path == () or one != other and block == pages[i][0] or keys[i] == keys[j] and not shows_apart(a):
                        continue
                    found.path = _meet(found.path, (*slot_paths(a.root, b.root), *slot_paths(b.root, a.root)))
            yield _learnt({(host, own): found})


def _layouts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([layout(parse(h)) for h in batch.column(1).to_pylist()], pa.int64())], names=["host", "html", "layout"])


def _path(root: Node, wrappers: list[dict] | None) -> tuple[str, ...] | None:
    """The path of the wrapper for a page's layout, of those that its host has."""
    if not wrappers:
        return None
    own = layout(root)
    return next((tuple(w["path"]) for w in wrappers if w["layout"] == own), None)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for html, wrappers in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            root = parse(html)
            wrapper, lines = main_blocks(root, _path(root, wrappers))
            rows.append([block_hash(wrapper, "")] + sorted({block_hash(wrapper, x) for x in lines}))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1:] for r in rows], pa.list_(pa.int64()))], names=["h", "host", "wrapper", "blocks"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, wrappers, template in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
            root = parse(html)
            texts.append(_kept(root, _path(root, wrappers), frozenset(template or ())))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["id", "url", "text", "n_chars"]
        )


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _of_host(pages: DataFrame, table: DataFrame) -> DataFrame:
    """``pages`` with the columns that a stored ``table`` has for their host; pages stay where they are read while the
    table is small (its files are measured), and are dealt by host beyond that."""
    p, fs = _hadoop_path(table.sparkSession, table.stored_at)
    small = fs.getContentSummary(p).getLength() <= BROADCAST_BYTES
    return pages.join(F.broadcast(table) if small else table, "host", "left")


def _joined(learnt: DataFrame) -> DataFrame:
    return learnt.repartition("host", "layout").sortWithinPartitions("host", "layout").mapInArrow(_join, LEARNT)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrappers): for every host the (layout, path) of its layouts that two different pages or more have.

    All pages are read. A task hands on, for each layout, the path over the slots it has seen and a page of each outline.
    Layouts where outlines do not settle the matter have all pairs of their different pages aligned, a number that grows with the square of these pages.
    """
    own = pages.select("host", "html").where("host <> '' and html is not null")
    paths = stored(_joined(own.mapInArrow(_learn, LEARNT)), "op10-paths")
    stuck = paths.where("stuck and (path is null or size(path) > 0)").select("host", "layout")
    if not stuck.isEmpty():
        alone = own.join(stuck.select("host").distinct(), "host", "left_semi").mapInArrow(_layouts, "host string, html string, layout long")
        alone = stored(alone.join(stuck, ["host", "layout"], "left_semi").distinct(), "op10-stuck")
        blocks = alone.groupBy("host", "layout").agg(F.ceil(F.count("*") / BLOCK_PAGES).cast("int").alias("blocks"))
        dealt = alone.join(blocks, ["host", "layout"]).withColumn("block", F.pmod(F.xxhash64("html"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pairs = dealt.groupBy("host", "layout", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
        again = pairs.agg(F.collect_list(F.struct("block", "html")).alias("pages")).mapInArrow(_align, LEARNT)
        paths = _joined(paths.withColumns({"stuck": F.lit(False), "pages": F.array().cast("array<string>")}).unionByName(again))
    return paths.where("size(path) > 0").groupBy("host").agg(F.collect_list(F.struct("layout", "path")).alias("wrappers"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): hashes of the blocks that stand on ``CONSTANT`` of a wrapper's different pages or more.

    Counts are over all pages; equal pages count once. A page's template blocks are among its
    own, so the array of a wrapper is no longer than 1 / ``CONSTANT`` pages.
    """
    own = pages.select("h", "host", "html", "wrappers").where("host <> '' and html is not null")
    found = stored(own.mapInArrow(_hashes, "h long, host string, wrapper long, blocks array<long>").dropDuplicates(["h", "host"]), "op10-blocks")
    size = found.groupBy("host", "wrapper").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_PAGES)
    held = found.select("host", "wrapper", F.explode("blocks").alias("block")).groupBy("host", "wrapper", "block").agg(F.count("*").alias("c"))
    constant = held.join(size, ["host", "wrapper"]).where(F.col("c") >= CONSTANT * F.col("n"))
    return constant.groupBy("host").agg(F.collect_set("block").alias("template"))


def html_main_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, url, text, n_chars): the main text of every page.

    Blocks are in page order, one per line, white space inside a block as one space. A
    null or empty page has an empty text; a null url, or one without a host, is read
    without a wrapper; repeated rows get equal rows; broken markup is read as far as it
    goes; an empty table gives no rows; other columns are ignored.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    own = pages.select(F.col(id_col).alias("id"), "url", "html", host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("h"))
    named = stored(wrappers(own), "op10-wrappers")
    constant = templates(_of_host(own, named))
    known = stored(named.join(constant, "host", "full"), "op10-hosts")
    full = _of_host(own, known).select("id", "url", "html", "wrappers", "template")
    return full.mapInArrow(_extract, f"id {id_type}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
