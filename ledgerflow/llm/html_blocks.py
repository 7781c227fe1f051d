"""Containers and text blocks of a page, from its tags.

``parse`` reads a page once, in time proportional to its length.  ``best_path`` scores every container by all the text
below it, less by ``DECAY`` for every container in between, and climbs from the best one while the rest of its parent
is prose.  ``text_under`` is the text of the elements with a given path.  Boilerplate (by tag, role, or a class or id of
which every word says so) never counts.  A path is the chain of tag.class names from the root, without digits in classes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

#: A comment, another declaration or a tag; what never ends runs to the end of the page, as in browsers.  Quotes count after "=" only.
TOKEN = re.compile(r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/(?![a-zA-Z])[^>]*+(?:>|\Z)"
                   r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z))", re.S)
ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")

# Names of HTML and its usual page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
            "h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = set("article main section div td body html center blockquote".split())
DROPPED = set("script style noscript template nav aside footer form button select textarea input iframe object svg canvas head title dialog menu "
              "xmp noembed noframes audio video map".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words that make boilerplate of a class or id, if all its other words are of this list or the next two.
STRONG = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
             "breadcrumbs cookie cookies consent gdpr newsletter subscribe signup login share sharing social related recommended comment comments "
             "disqus reply replies pagination pager footer copyright popup modal overlay".split())
#: Words that do so unless the element also has a class or id of the words of a text alone.
WEAK = set("sidebar side header masthead banner notice alert widget toolbar hidden legal disclaimer respond discussion skip".split())
TEXT = set("article content post entry main story text body".split())
#: Words that add nothing to what a class or id says.
FILL = set("area list section box wrap wrapper container block bar buttons button links link site page top bottom left right primary secondary "
           "inner outer item items group panel form slot unit posts articles global column col row main post article content entry".split())
READERS = set("comment comments disqus reply replies respond discussion".split())
HEADS = set("h1 h2 h3 h4 h5 h6".split())
#: What a container's score keeps of its child containers' scores.
DECAY = 0.8
#: An opening tag ends an open element of these kinds (up to the nearest of the stoppers).
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
#: Elements whose end tag also ends open tables and articles.
WIDE = set("body html main div section article table".split())
P_SCOPE = ("p", "table", "button", "td")
CLOSES_P = BLOCK - set("caption dd dt figcaption legend li optgroup option summary tbody td tfoot th thead tr body html".split())


class Path:
    """A node of the page's tree of paths: elements with equal chains of names share one."""

    __slots__ = ("parent", "name", "below")

    def __init__(self, parent: "Path | None", name: str):
        self.parent, self.name, self.below = parent, name, {}

    def child(self, name: str) -> "Path":
        got = self.below.get(name)
        if got is None:
            got = self.below[name] = Path(self, name)
        return got

    def __str__(self) -> str:
        names, p = [], self
        while p.parent is not None:
            names.append(p.name)
            p = p.parent
        return "".join("/" + n for n in reversed(names))


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    node: Path
    gone: bool                              # boilerplate by tag, role or style, or inside of some
    article: bool                           # an article or main element, or inside of one
    parent: "Element | None"
    order: int = 0
    soft: "Element | None" = None           # the outermost element around it that its class or id calls boilerplate
    readers: bool = False                   # ... and that holds comments
    block: "Element | None" = None          # itself or the nearest block element around it
    links: int = 0                          # characters of its own blocks that are links

    @property
    def path(self) -> str:
        return str(self.node)


def _hard(tag: str, attrs: dict[str, str], article: bool) -> bool:
    if tag in DROPPED or tag == "header" and not article:
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    return "display:none" in attrs.get("style", "").replace(" ", "").lower()


def _called(tag: str, attrs: dict[str, str], article: bool) -> set[str]:
    """The words that make the element boilerplate by its classes or id; none if it isn't."""
    if tag in ("html", "body", "main") or not ("class" in attrs or "id" in attrs):
        return set()
    names = [{w.lower() for w in WORD.findall(x)} for x in (attrs.get("class", "") + " " + attrs.get("id", "")).split()]
    bad = lambda n, words: n & words and n <= STRONG | WEAK | FILL
    for n in names:
        if bad(n, STRONG):
            return n if tag != "article" or n & READERS or n & {"ad", "advert", "related", "promo"} else set()
    if tag == "article" or any(n and n <= TEXT for n in names):
        return set()
    weak = WEAK - {"header"} if article else WEAK
    return set().union(*(n for n in names if bad(n, weak)))


def _name(tag: str, attrs: dict[str, str]) -> str:
    if "class" not in attrs:
        return tag
    classes = sorted({c for c in (re.sub(r"\d+", "", x) for x in attrs.get("class", "").lower().replace("/", "|").split()) if c.strip("-_")})
    return ".".join([tag, *classes])


class _Open:
    """The open elements, and per tag the places of those of its kind."""

    def __init__(self, root: Element):
        self.stack, self.places = [root], {}

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these kinds, else 0."""
        best = 0
        for t in tags:
            at = self.places.get(t)
            if at and at[-1] > best:
                best = at[-1]
        return best

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.stack))
        self.stack.append(e)

    def cut(self, k: int) -> None:
        """Closes the elements from place k on."""
        while len(self.stack) > k:
            self.places[self.stack.pop().tag].pop()


def parse(html: str) -> list[tuple[Element, str]]:
    """(element, text) of every block in page order, boilerplate left out; decoded, white space as one space.

    What classes and ids call boilerplate comes back where it is nearly all the text of the page, comments aside.
    """
    root = Element("", Path(None, ""), False, False, None)
    root.block = root
    tree, out, text = _Open(root), [], []
    n, pos, linked = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            got = "".join(text)
            text.clear()
            got = " ".join((unescape(got) if "&" in got else got).split())
            if got:
                e = tree.stack[-1].block
                e.links += linked
                out.append((e, got))
        linked = 0

    def close_to(k: int) -> None:
        if text and any(e.tag in BLOCK for e in tree.stack[k:]):
            flush()
        tree.cut(k)

    while True:
        m = TOKEN.search(html, pos)
        top = tree.stack[-1]
        if not top.gone:
            part = html[pos:m.start()] if m else html[pos:]
            if part:
                text.append(part)
                if tree.places.get("a"):
                    linked += len(part)
        if not m:
            break
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if top.tag == tag:                               # nearly always
                close_to(len(tree.stack) - 1)
                continue
            k = tree.last(tag)
            if k and (tag in WIDE or tree.last("table", "article") <= k):
                close_to(k)
            continue
        rest = m[3]
        attrs = {a[0].lower(): unescape(a[1] or a[2] or a[3]) for a in ATTR.findall(rest)} if rest and rest.strip(" /\n\t\r") else {}
        if tag == "br" or tag == "wbr":
            if not top.gone and tag == "br":
                text.append(" ")
            continue
        if tag in CLOSES_P and tree.places.get("p"):
            k = tree.last(*P_SCOPE)
            if k and tree.stack[k].tag == "p":
                close_to(k)
        if tag in ENDS:
            ends, stop = ENDS[tag]
            k = tree.last(*ends)
            if k > tree.last(*stop):
                close_to(k)
        up = tree.stack[-1]
        n += 1
        e = Element(tag, up.node, True, False, up, n)
        if not up.gone:
            e.node, e.article = up.node.child(_name(tag, attrs)), up.article or tag in ("article", "main")
            e.gone, e.soft, e.readers = _hard(tag, attrs, up.article), up.soft, up.readers
            if e.soft is None and not e.gone and (called := _called(tag, attrs, up.article)):
                e.soft, e.readers = e, bool(called & READERS)
        e.block = e if tag in BLOCK else up.block
        if tag in BLOCK and text:
            flush()
        if tag in VOID:
            continue
        if tag in RAW:
            end = RAW_END[tag].search(html, pos)
            pos = html.find(">", end.start()) + 1 or len(html) if end else len(html)
            continue
        if ":" in tag and rest.rstrip().endswith("/"):
            continue
        tree.push(e)
    flush()
    kept = [(e, t) for e, t in out if e.soft is None]
    if len(kept) < len(out) and sum(len(t) for _, t in kept) < 0.02 * sum(len(t) for e, t in out if not e.readers):
        return [(e, t) for e, t in out if not e.readers]
    return kept


RAW_END = {tag: re.compile(rf"</{tag}[\s/>]", re.I) for tag in RAW}


def _elements(found: list[tuple[Element, str]]) -> list[Element]:
    """The elements of the blocks and all around them, each behind its parent."""
    seen: dict[int, Element] = {}
    for e, _ in found:
        while e is not None and e.order not in seen:
            seen[e.order] = e
            e = e.parent
    return [seen[k] for k in sorted(seen)]


def _prose(e: Element, text: str) -> bool:
    return e.tag in HEADS or 2 * e.links < len(text) and (len(text) >= 60 or len(text) >= 20 and text[-1] in ".!?:;…\"”’»")


def best_path(found: list[tuple[Element, str]]) -> tuple[str, float] | None:
    """Path and score of the page's best container; inside an article or main element, that element's own."""
    around = _elements(found)
    score, blocks, prose = ({e.order: x for e in around} for x in (0.0, 0, 0))
    for e, t in found:
        score[e.order] += len(t)
        blocks[e.order] += 1
        prose[e.order] += _prose(e, t)
    best, most = None, 0.0
    for e in reversed(around):                               # children before their parents
        if e.tag in CONTAINER:
            weight = score[e.order] * (1.5 if e.article else 1.0)
            if best is None or (weight, -e.order) > (most, -best.order):
                best, most = e, weight
        if e.parent is not None:
            k = e.parent.order
            score[k] += score[e.order] * (DECAY if e.tag in CONTAINER else 1.0)
            blocks[k] += blocks[e.order]
            prose[k] += prose[e.order]
    if best is None:
        return None
    outer, e = None, best
    while e is not None:
        outer = e if e.tag in ("article", "main") else outer
        e = e.parent
    if outer is not None:
        return outer.path, most
    e = best.parent
    while e is not None and blocks[e.order] - blocks[best.order] == prose[e.order] - prose[best.order]:
        if e.tag in CONTAINER and blocks[e.order] > blocks[best.order]:
            best = e
        e = e.parent
    return best.path, most


def text_under(found: list[tuple[Element, str]], paths: list[str]) -> str | None:
    """Blocks inside the elements of the first of ``paths`` that the page has text under; None if it has none."""
    around = _elements(found)
    for path in paths if found else []:
        node = around[0].node                                # the root's
        for name in path.split("/")[1:]:
            node = node and node.below.get(name)
        if node is None:
            continue
        inside: dict[int, bool] = {}
        for e in around:
            inside[e.order] = e.node is node or e.parent is not None and inside[e.parent.order]
        got = [t for e, t in found if inside[e.order]]
        if got:
            return "\n".join(got)
    return None


def chosen_text(found: list[tuple[Element, str]], paths: list[str], least_share: float = 0.2) -> str:
    """Text under the first of ``paths`` with at least ``least_share`` of what the page's own best container holds, else that one's.

    A page without containers is taken whole.
    """
    own = best_path(found)
    mine = text_under(found, [own[0]]) if own else "\n".join(t for _, t in found)
    for p in paths:
        got = text_under(found, [p])
        if got is not None and len(got) >= least_share * len(mine):
            return got
    return mine
