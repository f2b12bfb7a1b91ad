"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, halved from level to level; the points of a container are discounted by the share of
its text that stands in links. The best container and those of its siblings that look like parts of the same article are kept.
Boilerplate that tags, roles or class names tell (menus, headers, footers, adverts, forms, comments, ...) does not take part; names and forms
do not count where they wrap the article (see ``_drop_marked``).
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frame import OWN, per_text

#: Fixed values of HTML: elements without an end, whose content is raw text, that make blocks, that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noframes", "noembed")
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                  "h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is never main text.
DROPPED = frozenset("nav footer header aside form menu button select option input label dialog fieldset object canvas audio video head svg annotation annotation-xml".split())
#: Of these, controls that stay where they stand in a sentence, outside forms.
CONTROLS = frozenset(("button", "label"))
#: Elements of other vocabularies; a block or a paragraph ends them.
FOREIGN = frozenset(("svg", "math"))
#: Words in class, id or role that mark boilerplate (whole words, or parts separated by - _ or a change of case).
UNLIKELY = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary cookie "
                     "cookies consent contentinfo disqus footer header masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination "
                     "popup promo promoted promotion related replies respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription "
                     "toolbar tags widget widgets".split())
#: Of these, names of discussions, which may be longer than the article.
DISCUSSION = frozenset("comment comments commentlist disqus replies respond".split())
LIKELY = frozenset("article articlebody body content entry hentry main page post story text".split())
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_PARAGRAPHS = frozenset(("p", "pre", "td", "blockquote", "li", "dd", "figcaption", "div", "section", "article", "main"))
_CLOSES_P = BLOCK - {"html", "body", "summary", "caption", "tbody", "td", "th", "tr", "thead", "tfoot"}
#: Open elements of the same kind that a new one ends, and where the search for them stops.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
#: An attribute after the other: name and value, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_PARTS = re.compile(r"[A-Za-z][a-z]*|\d+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "likely", "marked", "points", "text_size", "link_size")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False, likely: bool = False, marked: float = 0.0):
        self.tag, self.parent, self.dropped, self.likely = tag, parent, dropped, likely
        self.marked = marked  # share of the page's paragraph text above which the name or form is not boilerplate; 0: no mark
        self.children: list[Node | str] = []
        self.points = 0.0
        self.text_size = self.link_size = 0


def _marks(attributes: str) -> tuple[bool, float, bool]:
    """Whether an element is hidden, the share for ``Node.marked`` by its names, and whether they say article."""
    hidden = good = saved = False
    bad: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name in ("class", "id", "role"):
            parts = {p.lower() for p in _PARTS.findall(value)} | {value.lower()}
            good = good or not parts.isdisjoint(LIKELY)
            saved = saved or not LIKELY.isdisjoint(value.lower().split())  # a name of its own, not a part as in post-comments
            bad |= parts & UNLIKELY
    return hidden, 0.0 if saved or not bad else 0.5 if bad.isdisjoint(DISCUSSION) else 0.9, good


def parse(page: str) -> Node:
    """A tree of a page that may be broken: paragraphs and list items end where HTML lets them, stray end tags are ignored, what is open at the end is closed."""
    root = Node("#root", None)
    at, node, end = 0, root, len(page)
    is_open: Counter[str] = Counter()
    controls: list[Node] = []

    def leave(to: Node) -> Node:
        here = node
        while here is not to:
            is_open[here.tag] -= 1
            here = here.parent
        return to

    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            node.children.append(page[at:])
            break
        if found.start() > at:
            node.children.append(page[at:found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            if found.group().startswith("<![CDATA["):
                node.children.append(found.group()[9:].removesuffix("]]>"))
            continue
        name, rest = name.lower(), found.group(3)
        if found.group(1):
            if is_open[name]:
                node = leave(_close(node, name))
            continue
        node = leave(_make_room(node, name, is_open))
        hidden, share, good = _marks(rest) if "=" in rest or "hidden" in rest else (False, 0.0, False)
        frame = name in ("html", "body", "article", "main")
        raw = name in _RAW_END and not is_open["svg"]
        child = Node(name, node, name in DROPPED and name != "form" or raw or hidden and not frame, good or name in ("article", "main"),
                     0.5 if name == "form" else 0.0 if frame else share)
        node.children.append(child)
        if name in CONTROLS and not hidden and not is_open["form"]:
            controls.append(child)
        closed = rest.endswith("/")
        if raw:
            stop = _RAW_END[name].search(page, at)
            if stop or name in ("script", "style"):
                at = stop.end() if stop else end
        elif name not in VOID and not (closed and name not in BLOCK):
            is_open[name] += 1
            node = child
    for control in controls:
        # in a sentence there is other text beside it
        control.dropped = not any(isinstance(c, str) and c.strip() for c in control.parent.children)
    return root


def _close(node: Node, name: str) -> Node:
    """The node that stays open after an end tag of an open element."""
    at = node
    while at.parent is not None and at.tag != name:
        # an inline end tag does not reach out of its block
        if name not in BLOCK and at.tag in BLOCK:
            return node
        at = at.parent
    return node if at.parent is None else at.parent


def _make_room(node: Node, name: str, is_open: Counter[str]) -> Node:
    """The node that a new element belongs to, after what it ends was closed."""
    if name in BLOCK and (is_open["svg"] or is_open["math"]):
        at = node
        while at.parent is not None and at.tag not in FOREIGN and at.tag != "foreignobject" and at.tag not in BLOCK:
            at = at.parent
        if at.tag in FOREIGN:
            node = at.parent
    if name in _CLOSES_P and is_open["p"]:
        at = node
        while at.parent is not None and (at.tag == "p" or at.tag not in BLOCK):
            if at.tag == "p":
                node = at.parent
                break
            at = at.parent
    if name in _ENDS:
        ends, limits = _ENDS[name]
        at, found = node, None
        while any(is_open[e] for e in ends) and at.parent is not None and at.tag not in limits:
            if at.tag in ends:
                found = at
            at = at.parent
        if found is not None:
            node = found.parent
    return node


def blocks_of(root: Node) -> list[str]:
    """Text of a subtree without dropped parts: a string a block, references decoded, white space made one space, empty blocks left out."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        run.clear()
        if text:
            blocks.append(text)

    stack: list[Node | str | None] = [root]
    while stack:
        node = stack.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            run.append(node)
        elif node.dropped and node is not root:
            if node.tag in BLOCK:
                flush()
            else:
                run.append(" " if node.tag != "input" else "")
        elif node.tag == "br":
            run.append(" ")
        else:
            if node.tag in BLOCK or node is root:
                flush()
                stack.append(None)
            stack.extend(reversed(node.children))
    flush()
    return blocks


def _order(root: Node) -> list[Node]:
    """Kept nodes, parents before children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str) and not c.dropped)
    return order


def _score(order: list[Node]) -> None:
    for node in reversed(order):
        own = 0
        commas = 0
        for c in node.children:
            if isinstance(c, str):
                text = c.strip()
                own += len(text)
                commas += text.count(",") + text.count("،") + text.count("、")
            elif not c.dropped:
                node.text_size += c.text_size
                node.link_size += c.link_size
                if c.tag not in BLOCK:
                    own += c.text_size  # inline content belongs to this paragraph
        node.text_size += sum(len(c.strip()) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.link_size = node.text_size
        if node.tag in _PARAGRAPHS and own >= 1:
            points = min(own / 25, 1) * (1 + commas + min(own / 100, 3))
            up = node.parent
            while up is not None and up.tag != "#root" and points > 1e-12:  # below that a sum does not change
                up.points += points
                points /= 2
                up = up.parent


def _drop_marked(order: list[Node]) -> bool:
    """Drops elements with a mark, unless they hold <main>, every <article> or, in a page without these, more than their share of the paragraph text; whether any was named so."""
    text, articles, mains = {}, {}, {}
    for node in reversed(order):
        kept = [c for c in node.children if not isinstance(c, str) and not c.dropped]
        inline = sum(len(c.strip()) for c in node.children if isinstance(c, str)) if node.tag in _PARAGRAPHS or node.tag not in BLOCK else 0
        text[node] = inline + sum(text[c] for c in kept)
        articles[node] = (node.tag == "article") + sum(articles[c] for c in kept)
        mains[node] = (node.tag == "main") + sum(mains[c] for c in kept)
    root, named = order[0], False
    alone = not mains[root] and not articles[root]
    for node in order:
        if node.marked:
            wraps = mains[node] or articles[node] and articles[node] == articles[root] or alone and text[node] > node.marked * text[root]
            node.dropped = not wraps
            named = named or node.dropped and node.tag != "form"
    return named


def _worth(node: Node) -> float:
    return node.points * (1 - node.link_size / max(node.text_size, 1)) * (1.5 if node.likely else 1)


def extract(page: str | None) -> str:
    """The main text: blocks of the best container and of related siblings, joined by one space; empty for a page without text. Where names
    of boilerplate leave nothing, they do not count."""
    if not page:
        return ""
    root = parse(page)
    named = _drop_marked(_order(root))
    text = _main(root)
    if not text and named:
        root = parse(page)
        for node in _order(root):
            node.dropped = node.tag == "form" and bool(node.marked)
        text = _main(root)
    return text


def _main(root: Node) -> str:
    order = _order(root)
    _score(order)
    best = max(order, key=_worth, default=root)
    if _worth(best) <= 0:
        return " ".join(blocks_of(root))
    # an article around the best container is wholly meant as one
    up = best
    while up.parent is not None:
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    if best.parent is None:
        return " ".join(blocks_of(best))
    least, siblings = max(0.2 * _worth(best), 1.0), best.parent.children
    kept, minor = set(), set()
    for at, sibling in enumerate(siblings):
        if sibling is best:
            kept.add(at)
        elif isinstance(sibling, str):
            minor.add(at)
        elif not sibling.dropped and sibling.text_size:
            links = sibling.link_size / sibling.text_size
            whole = sibling.tag == "article" and best.tag == "article" and links < 0.5
            prose = sibling.tag in ("p", "pre", "blockquote") and links < 0.25 and sibling.text_size > 80
            if whole or prose or sibling.tag not in ("p", "a") and _worth(sibling) >= least and links < 0.5:
                kept.add(at)
            elif sibling.tag in ("p", "pre", "blockquote", *_HEADINGS) and links < 0.5:
                minor.add(at)
    if best.tag not in ("article", "main"):
        # headings, short paragraphs and loose text between kept siblings, and headings right before one, belong to the text
        first, last = min(kept), max(kept)
        kept |= {at for at in minor if first < at < last}
        at = first - 1
        while at >= 0 and (isinstance(siblings[at], str) and not siblings[at].strip() or at in minor and not isinstance(siblings[at], str)
                           and siblings[at].tag in _HEADINGS):
            kept.add(at)
            at -= 1
    blocks = []
    for at in sorted(kept):
        if isinstance(siblings[at], str):
            blocks += [t] if (t := _SPACE.sub(" ", html.unescape(siblings[at])).strip()) else []
        else:
            blocks += blocks_of(siblings[at])
    return " ".join(blocks)


def main_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) in place of the html. Null and empty pages, and those without any text, give an empty
    text; each row by itself, repeated rows alike; the whole page is read."""
    schema = pa.struct([("text", pa.string()), ("n_chars", pa.int64())])

    def make():
        def work(rows: list[str | None]) -> list[dict]:
            texts = [extract(r) for r in rows]
            return [dict(text=t, n_chars=len(t)) for t in texts]
        return work

    value = per_text(make, "struct<text:string,n_chars:bigint>", schema)(F.col(f"`{source}`"))
    rest = [F.col(f"`{c}`") for c in pages.columns if c != source and c.lower() not in ("text", "n_chars")]
    return pages.select(*rest, value.alias(f"{OWN}r")).select(*rest, f"{OWN}r.*")
