"""Main text of web pages by composite text density.

A page is read once into a tree of elements. Each element has its characters, tags, characters inside links and links,
all of its subtree. Its density is the number of characters for each tag, lowered by what links make of it; the sum
over its children says how much dense text it holds together. The element with the largest sum is the core; the
threshold is the lowest density on the path from the body to the core, and the main text is all that reaches it, with
the headings and paragraphs between. Where the core lies in an article element, the main text is that element and all
others that reach the threshold. Elements that are never part of an article are left out beforehand, and so are those
whose names say so; inside an article, names that may as well be a topic only decide where the text is sparse.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from litscreen.llm.texts import Texts, by_slices

#: Element names by their part in HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp", "plaintext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
LEFT_OUT = RAW | {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "label", "input", "fieldset",
                  "dialog", "template", "svg", "canvas", "object", "audio", "video", "menu", "math"}
BLOCKS = {"html", "body", "address", "article", "blockquote", "center", "dd", "details", "div", "dl", "dt", "figcaption", "figure",
          "h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "hr", "li", "main", "ol", "p", "pre", "section", "summary", "table",
          "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"} | LEFT_OUT - {"label", "button", "input", "select", "svg"}
BOXES = {"div", "section", "center", "details"}
#: Elements that a new element ends if it is open, up to the nearest of the elements behind them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
INLINE_SCOPE = {"table", "td", "th", "caption", "button", "object", "article", "main"}

#: Words of class, id and role that name what is not the article.
NOT_ARTICLE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebars?|side|topbar|footers?|"
    r"headers?|masthead|comments?|commentlist|usercomments|disqus|replies|reply|respond|cookies?|consent|gdpr|notices?|disclaimers?|announcements?|alerts?|newsletter|"
    r"subscri\w+|popup|modal|overlay|share|sharing|social|related|recommend\w*|widgets?|toolbar|pagination|pager|copyright|"
    r"contentinfo|complementary|navigation|search|login|signup|hidden)(?=$|[\s_-])", re.I)

#: Of these, words that may be a topic as well (related work, market share, side effects).
TOPIC = re.compile(r"search|related|side|menu\w*|alerts?|reply|replies|respond|share|sharing|social|hidden|recommend\w*|widgets?|login|signup|overlay|modal", re.I)

#: Class words that describe what a wrapper has or lacks; they do not name the wrapper itself.
LAYOUT = re.compile(r"(?:\S*[_-])?(?:no|has|have|with|without)[_-]\S*|\S*[_-]free", re.I)

_token = re.compile(r"<!--.*?(?:-->|--!>|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_attribute = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_white = re.compile(r"\s+")
_raw_end = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I) for name in RAW}


@dataclass(slots=True, eq=False)
class Node:
    name: str
    parent: Node | None = None
    dropped: bool = False
    left_out: bool = False  # by element or as hidden
    named: bool = False  # by its name alone
    hinted: bool = False  # by a name that may be a topic; density decides
    is_article: bool = False  # an article or main element that no name calls something else
    parts: list[Node | str] = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    links: int = 0
    density: float = 0.0
    total: float = 0.0


def _in_article(node: Node | None) -> bool:
    while node is not None and node.name not in ("article", "main"):
        node = node.parent
    return node is not None


def _is_left_out(name: str, attributes: str, parent: Node) -> bool:
    """By element, or as hidden. An article may have a header of its own."""
    if name in LEFT_OUT and not (name == "header" and _in_article(parent)):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _attribute.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _name_says(attributes: str, parent: Node) -> str:
    """What class, id and role say of an element: "out", "maybe" or nothing.

    Words that describe what a wrapper has or lacks do not count, and inside an article some are no more than a hint.
    """
    said = ""
    for m in _attribute.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() not in ("class", "id", "role"):
            continue
        for word in NOT_ARTICLE.finditer(" ".join(w for w in value.split() if not LAYOUT.fullmatch(w))):
            inside = _in_article(parent)
            if inside and TOPIC.fullmatch(word[0].strip(" \t\n\r\f_-")):
                said = "maybe"
            elif not ("header" in word[0].lower() and inside):
                return "out"
    return said


def _take_back(root: Node) -> None:
    """Names that leave out the only articles of a page, or nearly all of its text, name wrappers, which stay."""
    nodes = _in_order(root)
    articles = [n for n in nodes if n.is_article]
    if not any(n.named for n in nodes) or any(not n.dropped for n in articles):
        return
    hidden, chars, shown = set(), dict.fromkeys(map(id, nodes), 0), 0
    for node in nodes:
        if node.left_out or id(node.parent) in hidden:
            hidden.add(id(node))
    for node in reversed(nodes):
        if id(node) in hidden:
            continue
        own = sum(len(_white.sub(" ", p).strip()) for p in node.parts if isinstance(p, str))
        shown += 0 if node.dropped else own
        chars[id(node)] += own
        if node.parent is not None:
            chars[id(node.parent)] += chars[id(node)]
    held = [n for n in articles if id(n) not in hidden]
    if held and sum(chars[id(n)] for n in held) > shown:
        seen = set()
        for node in held:
            while node is not None and id(node) not in seen:
                seen.add(id(node))
                node.named = False
                node = node.parent
    elif not articles:
        for node in nodes:
            if node.named and id(node) not in hidden and chars[id(node)] > 0.9 * chars[id(root)]:
                node.named = False
    for node in nodes:
        node.dropped = node.left_out or node.named or node.parent is not None and node.parent.dropped


def parse(page: str) -> Node:
    """The tree of a page. Unclosed and stray tags do no harm; what never closes ends with its parent."""
    root = at = Node("#root")
    place = 0
    while place < len(page):
        m = _token.search(page, place)
        if m is None:
            at.parts.append(html.unescape(page[place:]))
            break
        if m.start() > place:
            at.parts.append(html.unescape(page[place:m.start()]))
        place = m.end()
        name = (m[3] or "").lower()
        if m[1]:
            at.parts.append(m[1])
        if not name:
            continue
        if m[2]:
            at = _close(at, name)
            continue
        at = _make_room(at, name)
        left_out, whole = _is_left_out(name, m[4], at), name in ("html", "body", "article", "main")
        said = _name_says(m[4], at) if m[4] else ""
        named = said == "out" and not whole
        node = Node(name, at, at.dropped or left_out or named, left_out, named, said == "maybe" and not whole,
                    name in ("article", "main") and said != "out")
        at.parts.append(node)
        if name in RAW:
            end = _raw_end[name].search(page, place)
            place = end.end()
        elif name not in VOID and not (m[4].endswith("/") and name not in BLOCKS and name != "a"):
            at = node
    _take_back(root)
    return root


def _close(at: Node, name: str) -> Node:
    node = at
    while node.parent is not None and node.name != name:
        if node.name in INLINE_SCOPE and name not in BLOCKS:
            return at  # an inline end tag does not reach out of here
        node = node.parent
    return node.parent if node.parent is not None else at


def _make_room(at: Node, name: str) -> Node:
    """Close what cannot stay open: a paragraph before a block, an item before the next one."""
    ended, until = ENDS.get(name, ((), ()))
    if ended:
        node, last = at, None
        while node.parent is not None and node.name not in until:
            if node.name in ended:
                last = node
            node = node.parent
        if last is not None:
            return last.parent
    if name in BLOCKS:
        node = at
        while node.parent is not None and node.name not in INLINE_SCOPE and (node.name not in BLOCKS or node.name == "p"):
            if node.name == "p":
                return node.parent
            node = node.parent
        if at.name in ("h1", "h2", "h3", "h4", "h5", "h6") and name in ("h1", "h2", "h3", "h4", "h5", "h6", "p"):
            return at.parent
    return at


def _in_order(root: Node) -> list[Node]:
    """Every node after its parent."""
    found, stack = [], [(root)]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return found


def _measure(nodes: list[Node], body: Node) -> None:
    for node in reversed(nodes):
        if node.dropped:
            continue
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(_white.sub(" ", part).strip())
            elif not part.dropped:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.links += part.links
        if node.name == "a":
            node.link_chars, node.links = node.chars, node.links + 1
    ratio = body.link_chars / max(1, body.chars)
    for node in nodes:
        node.density = density(node.chars, node.tags, node.link_chars, node.links, ratio)
    for node in nodes:
        node.total = sum(p.density for p in node.parts if isinstance(p, Node) and not p.dropped)


def density(chars: int, tags: int, link_chars: int, links: int, ratio: float) -> float:
    """Characters for each tag, times a logarithm that falls with the share of links; ``ratio`` is that of the page."""
    if not chars:
        return 0.0
    tags, links, link_chars = max(1, tags), max(1, links), max(1, link_chars)
    plain = max(1, chars - link_chars)
    base = math.log(chars * link_chars / plain + ratio * chars + math.e)
    return chars / tags * math.log(chars * tags / (link_chars * links) + 1) / base


def main_subtree(root: Node) -> Node:
    """The element with the largest sum, widened as far as the threshold of its path allows."""
    nodes = _in_order(root)
    body = next((n for n in nodes if n.name == "body" and not n.dropped), root)
    _measure(nodes, body)
    inside = [n for n in _in_order(body) if not n.dropped]
    core = max(inside, key=lambda n: n.total)
    path = [core]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    # Go up while nothing as sparse as the threshold is met, past boxes that hold no more text, and to the article that
    # the page itself names.
    for node in inside:
        if node.hinted and node.density < threshold:
            node.dropped = True
    named = [i for i, n in enumerate(path) if n.name == "article"] or [i for i, n in enumerate(path) if n.name == "main"]
    if named:
        return _articles(inside, path[named[-1]], threshold)
    best = core
    for node in path[1:]:
        if node.chars == best.chars or node.density > threshold and node is not body:
            best = node
        else:
            break
    # Beside the path, what is mostly links and sparser than the threshold is a menu without a name.
    at, on_path = path.index(best), set(map(id, path))
    for node in path[1:at + 1]:
        for part in node.parts:
            if isinstance(part, Node) and id(part) not in on_path and 2 * part.link_chars > part.chars and part.density < threshold:
                part.dropped = True
    # Further out, boxes stay that reach the threshold, whole or in part, and all that is no box but links.
    todo = path[at + 1:]
    while todo:
        node = todo.pop()
        for part in node.parts:
            if isinstance(part, Node) and not part.dropped and id(part) not in on_path and part.density < threshold:
                if part.name in BOXES and any(isinstance(p, Node) for p in part.parts):
                    todo.append(part)
                elif part.name in BOXES or 2 * part.link_chars > part.chars:
                    part.dropped = True
    return body


def _articles(inside: list[Node], chosen: Node, threshold: float) -> Node:
    """The article of the core and those beside it that reach the threshold, in page order, below one node."""
    kept, held = Node("#articles"), set()
    for node in inside:  # parents come first
        if id(node.parent) in held:
            held.add(id(node))
        elif node is chosen or node.name == chosen.name and node.is_article and not node.dropped and node.density >= threshold:
            held.add(id(node))
            kept.parts.append(node)
    return kept


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, in page order."""
    found: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _white.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            found.append(text)

    stack: list[Node | str | None] = [node]
    while stack:
        part = stack.pop()
        if part is None:
            end()
        elif isinstance(part, str):
            line.append(part)
        elif part.name in ("br", "wbr"):
            line.append(" " if part.name == "br" else "")
        elif not part.dropped:
            if part.name in BLOCKS:
                end()
                stack.append(None)
            stack.extend(reversed(part.parts))
        elif part.name in BLOCKS:
            end()
    end()
    return found


def main_text(page: str) -> str:
    """Blocks of the main subtree, joined by an empty line; empty if the page has no text."""
    return "\n\n".join(blocks(main_subtree(parse(page))))


def extract(pages: DataFrame) -> DataFrame:
    """``text`` and its ``n_chars`` of each page; a null page has none. One row for each row, nothing is shuffled."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("text"))

    def work(part, texts: Texts):
        found = [main_text(t.decode()) for t in texts.bytes()]
        return {"page_id": part["page_id"], "url": part["url"], "text": found, "n_chars": list(map(len, found))}

    return by_slices(rows, work, "page_id long, url string, text string, n_chars long")
