"""A small tree of an HTML page, and the text of parts of it."""

from __future__ import annotations

import html
import re

import xxhash

# How HTML names its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody tfoot thead tr caption ul".split())
CELL = frozenset(("td", "th"))
# Elements that the start of another one ends.
ENDS_P = BLOCK - frozenset(("legend", "option", "optgroup", "html", "head", "body"))
ENDED_BY = {
    "p": ENDS_P, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")), "option": frozenset(("option", "optgroup")),
    "td": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "tfoot")),
    "tr": frozenset(("tr", "tbody", "tfoot")), "thead": frozenset(("tbody", "tfoot")),
    "tbody": frozenset(("tbody", "tfoot")), "head": frozenset(("body",)),
}
# What an open element of the same kind cannot be closed across.
SCOPE = frozenset("table td th caption html button ul ol dl".split())
# Elements that are never a page's text.
NEVER = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video map nav footer "
    "aside form button select textarea datalist dialog menu title noembed noframes".split())
ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog "
                  "menu menubar toolbar".split())
# Words in class or id of menus, adverts, notices, comments and the like.
MARKS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notification alert popup modal overlay newsletter "
    "subscribe subscription signup login sidebar widget related recommended recommendations share "
    "sharing social comment comments disqus respond reply replies breadcrumb breadcrumbs menu nav "
    "navbar navigation footer masthead toolbar pagination pager skip search".split())
# Those of them that count within an article too, where the others may be about its subject;
# what else an article's template holds recurs.
FOREIGN = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr newsletter comment comments disqus respond reply replies".split())
# First words of classes of articles that are not the page's own.
ASIDE = FOREIGN | frozenset("related recommended recommendations teaser".split())
# Elements of running text; inside the main part they are content however often they recur.
FLOW = frozenset(
    "p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th "
    "caption figure figcaption a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q "
    "s samp small span strike strong sub sup time tt u var br wbr hr img".split())
# Those of them that hold several parts.
CONTAINERS = frozenset("ul ol dl table figure".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.DOTALL)
# An attribute by its whole name, with its value; quoted text without a name is passed over.
ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Element:
    """An element with its children in page order; text is held as strings."""

    __slots__ = ("tag", "marks", "classes", "ids", "hidden", "role", "children", "parent", "hash",
                 "holds")

    def __init__(self, tag: str, attributes: str = "", parent: Element | None = None):
        self.tag, self.parent, self.children, self.hash = tag, parent, [], 0
        self.marks, self.hidden, self.role = "", False, ""
        self.classes, self.ids, self.holds = "", "", False
        if attributes:
            for name, value in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name not in ("class", "id", "role", "hidden", "aria-hidden"):
                    continue
                value = html.unescape(value.strip("\"'"))
                if name == "class":
                    self.marks += f" {value}"
                    self.classes += f" {value}"
                elif name == "id":
                    self.marks += f" {value}"
                    self.ids += f" {value}"
                elif name == "role":
                    self.role = value.strip().lower()
                else:
                    self.hidden |= name == "hidden" or value.lower() == "true"


def parse(page: str) -> Element:
    """The page's tree. Anything is accepted: open ends are closed, stray ends ignored."""
    root = here = Element("")
    at = 0
    skip_to = None
    for found in TAG.finditer(page):
        if skip_to is not None:
            if found.start() < skip_to:
                continue
            at, skip_to = skip_to, None
        if found.start() > at:
            here.children.append(page[at:found.start()])
        at = found.end()
        text = found.group()
        if text.startswith("<![CDATA["):
            here.children.append(html.escape(text[9:-3], quote=False))
            continue
        name = found.group(2) or found.group(5)
        if name is None:
            continue
        tag = name.lower()
        if found.group(1) or found.group(4):
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        node = here
        while node is not root:
            if tag in ENDED_BY.get(node.tag, ()):
                here = node.parent
                break
            if node.tag in SCOPE:
                break
            node = node.parent
        attributes = found.group(3) or found.group(6) or ""
        element = Element(tag, attributes, here)
        here.children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
            skip_to = end.end() if end else len(page)
        elif tag not in VOID and not attributes.endswith("/"):
            here = element
    if skip_to is None and at < len(page):
        here.children.append(page[at:])
    return root


def walk(root: Element):
    """All elements in page order, parents first."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))


def is_container(node: Element) -> bool:
    return node.tag in CONTAINERS or (node.tag in BLOCK and node.tag not in FLOW)


def may_recur(node: Element, inside: bool) -> bool:
    """Whether an element may be template on its own.

    Within an article containers only, no lists and tables. Elsewhere these too, and
    table cells that hold containers. Headings, paragraphs, list items, data cells and
    elements within a block go only with what holds them.
    """
    if inside:
        return node.tag not in FLOW and (is_container(node) or node.holds)
    return is_container(node) or (node.holds and (node.tag not in FLOW or node.tag in CELL))


def set_hashes(root: Element) -> None:
    """Give every element a hash of its whole subtree: names, marks and text.

    And note whether it holds a container.
    """
    for node in reversed(list(walk(root))):
        mixed = xxhash.xxh64(f"<{node.tag}{node.marks}>")
        for child in node.children:
            mixed.update(" ".join(child.split()) if isinstance(child, str)
                         else child.hash.to_bytes(8, "little"))
        node.hash = mixed.intdigest()
        node.holds = any(not isinstance(c, str) and (c.holds or is_container(c)) for c in node.children)


def is_marked(node: Element, inside: bool) -> bool:
    """Whether name, role, class or id say that the element is not the page's text."""
    if node.tag in NEVER or node.hidden or node.role in ROLES:
        return True
    if not inside and node.tag == "header":
        return True
    if node.tag == "article":
        firsts = (WORD.search(name) for name in node.classes.split())
        return any(w and w.group().lower() in ASIDE for w in firsts)
    if node.marks and node.tag not in ("html", "body", "main"):
        words = {w.lower() for w in WORD.findall(node.classes)}
        if node.tag in CONTAINERS or node.tag not in FLOW:
            # Within an article, and of sections, ids are slugs of what is written there.
            slug = inside or node.tag == "section"
            words.update(w.lower() for w in (node.ids.split() if slug else WORD.findall(node.ids)))
        return bool(words & (FOREIGN if inside else MARKS)) or (not inside and "header" in words)
    return False


def main_parts(root: Element) -> list[Element]:
    """Outermost articles, but for teasers and comments; else the main element; else the page."""
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.tag == tag and not (tag == "article" and is_marked(node, False)):
                found.append(node)
            elif not is_marked(node, False):
                stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
        if found:
            return found
    return [root]


def countable(root: Element) -> set[int]:
    """Hashes of all subtrees that may be part of a template.

    Containers but for the page's frame; see ``may_recur``.
    """
    found: set[int] = set()
    stack = [(root, False)]
    mains = {id(m) for m in main_parts(root)} if root.children else set()
    while stack:
        node, inside = stack.pop()
        within = inside or (id(node) in mains and node is not root)
        if node.tag not in ("", "html", "head", "body", "main", "article") and may_recur(node, inside):
            found.add(node.hash)
        if node.tag != "head":
            stack.extend((c, within) for c in node.children if not isinstance(c, str))
    return found


def blocks(root: Element, template: frozenset[int] | set[int] = frozenset()) -> list[str]:
    """Texts of the main parts' blocks in page order, without templates and marked elements."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    for part in main_parts(root):
        inside = part.tag != ""
        stack: list = [part]
        while stack:
            node = stack.pop()
            if node is None:
                end()
            elif isinstance(node, str):
                held.append(node)
            elif node is not part and is_marked(node, inside):
                end()
            elif node.hash in template and node is not part and may_recur(node, inside):
                end()
            elif node.tag == "br" or node.tag in CELL:
                held.append(" ")
                stack.extend(reversed(node.children))
            elif node.tag in BLOCK:
                end()
                stack.append(None)
                stack.extend(reversed(node.children))
            else:
                stack.extend(reversed(node.children))
        end()
    return out
