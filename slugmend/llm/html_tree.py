"""A lenient reader of HTML: tags with their paths and roles, and text runs, in page order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

OPEN, CLOSE, TEXT = range(3)
# Roles of a place: plain, inside something that is never main text, inside a declared article.
PLAIN, EXCLUDED, ARTICLE = range(3)

# Element names of the HTML standard by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_TEXT = frozenset(
    "head nav header footer aside form button select menu dialog object canvas audio video map datalist".split()
) | RAW
# An open element of the first kind ends where one of the second starts.
ENDS_AT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
LIST_OF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
# Of these, elements that may stand around a declared article (a form around the whole page, a header with its article).
AROUND = frozenset("form header".split())
# Names of class, id and role attributes that name page furniture.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social related "
    "recommended recommendations sidebar side aside widget widgets menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer header masthead topbar comment comments commentlist disqus respond reply replies login search "
    "toolbar skip copyright contentinfo complementary dialog form".split()
)
# Furniture of which a declared article is no main text: menus, footers, comments.
FIRM = frozenset(
    "nav navbar navigation footer aside comment comments commentlist disqus respond reply replies menu dialog modal popup".split()
)
# Parts that a name of page furniture may have besides: main-nav, site-footer, share-buttons, ad-box.
HELPERS = frozenset(
    "site page main top bottom left right primary secondary global mobile desktop box bar block list item items link links "
    "button buttons icon icons wrapper wrap container inner outer content area section row col text message title head body "
    "post posts article articles entry story stories news media form panel slot unit id js header region group the my".split()
)
#: Elements of text: inside a declared article their names exclude nothing.
TEXTS = HEADINGS | {"p"}
#: Elements that hold a whole page or article: their names and classes exclude nothing.
HOLDERS = frozenset("html body main article".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>?"
    r"|(?P<text>[^<]+)|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_PARTS = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Element:
    name: str
    path: str
    role: int
    in_link: bool = False
    header: bool = False  #: an excluded header inside an article: its headings stay
    firm: bool = False  #: excluded together with any article below


@dataclass(slots=True)
class Item:
    """A tag or a text run. ``path``: of the element it opens, closes or stands in; ``text``: as written, with
    character references."""

    kind: int
    path: str
    role: int
    name: str = ""
    text: str = ""
    in_link: bool = False
    block: bool = False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(raw)}


def _names(attrs: dict[str, str]) -> frozenset[str]:
    said = " ".join(attrs.get(a, "") for a in ("class", "id", "role", "itemprop"))
    return frozenset(_WORDS.findall(_CAMEL.sub(" ", said).lower()))


def _furniture(attrs: dict[str, str], given: tuple[str, ...]) -> frozenset[str]:
    """Words of page furniture in names that consist of such words and helpers; has-sidebar and related-work are none."""
    found: set[str] = set()
    for a in given:
        for name in _CAMEL.sub("-", attrs.get(a, "")).lower().split():
            parts = [w for w in _PARTS.split(name) if w]
            if all(w in FURNITURE or w in HELPERS for w in parts):
                found.update(w for w in parts if w in FURNITURE)
    return frozenset(found)


def _enter(parent: Element, name: str, raw: str) -> Element:
    attrs = _attributes(raw) if raw and not raw.isspace() else {}
    words = _names(attrs) if attrs else frozenset()
    label = name + "".join("." + w for w in sorted(words))
    role, header, firm = parent.role, parent.header, parent.firm
    furniture, hidden = words & FURNITURE, _hidden(attrs)
    if furniture:
        # Ids of headings are made of their text, and text elements of an article are text.
        given = ("class", "role", "itemprop") if name in HEADINGS else ("class", "id", "role", "itemprop")
        furniture = frozenset() if role == ARTICLE and name in TEXTS else _furniture(attrs, given)
    if name in HOLDERS:
        if name in ("article", "main") and not firm and role != ARTICLE:
            role, header = ARTICLE, False
    elif role == ARTICLE and (name == "header" or "header" in furniture) and furniture <= {"header"}:
        role, header = EXCLUDED, True
    elif name in HEADINGS and header:
        role, header = ARTICLE, False
    elif name in NEVER_TEXT or furniture or hidden:
        # Within an article what is excluded stays so; its own sidebars may have articles of others.
        firm = firm or role == ARTICLE or name in NEVER_TEXT - AROUND or bool(furniture & FIRM) or hidden
        role, header = EXCLUDED, False
    elif role == PLAIN and ("articlebody" in attrs.get("itemprop", "").lower().split() or attrs.get("role", "").lower() == "main"):
        role = ARTICLE
    return Element(name, f"{parent.path}/{label}", role, parent.in_link or name == "a", header, firm)


def _hidden(attrs: dict[str, str]) -> bool:
    return bool(attrs) and (
        "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
        or "display:none" in attrs.get("style", "").replace(" ", "").lower()
    )


def read(html: str) -> Iterator[Item]:
    """Items of a page. Comments, declarations and the content of raw elements give none."""
    stack = [Element("", "", PLAIN)]
    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.match(html, at)
        at = m.end()
        if m["text"] is not None or m[0] == "<":
            top = stack[-1]
            yield Item(TEXT, top.path, top.role, text=m[0], in_link=top.in_link)
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if m["end"]:
            yield from _close(stack, name)
            continue
        if name in BLOCK:
            yield from _close_until(stack, "p", BLOCK - {"p"})
        if name in ENDS_AT:
            for other in ENDS_AT[name]:
                yield from _close_until(stack, other, LIST_OF[name])
        made = _enter(stack[-1], name, m["attrs"])
        yield Item(OPEN, made.path, made.role, name, block=name in BLOCK)
        if name in RAW:
            if m[0].endswith("/>") and name in ("svg", "math"):
                continue
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            at = stop.end() if stop else end
            yield Item(CLOSE, made.path, made.role, name)
        elif name not in VOID and not m[0].endswith("/>"):
            stack.append(made)


def _close(stack: list[Element], name: str) -> Iterator[Item]:
    """An end tag closes the nearest open element of its name; an inline one not beyond its block."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == name:
            yield from _pop_to(stack, i)
            return
        if name not in BLOCK and stack[i].name in BLOCK:
            return


def _close_until(stack: list[Element], name: str, bounds: frozenset[str] | set[str]) -> Iterator[Item]:
    """Close an open ``name`` that no element of ``bounds`` stands above."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name == name:
            yield from _pop_to(stack, i)
            return
        if stack[i].name in bounds:
            return


def _pop_to(stack: list[Element], i: int) -> Iterator[Item]:
    while len(stack) > i:
        gone = stack.pop()
        yield Item(CLOSE, gone.path, gone.role, gone.name, block=gone.name in BLOCK)
