"""The leaf blocks of an HTML page: text runs between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

_NAMES = """
    address article aside blockquote body button caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html
    label legend li main menu nav ol option p pre search section select summary table tbody td
    tfoot th thead title tr ul xmp
"""
BLOCKS = frozenset(_NAMES.split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not markup; only that of xmp is shown as text of the page.
RAW = frozenset("iframe noembed noframes script style template textarea title xmp".split())
# Also not shown; the content is markup.
HIDDEN = frozenset("head noscript svg canvas audio video datalist".split())
_CLOSES_P = BLOCKS - frozenset("button label option body html head".split())
# A new one ends an open one, unless an element of the second set stands between.
_SIBLINGS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
_P = frozenset({"p"})
_P_SCOPE = frozenset({"button", "table", "td", "th", "caption", "object", "html"})

# A quoted value may hold a ">"; atomic groups keep broken tags from being tried in many ways.
_MARKUP = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<other>[!?][^>]*>)"
    r"|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>)",
    re.DOTALL,
)
# Name by name, each with its whole value.
_ATTRIBUTE = re.compile(
    r"([^\s/=>][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_TOKEN = re.compile(r"[a-z]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?:;|$)")


@dataclass(frozen=True)
class Block:
    text: str
    # Block-level ancestors from the outermost, each as tag and tokens of class, id and role.
    ancestors: tuple[tuple[str, tuple[str, ...]], ...]
    link_chars: int


def _marks(attrs: str) -> tuple[tuple[str, ...], bool]:
    """Tokens of class, id and role, and whether the element is not shown."""
    tokens: list[str] = []
    hidden = False
    for name, a, b, c in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role"):
            tokens += _TOKEN.findall(value)
        elif name == "style":
            hidden |= _NOT_SHOWN.search(value) is not None
        elif name == "hidden":
            hidden = True
    return tuple(tokens), hidden


class _Page:
    def __init__(self):
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.hidden: list[int] = []  # heights of the stack at which hidden elements stand
        self.parts: list[str] = []
        self.link_chars = 0
        self.in_link = False

    def text(self, raw: str, plain: bool = False) -> None:
        if self.hidden or not raw:
            return
        text = unescape(raw) if "&" in raw and not plain else raw
        self.parts.append(text)
        if self.in_link:
            self.link_chars += len(" ".join(text.split()))

    def end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, tuple(self.stack), self.link_chars))
            self.parts = []
        self.link_chars = 0

    def push(self, name: str, attrs: str) -> None:
        tokens, hidden = _marks(attrs) if attrs else ((), False)
        if name not in VOID:
            self.stack.append((name, tokens))
            if hidden or name in HIDDEN:
                self.hidden.append(len(self.stack))

    def pop_to(self, names: frozenset[str], scope: frozenset[str]) -> None:
        """Close the innermost of `names`, and all in it, unless one of `scope` stands between."""
        for height in range(len(self.stack), 0, -1):
            name = self.stack[height - 1][0]
            if name in names:
                del self.stack[height - 1:]
                while self.hidden and self.hidden[-1] >= height:
                    self.hidden.pop()
                return
            if name in scope:
                return

    def start(self, name: str, attrs: str) -> None:
        if name == "a":
            self.in_link = True
        elif name == "br":
            self.text(" ")
        elif name in HIDDEN and name not in BLOCKS:
            if not attrs.rstrip().endswith("/"):
                self.push(name, "")
        elif name in BLOCKS:
            self.end_block()
            self.in_link = False
            if name == "body":  # a head without its end tag ends here
                self.pop_to(frozenset({"head"}), frozenset())
            if name in _CLOSES_P:
                self.pop_to(_P, _P_SCOPE)
            if name in _SIBLINGS:
                self.pop_to(*_SIBLINGS[name])
            self.push(name, attrs)

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        elif name in BLOCKS:
            self.end_block()
            self.in_link = False
            self.pop_to(frozenset({name}), frozenset())
        elif name in HIDDEN:
            self.pop_to(frozenset({name}), frozenset())


def blocks(html: str) -> list[Block]:
    """The shown text blocks in page order: references decoded, white space as one space."""
    page, at = _Page(), 0
    closing = html.rfind(">") + 1  # beyond it there is no tag, and "<" is text
    for_search = html[:closing] if closing else ""
    while found := _MARKUP.search(for_search, at):
        page.text(html[at:found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if found["end"]:
            page.end(name)
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            if name == "xmp":
                page.start(name, found["attrs"])
                page.text(html[at:end.start() if end else len(html)], plain=True)
                page.end(name)
            elif name in BLOCKS:
                page.end_block()
            at = end.end() if end else len(html)
        else:
            page.start(name, found["attrs"])
    page.text(html[at:])
    page.end_block()
    return page.blocks
