"""HTML to visible text, laid out by blocks, lists and tables.

A small tree builder (implied end tags, void elements, raw-text elements) works on the
tokens of the standard library's parser; a renderer walks the tree without recursion. Text of
elements that a browser does not show is left out; nothing else is dropped. Of a select the
chosen option is shown, as browsers do.
"""

from __future__ import annotations

import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.llm.common import bounded_batches

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
UNSEEN = {"head", "title", "style", "script", "noscript", "template", "iframe", "object", "datalist", "audio", "video", "canvas"}
#: What stands in a head; any other tag, or text, ends it.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
#: Unseen within the element; tags that end it where they stand in it; and what may hold HTML in it.
FOREIGN_UNSEEN = {"svg": {"defs", "desc", "metadata", "symbol", "clippath", "mask"}, "math": {"annotation", "annotation-xml"}}
HOLDS_HTML = {"svg": {"foreignobject", "desc", "title"}, "math": {"annotation-xml", "mi", "mo", "mn", "ms", "mtext"}}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul", "caption"}
ENDS_FOREIGN = {"b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s", "small", "span", "strong", "strike", "sub", "sup", "table", "tt", "u", "ul", "var"}
ENDS_SELECT = BLOCKS - {"div", "hr"} | {"input", "select", "textarea", "tr", "td", "th", "thead", "tbody", "tfoot"}
#: Lines of their own, without being blocks to the tree builder.
LINES = {"text", "textarea"}
#: Blocks with an empty line around them.
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "ul", "ol", "dl", "article", "section", "figure", "fieldset", "hr"}
#: Start tags that end an open p; and what else a start tag ends, up to the nearest element that contains it.
ENDS_P = BLOCKS - {"li", "dd", "dt", "body", "html", "caption", "legend", "summary", "figcaption"} | {"li", "dd", "dt"}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)
#: A tag that the page ends in the middle of; browsers drop it.
_UNFINISHED = re.compile(r"<[/!?]?[a-zA-Z][^<>]*\Z")
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def hidden(self) -> bool:
        a = self.attrs
        return self.tag in UNSEEN or "hidden" in a or self.tag == "dialog" and "open" not in a or bool(_HIDDEN_STYLE.search(a.get("style") or ""))


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        self.marks: list[tuple[int, Node]] = []

    def _context(self) -> tuple[int, str]:
        """Place and tag of the innermost open svg, math or select, or of what holds HTML in one."""
        while self.marks:
            k, node = self.marks[-1]
            if k < len(self.open) and self.open[k] is node:
                return k, node.tag
            self.marks.pop()
        return 0, ""

    def _end(self, tags: set[str], within: set[str]) -> None:
        """Close from the topmost open element of ``tags``, looking no further than ``within``."""
        low = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in within:
                break
            if self.open[k].tag in tags:
                low = k
        if low is not None:
            del self.open[low:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "head" and self.open[-1].tag not in ("#root", "html"):
            return
        at, context = self._context()
        while context in FOREIGN_UNSEEN and tag in ENDS_FOREIGN or context == "select" and tag in ENDS_SELECT:
            del self.open[at:]
            at, context = self._context()
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self.open.pop()
        if tag in ENDS_P:
            self._end({"p"}, {"table", "td", "th", "caption", "button", "object", "li", "dd", "dt", "div"})
        if tag in IMPLIED:
            self._end(*IMPLIED[tag])
        elif tag in BLOCKS and any(n.tag == "head" for n in self.open[:4]):
            self._end({"head"}, set())
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        node = Node(tag, dict(attrs))
        if tag in FOREIGN_UNSEEN.get(context, ()):
            node.attrs["hidden"] = ""
        self.open[-1].children.append(node)
        if tag not in VOID:
            if tag in FOREIGN_UNSEEN or tag == "select" or tag in HOLDS_HTML.get(context, ()):
                self.marks.append((len(self.open), node))
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # Only svg, math and what is in them can close itself.
        if self.open[-1].tag == tag and (tag in FOREIGN_UNSEEN or self._foreign_parent()):
            self.open.pop()

    def _foreign_parent(self) -> bool:
        """Whether the innermost open element stands in an svg or math."""
        at, context = self._context()
        if at == len(self.open) - 1 and context not in FOREIGN_UNSEEN:  # a mark itself
            return context != "select"
        return context in FOREIGN_UNSEEN

    def handle_endtag(self, tag: str) -> None:
        scope = {"table", "td", "th", "caption"} if tag not in {"table", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "body", "html"} else {"table"} - {tag}
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if self.open[k].tag in scope:
                return
        if tag == "p":
            self.handle_starttag("p", [])
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "#root" and not data.strip():
            return
        if self.open[-1].tag == "head" and data.strip():
            self.open.pop()
        self.open[-1].children.append(data)


def width(text: str) -> int:
    """Columns that a text takes: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Layout:
    """Lines of text. ``gap`` is the number of line ends owed before the next text."""

    def __init__(self):
        self.out: list[str] = []
        self.gap = 0
        self.space = False
        self.prefix: list[str] = []
        self.marker: str | None = None

    def block(self, lines: int) -> None:
        if self.out:
            self.gap = max(self.gap, lines)
        self.space = False

    def _begin(self) -> None:
        if self.gap or not self.out:
            self.out.append("\n" * self.gap + "".join(self.prefix))
            self.gap, self.space = 0, False
            if self.marker is not None:
                self.out[-1] = self.out[-1][: len(self.out[-1]) - len(self.marker)] + self.marker
                self.marker = None

    def text(self, data: str) -> None:
        words = _SPACES.sub(" ", data)
        if words == " " or not words:
            self.space = self.space or bool(words)
            return
        leading = words[0] == " " or self.space
        fresh_line = bool(self.gap) or not self.out
        self._begin()
        if leading and not fresh_line:
            self.out.append(" ")
        self.out.append(words.strip(" "))
        self.space = words[-1] == " "

    def raw(self, data: str) -> None:
        for k, line in enumerate(data.split("\n")):
            if k:
                self.gap += 1
            if line.strip():
                self._begin()
                self.out.append(line.rstrip())

    def result(self) -> str:
        return "".join(self.out)


def _parts(table: Node) -> tuple[list[tuple[int, list[Node]]], list[Node], Node]:
    """Rows (number of their row group, cells), captions, and all else that the table holds.

    Cells and rows are found below any element but cells and tables, as browsers ignore what
    stands between; cells without a row make one.
    """
    sections, bearers = {"thead", "tbody", "tfoot"}, {id(table)}
    above, stack = {}, [table]
    while stack:  # the elements that have rows or cells below them
        x = stack.pop()
        for c in x.children:
            if isinstance(c, Node) and not c.hidden():
                above[id(c)] = id(x)
                if c.tag in ("tr", "td", "th"):
                    k = above[id(c)]
                    while k not in bearers:
                        bearers.add(k)
                        k = above[k]
                if c.tag not in ("table", "td", "th", "caption", "select"):
                    stack.append(c)
    rows, captions, stray = [], [], Node("#stray", {})
    row: list[Node] | None = None
    group, walk = 0, [(c, False) for c in reversed(table.children)]
    while walk:
        x, leaving = walk.pop()
        if isinstance(x, str):
            stray.children.append(x)
            continue
        if leaving:
            row, group = None, group + (x.tag in sections)
        elif x.hidden() or x.tag == "col":
            continue
        elif x.tag in ("td", "th"):
            if row is None:
                row = []
                rows.append((group, row))
            row.append(x)
        elif x.tag == "caption":
            captions.append(x)
        elif x.tag == "tr" or x.tag in sections:
            row, group = None, group + (x.tag in sections)
            walk.append((x, True))
            walk += [(c, False) for c in reversed(x.children)]
        elif x.tag == "colgroup" or id(x) in bearers:
            walk += [(c, False) for c in reversed(x.children)]
        else:
            stray.children.append(x)
            continue
        stray.children.append(Node("div", {}))  # what comes next is not of the same line
    return rows, captions, stray


def _number(text: str | None, default: int = 1) -> int:
    return int(text) if text and re.fullmatch("-?[0-9]{1,6}", text.strip()) else default


def _table(rows: list[tuple[int, list[Node]]], depth: int) -> str:
    """Rows with their cells in columns of equal width; a cell spans as many columns and rows as it says."""
    lines: list[list[tuple[str, int]]] = []
    held: dict[int, list[int]] = {}  # by first column: further rows of the cell, its columns
    last = 0
    for group, row in rows:
        if group != last:
            held, last = {}, group
        line, at, later = [], 0, {}
        for c in row:
            while at in held:
                line.append(("", held[at][1]))
                at += held[at][1]
            span = max(1, min(_number(c.attrs.get("colspan")), 1000))
            line.append((" ".join(render(c, depth + 1).split()), span))
            more = _number(c.attrs.get("rowspan"))
            if more > 1 or more == 0:
                later[at] = [more - 1 if more else 65534, span]
            at += span
        held = {k: [n - 1, span] for k, (n, span) in held.items() if n > 1} | later
        lines.append(line)
    widths: dict[int, int] = {}
    for cells in lines:
        at = 0
        for text, span in cells:
            if span == 1:
                widths[at] = max(widths.get(at, 0), width(text))
            at += span
    out = []
    for cells in lines:
        at, line = 0, ""
        for k, (text, span) in enumerate(cells):
            room = sum(widths.get(c, 0) for c in range(at, at + span)) + 3 * (span - 1)
            line += text + (" " * max(0, room - width(text)) + " | " if k + 1 < len(cells) else "")
            at += span
        out.append(line.rstrip())
    return "\n".join(x for x in out if x)


def _plain(node: Node) -> str:
    words, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            words.append(x)
        elif not x.hidden():
            stack += reversed(x.children)
    return " ".join("".join(words).split())


def _shown(select: Node) -> list[str]:
    """Texts of the options that a select shows: all of a list box, else the chosen one."""
    all_ = "multiple" in select.attrs or _number(select.attrs.get("size"), 0) > 1
    options: list[Node] = []
    texts, stack = [], list(reversed(select.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            texts.append(x)
        elif not x.hidden():
            if x.tag == "option":
                options.append(x)
                texts.append(x.attrs.get("label") or _plain(x))
            else:
                if x.tag == "optgroup" and x.attrs.get("label"):
                    texts.append(x.attrs["label"])
                stack += reversed(x.children)
    if not all_ and options:
        chosen = [o for o in options if "selected" in o.attrs] or [o for o in options if "disabled" not in o.attrs][:1] or options[:1]
        texts = [chosen[-1].attrs.get("label") or _plain(chosen[-1])]
    return [t for t in texts if t.strip()]


#: Nesting beyond which a table is rendered as plain blocks.
DEEP = 20


def render(root: Node, depth: int = 0) -> str:
    """Text of a tree. Tables are laid out by themselves and put in as lines."""
    layout = Layout()
    stack: list = [(root, False)]
    lists: list[list] = []
    pre = 0
    while stack:
        x, leaving = stack.pop()
        if isinstance(x, str):
            layout.raw(x) if pre else layout.text(x)
            continue
        tag = x.tag
        if leaving:
            if tag in ("ul", "ol", "menu"):
                lists.pop()
            elif tag == "li":
                layout.prefix.pop()
                layout.marker = None
            elif tag == "blockquote":
                layout.prefix.pop()
            elif tag in ("pre", "textarea"):
                pre -= 1
            if tag in BLOCKS:
                layout.block(2 if tag in SPACED and not lists else 1)
            elif tag in LINES:
                layout.block(1)
            continue
        if x.hidden():
            continue
        if tag == "br":
            layout.gap, layout.space = layout.gap + 1 if layout.out else 0, False
            continue
        if tag == "img":
            if x.attrs.get("alt"):
                layout.text(x.attrs["alt"])
            continue
        if tag == "select":
            for text in _shown(x):
                layout.space = True
                layout.text(text + " ")
            continue
        if tag in BLOCKS:
            layout.block(2 if tag in SPACED and not lists else 1)
        elif tag in ("td", "th", "tr") or tag in LINES:
            layout.block(1)
        rows, captions, stray = _parts(x) if tag == "table" and depth < DEEP else ([], [], x)
        if rows:
            for c in [stray, *captions]:
                text = render(c, depth + 1)
                if text.strip():
                    layout.raw(text.strip())
                    layout.block(1)
            layout.raw(_table(rows, depth))
            layout.block(2)
            continue
        if tag in ("ul", "ol", "menu"):
            lists.append([tag, _number(x.attrs.get("start")) - 1])
        elif tag == "li":
            kind = lists[-1] if lists else ["ul", 0]
            kind[1] = _number(x.attrs.get("value"), kind[1] + 1)
            marker = f"{kind[1]}. " if kind[0] == "ol" else "- "
            layout.prefix.append(" " * len(marker))
            layout.marker = marker
        elif tag == "blockquote":
            layout.prefix.append("> ")
        elif tag in ("pre", "textarea"):
            pre += 1
        stack.append((x, True))
        stack += [(c, False) for c in reversed(x.children)]
    return layout.result()


def visible_text(html: str | None) -> str:
    builder = TreeBuilder()
    builder.feed(_UNFINISHED.sub("", html or ""))
    builder.close()
    return render(builder.root)


def title_of(html: str | None) -> str | None:
    m = re.search(r"<title[^>]*>(.*?)</title", html or "", re.I | re.S)
    return " ".join(m.group(1).split()) if m else None


@F.pandas_udf(T.StringType())
def text_of(pages: pd.Series) -> pd.Series:
    return pages.map(visible_text)


def extract(pages: DataFrame, html: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``html`` in ``to`` (replaced if there).

    Row by row: nothing is shuffled. Null and empty pages give an empty text; broken mark-up is repaired as the
    tree builder can, an unfinished tag at the end included.
    """
    bounded_batches(pages)
    return pages.withColumn(to, text_of(html))
