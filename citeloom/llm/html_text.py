"""HTML extraction by layout: a tree builder with implied tags, then all visible text.

Tree: tags are read with their attributes; scripts and the like are raw text up to
their end tag; missing end tags are implied as browsers do (a block closes an open
p, li closes li, dt and dd close each other, cells close cells, rows rows, option
option), end tags close what is open inside them and are ignored where nothing
matches. Nesting may have any depth; the tree keeps where each tag is open, so no
tag searches what is open.

Visibility: nothing is emitted of elements that browsers do not show (head, script,
style, template, noscript, select and such), or of closed details but for the summary.
Of others ``display`` and ``visibility`` are what the page's own rules say: the hidden
attribute and closed dialogs hide; simple selectors (tag, .class, #id) of its style
elements come next, by specificity, then order; inline styles last; ``!important``
before all. ``visibility:hidden`` hides text until a descendant is visible again. The
text of a textarea is shown, values of other form controls are not.

Layout: white space collapses as in browsers except in pre; br breaks the line;
blocks start on a line of their own and paragraphs, headings, lists, tables and
quotations are set off by one empty line; list items get "- " or their number and
are indented by depth (``max_indent`` of ``render`` may bound it); table cells are padded to
the width of their column, with colspan and rowspan, and separated by two spaces; a cell
over several columns widens the last of them where it needs more room than they have.

Defined results: null and empty pages give an empty text; text outside any tag is
text; an unclosed comment, raw element or tag runs to the end of the page; repeated
rows are each rendered; other columns are not read. Plan: one pass, no exchange.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textvec import text_slices

_words = lambda s: frozenset(s.split())

# Groups of elements of the HTML standard.
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style xmp iframe noembed noframes textarea title")
UNSEEN = _words("head script style template noscript select datalist option title meta link iframe noembed noframes object audio video canvas area base param source track")
FOREIGN = _words("svg math")
#: What these hold without showing it.
FOREIGN_UNSEEN = _words("desc metadata defs symbol clippath mask pattern marker annotation annotation-xml")
BLOCK = _words(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul tr td th thead tbody tfoot caption xmp"
)
SET_OFF = _words("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir table blockquote pre figure hr fieldset")
CLOSES_P = _words(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt"
)
SCOPE = _words("table td th caption button object html body template")
_BARRIER = (BLOCK | SCOPE) - _words("address div p")
#: A start tag on the left closes open elements of the middle, unless one of the right comes first.
IMPLIED = {
    "li": (_words("li"), _BARRIER - _words("li")),
    "dt": (_words("dt dd"), _BARRIER - _words("dt dd")),
    "dd": (_words("dt dd"), _BARRIER - _words("dt dd")),
    "option": (_words("option"), _words("select datalist")),
    "optgroup": (_words("option optgroup"), _words("select datalist")),
    "td": (_words("td th"), _words("tr table")),
    "th": (_words("td th"), _words("tr table")),
    "tr": (_words("tr td th caption colgroup"), _words("table")),
    "thead": (_words("thead tbody tfoot tr td th caption colgroup"), _words("table")),
    "tbody": (_words("thead tbody tfoot tr td th caption colgroup"), _words("table")),
    "tfoot": (_words("thead tbody tfoot tr td th caption colgroup"), _words("table")),
    "body": (_words("head"), _words("html")),
}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_BRACE = re.compile(r"[{}]")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SIMPLE = re.compile(r"[.#]?[A-Za-z_][\w-]*\Z")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    found: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


class Tree:
    """Builds the tree of one page; ``styles`` gathers the texts of its style elements."""

    def __init__(self, page: str):
        self.root = Node("#root", {})
        self.open = [self.root]
        self.where: dict[str, list[int]] = {}  # the places of each open tag in ``open``
        self.depth = 1
        self.styles: list[str] = []
        i, n = 0, len(page)
        while i < n:
            j = page.find("<", i)
            if j < 0:
                self.text(page[i:])
                break
            if j > i:
                self.text(page[i:j])
            i = self.markup(page, j)

    def text(self, s: str) -> None:
        self.open[-1].kids.append(html.unescape(s) if "&" in s else s)

    def markup(self, page: str, at: int) -> int:
        """Reads what begins with < at ``at``; where to go on."""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return len(page) if end < 0 else end + 3
        if page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            return len(page) if end < 0 else end + 1
        m = _TAG.match(page, at) or _LOOSE.match(page, at)
        if m is None:
            if re.match(r"</?[A-Za-z]", page[at : at + 3]):
                return len(page)  # an unclosed tag
            self.text("<")
            return at + 1
        tag = m[2].lower()
        if m[1]:
            self.end(tag)
            return m.end()
        if m[0].endswith("/>") and any(self.where.get(x) for x in FOREIGN):
            self.open[-1].kids.append(Node(tag, attributes(m[3])))
            return m.end()
        self.start(tag, attributes(m[3]))
        if tag not in RAW:
            return m.end()
        stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, m.end())
        inside = page[m.end() : stop.start() if stop else len(page)]
        if tag == "style":
            self.styles.append(inside)
        elif tag in ("textarea", "xmp"):
            self.text(inside.removeprefix("\n") if tag == "textarea" else inside)
        self.end(tag)
        return stop.end() if stop else len(page)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body") and self.where.get(tag):
            return
        if tag in CLOSES_P:
            self.close(_words("p"), SCOPE)
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
        if tag in ("td", "th") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self.push(Node("tr", {}))
        node = Node(tag, attrs)
        if tag in VOID:
            self.open[-1].kids.append(node)
        else:
            self.push(node)

    def push(self, node: Node) -> None:
        self.open[-1].kids.append(node)
        self.where.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)
        self.depth = max(self.depth, len(self.open))

    def cut(self, at: int) -> None:
        while len(self.open) > at:
            self.where[self.open.pop().tag].pop()

    def innermost(self, tags: frozenset[str]) -> int:
        return max((x[-1] for t in tags if (x := self.where.get(t))), default=0)

    def close(self, tags: frozenset[str], until: frozenset[str]) -> None:
        """Closes the outermost open element of ``tags`` above the innermost of ``until``."""
        places = [x for t in tags if (x := self.where.get(t))]
        if places:
            floor = self.innermost(until)
            above = [x[k] for x in places if (k := bisect_right(x, floor)) < len(x)]
            if above:
                self.cut(min(above))

    def end(self, tag: str) -> None:
        at = self.where.get(tag)
        if at and (tag in BLOCK or at[-1] >= self.innermost(SCOPE)):
            self.cut(at[-1])
        elif tag == "p":
            self.open[-1].kids.append(Node("p", {}))


def on_screen(css: str) -> str:
    """The rules outside at-rules, and those inside @layer and inside @media of every screen."""
    out, at = [], 0
    while (i := css.find("@", at)) >= 0:
        out.append(css[at:i])
        head = re.compile(r"[^;{]*").match(css, i)
        at = head.end() + 1
        if css[head.end() : at] != "{":
            continue
        depth = 1
        start = at
        while depth and (m := _BRACE.search(css, at)):
            at = m.end()
            depth += 1 if m[0] == "{" else -1
        if depth:
            at = len(css)
        kind, _, query = head[0].lower().partition(" ")
        if kind == "@layer" or (kind == "@media" and {q.strip() for q in query.split(",")} & {"", "all", "screen", "only screen"}):
            out.append(on_screen(css[start : at if depth else at - 1]))
    return "".join([*out, css[at:]])


def declared(style: str) -> dict[str, tuple[bool, str]]:
    """Of display and visibility the last value declared, and whether it is important; an important one stays."""
    found: dict[str, tuple[bool, str]] = {}
    if "isplay" not in style and "isibility" not in style and style.islower():
        return found
    for part in style.lower().split(";"):
        name, _, value = part.partition(":")
        if (name := name.strip()) in ("display", "visibility"):
            value, mark, _ = value.partition("!")
            if mark or not found.get(name, (False, ""))[0]:
                found[name] = (bool(mark), value.strip())
    return found


def page_rules(styles: list[str]) -> dict[str, list[tuple[int, dict[str, tuple[bool, str]]]]]:
    """Simple selectors with their declarations of display and visibility, in the order of the page."""
    rules: dict[str, list] = {}
    order = 0
    for css in styles:
        for m in _RULE.finditer(on_screen(re.sub(r"/\*.*?\*/", "", css, flags=re.DOTALL))):
            if said := declared(m[2]):
                order += 1
                for x in m[1].split(","):
                    if _SIMPLE.match(key := x.strip()):
                        rules.setdefault(key if key[0] in ".#" else key.lower(), []).append((order, said))
    return rules


class Writer:
    """Lines of text with collapsed space, blocks and margins."""

    def __init__(self, max_indent: int | None = None):
        self.max_indent = max_indent
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False  # a space is due before the next text
        self.margin = False
        self.indent: list[str] = []
        self.mark = ""

    def inline(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if not s:
            return
        if s[0] == " ":
            self.space, s = True, s[1:]
        if not s:
            return
        if self.space and self.parts:
            self.parts.append(" ")
        self.space = s[-1] == " "
        self.parts.append(s[:-1] if self.space else s)

    def flush(self) -> None:
        if self.parts:
            self.line("".join(self.parts))
        self.parts, self.space = [], False

    def line(self, s: str) -> None:
        if self.margin and self.lines:
            self.lines.append("")
        self.margin = False
        pad = "".join(self.indent if self.max_indent is None else self.indent[: self.max_indent])[: self.max_indent]
        if self.mark:
            pad, self.mark = pad[: len(pad) - len(self.mark)] + self.mark, ""
        self.lines.append((pad + s).rstrip(" "))

    def block(self, set_off: bool) -> None:
        self.flush()
        self.margin |= set_off

    def done(self) -> str:
        self.flush()
        return "\n".join(self.lines)


class Renderer:
    def __init__(self, rules: dict[str, list]):
        self.rules = rules
        self.foreign = 0

    def how(self, node: Node) -> str:
        """ "display" where the element is not shown, "visibility" or "shown" where its text is hidden or shown, else ""."""
        a, tag = node.attrs, node.tag
        if tag in UNSEEN or tag == "input":
            return "display"
        gone = "hidden" in a or (tag == "dialog" and "open" not in a)
        if not a and tag not in self.rules:
            return "display" if gone else ""
        said = []
        if self.rules:
            for weight, key in ((0, tag), *((1, "." + c) for c in a.get("class", "").split()), (2, "#" + a.get("id", ""))):
                said += [(weight, order, d) for order, d in self.rules.get(key, ())]
            said.sort(key=lambda x: x[:2])
        if "style" in a and (d := declared(a["style"])):
            said.append((3, 0, d))
        now: dict[str, tuple[bool, str]] = {}
        for _, _, d in said:
            now |= {k: v for k, v in d.items() if v[0] or not now.get(k, (False, ""))[0]}
        if (now["display"][1] == "none") if "display" in now else gone:
            return "display"
        seen = now.get("visibility", (False, ""))[1]
        return "visibility" if seen in ("hidden", "collapse") else "shown" if seen == "visible" else ""

    def kids(self, node: Node, w: Writer, seen: bool, pre: bool, depth: int) -> None:
        number = int(node.attrs["start"]) if re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
        shut = node.tag == "details" and "open" not in node.attrs
        for kid in node.kids:
            if isinstance(kid, str):
                if seen and not shut:
                    self.text(kid, w, pre)
            elif not shut or kid.tag == "summary":
                if kid.tag == "li":
                    value = kid.attrs.get("value", "")
                    number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
                    self.item(kid, w, seen, pre, depth, f"{number}. " if node.tag == "ol" else "- ")
                    number += 1
                else:
                    self.node(kid, w, seen, pre, depth)

    def text(self, s: str, w: Writer, pre: bool) -> None:
        if not pre:
            w.inline(s)
            return
        if w.space and w.parts:
            w.parts.append(" ")
        w.space = False
        first, *rest = s.replace("\r\n", "\n").split("\n")
        w.parts.append(first)
        for line in rest:
            w.line("".join(w.parts))
            w.parts = [line]

    def node(self, node: Node, w: Writer, seen: bool, pre: bool, depth: int) -> None:
        how = self.how(node)
        if how == "display":
            return
        seen = False if how == "visibility" else True if how == "shown" else seen
        tag = node.tag
        if self.foreign and tag in FOREIGN_UNSEEN:
            return
        if tag in FOREIGN:
            self.foreign += 1
            self.kids(node, w, seen, pre, depth)
            self.foreign -= 1
        elif self.foreign and tag == "text":
            w.inline(" ")
            self.kids(node, w, seen, pre, depth)
            w.inline(" ")
        elif tag == "br":
            if seen:
                w.line("".join(w.parts))
                w.parts, w.space = [], False
        elif tag == "textarea":
            self.kids(node, w, seen, True, depth)
        elif tag == "table":
            self.table(node, w, seen, depth)
        elif tag in BLOCK:
            off = tag in SET_OFF and not (depth and tag in ("ul", "ol", "menu", "dir"))
            w.block(off)
            inner = tag in ("blockquote", "dd") or (depth and tag in ("ul", "ol", "menu", "dir"))
            if inner:
                w.indent.append("  ")
            self.kids(node, w, seen, pre or tag in ("pre", "xmp"), depth + (tag in ("ul", "ol", "menu", "dir")))
            w.block(off)
            if inner:
                w.indent.pop()
        else:
            self.kids(node, w, seen, pre, depth)

    def item(self, node: Node, w: Writer, seen: bool, pre: bool, depth: int, mark: str) -> None:
        how = self.how(node)
        if how == "display":
            return
        seen = False if how == "visibility" else True if how == "shown" else seen
        w.block(False)
        w.indent.append(" " * len(mark))
        w.mark = mark
        # nested lists are indented by their item already
        inner = Node("li", node.attrs)
        inner.kids = node.kids
        nested, w.indent = w.indent, list(w.indent)
        self.items_kids(inner, w, seen, pre, depth)
        w.block(False)
        w.indent = nested
        w.indent.pop()
        w.mark = ""

    def items_kids(self, node: Node, w: Writer, seen: bool, pre: bool, depth: int) -> None:
        for kid in node.kids:
            if isinstance(kid, str):
                if seen:
                    self.text(kid, w, pre)
            elif kid.tag in ("ul", "ol", "menu", "dir") and self.how(kid) != "display":
                how = self.how(kid)
                w.block(False)
                self.kids(kid, w, False if how == "visibility" else True if how == "shown" else seen, pre, depth + 1)
                w.block(False)
            else:
                self.node(kid, w, seen, pre, depth)

    def rows_of(self, table: Node, seen: bool, around: set[int]) -> Iterator[tuple[Node, bool]]:
        todo = [(kid, seen) for kid in reversed(table.kids)]
        while todo:
            kid, own = todo.pop()
            if isinstance(kid, str) or (how := self.how(kid)) == "display":
                continue
            own = False if how == "visibility" else True if how == "shown" else own
            if kid.tag == "tr":
                yield kid, own
            elif id(kid) in around:
                todo += [(x, own) for x in reversed(kid.kids)]

    def strays(self, node: Node, w: Writer, seen: bool, depth: int, around: set[int]) -> None:
        """Captions, and what does not belong into a table, its sections and rows."""
        for k in node.kids:
            if isinstance(k, str):
                if seen and not k.isspace():
                    w.inline(k)
            elif k.tag == "tr" or id(k) in around:
                if (how := self.how(k)) != "display":
                    inner = Node(k.tag, k.attrs)
                    inner.kids = [x for x in k.kids if isinstance(x, str)] if k.tag == "tr" else k.kids
                    self.strays(inner, w, False if how == "visibility" else True if how == "shown" else seen, depth, around)
            elif k.tag not in ("colgroup", "col"):
                self.node(k, w, seen, False, depth)

    def table(self, table: Node, w: Writer, seen: bool, depth: int) -> None:
        w.block(True)
        around, todo = set(), [(table, ())]  # sections, and what else has rows of this table in it
        while todo:
            node, above = todo.pop()
            for k in node.kids:
                if isinstance(k, str) or k.tag == "table":
                    continue
                if k.tag == "tr":
                    up = above
                    while up and id(up[0]) not in around:
                        around.add(id(up[0]))
                        up = up[1]
                else:
                    if k.tag in ("thead", "tbody", "tfoot"):
                        around.add(id(k))
                    todo.append((k, (k, above)))
        self.strays(table, w, seen, depth, around)
        w.flush()
        grid: list[dict[int, list[str]]] = []
        below: dict[int, int] = {}
        spans: list[tuple[int, int, int]] = []
        span = lambda c, k: min(max(int(c.attrs[k]), 1), 1000) if c.attrs.get(k, "").isdecimal() else 1
        for row, shown in self.rows_of(table, seen, around):
            cells: dict[int, list[str]] = {}
            below = {c: n - 1 for c, n in below.items() if n > 1}
            at = 0
            for cell in row.kids:
                if isinstance(cell, str) or (how := self.how(cell)) == "display":
                    continue
                while at in below:
                    at += 1
                own = Writer(w.max_indent)
                self.kids(cell, own, False if how == "visibility" else True if how == "shown" else shown, False, 0)
                cells[at] = own.done().split("\n")
                wide, tall = span(cell, "colspan"), span(cell, "rowspan")
                if wide > 1:
                    spans.append((len(grid), at, wide))
                if tall > 1:
                    below |= {c: tall for c in range(at, at + wide)}
                at += wide
            grid.append(cells)
        wide_cells = {(r, c): n for r, c, n in spans}
        used = sorted({c for cells in grid for c in cells})  # a column in which no cell begins takes no room
        width = dict.fromkeys(used, 0)
        for r, cells in enumerate(grid):
            for c, lines in cells.items():
                if (r, c) not in wide_cells:
                    width[c] = max(width[c], *map(len, lines))
        for r, c, n in sorted(spans, key=lambda x: x[2]):
            over = used[bisect_left(used, c) : bisect_left(used, c + n)]
            width[over[-1]] += max(0, max(map(len, grid[r][c])) - sum(width[x] + 2 for x in over) + 2)
        start, at = {}, 0
        for c in used:
            start[c], at = at, at + width[c] + 2
        for cells in grid:
            if not any(any(x) for x in cells.values()):
                continue
            for k in range(max(map(len, cells.values()))):
                out = ""
                for c in sorted(cells):
                    if k < len(cells[c]):
                        out = out.ljust(start[c]) + cells[c][k]
                w.line(out)
        w.block(True)


def render(page: str | None, max_indent: int | None = None) -> str:
    """All visible text of one page; with ``max_indent`` no line is indented by more characters (nested lists then lose depth)."""
    if not page:
        return ""
    tree = Tree(page)
    w, had = Writer(max_indent), sys.getrecursionlimit()
    # frames of Python code are on the heap; the renderer has up to four for each level of the tree
    sys.setrecursionlimit(had + 5 * tree.depth)
    try:
        Renderer(page_rules(tree.styles)).kids(tree.root, w, True, False, 0)
    finally:
        sys.setrecursionlimit(had)
    return w.done()


def _rendered(batches: Iterator[pa.RecordBatch], max_indent: int | None = None) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in text_slices(whole, 1, 8_000_000):
            texts = [render(x, max_indent) for x in b.column(1).to_pylist()]
            raw = [t.encode("utf-8", "replace") for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": b.column(0),
                    "text": pa.array([x.decode() for x in raw], pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                    "n_lines": pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                    "text_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in raw], pa.string()),
                }
            )


def visible_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_indent: int | None = None) -> DataFrame:
    """One row per page: id, text, n_chars, n_lines and text_sha256."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(html_col).cast("string").alias("_html"))
    out = rows.mapInArrow(partial(_rendered, max_indent=max_indent), f"_id {rows.schema['_id'].dataType.simpleString()}, text string, n_chars long, n_lines long, text_sha256 string")
    return out.withColumnRenamed("_id", id_col)
