"""Visible text of HTML pages, laid out as a reader would see it.

A tree builder reads tags, supplies those that are implied (the end of a
paragraph before a block, of a list item before the next, rows around cells)
and ignores end tags without a start. Visibility rules then leave out what a
browser does not show: head, scripts, styles, templates, media, unselected
form choices, closed dialogs, ``hidden``, ``display:none`` and ``visibility:hidden`` (inherited,
``visible`` further down ends it). Inline styles alone are read. What remains is written
with line breaks between blocks, an empty line around paragraphs, headings,
lists and tables, markers and indents for list items, and table cells padded
to columns, with cells that span columns or rows. Preformatted text keeps its
white space. Both passes use explicit stacks, so nesting of any depth is no problem.

Edge cases: a null page gives a null text, an empty one an empty text;
unclosed tags, comments and quotes end with the page; null ids, repeated rows
and extra columns pass through; very long pages are read whole; an empty table gives no rows; an input column
with the name of an output gives way to it.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.util import boxed, table, unboxed


TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)"""
                   r"""((?:[^"'>]++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""", re.S)
ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
#: Declarations of an inline style; semicolons in strings and brackets are no ends.
DECLARATION = re.compile(r"""((?:"[^"]*"|'[^']*'|\([^)]*\)|[^;"'(])+)""")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title meta link iframe noembed noframes "
                   "audio video canvas datalist annotation annotation-xml".split())
#: Not drawn inside svg, and start tags that leave an unclosed head open.
SVG_UNSEEN = frozenset("defs symbol metadata desc clippath mask pattern marker".split())
IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
#: Blocks with an empty line around them, and those on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCK = SPACED | frozenset("html body div section article aside main nav header footer address center details summary "
                           "dialog fieldset form figcaption legend li dt dd tr caption thead tbody tfoot td th".split())
#: Start tag -> the open tags that it ends, and the tags that shield them.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    **{t: (("thead", "tbody", "tfoot", "tr", "caption", "colgroup"), ("table",)) for t in ("thead", "tbody", "tfoot")},
    "option": (("option",), ("select", "datalist")),
}
P_ENDERS = BLOCK - {"html", "body", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "legend"}
P_SHIELDS = ("table", "td", "th", "caption", "button", "object", "template")


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def attr(self, name: str) -> str | None:
        for m in ATTR.finditer(self.attrs):
            if m[1].lower() == name:
                return html.unescape(m[2] or m[3] or m[4] or "")
        return None

    def style(self) -> dict[str, str]:
        """Property -> value of the inline style, as the last or important declaration has it."""
        out, firm = {}, set()
        for m in DECLARATION.finditer(COMMENT.sub(" ", self.attr("style") or "")):
            name, _, value = m[1].partition(":")
            name, (value, bang, note) = name.strip().lower(), value.strip().lower().partition("!")
            important = bool(bang) and note.strip() == "important"
            if important or name not in firm:
                out[name] = value.strip()
            if important:
                firm.add(name)
        return out

    def hidden(self) -> tuple[bool, str | None]:
        """Whether the subtree is left out, and its own visibility if it has one."""
        if self.tag in UNSEEN or self.tag == "dialog" and self.attr("open") is None:
            return True, None
        if not self.attrs:
            return False, None
        low = self.attrs.lower()
        if "hidden" in low and self.attr("hidden") is not None:
            return True, None
        if "style" not in low:
            return False, None
        style = self.style()
        seen = style.get("visibility")
        return style.get("display") == "none", seen if seen in ("visible", "hidden", "collapse") else None

    def walk(self, tags: tuple[str, ...]) -> list[Node]:
        """Nodes of these tags below this one, in page order."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.tag in tags:
                out.append(x)
            todo += [k for k in reversed(x.kids) if isinstance(k, Node)]
        return out


def choices(select: Node) -> tuple[list, bool]:
    """What a closed menu or a list box shows, and whether it is a list box."""
    size = select.attr("size") or ""
    box = select.attr("multiple") is not None or bool(re.fullmatch(r"\d{1,9}", size)) and int(size) > 1
    if box:
        return select.kids, True
    options = [x for x in select.walk(("option",)) if not x.hidden()[0]]
    marked = [x for x in options if x.attr("selected") is not None]
    able = [x for x in options if x.attr("disabled") is None]
    return (marked[-1:] or able[:1] or options[:1]), False


def tree(page: str) -> Node:
    root = Node("")
    stack, open_ = [root], Counter()

    def close(targets, shields) -> None:
        """End the nearest of ``targets`` that no shield stands before."""
        if not any(open_[t] for t in targets):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in targets:
                for n in stack[depth:]:
                    open_[n.tag] -= 1
                del stack[depth:]
                return
            if stack[depth].tag in shields:
                return

    def start(tag: str, attrs: str) -> None:
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        drawn = tag in ("svg", "math") or open_["svg"] or open_["math"]
        if tag not in VOID and not (drawn and attrs.rstrip().endswith("/")):
            stack.append(node)
            open_[tag] += 1

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        m = TOKEN.match(page, lt) if lt >= 0 else None
        while lt >= 0 and m is None:  # a lone "<" is text
            lt = page.find("<", lt + 1)
            m = TOKEN.match(page, lt) if lt >= 0 else None
        stop = lt if m else end
        if stop > at:
            text = html.unescape(page[at:stop])
            if stack[-1].tag == "head" and text.strip():
                close(("head",), ())
            stack[-1].kids.append(text)
        if not m:
            break
        at = max(m.end(), lt + 1)
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), m[3] or ""
        if m[1]:
            if tag == "br":
                start("br", "")
            elif tag == "p" and not open_["p"]:
                start("p", "")
                close(("p",), ())
            elif tag not in VOID:
                close((tag,), ("table",) if tag not in ENDS and tag != "table" and tag not in ("html", "body") else ())
            continue
        if tag in ("html", "body", "head") and open_[tag]:
            continue
        if tag == "body" or tag in BLOCK and tag != "html" or stack[-1].tag == "head" and tag not in IN_HEAD:
            close(("head",), ())
        if tag in P_ENDERS:
            close(("p",), P_SHIELDS)
        for targets, shields in [ENDS[tag]] if tag in ENDS else []:
            close(targets, shields)
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            start("tr", "")
        start(tag, attrs)
        if tag in RAW and stack[-1].tag == tag:
            m = re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            body_end = m.start() if m else end
            if body_end > at:
                raw = page[at:body_end]
                stack[-1].kids.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = m.end() if m else end
            close((tag,), ())
    return root


class Page:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # collapsed white space waits for the next word
        self.gap = 0        # empty lines wanted before the next text

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self._put(first)
            for x in rest:
                self.end(force=True)
                self._put(x)
            return
        s = SPACE.sub(" ", s)
        if s[:1] == " ":
            self.space = True
        body = s.strip(" ")
        if body:
            self._put((" " if self.space and self.line else "") + body)
            self.space = s[-1] == " "

    def _put(self, s: str) -> None:
        if s:
            if not self.line and self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            self.line.append(s)

    def end(self, gap: int = 0, force: bool = False) -> None:
        if self.line or force:
            self.lines.append("".join(self.line))
            self.line = []
        self.space = False
        self.gap = max(self.gap, gap)

    def block(self, lines: list[str]) -> None:
        """Whole lines, such as a list item or a table."""
        self.end()
        if lines:
            if self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines += lines

    def done(self) -> list[str]:
        self.end()
        return [x.rstrip() for x in self.lines]


def _placed(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, list[str], int]]]:
    """Rows of (cell lines, columns, rows it spans) as rows of (first column,
    cell lines, columns): a cell takes the next column that no cell from a row
    above still holds."""
    held: dict[int, int] = {}
    out = []
    for row in rows:
        taken, held = held, {c: n - 1 for c, n in held.items() if n > 1}
        col, cells = 0, []
        for lines, span, down in row:
            while col in taken:
                col += 1
            cells.append((col, lines, span))
            if down > 1:
                held |= dict.fromkeys(range(col, col + span), down - 1)
            col += span
        out.append(cells)
    return out


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table. Columns are as wide as their widest cell, two spaces
    apart; of several columns under one wide cell, the last takes up the rest."""
    placed = _placed(rows)
    width: dict[int, int] = {}
    cells = [(span, col, max(map(len, lines), default=0)) for row in placed for col, lines, span in row]
    for span, col, size in sorted(cells):
        last = col + span - 1
        before = sum(width.get(c, 0) for c in range(col, last)) + 2 * (span - 1)
        width[last] = max(width.get(last, 0), size - before)
    start, at = {}, 0
    for c in range(max(width, default=-1) + 1):
        start[c] = at
        at += width.get(c, 0) + 2
    out = []
    for row in placed:
        for k in range(max([len(lines) for _, lines, _ in row], default=0)):
            line = ""
            for col, lines, _ in row:
                if k < len(lines) and lines[k]:
                    line = line.ljust(start[col]) + lines[k]
            out.append(line)
    return out


def visible_text(page: str | None) -> str | None:
    if page is None:
        return None
    pages, tables, lists, boxes = [Page()], [], [], []
    # Work left: a node or a text to write, or what to do when a node ends.
    todo: list = [tree(page)]
    pre = svg = 0
    shown = True
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if tables and tables[-1][1] is pages[-1] and not x.strip():
                continue  # white space between rows and cells
            if shown:
                pages[-1].text(x, pre > 0)
            continue
        if callable(x):
            x()
            continue
        gone, seen = x.hidden()
        if gone or svg and x.tag in SVG_UNSEEN:
            continue
        tag, then, kids = x.tag, [], x.kids
        if tag == "br":
            pages[-1].end(force=shown)
            continue
        if seen is not None and (seen == "visible") != shown:
            shown = not shown

            def turn():
                nonlocal shown
                shown = not shown

            then.append(turn)
        if tag == "svg":
            svg += 1

            def drawn():
                nonlocal svg
                svg -= 1

            then.append(drawn)
        elif tag == "select":
            kids, box = choices(x)
            if box:
                pages[-1].end()
                boxes.append(x)
                then.append(lambda: (boxes.pop(), pages[-1].end()))
        elif tag in ("option", "optgroup") and x.attr("label"):
            kids = [x.attr("label"), *(x.kids if tag == "optgroup" else [])]
        if tag == "text" and svg or tag in ("option", "optgroup") and boxes:
            pages[-1].end()
            then.append(lambda: pages[-1].end())
        if tag in BLOCK:
            gap = int(tag in SPACED and not (tag in ("ul", "ol") and lists))
            pages[-1].end(gap)
            then.append(lambda gap=gap: pages[-1].end(gap))
        if tag == "hr":
            continue
        if tag in ("pre", "textarea"):
            if tag == "textarea" and kids:
                kids = [re.sub(r"\A\r?\n", "", kids[0])]  # the line feed after the start tag
            pre += 1

            def leave():
                nonlocal pre
                pre -= 1

            then.append(leave)
        elif tag in ("ul", "ol", "menu"):
            first = x.attr("start") if tag == "ol" else None
            lists.append([tag, int(first) if first and re.fullmatch(r"-?\d{1,9}", first) else 1])
            then.append(lists.pop)
        elif tag in ("li", "dd", "blockquote"):
            mark = "  "
            if tag == "li":
                mark = "- "
                if lists and lists[-1][0] == "ol":
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
            pages.append(Page())

            def item(mark=mark):
                lines = pages.pop().done()
                pages[-1].block([(mark if not i else " " * len(mark)) + s if s or not i else s
                                 for i, s in enumerate(lines)])

            then.append(item)
        elif tag == "table":
            tables.append(([], pages[-1]))

            def lay_out():
                rows, _ = tables.pop()
                pages[-1].block(_aligned(rows))

            then.append(lay_out)
        elif tag == "tr" and tables:
            tables[-1][0].append([])
        elif tag in ("td", "th") and tables and tables[-1][0]:
            # The least and greatest spans that browsers take; 0 rows means all that follow.
            span, down = (int(v) if re.fullmatch(r"\d{1,9}", v) else 1 for v in (x.attr(a) or "1" for a in ("colspan", "rowspan")))
            span, down = min(max(span, 1), 1000), min(down, 65534) or 65534
            pages.append(Page())

            def cell(row=tables[-1][0][-1], span=span, down=down):
                row.append((pages.pop().done(), span, down))

            then.append(cell)
        # The end of the node comes after its children: the last pushed is the first done.
        todo += [*then, *reversed(kids)]
    return "\n".join(pages[0].done()).strip("\n")


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` plus ``_text``: the visible text."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [visible_text(t) for t in b.column("_doc").field(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_doc"), pa.array(got, pa.string())], names=["_doc", "_text"])

    rows = pages.select(boxed(pages))
    schema = T.StructType([rows.schema["_doc"], T.StructField("_text", T.StringType())])
    return unboxed(rows.mapInArrow(run, schema), pages, {"_text": F.col("_text")})


def query(spark, sf_dir):
    r = extract(table(spark, sf_dir, "pages"))
    return r.select("page_id", "url", F.col("_text").alias("text"))
