"""Layout-aware text of web pages.

A tree builder with implied tags (a ``p`` closed by a block, ``li``, ``tr``,
``td`` and the like closed by the next) and visibility rules, then a layout
pass: white space collapses, blocks stand apart, lists get markers, table
cells are padded into columns.  Both passes are loops with own stacks, so
nesting depth is bounded by memory only.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
UNSEEN = frozenset("""head script style title template noscript iframe noembed noframes object audio video canvas
    svg math datalist select option param source track link meta base area map""".split())
SPACED = frozenset("""p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset menu""".split())
BLOCK = SPACED | frozenset("""address article aside body center details dialog dd div dt figcaption footer form header
    hgroup html legend li main nav section summary caption optgroup search""".split())
CLOSES_P = (BLOCK - frozenset("html body dd dt li caption legend".split())) | frozenset(["li", "dd", "dt"])
ROWS = frozenset(["tbody", "thead", "tfoot"])
#: A start tag closes the nearest of the first set, up to the second.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (ROWS | {"caption", "colgroup"}, frozenset(["table"])),
    "thead": (ROWS | {"caption", "colgroup"}, frozenset(["table"])),
    "tfoot": (ROWS | {"caption", "colgroup"}, frozenset(["table"])),
}
SCOPE = frozenset(["table", "td", "th", "caption", "button", "html", "body"])

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)(?!\s*=\s*[\"']?until-found)", re.I)
STYLE = re.compile(r"\sstyle\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
STYLE_OFF = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
START = re.compile(r"\sstart\s*=\s*[\"']?(-?\d+)", re.I)
DIALOG_OPEN = re.compile(r"\sopen(?=[\s=/]|$)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []


def hidden(node: Node) -> bool:
    tag, attrs = node.tag, node.attrs
    if tag in UNSEEN or tag == "dialog" and not DIALOG_OPEN.search(attrs):
        return True
    if not attrs:
        return False
    if HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "\"\"", attrs)) and "hidden" in attrs.lower():
        return True
    m = STYLE.search(attrs)
    return bool(m and STYLE_OFF.search(html.unescape(m[1])))


def parse(source: str) -> Node:
    """The tree of a page; never fails: what is no markup is text."""
    root = Node("html")
    stack, at, end = [root], 0, len(source)
    where: dict[str, list[int]] = {}  # places of the open elements of each tag in the stack

    def push(node: Node) -> None:
        where.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def pop() -> None:
        where[stack.pop().tag].pop()

    def innermost(tags: frozenset) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def close(tags: frozenset, upto: frozenset) -> None:
        i = innermost(tags)
        if i and i >= innermost(upto):
            while len(stack) > i:
                pop()

    while at < end:
        m = TOKEN.search(source, at)
        text = source[at:m.start()] if m else source[at:]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        shut, tag = m[1], m[2]
        if shut:
            shut = shut.lower()
            if shut == "br":
                stack[-1].children.append(Node("br"))
            elif shut == "p" and not where.get("p"):
                stack[-1].children.append(Node("p"))
            elif shut not in ("html", "body"):
                stop = frozenset() if shut in SCOPE or shut in ROWS or shut == "tr" else frozenset(["table", "td", "th"])
                close(frozenset([shut]), stop)
            continue
        if not tag:
            continue
        tag, attrs = tag.lower(), m[3] or ""
        if tag in ("html", "body"):
            stack[0].attrs += " " + attrs if tag == "body" else ""
            continue
        if tag in CLOSES_P:
            close(frozenset(["p"]), SCOPE)
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        elif len(tag) == 2 and tag[0] == "h" and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6") and tag[1] in "123456":
            pop()
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            done = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at) if tag != "plaintext" else None
            raw = source[at:done.start()] if done else source[at:]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = done.end() if done else end
            continue
        if tag == "head":
            # metadata only: the next other element is the body's
            pass
        elif stack[-1].tag == "head" and tag not in UNSEEN:
            stack[-1].children.pop()
            pop()
            stack[-1].children.append(node)
        push(node)
    return root


def width(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


#: Columns of tables are padded up to this width.
WIDEST = 120


class Layout:
    """Lines of one block container (the page or a table cell)."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = False
        self.indent = 0
        self.marker = ""
        self.keep = 0

    def text(self, s: str) -> None:
        if self.keep:
            first, *rest = s.replace("\r\n", "\n").split("\n")
            self._put(first)
            for x in rest:
                self.end_line(True)
                self._put(x)
            return
        words = SPACES.sub(" ", s)
        if words[:1] == " ":
            self.space = bool(self.line) or self.space
            words = words[1:]
        if not words:
            return
        if self.space and self.line:
            self.line.append(" ")
        self.space = words[-1] == " "
        self._put(words[:-1] if self.space else words)

    def _put(self, s: str) -> None:
        if not s:
            return
        if not self.line:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.line.append(" " * (self.indent - len(self.marker)) + self.marker)
            self.marker = ""
        self.line.append(s)

    def end_line(self, even_empty: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
        elif even_empty:
            self.lines.append("")
        self.line, self.space = [], False

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced

    def rows(self, lines: list[str]) -> None:
        self.block(True)
        for x in lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append((" " * (self.indent - len(self.marker)) + self.marker + x).rstrip())
            self.marker = ""
        self.gap = True

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def aligned(table: list[list[list[str]]]) -> list[str]:
    """Rows of cells (each a list of lines) with the columns padded to one
    width.  A column is padded to ``WIDEST`` at most, so padding adds no more
    than that to a cell; longer lines stand as they are."""
    sizes: list[int] = []
    for row in table:
        for k, cell in enumerate(row):
            w = min(WIDEST, max(map(width, cell), default=0))
            if k == len(sizes):
                sizes.append(w)
            elif w > sizes[k]:
                sizes[k] = w
    out = []
    for row in table:
        for i in range(max((len(c) for c in row), default=0)):
            parts = [c[i] if i < len(c) else "" for c in row]
            out.append(" | ".join(p + " " * (sizes[k] - width(p)) for k, p in enumerate(parts)).rstrip())
    return out


def render(root: Node) -> str:
    """Visible text of a tree."""
    out = Layout()
    lists: list[list[int]] = []
    layouts, tables = [out], []
    todo: list[tuple] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        lay = layouts[-1]
        if isinstance(node, str):
            lay.text(node)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th") and len(layouts) > 1:
                cell = layouts.pop().done()
                if tables[-1]:
                    tables[-1][-1].append(cell)
                else:
                    tables[-1].append([cell])
            elif tag == "table":
                rows = [r for r in tables.pop() if any(any(c) for c in r)]
                lay.rows(aligned(rows))
            else:
                if tag in ("ul", "ol", "menu"):
                    lists.pop()
                    lay.indent -= 2
                elif tag in ("dd", "blockquote"):
                    lay.indent -= 2
                elif tag in ("pre", "textarea"):
                    lay.keep -= 1
                if tag == "li":
                    lay.marker = ""
                lay.block(tag in SPACED)
            continue
        if hidden(node):
            continue
        if tag == "br":
            lay.end_line(True)
            continue
        if tag == "wbr" or tag in VOID:
            if tag == "hr":
                lay.block(True)
            continue
        if tag == "table":
            lay.block(True)
            tables.append([])
            todo.append((node, True))
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in ("td", "th") and tables:
            layouts.append(Layout())
            todo.append((node, True))
        elif tag in BLOCK or tag == "textarea":
            lay.block(tag in SPACED and not (tag in ("ul", "ol", "menu") and lists))
            if tag in ("ul", "ol", "menu"):
                m = START.search(node.attrs)
                lists.append([int(m[1]) if m else 1] if tag == "ol" else [])
                lay.indent += 2
            elif tag in ("dd", "blockquote"):
                lay.indent += 2
            elif tag in ("pre", "textarea"):
                lay.keep += 1
            elif tag == "li":
                lay.marker = "- "
                if lists and lists[-1]:
                    lay.marker = f"{lists[-1][0]}. "
                    lists[-1][0] += 1
            todo.append((node, True))
        todo.extend((c, False) for c in reversed(node.children))
    return "\n".join(out.done())


def page_text(source: str | None) -> str:
    return render(parse(source)) if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_chars, n_lines) of each page, one row per input row.

    A null or empty page gives an empty text; broken markup is read as far as
    it goes, the rest is text; null ids stay null; repeated rows give a row
    each; an empty table gives an empty result.  Other columns are not read.
    """
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [page_text(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())],
                ["page_id", "text", "n_chars", "n_lines"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, "page_id long, text string, n_chars long, n_lines long"))
