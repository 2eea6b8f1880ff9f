"""Layout-aware text of HTML pages.

A page's tags become a tree: end tags that HTML lets authors leave out are implied (a paragraph ends
where a block begins, an item where the next begins, and so on), stray end tags are ignored, open
elements end with their parent. Elements that a browser doesn't show (head, script, style, template,
an attribute named ``hidden``, the style declaration ``display:none``) are left out with all they hold, as are titles, descriptions
and definitions in ``svg`` and annotations in ``math``, whose other text is inline text; of
``visibility:hidden`` all but the descendants that are ``visible`` again. Style sheets and classes aren't
followed. Of the rest all text is emitted: blocks on lines of their own, a blank line around paragraphs and headings, list items
with marks and indents, preformatted text as it is, table cells in aligned columns (``MAX_CELL``: wider
lines don't widen their column), each with its lines below one another and clear of cells that span rows.

Each page is handled on its own, in time and memory in proportion to its length.

Defined cases: null, empty and tagless texts give their text with white space collapsed (null: empty).
Broken markup never fails: what isn't a tag is text. Rows are rendered one by one; other columns pass
through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from waybill.llm.words import row_chunks

MAX_CELL = 40
MAX_COLUMNS = 64  # cells beyond reach into no row below, so a page takes linear time
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template title noscript iframe noembed noframes audio video canvas object datalist".split())
# never drawn where they stand, besides those
HIDDEN_WITHIN = {"svg": frozenset("desc defs metadata symbol clippath mask marker pattern".split()),
                 "math": frozenset("annotation annotation-xml mphantom".split())}
LINES = frozenset("address article aside body center dd details dialog div dl dt fieldset figcaption figure footer form header "
                  "hgroup html legend li main menu nav ol optgroup option search section select summary table tbody td tfoot "
                  "th thead tr ul".split())
SPACED = frozenset("blockquote h1 h2 h3 h4 h5 h6 hr p pre table ul ol dl figure".split())
ENDS_PARAGRAPH = (LINES | SPACED) - frozenset("body html td th tr tbody thead tfoot dd dt li option optgroup legend".split()) | {"li", "dd", "dt"}
# a start tag of the key implies the end of an open element of these, up to the nearest boundary
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    **{t: ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
    "body": ({"head"}, set()),
}
_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
_PLAIN_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_MAY_HIDE = re.compile("hidden|style", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARATION = re.compile(r"""(?:[^;"'()]++|"[^"]*+"|'[^']*+'|\([^()]*+\)|["'()])++""")  # a semicolon in quotes or brackets ends none
_START = re.compile(r"""start\s*=\s*["']?(\d{1,9})""", re.I)
_SPAN = re.compile(r"""colspan\s*=\s*["']?(\d{1,3})""", re.I)
_DOWN = re.compile(r"""rowspan\s*=\s*["']?(\d{1,5})""", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "marks", "children")

    def __init__(self, tag: str, marks: str = ""):
        self.tag, self.marks, self.children = tag, marks, []


def tree(html: str) -> Node:
    """The tree of a page; a child is a text or a node."""
    root = Node("html")
    stack, at, tag_pattern, size = [root], 0, _TAG, len(html)
    open_count: dict[str, int] = {}

    def close(depth: int) -> None:
        while len(stack) > depth:
            open_count[stack.pop().tag] -= 1

    def nearest(tags, stops) -> int | None:
        """Depth of the outermost open element of ``tags`` above the nearest of ``stops``."""
        if not any(open_count.get(t) for t in tags):
            return None
        found = None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in stops:
                break
            if stack[depth].tag in tags:
                found = depth
        return found

    last = html.rfind(">")
    while at < size:
        begin = html.find("<", at)
        if begin < 0 or begin > last and not html.startswith("<!--", begin):
            stack[-1].children.append(unescape(html[at:]))
            break
        match = tag_pattern.match(html, begin)
        if match is None and tag_pattern is _TAG and (match := _PLAIN_TAG.match(html, begin)):
            tag_pattern = _PLAIN_TAG  # a quote that nothing closes: from here on quotes mean nothing
        if match is None:
            stack[-1].children.append(unescape(html[at : begin + 1]))
            at = begin + 1
            continue
        if begin > at:
            stack[-1].children.append(unescape(html[at:begin]))
        at = match.end()
        if not match[2]:
            continue
        name, marks = match[2].lower(), match[3]
        if match[1]:
            if name == "p" and not open_count.get("p"):
                stack[-1].children.append(Node("p"))
            elif name == "br":
                stack[-1].children.append(Node("br"))
            elif open_count.get(name):
                limits = {"table"} if name not in ("table", "body", "html") and open_count.get("table") else set()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == name:
                        close(depth)
                        break
                    if stack[depth].tag in limits:
                        break
            continue
        if name == "html":
            continue
        if name in ENDS_PARAGRAPH and open_count.get("p"):
            depth = nearest({"p"}, {"table", "td", "th", "button"})
            if depth is not None:
                close(depth)
        if name in IMPLIED:
            depth = nearest(*IMPLIED[name])
            if depth is not None:
                close(depth)
        node = Node(name, marks)
        stack[-1].children.append(node)
        if name in VOID or marks.endswith("/") and (
                name in ("svg", "math") or (open_count.get("svg") or open_count.get("math")) and not open_count.get("foreignobject")):
            continue
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(html, at)
            raw = html[at : end.start() if end else size]
            node.children.append(unescape(raw) if name == "textarea" else raw)
            at = end.end() if end else size
            continue
        stack.append(node)
        open_count[name] = open_count.get(name, 0) + 1
    return root


class _Out:
    """Lines with the spacing that blocks ask for."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.wanted = 0  # blank lines before the next text
        self.lead = ""  # a list mark that the next line begins with
        self.indent = 0

    def text(self, text: str) -> None:
        self.words.append(text)

    def line(self, keep_empty: bool = False) -> None:
        words = _SPACE.sub(" ", "".join(self.words)).strip(" ")
        self.words.clear()
        if words or keep_empty:
            self.put(words)

    def put(self, words: str) -> None:
        if self.wanted and self.lines:
            self.lines.append("")
        self.wanted = 0
        self.lines.append(("  " * self.indent)[: -len(self.lead) or None] + self.lead + words if self.lead else "  " * self.indent + words)
        self.lead = ""


def _attributes(marks: str) -> dict[str, str]:
    """Names in lower case and values of a tag's attributes; of repeated names the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(marks):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


def _declared(style: str) -> dict[str, str]:
    """Properties and values of a style attribute; of repeated ones the last important one counts, else the last."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in _DECLARATION.findall(_COMMENT.sub(" ", style)):
        name, _, value = declaration.partition(":")
        name, (value, mark, rank) = name.strip().lower(), value.lower().partition("!")
        important = bool(mark) and rank.strip() == "important"
        if value.strip() and (important or not found.get(name, (False,))[0]):
            found[name] = important, value.strip()
    return {name: value for name, (_, value) in found.items()}


def _shown(node: Node, visible: bool) -> bool | None:
    """Whether a node's own text is visible, given its parent's; None if it is left out with all it holds."""
    if node.tag in HIDDEN:
        return None
    if not node.marks or not _MAY_HIDE.search(node.marks):
        return visible
    attributes = _attributes(node.marks)
    style = _declared(attributes.get("style", ""))
    if "hidden" in attributes or style.get("display") == "none":
        return None
    return {"hidden": False, "collapse": False, "visible": True, "initial": True}.get(style.get("visibility"), visible)


def _placed(rows: list[list[tuple]]) -> list[list[tuple[int, list[str], int]]]:
    """Rows of (column, lines, columns spanned): cells move right of those that reach down from rows above."""
    taken: dict[int, int] = {}  # column: first row below in which it is free
    out = []
    for r, row in enumerate(rows):
        column, cells = 0, []
        for lines, span, down in row:
            while taken.get(column, 0) > r:
                column += 1
            cells.append((column, lines, span))
            if down != 1:
                for c in range(column, min(column + span, MAX_COLUMNS)):
                    taken[c] = r + down if down else len(rows)
            column += span
        out.append(cells)
    return out


def _aligned(rows: list[list[tuple]]) -> list[str]:
    """Lines of a table's rows; a cell is (lines, columns spanned, rows spanned or 0 for all that follow)."""
    placed, widths = _placed(rows), []
    for row in placed:
        for column, lines, span in row:
            widths += [0] * (column + 1 - len(widths))
            if span == 1:
                widths[column] = max(widths[column], max((len(t) for t in lines if len(t) <= MAX_CELL), default=0))
    out = []
    for row in placed:
        for k in range(max([1, *(len(lines) for _, lines, _ in row)])):
            line, at, end = [], 0, 0
            for column, lines, span in row:
                line += [" " * (widths[c] if c < len(widths) else 0) for c in range(at, column)]
                text = lines[k] if k < len(lines) else ""
                line.append(text.ljust(sum(widths[column : column + span]) + 3 * (span - 1)))
                at = column + span
                end = len(line) if text or not k else end
            out.append(" | ".join(line[:end]).rstrip())
    return out


def render(html: str | None) -> str:
    """All visible text of a page, laid out in lines."""
    if not html:
        return ""
    outs, tables, numbers, verbatim = [_Out()], [], [], 0
    inside = {"svg": 0, "math": 0}
    work: list = [(tree(html), False, True)]
    while work:
        node, leaving, visible = work.pop()
        out = outs[-1]
        if isinstance(node, str):
            if not visible:
                continue
            if verbatim:
                first, *rest = node.split("\n")
                out.text(first.replace(" ", " ").replace("\t", " " * 4))
                for line in rest:
                    out.line(keep_empty=True)
                    out.text(line.replace(" ", " ").replace("\t", " " * 4))
            else:
                out.text(node)
            continue
        tag = node.tag
        if not leaving:
            visible = _shown(node, visible)
            if visible is None or any(depth and tag in HIDDEN_WITHIN[kind] for kind, depth in inside.items()):
                continue
            if tag in inside:
                inside[tag] += 1
            elif tag == "text" and inside["svg"]:
                out.text(" ")  # labels stand apart
            if tag == "br":
                out.line(keep_empty=bool(out.words))
                continue
            if tag in LINES or tag in SPACED:
                if tag not in ("td", "th"):
                    out.line()
                if tag in SPACED and out.indent == 0:
                    out.wanted = 1
            if tag in ("ul", "ol", "menu"):
                start = _START.search(node.marks)
                numbers.append(int(start[1]) if start and tag == "ol" else 1 if tag == "ol" else None)
                out.indent += 1
            elif tag == "li":
                number = numbers[-1] if numbers else None
                out.lead = "- " if number is None else f"{number}. "
                if number is not None:
                    numbers[-1] = number + 1
            elif tag in ("dd", "blockquote"):
                out.indent += 1
            elif tag == "pre":
                verbatim += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th", "caption") and tables:
                outs.append(_Out())
            work.append((node, True, visible))
            work.extend((c, False, visible) for c in reversed(node.children))
            continue
        if tag in ("td", "th", "caption") and tables:
            out.line()
            outs.pop()
            if tag == "caption":
                outs[-1].put(" ".join(filter(None, (x.strip() for x in out.lines))))
            else:
                span, down = _SPAN.search(node.marks), _DOWN.search(node.marks)
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((out.lines, max(1, int(span[1])) if span else 1, int(down[1]) if down else 1))
            continue
        if tag in inside:
            inside[tag] -= 1
        elif tag == "text" and inside["svg"]:
            out.text(" ")
        if tag in LINES or tag in SPACED:
            out.line()
        if tag == "table":
            for line in _aligned([r for r in tables.pop() if r]):
                out.put(line)
        elif tag == "tr" and not visible and tables and tables[-1] and not any(lines for lines, _, _ in tables[-1][-1]):
            tables[-1].pop()
        elif tag == "pre":
            verbatim -= 1
        elif tag in ("ul", "ol", "menu"):
            numbers.pop()
            out.indent -= 1
        elif tag in ("dd", "blockquote"):
            out.indent -= 1
        elif tag == "li":
            out.lead = ""
        if tag in SPACED and out.indent == 0:
            out.wanted = 1
    outs[0].line()
    return "\n".join(outs[0].lines).replace(" ", " ").strip("\n")


def rendered(pages: DataFrame, html: str = "html", text: str = "text", blocks: str = "n_blocks") -> DataFrame:
    """``pages`` with the visible text of the whole page and its number of blocks (runs of lines
    between blank ones). Columns named like these two are replaced."""
    pages = pages.select(*(c for c in pages.columns if c not in (text, blocks) or c == html))
    schema = StructType(pages.schema.fields + [StructField(text, StringType()), StructField(blocks, LongType())])
    place = pages.columns.index(html)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_chunks(whole, html):
                texts = [render(h) for h in batch.column(place).to_pylist()]
                counts = [len(re.findall(r"[^\n](?:\n\n|\Z)", t)) for t in texts]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                                                 [*batch.schema.names, text, blocks])

    return pages.mapInArrow(run, schema)
