"""Main text of a web page by line-block distribution.

Markup is read by one scan into lines: a block element, a line break or a
heading ends a line. What stands in scripts, styles, the head, forms, menus,
headers of the page, footers, sidebars, notices, adverts and comment sections is
stripped with its markup; those are known by element, role, or a word of their
class or id. A line weighs its text without link text, whatever element holds it. The
line-block distribution is the sum of the weights of the WINDOW lines from each line on. A
surge is a weighing line whose sum exceeds SURGE, the dive is the next line that weighs
nothing in a block that fell below it. As the dive waits for a line without weight, so the
surge reaches up over the weighing lines right above it, and a heading above those: the
text between is the article, short first and last lines included. A page without any
surge (a very short one) gives its weighing lines.

Null or empty html gives an empty text. A closing tag ends the nearest open element of its
name and those inside it, a stray one nothing; a slash at the end of an opening tag means
nothing, as in HTML; a new link ends an open one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

WINDOW = 3
#: Characters in a window where a surge begins.
SURGE = 80

# Elements of HTML by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template textarea iframe svg math title select".split())
NOT_TEXT = frozenset("head nav footer aside form menu button dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of class and id names, and roles, that mark what is no article.
NOT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related reply replies share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[a-z]+")


@dataclass
class Line:
    text: str
    linked: int
    heading: bool
    inside: bool


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    if name in NOT_TEXT or (name == "header" and not inside):
        return True
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in NOT_ROLES:
        return True
    if name in ("html", "body", "article", "main"):
        return False
    marks = f"{found.get('class', '')} {found.get('id', '')}".lower()
    return any(part in NOT_WORDS for part in _PART.findall(marks))


def lines(page: str) -> list[Line]:
    """Non-blank lines of the page without what is known to be no article."""
    out: list[Line] = []
    parts: list[str] = []
    stack: list[tuple[str, bool]] = []  # (element, is unwanted)
    state = {"skip": 0, "link": 0, "inside": 0, "heading": 0, "linked": 0}

    def end_line() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        if text:
            out.append(Line(text, state["linked"], state["heading"] > 0, state["inside"] > 0))
        parts.clear()
        state["linked"] = 0

    def text(piece: str) -> None:
        if piece and not state["skip"]:
            parts.append(piece)
            if state["link"]:
                state["linked"] += len(piece)

    def count(name: str, unwanted: bool, by: int) -> None:
        state["skip"] += by * unwanted
        state["link"] += by * (name == "a")
        state["inside"] += by * (name in ("article", "main"))
        state["heading"] += by * (len(name) == 2 and name[0] == "h" and name[1].isdigit())

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                text(html.escape(m[0][9:-3]))
            continue
        if name in BLOCKS or name == "br":
            end_line()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    for closed in reversed(stack[k:]):
                        count(*closed, -1)
                    del stack[k:]
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if name in VOID:
            continue
        if name == "a" and ("a", False) in stack:
            k = len(stack) - 1 - stack[::-1].index(("a", False))
            count(*stack.pop(k), -1)
        if name in BLOCKS and stack and stack[-1][0] == "p":
            count(*stack.pop(), -1)
        if name == "li" and stack and stack[-1][0] == "li":
            count(*stack.pop(), -1)
        unwanted = _unwanted(name, m[3], state["inside"] > 0)
        stack.append((name, unwanted))
        count(name, unwanted, 1)
    end_line()
    return out


def article(page: str | None) -> str:
    """The article's lines, joined by a line feed."""
    found = lines(page or "")
    if not found:
        return ""
    weight = [max(len(x.text) - x.linked, 0) for x in found]
    sums = [sum(weight[i : i + WINDOW]) for i in range(len(found))]
    keep, i = [False] * len(found), 0
    while i < len(found):
        if not weight[i] or sums[i] <= SURGE:
            i += 1
            continue
        above = i
        while above and weight[above - 1]:
            above -= 1
        if above and found[above - 1].heading:
            above -= 1
        keep[above:i] = [True] * (i - above)
        while i < len(found) and (weight[i] or sums[i] > SURGE):
            keep[i] = True
            i += 1
    if not any(keep):
        keep = [w > 0 for w in weight]
    return "\n".join(x.text for x, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the column __article in place of the html."""
    rest = [c for c in pages.columns if c != html_col]
    frame = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(html_col).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([article(x.as_py()) for x in batch.column(len(rest))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*rest, "__article"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in frame.schema.fields[:-1])
    return frame.mapInArrow(run, f"{fields}__article string")


def query(spark, sf_dir: str) -> DataFrame:
    texts = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", F.col("__article").alias("text"), F.length("__article").cast("long").alias("n_chars"))
