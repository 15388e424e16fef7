"""Main text of HTML pages by composite text density.

For every node of the page's tree: characters ``C``, tags ``T``, and both inside
links, ``LC`` and ``LT``. Its composite density

    C / T * log(C / LC * T / LT)   to the base   ln(C / (C - LC) * LC + LC_body / C_body * C + e)

is characters per tag, adjusted for links, and its *density sum* is the sum over its
children. The node with the greatest density sum is the body of the article. Nodes
at least as dense as the least dense node on the path from ``body`` to it are content as
well; the subtree that holds them all is selected, up to the article element if the best
node lies in one. Inside an article element nothing more is dropped, elsewhere only runs of
links that hold no content.

Before that go the elements that are never article text: scripts, styles, menus,
headers and footers of the page, sidebars, forms, and what ``role``, ``hidden`` or the words of
``class`` and ``id`` name as one of these, as a notice, an advert or comments. A form or a
named element with most of the page's text, outside of which no article lies, stays: it is a wrapper.

A block is the text between two tags of block elements; character references are
decoded, white space becomes one space, blocks are joined by a newline. Nothing is cut
by length. Null and empty pages, and pages without text, give an empty text. A page
without a tag is one block. Each row is worked out alone, so equal pages and equal ids
have equal results. The result holds its own columns only, whatever else the input has.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import table

# Element names of HTML, and words that name what is not article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("html head title meta link script style base noscript template".split())
SCOPES = frozenset("table td th caption button object template html".split())
TABLE = frozenset("table tbody thead tfoot tr".split())
NEVER = frozenset(
    "script style noscript template head title svg math canvas audio video object embed iframe frameset noframes noembed applet "
    "select datalist textarea button input option optgroup dialog xmp".split())
APART = frozenset("nav aside footer form menu header search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion banner cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay sidebar widget widgets nav navbar navigation "
    "menu menus breadcrumb breadcrumbs masthead header footer comment comments disqus respond reply replies share sharing "
    "social related recommended newsletter subscribe subscription signup signin login pagination pager skip toolbar".split())
OF_READERS = frozenset("comment comments disqus respond reply replies".split())
# Starting a block ends an open paragraph; starting one of a group ends an open one, up to the element that holds the group.
CLOSES_P = BLOCK - set("body html legend caption colgroup tbody td tfoot th thead tr".split())
GROUPS = (({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"option", "optgroup"}, {"select"}),
          ({"tr"}, {"table", "tbody", "thead", "tfoot"}), ({"td", "th"}, {"tr", "table"}),
          ({"tbody", "thead", "tfoot"}, {"table"}))

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)"
                    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_ENDS = re.compile(r"(?:^|[\s\"'])/$")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Tree:
    """The nodes of a page in page order: ``name``, ``parent`` and whether they are set ``apart``. ``texts`` are
    the pieces of text with their node and the last node that had begun before them."""

    def __init__(self, page: str):
        self.name, self.parent, self.apart = ["#page"], [0], [0]
        self.texts: list[tuple[int, int, str]] = []
        stack, at = [0], 0
        while m := _TOKEN.search(page, at):
            self._text(stack, page[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self._close(stack, tag)
                continue
            self._imply(stack, tag)
            above = [self.name[k] for k in stack]
            self.name.append(tag)
            self.parent.append(stack[-1])
            self.apart.append(set_apart(tag, m[3], above))
            if tag in VOID or _ENDS.search(m[3]):
                continue
            stack.append(len(self.name) - 1)
            if tag in RAW:                       # its text is no markup: only its own end counts
                end = _RAW_END[tag].search(page, at)
                at = end.start() if end else len(page)
        self._text(stack, page[at:])

    def _text(self, stack: list[int], text: str) -> None:
        if text:
            self.texts.append((stack[-1], len(self.name) - 1, entities.unescape(text) if "&" in text else text))

    def _cut(self, stack: list[int], names: set | frozenset, until: set | frozenset = frozenset()) -> None:
        """End the innermost open element of ``names``, unless one of ``until`` comes first."""
        for k in range(len(stack) - 1, 0, -1):
            if self.name[stack[k]] in names:
                del stack[k:]
                return
            if self.name[stack[k]] in until:
                return

    def _imply(self, stack: list[int], tag: str) -> None:
        if tag not in IN_HEAD:
            self._cut(stack, {"head"})
        if tag in CLOSES_P:
            self._cut(stack, {"p"}, SCOPES)
        if tag == "a":
            self._cut(stack, {"a"}, SCOPES | BLOCK)
        if tag in HEADINGS and self.name[stack[-1]] in HEADINGS:
            stack.pop()
        for group, holder in GROUPS:
            if tag in group:
                self._cut(stack, group, holder)

    def _close(self, stack: list[int], tag: str) -> None:
        if tag in ("html", "body"):
            return                               # text after them still belongs to the page
        if tag in HEADINGS:
            self._cut(stack, HEADINGS, SCOPES)
        elif tag in TABLE:
            self._cut(stack, {tag})
        elif tag in BLOCK:
            self._cut(stack, {tag}, {"td", "th"} - {tag})
        else:
            self._cut(stack, {tag}, (SCOPES | BLOCK) - {tag})


def set_apart(tag: str, attributes: str, above: list[str]) -> int:
    """Whether the element's kind, role, state or name marks it as no article text: 0 no,
    1 yes unless it wraps the page, 2 yes."""
    article = "article" in above or "main" in above
    if tag in APART:
        return 0 if tag == "header" and article else 1 if tag == "form" else 2
    if tag == "article" and "article" in above:
        return 2                                 # an article inside an article is a comment or a teaser
    if not attributes or tag in ("html", "body", "main", "article"):
        return 0
    given = {k.lower(): a or b or c or "" for k, a, b, c in _ATTRIBUTE.findall(attributes)}
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true" or given.get("role", "").lower() in ROLES:
        return 2
    if _UNSEEN.search(given.get("style", "")):
        return 2
    words = {w.lower() for k in ("class", "id") for w in _WORD.findall(given.get(k, ""))} & NAMES
    if article or tag in HEADINGS:
        words -= {"header", "masthead"}
    return 2 if words & OF_READERS else 1 if words else 0


def _keep(tree: Tree, chars: np.ndarray) -> np.ndarray:
    """Nodes that are left when what is set apart goes. A form or named element stays if it has most
    of the page's text and every article, main element and first heading, site headers left aside."""
    n, parent = len(tree.name), tree.parent
    never, anchors = np.zeros(n, bool), np.zeros(n, np.int64)
    for k in range(1, n):
        never[k] = never[parent[k]] or tree.name[k] in NEVER or tree.apart[k] == 2
        anchors[k] = tree.name[k] in ("article", "main", "h1") and not never[k]
    size = np.where(never, 0, chars)
    for k in range(n - 1, 0, -1):
        size[parent[k]] += size[k]
        anchors[parent[k]] += anchors[k]
    keep = ~never
    for k in range(1, n):
        wraps = 2 * size[k] > size[0] and anchors[k] == anchors[0]
        keep[k] &= keep[parent[k]] and (not tree.apart[k] or bool(wraps))
    return keep


def densities(parent: list[int], keep: np.ndarray, link: np.ndarray, chars: np.ndarray, body: int) -> tuple[np.ndarray, ...]:
    """Characters, link characters, link tags, composite density and density sum of each node."""
    n = len(parent)
    c, lc = np.where(keep, chars, 0), np.where(keep & link, chars, 0)
    t, lt = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(n - 1, 0, -1):
        p = parent[k]
        if keep[k]:
            c[p] += c[k]
            lc[p] += lc[k]
            t[p] += t[k] + 1
            lt[p] += lt[k] + int(link[k])
    share = lc[body] / max(c[body], 1)
    density, total = np.zeros(n), np.zeros(n)
    for k in range(n - 1, -1, -1):
        if keep[k] and c[k]:
            tags, links, linked = max(t[k], 1), max(lt[k], 1), max(lc[k], 1)
            base = math.log(c[k] / max(c[k] - lc[k], 1) * linked + share * c[k] + math.e)
            density[k] = c[k] / tags * math.log(max(c[k] / linked * tags / links, 1)) / math.log(base)
        if k and keep[k]:
            total[parent[k]] += density[k]
    return c, lc, lt, density, total


def main_text(page: str | None) -> str:
    """The article of a page, a block a line."""
    tree = Tree(page or "")
    n, parent, name = len(tree.name), tree.parent, tree.name
    chars, link = np.zeros(n, np.int64), np.zeros(n, bool)
    for node, _, text in tree.texts:
        chars[node] += len("".join(text.split()))
    for k in range(1, n):
        link[k] = link[parent[k]] or name[k] == "a"
    keep = _keep(tree, chars)
    body = next((k for k in range(n) if name[k] == "body"), 0)
    c, lc, lt, density, total = densities(parent, keep, link, chars, body)
    last = list(range(n))                                    # the last node below each
    for k in range(n - 1, 0, -1):
        last[parent[k]] = max(last[parent[k]], last[k])

    best = int(np.argmax(np.where(keep, total, -1)))
    path = [best]
    while path[-1] not in (0, body):
        path.append(parent[path[-1]])
    least = min((density[k] for k in path if density[k] > 0), default=math.inf)
    content = keep & (density >= least)
    on_path = np.isin(np.arange(n), path)
    root = next((k for k in reversed(path) if name[k] == "article"), None)
    whole = root is not None
    if root is None:
        root = next((k for k in path if name[k] == "main"), None)
    if root is None:
        others = np.flatnonzero(content & ~on_path)
        root = next((k for k in path if ((others > k) & (others <= last[k])).all()), path[-1])
    if not whole:                                            # runs of links that hold no content
        held = np.cumsum(np.append(0, content & ~link))
        for k in range(root + 1, last[root] + 1):
            run = name[k] in BLOCK and lt[k] > 1 and 2 * lc[k] > c[k] and held[last[k] + 1] == held[k] and not on_path[k]
            keep[k] &= not run and keep[parent[k]]
    return _blocks(tree, keep, root, last[root])


def _blocks(tree: Tree, keep: np.ndarray, root: int, last: int) -> str:
    """The text of a subtree, a new line wherever a block element begins or ends."""
    name, n = tree.name, len(tree.name)
    block = [0] * n                                          # the nearest block element
    for k in range(1, n):
        block[k] = k if name[k] in BLOCK else block[tree.parent[k]]
    lines, line, now, seen = [], [], None, root
    for node, begun, text in tree.texts:
        if not (root <= node <= last and keep[node]):
            continue
        between = name[seen + 1:begun + 1]
        seen = max(seen, begun)
        if block[node] != now or not BLOCK.isdisjoint(between):
            lines.append("".join(line))
            line, now = [], block[node]
        elif "br" in between:
            line.append(" ")
        line.append(text)
    lines.append("".join(line))
    return "\n".join(x for x in (" ".join(x.split()) for x in lines) if x)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` of every page."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    return slim.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def op12_page_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


# The test pages are of one make: an article element, blocks h1 and p, a few kinds of references.
OP12_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'),
    '</?(p|h1)>', chr(10), 'g'), '<br>', ' ', 'g') AS t FROM pages),
b AS (
  SELECT page_id, url, list_transform(string_split(regexp_replace(t, '<[^>]*>', '', 'g'), chr(10)), lambda x: trim(regexp_replace(
    regexp_replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', chr(39)), '&amp;?', '&', 'g'),
    '\s+', ' ', 'g'))) AS lines FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(lines, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
"""
