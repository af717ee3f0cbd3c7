"""Main text of web pages by the maximum-scoring contiguous region.

A page is a sequence of tags and runs of words.  Words score positive and tags
negative; the weights depend on where a word stands and on the tag's name and come
from labelled pages: pages that mark their article (one ``article`` or ``main``
element), at most ``SAMPLE`` of them (those of the smallest id hash).  One linear scan
finds the contiguous region of the largest sum.  The region is then extended, both ways,
over adjoining text of the same container that is not in such an element: what lies
beyond a notice or advert in mid-article, and ends whose tags outweigh their words, are
article text too.  Within it, elements that are never
article text (menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts, styles) are left out, character references are decoded, white space becomes
one space and blocks are joined by a line feed.

Edge cases: a null or empty page, and one without words, gives ''; unclosed, stray and
badly nested tags close what they can; a '<' that opens no tag is text; pages of any
length are scanned once, whatever stays open in them; repeated rows are alike; without labelled pages the weights
are the defaults; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.llm.common import ensure_checkpoint_dir, lean

SAMPLE = 2_000        # labelled pages that weights come from, at most
FEATURES = 400        # weights, at most
WORD, TAG = 1.0, -1.0  # weights of what labelled pages do not show
LARGEST = 3.0

# Element names of the HTML standard by what they mean here.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul head".split())
# Blocks that hold running text; all others are containers.
FLOW = frozenset("address blockquote caption center dd dl dt figure h1 h2 h3 h4 h5 h6 hgroup hr li ol p pre section table tbody td tfoot th thead "
                 "tr ul".split())
RAW = frozenset("script style noscript template svg iframe object textarea select button".split())   # no words of the page inside
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head nav header footer aside form menu dialog title figcaption fieldset".split())
# Words that name what is no article text, as a class, id, role or label.
_WORDS = (r"ad|ads|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu\w*|nav\w*|breadcrumb\w*|footer|header|masthead|cookie\w*|consent|"
          r"notice\w*|popup|modal|newsletter|subscribe|comment\w*|reply|replies|disqus|related\w*|share\w*|social\w*|widget\w*|toolbar|login|"
          r"search\w*|form|pagination|pager|complementary|contentinfo|navigation")
_HINT = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*["']?[^"'>]*?(?<![a-z])(""" + _WORDS + ")(?![a-z])", re.I)
# Within the one article the name must begin with such a word, and a header is the article's own.
_INNER_HINT = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*["']?(?:[^"'>]*\s)?(?!header|form|search)(""" + _WORDS + r""")(?![a-z])""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 p".split())     # dropped only where all around them is

_MARKS = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">"))     # how they open and end
_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_SPECIAL = re.compile("[\"'>]")
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}


class _Ends:
    """Where tags end: the next '>' that stands outside quotes.

    What is found, or not found, from one place holds for every place on the way, so
    that a page is gone through once however many tags never close.
    """

    def __init__(self, page: str):
        self.page, self.known = page, {}
        self.last = {c: page.rfind(c) for c in "\"'>"}

    def after(self, at: int) -> int:
        """The place after the '>', or -1."""
        page, known, way = self.page, self.known, []
        while True:
            if at > self.last[">"]:
                end = -1
                break
            spot = _SPECIAL.search(page, at).start()
            if (end := known.get(spot)) is not None:
                break
            way.append(spot)
            if page[spot] == ">":
                end = spot + 1
                break
            if spot >= self.last[page[spot]]:
                end = -1
                break
            at = page.find(page[spot], spot + 1) + 1
        if len(way) > 1 or end < 0:
            known.update(dict.fromkeys(way, end))
        return end


def tags(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(from, to, name, attributes) of every tag, '/' before the name of a closing one.

    Comments, declarations and marked sections have no name; an element of ``RAW`` goes
    with all that it holds.  A '<' that opens no tag is passed over.
    """
    ends, at = _Ends(page), page.find("<")
    while at >= 0:
        name, attributes = "", ""
        mark = next((c for o, c in _MARKS if page.startswith(o, at)), None)
        if mark:
            end = page.find(mark, at + len(mark) + 1)
            end = len(page) if end < 0 else end + len(mark)
        else:
            hit = _NAME.match(page, at)
            end = ends.after(hit.end()) if hit else -1
            if end < 0:
                at = page.find("<", at + 1)
                continue
            name, attributes = hit.group(1) + hit.group(2).lower(), page[hit.end():end - 1]
            if name in RAW:
                close = _CLOSE[name].search(page, end)
                end = close.end() if close else len(page)
        yield at, end, name, attributes
        at = page.find("<", end)


def events(page: str) -> Iterator[tuple]:
    """('text', raw, place, out, block, container) and ('tag', name) in page order.

    ``place`` names where a run of words stands, ``out`` tells that an enclosing
    element is never article text, ``block`` numbers the block and ``container`` the
    nearest enclosing element that is a container.
    """
    stack: list[tuple[str, bool, str, int]] = []       # name, never text, place, container
    block, out, at, containers = 0, False, 0, 0

    def text(raw):
        return ("text", raw, stack[-1][2] if stack else "none", out, block, stack[-1][3] if stack else 0)

    for start, end, name, attributes in tags(page):
        if start > at:
            yield text(page[at:start])
        at = end
        if not name or name in RAW:
            if name:
                yield "tag", name
            continue
        if name[0] == "/":
            yield "tag", name
            name = name[1:]
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
                out = bool(stack) and stack[-1][1]
        else:
            yield "tag", name
            if name not in VOID and not attributes.endswith("/"):
                if name in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):      # closes an open one of its kind
                    depth = len(stack)
                    while depth and stack[depth - 1][0] in (name, "b", "i", "em", "strong", "a", "span", "u", "font") and stack[depth - 1][0] != name:
                        depth -= 1
                    if depth and stack[depth - 1][0] == name:
                        del stack[depth - 1:]
                inside = any(s[0] in ("article", "main") for s in stack)
                hint = bool(attributes) and bool((_INNER_HINT if inside else _HINT).search(attributes) and not (inside and name in _HEADINGS)
                                                 or _HIDDEN.search(attributes))
                never = (bool(stack) and stack[-1][1]) or (name in NEVER and not (name in ("header", "figcaption") and inside)) \
                    or (hint and name not in ("html", "body", "article", "main"))
                outer = stack[-1][2] if stack else "none"
                place = name if name in BLOCKS else outer.split("+")[0]
                place += "+a" if name == "a" or outer.endswith("+a") and name not in BLOCKS else ""
                if never:
                    place = "out" if not place.endswith("+a") else "out+a"
                container = stack[-1][3] if stack else 0
                if name in BLOCKS and name not in FLOW:
                    containers += 1
                    container = containers
                stack.append((name, never, place, container))
                out = never
        if name in BLOCKS:
            block += 1
    if at < len(page):
        yield text(page[at:])


def region(page: str, weights: dict[str, float]) -> list[tuple]:
    """Events of the contiguous region of the largest sum, extended over adjoining text
    of its first and last container; [] if no sum is positive.

    Of equal sums the first, and then the longest, region is taken.  The extension
    passes over elements that are never article text and stops at text of any other
    container and at text whose words weigh less than nothing.
    """
    listed = list(events(page))
    best, best_from, best_to, total, start = 0.0, 0, 0, 0.0, 0
    for k, e in enumerate(listed):
        if e[0] == "tag":
            total += weights.get("<" + e[1], TAG)
        elif n := len(e[1].split()):
            total += n * weights.get(e[2], -WORD if e[3] else WORD)
        if total < 0:
            total, start = 0.0, k + 1
        elif total > best or total == best > 0 and start == best_from:
            best, best_from, best_to = total, start, k + 1
    told = [k for k in range(best_from, best_to) if listed[k][0] == "text" and not listed[k][3] and listed[k][1].split()]
    if told:
        best_to = max(best_to, 1 + _reach(listed, range(told[-1] + 1, len(listed)), told[-1], weights))
        best_from = min(best_from, _reach(listed, range(told[0] - 1, -1, -1), told[0], weights))
    return listed[best_from:best_to]


def _reach(listed: list[tuple], way: range, at: int, weights: dict[str, float]) -> int:
    """Last event on the way that is text of the container of event ``at``, with no other article text before it."""
    home = listed[at][5]
    for k in way:
        e = listed[k]
        if e[0] == "tag" or e[3] or not e[1].split():
            continue
        if e[5] != home or weights.get(e[2], WORD) < 0:
            break
        at = k
    return at


def extract(page: str | None, weights: dict[str, float]) -> str:
    """Main text of one page."""
    if not page:
        return ""
    blocks: dict[int, list[str]] = {}
    for e in region(page, weights):
        if e[0] == "text" and not e[3]:
            blocks.setdefault(e[4], []).append(e[1])
        elif e[0] == "tag" and e[1] in ("br", "/td", "/th") and blocks:
            blocks[next(reversed(blocks))].append(" ")
    lines = (" ".join(html.unescape("".join(parts)).split()) for _, parts in sorted(blocks.items()))
    return "\n".join([x for x in lines if x])


def label_counts(page: str) -> dict[str, list[int]] | None:
    """[outside, inside] the marked article by feature, words and tags; None if none is marked."""
    names = re.findall(r"<(article|main)\b", page, re.I)
    if len(names) != 1:
        return None
    target, inside, out = names[0].lower(), False, {}
    for e in events(page):
        if e[0] == "tag":
            if e[1] == target:
                inside = True
            out.setdefault("<" + e[1], [0, 0])[int(inside and e[1] != target)] += 1
            if e[1] == "/" + target:
                inside = False
        elif n := len(e[1].split()):
            out.setdefault(e[2], [0, 0])[int(inside)] += n
    return out


def weights_of(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Weights from counts outside and inside articles.

    A word's is its share inside against an even chance, in log odds; a tag's is
    negative, the more so the more often it stands outside.
    """
    found = {}
    for name, (outside, inside) in counts.items():
        odds = float(np.log((inside + 0.5) / (outside + 0.5)))
        if name.startswith("<"):
            found[name] = min(-0.25, TAG + max(-LARGEST, min(0.0, odds)))
        else:
            found[name] = max(-LARGEST, min(LARGEST, odds))
    return found


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` pages that mark their article."""
    import pyarrow as pa

    ensure_checkpoint_dir(pages.sparkSession)
    marked = (pages.select(F.xxhash64(f"`{id_col}`").alias("h"), F.col(f"`{html_col}`").alias("html"))
              .filter(F.col("html").rlike("(?i)<(article|main)[ >]")))
    least = marked.select("h").orderBy("h").limit(sample)
    cut = least.agg(F.max("h").alias("m")).first()["m"]
    if cut is None:
        return {}

    @lean
    def count(batches):
        for batch in batches:
            total: dict[str, list[int]] = {}
            for page in batch.column("html").to_pylist():
                for name, (a, b) in (label_counts(page) or {}).items():
                    one = total.setdefault(name, [0, 0])
                    one[0] += a
                    one[1] += b
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()),
                 pa.array([v[1] for v in total.values()], pa.int64())], names=["name", "outside", "inside"])

    rows = (marked.filter(F.col("h") <= cut).select("html").mapInArrow(count, "name string, outside long, inside long")
            .groupBy("name").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
            .orderBy(F.desc(F.col("outside") + F.col("inside")), "name").limit(FEATURES).collect())
    return weights_of({r["name"]: (r["outside"], r["inside"]) for r in rows})


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with the html column replaced by the main text in ``out``."""
    import pyarrow as pa

    ensure_checkpoint_dir(pages.sparkSession)
    fields = [f for f in pages.schema.fields if f.name not in (html_col, out)]
    names = [f.name for f in fields]

    @lean
    def run(batches):
        for batch in batches:
            texts = [extract(p, weights) for p in batch.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(texts, pa.string())], names=[*names, out])

    return pages.select(*[f"`{n}`" for n in names], F.col(f"`{html_col}`").alias("__html")) \
        .mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))
