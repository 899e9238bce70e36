"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into flat blocks (runs of text between block-level tags).  Each
block is described by its own and its two neighbours' word counts and link
densities, by whether it, or the block before it, is a heading, whether it is a
list item, whether the page marks an article at all, and by the zone in which it
stands: elements that hold an article, or menus, footers, side bars, notices,
adverts, forms and reader comments (by tag, role, and whole words of class and
id).  A zone that holds most of the page's words, or many of them and a page
title or an element named for the content, is a page-wide wrapper (a form around
the body, a "menu-open-wrapper") and no zone around an article; an article or
main element leaves the zones around it.  Within an article a section named
"related" is one of its own.
A decision tree, trained on a small table of labelled blocks
(``LABELLED``), keeps or drops each block; kept blocks are joined in page order.

Inside a block all white space (``<br>`` and table cells count as such) becomes
one space.  Scripts, styles, comments and other elements without running text
are not read.  Unclosed and unknown tags, stray ends and cut-off pages are
accepted: an end tag closes the nearest open element of its name, or nothing.
Only comments and the raw text of script, style and textarea run to the end of
the page if nothing ends them; another element without running text ends, if it
lacks its end tag, with its parent or before the next block, whichever is first.

Defined results: null and empty html give an empty text; a page without any
kept block gives an empty text; other columns pass through unchanged, but the
result's own columns (``text``, ``n_chars``) replace columns of the same name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common

#: Elements whose content is no running text.
_SILENT = frozenset("noscript template iframe object svg math select button title canvas audio video".split())
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    # raw text: up to the end tag or the page's end; a title only if it ends within its parent
    r"|<(script|style|textarea)(?=[\s/>])(?:=\s*+[^\s\"'>]*+|[^>\"'/=]++|/(?!\s*+>)|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)"
    r"|<title(?=[\s/>])(?:=\s*+[^\s\"'>]*+|[^>\"'/=]++|/(?!\s*+>)|\"[^\"]*+\"|'[^']*+')*+>(?:(?!</?(?:title|head|body|svg)[\s/>]).)*+</title(?=[\s/>])[^>]*+>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S | re.I,
)
_EMPTY = re.compile(r"/\s*\Z")
_UNQUOTED = re.compile(r"=\s*[^\s\"'>]*/\s*\Z")
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are kept on the stack of open elements.
_HOLDERS = frozenset("article aside blockquote center details dialog div dl fieldset figure footer form header li main menu nav ol section span table td ul".split())
_SPACES = frozenset("br td th".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

_OUT_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored banner promo promotion popup modal overlay cookie cookies consent gdpr notice notices alert "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager sidebar side aside footer foot masthead topbar toolbar header "
    "comment comments disqus respond replies share sharing social related recommended widget newsletter subscribe signup login search form copyright legal tags hidden".split()
)
#: Zones that hold no main text, however much of the page they hold, unless there is a page title or main element in them.
_FIRM_TAGS = frozenset("nav footer aside menu dialog".split())
_REPLIES = frozenset("comment comments disqus respond replies related recommended".split())
#: Words that within an article name one of its sections.
_SECTIONS = frozenset("related recommended".split())
_FIRM_WORDS = _REPLIES | frozenset("nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer foot cookie cookies consent gdpr ad ads adv advert adverts advertisement advertising".split())
#: Shares of the page's words from which a zone, or a zone with a page title, is page-wide.
_WIDE, _TITLED = 0.75, 0.4
#: First and last words of names that tell what an element has, and words of names of layout.
_HAS, _STATES = frozenset("has with no without".split()), frozenset("open closed enabled disabled".split())
_WRAPS, _SIDES = frozenset("wrap wrapper container layout columns grid row".split()), frozenset("sidebar side aside".split())
_IN_TAGS = frozenset("article main".split())
_IN_WORDS = frozenset("article content main post entry story articlebody maincontent".split())
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _zone(tag: str, attributes: str, inside: bool) -> int:
    """1: the element holds an article, below 0: it holds what is around one (-2: even if page-wide, -3: articles too), 0: neither."""
    words: set[str] = set()
    said = False  # one of the names tells of nothing but an article
    for name, *value in _ATTRIBUTE.findall(attributes):
        text = "".join(value).lower()
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and text == "true" or name == "style" and _UNSEEN.search(text):
            return -3
        if name in ("class", "id", "role"):
            for one in text.split():
                own = [w for w in _WORDS.findall(one) if not (inside and w in _SECTIONS)]
                if not own or own[0] in _HAS or len(own) > 1 and own[-1] in _STATES:
                    continue
                held = _OUT_WORDS.intersection(own)
                if held and held <= _SIDES and not _IN_WORDS.isdisjoint(own) and not _WRAPS.isdisjoint(own):
                    continue
                said = said or not held and not _IN_WORDS.isdisjoint(own)
                words.update(own)
    if tag in _IN_TAGS and not words & {"comment", "comments"}:
        return 1
    out = words & _OUT_WORDS and not (tag == "header" and inside)
    if tag in _FIRM_TAGS or out and words & _REPLIES:
        return -3
    if out and words & _FIRM_WORDS:
        return -2
    if tag in _OUT_TAGS or tag == "header" and not inside or out and not said:
        return -1
    return 1 if words & _IN_WORDS and not out else 0


def silent(tokens: list[re.Match[str]], end: int) -> dict[int, int]:
    """Where the page goes on after each element without running text, by the number of its start tag."""
    spans: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()
    stop: dict[int, int] = {}  # first block or space tag in an open silent element
    fresh: list[int] = []
    for at, m in enumerate(tokens):
        tag = (m[3] or m[6] or "").lower()
        if not tag or tag in _VOID and tag not in _SPACES:
            continue
        if tag in _BLOCKS or tag in _SPACES:
            stop.update(dict.fromkeys(fresh, m.start()))
            fresh.clear()
        if not (m[2] or m[5]):
            attributes = m[4] or m[7] or ""
            if tag in _VOID or tag in _SILENT and _EMPTY.search(attributes) and not _UNQUOTED.search(attributes):
                continue
            stack.append((tag, at))
            opened[tag] += 1
            if tag in _SILENT:
                fresh.append(at)
        elif opened[tag]:
            while True:
                name, start = stack.pop()
                opened[name] -= 1
                if name in _SILENT:
                    spans[start] = m.end() if name == tag else stop.get(start, m.start())
                    if fresh and fresh[-1] == start:
                        fresh.pop()
                if name == tag:
                    break
    for name, start in stack:
        if name in _SILENT:
            spans[start] = stop.get(start, end)
    return spans


def blocks(page: str) -> list[tuple[str, dict[str, float], bool]]:
    """(text, own features, labelled) of each flat block; labelled is for the training table only."""
    out: list[tuple[str, dict[str, float], bool]] = []
    stack: list[tuple[str, int, tuple[int, ...]]] = []
    zones: list[list[int]] = []  # kind, words before it, words up to its end, titles and main elements in it, elements named for content
    around: tuple[int, ...] = ()  # the innermost zone around an article, and whether articles in it are none
    within = links = linked = total = 0
    parts: list[str] = []
    tag_of, marked = "", False

    def close() -> None:
        nonlocal linked, total
        if parts:
            words = entities.unescape("".join(parts)).split()
            parts.clear()
            if words:
                total += len(words)
                out.append((" ".join(words), {"out": around[0] if around else -1, "in": float(within > 0), "heading": float(tag_of in _HEADINGS), "item": float(tag_of in ("li", "dt", "dd")), "words": float(len(words)), "links": min(1.0, linked / len(words))}, marked))
        linked = 0

    tokens = list(_TOKEN.finditer(page))
    spans = silent(tokens, len(page))
    at = 0
    for number, m in enumerate(tokens):
        if m.start() < at:
            continue
        if m.start() > at:
            text = page[at : m.start()]
            parts.append(text)
            if links:
                linked += len(text.split())
        at = spans.get(number, m.end())
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        end, attributes = m[2] or m[5], m[4] or m[7] or ""
        if tag == "a":
            links = 0 if end else 1
        elif tag in _SPACES:
            parts.append(" ")
        if tag in _BLOCKS:
            close()
            if tag != "hr":
                tag_of, marked = ("", False) if end else (tag, attributes.startswith(" k"))
            if tag not in ("p", "li"):
                links = 0
            if tag == "h1" and not end and around:
                zones[around[0]][3] += 1
        if tag in _HOLDERS:
            if not end:
                zone = _zone(tag, attributes, within > 0)
                stack.append((tag, zone, around))
                within += zone == 1
                if zone < 0:
                    zones.append([zone, total, -1, 0, 0])
                    around = (len(zones) - 1, zone == -3 or around[1:] == (True,))
                elif around and tag == "main":
                    zones[around[0]][3] += 1
                    around = ()
                elif around and zone == 1 and tag == "article" and not around[1]:
                    around = ()
                elif around and zone == 1:
                    zones[around[0]][4] += 1
            elif any(t == tag for t, _, _ in reversed(stack)):
                while True:
                    t, zone, outer = stack.pop()
                    within -= zone == 1
                    if zone < 0 and around:
                        zones[around[0]][2] = total
                        if outer:
                            zones[outer[0]][3] += zones[around[0]][3]
                            zones[outer[0]][4] += zones[around[0]][4]
                    around = outer
                    if t == tag:
                        break
    parts.append(page[at:])
    close()
    while stack:
        _, zone, outer = stack.pop()
        if zone < 0 and around and outer:
            zones[outer[0]][3] += zones[around[0]][3]
            zones[outer[0]][4] += zones[around[0]][4]
        around = outer
    for _, own, _ in out:
        kind, before, upto, titles, named = zones[int(own["out"])] if own["out"] >= 0 else (0, 0, total, 0, 0)
        share = ((total if upto < 0 else upto) - before) / total
        own["out"] = float(kind < 0 and not (share >= _WIDE and kind == -1 or share >= _TITLED and (titles or named and kind > -3)))
        if own["out"]:
            own["in"] = 0.0  # what is named for content there is no article
    return out


#: What the tree sees of a block: its own features, and those of its neighbours.
FEATURES = ("out", "in", "heading", "item", "words", "links", "words_before", "links_before", "words_after", "links_after", "heading_before", "bare")


def table(found: list[tuple[str, dict[str, float], bool]]) -> np.ndarray:
    rows = np.zeros((len(found), len(FEATURES)))
    for i, (_, own, _) in enumerate(found):
        rows[i, :6] = [own[f] for f in FEATURES[:6]]
    rows[1:, 6:8] = rows[:-1, 4:6]
    rows[:-1, 8:10] = rows[1:, 4:6]
    rows[1:, 10] = rows[:-1, 2]
    rows[:, 11] = not rows[:, 1].any()  # nothing says where an article is
    return rows


#: Labelled pages: {n} stands for n words, k marks a block of the main text.
LABELLED = (
    "<nav><ul><li><a>{2}</a></li><li><a>{1}</a></li><li><a>{1}</a></li></ul></nav><div class=ad>{9}</div><article><h1 k>{9}</h1><p k>{70}</p><p k>{2}</p><p k>{40}</p><p k>{1}</p></article><footer>{14}</footer>",
    "<header><a>{2}</a><p>{6}</p></header><main><h1 k>{5}</h1><p k>{1}</p></main><aside><h2>{2}</h2><p>{30}</p></aside><footer><p>{40}</p></footer>",
    "<div><a>{1}</a> <a>{1}</a> <a>{2}</a></div><div><h1 k>{7}</h1><p k>{50}</p><p k>{6}</p><p k>{35}</p><h2 k>{3}</h2><p k>{60}</p></div><div><a>{4}</a></div><div>{5} <a>{2}</a></div>",
    "<div><p>{3}</p></div><p k>{45}</p><p k>{80}</p><p k>{12}</p><p k>{30}</p><p>{2} <a>{3}</a></p><p>{4}</p>",
    "<div class=cookie-notice><p>{40}</p></div><article><p k>{20} <a>{2}</a> {20}</p><ul><li k>{8}</li><li k>{5}</li></ul><p k>{25}</p><div class=share><a>{1}</a></div></article><div class=comments><p>{30}</p><p>{22}</p></div>",
    "<form><p>{12}</p><p>{3}</p></form><p k>{33}</p><p k>{28}</p><ul><li><a>{4}</a><li><a>{5}</a><li><a>{3}</a></ul>",
    "<table><tr><td><a>{2}</a><tr><td><a>{2}</a></table><h1 k>{6}</h1><p k>{22} <a>{1}</a> {30}</p><blockquote k>{18}</blockquote><p k>{41}</p><p><a>{2}</a> <a>{1}</a></p>",
    "<div id=sidebar><p>{50}</p><p>{3}</p></div><div class=content><h2 k>{4}</h2><p k>{3}</p><p k>{25}</p><p k>{9}</p></div><div class=footer>{25}</div>",
    "<div class=nav><p>{20}</p></div><p k>{60}</p><p>{1}</p><p>{2}</p><p><a>{6}</a></p>",
    "<p>{2}</p><p><a>{3}</a> {2}</p><h1 k>{8}</h1><p k>{90}</p><ul><li k>{14}</li><li k>{11}</li><li k>{16}</li></ul><p k>{55}</p><h3>{2}</h3><ul><li><a>{6}</a></li><li><a>{7}</a></li></ul>",
    "<article><h1 k>{4}</h1><nav><a>{1}</a></nav><p k><a>{8}</a></p><p k>{3} <a>{4}</a></p><aside><p>{28}</p></aside><p k>{31}</p><form><p>{9}</p></form></article>",
    "<article><h2 k>{5}</h2><p k>{6}</p></article><p>{5}</p><p>{3} <a>{2}</a></p>",
    "<form><div class=menu><a>{2}</a> <a>{3}</a></div><div><h1 k>{2}</h1><p k>{40}</p><p k>{2}</p><p k>{60}</p><p k>{12}</p><p k>{55}</p><h2 k>{2}</h2><p k>{30}</p></div><div><a>{3}</a> <a>{2}</a></div><div class=footer>{18}</div></form>",
    "<header><h1>{3}</h1><p>{9}</p><h2>{2}</h2></header><div class=sidebar-right><h1 k>{3}</h1><p k>{35}</p><p k>{60}</p><h2 k>{2}</h2><p k>{40}</p><p k>{3}</p><p k>{70}</p><div class=sidebar><h2>{2}</h2><p>{30}</p></div></div><p>{3} <a>{2}</a></p><div class=footer>{150}</div>",
    "<form><h1 k>{2}</h1><p k>{45}</p><p k>{45}</p></form>",
    "<div class=layout-banner><h1 k>{3}</h1><p k>{30}</p></div><form><p>{3}</p></form>",
    "<article><p k>{2}</p></article>",
    "<nav><a>{2}</a></nav><article><p k>{1}</p><p k>{2}</p><p k>{1}</p></article><p>{2}</p>",
    "<main><p k>{3}</p><p k>{1}</p></main>",
    "<h1 k>{4}</h1><p k>{8}</p><p k>{6}</p>",
    "<h1 k>{2}</h1><p k>{3}</p><p k>{2}</p>",
    "<h2 k>{6}</h2><p k>{14}</p><p k>{3}</p><p k>{9}</p>",
    "<div><h2 k>{4}</h2><p k>{3}</p><p k>{40}</p></div>",
    "<div><a>{1}</a> <a>{2}</a></div><h1 k>{3}</h1><p k>{5}</p><p k>{7}</p><div><a>{2}</a></div>",
    "<p k>{30}</p><h3 k>{3}</h3><p k>{4}</p><p k>{25}</p>",
    "<div class=menu-open-wrapper><div class=content><h1 k>{3}</h1><p k>{60}</p><p k>{4}</p></div></div>",
    "<div class=footer-layout><div class=content><p k>{200}</p></div></div>",
    "<nav><a>{2}</a></nav><article><p k>{40}</p><p k>{1}</p></article><p>{9}</p><p>{1}</p>",
    "<p>{1}</p><p>{40}</p><article><h1 k>{2}</h1><p k>{90}</p><p k>{1}</p><p k>{80}</p><p k>{2}</p></article><p>{1}</p><p>{60}</p>",
    "<div>{12}</div><div class=content><p k>{1}</p><p k>{50}</p><p k>{2}</p></div><div>{3}</div><div>{33}</div>",
    "<div>{2}</div><main><h2 k>{1}</h2><p k>{48}</p><h2 k>{1}</h2><p k>{2}</p><p k>{1}</p><p k>{1}</p></main><div>{20}</div>",
    "<h2>{3}</h2><div class=post><h2 k>{2}</h2><p k>{3}</p><p k>{1}</p><p k>{7}</p></div><h2>{2}</h2><p>{25}</p>",
    "<h1 k>{6}</h1><p k>{12}</p><p k>{4}</p>",
    "<div><h1 k>{3}</h1><p k>{60}</p></div><div class=comments><div class=content><p>{70}</p></div></div>",
    "<div><h2 k>{2}</h2><p k>{100}</p><h2 k>{1}</h2><p k>{48}</p></div>",
    "<div><h1 k>{4}</h1><p k>{46}</p><h2 k>{3}</h2><p k>{75}</p></div>",
    "<h1 k>{9}</h1><p k>{15}</p><p k>{2}</p><p k>{44}</p><p k>{1}</p><p k>{51}</p>",
    "<article><p k>{50}</p><section class=related-work><h2 k>{2}</h2><p k>{60}</p></section></article>",
    "<article><h1 k>{4}</h1><p k>{24}</p></article><section class=comments><p>{90}</p><p>{70}</p><p>{45}</p></section>",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """The small labelled table: a row for each block of the labelled pages."""
    rows, labels = [], []
    for page in LABELLED:
        found = blocks(re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), page))
        rows.append(table(found))
        labels += [keep for _, _, keep in found]
    return np.concatenate(rows), np.array(labels)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 10):
    """A decision tree: (feature, threshold, tree below or at it, tree above it), or a leaf's label."""
    share = labels.mean()
    if depth == 0 or share in (0.0, 1.0):
        return bool(share >= 0.5)
    best = None
    for f in range(rows.shape[1]):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= cut
            p, q = labels[low].mean(), labels[~low].mean()
            impurity = low.sum() * p * (1 - p) + (~low).sum() * q * (1 - q)
            if best is None or impurity < best[0] - 1e-12:
                best = impurity, f, float(cut)
    if best is None or best[0] >= len(labels) * share * (1 - share) - 1e-12:
        return bool(share >= 0.5)
    _, f, cut = best
    low = rows[:, f] <= cut
    return f, cut, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def decide(tree, row: list[float]) -> bool:
    while not isinstance(tree, bool):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    return "\n\n".join(b[0] for b, row in zip(found, table(found).tolist(), strict=True) if decide(tree, row))


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """The pages (without html) with text and n_chars."""
    common.prepare(pages.sparkSession)
    tree = grow(*labelled_table())
    base = pages.drop("text", "n_chars", html_col)
    out = common.extended(base, text="string", n_chars="long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(page or "", tree) for page in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[f.name for f in out])

    return pages.drop("text", "n_chars").select(*base.columns, F.col(html_col).alias("__td_html")).mapInArrow(run, out)
