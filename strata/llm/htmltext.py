"""Main text of web pages by a maximum-scoring subsequence (operator 12).

A page is a sequence of tags and words. Words score positive and tags
negative; the best contiguous run of that sequence, found in one linear scan,
is the content region. What the weights are is learned from labelled pages:
those whose author marked the content with a single ``article`` (or ``main``,
or an element named as the content). There, tags and words are counted inside
and outside of the marked element by what they are and where they stand
(``where``: within a marked element, outside of it, or ``free`` of any), and
the share inside, smoothed by ``PRIOR_ROWS`` imagined cases, gives the weight.
Pages without a mark are scored with the weights of the ``free`` place.

Elements that are never article text (scripts, forms, menus, adverts, reader
comments and so on, by tag, role or name) score nothing and give no text,
inside a region as well. Character references are decoded, white space within
a block becomes one space, blocks are joined by an empty line.

Defined results: a null page is an empty one; a page without words in a
region gives an empty text; equally good regions: the first one; repeated rows
and null ids are pages of their own; markup that never ends is text if it has
no ``>``, and a comment, script or style without an end reaches to the page's
end. Nothing is cut: pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import id_type, map_texts

#: Imagined labelled cases that each weight starts from.
PRIOR_ROWS = 10.0
#: A word whose place is article text less often than this scores nothing.
LEAST_SHARE = 0.1
#: A tag costs at least and at most this.
TAG_COST = (0.01, 8.0)

_MARKUP = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*>"
    r"|(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*))?|=)*+)>|/[^a-zA-Z][^>]*>)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))|(?=[\s/]|$))", re.I)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NOT_LETTER = re.compile(r"[^a-z]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table "
    "tbody tfoot thead title tr ul".split()
)
SPACE = frozenset("br td th option".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select", "datalist")}

# What is never article text: by element, and by the words of class, id and role.
HIDDEN = frozenset(
    "head script style title noscript template textarea xmp iframe noembed noframes nav footer aside form button select "
    "option datalist input label svg canvas object menu dialog audio video map".split()
)
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion comment comments "
    "commentlist disqus respond reply replies cookie cookies consent gdpr notice notices alert popup modal overlay dialog "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "pagination pager breadcrumb breadcrumbs search form skip hidden".split()
)
#: Words of the page's layout: a marked article within such an element counts.
LAYOUT = frozenset(
    "nav navbar navigation menu sidebar aside header masthead footer topbar toolbar widget widgets complementary contentinfo".split()
)
CONTENT_NAMES = frozenset(
    "content main article maincontent articlebody articlecontent articletext postcontent postbody entrycontent entrybody "
    "post entry story storybody pagecontent bodycontent".split()
)
TEXT_TAGS = frozenset(
    "a abbr b blockquote br cite code dd dl dt em figcaption figure h1 h2 h3 h4 h5 h6 hr i img li mark ol p pre q s small "
    "span strong sub sup table tbody td tfoot th thead time tr u ul wbr".split()
)
OUTER_TAGS = frozenset("article body html main".split())
KNOWN_TAGS = TEXT_TAGS | OUTER_TAGS | BLOCK | HIDDEN | VOID


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _name_words(values: str) -> set[str]:
    return {w.lower() for w in _NAME_WORD.findall(values)}


@dataclass
class Page:
    """A page's sequence: for item i its kind, its place and its text.

    ``tags[i]`` is the element of a tag, or of the block around a text;
    ``texts[i]`` is None for a tag and the text's source for words."""

    tags: list[str] = field(default_factory=list)
    texts: list[str | None] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    linked: list[bool] = field(default_factory=list)
    article: list[int] = field(default_factory=list)  # number of the article around it, 0: none
    content: list[int] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    n_articles: int = 0
    n_content: int = 0

    def marked(self) -> list[int] | None:
        """Which items stand in the marked element: the only article, else the
        only content element, else any article. None without a mark."""
        if self.n_articles == 1:
            return self.article
        if self.n_content == 1:
            return self.content
        if self.n_articles:
            return self.article
        return self.content if self.n_content else None


def read_page(source: str) -> Page:
    """Tags and texts of a page, with unclosed elements ended as browsers do."""
    page = Page()
    # Of an open element: name, whether its text counts as none, whether that
    # is only due to a layout name, its article, its content element, a link.
    stack: list[tuple[str, bool, bool, int, int, bool]] = [("", False, False, 0, 0, False)]
    open_names: Counter[str] = Counter()
    blocks: list[str] = [""]

    def add(name: str, text: str | None) -> None:
        _, hidden, _, article, content, linked = stack[-1]
        page.tags.append(name)
        page.texts.append(None if text is None or hidden else text)
        page.words.append(0 if text is None or hidden else len(text.split()))
        page.linked.append(linked)
        page.article.append(article)
        page.content.append(content)
        page.hidden.append(hidden)

    def close(name: str) -> None:
        while True:
            top = stack.pop()[0]
            open_names[top] -= 1
            if top in BLOCK:
                blocks.pop()
            if top == name:
                return

    def close_implied(names: tuple[str, ...], within: tuple[str, ...]) -> None:
        if not any(open_names[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                close(stack[i][0])
                return
            if stack[i][0] in within:
                return

    at, stop = 0, source.rfind(">") + 1
    if "<!--" in source[stop:]:
        stop = len(source)
    while True:
        m = _MARKUP.search(source, at, stop) if at < stop else None
        text = source[at : m.start() if m else len(source)]
        if text and not text.isspace():
            add(blocks[-1], text)
        elif text:
            add("", " ")
        if m is None:
            return page
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if open_names[name]:
                add(name, None)
                close(name)
            elif name in BLOCK:
                add(name, None)
            continue
        if name in BLOCK and open_names["p"]:
            close_implied(("p",), ("button", "table", "td", "th", "object", "caption"))
        if name in CLOSES:
            close_implied(CLOSES[name], SCOPES[name])
        _, hidden, by_layout, article, content, linked = stack[-1]
        attributes = _attributes(m[3]) if "=" in m[3] or "hidden" in m[3].lower() else {}
        names = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
        words = _name_words(names) if names.strip() else set()
        marks = name not in ("html", "body")
        never = (
            name in HIDDEN
            or (name == "header" and not article and not content)
            or "hidden" in attributes
            or attributes.get("aria-hidden", "").lower() == "true"
            or bool(_INVISIBLE.search(attributes.get("style", "")))
            or bool(marks and words & NOT_TEXT)
        )
        layout = bool(marks and words & LAYOUT) and not (words & {"header"} and (article or content))
        if name in ("article", "main") and hidden and by_layout and not never:
            hidden = by_layout = False
        if never:
            hidden, by_layout = True, False
        elif layout and not hidden:
            hidden = by_layout = True
        if not hidden and not article and name == "article":
            page.n_articles += 1
            article = page.n_articles
        named = {_NOT_LETTER.sub("", v.lower()) for k in ("id", "class", "role", "itemprop") for v in attributes.get(k, "").split()}
        if not hidden and not content and marks and (name == "main" or named & CONTENT_NAMES):
            page.n_content += 1
            content = page.n_content
        if name in VOID:
            add(name, None)
            continue
        stack.append((name, hidden, by_layout, article, content, linked or name == "a"))
        open_names[name] += 1
        if name in BLOCK:
            blocks.append(name)
        add(name, None)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = end.start() if end else len(source)


def _where(marked: list[int] | None, i: int) -> str:
    return "free" if marked is None else "in" if marked[i] else "out"


def _keys(page: Page, i: int, where: str) -> str:
    tag = page.tags[i] if page.tags[i] in KNOWN_TAGS else "other"
    return f"{where} {'tag' if page.texts[i] is None else 'link' if page.linked[i] else 'word'} {tag}"


def _prior(where: str, kind: str, tag: str) -> float:
    if where == "in":
        return 0.99
    if kind == "tag":
        return 0.9 if tag in TEXT_TAGS else 0.05 if tag in OUTER_TAGS else 0.6
    if where == "out":
        return 0.02
    return (0.2 if kind == "link" else 1.0) * (0.9 if tag in TEXT_TAGS else 0.5)


class Weights:
    """Scores by key, from the counts of labelled pages inside and outside."""

    def __init__(self, counts: dict[str, tuple[float, float]] | None = None):
        self.counts = counts or {}
        self.known: dict[str, float] = {}

    def __getitem__(self, key: str) -> float:
        if key not in self.known:
            where, kind, tag = key.split(" ")
            inside, outside = self.counts.get(key, (0.0, 0.0))
            share = (inside + PRIOR_ROWS * _prior(where, kind, tag)) / (inside + outside + PRIOR_ROWS)
            if kind == "tag":
                low, high = TAG_COST
                self.known[key] = -min(high, max(low, -log(share)))
            else:
                self.known[key] = share if share >= LEAST_SHARE else 0.0
        return self.known[key]

    def __reduce__(self):
        return Weights, (self.counts,)


def scores(page: Page, weights: Weights) -> list[float]:
    """What each tag and each text (all of its words) scores."""
    marked = page.marked()
    out = []
    for i, hidden in enumerate(page.hidden):
        if page.texts[i] is None:
            out.append(0.0 if hidden else weights[_keys(page, i, _where(marked, i))])
        else:
            out.append(page.words[i] * weights[_keys(page, i, _where(marked, i))] if page.words[i] else 0.0)
    return out


def best_run(values: list[float]) -> tuple[int, int]:
    """First and past-the-last index of the best contiguous run; the earliest
    of the best, (0, 0) if none is above zero."""
    best, run, first, span = 0.0, 0.0, 0, (0, 0)
    for i, v in enumerate(values):
        if run <= 0.0:
            run, first = 0.0, i
        run += v
        if run > best:
            best, span = run, (first, i + 1)
    return span


def block_text(page: Page, first: int, last: int) -> str:
    """Visible text of a run: blocks in page order, joined by an empty line."""
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        block = " ".join(html.unescape("".join(parts)).split())
        if block:
            blocks.append(block)
        parts.clear()

    for i in range(first, last):
        text = page.texts[i]
        if text is not None:
            parts.append(text)
        elif page.tags[i] in BLOCK:
            flush()
        elif page.tags[i] in SPACE:
            parts.append(" ")
    flush()
    return "\n\n".join(blocks)


def main_text(source: str, weights: Weights) -> str:
    page = read_page(source)
    return block_text(page, *best_run(scores(page, weights)))


def count_labelled(page: Page) -> dict[str, list[float]]:
    """Counts inside and outside of the mark by key; nothing for a page that
    is not labelled. Every item also counts for the ``free`` place."""
    if page.n_articles != 1 and page.n_content != 1:
        return {}
    marked = page.marked()
    counts: dict[str, list[float]] = {}
    for i, hidden in enumerate(page.hidden):
        if hidden or (page.texts[i] is not None and not page.words[i]):
            continue
        amount = 1 if page.texts[i] is None else page.words[i]
        # A marked element's own tags are not part of what it holds.
        inside = bool(marked[i]) and not (page.texts[i] is None and page.tags[i] in OUTER_TAGS)
        for where in (_where(marked, i) if inside else "out", "free"):
            counts.setdefault(_keys(page, i, where), [0.0, 0.0])[0 if inside else 1] += amount
    return counts


def fit(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from all labelled pages. Keys are places times kinds times known
    elements, so a few hundred counts at most reach the driver."""

    def count(rows: pa.RecordBatch, texts: list[str]) -> dict | None:
        total: dict[str, list[float]] = {}
        for text in texts:
            for key, (inside, outside) in count_labelled(read_page(text)).items():
                sums = total.setdefault(key, [0.0, 0.0])
                sums[0] += inside
                sums[1] += outside
        if not total:
            return None
        return {"key": list(total), "inside": [v[0] for v in total.values()], "outside": [v[1] for v in total.values()]}

    some = pages.select(F.col(html_col).alias("html")).filter(F.lower("html").rlike("<article|<main|id=|class=|role=|itemprop="))
    parts = map_texts(some, count, "key string, inside double, outside double", text_col="html")
    found = parts.groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return Weights({r["key"]: (r["inside"], r["outside"]) for r in found})


def extract(
    pages: DataFrame,
    weights: Weights,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""

    def texts_of(rows: pa.RecordBatch, sources: list[str]) -> dict:
        found = [main_text(s, weights) for s in sources]
        return {"page_id": rows.column("page_id"), "url": rows.column("url"), "text": found, "n_chars": [len(t) for t in found]}

    read = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = f"page_id {id_type(pages, id_col)}, url string, text string, n_chars long"
    return map_texts(read, texts_of, schema, text_col="html")


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))
