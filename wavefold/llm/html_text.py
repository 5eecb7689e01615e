"""Main text of web pages by the maximum-scoring run of tokens.

A page is read as words and tags.  Elements that never hold the article (scripts, menus,
forms, adverts, reader comments, ...) are left out by name, class, id or role, but never one that
holds the page's ``<article>`` or ``<main>`` or most of its words: there the name lowers the score.  Of the
rest each word scores +1 and each tag a negative weight; one linear scan finds
the contiguous run with the largest sum, and its words are the text.

Tag weights come from labelled pages: pages that mark their article themselves.  A tag
common inside articles costs next to nothing, a block tag met only outside costs several
blocks of words (an inline tag one word).  That divides an article from the rest of its page; on a page that marks
no article a block tag costs ``BLOCK_TAG`` words at most, one of a list or table ``ITEM_TAG``, whatever the
labelled pages hold, and inside a marked article tags cost next to nothing.  The fit reads at most ``FIT_PAGES`` labelled pages, chosen by a
hash of the page id; extraction then covers every page.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavefold.llm.common import bounded_sample, stage

FIT_PAGES = 500
WORDS_PER_BLOCK = 30
UNKNOWN_TAG = -1.0
CHEAPEST_TAG = -0.01
BLOCK_TAG, ITEM_TAG = -2.0, -0.4
# Share of its score that a word or tag keeps in a noise element that is not left out, and if the page marks an article elsewhere.
NOISE_SHARE, RIVAL_SHARE = 0.5, 0.1

# Element and attribute vocabulary of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body article main section div nav aside header footer form table ul ol dl blockquote "
                       "fieldset details dialog td th li".split())
ITEMS = frozenset("li dt dd tr td th thead tbody tfoot".split())
LEFT_OUT = frozenset("head title nav header footer aside form script style noscript template button select textarea "
                     "iframe svg canvas object menu dialog math audio video map".split())
SILENT = LEFT_OUT - frozenset("nav header footer aside form menu dialog".split())  # no element of these holds an article
ASIDE = frozenset("nav footer aside menu dialog".split())
NOISE = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav "
                  "navbar navigation breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr "
                  "notice notices alert popup modal overlay newsletter subscribe subscription social share sharing "
                  "related recommended recommendations comment comments commentlist disqus reply replies respond widget "
                  "toolbar pagination pager login signup search copyright disclaimer skip hidden".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NEVER_NOISE = frozenset("html body article main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][\w:-]*)([^<>]*)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z][^<>]*\Z",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _noise(name: str, attributes: str) -> str:
    """Why an element is left out: ``"silent"``, ``"aside"`` (not the article by its markup), ``"named"`` or ``""``."""
    if name in SILENT:
        return "silent"
    if name in ASIDE:
        return "aside"
    found = "named" if name in LEFT_OUT else ""
    if not attributes or name in NEVER_NOISE:
        return found
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "aside"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "aside"
        if key == "role" and value.lower() in ROLES or key in ("class", "id") and any(
                part.lower() in NOISE for part in _NAME_PART.findall(value)):
            found = "named"
    return found


class _Element:
    """A noise or article element while the page is read: its height, words and the articles in it."""

    def __init__(self, name: str, noise: str, height: int, words: int, shown: int):
        self.name, self.noise, self.height, self.words, self.shown = name, noise, height, -words, -shown
        self.holds, self.share = 0, 1.0  # words of the largest outermost article inside; share of the score


def _read(page: str) -> list[tuple[str, str, int, _Element | None]]:
    """Kind, value, height of the stack and noise element of every token, scripts and the like left out.

    Open elements form a stack; a closing tag ends what was left open inside it, and a
    new block ends an open paragraph, so unclosed and truncated markup stays readable.
    ``noise`` of an element that is not to be left out is set to ``"kept"``.
    """
    stack: list[str] = []
    out: list[tuple[str, str, int, _Element | None]] = []
    opened: list[_Element] = []
    noisy: list[_Element] = []
    words = shown = 0  # words outside scripts and the like; those of them outside ``aside`` elements
    within = Counter()  # open elements by their noise; ``"article"`` counts articles
    largest = 0  # words of the largest outermost article

    def text(raw: str) -> None:
        nonlocal words, shown
        out.append(("text", raw, len(stack), None))
        if not within["silent"]:
            n = len(raw.split())
            words += n
            shown += 0 if within["aside"] else n

    def end(height: int) -> None:
        nonlocal largest
        while opened and opened[-1].height > height:
            done = opened.pop()
            done.words += words
            done.shown += shown
            within[done.noise] -= 1
            if done.name in ("article", "main"):
                within["article"] -= 1
                done.holds = 0 if within["article"] else done.words
                largest = max(largest, done.holds)
            if opened:
                opened[-1].holds = max(opened[-1].holds, done.holds)

    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            text(page[at:found.start()])
        at = found.end()
        closing, name, attributes = found.group(2, 3, 4) if found.group(3) else found.group(5, 6, 7)
        if not name:
            continue
        name = name.lower()
        if closing:
            for height in range(len(stack), 0, -1):
                if stack[height - 1] == name:
                    del stack[height - 1:]
                    break
                if name not in CONTAINERS and stack[height - 1] in CONTAINERS:
                    break
            end(len(stack))
            out.append(("close", name, len(stack), None))
            continue
        if name not in INLINE and name not in VOID:
            for height in range(len(stack), 0, -1):
                if stack[height - 1] == "p" or stack[height - 1] == name == "li":
                    del stack[height - 1:]
                    break
                if stack[height - 1] in CONTAINERS:
                    break
            end(len(stack))
        below, element = len(stack), None
        if name not in VOID and not attributes.endswith("/"):
            stack.append(name)
            noise = _noise(name, attributes)
            if noise or name in ("article", "main"):
                element = _Element(name, noise, len(stack), words, shown)
                opened.append(element)
                within[noise] += 1
                within["article"] += name in ("article", "main")
                if noise:
                    noisy.append(element)
        out.append(("open", name, below, element))
    if at < len(page):
        text(page[at:])
    end(0)
    for element in noisy:
        holds_article = element.noise != "silent" and 0 < largest <= 2 * element.holds
        if holds_article or element.noise == "named" and 2 * element.shown > shown:
            element.noise = "kept"
            element.share = RIVAL_SHARE if largest and not holds_article else NOISE_SHARE
    return out


def tokens(page: str, everything: bool = False) -> Iterator[tuple[str, str, float]]:
    """``("text", raw)``, ``("open", tag)`` and ``("close", tag)`` in page order, noise left out unless ``everything``.

    The third value is the share of its score that a token keeps: less inside noise that holds most words of the page,
    until an ``<article>`` or ``<main>`` opens.
    """
    muted = 0  # height of the stack at the element that is left out, 1-based
    shares: list[tuple[int, float]] = []
    for kind, value, height, element in _read(page):
        if kind != "text":
            if height < muted:
                muted = 0
                if kind == "close":  # the tag that ends it belongs to it
                    while shares and height < shares[-1][0]:
                        shares.pop()
                    continue
            while shares and height < shares[-1][0]:
                shares.pop()
        if not muted and element is not None:
            if element.noise == "kept":
                shares.append((element.height, element.share))
            elif element.noise and not everything:
                muted = element.height
            elif element.name in ("article", "main"):
                shares.append((element.height, element.share))
        if not muted:
            yield kind, value, shares[-1][1] if shares else 1.0


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum (empty if none is positive; the first of equals)."""
    best, best_from, best_to = 0.0, 0, 0
    total, begin = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_from, best_to = total, begin, i + 1
    return best_from, best_to


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    found = list(tokens(page))
    scores, marked = [], 0
    article = any(kind == "open" and value in ("article", "main") for kind, value, _ in found)
    for kind, value, share in found:
        if kind == "text":
            scores.append(share * len(value.split()))
            continue
        if value in ("article", "main"):
            marked = max(0, marked + (1 if kind == "open" else -1))
        weight = weights.get(value, CHEAPEST_TAG if value in INLINE else UNKNOWN_TAG)
        if value not in ("article", "main"):
            if marked:  # the article is whole
                weight = CHEAPEST_TAG
            elif not article:
                weight = max(weight, ITEM_TAG if value in ITEMS else BLOCK_TAG)
        scores.append(share * weight)
    first, end = best_run(scores)
    out = []
    for kind, value, _ in found[first:end]:
        if kind == "text":
            out.append(html_lib.unescape(value))
        elif value not in INLINE:
            out.append(" ")
    return " ".join("".join(out).split())


def fit_weights(labelled: list[str]) -> dict[str, float]:
    """Tag weights from pages that mark their article with ``<article>`` or ``<main>``."""
    inside, every = Counter(), Counter()
    for page in labelled:
        every.update(value for kind, value, _ in tokens(page, everything=True) if kind != "text")
        depth = 0
        for kind, value, _ in tokens(page):
            if value in ("article", "main") and kind != "text":
                depth = max(0, depth + (1 if kind == "open" else -1))
            elif kind != "text" and depth:
                inside[value] += 1
    outside = every - inside
    n_in, n_out = sum(inside.values()) + 1, sum(outside.values()) + 1
    weights = {}
    for tag in {*inside, *outside}:
        odds = math.log((outside[tag] + 0.5) / n_out) - math.log((inside[tag] + 0.5) / n_in)
        cost = max(UNKNOWN_TAG, -odds) if tag in INLINE else -odds * WORDS_PER_BLOCK
        weights[tag] = min(CHEAPEST_TAG, cost)
    return weights


def learned_weights(pages: DataFrame, limit: int = FIT_PAGES) -> dict[str, float]:
    """Weights fitted on at most ``limit`` labelled pages of the table."""
    labelled = pages.filter(F.col("html").rlike(r"(?i)<(article|main)\b")).select("page_id", "html")
    chosen = stage(bounded_sample(labelled, "page_id", limit, 29), "html-sample")
    found = labelled.join(chosen, "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    return fit_weights([row["html"] for row in found.orderBy("page_id").collect()])


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Null, empty and text-free html give an empty text.  Rows that repeat are extracted one by one; other columns are
    not read.  Ties between runs go to the first.  Pages cut off in a tag lose that tag only.
    """
    if weights is None:
        weights = learned_weights(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(page, weights) for page in part.column("html").to_pylist()]
                text = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), text, pc.cast(pc.utf8_length(text), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of every page of ``pages``."""
    return extract(spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet"))
