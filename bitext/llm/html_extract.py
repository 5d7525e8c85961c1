"""Main text of HTML pages as the maximum-scoring run of page tokens.

A page is a sequence of tags and words (words of links, and of everything
else, are told apart). Each kind of token has a weight: the logarithm of how much
more often it stands inside the main text than outside. Words thus score
positive and tags at most 0, those of navigation and page frames far below. Elements that are never
main text (scripts, forms, menus, notices, adverts, ...) are found first, on the
whole page; each is one item of a fixed negative score, whatever its length, so that
a run neither starts nor ends with it, but text goes on behind an advert in its
middle. One linear scan (Kadane) then finds the contiguous run of items with the
largest sum, the content region; what it holds outside such elements becomes blocks.

Weights come from labelled pages: pages that mark their main text themselves with
one <article> or <main> element (at most about ``MAX_PAGES``, chosen by a hash
of page_id: the documented bound of the sample). These marks are labels only: their
tags have no weight and no score, so that a page without them gives the same
text. Without marked pages ``DEFAULT_WEIGHTS`` are used.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one line feed, in page order; block
tags and <br> end a block. Nothing else is dropped or cut.

Defined results
* NULL, empty and wordless html: text ''.
* Unclosed and stray tags: an element ends with its parent, <p> also before the next
  block and list items and cells before the next one; a stray end tag ends a block.
  A cut-off tag at the end of the page is no text.
* Empty tables give no rows.
* On equal sums the earlier, then the longer run wins.
* Rows are independent; repeated rows, NULL page_id or url and extra columns do
  not matter (extra columns are not read).

Scale: no shuffle; a scan for the sample and a scan for the texts. The weights
are one number per tag name (names seen less than ``LEAST_SEEN`` times share one).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import load_table, map_rows

MAX_PAGES = 4_000
LEAST_SEEN = 5

# --- fixed values: element names of the HTML standard, and usual class names --------
RAW = "script style noscript template textarea title svg math iframe object select"
NEVER = ("head nav aside form button footer header dialog menu label input fieldset canvas audio video "
         "map datalist option").split()
BLOCK = set("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
p pre search section summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
# whole names of a class attribute or an id
NEVER_CLASSES = set("""ad ads advert adverts advertisement advertising ad-banner ad-box ad-container ad-slot ad-unit
adsbygoogle banner breadcrumb breadcrumbs comment comments comment-list comments-area comment-section comment-form
cookie cookies cookie-banner cookie-bar cookie-consent cookie-notice consent disqus disqus_thread footer gdpr
header login masthead menu menus main-menu modal nav navbar navigation main-nav main-navigation site-nav
newsletter notice notices pagination popup promo promoted promotion related related-posts replies reply respond
share sharing share-buttons sidebar signup site-footer site-header page-footer social social-links social-share
sponsor sponsored subscribe toolbar widget""".split())
NEVER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
               "menubar", "form", "toolbar"}
DEFAULT_WEIGHTS = {"word": 1.0, "link word": -0.5, "tag": -3.0, "p": 0.0, "/p": 0.0, "b": 0.0, "/b": 0.0, "br": 0.0,
                   "h1": 0.0, "/h1": 0.0, "h2": 0.0, "/h2": 0.0}
# -------------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(" + "|".join(RAW.split()) + r")\b[^>]*(?:>(?:.*?</\1\s*>|.*\Z)|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)", re.I | re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
#: Elements that may stand in <head>, and those that end an open element of the same set.
_HEAD = {"title", "meta", "link", "base", "style", "script", "noscript", "template"}
_ENDED_BY_NEXT = {n: set(names.split()) for names in ("li", "dt dd", "td th", "tr", "option") for n in names.split()}
#: Score of an element that is never main text.
NEVER_SCORE = -1.0
#: Words of links in the running text cost no more than this.
LEAST_LINK_SCORE = -2.0
LABELS = ("article", "main")

Token = tuple  # (kind, name or text, attributes)


def tokens(page: str) -> list[Token]:
    """``("open" | "close" | "text", name or text, attributes)``; comments and
    elements whose content is not text are gone."""
    out, at = [], 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            out.append(("text", page[at:m.start()], ""))
        at = m.end()
        name = m[3] or m[6]
        if name:
            closing = m[2] if m[3] else m[5]
            attributes = (m[4] if m[3] else m[7]) or ""
            out.append(("close" if closing else "open", name.lower(), attributes))
    if at < len(page):
        out.append(("text", page[at:], ""))
    return out


def _is_never(name: str, attributes: str) -> bool:
    if name in NEVER:
        return True
    if not attributes:
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and not NEVER_CLASSES.isdisjoint(value.split()):
            return True
        if key == "role" and value in NEVER_ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
    return False


def never_elements(found: list[Token]) -> list[int]:
    """Per token: 0 outside the elements that are never main text, 1 for the first
    token of an outermost one, 2 for the rest of it."""
    marks, stack, open_names, never = [], [], Counter(), 0

    def end():
        nonlocal never
        name, own = stack.pop()
        open_names[name] -= 1
        never -= own

    for kind, value, attributes in found:
        before = never
        if stack and stack[-1][0] == "head" and (
                kind == "open" and value not in _HEAD or kind == "text" and not value.isspace()):
            end()
        if kind == "open":
            if value in BLOCK and stack and stack[-1][0] == "p" or stack and stack[-1][0] in _ENDED_BY_NEXT.get(value, ()):
                end()
            if value not in VOID and not attributes.rstrip().endswith("/"):
                own = _is_never(value, attributes)
                marks.append(0 if not never and not own else 1 if not never else 2)
                stack.append((value, own))
                open_names[value] += 1
                never += own
                continue
        elif kind == "close" and open_names[value]:
            while stack[-1][0] != value:
                end()
            end()
            marks.append(2 if before else 0)
            continue
        marks.append(2 if never else 0)
    return marks


def scored_items(found: list[Token], never: list[int] | None = None) -> list[tuple[str, int]]:
    """``(kind of weight, number of tokens)`` of each token; given ``never``, each
    element that is never main text is one token of kind ``never``."""
    out, links = [], 0
    for i, (kind, value, _) in enumerate(found):
        if kind != "text" and value == "a":
            links = kind == "open"
        if never and never[i]:
            out.append(("never", int(never[i] == 1)))
        elif kind == "text":
            out.append(("link word" if links else "word", len(value.split())))
        elif value in LABELS:
            out.append(("label", 0))
        else:
            out.append((value if kind == "open" else "/" + value, 1))
    return out


def marked_region(found: list[Token]) -> tuple[int, int] | None:
    """Tokens inside the page's one <article> or <main> element, without its own tags."""
    for name in LABELS:
        opens = [i for i, t in enumerate(found) if t[0] == "open" and t[1] == name]
        closes = [i for i, t in enumerate(found) if t[0] == "close" and t[1] == name]
        if len(opens) == len(closes) == 1 and opens[0] < closes[0]:
            return opens[0] + 1, closes[0]
    return None


def region_counts(page: str) -> tuple[Counter, Counter] | None:
    """Token counts inside and outside the marked main text."""
    found = tokens(page)
    marked = marked_region(found)
    if marked is None:
        return None
    inside, outside = Counter(), Counter()
    for i, (kind, n) in enumerate(scored_items(found)):
        if n:
            (inside if marked[0] <= i < marked[1] else outside)[kind] += n
    return inside, outside


def learn_weights(counts: list[tuple[str, int, int]]) -> dict[str, float]:
    """Log-odds weights of ``(kind, inside, outside)``; smoothed by one half."""
    seen: dict[str, list[float]] = {}
    for kind, inside, outside in counts:
        own = kind if inside + outside >= LEAST_SEEN or "word" in kind else "tag"
        held = seen.setdefault(own, [0, 0])
        held[0] += inside
        held[1] += outside
    total_in, total_out = (sum(c[k] for c in seen.values()) for k in (0, 1))
    if not total_in or not total_out:
        return dict(DEFAULT_WEIGHTS)
    weights = {kind: math.log((a + 0.5) / (total_in + 1)) - math.log((b + 0.5) / (total_out + 1))
               for kind, (a, b) in seen.items()}
    # words are what is looked for, whatever the share of them outside
    weights["word"] = max(weights.get("word", 0.0), 0.1)
    weights.setdefault("link word", DEFAULT_WEIGHTS["link word"])
    weights["tag"] = min(weights.get("tag", DEFAULT_WEIGHTS["tag"]), 0.0)
    return weights


def item_scores(weights: dict[str, float]) -> dict[str, float]:
    """Words score positive, tags at most 0: a tag is no reason to take more text."""
    scores = {kind: w if kind == "word" else min(w, 0.0) for kind, w in weights.items()}
    return {**scores, "link word": max(scores["link word"], LEAST_LINK_SCORE), "never": NEVER_SCORE}


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the largest positive sum; (0, 0) if none."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(scores):
        if total < 0:
            total, start = 0.0, i
        total += x
        if total > best or total == best and bounds[1] and start == bounds[0]:
            best, bounds = total, (start, i + 1)
    return bounds


def region_text(found: list[Token], never: list[int] | None = None) -> str:
    """Blocks of the tokens, without elements that are never main text."""
    blocks, parts = [], []
    for (kind, value, _), mark in zip(found, never_elements(found) if never is None else never):
        if kind != "text":
            if value in BLOCK:
                blocks.append("".join(parts))
                parts = []
        elif not mark:
            parts.append(value)
    blocks.append("".join(parts))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    found = tokens(page)
    never = never_elements(found)
    scores = item_scores(weights)
    lo, hi = best_run([scores.get(kind, scores["tag"]) * n for kind, n in scored_items(found, never)])
    return region_text(found[lo:hi], never[lo:hi])


# --- jobs --------------------------------------------------------------------------
def page_weights(pages: DataFrame, max_pages: int = MAX_PAGES) -> dict[str, float]:
    total = pages.count()
    if not total:
        return dict(DEFAULT_WEIGHTS)
    units = 1 << 24
    picked = pages.where(F.pmod(F.xxhash64("page_id", F.lit(4)), F.lit(units)) < units * max_pages // total + 1)

    def make():
        inside, outside = Counter(), Counter()

        def work(texts):
            for t in texts:
                found = region_counts(t) if t else None
                if found:
                    inside.update(found[0])
                    outside.update(found[1])
            return iter(())

        def flush():
            kinds = sorted({*inside, *outside})
            yield {"kind": kinds, "inside": [inside[k] for k in kinds], "outside": [outside[k] for k in kinds]}

        work.flush = flush
        return work

    counts = map_rows(picked, ["html"], "kind string, inside long, outside long", make).groupBy("kind").agg(
        F.sum("inside"), F.sum("outside"))
    return learn_weights(sorted(tuple(r) for r in counts.collect()))


def extract_main_text(pages: DataFrame, max_pages: int = MAX_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    weights = page_weights(pages, max_pages)
    kind = pages.schema["page_id"].dataType.simpleString()

    def make():
        def work(page_ids, urls, texts):
            found = [main_text(t, weights) for t in texts]
            yield {"page_id": page_ids, "url": urls, "text": found, "n_chars": [len(t) for t in found]}

        return work

    return map_rows(pages, ["page_id", "url", "html"], f"page_id {kind}, url string, text string, n_chars long", make)


def op4_html_text(spark, sf_dir):
    return extract_main_text(load_table(spark, sf_dir, "pages"))
