"""Main text of web pages by the maximum-scoring contiguous region.

A page is a sequence of tags and words.  Words score positive and tags negative; a linear
scan finds the contiguous region of the largest sum, which is the content.  The weights
come from labelled pages, those that mark their content themselves (their ``article``
elements, or ``main`` without any): a word scores the share of words after the same kind of tag that are content
there, and a tag costs the more the rarer it is inside content.  A kind is the element
name and whether its class or id hints at boilerplate, so the table of weights is bounded.

Elements that never hold content (scripts, styles, forms, menus, asides, footers, ...) and
elements whose class or id says so (adverts, comments, notices, ...) are cut out with all
they contain, also inside the region.  A class or id says so only as a whole: ``ad`` and
``cookie-notice`` do, ``has-sidebar`` and ``related-work`` are hints that make a kind of their
own, which is weighed and not cut.  Headings are never cut for a class or id, an id counts on
boxes only (that of a heading, section or paragraph is made from its title), and no form or
element with such a class, id or role is cut that holds ``article`` or ``main``, but for comments
in or after an article.

Defined cases: a null, empty or tag-only page gives an empty text; a page cut off anywhere
is read to its end; unclosed paragraphs end where the next block begins; without labelled
pages the prior weights decide; repeated pages are extracted alike; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.plans.workspace import write_table

# Elements that hold no main text, by their meaning in HTML (fixed values).
CUT = frozenset(
    "head script style noscript template svg math iframe object canvas form button select "
    "textarea nav aside footer dialog menu".split()
)
# Their content is not markup: only their own end tag ends them (fixed values).
RAW = frozenset("script style textarea title".split())
# Elements without content (fixed values).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements that do not end a block of text (fixed values).
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
# Elements told apart in the weights; others share one kind (fixed values).
KNOWN = frozenset(
    "html body title header hgroup main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
    "table thead tbody tfoot tr td th caption blockquote pre figure figcaption details summary "
    "center address a b i em strong span br hr img".split()
)
# Start of a new one of these ends an open paragraph (fixed values).
ENDS_P = frozenset(
    "p div ul ol dl table section article main header footer aside nav form h1 h2 h3 h4 h5 h6 "
    "blockquote pre figure hr address".split()
)
CONTENT = frozenset(("article", "main"))
# Words in a class or id that mark boilerplate (fixed values).
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "comment comments disqus reply replies respond nav navbar navigation menu menus breadcrumb "
    "breadcrumbs sidebar side aside widget footer header masthead topbar toolbar cookie cookies "
    "consent notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended pagination pager copyright disclaimer legal "
    "skip hidden".split()
)
# Those of NOISE whose elements may hold articles: each comment is one (fixed values).
COMMENTS = frozenset("comment comments disqus reply replies respond".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements whose id names a part of the page, not a title in the text (fixed values).
BOXES = frozenset("div ul ol table td".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z)", re.S
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
PARTS = re.compile(r"[a-z]+")

# Weights before any page is seen: pseudo-counts inside and outside content.
PRIOR_IN, PRIOR_OUT = 1.0, 1.0
WORD, TAG = 1.0, 0.2  # score of a sure content word; cost of a tag common in content
REMOVED = "removed"  # kind of every element that is cut out
HINTED = "~"  # ends the kinds of elements that are not, although their class or id has a word of NOISE
CUT_OUT = TAG / 4  # cost of an element that is cut out: it says little about what is around it


def _attributes(tag: str) -> dict[str, str]:
    """Names and values in small letters; the first of several equal names counts."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(tag, NAME.match(tag).end()):
        out.setdefault(name.lower(), next((v for v in values if v), "").lower())
    return out


def _hints(name: str, tag: str) -> tuple[set[str], bool]:
    """Words that say the element is boilerplate, and whether there are mere hints of it."""
    said, hinted = set(), False
    given = _attributes(tag)
    if given.get("role", "").strip() in ROLES:
        said.add("role")
    if "hidden" in given or given.get("aria-hidden", "").strip() == "true":
        said.add("hidden")
    classes = given.get("class", "").split()
    for at in ("class", "id"):
        counts = name not in HEADINGS
        if at == "id":
            counts = name in BOXES and "section" not in classes
        for value in classes if at == "class" else given.get("id", "").split():
            parts = PARTS.findall(value)
            noise = NOISE.intersection(parts)
            hinted |= bool(noise)
            if counts and noise and len(noise) == len(set(parts)):
                said |= noise
    return said, hinted


Piece = tuple[str, str, str, bool, bool]


def _pieces(page: str) -> list[Piece]:
    """The page as (text, "", "", ..) and (tag, name, raw text in it, closing, without end tag) in order."""
    out: list[Piece] = []
    at, end = 0, len(page)
    while at < end:
        found = TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at:
            out.append((page[at:stop], "", "", False, False))
        if not found:
            break
        at = found.end()
        tag = found.group()
        named = NAME.match(tag)
        if not named:
            continue  # a comment or declaration joins nothing and separates nothing
        name, closing = named.group(1).lower(), tag[1] == "/"
        alone = name in VOID or (tag.endswith("/>") and name not in RAW)
        raw = ""
        if not closing and name in RAW and not alone:
            # up to its own end tag
            close = re.compile(rf"</{name}\b", re.I).search(page, at)
            raw = page[at : close.start() if close else end]
            at += len(raw)
        out.append((tag, name, raw, closing, alone))
    return out


def _holders(pieces: list[Piece]) -> set[int]:
    """Places of the start tags whose elements hold ``article`` or ``main``."""
    out: set[int] = set()
    opened: list[tuple[int, str]] = []
    count: Counter = Counter()
    for at, (_, name, _, closing, alone) in enumerate(pieces):
        if not name or alone:
            continue
        if closing:
            if count[name]:
                while True:
                    _, last = opened.pop()
                    count[last] -= 1
                    if last == name:
                        break
            continue
        if name in ENDS_P and opened and opened[-1][1] == "p":
            opened.pop()
            count["p"] -= 1
        if name in CONTENT:
            for place, _ in reversed(opened):
                if place in out:
                    break  # and so are all around it
                out.add(place)
        opened.append((at, name))
        count[name] += 1
    return out


def tokens(page: str) -> list[tuple[str, str]]:
    """The page as ("tag", kind), ("break", "") and ("text", raw) in order.

    What is cut out leaves one tag, so it separates but says nothing.
    """
    out: list[tuple[str, str]] = []
    open_cut: list[str] = []  # the outermost element that is cut out, and open ones in it
    content: list[str] = []  # open elements that mark the content
    had_article = False
    pieces = _pieces(page)
    holders = _holders(pieces)
    for at, (tag, name, raw, closing, alone) in enumerate(pieces):
        if not name:
            if not open_cut:
                out.append(("text", tag))
            continue
        if open_cut:
            if closing:
                if name in open_cut:
                    while open_cut.pop() != name:
                        pass
                    if not open_cut:
                        continue  # its start tag stands for all of it
                elif name in ("body", "html", *CONTENT):
                    open_cut.clear()  # never closed: it ends with what surrounds it
            elif not alone:
                if name in ENDS_P and open_cut[-1] == "p" and len(open_cut) > 1:
                    open_cut.pop()
                elif name in ENDS_P and open_cut == ["p"]:
                    open_cut.clear()
                elif name == "body":
                    open_cut.clear()
                if open_cut:
                    open_cut.append(name)
        if not open_cut:
            said, hinted = set(), False
            if not closing and name not in ("html", "body", *CONTENT):
                said, hinted = _hints(name, tag)
                if at in holders and not (said & COMMENTS and (had_article or "article" in content)):
                    said = set()
                if name == "header" and not content and at not in holders:
                    said.add(name)
            noisy = bool(said) or (name in CUT and not (name == "form" and at in holders))
            if noisy and not closing and not alone:
                open_cut.append(name)
            if name in CONTENT:
                if not closing:
                    content.append(name)
                elif name in content:
                    while content.pop() != name:
                        pass
                    had_article |= name == "article"
            if name not in INLINE:
                out.append(("break", ""))
            kind = REMOVED if noisy else (name if name in KNOWN else "other") + HINTED * hinted
            out.append(("tag", f"{'/' * closing}{kind}"))
        if raw and not open_cut:
            out.append(("text", raw))
    return out


def labelled_counts(page: str) -> Counter | None:
    """(what, kind, inside) -> count of a page that marks its content; None if it does not."""
    sequence = tokens(page)
    marks = {v for t, v in sequence if t == "tag" and v in CONTENT}
    if not marks:
        return None
    mark = min(marks)  # article before main, which may hold more than the content
    depth, last, counts = 0, "", Counter()
    for what, value in sequence:
        if what == "tag":
            if value == "/" + mark:
                depth = max(0, depth - 1)
            counts["tag", value, depth > 0] += 1
            if value == mark:
                depth += 1
            last = value
        elif what == "text":
            counts["word", last, depth > 0] += len(value.split())
    return counts


Weights = dict[tuple[str, str], float]


def weights_from(counts: dict[tuple[str, str, bool], int]) -> Weights:
    """Score of a word after each kind of tag, and (negative) score of each kind of tag."""
    out: Weights = {}
    for what, kind in {(w, k) for w, k, _ in counts}:
        inside = counts.get((what, kind, True), 0) + PRIOR_IN
        outside = counts.get((what, kind, False), 0) + PRIOR_OUT
        share = inside / (inside + outside)
        # log odds against content, never below the cost of a common tag
        out[what, kind] = (
            WORD * share if what == "word" else -max(TAG, math.log((1 - share) / share) * 2)
        )
        if kind.endswith(REMOVED) and what == "tag":
            out[what, kind] = -CUT_OUT
    return out


def _score(weights: Weights, what: str, kind: str) -> float:
    known = weights.get((what, kind), weights.get((what, kind.removesuffix(HINTED))))
    if known is not None:
        return known
    if what == "word":
        return WORD / 2
    if kind == REMOVED:
        return -CUT_OUT
    return -TAG


def region(sequence: list[tuple[str, str]], weights: Weights) -> tuple[int, int]:
    """Bounds of the contiguous part of the largest score; the first of several equal ones."""
    best, best_from, best_to = 0.0, 0, 0
    total, start, last = 0.0, 0, ""
    for at, (what, value) in enumerate(sequence):
        if what == "tag":
            total += _score(weights, "tag", value)
            last = value
        elif what == "text":
            total += _score(weights, "word", last) * len(value.split())
        if total <= 0:
            total, start = 0.0, at + 1
        elif total > best + 1e-9:
            best, best_from, best_to = total, start, at + 1
    return best_from, best_to


def extract(page: str | None, weights: Weights) -> str:
    """The main text: blocks in page order joined by one space."""
    if not page:
        return ""
    sequence = tokens(page)
    first, last = region(sequence, weights)
    parts = [
        value if what == "text" else " " for what, value in sequence[first:last] if what != "tag"
    ]
    # a character reference that stands across a tag is none, so each text decodes alone
    return " ".join("".join(map(html.unescape, parts)).split())


# --- on tables ------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for page in batch.column(0):
            text = page.as_py()
            found = labelled_counts(text) if text else None
            if found:
                total.update(found)
    # bounded: kinds of tags times four
    rows = [(*key, count) for key, count in total.items()]
    yield pa.RecordBatch.from_pydict(
        {
            "what": pa.array([r[0] for r in rows], pa.string()),
            "kind": pa.array([r[1] for r in rows], pa.string()),
            "inside": pa.array([r[2] for r in rows], pa.bool_()),
            "n": pa.array([r[3] for r in rows], pa.int64()),
        }
    )


def learn_weights(pages: DataFrame) -> Weights:
    """Weights from all pages that mark their content."""
    counts = (
        pages.select(F.col("html").cast("string"))
        .mapInArrow(_count, "what string, kind string, inside boolean, n long")
        .groupBy("what", "kind", "inside")
        .agg(F.sum("n").alias("n"))
    )
    found = write_table(counts, "tag-counts").collect()  # a row per kind of tag
    return weights_from({(r.what, r.kind, r.inside): r.n for r in found})


def _extractor(weights: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py(), weights.value) for page in batch.column("html")]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(map(len, texts), pa.int64()),
                }
            )

    return run


def extract_pages(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page; weights are learned from ``pages`` unless given."""
    if weights is None:
        weights = learn_weights(pages)
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return narrow.mapInArrow(_extractor(shared), "page_id long, url string, text string, n_chars long")
