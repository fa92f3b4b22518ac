"""HTML extraction by two-pass block rules.

Pass one decides blocks by their link density, their length and their density of
stop words (of marks of sentences in other scripts and languages), with where they
stand (page furniture, main element) as a prior; pass two gives blocks that are
too short to judge the label of their nearest decided neighbours.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .workers import ship

# Element names and words of class names, ids and roles.
BLOCK_TAGS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section
summary table tbody td tfoot th thead tr ul""".split())
RAW_TAGS = frozenset("script style noscript template textarea title iframe svg math object canvas select".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE_TAGS = frozenset("nav footer aside form menu dialog button".split())
MAIN_TAGS = frozenset("article main".split())
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs
comment comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus
footer gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice notices overlay
pager pagination popup promo promotion recommended related replies reply respond responses search share
sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget""".split())
HEADER_WORDS = frozenset("header topbar".split())
# names that text may have too: such blocks are judged by their densities, at a higher bar
WEAK_WORDS = frozenset("""alert comment complementary copyright discussion disclaimer legal notice notices related replies
reply respond responses search share sharing skip social""".split())
# words behind the name itself, words of layouts, and words that make a name a state
GENERIC_WORDS = frozenset("""area articles bar block body bottom box btn button buttons container content form group header
icons inner items left links list panel posts primary right row secondary section stories text top wrap wrapper""".split())
LAYOUT_WORDS = frozenset("article content layout main page site".split())
STATE_WORDS = frozenset("has hide is no not show with without".split())
STOP_WORDS = frozenset("""a and are as at be by for from have he in is it of on that the this to was were with you
au dans de des du en est et il la le les ne pas pour que qui sur un une
auf das dem den der die ein eine er es im ist mit nicht sich sie und von zu
al como con del el ella las lo los no para por se su una y""".split())

#: Lengths (characters) and densities of the block rules.
SHORT, LONG = 70, 200
LINK_DENSITY, STOP_DENSITY = 0.5, 0.25
#: Inside the main element fewer stop words are enough.
MAIN_STOP_DENSITY = 0.15
#: A page with fewer stop words than this is in none of their languages: marks of
#: sentences stand in for them there, as they do in text of another script.
KNOWN_DENSITY = 0.05
#: What a character of a wide script counts for.
WIDE = 3

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+|[^>]*)>|<[!?][^>]*>|<[a-zA-Z/!?][^>]*\Z""",
                  re.S)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

_LATIN = re.compile(r"[A-Za-z\u00aa\u00ba\u00c0-\u024f\u1e00-\u1eff]")
_WIDES = re.compile(r"[\u1100-\u11ff\u2e80-\u2fdf\u3005-\u3007\u3040-\u30ff\u3130-\u318f\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")
#: Marks that divide or end sentences; Thai, Lao, Khmer and Burmese prose goes without.
_MARKS = re.compile(r"[.,;:!?…\u037e\u0387\u0589\u05c3\u060c\u061b\u061f\u06d4\u0964\u0965\u104a\u104b\u1362-\u1368\u17d4\u17d5\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f]")
_UNMARKED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]")

GOOD, BAD, OPEN = 1, -1, 0
#: How sure it is that an element is page furniture: a weak name, a form (unless
#: the page stands in it), a name, its kind.
NO, WEAK, FORM, NAMED, SURE = range(5)


@functools.lru_cache(maxsize=4096)
def _named(token: str, header: bool) -> int:
    """What a class, id or role says: its words count as a whole or by the last
    (behind words like ``wrapper``), not as any part of it."""
    words = [w.lower() for w in _CAMEL.split(token) if w]
    known = FURNITURE_WORDS | HEADER_WORDS if header else FURNITURE_WORDS
    if not words or words[0] in STATE_WORDS:
        return NO
    name = list(words)
    if not all(w in known for w in name):
        while len(name) > 1 and name[-1] in GENERIC_WORDS and name[-1] not in known:
            name.pop()
        if name != words and not LAYOUT_WORDS.isdisjoint(name):
            return NO
    if all(w in known for w in name):
        return WEAK if all(w in WEAK_WORDS for w in name) else NAMED
    if name[-1] in known and name[-1] not in WEAK_WORDS and name[-2] not in STATE_WORDS:
        return NAMED
    return NO


def _furniture(tag: str, attrs: str, in_main: bool) -> int:
    if tag == "form":
        return FORM
    if tag in FURNITURE_TAGS or (tag == "header" and not in_main):
        return SURE
    if not attrs or tag in ("html", "body"):
        return NO
    level = NO
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (
                name == "style" and _NOT_SHOWN.search(value)):
            return SURE
        if name in ("class", "id", "role"):
            for token in value.split():
                if tag not in MAIN_TAGS:
                    level = max(level, _named(token, not in_main))
                elif "comment" in (w.lower() for w in _CAMEL.split(token)):
                    level = NAMED
    return level


def blocks(page: str) -> Iterator[tuple[str, int, int, bool, int]]:
    """(text, characters inside links, page furniture or not, stands in the main
    element, what an element around the main element says of it) for each block
    of text, in page order."""
    stack: list[tuple[str, int, bool, int]] = [("", NO, False, NO)]
    opened: Counter[str] = Counter()
    parts: list[str] = []
    linked: list[str] = []
    links, at = 0, 0

    def flush():
        text, inside = _plain(parts), _plain(linked)
        parts.clear()
        linked.clear()
        return (text, len(inside), *stack[-1][1:]) if text else None

    def close(depth: int) -> None:
        opened.subtract(e[0] for e in stack[depth:])
        del stack[depth:]

    while at < len(page):
        m = _TAG.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            parts.append(text)
            if links:
                linked.append(text)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW_TAGS and not closing:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 if end else len(page)
            at = at or len(page)
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag == "br":
            parts.append(" ")
            linked.append(" ")
        if tag not in BLOCK_TAGS and tag not in ("button", "span"):
            continue
        if tag in BLOCK_TAGS:
            block = flush()
            if block:
                yield block
            links = 0 if tag != "li" else links
        if closing:
            # a tag that is not open is not looked for, and only the last span ends
            depth = 0
            if opened[tag] > 0:
                low = len(stack) - 2 if tag == "span" else 0
                depth = next((k for k in range(len(stack) - 1, low, -1) if stack[k][0] == tag), 0)
            if depth:
                if stack[depth][1] != stack[depth - 1][1] and tag not in BLOCK_TAGS:
                    block = flush()
                    if block:
                        yield block
                close(depth)
        elif tag not in VOID_TAGS:
            if tag in BLOCK_TAGS and stack[-1][0] == "p":
                close(len(stack) - 1)
            if tag == "li" and stack[-1][0] == "li":
                close(len(stack) - 1)
            _, furniture, main, around = stack[-1]
            mine = _furniture(tag, m[3] or "", main)
            if tag in MAIN_TAGS and not main and furniture < SURE:
                around, furniture = NO if tag == "main" else furniture, NO
            if tag in BLOCK_TAGS or mine:
                if mine and tag not in BLOCK_TAGS:
                    block = flush()
                    if block:
                        yield block
                stack.append((tag, max(furniture, mine), main or tag in MAIN_TAGS, around))
                opened[tag] += 1
    block = flush()
    if block:
        yield block


def _plain(parts: list[str]) -> str:
    """Characters as they are read: references decoded, white space one space."""
    text = "".join(parts)
    return " ".join((html.unescape(text) if "&" in text else text).split())


def width(text: str) -> int:
    """The length of a text, characters of wide scripts counted WIDE times."""
    return len(text) if text.isascii() else len(text) + (WIDE - 1) * len(_WIDES.findall(text))


def _stops(text: str) -> tuple[int, int]:
    words = _WORD.findall(text.lower())
    return sum(map(STOP_WORDS.__contains__, words)), len(words)


def stop_density(text: str, counts: tuple[int, int], known: bool) -> float:
    """The share of stop words (``counts``: of them and of all words).  Text that they cannot tell anything about, in a
    script other than Latin or (not ``known``) on a page in another language, has
    the density of prose if it has marks of sentences or needs none."""
    foreign = not known
    if not text.isascii():
        letters = sum(map(str.isalpha, text))
        foreign = foreign or 2 * len(_LATIN.findall(text)) < letters
    if foreign:
        return STOP_DENSITY if _MARKS.search(text) or 2 * len(_UNMARKED.findall(text)) >= len(text) else 0.0
    return counts[0] / counts[1] if counts[1] else 0.0


def label(found: list[tuple[str, int, int, bool, int]]) -> list[int]:
    """GOOD or BAD for each block."""
    # a form that holds most of the prose is no furniture: the page stands in it
    prose = Counter()
    for t, linked, level, _, _ in found:
        if level <= FORM and width(t) >= SHORT and linked <= LINK_DENSITY * len(t):
            prose[level == FORM] += len(t)
    form = NO if prose[True] > prose[False] else NAMED
    found = [(t, linked, form if level == FORM else level, main, form if around == FORM else around)
             for t, linked, level, main, around in found]
    labels = _label([(t, linked, max(level, around), main) for t, linked, level, main, around in found])
    if GOOD not in labels and any(b[4] for b in found):  # that element stands around the whole page
        labels = _label([b[:4] for b in found])
    return labels


def _label(found: list[tuple[str, int, int, bool]]) -> list[int]:
    stops = [_stops(t) if level < NAMED and linked <= LINK_DENSITY * len(t) else (0, 0) for t, linked, level, _ in found]
    known = sum(s for s, _ in stops) >= KNOWN_DENSITY * sum(n for _, n in stops)
    inside = sum(len(t) for t, linked, level, main in found if main and level < NAMED and linked <= LINK_DENSITY * len(t))
    outside = sum(len(t) for t, linked, level, main in found if not main and not level and linked <= LINK_DENSITY * len(t))
    # the main element speaks for its blocks, and against others, if it has most of the text
    has_main = 0 < inside >= outside
    labels = []
    for (text, linked, level, main), counts in zip(found, stops):
        size = width(text)
        likely, unlikely = has_main and main and not level, level == WEAK or (has_main and not main)
        if level >= NAMED or linked > LINK_DENSITY * len(text):
            labels.append(BAD)
        elif size < SHORT:
            labels.append(BAD if level or (linked and not likely) else OPEN)
        elif (size >= LONG and not unlikely) or stop_density(text, counts, known) >= (
                MAIN_STOP_DENSITY if likely else STOP_DENSITY):
            labels.append(GOOD)
        else:
            labels.append(OPEN)
    if GOOD not in labels:  # nothing is sure: what is long enough and not linked is the text
        labels = [GOOD if kind == OPEN and width(b[0]) >= SHORT and not b[1] else kind for kind, b in zip(labels, found)]
    # blocks of the page's own furniture say nothing about their neighbours, nor
    # do blocks inside the main element about those outside
    out = list(labels)
    sides = groupby((k for k, b in enumerate(found) if b[2] < NAMED), lambda k: found[k][3] or not has_main)
    for side, run in sides:
        judged = list(run)
        follows, after = {}, None
        for k in reversed(judged):
            follows[k] = after
            after = k if labels[k] != OPEN else after
        before = None
        for k in judged:
            if labels[k] != OPEN:
                before = k
                continue
            after = follows[k]
            near = [labels[d] for d in (before, after) if d is not None]
            if len(set(near)) > 1:  # they disagree: the nearer, then the one that follows
                near = [labels[after] if after - k <= k - before else labels[before]]
            out[k] = near[0] if near else GOOD if side else BAD
    return out


def main_text(page: str | None) -> str:
    found = list(blocks(page or ""))
    return "\n\n".join(b[0] for b, kind in zip(found, label(found)) if kind == GOOD)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                         names=["id", "url", "text"])


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (main text of the whole
    page, blocks joined by two newlines; empty if there is none) and ``n_chars``.

    Character references are decoded and white space inside a block becomes one
    space.  Null and empty pages give an empty text; unclosed tags, comments
    and scripts end with the page.  Null ids and urls and repeated rows are
    extracted like any row.  Other columns are ignored; an empty table gives none.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([rows.schema["id"], rows.schema["url"], T.StructField("text", T.StringType())])
    return rows.mapInArrow(_extract, schema).select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
