"""Main text of web pages: flat text blocks, classified by a decision tree on their own and their neighbours' features."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Elements that a block of text ends at.
BREAKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav noscript ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Those of them that hold others and whose kind matters for what is inside.
HOLDERS = frozenset(
    "article aside blockquote body button details dialog div dl fieldset figure footer form head header html iframe "
    "main nav noscript ol section select svg table template ul".split()
)
#: Their content is no markup and no text of the page.
RAW = frozenset("script style textarea title xmp".split())
BAD_TAGS = frozenset(
    "aside button dialog footer form head header iframe menu nav noscript select svg template".split()
)
GOOD_TAGS = frozenset(("article", "main"))
#: Words in class, id and role that tell what a holder is for.
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts alert author-bio banner breadcrumb breadcrumbs byline-share "
    "comment comments commentlist complementary consent contentinfo cookie cookies disqus footer gdpr header hidden "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification outbrain overlay "
    "pagination paywall popup promo promos promoted recommended related reply replies respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe taboola tags toolbar topbar warning widget widgets".split()
)
#: A name in which one of these comes before a bad word, or one of the others after it, tells how the page is laid out
#: or what it is about, not what the holder is for.
BEFORE = frozenset("cat categories category format has have hide no non not show tag taxonomy term topic type with without".split())
AFTER = frozenset("closed disabled enabled layout off on open page".split())
#: Of articles inside fewer of these the page's own is chosen.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
GOOD_WORDS = frozenset("article articlebody content entry main maincontent post story text body-text".split())

# What opens always ends, at the end of the page if need be, so no stretch is searched twice.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|"""
    r"""<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>"'=]|=\s*"[^"]*(?:"|\Z)|=\s*'[^']*(?:'|\Z)|["'=])*+)(?:>|\Z)""",
    re.S,
)
_KIND = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Za-z0-9]+(?:[-_]+[A-Za-z0-9]+)*")
_PART = re.compile(r"[a-z0-9]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}


class Block(NamedTuple):
    text: str
    words: int
    links: float  # share of words inside links
    bad: bool  # inside a holder that is not for the main text
    good: bool  # inside a holder that is
    heading: bool


def _bad_words(parts: list[str]) -> set[str]:
    """The bad words of a name that say what its holder is for."""
    found = {whole} if (whole := "-".join(parts)) in BAD_WORDS else set()
    for i, part in enumerate(parts):
        if part in BEFORE and part not in BAD_WORDS:
            break
        if part in BAD_WORDS and not (i + 1 < len(parts) and parts[i + 1] in AFTER):
            found.add(part)
    return found


def _cue(tag: str, attributes: str, in_article: bool) -> tuple[int, set[str]]:
    """-1 for holders of what surrounds a page's main text, 1 for those of the main text, 0 for others; its bad words."""
    if tag in BAD_TAGS and not (tag == "header" and in_article):
        return -1, set()
    names: set[str] = set()
    bad: set[str] = set()
    for match in _KIND.finditer(attributes):
        for name in _NAME.findall((match[1] or match[2] or match[3] or "").lower()):
            parts = _PART.findall(name)
            names.update(parts, ("-".join(parts),))
            bad |= _bad_words(parts)
    if tag not in ("body", "html") and tag not in GOOD_TAGS and bad:
        return -1, bad
    return int(tag in GOOD_TAGS or bool(names & GOOD_WORDS)), set()


def blocks(page: str) -> list[Block]:
    """Cut a page into blocks of text in page order. Broken nesting is borne: an end tag closes to its start tag.

    Holders that contain the page's article, its main or else the longest article, are not bad by their names, nor forms.
    """
    found, around = _cut(page, frozenset())
    return _cut(page, around)[0] if around else found


def _cut(page: str, around: frozenset[int]) -> tuple[list[Block], frozenset[int]]:
    """The blocks if the holders of the numbers ``around`` are not bad, and the bad holders around the page's article."""
    found: list[Block] = []
    holders: list[tuple[str, int, int]] = []  # open holders, their cues and numbers
    parents: list[tuple[int, bool, int]] = []  # by number: the holder around it, whether bad but no bad tag, comments around
    articles: list[list] = []  # whether main, minus the comment holders around, words, the holder around
    inside, shut = -1, 0  # depth of the open article, open holders of bad tags
    pieces: list[tuple[str, bool]] = []
    counts = [0, 0, 0]  # open holders by cue: bad at -1, good at 1
    link, heading = 0, False

    def end() -> None:
        nonlocal pieces
        if pieces:
            text = " ".join("".join(t for t, _ in pieces).split())
            if text:
                words = len(text.split(" "))
                linked = sum(len(t.split()) for t, inside in pieces if inside)
                share = min(1.0, linked / words)
                found.append(Block(text, words, share, counts[-1] > 0, counts[1] > 0, heading))
                if inside >= 0:
                    articles[-1][2] += words
            pieces = []

    def close(upto: int) -> None:
        nonlocal inside, shut
        while len(holders) > upto:
            _, cue, number = holders.pop()
            counts[cue] -= 1
            shut -= cue == -1 and not parents[number][1]
        if inside >= upto:
            inside = -1

    at = 0
    while True:
        match = _TAG.search(page, at)
        text = page[at : match.start() if match else len(page)]
        if text:
            pieces.append((html.unescape(text), link > 0))
        if match is None:
            break
        at = match.end()
        if not match[2]:
            continue
        tag, closing = match[2].lower(), bool(match[1])
        if tag in BREAKS or tag in HOLDERS or tag in RAW:
            end()
        if tag in RAW:
            if not closing:
                stop = _RAW_END[tag].search(page, at)
                at = stop.end() if stop else len(page)
        elif tag == "a":
            link = 0 if closing else 1
        elif tag in HOLDERS:
            link = 0
            if closing:
                for i in range(len(holders) - 1, -1, -1):
                    if holders[i][0] == tag:
                        close(i)
                        break
            else:
                if tag == "body":  # a head that was not closed ends here
                    close(0)
                number, outer = len(parents), holders[-1][2] if holders else -1
                cue, bad = _cue(tag, match[3] or "", counts[1] > 0)
                cue = 0 if number in around else cue
                comments = (parents[outer][2] if holders else 0) + bool(bad & COMMENT_WORDS)
                if tag in GOOD_TAGS and inside < 0 and not shut:
                    articles.append([tag == "main", -comments, 0, outer])
                    inside = len(holders)
                parents.append((outer, cue == -1 and (bool(bad) or tag == "form"), comments))
                holders.append((tag, cue, number))
                counts[cue] += 1
                shut += cue == -1 and not parents[number][1]
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = not closing
        if tag == "p":
            heading = False
    end()
    bad_around = set()
    place = max(articles, key=lambda x: x[:3])[3] if articles else -1
    while place >= 0:
        place, bad, _ = parents[(number := place)]
        if bad:
            bad_around.add(number)
    return found, frozenset(bad_around)


#: Columns of the labelled table and of ``table``.
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "bad", "good", "page_good", "heading")


def table(page: Sequence[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block of a page; beyond its ends neighbours count as empty."""
    if not page:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in page], dtype=float)
    links = np.array([b.links for b in page])
    good = np.array([b.good and not b.bad for b in page], dtype=float)
    rest = [[b.bad for b in page], [b.good for b in page]]
    before, after = (lambda x: np.r_[0.0, x[:-1]]), (lambda x: np.r_[x[1:], 0.0])
    columns = [words, links, before(words), before(links), after(words), after(links), *rest]
    columns += [np.full(len(page), good.max()), [b.heading for b in page]]
    return np.column_stack(columns).astype(float)


#: The labelled table: blocks seen on common page layouts, in the order of FEATURES, and whether they are main text.
LABELLED = (
    # pages that mark their main text: inside it all blocks count, however short
    ((42, 0.0, 12, 0.0, 55, 0.0, 0, 1, 1, 0), 1), ((2, 0.0, 60, 0.0, 35, 0.0, 0, 1, 1, 0), 1),
    ((1, 0.0, 25, 0.0, 6, 0.2, 0, 1, 1, 0), 1), ((9, 0.0, 14, 0.0, 70, 0.0, 0, 1, 1, 1), 1),
    ((180, 0.02, 9, 0.0, 44, 0.0, 0, 1, 1, 0), 1), ((6, 1.0, 50, 0.0, 61, 0.0, 0, 1, 1, 0), 1),
    ((15, 0.4, 33, 0.0, 28, 0.1, 0, 1, 1, 0), 1), ((3, 0.0, 2, 0.0, 4, 0.0, 0, 1, 1, 0), 1),
    ((12, 0.0, 0, 0.0, 0, 0.0, 0, 1, 1, 0), 1), ((5, 0.0, 1, 1.0, 20, 0.0, 0, 1, 1, 1), 1),
    ((3, 0.0, 40, 0.0, 2, 1.0, 0, 1, 1, 0), 1), ((31, 0.0, 50, 0.0, 1, 1.0, 0, 1, 1, 0), 1),
    ((2, 1.0, 1, 1.0, 3, 1.0, 0, 1, 1, 0), 1), ((28, 0.9, 14, 0.5, 9, 0.8, 0, 1, 1, 0), 1),
    ((64, 0.0, 3, 1.0, 90, 0.0, 0, 1, 1, 0), 1), ((1, 0.0, 0, 0.0, 1, 0.0, 0, 1, 1, 1), 1),
    # around it and in marked surroundings nothing does
    ((4, 0.0, 1, 1.0, 60, 0.0, 0, 0, 1, 0), 0), ((6, 0.0, 0, 0.0, 120, 0.0, 0, 0, 1, 1), 0),
    ((20, 0.0, 15, 0.0, 80, 0.0, 0, 0, 1, 0), 0), ((45, 0.1, 33, 0.0, 41, 0.0, 0, 0, 1, 0), 0),
    ((55, 0.0, 1, 1.0, 38, 0.0, 0, 0, 1, 0), 0), ((2, 0.0, 70, 0.0, 90, 0.0, 0, 0, 1, 0), 0),
    ((30, 0.0, 9, 0.0, 66, 0.0, 1, 0, 1, 0), 0), ((5, 0.0, 0, 0.0, 75, 0.0, 1, 0, 1, 0), 0),
    ((14, 0.0, 1, 1.0, 48, 0.0, 1, 0, 1, 1), 0), ((88, 0.0, 40, 0.0, 60, 0.0, 1, 1, 1, 0), 0),
    ((10, 0.0, 8, 0.0, 72, 0.0, 1, 0, 0, 0), 0), ((52, 0.0, 31, 0.0, 1, 1.0, 1, 0, 0, 0), 0),
    ((1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 1, 0), 0), ((8, 0.0, 1, 1.0, 10, 0.0, 1, 0, 1, 0), 0),
    ((12, 0.1, 40, 0.0, 0, 0.0, 1, 0, 1, 0), 0), ((60, 0.0, 10, 0.0, 80, 0.0, 1, 0, 1, 0), 0),
    ((25, 0.0, 70, 0.0, 22, 0.0, 1, 1, 1, 0), 0), ((4, 0.0, 25, 0.0, 30, 0.0, 1, 1, 1, 1), 0),
    ((110, 0.0, 25, 0.0, 30, 0.0, 1, 1, 1, 0), 0), ((2, 1.0, 44, 0.0, 3, 1.0, 1, 1, 1, 0), 0),
    ((7, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0), 0), ((30, 0.0, 9, 0.0, 12, 0.0, 0, 0, 1, 0), 0),
    ((95, 0.0, 20, 0.0, 3, 1.0, 0, 0, 1, 0), 0), ((3, 1.0, 30, 0.0, 2, 1.0, 0, 0, 1, 0), 0),
    ((6, 0.0, 50, 0.0, 0, 0.0, 0, 0, 1, 1), 0), ((1, 1.0, 2, 1.0, 2, 1.0, 0, 0, 1, 0), 0),
    # pages that do not mark it: length, links and neighbours decide
    ((70, 0.0, 8, 0.0, 55, 0.0, 0, 0, 0, 0), 1), ((35, 0.05, 60, 0.0, 80, 0.0, 0, 0, 0, 0), 1),
    ((120, 0.02, 0, 0.0, 0, 0.0, 0, 0, 0, 0), 1), ((18, 0.0, 45, 0.0, 40, 0.0, 0, 0, 0, 0), 1),
    ((5, 0.0, 50, 0.0, 65, 0.0, 0, 0, 0, 0), 1), ((2, 0.0, 38, 0.0, 41, 0.0, 0, 0, 0, 0), 1),
    ((8, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 1), 1), ((6, 0.0, 3, 1.0, 45, 0.0, 0, 0, 0, 1), 1),
    ((22, 0.2, 30, 0.0, 28, 0.0, 0, 0, 0, 0), 1), ((26, 0.0, 9, 0.0, 31, 0.0, 0, 0, 0, 0), 1),
    ((60, 0.0, 2, 0.0, 2, 1.0, 0, 0, 0, 0), 1), ((35, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 0), 1),
    ((48, 0.0, 22, 0.0, 0, 0.0, 0, 0, 0, 0), 1), ((27, 0.0, 60, 0.0, 5, 0.5, 0, 0, 0, 0), 1),
    ((33, 0.1, 1, 1.0, 20, 0.0, 0, 0, 0, 0), 1), ((75, 0.0, 50, 0.0, 12, 0.3, 0, 0, 0, 0), 1),
    ((2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), 0), ((1, 1.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), 0),
    ((4, 0.8, 3, 1.0, 4, 0.9, 0, 0, 0, 0), 0), ((9, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), 0),
    ((10, 0.1, 40, 0.0, 0, 0.0, 0, 0, 0, 0), 0), ((3, 0.0, 4, 0.5, 0, 0.0, 0, 0, 0, 0), 0),
    ((25, 0.9, 2, 1.0, 3, 1.0, 0, 0, 0, 0), 0), ((30, 0.8, 40, 0.0, 10, 0.5, 0, 0, 0, 0), 0),
    ((7, 1.0, 6, 1.0, 8, 1.0, 0, 0, 0, 0), 0), ((3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 1), 0),
    ((40, 0.0, 12, 0.0, 33, 0.0, 1, 0, 0, 0), 0), ((9, 0.0, 55, 0.0, 20, 0.0, 1, 0, 0, 0), 0),
    ((3, 1.0, 55, 0.0, 2, 1.0, 1, 0, 0, 0), 0), ((66, 0.0, 80, 0.0, 70, 0.0, 1, 0, 0, 0), 0),
)


class Node(NamedTuple):
    """Go to ``low`` if the feature is at most ``cut``, else to ``high``; leaves have feature -1 and a verdict."""

    feature: int
    cut: float
    low: int
    high: int
    verdict: bool


def grow(rows: np.ndarray, truth: np.ndarray, depth: int = 8) -> list[Node]:
    """Grow a decision tree by Gini impurity; among equal splits the first feature and lowest cut."""
    nodes: list[Node] = []

    def add(chosen: np.ndarray, left: int) -> int:
        place = len(nodes)
        labels = truth[chosen]
        nodes.append(Node(-1, 0.0, -1, -1, bool(labels.mean() > 0.5)))
        best = (labels.mean() * (1 - labels.mean()) * len(labels) - 1e-9, -1, 0.0)
        for feature in range(rows.shape[1]) if left else ():
            values = np.unique(rows[chosen, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                low = rows[chosen, feature] <= cut
                cost = sum(labels[s].mean() * (1 - labels[s].mean()) * s.sum() for s in (low, ~low))
                if cost < best[0]:
                    best = (cost, feature, float(cut))
        if best[1] >= 0:
            low = rows[chosen, best[1]] <= best[2]
            a, b = add(chosen[low], left - 1), add(chosen[~low], left - 1)
            nodes[place] = Node(best[1], best[2], a, b, nodes[place].verdict)
        return place

    add(np.arange(len(rows)), depth)
    return nodes


def train(labelled: Sequence = LABELLED) -> list[tuple]:
    """The tree for a labelled table, as plain tuples."""
    rows, truth = np.array([r for r, _ in labelled], dtype=float), np.array([y for _, y in labelled])
    return [tuple(n) for n in grow(rows, truth)]


def verdicts(tree: Sequence[tuple], rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), dtype=bool)
    waiting = [(0, np.arange(len(rows)))]
    while waiting:
        place, chosen = waiting.pop()
        feature, cut, low, high, verdict = tree[place]
        if feature < 0:
            out[chosen] = verdict
        elif len(chosen):
            down = rows[chosen, feature] <= cut
            waiting += [(low, chosen[down]), (high, chosen[~down])]
    return out


def main_text(page: str, tree: Sequence[tuple]) -> str:
    cut = blocks(page)
    return "\n".join(b.text for b, keep in zip(cut, verdicts(tree, table(cut)), strict=True) if keep)


def extract(
    pages: DataFrame, tree: Sequence[tuple] | None = None, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """The main text of every whole page, as (id_col, url_col, text, n_chars).

    Null, empty and textless pages have an empty text. Null ids and urls stay null; repeated rows are read each;
    other columns are not read; an empty table gives an empty one. A page is worked on alone, so memory is bounded by
    the largest page. Without a ``tree`` one is grown from ``LABELLED``.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train() if tree is None else list(tree))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py() or "", shared.value) for p in batch.column(2)]
            arrays = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], names=[id_col, url_col, "text", "n_chars"])

    chosen = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string"))
    kinds = [f.dataType.simpleString() for f in chosen.schema][:2]
    return chosen.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")
