"""Main text of web pages as the maximum-scoring run of words and tags.

A page is a sequence of text runs and tags. Each word adds to the score, each tag takes
from it; the weights are log-odds from labelled pages, those that mark their content
with an `article` or `main` element. One linear scan finds the contiguous region of the
largest sum. Elements that are never content (menus, adverts, forms, comments, ...) are
taken out of the region; their tags cost, their words count for nothing. An element that
only its class, id or role names so stays if it holds more than half of the words around it. Where most of
the region lies in one `article` element, it is set to that element's bounds, otherwise
to whole blocks.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronostar.llm.common import hash_sample, map_texts

#: Pages, about, drawn by a hash, among which the labelled ones give the weights.
SAMPLE_PAGES = 1000
#: Longer pages are not taken into that sample; they are extracted like all others.
SAMPLE_CHARS = 1 << 16
#: Least gain of a word and cost of a tag, so that short blocks beside the region join it.
LEAST_WORD, LEAST_TAG = 0.05, 0.001
PRIOR_TAG = 2.0

CONTENT = {"article", "main"}
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
NEVER = set(
    "head title nav menu footer aside form script style noscript template button select option textarea input "
    "iframe object canvas svg math dialog audio video search".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Parts of class and id names of elements that are not content.
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo cookie cookies consent notice "
    "notices alert popup modal sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments "
    "disqus respond share sharing social related newsletter subscribe subscription signup login widget".split()
)
#: Before such a part, a name tells of the page, not of the element (has-sidebar, no-comments).
WITH = {"has", "have", "no", "not", "with", "without", "show", "hide"}
#: Words in content elements, against others, where a marked element is weighed.
CONTENT_WORDS = 4
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comments; an unclosed one reaches the end
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe|svg|template)\b(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>"
    r"(?:.*?(?:</(?P=raw)\s*[^>]*>|\Z))"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)"
    r"|<(?P<odd>/?[a-z][^>]*)(?:>|\Z)",
    re.I | re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _is_marked(attributes: str) -> bool:
    for groups in _NAMES.findall(attributes):
        value = "".join(groups)
        parts = [p.lower() for p in _PART.findall(value)]
        if any(p in MARKS and before not in WITH for before, p in zip(["", *parts], parts)) or value.lower() in _ROLES:
            return True
    return False


def tokens(page: str) -> Iterable[tuple[str, str, str]]:
    """(kind, name, text): kind is `text`, `open`, `close` or `raw` (an element kept whole)."""
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        if m["raw"]:
            yield "raw", m["raw"].lower(), ""
        elif m["name"]:
            yield ("close" if m["close"] else "open"), m["name"].lower(), m["attributes"]
    if at < len(page):
        yield "text", "", page[at:]


@dataclass
class Weights:
    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)
    other: float = -PRIOR_TAG

    def tag(self, name: str) -> float:
        return self.tags.get(name, self.other)


@dataclass
class _Piece:
    block: int
    article: int  # number of the outermost article element, 0 outside
    words: str


_CELLS = {"td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_SCOPES = {"table", "td", "th", "caption", "ul", "ol", "menu", "dl", "select", *CONTENT}
_WALLS = {"td", "th", "caption", *CONTENT}
#: Elements whose end tag may be missing, with those whose start ends them.
_ENDED = {"li": ["li"], "dd": ["dd", "dt"], "dt": ["dd", "dt"], "option": ["option"], "td": ["td", "th"], "th": ["td", "th"]}
_ENDED |= {"tr": ["tr"], "tbody": ["tbody", "thead"], "tfoot": ["tbody", "thead"], "body": ["head"]}


def _ends(parts: list[tuple[str, str, str]]) -> dict[int, int]:
    """For the place of each start tag, the place where its element ends: end tags that may be missing are implied."""
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    heights: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of each name

    def innermost(names) -> int:
        return max((heights[n][-1] for n in names if heights.get(n)), default=-1)

    def close(names, walls, at):
        """End the innermost element of some names, and all within it, if no wall stands between."""
        height = innermost(names)
        if height > innermost(walls):
            while len(stack) > height:
                name, start = stack.pop()
                heights[name].pop()
                ends[start] = at

    for at, (kind, name, _) in enumerate(parts):
        if kind == "open" and name not in VOID:
            if name in BLOCKS and name not in _CELLS:
                close(["p"], _SCOPES, at)
            if name in _ENDED:
                close(_ENDED[name], {"table"} if name in _CELLS else _SCOPES, at)
            heights[name].append(len(stack))
            stack.append((name, at))
        elif kind == "close":
            close([name], {"table"} if name in _CELLS else () if name in CONTENT or name == "table" else _WALLS, at)
    ends.update((start, len(parts)) for _, start in stack)
    return ends


def _never(name: str, content: int) -> bool:
    return name in NEVER or (name == "header" and not content)


def _taken_out(parts: list[tuple[str, str, str]], ends: dict[int, int]) -> set[int]:
    """Places of marked elements that are not content: those with no more words than what is around them, in the
    content element or page, outside of other marked elements."""
    held = [0]  # words up to each place
    direct: Counter[int] = Counter()  # words whose innermost marked element this is, or, in a content element, that have none
    path: list[tuple[int, bool]] = [(-1, False)]  # open elements: place, is marked
    above: dict[int, tuple[int, bool]] = {}  # what each marked element stands in
    skip = content = 0

    def leave():
        nonlocal content
        place, marked = path.pop()
        content -= not marked
        if not marked:
            direct[path[-1][0]] += direct[place]

    for at, (kind, name, text) in enumerate(parts):
        while len(path) > 1 and ends[path[-1][0]] <= at:
            leave()
        n = 0
        if name in CONTENT:
            skip = at
        if kind == "text" and at >= skip:
            n = len(text.split()) * (CONTENT_WORDS if content else 1)
            direct[path[-1][0]] += n
        elif kind == "open" and at in ends and at >= skip:
            if name in CONTENT:
                path.append((at, False))
                content += 1
            elif _never(name, content):
                skip = ends[at]
            elif name not in ("html", "body") and _is_marked(text):
                above[at] = path[-1]
                path.append((at, True))
        held.append(held[-1] + n)
    while len(path) > 1:
        leave()
    around: dict[int, int] = {}  # words of the marked elements around, and of what they stand in
    for at, (place, marked) in above.items():
        around[at] = direct[place] + (around[place] if marked else 0)
    return {at for at in above if held[ends[at]] - held[at] <= around[at]}


def _read(page: str):
    """Scored parts of a page in order: (tag name or None, piece or None, number of words, in content)."""
    skip = block = content = 0
    article, opened = 0, 0
    parts = list(tokens(page))
    ends = _ends(parts)
    out = _taken_out(parts, ends)
    for at, (kind, name, text) in enumerate(parts):
        if kind == "text":
            if at >= skip:
                plain = html.unescape(text) if "&" in text else text
                n = len(plain.split())
                yield None, _Piece(block, article if opened else 0, plain), n, content > 0
            continue
        if name in BLOCKS:
            block += 1
        elif name == "br" and at >= skip:
            yield None, _Piece(block, article if opened else 0, " "), 0, content > 0
        if name == "article":
            article += kind == "open" and not opened
            opened = max(0, opened + (1 if kind == "open" else -1))
        if name in CONTENT:
            content = max(0, content + (1 if kind == "open" else -1 if kind == "close" else 0))
            skip = at  # an element that was never closed ends here at the latest
        if kind == "open" and at >= skip and at in ends and name not in CONTENT and (_never(name, content) or at in out):
            skip = ends[at]
        yield name, None, 0, content > 0


def learn(pages: Iterable[str]) -> Weights:
    """Log-odds of words and tags, inside against outside the content element of labelled pages."""
    inside, outside = Counter(), Counter()
    for page in pages:
        for name, _, n, content in _read(page):
            (inside if content else outside)[name] += n if name is None else 1
    n_in, n_out = sum(inside.values()), sum(outside.values())
    if not n_in or not n_out:
        free = {t: -LEAST_TAG for t in ("p", "b", "i", "em", "strong", "a", "span", "br", "h1", "h2", "h3", "h4")}
        return Weights(tags=free)

    def odds(name):
        return math.log((inside[name] + 1) / (n_in + 1)) - math.log((outside[name] + 1) / (n_out + 1))

    tags = {name: min(-LEAST_TAG, odds(name)) for name in {*inside, *outside} if name is not None}
    return Weights(max(LEAST_WORD, odds(None)), tags)


def main_text(page: str, weights: Weights) -> str:
    """The blocks of the best region, a line each."""
    total = best = 0.0
    start = 0
    region = (0, 0)
    parts = list(_read(page))
    for i, (name, piece, n, _) in enumerate(parts):
        if total <= 0:
            total, start = 0.0, i
        total += weights.tag(name) if piece is None else n * weights.word
        if total > best:
            best, region = total, (start, i + 1)
    share: Counter[int] = Counter()
    chosen = set()
    for _, piece, n, _ in parts[slice(*region)]:
        if piece is not None and n:
            share[piece.article] += n
            chosen.add(piece.block)
    article, most = share.most_common(1)[0] if share else (0, 0)
    if article and 2 * most > sum(share.values()):
        chosen = {piece.block for _, piece, _, _ in parts if piece is not None and piece.article == article}
    blocks: dict[int, list[str]] = {}
    for _, piece, _, _ in parts:
        if piece is not None and piece.block in chosen:
            blocks.setdefault(piece.block, []).append(piece.words)
    lines = (" ".join("".join(x).split()) for x in blocks.values())
    return "\n".join(x for x in lines if x)


def fit(pages: DataFrame, key: str = "page_id", text: str = "html") -> Weights:
    """Weights from the pages of a bounded sample that have a content element."""
    drawn = hash_sample(pages, [key, text], SAMPLE_PAGES, pages.count())
    labelled = F.col(text).rlike(r"(?i)<(article|main)[\s>]") & (F.length(text) <= SAMPLE_CHARS)
    rows = drawn.select(F.when(labelled, F.col(text)).alias("page")).filter("page is not null").collect()
    rows.sort()
    return learn(r[0] for r in rows)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """key, url, text and n_chars of every row.

    Null, empty and wordless pages have an empty text; repeated rows and null keys get rows
    of their own; an empty table gives none; other columns are not read. Without labelled
    pages, fixed weights hold.
    """
    weights = fit(pages, key, text)

    def work():
        def step(keys, htmls):
            texts = [main_text(h, weights) for h in htmls]
            return {
                "key": [k["key"] for k in keys],
                "url": [k["url"] for k in keys],
                "text": texts,
                "n_chars": list(map(len, texts)),
            }

        return step

    kind = pages.schema[key].dataType.simpleString()
    packed = pages.select(F.struct(F.col(key).alias("key"), F.col(url).alias("url")).alias("key"), F.col(text).alias("text"))
    out = map_texts(packed, "key", "text", work, f"key {kind}, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
