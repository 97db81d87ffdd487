"""HTML main-text extraction by line-block distribution.

A page becomes lines, one per block of text, with the markup stripped and each
line's text length known.  Elements that never hold article text (scripts,
menus, forms, notices, adverts, reader comments ...) have no lines, unless they
stand around the article.  Lengths outside links are summed over sliding windows
of lines: the text starts at the first surge that is not mostly links and ends
where the sum dives to nothing after the last one, and every line between the
two is kept.  A skipped element leaves a run of empty lines, which keeps
what stands before the text apart from it but does not end the text.  An article
that the page marks (the heaviest, where it marks several) is a prior: the windows
run over its lines alone, with a surge of one character, unless one stretch of
text outside it is many times longer.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, spread

#: Lines of a window; a skipped element leaves as many empty lines.
LINES = 3
#: Without a marked article: a region starts where a window holds this many
#: characters outside links, and counts if this share of its characters are.
SURGE, SHARE = 40, 0.5
#: A marked article stands against one stretch of text outside it of up to this many times its length.
PRIOR = 8
_RIGHTS = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.IGNORECASE)

# attributes as HTML reads them: a quote opens a value only right behind the equals sign
_ATTRS = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+|[^>=]++)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|math|iframe|object|textarea|select|button|canvas|audio|video|title)\b"
    + _ATTRS + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>" + _ATTRS + r")>"
    r"|<[!?/][^>]*>", re.DOTALL | re.IGNORECASE)
_ATTR = re.compile(r"""([^\s=>"'/]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?""")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr "
                    "output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("nav footer aside form menu dialog fieldset".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form "
                   "toolbar tablist".split())
#: Words in a class or id that mark other than article text.
_MARKS = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side footer masthead topbar "
                   "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
                   "cookie cookies consent gdpr notice notices notification alert popup modal overlay paywall "
                   "comment comments commentlist discussion replies disqus respond related recommended share sharing "
                   "social newsletter subscribe signup login search pagination pager widget toolbar skip copyright "
                   "disclaimer hidden".split())
#: Whole classes that mark other than article text even inside a marked article.
_MARKS_INSIDE = frozenset("ad ads adv advert adverts advertisement adsense ad-container ad-slot ad-banner "
                          "sponsored sidebar navbar breadcrumb breadcrumbs share-buttons social-share sharedaddy "
                          "cookie-notice cookie-banner newsletter-signup related-posts related-articles "
                          "comments comment-list commentlist disqus pagination skip-link".split())
_ARTICLE_MARKS = frozenset("article-body article-content post-content post-body entry-content main-content "
                           "story-body".split())
#: Elements that hold reader comments when a word of their class or id says so.
_CONTAINERS = frozenset("div section ol ul li article aside details dl dd table td main".split())
_COMMENTS = frozenset("comment comments commentlist commenting disqus".split())
_SPLIT = re.compile(r"[^a-z0-9]+")


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v[1:-1] if v[:1] in "\"'" else v) for k, v in _ATTR.findall(raw)}


def _words(attrs: dict[str, str], with_id: bool = True) -> set[str]:
    return set(_SPLIT.split(f"{attrs.get('class', '')} {attrs.get('id', '') if with_id else ''}".lower()))


def _comments(name: str, attrs: dict[str, str]) -> bool:
    return name in _CONTAINERS and bool(attrs) and any(
        w in _COMMENTS or w.endswith("comments") for w in _words(attrs))


def _boilerplate(name: str, attrs: dict[str, str], in_article: bool) -> bool:
    if name in _SKIP or (name == "header" and not in_article):
        return True
    if not attrs or name in ("html", "body"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in _ROLES:
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower() or _comments(name, attrs):
        return True
    if name in ("article", "main"):
        return False
    if in_article:
        return not _MARKS_INSIDE.isdisjoint(attrs.get("class", "").lower().split())
    words = _words(attrs, name not in _HEADINGS)  # a heading's id repeats its text
    return not words.isdisjoint(_MARKS) or "header" in words


def _is_article(name: str, attrs: dict[str, str]) -> bool:
    if name in ("article", "main") or attrs.get("role", "").lower() in ("main", "article"):
        return True
    return not _ARTICLE_MARKS.isdisjoint(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split())


class Outline:
    """What a first look at the tags tells: extents and the text each element holds outside links.

    ``article`` is the marked article of the page, the heaviest one that is no reader comment and, of
    two with the same text, the outer one (None without any).  ``kept`` are the elements that are
    not skipped whatever their name or class: those around the article, and on a page without
    one those that hold most of its text."""

    def __init__(self, page: str, tokens: list[re.Match]):
        self.unclosed: set[int] = set()
        opened: dict[str, list[tuple[int, int, dict[str, str]]]] = {}
        found: list[tuple[int, int, int, str, dict[str, str]]] = []  # (start, end, weight, name, attributes)
        weight = at = links = 0
        last_article = -1
        headings = []
        for m in tokens:
            if not links:
                weight += len(page[at:m.start()].strip())
            at = m.end()
            name = (m.group("name") or "").lower()
            if name == "a":
                links = 0 if m.group("close") else 1
            if not name or name in _VOID or name in _INLINE and not m.group("attrs"):
                continue
            if m.group("close"):
                if opened.get(name):
                    start, before, attrs = opened[name].pop()
                    found.append((start, m.start(), weight - before, name, attrs))
                continue
            if m.group("attrs").rstrip().endswith("/"):
                continue
            attrs = _attributes(m.group("attrs")) if m.group("attrs").strip() else {}
            opened.setdefault(name, []).append((m.start(), weight, attrs))
            if name == "h1":
                headings.append(m.start())
            if name in ("article", "main"):
                last_article = m.start()
            links = 0 if name not in _INLINE else links
        if not links:
            weight += len(page[at:].strip())
        for name, rest in opened.items():
            for start, before, attrs in rest:
                found.append((start, len(page), weight - before, name, attrs))
                # a footer counts as closed by the end of the page unless an article or main follows
                if name != "footer" or start < last_article:
                    self.unclosed.add(start)
        found.sort(key=lambda e: (e[0], -e[1]))
        closed_at, marked = -1, []  # where the reader comments last met end
        for start, end, own, name, attrs in found:
            if start < closed_at:
                continue
            if _comments(name, attrs) and not any(start < h < end for h in headings):
                closed_at = end
            elif _is_article(name, attrs):
                marked.append((own, start, end, name, attrs))
        self.article = max(marked, key=lambda e: (e[0], -e[1]))[1] if marked else None
        #: of several articles in one main element, all but the heaviest
        self.others: set[int] = set()
        if marked:
            _, start, end, name, _ = next(e for e in marked if e[1] == self.article)
            if name == "main":
                inner = [e for e in marked if start < e[1] < end and e[3] == "article"]
                heaviest = max(inner, key=lambda e: (e[0], -e[1]), default=None)
                self.others = {e[1] for e in inner if not heaviest[1] <= e[1] < heaviest[2]}
        if self.article is not None:
            self.kept = {start for start, end, _, _, _ in found if start <= self.article < end}
        else:
            self.kept = {start for start, _, own, name, attrs in found
                         if 2 * own > weight and name not in ("nav", "footer", "aside", "menu", "dialog")
                         and not _comments(name, attrs)}


def lines_of(page: str) -> Iterator[tuple[str, int, bool]]:
    """(text, characters outside links, inside a marked article) per line."""
    text: list[str] = []
    link: list[bool] = []
    stack: list[tuple[str, bool, bool]] = []  # (name, starts a skip, starts an article)
    skip = article = links = 0
    at = 0

    def line():
        whole = html.unescape("".join(text))
        plain = html.unescape("".join(t for t, a in zip(text, link, strict=True) if not a))
        text.clear()
        link.clear()
        whole = " ".join(whole.split())
        if whole:
            yield whole, len(" ".join(plain.split())), article > 0

    gap = ("", 0, False)
    tokens = list(_TOKEN.finditer(page))
    outline = Outline(page, tokens)
    for m in tokens:
        if m.start() > at and not skip:
            text.append(page[at:m.start()])
            link.append(links > 0)
        at = m.end()
        name = (m.group("name") or "").lower()
        if not name:
            continue  # a comment or an element whose content is no text
        if name == "br":
            if not skip:
                text.append(" ")
                link.append(links > 0)
            continue
        if name == "a":
            links = 0 if m.group("close") else 1
            continue
        if name in _INLINE and not (m.group("attrs") or skip) or name in _VOID and name != "hr":
            continue
        if m.group("close"):
            if not any(s[0] == name for s in reversed(stack)):
                if name not in _INLINE and not skip:
                    yield from line()
                continue
            if not skip and name not in _INLINE:
                yield from line()
            while stack:
                open_name, skips, marks = stack.pop()
                if skips:
                    skip -= 1
                    if not skip:
                        for _ in range(LINES):
                            yield gap
                if marks:
                    if not skip:
                        yield from line()
                    article -= 1
                    for _ in range(LINES):
                        yield gap
                if open_name == name:
                    break
            continue
        attrs = _attributes(m.group("attrs")) if m.group("attrs").strip() else {}
        # one that nothing closes would skip the rest of the page
        skips = m.start() in outline.others or (
            _boilerplate(name, attrs, article > 0) and m.start() not in outline.unclosed and m.start() not in outline.kept)
        marks = not skip and m.start() == outline.article
        if not skip and (name not in _INLINE or skips):
            yield from line()
        if name == "p" and stack and stack[-1][0] == "p" and not stack[-1][1]:
            stack.pop()  # a paragraph ends where the next begins
        if name in ("hr",) or m.group("attrs").rstrip().endswith("/"):
            continue
        if name in _INLINE and not skips and not skip:
            continue
        stack.append((name, skips, marks))
        skip += skips
        article += marks
        links = 0 if name not in _INLINE else links
    if at < len(page) and not skip:
        text.append(page[at:])
        link.append(links > 0)
    yield from line()


def regions(lengths: list[int], surge: int) -> Iterator[tuple[int, int]]:
    """[first line, end line) from each surge of the window sums to the dive after it."""
    n, i = len(lengths), 0
    window = sum(lengths[:LINES])
    sums = []
    for k in range(n):
        sums.append(window)
        window += (lengths[k + LINES] if k + LINES < n else 0) - lengths[k]
    while i < n:
        if lengths[i] and sums[i] >= surge:
            end = i
            while end < n and sums[end]:  # the dive: a window without text
                end += 1
            yield i, end
            i = end
        i += 1


def main_text(page: str) -> str:
    """The article of one page, one line per block (empty if it has none)."""
    if len(page) == 0:
        return ""
    lines = list(lines_of(page))
    # a marked article is where the text is looked for, unless a longer one stands outside it
    inside = sum(len(text) for text, _, marked in lines if marked)
    if inside and PRIOR * inside >= max((sum(plain for _, plain, _ in lines[a:b]) for a, b in regions(
            [0 if marked else plain for _, plain, marked in lines], SURGE)), default=0):
        rest = [line for line in lines if line[2] and line[0]]
        found = list(regions([len(text) for text, _, _ in rest], 1))
        return "\n".join(text for text, _, _ in rest[found[0][0]:found[-1][1]])
    lengths = [plain for _, plain, _ in lines]
    surge = SURGE if any(regions(lengths, SURGE)) else 1

    def dense(part: list[tuple[str, int, bool]]) -> bool:
        return sum(plain for _, plain, _ in part) >= SHARE * sum(len(text) for text, _, _ in part)

    found = list(regions(lengths, surge))
    start = next((a for a, b in found if dense(lines[a:b])), found[0][0] if found else len(lines))
    rest = [line for line in lines[start:] if line[0]]  # without the gaps of skipped elements
    found = list(regions([plain for _, plain, _ in rest], surge))
    end = max((b for a, b in found if dense(rest[a:b])), default=found[-1][1] if found else 0)
    while end > 1 and _RIGHTS.search(rest[end - 1][0]):  # the owner's line at the foot
        end -= 1
    return "\n".join(text for text, _, _ in rest[:end])


def _extract(batches):
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def rows():
        for b in batches:
            for page_id, url, page in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield page_id, url, main_text(page)
    yield from batches_of(rows(), schema)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per input row: ``page_id``, ``url``, ``text``, ``n_chars`` (code
    points).  Null html counts as empty and gives the empty text, and so does a
    page without text; null ids and urls stay null; repeated rows are done
    each; other columns are not read; an empty table gives an empty result."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    out = spread(rows).mapInArrow(_extract, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
