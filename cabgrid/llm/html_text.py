"""Main text of web pages by consensus of each host's pages.

1. Every page is read into blocks of text, each with the path of the containers
   around it: tags with their classes, digits left out. Navigation, headers and
   footers of the page, sidebars, forms, scripts, notices, adverts and comments
   are left out: by tag, role or hiding anywhere; by class or id as follows. A
   container outside article and main goes if any word of a name is marked; inside,
   if all words of a name are, or one is and at least half of its text is links. A
   paragraph, heading or row goes if a whole name is marked, inside article and main, like
   an inline element anywhere, only if the name says advert. A class or id never leaves out
   html, body, main or an article that is in no other, nor a container with most
   of the text outside links.
2. A page votes for one path: the deepest container that still holds most of
   the text outside links, or from there up the nearest article or main, or the main around
   that, if text stands directly between them or a first heading is there only; else the
   uppermost container below body with text of its own beside it. Votes are summed per host and path in Spark.
3. The paths with the most votes of a host, those with at least a quarter of the
   winner's, extract every page of that host again; containers around a page's own
   winning path aren't used. A page without any of them falls back to its own vote, as does one whose
   own vote is an article or main while they hold less than half of its text.

Containers are nodes that know the node around them and text is summed upward once, so work is
linear in the page, however deep it is. Long paths are known by a digest.

Votes are summed before they move. Each page meets the winners among its own
containers as rows, so no list outgrows a page. The pages and the paths of a host
are dealt over ``SPREAD`` salts, to which winners and most votes are copied.

Cases: a null html is an empty page with an empty text; a page whose url has no
host votes with all of its kind; ties go to more text, then to the first
path in order; a page with text in links only weighs that; stray closing tags are passed over, unclosed
elements end with the container around them or where HTML says that the next element ends them; a tag
that the end of the page cuts off is no text; repeated pages get a
row each; an empty table gives no rows; columns other than page_id, url and html
are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabgrid.llm.common import parts, rows_of, stored

SPREAD = 16
#: Share of a page's text that the chosen container must hold, and share of the winner's votes for a further path.
MOST, ALSO = 0.8, 0.25
#: Characters of a path beyond which a digest stands for it.
LONGEST = 240
VOTES = "key string, host string, salt int, path string, chars long, paths array<string>"
PAGES = "page_id long, url string, text string, n_chars long"

CONTAINERS = frozenset("html body main article section div td table tbody tr ul ol dl blockquote center fieldset figure".split())
#: Elements that hold no part of an article.
OUTSIDE = frozenset(
    "nav footer aside form script style noscript template button select textarea iframe svg head title dialog menu object"
    " canvas audio video map option label input".split()
)
BLOCKS = CONTAINERS | OUTSIDE | frozenset(
    "p h1 h2 h3 h4 h5 h6 header li dt dd pre address hr caption th figcaption details summary hgroup thead tfoot".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in a class or id that mark a part outside the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu"
    " menus breadcrumb breadcrumbs sidebar aside related recommended recommendations share sharing social comment comments"
    " disqus respond reply replies footer masthead topbar toolbar widget widgets pagination pager tags copyright".split()
)
#: Marks that hold for an inline element or a paragraph of the article too.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsored".split())
#: Words beside a mark that only say how a part is laid out.
LAYOUT = frozenset(
    "area bar block bottom box button buttons container content form icons inner item items left link links list outer panel"
    " post posts right section top wrap wrapper".split()
)
#: Elements that their class or id never marks: they hold the page or the article.
WHOLE = frozenset("html body main article".split())
ARTICLES = frozenset(("article", "main"))
#: Elements that end where one of the named elements begins, and closing tags that end nothing beyond the element around them.
ENDED = {h: HEADINGS for h in HEADINGS} | {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "tr": frozenset({"td", "th", "tr"}),
}
SMALL = frozenset(ENDED) - {"td", "tr"} | {"p", "pre", "address", "caption", "figcaption", "summary"}
# Quotes count only after an equals sign, and what a repeat has taken it never gives back: a page is read in linear time.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|href)(?![^\s=/>])\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
SPLIT = re.compile(r"[^a-z]+")
SPACE = re.compile(r"\s+")
#: What class and id say: nothing, a marked word, a name of marked words, a whole marked name, a name for adverts.
NOTHING, WORD, NAME, EXACT, ADVERT = range(5)


class Path:
    """The containers around a block, by tag and class. Equal paths of a page are one object."""

    __slots__ = ("above", "tag", "name", "depth")

    def __init__(self, above: Path | None = None, tag: str = "", label: str = ""):
        name = f"{above.name}/{label}" if above else ""
        if len(name) > LONGEST:
            name = "~" + hashlib.blake2b(name.encode(), digest_size=16).hexdigest()
        self.above, self.tag, self.name = above, tag, name
        self.depth = above.depth + 1 if above else 0

    def upward(self) -> Iterator[Path]:
        at: Path | None = self
        while at is not None:
            yield at
            at = at.above


class Block(NamedTuple):
    path: Path
    text: str
    #: Characters outside links.
    chars: int
    #: Whether it is a heading of the first order.
    first: bool


class Element(NamedTuple):
    """What an open element goes back to when it ends."""

    tag: str
    path: Path
    outside: bool
    container: int
    article: bool
    heading: bool


@lru_cache(maxsize=4096)
def described(tag: str, attributes: str) -> tuple[str, bool, int]:
    """A container's place in a path, whether a role or hiding tells that it's outside the article, and what class and id say."""
    if not attributes or attributes.isspace():
        return tag, False, NOTHING
    classes, outside, marked = "", False, NOTHING
    for name, value in NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "class":
            classes = ".".join(sorted(x for x in (re.sub(r"\d+", "", c) for c in value.split()) if x))
        if name in ("class", "id"):
            marked = max([marked, *map(said, value.split())])
        elif name == "role":
            outside = outside or value in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert")
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            outside = True
    return (f"{tag}.{classes}" if classes else tag), outside, marked


def said(name: str) -> int:
    """What one name of a class or id says."""
    if name in ADVERTS:
        return ADVERT
    if name in MARKS:
        return EXACT
    words = [w for w in SPLIT.split(name) if w]
    if MARKS.isdisjoint(words):
        return NOTHING
    return NAME if all(w in MARKS or w in LAYOUT for w in words) else WORD


def blocks_of(page: str) -> list[Block]:
    """The blocks of the page in page order, without those outside the article."""
    found: list[tuple[Block, int]] = []
    known: dict[tuple[Path, str], Path] = {}
    stack: list[Element] = []
    opened: dict[str, list[int]] = {}  # places in the stack by tag
    around: list[int] = []  # places in the stack of what a small element's end can't leave
    # Containers with a marking class or id stay until all text has been seen: the one around each, what it says.
    marks: list[tuple[int, int]] = [(0, NOTHING)]
    pieces: list[str] = []
    linked = in_link = 0
    path, outside, container, article, heading = Path(), False, 0, False, False

    def flush() -> None:
        nonlocal linked
        if pieces and not outside:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                found.append((Block(path, text, max(0, len(text) - linked), heading), container))
        pieces.clear()
        linked = 0

    def push(tag: str) -> None:
        if tag in BLOCKS and tag not in SMALL:
            around.append(len(stack))
        opened.setdefault(tag, []).append(len(stack))
        stack.append(Element(tag, path, outside, container, article, heading))

    def end_from(place: int) -> None:
        nonlocal path, outside, container, article, heading
        _, path, outside, container, article, heading = stack[place]
        while len(stack) > place:
            opened[stack.pop().tag].pop()
        while around and around[-1] >= place:
            around.pop()

    def end_before(tag: str) -> None:
        """Ends the elements that the beginning of this one ends, inline ones in them too."""
        if stack and stack[-1].tag == "head":
            end_from(len(stack) - 1)
        while True:
            kin = [opened[t][-1] for t in ("p", *ENDED.get(tag, ())) if opened.get(t)]
            last = max(kin, default=-1)
            inner = around[-1] if around else -1
            # td and tr are containers themselves, so they may be what is around.
            if last < 0 or last < inner:
                return
            end_from(last)

    at, end = 0, len(page)
    while at < end:
        tag = TAG.search(page, at)
        stop = tag.start() if tag else end
        if stop > at and not outside:
            pieces.append(page[at:stop])
            if in_link:
                linked += stop - at
        if tag is None:
            break
        at = tag.end()
        if tag[1] is not None and not outside:
            pieces.append(html.escape(tag[1], quote=False))
        if tag[3] is None:
            continue
        name = tag[3].lower()
        closing = bool(tag[2])
        if name == "a":
            in_link = 0 if closing else int("href" in tag[4].lower())
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name not in BLOCKS:
            if closing:
                if stack and stack[-1].tag == name:
                    end_from(len(stack) - 1)
            elif name not in VOID:
                if outside:
                    # Elements of the same tag inside one that's left out are counted.
                    if stack and stack[-1].tag == name:
                        push(name)
                elif tag[4]:
                    _, off, marked = described(name, tag[4])
                    if off or marked == ADVERT:
                        push(name)
                        outside = True
            continue
        flush()
        if closing:
            places = opened.get(name)
            if places and not (name in SMALL and around and around[-1] > places[-1]):
                end_from(places[-1])
            continue
        if name in RAW:
            if not (name == "svg" and tag[4].endswith("/")):
                close = raw_end(name).search(page, at)
                at = close.end() if close else end
            continue
        end_before(name)
        if name in VOID:
            continue
        label, off, marked = described(name, tag[4])
        push(name)
        heading = heading or name == "h1"
        if name in CONTAINERS:
            if marked and (name not in WHOLE or (name == "article" and article)):
                weak = article and marked == WORD
                marks.append((container, WORD if weak else EXACT))
                container = len(marks) - 1
            key = (path, label)
            path = known[key] = known.get(key) or Path(path, name, label)
            outside = outside or off
            article = article or name in ARTICLES
        else:
            least = ADVERT if article else EXACT
            outside = outside or off or name in OUTSIDE or marked >= least or (name == "header" and not article)
    flush()
    return unmarked(found, marks)


@lru_cache(maxsize=None)
def raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I)


def unmarked(found: list[tuple[Block, int]], marks: list[tuple[int, int]]) -> list[Block]:
    """The blocks outside marked containers; see the text of the module for what a mark needs."""
    total = sum(block.chars for block, _ in found)
    chars, size = [0] * len(marks), [0] * len(marks)
    for block, mark in found:
        chars[mark] += block.chars
        size[mark] += len(block.text)
    for mark in range(len(marks) - 1, 0, -1):
        chars[marks[mark][0]] += chars[mark]
        size[marks[mark][0]] += size[mark]
    out = [False] * len(marks)
    for mark in range(1, len(marks)):
        within, says = marks[mark]
        goes = (not total or chars[mark] < MOST * total) and (says != WORD or 2 * chars[mark] <= size[mark])
        out[mark] = out[within] or goes
    return [block for block, mark in found if not out[mark]]


def paths_of(blocks: Iterable[Block]) -> list[Path]:
    """All containers around the blocks, from the deepest to the page."""
    seen: set[Path] = set()
    for block in blocks:
        for path in block.path.upward():
            if path in seen:
                break
            seen.add(path)
    return sorted(seen, key=lambda p: (-p.depth, p.name))


def weights(blocks: list[Block]) -> list[int]:
    """Characters outside links, or all characters on a page that has only links."""
    return [b.chars for b in blocks] if any(b.chars for b in blocks) else [len(b.text) for b in blocks]


def own_path(blocks: list[Block]) -> tuple[Path, int]:
    """The path of the whole article around the deepest container with most of the page's text, and its text outside links."""
    held = dict.fromkeys(paths_of(blocks), 0)
    if not held:
        return Path(), 0
    for block, weight in zip(blocks, weights(blocks)):
        held[block.path] += weight
    for path in held:
        if path.above is not None:
            held[path.above] += held[path]
    total = max(held.values())
    path = whole(next(p for p, weight in held.items() if weight >= MOST * total), blocks)
    return path, held[path] if any(b.chars for b in blocks) else 0


def whole(path: Path, blocks: list[Block]) -> Path:
    """The nearest article or main from ``path`` up, or the one around it; without one, the uppermost container below body that text stands in directly."""
    direct = {b.path for b in blocks if b.chars}
    articles = [p for p in path.upward() if p.tag in ARTICLES]
    if articles:
        nearest, outer = articles[0], articles[-1]
        between = [p for p in nearest.upward() if p.depth >= outer.depth][1:]
        held = beneath(blocks, {nearest.name})
        beside = [b for b, inside in zip(blocks, beneath(blocks, {outer.name})) if inside]
        headed = any(b.first for b, inside in zip(blocks, held) if inside)
        if any(p in direct for p in between) or (not headed and any(b.first for b in beside)):
            return outer
        return nearest
    own = [p for p in path.upward() if p.above is not None and p.tag not in ("html", "body") and p in direct]
    return own[-1] if own else path


def beneath(blocks: list[Block], names: set[str]) -> list[bool]:
    """Whether each block is inside one of the named paths."""
    known: dict[Path, bool] = {}
    for block in blocks:
        chain = []
        inside = False
        for path in block.path.upward():
            if path in known:
                inside = known[path]
                break
            chain.append(path)
        for path in reversed(chain):
            inside = known[path] = inside or path.name in names
    return [known[block.path] for block in blocks]


def vote(blocks: list[Block]) -> tuple[str, int]:
    """The path that a page votes for, and its text."""
    path, chars = own_path(blocks)
    return path.name, chars


def extracted(page: str, paths: list[str]) -> str:
    """Text of the page's blocks inside the given paths, or inside its own vote; see the text of the module."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    own, _ = own_path(blocks)
    names = set(paths)
    if own.name in names:
        names -= {p.name for p in own.upward()} - {own.name}
    chosen = beneath(blocks, names)
    weighed = weights(blocks)
    if 2 * sum(w for w, inside in zip(weighed, chosen) if inside) < sum(weighed) and own.tag in ARTICLES or not any(chosen):
        chosen = beneath(blocks, {own.name})
    return "\n".join(block.text for block, inside in zip(blocks, chosen) if inside)


def host_of(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))


def page_paths(pages: DataFrame) -> DataFrame:
    """Per page, by its ``key``, those of its containers that win the vote of its host."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, column="html"):
            rows = []
            for key, host, salt, page in zip(*(c.to_pylist() for c in batch.columns)):
                blocks = blocks_of(page)
                path, chars = vote(blocks)
                # The page itself holds all pages' text, so it only counts where it's the vote.
                names = {p.name for p in paths_of(blocks) if p.name or not path}
                rows.append((key, host, salt, path, chars, sorted(names)))
            yield rows_of(VOTES, rows)

    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt")
    ballots = stored(pages.select("key", "host", "salt", "html").mapInArrow(emit, VOTES), "page-votes")
    sums = ballots.filter("chars > 0").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    most = sums.groupBy("host").agg(F.max("votes").alias("most")).select("host", "most", salts)
    dealt = sums.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SPREAD)).cast("int"))
    winners = dealt.join(most, ["host", "salt"]).filter(F.col("votes") >= ALSO * F.col("most")).select("host", "path", salts)
    own = ballots.select("key", "host", "salt", F.explode("paths").alias("path"))
    return own.join(winners, ["host", "path", "salt"]).groupBy("key").agg(F.sort_array(F.collect_set("path")).alias("paths"))


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page with its main text and the number of its characters."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of("url").alias("host"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("int"))
    fields = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("page_id", "url", "html"))
    rows = rows.withColumn("key", F.md5(F.concat_ws("\x00", *fields)))
    chosen = page_paths(rows)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, column="html"):
            out = []
            for page_id, url, page, paths in zip(*(c.to_pylist() for c in batch.columns)):
                text = extracted(page, paths or [])
                out.append((page_id, url, text, len(text)))
            yield rows_of(PAGES, out)

    joined = rows.join(chosen, "key", "left").select("page_id", "url", "html", "paths")
    return joined.mapInArrow(emit, PAGES)
