"""Main text of web pages by container paths on which the pages of a host agree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import Scratch

# A quoted value ends at the next quote of its kind, whatever it holds. A scan for it stops at that quote, so no part of a
# page is scanned for more than a few tags.
_QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^<>]*>"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>[^<>\"']*+(?:{_QUOTED}[^<>\"']*+)*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^<>]*)>",
    re.S,
)
_BODY = re.compile(r"<body[\s>]", re.I)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is text for programs, up to the end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are never part of an article.
DROPPED = frozenset(
    "script style textarea title head nav header footer aside form button select option datalist input label fieldset legend noscript template iframe object "
    "embed applet svg math canvas audio video menu dialog noembed noframes xmp".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul caption".split()
)
#: Blocks that hold other blocks and can be the place of an article.
CONTAINER = frozenset("article body center div html main section td table tbody tr blockquote".split())
#: A start tag of the key ends an open element of the values, unless one of the walls lies between.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_WALLS = frozenset("ul ol dl table body html article section div main select".split())
_INLINE_END = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var".split())
#: Words of class, id or role that mark what is around an article.
AROUND = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar "
    "aside notice notices alert cookie cookies consent gdpr banner comment comments commentlist disqus respond replies reply share sharing social related recommended "
    "newsletter subscribe subscription signup popup modal overlay login search searchbox form widget pagination pager toolbar skip complementary contentinfo".split()
)
_GOOD = frozenset("article content post entry story main body text page".split())
_KEEP = frozenset("html body main article".split())
_TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote figcaption".split())
_CELLS = frozenset("td tr tbody".split())


@dataclass
class Page:
    """What a parse leaves: containers with parent and path, and text blocks in page order."""

    parent: list[int] = field(default_factory=list)
    path: list[str] = field(default_factory=list)
    step: list[tuple[str, list[str]]] = field(default_factory=list)  # tag and classes
    boost: list[float] = field(default_factory=list)
    blocks: list[tuple[str, int, int]] = field(default_factory=list)  # text, container, characters in links


def _around(tag: str, attrs: dict[str, str]) -> bool:
    for value in (attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", "")):
        for token in value.lower().split():
            parts = re.split(r"[-_:]+", token)
            # The first word of a longer name speaks for boxes only: a paragraph of class header-text is a text.
            if len(parts) > 1 and parts[0] in AROUND and tag in _TEXTS:
                continue
            if parts[0] in AROUND or parts[-1] in AROUND and parts[0] not in ("has", "no", "with", "without"):
                return True
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()


def parse(text: str) -> Page:
    """A page; where forms hold three quarters of its text or more, with what is in them besides their controls."""
    page = _parse(text, DROPPED)
    if "<form" not in text.lower():
        return page
    with_forms = _parse(text, DROPPED - {"form"})
    plain, all_plain = (sum(len(b) - links for b, _, links in p.blocks) for p in (page, with_forms))
    return with_forms if 4 * plain < all_plain else page


def _parse(text: str, never: frozenset[str]) -> Page:
    """Containers and text blocks of a page as browsers would nest them, as far as an article needs it."""
    page, stack, buffer, at, links = Page(), [], [], 0, 0
    # stack: (tag, container index, dropped, generalised path, in a link)
    top = ("", -1, False, "", False)

    def flush() -> None:
        nonlocal links
        if buffer:
            block = " ".join(html.unescape("".join(buffer)).split())
            if block and top[1] >= 0:
                page.blocks.append((block, top[1], min(links, len(block))))
            buffer.clear()
            links = 0

    def pop_to(i: int) -> None:
        nonlocal top
        if any(x[0] in BLOCK for x in stack[i:]):
            flush()
        del stack[i:]
        top = stack[-1] if stack else ("", -1, False, "", False)

    def take(s: str) -> None:
        nonlocal links
        if s and not top[2]:
            if top[1] < 0:
                if not s.strip():
                    return
                open_tag("body", {})
            buffer.append(s)
            if top[4]:
                links += len(s.strip())

    def open_tag(tag: str, attrs: dict[str, str]) -> None:
        nonlocal top
        dropped = top[2] or tag in never or tag not in _KEEP and _around(tag, attrs)
        if tag in BLOCK or dropped and not top[2]:
            flush()
        path, index = top[3], top[1]
        if tag in CONTAINER and not dropped:
            classes = sorted(set(re.sub(r"\d+", "#", attrs.get("class", "")).split()))
            path = f"{path}>{'.'.join([tag, *classes])}"
            names = set(re.split(r"[^a-z]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
            page.parent.append(index)
            page.path.append(path)
            page.step.append((tag, classes))
            page.boost.append(1.5 if tag in ("article", "main") else 1.25 if names & _GOOD else 1.0)
            index = len(page.path) - 1
        top = (tag, index, dropped, path, top[4] or tag == "a")
        stack.append(top)

    if not _BODY.search(text):
        open_tag("body", {})  # its tag can be left out
    for m in iter(lambda: _TAG.search(text, at), None):
        take(text[at : m.start()])
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            if m[0].startswith("<![CDATA["):
                take(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = name.lower()
        if m["end"] or m["end2"]:
            if tag in ("p",) and not any(x[0] == "p" for x in stack):
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if tag in _INLINE_END and stack[i][0] in BLOCK:
                    break
            continue
        if tag in VOID:
            take(" ") if tag in ("br", "wbr", "img") else flush() if tag == "hr" else None
            continue
        if tag in ("td", "th"):
            take(" ")
        shut = CLOSES.get(tag, ()) + (("p",) if tag in BLOCK else ())
        for i in range(len(stack) - 1, -1, -1) if shut else ():
            if stack[i][0] in shut:
                pop_to(i)
                if tag not in CLOSES:
                    break
            elif stack[i][0] in _WALLS:
                break
        raw = m["attrs"] or m["attrs2"] or ""
        attrs = {k.lower(): html.unescape(a or b or c) for k, a, b, c in _ATTR.findall(raw)} if raw.strip(" /\n\t\r") else {}
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            continue
        open_tag(tag, attrs)
        if raw.endswith("/") and tag not in BLOCK and tag not in _INLINE_END:
            pop_to(len(stack) - 1)
    take(text[at:])
    flush()
    return page


def without_rare(page: Page, rare: set[str]) -> Page:
    """The page with the classes ``rare`` left out of its paths, but where that would make two of its paths one."""
    if not rare:
        return page
    short: list[str] = []
    for (tag, classes), parent in zip(page.step, page.parent, strict=True):
        short.append(f"{short[parent] if parent >= 0 else ''}>{'.'.join([tag, *[c for c in classes if c not in rare]])}")
    full: dict[str, set[str]] = {}
    for s, p in zip(short, page.path, strict=True):
        full.setdefault(s, set()).add(p)
    page.path = [s if len(full[s]) == 1 else p for s, p in zip(short, page.path, strict=True)]
    return page


def scores(page: Page) -> list[float]:
    """A container's characters outside links: all of its own blocks, half of its children's, and so on up."""
    out = [0.0] * len(page.path)
    for block, container, links in page.blocks:
        gain, i = float(len(block) - links), container
        while i >= 0 and gain >= 1:
            out[i] += gain
            gain, i = gain / 2, page.parent[i]
    return [s * b for s, b in zip(out, page.boost, strict=True)]


def main_text(page: Page, winners: list[str]) -> tuple[str, str]:
    """The text under the first winning path that holds at least half of the page's own best, and the path."""
    marks = scores(page)
    if not marks:
        return "", ""
    best = max(range(len(marks)), key=lambda i: (marks[i], -i))
    if marks[best] <= 0:  # nothing but links
        return "\n\n".join(b for b, _, _ in page.blocks), ""
    for path in winners:
        if sum(m for m, p in zip(marks, page.path, strict=True) if p == path) * 2 >= marks[best]:
            break
    else:
        path = page.path[best]
    roots, own = _whole_article(page, [i for i, p in enumerate(page.path) if p == path])
    inside = [False] * len(page.path)
    for i in range(len(page.path)):  # a parent comes before its children
        inside[i] = i in roots or page.parent[i] >= 0 and inside[page.parent[i]]
    return "\n\n".join(b for b, c, _ in page.blocks if inside[c] or c in own), path


def _whole_article(page: Page, places: list[int]) -> tuple[set[int], set[int]]:
    """The containers that hold the whole article around ``places``, and those of which only their own blocks do.

    A place grows to its parent while what the parent adds is text rather than links (at most half of its characters in
    links) and belongs to the article: the parent is an article by element or class, or has text of its own beside
    the place, or the place is a cell with less than half of its table. It ends at an ``article`` or ``main``. Of
    ``body`` and ``html`` only text of their own is taken, for what else they hold are boxes around the article.
    """
    n = len(page.path)
    held, links, own, own_links = [0] * n, [0] * n, [0] * n, [0] * n
    for block, container, linked in page.blocks:
        own[container] += len(block)
        own_links[container] += linked
    for i in range(n - 1, -1, -1):
        held[i] += own[i]
        links[i] += own_links[i]
        if page.parent[i] >= 0:
            held[page.parent[i]] += held[i]
            links[page.parent[i]] += links[i]
    tags = [tag for tag, _ in page.step]
    roots, alone = set(), set()
    for i in places:
        while tags[i] not in ("article", "main") and (p := page.parent[i]) >= 0:
            more, more_links = held[p] - held[i], links[p] - links[i]
            beside = own[p] > 0 and 2 * own_links[p] <= own[p]
            if tags[p] in ("body", "html"):
                if beside:
                    alone.add(p)
            elif more and 2 * more_links <= more and (page.boost[p] > 1 or beside or tags[i] in _CELLS and _small_cell(page, tags, held, i)):
                i = p
                continue
            elif not more:
                i = p
                continue
            break
        roots.add(i)
    return roots, alone


def _small_cell(page: Page, tags: list[str], held: list[int], i: int) -> bool:
    """Whether a part of a table holds less than half of it: a cell of data, not a column of a layout."""
    t = i
    while t >= 0 and tags[t] != "table":
        t = page.parent[t]
    return t >= 0 and 2 * held[i] < held[t]


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, tokens = [], []
        for row, text in enumerate(batch.column("html")):
            found = {c for _, classes in parse(text.as_py()).step for c in classes}
            at += [row] * len(found)
            tokens += sorted(found)
        keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("k1", "k2", "host")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(tokens, pa.string())], ["k1", "k2", "host", "token"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every path that can be a page's place, with its vote; 0 where it may only be chosen."""
    for batch in batches:
        at, paths, shares = [], [], []
        for row, (text, rare) in enumerate(zip(batch.column("html"), batch.column("rare"), strict=True)):
            page = without_rare(parse(text.as_py()), set(rare.as_py() or ()))
            marks = scores(page)
            by_path: dict[str, float] = {}
            for p, s in zip(page.path, marks, strict=True):
                by_path[p] = by_path.get(p, 0.0) + s
            total, least = max(by_path.values(), default=0.0), max(marks, default=0.0)
            # What only surrounds the best place has no vote, else it would collect those of all layouts.
            best, outer = max(by_path, key=by_path.__getitem__, default=None), set()
            for i, p in enumerate(page.path):
                while p == best and (i := page.parent[i]) >= 0 and i not in outer:
                    outer.add(i)
            around = {page.path[i] for i in outer} - {best}
            for p, s in by_path.items():
                if total and 2 * s >= least:
                    at.append(row)
                    paths.append(p)
                    shares.append(round(1024 * s / total) if 2 * s >= total and p not in around else 0)
        keys = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("k1", "k2", "host")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(paths, pa.string()), pa.array(shares, pa.int64())], ["k1", "k2", "host", "path", "share"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            main_text(without_rare(parse(t.as_py()), set(r.as_py() or ())), w.as_py() or [])
            for t, r, w in zip(batch.column("html"), batch.column("rare"), batch.column("winners"), strict=True)
        ]
        columns = [batch.column("page_id"), batch.column("url"), *[pa.array([f[i] for f in found], pa.string()) for i in (0, 1)]]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([len(f[0]) for f in found], pa.int64())], ["page_id", "url", "text", "path", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """The article text of every page: rows (page_id, url, text, n_chars, path).

    Each page scores its containers and votes, with the share of its best score, for the generalised paths
    (tags with classes, digits as ``#``) that reach half of it and do not just surround the best. Votes are
    summed per host and path. Pages are then extracted anew from the host's best path that holds at least half
    of the page's own best, else from its own best. The place found grows over the text around it that belongs to
    the same article (:func:`_whole_article`). Menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    styles and comments are left out by element and by words of class, id or role; of a page most
    of whose text lies in a form only the controls are.

    Blocks keep page order, joined by two newlines; white space in a block is one space, and a line break
    element is white space. NULL or empty html gives an empty text; a NULL url is a host of its own; pages
    without a container of text give all their text. Repeated rows are extracted alike; paths with equal votes
    are tried in descending order of the path. Very long pages are parsed whole. An empty table gives no rows, and columns of
    other names are not read. Votes are joined back on host and path for every path a page can take, so a host
    may have any number of layouts. Classes of one page of a host only, or of fewer than one page in a hundred,
    are left out of paths unless two paths of a page would become one, on hosts of every size.
    """
    scratch = Scratch(pages.sparkSession, "html")
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    key = ["k1", "k2"]
    rows = rows.select("*", F.xxhash64("host", "html").alias("k1"), F.xxhash64(F.lit(1), "html", "host").alias("k2"))
    sizes = rows.select(*key, "host").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    tokens = scratch.stage(rows.select(*key, "host", "html").mapInArrow(_classes, "k1 long, k2 long, host string, token string").distinct())
    seen = tokens.groupBy("host", "token").agg(F.count(F.lit(1)).alias("used")).join(sizes, "host")
    seen = scratch.stage(seen.where((F.col("used") == 1) | (100 * F.col("used") < F.col("pages"))).select("host", "token"))
    rare = scratch.stage(tokens.join(seen, ["host", "token"]).groupBy(*key).agg(F.collect_set("token").alias("rare")))
    rows = rows.join(rare, key, "left")
    paths = scratch.stage(rows.select(*key, "host", "html", "rare").mapInArrow(_candidates, "k1 long, k2 long, host string, path string, share long"))
    votes = scratch.stage(paths.groupBy("host", "path").agg(F.sum("share").alias("votes")).where("votes > 0"))
    order = F.sort_array(F.collect_list(F.struct("votes", F.col("path"))), asc=False)
    own = paths.select(*key, "host", "path").distinct().join(votes, ["host", "path"])
    winners = scratch.stage(own.groupBy(*key).agg(order["path"].alias("winners")))
    placed = rows.join(winners, key, "left").select("page_id", "url", "html", "rare", "winners")
    return placed.mapInArrow(_extract, "page_id long, url string, text string, path string, n_chars long").select("page_id", "url", "text", "n_chars", "path")
