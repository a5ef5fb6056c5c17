"""Main text of web pages: markup rules, and differences to the page with the nearest URL.

A page's blocks of text are its lines. Markup says of a line that it belongs to the article, that it does
not (menus, forms, adverts and the like), or neither: it stands beside the article, or in an element whose class
or id only hints at something else than an article. Lines of the last kind are compared with those of the
neighbouring page of the same host in the order of URL paths: lines on the longest common subsequence of
both pages are the site's own and are deleted.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Sequence

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from brightloom.operators.positions import with_group_position

# Elements by what they do to text.
_RAW = "script|style|template|noscript|iframe|svg|math|object|video|audio|canvas|select|textarea|title"
_DROP = frozenset("head nav header footer aside form menu button dialog fieldset".split())
_ARTICLE = frozenset("article main".split())
_BLOCK = frozenset(
    "html head body nav header footer aside form menu dialog fieldset article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
    "table caption thead tbody tfoot tr blockquote pre address figure figcaption hr details summary legend option hgroup search center".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em i ins kbd label mark q rp rt ruby s samp small span strong sub sup td th time tt u var font big".split())
_SURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer masthead cookie cookies consent gdpr popup modal comment comments disqus newsletter subscribe signup login pagination pager "
    "toolbar".split())
_HINTS = frozenset(
    "banner header topbar notice notices alert overlay reply replies respond share sharing social related recommended search widget".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+>.*?(?:</\1\s*+[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_MARKS = re.compile(r"(?<![\w-])(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))", re.I)

INSIDE, OUTSIDE, OPEN, DOUBT = "article", "site", "open", "doubt"


def _mark(attributes: str, inside: bool) -> str | None:
    """What class, id and role say of an element: no part of an article (``OUTSIDE``), perhaps none (``DOUBT``), or nothing.

    A whole name counts, or one of which every part is listed, such as ``nav-menu``; of a name with a
    listed part, such as ``has-social``, it can't be said. Inside an article hints are only doubts.
    """
    doubt = False
    for kind, *values in _MARKS.findall(attributes):
        for name in "".join(values).lower().split():
            parts = [p for p in re.split(r"[^a-z]+", name) if p]
            if kind.lower() == "role":
                if name in _ROLES:
                    return OUTSIDE
                continue
            listed = [p in _SURE or p in _HINTS for p in parts]
            if parts and all(listed) and (not inside or any(p in _SURE for p in parts)):
                return OUTSIDE
            doubt |= any(listed)
    return DOUBT if doubt else None


def lines(page: str | None) -> list[tuple[str, str]]:
    """``(zone, text)`` of each block of a page in order; character references decoded, white space made one space.

    ``article`` and ``main`` are never put aside for their class, nor is an element that holds most of the words of a
    page in at least four blocks.
    """
    found: list[tuple[str, bool, bool, bool, tuple[int, ...]]] = []  # text, dropped by its element, inside, in doubt, dropping marks
    stack: list[tuple[str, str | None, bool, int]] = []  # name, what it does to text, is an article, number of the mark
    held: list[str] = []
    page, at, marks = page or "", 0, 0

    def end_block() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            kinds = [x[1] for x in stack]
            found.append((text, "element" in kinds, any(x[2] for x in stack), DOUBT in kinds, tuple(x[3] for x in stack if x[1] == OUTSIDE)))

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            if m[1]:
                held.append(" ")
            continue
        if name in _BLOCK:
            end_block()
        elif name not in _INLINE or name in ("td", "th"):
            held.append(" ")
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name not in _BLOCK and any(x[1] for x in stack[i:]):
                        end_block()
                    del stack[i:]
                    break
        elif name not in _VOID:
            if name in _BLOCK:  # a paragraph ends where the next block begins
                while stack and stack[-1][0] == "p":
                    stack.pop()
            inside = any(x[2] for x in stack)
            does = "element" if name in _DROP and not (name == "header" and inside) else None
            if does is None and m[4].strip() and name not in ("html", "body") and name not in _ARTICLE:
                does = _mark(m[4], inside)
            marks += 1
            if does and name not in _BLOCK:
                end_block()
            if does or name in _ARTICLE or name not in _INLINE and name != "p":
                stack.append((name, does, name in _ARTICLE, marks))
    held.append(page[at:])
    end_block()

    sizes: dict[int, int] = {}
    blocks: dict[int, int] = {}
    words = [len(text.split()) for text, *_ in found]
    for n, (_, dropped, _, _, outside) in zip(words, found):
        for i in () if dropped else outside:
            sizes[i], blocks[i] = sizes.get(i, 0) + n, blocks.get(i, 0) + 1
    whole = sum(n for n, x in zip(words, found) if not x[1])
    out = []
    for text, dropped, inside, doubt, outside in found:
        if dropped or any(2 * sizes[i] <= whole or blocks[i] < 4 for i in outside):
            zone = OUTSIDE
        else:
            zone = (DOUBT if doubt else INSIDE) if inside else OPEN
        out.append((zone, text))
    return out


def common_lines(a: Sequence[int], b: Sequence[int]) -> list[bool]:
    """Which lines of ``a`` lie on a longest common subsequence with ``b``; rows of bits stand for the table."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    rows, v = [], full
    for y in b:
        u = v & places.get(y, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    shared, j, i = [False] * len(a), len(b) - 1, len(a) - 1
    # A zero bit i in row j: the subsequence of a[:i + 1] and b[:j + 1] is longer than that of a[:i].
    while i >= 0 and j >= 0:
        if rows[j] >> i & 1:
            i -= 1
        elif j and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            shared[i] = True
            i, j = i - 1, j - 1
    return shared


def open_hashes(found: Sequence[tuple[str, str]]) -> list[int]:
    """Of the lines that markup does not settle, 32 bits each."""
    return [xxhash.xxh32_intdigest(t) - (1 << 31) for zone, t in found if zone in (OPEN, DOUBT)]


def main_text(page: str | None, neighbour: Sequence[int] | None) -> str:
    """The article's blocks, and the lines in doubt that the neighbour does not share.

    Lines beside the article are in doubt too where they have more words than it, as on a page with a teaser, or
    where there is no article.
    """
    found = lines(page)
    words = {zone: sum(len(t.split()) for z, t in found if z == zone) for zone in (INSIDE, OPEN, DOUBT)}
    keep = (INSIDE, DOUBT) if words[INSIDE] + words[DOUBT] >= words[OPEN] else (INSIDE, DOUBT, OPEN)
    hashes = open_hashes(found)
    shared = iter(common_lines(hashes, list(neighbour)) if neighbour is not None and len(neighbour) else [False] * len(hashes))
    settled = [(zone, t, zone in (OPEN, DOUBT) and next(shared)) for zone, t in found]
    return "\n\n".join(t for zone, t, site in settled if zone in keep and not site)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _hashes(pages: pd.Series) -> pd.Series:
    return pd.Series([open_hashes(lines(p)) for p in pages], dtype=object)


@F.pandas_udf(T.StringType())
def _text(pages: pd.Series, neighbours: pd.Series) -> pd.Series:
    return pd.Series([main_text(p, n) for p, n in zip(pages, neighbours)], dtype=object)


def _alike(a, b):
    """Share of the lines of ``a`` that ``b`` has too."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_distinct(a)), F.lit(1))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", copy_share: float = 0.9) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Of the two pages beside a page in the order of URL paths of its host, the one whose path has the longer
    common beginning is its neighbour; pages that share ``copy_share`` of the lines or more are copies
    and are passed over. A null page has the text ``''``; a null URL has the host ``''``; repeated rows get
    equal results; an empty table gives an empty one. A host with any part of the pages is sorted
    over many tasks.
    """
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    base = base.withColumn("_key", F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))
    address = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(address, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_replace(address, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*", "")
    keyed = base.select("_key", host.alias("host"), path.alias("path"), _hashes("html").alias("lines")).dropDuplicates(["_key"])
    placed = with_group_position(keyed, ["host"], ["path", "_key"], "n")
    beside = placed.select("host", "n", "path", "lines")

    def near(step: int, name: str) -> DataFrame:
        return beside.select(F.col("host").alias(f"_host_{name}"), (F.col("n") - step).alias(f"_n_{name}"), F.struct("path", "lines").alias(name))

    pairs = placed
    for step, name in ((-1, "before"), (1, "after")):
        pairs = pairs.join(near(step, name), (F.col("host") == F.col(f"_host_{name}")) & (F.col("n") == F.col(f"_n_{name}")), "left")

    def closeness(name: str):
        """Length of the common beginning of both paths, -1 for no page or a copy."""
        other = F.col(name)
        upto = F.least(F.length("path"), F.length(other["path"]))
        same = F.filter(F.sequence(F.lit(1), F.greatest(upto, F.lit(1))),
                        lambda i: F.substr(F.col("path"), F.lit(1), i) == F.substr(other["path"], F.lit(1), i))
        usable = other.isNotNull() & (_alike(F.col("lines"), other["lines"]) < copy_share)
        return F.when(usable, F.size(same)).otherwise(-1)

    chosen = F.when(F.greatest("_before", "_after") < 0, F.lit(None)).when(F.col("_after") > F.col("_before"), F.col("after.lines")).otherwise(F.col("before.lines"))
    pairs = pairs.withColumn("_before", closeness("before")).withColumn("_after", closeness("after")).select("_key", chosen.alias("_lines"))
    text = base.join(pairs, "_key", "left").withColumn("text", _text("html", "_lines"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
