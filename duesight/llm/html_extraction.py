"""Main text of web pages, by deducing each host's template from equivalence classes of its tokens.

A token is an element with its place in the tree (tag and class names of its block ancestors). Its occurrence
vector says how often it stands on each page of the host. Tokens with the same vector form a class; a class is
valid if its tokens stand once on each page that has them, on a good part of the host's pages. Valid classes nest
by their places and are the template; the text between their tokens is the slots, the text of places that repeat on
a page included. Slots with the names of page furniture or mostly links are dropped; the template's article, or
else all slots that are left, are the main slots. A page without them falls back to its own article or body.

Vectors are never gathered: two hash sums over the pages stand for them, added up on the map side. Decisions are one
row for each host and are joined to the pages.

Null urls share one host; null or empty html gives the empty text. Pages that repeat are extracted each on its own.
Unclosed comments and raw elements end with the page; a ``<`` that opens no tag is text. Pages of any length are read in time in
proportion to it. Empty tables give no rows; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.llm.scratch import cut

# Elements of HTML by what they do to text.
RAW = frozenset("script style noscript template iframe textarea select svg object title".split())
PLACES = frozenset("html head body main article section div nav header footer aside form table ul ol dl figure fieldset details dialog menu".split())
BLOCKS = PLACES | frozenset("p br hr h1 h2 h3 h4 h5 h6 li dt dd tr td th thead tbody caption figcaption pre blockquote address center option legend summary".split())
EMPTY = frozenset("br hr img input meta link area base col embed source track wbr".split())
FURNITURE = frozenset("head nav footer aside form menu dialog".split())
# Words in class names and ids of page furniture.
FURNITURE_NAMES = re.compile(
    r"(?:^| |(?<!with)(?<!has)(?<!no)(?<!article)(?<!post)(?<!entry)[-_])(?:ad|ads|advert|advertisement|adverts|banner|sponsor|sponsored|promo|cookie|cookies|consent|gdpr|notice|alert|popup|modal|overlay|nav|navbar|navigation|"
    r"menu|sidebar|side|aside|footer|header|masthead|breadcrumb|breadcrumbs|comment|comments|respond|disqus|replies|share|sharing|social|related|recommended|newsletter|"
    r"subscribe|subscription|signup|login|search|widget|toolbar|pagination|pager|copyright|skip|hidden)(?:$|[-_ ])"
)
_START = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|!--|[!?/])")
#: Attributes up to the tag's end; a ``>`` in a quoted value ends no tag.
_ATTRIBUTES = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
_NAMES = re.compile(r"""(?<![\w-])(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ENDS = {tag: re.compile(rf"</{tag}\b[^>]*>?", re.I) for tag in RAW}
#: Share of a host's pages that a template token stands on, and of links in furniture.
SUPPORT, LINKS = 0.3, 0.6


def host_of(url: str | None) -> str:
    found = re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def pieces(page: str | None) -> Iterator[tuple[str, str, bool]]:
    """``place, text, linked`` in page order; a text of ``\\0`` ends a block, an empty one opens a place."""
    page = page or ""
    stack: list[str] = []
    path, linked, at, quoted = "", False, 0, True
    last = page.rfind(">")  # behind it no tag ends, which is known before one is tried
    while True:
        tag = _START.search(page, at)
        while tag and tag[2] and not tag[1] and tag.start() > last:
            tag = _START.search(page, tag.end())
        text = page[at : tag.start() if tag else len(page)]
        if text:
            yield path, text.replace("\0", " "), linked
        if tag is None:
            return
        at = tag.end()
        if tag[2] is None or tag.start() > last:
            end = page.find("-->" if tag[0] == "<!--" else ">", at)
            at = len(page) if end < 0 else end + (3 if tag[0] == "<!--" else 1)
            continue
        rest = _ATTRIBUTES.match(page, at) if quoted else None
        if rest is None:  # quotes that don't end: from here on the next sign ends a tag
            quoted = False
            end = page.find(">", at)
            attributes, at = page[at:end], end + 1
        else:
            attributes, at = rest[1], rest.end()
        name = tag[2].lower()
        if name in RAW:
            if not tag[1] and not attributes.endswith("/"):
                end = _ENDS[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "a":
            linked = not tag[1]
        if name in BLOCKS:
            yield path, "\0", linked
        if name in PLACES:
            if tag[1]:
                if name in (own := [s.split(".")[0] for s in stack]):
                    del stack[len(own) - 1 - own[::-1].index(name) :]
            else:
                named = " ".join(a or b or c for _, a, b, c in _NAMES.findall(attributes)) if attributes else ""
                named = re.sub(r"[^a-z_ -]+", "", named.lower()).strip()
                stack.append(f"{name}.{named}" if named else name)
                linked = False
            path = "/".join(stack)
            if not tag[1]:
                yield path, "", False


@lru_cache(maxsize=1 << 14)
def is_furniture(place: str) -> bool:
    """Whether a step of the place is page furniture. A header inside an article is the article's."""
    inside = False
    for step in place.split("/"):
        name, _, names = step.partition(".")
        if name in FURNITURE or name == "header" and not inside or names and name not in ("html", "body", "article", "main") and FURNITURE_NAMES.search(names):
            return True
        inside = inside or name in ("article", "main")
    return False


TOKEN = "host string, place string, pages long, uses long, most long, a long, b long, chars long, linked long"


def tokens(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Sums over the pages of each host's tokens; ``a`` and ``b`` stand for the occurrence vector. ``chars`` and
    ``linked`` are those of the place and of all places below it that aren't furniture."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = {}
            for page_id, url, page in zip(batch.page_id, batch.url, batch.html, strict=True):
                own: dict[str, list[int]] = {"": [1, 0, 0]}
                for place, text, linked in pieces(page):
                    row = own.setdefault(place, [0, 0, 0])
                    if not text:
                        row[0] += 1
                    elif text != "\0":
                        n = len(text) - text.count(" ")
                        row[1] += n
                        row[2] += n * linked
                for place in sorted(filter(None, own), key=lambda p: -p.count("/")):
                    if not is_furniture(place):
                        row, above = own[place], own[place.rpartition("/")[0]]
                        above[1] += row[1]
                        above[2] += row[2]
                host = host_of(url)
                for place, (uses, chars, links) in own.items():
                    mark = xxhash.xxh64_intdigest(f"{page_id} {url} {uses}")
                    row = sums.setdefault((host, place), [0] * 7)
                    for k, x in enumerate((1, uses, 0, mark & 0xFFFFFFFF, mark >> 32, chars, links)):
                        row[k] += x
                    row[2] = max(row[2], uses)
            yield pd.DataFrame([(*key, *row) for key, row in sums.items()], columns=[x.split()[0] for x in TOKEN.split(", ")])

    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    sums = [F.max(c).alias(c) if c == "most" else F.sum(c).alias(c) for c in ("pages", "uses", "most", "a", "b", "chars", "linked")]
    return rows.mapInPandas(run, TOKEN).groupBy("host", "place").agg(*sums)


def templates(stats: DataFrame) -> DataFrame:
    """``host, main, drop``: places whose text is the article, and places inside them whose text is not."""
    all_pages = stats.filter("place = ''").select("host", F.col("pages").alias("all_pages"))
    rows = stats.join(all_pages, "host").filter(F.col("pages") >= SUPPORT * F.col("all_pages"))
    # A class: equal occurrence vectors. It is valid if its tokens stand once on each page that has them.
    classes = rows.groupBy("host", "a", "b", "pages").agg(
        F.max("most").alias("class_most"), F.collect_list(F.struct("place", "chars", "linked")).alias("members")
    )
    valid = classes.filter("class_most = 1").groupBy("host").agg(F.flatten(F.collect_list("members")).alias("members"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [(host, *choose([(m["place"], m["chars"], m["linked"]) for m in members])) for host, members in zip(batch.host, batch.members, strict=True)]
            yield pd.DataFrame(made, columns=["host", "main", "drop"])

    return valid.mapInPandas(decide, "host string, main array<string>, drop array<string>")


def choose(members: list[tuple[str, int, int]]) -> tuple[list[str], list[str]]:
    """Nest the places of a host's valid classes; the main slots and the slots to drop."""
    chars = {place: n for place, n, _ in members}
    links = {place: linked for place, _, linked in members}
    # An article that is mostly links is still the article.
    real = lambda p: p.split("/")[-1].split(".")[0] in ("", "article", "main", "body", "html")
    drop = {p for p in chars if is_furniture(p)}
    for p in sorted(chars.keys() - drop, key=lambda p: (-p.count("/"), p)):
        if not real(p) and links[p] > LINKS * max(chars[p], 1):
            drop.add(p)
            above = p
            while above:  # what goes no longer counts for the places around it
                above = above.rpartition("/")[0]
                if above in chars:
                    chars[above] -= chars[p]
                    links[above] -= links[p]
    kept = sorted((p for p in chars if not any(p == d or p.startswith(d + "/") for d in drop)), key=lambda p: (p.count("/"), p))
    for name in ("article", "main"):
        main = [p for p in kept if p.split("/")[-1].split(".")[0] == name]
        if main and any(chars[p] for p in main):
            break
    else:
        main = [""] if chars.get("") else []  # the page: all that is left
    main = [p for p in main if not any(p.startswith(q + "/") for q in main)]
    return main, sorted(d for d in drop if any(not p or d.startswith(p + "/") for p in main))


def text_of(page: str | None, main: list[str] | None, drop: list[str] | None) -> str:
    """Blocks of the main slots in page order, joined by one blank."""
    found = list(pieces(page))
    main, drop = [*(main if main is not None else [])], [*(drop if drop is not None else [])]
    chosen = [p for p in main if any(not p or place == p or place.startswith(p + "/") for place, text, _ in found if text.strip("\0"))]
    if not chosen:  # this page does not follow the template
        opened = dict.fromkeys(place for place, text, _ in found if not text)
        for name in ("article", "main", "body"):
            chosen = [p for p in opened if p.split("/")[-1].split(".")[0] == name and not is_furniture(p)]
            if chosen:
                break
        else:
            chosen = [""]
    keep: dict[str, bool] = {}
    parts: list[str] = []
    for place, text, _ in found:
        use = keep.get(place)
        if use is None:
            inside = any(not p or place == p or place.startswith(p + "/") for p in chosen)
            use = keep[place] = inside and not is_furniture(place) and not any(place == d or place.startswith(d + "/") for d in drop)
        if text == "\0":
            parts.append(" ")
        elif use and text:
            parts.append(text)
    return " ".join(html.unescape("".join(parts)).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` of every page."""
    decided = cut(templates(tokens(pages, id_col, url_col, html_col)), "templates")
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("host"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text_of(page, main, drop) for page, main, drop in zip(batch.html, batch.main, batch["drop"], strict=True)]
            yield pd.DataFrame({"page_id": batch.page_id, "url": batch.url, "text": texts})

    return rows.join(decided, "host", "left").select("page_id", "url", "html", "main", "drop").mapInPandas(run, "page_id long, url string, text string")
