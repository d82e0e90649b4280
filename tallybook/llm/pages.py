"""Main text of web pages by wrappers inferred for each host."""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import materialized, small_batches

# What HTML and its users name things. Fixed values.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike "
    "strong sub sup time tt u var".split())
_UNSEEN = frozenset("script style template img input link meta wbr source track area embed param base".split())  # break no line
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section summary table ul".split())
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table select".split())
_APART = frozenset(
    "head nav header footer aside script style noscript template iframe object svg math canvas audio video select button input "
    "textarea title menu dialog noembed noframes xmp".split())
_APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup "
    "modal overlay sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs header footer comment comments disqus reply replies "
    "respond share sharing social related recommended newsletter subscribe subscription signup login search widget widgets toolbar pagination "
    "skip".split())
# Within a main part only these set a part aside, and only as a whole name, alone or with words that say nothing.
_APART_INSIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo comment comments disqus newsletter subscribe share sharing "
    "social cookie cookies consent popup modal".split())
_NEUTRAL = frozenset("reader readers user users box block container wrapper section area button buttons bar list links link inline slot unit top bottom left right".split())
_APART_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar".split())
_MAIN = frozenset("article main".split())
_MAIN_ROLES = frozenset("main article".split())
_ROOTS = frozenset("html body".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^=>]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?P<close>>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?P<name>class|id|role|itemprop|hidden|aria-hidden)(?=[\s=/]|\Z)(?:\s*=\s*(?:\"(?P<a>[^\"]*)\"|'(?P<b>[^']*)'|(?P<c>[^\s>]+)))?", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")

_GUESSED = frozenset(["form"])  # a whole page may be one form

APART, MAIN, OTHER, GUESSED, RETAKEN = "apart", "main", "other", "guessed", "retaken"


@dataclass
class _Element:
    name: str
    label: str
    apart: bool
    guessed: bool
    main: bool
    inside: bool


def _set_aside(names: str) -> bool:
    """Whether one of an element's names is one that sets a part of an article aside: ``share-buttons``, not ``ad-hoc``."""
    for name in names.lower().split():
        words = {w for w in _SPLIT.split(name) if w}
        if words & _APART_INSIDE and words <= _APART_INSIDE | _NEUTRAL:
            return True
    return False


def _element(name: str, rest: str) -> _Element:
    found = {m["name"].lower(): m["a"] or m["b"] or m["c"] or "" for m in _ATTRIBUTE.finditer(rest)} if rest else {}
    words = {w for key in ("class", "id") for w in _SPLIT.split(found.get(key, "").lower())}
    role = found.get("role", "").lower()
    main = name in _MAIN or role in _MAIN_ROLES or found.get("itemprop", "").lower() == "articlebody"
    apart = name in _APART or role in _APART_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    comment = name == "article" and bool(words & {"comment", "comments", "reply"})
    main = main and not comment
    guessed = comment or name in _GUESSED or role in _GUESSED or name not in _ROOTS and not main and bool(words & _APART_WORDS)
    label = name + "".join(sorted(f".{w}" for w in _SPLIT.split(found.get("class", "").lower()) if w and not w.isdigit()))
    inside = not main and (comment or name in _GUESSED or role in _GUESSED or _set_aside(f"{found.get('class', '')} {found.get('id', '')}"))
    return _Element(name, label, apart, guessed, main, inside)


def _kind(stack: list[_Element]) -> str:
    """What the innermost mark says. Tags, roles and hidden parts set apart all within; a form or a class word is a guess,
    which the host's pages confirm or not, and within a main part counts only as a whole name."""
    if any(e.apart for e in stack):
        return APART
    last = max((i for i, e in enumerate(stack) if e.main), default=-1)
    if last < 0:
        return GUESSED if any(e.guessed for e in stack) else OTHER
    if any(e.inside for e in stack[last + 1 :]):
        return APART
    return RETAKEN if any(e.guessed for e in stack[:last]) else MAIN


def _judged(found: list[tuple[int, str, str]]) -> list[tuple[int, str, str]]:
    """An article within a guess is the main part if it outweighs what is outside, else a teaser and set apart."""
    sizes = dict.fromkeys((APART, MAIN, OTHER, GUESSED, RETAKEN), 0)
    for _, path, text in found:
        sizes[path.split("/", 1)[0]] += len(text.strip())
    if not sizes[RETAKEN]:
        return found
    kind = MAIN if sizes[RETAKEN] > sizes[MAIN] + sizes[OTHER] else APART
    return [(block, kind + path.removeprefix(RETAKEN) if path.startswith(RETAKEN + "/") else path, text) for block, path, text in found]


def pieces(page: str) -> list[tuple[int, str, str]]:
    """(block, path, text) of every piece of text in page order; references decoded, white space kept.

    The path is that of the open block elements with their classes; it begins with what the place
    says of the text: in a part set apart, in one that its name makes look so, in a main part, or neither. Elements that their
    successor closes need no end tag; an end tag without its element is ignored.
    """
    out: list[tuple[int, str, str]] = []
    stack: list[_Element] = []
    block, at = 0, 0
    path: str | None = None

    def say(text: str) -> None:
        nonlocal path
        if not text or text.isspace() and (not out or out[-1][0] != block):
            return
        if path is None:
            path = _kind(stack) + "/" + "/".join(e.label for e in stack if e.name not in _INLINE)
        out.append((block, path, entities.unescape(text)))

    while at < len(page):
        token = _TOKEN.search(page, at)
        if token is None:
            say(page[at:])
            break
        say(page[at : token.start()])
        at = token.end()
        if token["cdata"] is not None:
            say(token["cdata"].replace("&", "&amp;"))
            continue
        if token["name"] is None:
            continue
        name = token["name"].lower()
        if name not in _INLINE and name not in _UNSEEN:
            block += 1
        path = None
        if token["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == name:
                    del stack[i:]
                    break
                if stack[i].main and name in _INLINE:
                    break
            continue
        if not token["close"]:
            break  # cut off within a tag
        if name in _CLOSES_P:
            while stack and any(e.name == "p" for e in stack) and next((e.name for e in reversed(stack) if e.name not in _INLINE), "") == "p":
                del stack[max(i for i, e in enumerate(stack) if e.name == "p") :]
        if name in _SELF_CLOSING:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in _SCOPE:
                    break
                if stack[i].name in _SELF_CLOSING[name]:
                    del stack[i:]
                    break
        if name in _VOID or token["rest"].endswith("/") and name not in _CLOSES_P and name not in _INLINE:
            continue
        if name in _RAW:
            stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            continue
        stack.append(_element(name, token["rest"]))
    return _judged(out)


# --- wrappers: lists of items (path, optional, repeated), a regular expression without union ---

Item = tuple[str, bool, bool]
_CELLS = 1_000_000
_MOST_SENT = 8_000_000  # characters


def folded(paths: list[str]) -> list[Item]:
    """The paths in order; what repeats at once, a path or a group of up to eight, becomes repeated."""
    items: list[Item] = []
    for path in paths:
        items.append((path, False, False))
        for size in range(1, min(8, len(items) // 2) + 1):
            last, before = items[-size:], items[-2 * size : -size]
            if [i[0] for i in last] == [i[0] for i in before]:
                items[-2 * size :] = [(b[0], a[1] or b[1], True) for a, b in zip(last, before, strict=True)]
                break
    return items


def _aligned_greedily(one: list[Item], other: list[Item]) -> list[Item]:
    """For long wrappers: each item matches the next of its path. In proportion to the lengths."""
    places: dict[str, list[int]] = {}
    for i, item in enumerate(one):
        places.setdefault(item[0], []).append(i)
    out, i = [], 0
    for path, optional, repeated in other:
        later = places.get(path, [])
        at = bisect_left(later, i)
        if at == len(later):
            out.append((path, True, repeated))
            continue
        out += [(p, True, r) for p, _, r in one[i : later[at]]]
        i = later[at]
        out.append((path, optional or one[i][1], repeated or one[i][2]))
        i += 1
    return out + [(p, True, r) for p, _, r in one[i:]]


def aligned(one: list[Item], other: list[Item]) -> list[Item]:
    """The least wrapper of both that keeps their order: common items match, others become optional."""
    n, m = len(one), len(other)
    if n * m > _CELLS:
        return _aligned_greedily(one, other)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if one[i][0] == other[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and one[i][0] == other[j][0]:
            out.append((one[i][0], one[i][1] or other[j][1], one[i][2] or other[j][2]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append((one[i][0], True, one[i][2]))
            i += 1
        else:
            out.append((other[j][0], True, other[j][2]))
            j += 1
    merged: list[Item] = []
    for item in out:  # optional twins side by side are one repeated item
        if merged and merged[-1][0] == item[0]:
            merged[-1] = (item[0], merged[-1][1] and item[1], True)
        else:
            merged.append(item)
    return merged


def _encode(items: list[Item]) -> str:
    return "\n".join(path + ("?" if optional else "") + ("+" if repeated else "") for path, optional, repeated in items)


def _decode(text: str) -> list[Item]:
    out = []
    for line in text.split("\n") if text else []:
        repeated = line.endswith("+")
        line = line.removesuffix("+")
        out.append((line.removesuffix("?"), line.endswith("?"), repeated))
    return out


def _merge(rows: pd.DataFrame) -> str:
    wrapper: list[Item] | None = None
    for text in sorted(rows["skeleton"]):
        items = _decode(text)
        wrapper = items if wrapper is None else aligned(wrapper, items)
    return _encode(wrapper or [])


def host_of(url: str | Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def infer_wrappers(pages: DataFrame, *, fan: int = 64) -> DataFrame:
    """``host``, ``wrapper``, ``slots``: a union-free expression for all pages of each host.

    ``wrapper`` lists the places of text in page order, one a line, ``?`` for optional and ``+`` for
    repeated. ``slots`` are the places whose text differs between pages of the host, and optional ones that
    a single one of its pages has; the text of the others belongs to the template, unless the host has one page only.

    Pages of equal structure, nearly all of them, are counted as one before any shuffle. The
    distinct ones are aligned in groups of about ``fan``, their wrappers in groups again, and so on, so that
    a host with a large share of all pages is no task's work alone.
    """
    rows = pages.select(host_of("url").alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    def structure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, page in zip(batch["host"], batch["html"], strict=True):
                texts: dict[str, list[str]] = {}
                order = []
                for _, path, text in pieces(page):
                    if text.isspace():
                        continue
                    order.append(path)
                    texts.setdefault(path, []).append(text)
                out.append((host, _encode(folded(order)), [{"path": p, "text": "\0".join(t)} for p, t in texts.items()]))
            yield pd.DataFrame(out, columns=["host", "skeleton", "places"])

    read = rows.mapInPandas(structure, "host string, skeleton string, places array<struct<path:string,text:string>>")
    hashed = F.transform("places", lambda p: F.struct(p["path"].alias("path"), F.xxhash64(p["text"]).alias("text")))
    read = read.select("host", "skeleton", hashed.alias("places"))
    read = materialized(read.withColumn("page", F.xxhash64("places")), "structures")

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(key[0], key[1], _merge(group))], columns=["host", "part", "skeleton"])

    distinct = materialized(read.select("host", "skeleton").distinct(), "skeletons")
    most = distinct.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // fan))
    level = distinct.withColumn("part", F.pmod(F.xxhash64("skeleton"), F.lit(parts)))
    while True:
        level = level.groupBy("host", "part").applyInPandas(merge, "host string, part long, skeleton string")
        if parts == 1:
            break
        parts = -(-parts // fan)
        level = materialized(level, "wrappers").withColumn("part", F.pmod("part", F.lit(parts)))

    seen = read.select("host", "page", F.explode("places").alias("place")).groupBy("host", "place.path").agg(
        F.min("place.text").alias("least"), F.max("place.text").alias("most"), F.min("page").alias("first"), F.max("page").alias("last"))
    several = read.groupBy("host").agg((F.min("page") != F.max("page")).alias("several"))
    slot = (F.col("least") != F.col("most")) | (F.col("several") & (F.col("first") == F.col("last")))
    slots = seen.join(several, "host").where(slot).groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("slots"))
    return level.join(slots, "host", "left").select("host", F.col("skeleton").alias("wrapper"), F.coalesce("slots", F.array().cast("array<string>")).alias("slots"))


def content_places(wrapper: str, slots: list[str]) -> list[set[str]]:
    """The places of a wrapper that may hold the article, the likelier first; a page takes the first it has text in.

    Those in main parts; the slots that nothing sets apart; the slots that only a guess sets apart; and for pages with nothing but
    template, as the only page of a host is, all places that nothing, or only a guess, sets apart.
    """
    places = [path for path, _, _ in _decode(wrapper)]
    main, other, guessed = ({p for p in places if p.startswith(kind + "/")} for kind in (MAIN, OTHER, GUESSED))
    return [main, other & set(slots), guessed & set(slots), other, guessed]


def main_text(page: str, content: list[set[str]]) -> str:
    """The text of the content places, a line for each block; nothing from places that the host's wrapper does not have."""
    found = pieces(page)
    for places in content:
        blocks: dict[int, list[str]] = {}
        for block, path, text in found:
            if path in places:
                blocks.setdefault(block, []).append(text)
        lines = [_SPACE.sub(" ", "".join(b)).strip() for b in blocks.values()]
        if any(lines):
            return "\n".join(line for line in lines if line)
    return ""


def extract_text(pages: DataFrame, *, fan: int = 64) -> DataFrame:
    """``page_id``, ``url``, ``text`` of every row: the article by the wrapper of its host.

    White space inside a block becomes one space, blocks are joined by a line feed, character references
    are decoded; nothing is cut, however long. Null and empty pages give the empty text. Pages with a null URL or one without a host
    share the wrapper of the empty host. Rows repeated are rows of their own; other columns are ignored. An empty
    table gives an empty result.
    """
    small_batches(pages.sparkSession, 200)
    wrappers = materialized(infer_wrappers(pages, fan=fan), "wrappers")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of("url").alias("host"))
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length(F.array_join("slots", ",")))).first()[0] or 0
    if size <= _MOST_SENT:  # else the pages are dealt out by host, and Spark splits a host of many
        wrappers = F.broadcast(wrappers)
    joined = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper", "slots")

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, list[set[str]]] = {}
        for batch in batches:
            texts = []
            for page, wrapper, slots in zip(batch["html"], batch["wrapper"], batch["slots"], strict=True):
                key = f"{wrapper}\0{len(slots)}\0{hash(tuple(slots))}"
                if key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = content_places(wrapper, list(slots))
                texts.append(main_text(page, known[key]))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": pd.Series(texts, dtype=object)})

    kind = dict(pages.dtypes)["page_id"]
    return joined.mapInPandas(extract, f"page_id {kind}, url string, text string")
