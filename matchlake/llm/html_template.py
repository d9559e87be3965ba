"""Main text of web pages by deducing each host's template.

A page is a row of tokens: tags with their path of open elements, and text blocks with theirs. Tokens of a host that occur
equally often on every one of its pages share an occurrence vector; vectors are compared by a sum of per-page random numbers,
so they are found by one aggregation and a host's pages never have to meet. Such equivalence classes are valid if enough
pages have them and their spans nest; together they are the template. Text blocks that belong to a valid class are template
text and go on every page; what lies in a template element besides is its slots. The main slots, which are kept, are chosen by
how much text the host's slots hold; article and main marks help to name them.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, shipped, staged

#: A class counts from this many pages and this part of the host's pages on.
PAGES, SUPPORT = 3, 0.5
#: Part of a block's text in links from which it is a list of links, on pages that mark no article.
LINKED = 0.5
#: Part of the text outside the template from which marked elements are the main slot, and of the largest from which one counts.
MARKED = 0.25

#: Part of a page's text from which an element holds the main slot, if no mark names one.
HOLDS = 0.5

# Kinds of tokens, and the token of the page itself.
TEXT, OTHER, ARTICLE, MAIN, WHOLE = -1, 0, 1, 2, 0
MARKS = {"article": ARTICLE, "main": MAIN}

# Fixed values of the HTML standard and of common page markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|object|select"
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table
    tbody td tfoot th thead tr ul""".split())
CLOSES = {"p": BLOCK, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
          "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody"]), "th": frozenset(["td", "th", "tr", "tbody"]),
          "option": frozenset(["option", "optgroup"])}
SCOPE = frozenset("table td th article section div main aside nav footer header ul ol dl form blockquote body".split())
ASIDE = frozenset("nav aside footer form menu dialog button fieldset input label canvas audio video map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset("""ad ads adbox advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies
    consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup share sharing social
    related recommended recommendations sidebar widget widgets breadcrumb breadcrumbs pagination pager menu nav navbar navigation
    footer masthead topbar comment comments commentlist disqus reply replies respond login toolbar copyright disclaimer skip
    hidden""".split())
BOXES = frozenset("""area bar block bottom box button buttons container group header icons inner item items left link links list outer panel
    post posts right section site slot small text title top unit wrap wrapper""".split())

PIECE = re.compile(rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?=/?[a-z])[^>]*(?:>|\Z)", re.I | re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
DIGITS = re.compile(r"\d+")
NAME_PARTS = re.compile(r"[a-z]+|\d+")
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def token(*parts: str) -> int:
    """A signed 64-bit number for a token."""
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def marks(attributes: str) -> tuple[str, bool, bool]:
    """Class and id of a tag, whether its role or state says that it is no part of the article, and whether a name does.

    A name says so if one of its parts is in NAMES and the others only tell what kind of box it is: has-sidebar, nav-open,
    related-work and no-comment are other things."""
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return "", False, False
    label, out, named = [], False, False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            label.append(value)
            for name_of in value.split():
                parts = set(NAME_PARTS.findall(name_of))
                named |= not NAMES.isdisjoint(parts) and all(p in NAMES or p in BOXES or p.isdigit() for p in parts)
        elif name == "role":
            out |= value in ROLES
        else:
            out |= name == "hidden" or value == "true"
    return " ".join(label), out, named


@dataclass
class Block:
    """A run of text between block tags, and the number of the element it stands in (-1: none)."""

    token: int
    text: str
    linked: int
    dropped: bool
    at: int

    @property
    def plain(self) -> int:
        """Characters that count for the size of a slot."""
        return 0 if self.dropped else max(len(self.text) - self.linked, 0)


@dataclass
class Page:
    """Elements in page order with the number of the one around each (-1: none), and the text blocks."""

    tokens: list[int]
    parents: list[int]
    kinds: list[int]
    places: list[int]
    blocks: list[Block]
    block_places: list[int]
    named: list[bool]

    def leave(self, template: frozenset[int] = frozenset(), held: frozenset[int] = frozenset(),
              left: frozenset[int] = frozenset()) -> dict[int, bool]:
        """Drops the blocks of elements named as something else; returns which of these were dropped, by token.

        An element stays that is around the marked main slot or an element of `held`, or that holds half of the text of the
        marked slot it is in, of the page if none is marked. What the host says goes first: `held` stays, `left` goes.
        """
        if not any(self.named):
            return {}
        sizes, n = self.sizes(template), len(self.tokens)

        def over(chosen: list[int]) -> list[bool]:
            out = [False] * (n + 1)
            for k in chosen:
                out[k] = True
            for k in range(n - 1, -1, -1):
                out[self.parents[k]] |= out[k]
            return out

        def under(chosen: list[bool]) -> list[int]:
            """The outermost chosen element around each, or -1."""
            out = [-1] * (n + 1)
            for k, parent in enumerate(self.parents):
                out[k] = out[parent] if out[parent] >= 0 else k if chosen[k] else -1
            return out

        near = over([k for k in range(n) if self.kinds[k] in (ARTICLE, MAIN)])
        aside = under([name and not x for name, x in zip(self.named, near)])
        rest = sizes[-1] - sum(sizes[k] for k in range(n) if aside[k] == k)
        slots: list[int] = []
        within = [-1] * (n + 1)
        for kind in (ARTICLE, MAIN):
            within = under([k == kind for k in self.kinds])
            slots = [k for k in range(n) if within[k] == k]
            if sum(sizes[k] for k in slots) >= max(MARKED * rest, 1):
                break
            slots, within = [], [-1] * (n + 1)
        most = max((sizes[k] for k in slots), default=0)
        around = over([k for k in slots if sizes[k] >= MARKED * most] + [k for k in range(n) if self.tokens[k] in held])
        said: dict[int, bool] = {}
        gone = [False] * (n + 1)
        for k, parent in enumerate(self.parents):
            gone[k] = gone[parent]
            if self.named[k]:
                whole = sizes[within[k]] if within[k] >= 0 else 0 if slots else sizes[-1]
                mine = not around[k] and (self.tokens[k] in left or not whole or sizes[k] < HOLDS * whole)
                said[self.tokens[k]] = said.get(self.tokens[k], True) and mine
                gone[k] |= mine
        for b in self.blocks:
            b.dropped |= gone[b.at]
        return said

    def sizes(self, template: frozenset[int]) -> list[int]:
        """Plain characters outside the template in each element, and in the page at the end."""
        out = [0] * (len(self.tokens) + 1)
        for b in self.blocks:
            if b.token not in template:
                out[b.at] += b.plain
        for k in range(len(self.tokens) - 1, -1, -1):
            out[self.parents[k]] += out[k]
        return out


def parse(page: str) -> Page:
    """Elements and text blocks of a page. Digits in classes and ids do not count for tokens: they number posts."""
    out = Page([], [], [], [], [], [], [])
    stack: list[tuple[str, int, bool]] = []  # tag, element, dropped
    inside = {"article": 0, "a": 0}
    held: list[str] = []
    linked = place = 0

    def flush() -> None:
        nonlocal linked, place
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                at = stack[-1][1] if stack else -1
                path = out.tokens[at] if stack else WHOLE
                out.blocks.append(Block(token(str(path), text), text, linked, bool(stack and stack[-1][2]), at))
                place += 1
                out.block_places.append(place)
            held.clear()
        linked = 0

    def pop() -> None:
        tag = stack.pop()[0]
        if tag in inside:
            inside[tag] -= 1

    def text(part: str) -> None:
        nonlocal linked
        held.append(part)
        if inside["a"]:
            linked += len(part)

    at = 0
    for found in PIECE.finditer(page):
        if found.start() > at:
            text(page[at:found.start()])
        at = found.end()
        tag = found["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK:
            flush()
        if found["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in SCOPE and tag not in BLOCK:
                    break
            continue
        for k in range(len(stack) - 1, -1, -1):  # end tags that may be left out
            if tag in CLOSES.get(stack[k][0], ()):
                while len(stack) > k:
                    pop()
                break
            if stack[k][0] in SCOPE:
                break
        if tag in VOID:
            continue
        label, marked, named = marks(found["attributes"])
        above = stack[-1] if stack else ("", -1, False)
        able = tag not in ("html", "body", "article", "main") or tag == "article" and inside["article"] > 0
        dropped = above[2] or marked and able or tag in ASIDE or tag == "header" and not inside["article"]
        if above[0] == "header" and inside["article"] and tag not in HEADINGS and tag not in ("div", "hgroup", "header", "section"):
            dropped = dropped or tag in BLOCK
        if tag in inside:
            inside[tag] += 1
        path = out.tokens[above[1]] if stack else WHOLE
        stack.append((tag, len(out.tokens), dropped))
        out.tokens.append(token(str(path), "<", tag, DIGITS.sub("0", label)))
        out.parents.append(above[1])
        out.kinds.append(MARKS.get(tag, OTHER))
        out.named.append(named and able)
        place += 1
        out.places.append(place)
    if at < len(page):
        text(page[at:])
    flush()
    return out


def main_slots(tags: dict[int, tuple[int, int, int]]) -> tuple[set[int], set[int]]:
    """Tokens of the elements whose slots are the main text, and of articles that are not, out of all elements (token:
    token around it, kind, plain characters of its slots). Marks name the main slot if they hold enough of the text; an
    article with little of it is a teaser or a card. Without marks that do, all slots are main: the token `WHOLE`."""
    def outermost(kind: int) -> dict[int, int]:
        """Elements of a kind that are in no other of it, with their sizes."""
        known = {WHOLE: False}
        for t in tags:
            way = []
            while t not in known:
                way.append(t)
                t = tags[t][0]
            covered = known[t] or t != WHOLE and tags[t][1] == kind
            for x in reversed(way):
                known[x] = covered
                covered = covered or tags[x][1] == kind
        return {t: size for t, (_, k, size) in tags.items() if k == kind and not known[t]}

    articles = outermost(ARTICLE)
    for marked in (articles, outermost(MAIN)):
        if marked and sum(marked.values()) >= MARKED * tags[WHOLE][2]:
            main = {t for t, size in marked.items() if size >= MARKED * max(marked.values())}
            return main, set(articles) - main
    return {WHOLE}, set(articles)


def main_text(page: str, template: frozenset[int], main: frozenset[int] = frozenset(), lesser: frozenset[int] = frozenset(),
              held: frozenset[int] = frozenset(), left: frozenset[int] = frozenset()) -> str:
    """The blocks of the main slots in page order, without the host's template text.

    `main` and `lesser` are the host's `main_slots`, `held` and `left` say what its elements named as something else are; a page that has none of the main ones is judged by its own elements.
    Lists of links are no text where no mark names the slot.
    """
    found = parse(page)
    found.leave(template, held | main, left)
    if WHOLE not in main and main.isdisjoint(found.tokens):
        sizes = found.sizes(template)
        tags = {WHOLE: (WHOLE, OTHER, sizes[-1])}
        for t, parent, kind, size in zip(found.tokens, found.parents, found.kinds, sizes):
            tags[t] = (found.tokens[parent] if parent >= 0 else WHOLE, kind, size + (tags[t][2] if t in tags else 0))
        main, lesser = main_slots(tags)
    whole = WHOLE in main
    kept = [False] * len(found.tokens) + [whole]
    for k, (t, parent) in enumerate(zip(found.tokens, found.parents)):
        kept[k] = t in main or t not in lesser and kept[parent]
    return "\n".join(b.text for b in found.blocks if kept[b.at] and not b.dropped and b.token not in template
                     and (not whole or b.linked <= LINKED * len(b.text)))


def host_of(url: str) -> Column:
    """Lower-cased host of an address, empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), HOST, 1), F.lit("")))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, kind, token around it) with the sums over pages of occurrence times the page's number, pages, first places,
    plain characters in it and what `leave` says of it (1 or -1), summed by batch; the vector sums wrap around. `WHOLE` stands for the page itself."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            number = int(mix(np.array([token(page)], dtype=np.int64).view(np.uint64), 5)[0])
            found = parse(page)
            said = found.leave()
            sizes = found.sizes(frozenset())
            mine = {WHOLE: [OTHER, WHOLE, 1, 0, sizes[-1]]}
            for t, parent, kind, place, size in zip(found.tokens, found.parents, found.kinds, found.places, sizes):
                seen = mine.setdefault(t, [kind, found.tokens[parent] if parent >= 0 else WHOLE, 0, place, 0])
                seen[2] += 1
                seen[4] += size
            for b, place in zip(found.blocks, found.block_places):
                seen = mine.setdefault(b.token, [TEXT, found.tokens[b.at] if b.at >= 0 else WHOLE, 0, place, 0])
                seen[2] += 1
                seen[4] += b.plain
            for t, (kind, parent, times, place, size) in mine.items():
                total = sums.setdefault((host, t), [kind, parent, 0, 0, 0, 0, 0])
                total[2] = (total[2] + number * times) & 0xFFFFFFFFFFFFFFFF
                total[3] += 1
                total[4] += place
                total[5] += size
                if t in said:
                    total[6] += 1 if said[t] else -1
        if not sums:
            continue
        columns = list(zip(*sums.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in sums], pa.string()), pa.array([t for _, t in sums], pa.int64()), pa.array(columns[0], pa.int32()),
             pa.array(columns[1], pa.int64()), pa.array(np.array(columns[2], dtype=np.uint64).view(np.int64)),
             *(pa.array(c, pa.int64()) for c in columns[3:])], names=["host", "token", "kind", "parent", "v", "pages", "place", "size", "said"])


def nest(classes: list[tuple[int, float, float, int]]) -> set[int]:
    """Classes (name, first place, last place, pages) whose spans nest: those on more pages are taken first, and a class
    that begins inside one of them and ends outside is not valid."""
    valid: list[tuple[float, float]] = []
    out = set()
    for name, first, last, _ in sorted(classes, key=lambda c: (-c[3], c[1] - c[2], c[0])):
        if all(a <= first and last <= b or first <= a and b <= last or last < a or b < first for a, b in valid):
            valid.append((first, last))
            out.add(name)
    return out


def _template(frame: pd.DataFrame) -> pd.DataFrame:
    """A host's template: text tokens of its valid classes, and which of their elements hold the main slots if any of them is
    marked. Its size is bounded by the length of the host's pages."""
    frame = frame.assign(at=frame["place"] / frame["pages"])
    classes = frame.groupby("v").agg(first=("at", "min"), last=("at", "max"), pages=("pages", "max"))
    valid = nest(list(classes.itertuples(name=None)))
    frame = frame[frame["v"].isin(list(valid))]
    texts = frame[frame["kind"] == TEXT]
    elements = frame[frame["kind"] != TEXT].set_index("token")
    size, parent, kind = elements["size"].to_dict(), elements["parent"].to_dict(), elements["kind"].to_dict()
    for around, chars in zip(texts["parent"], texts["size"]):  # template text is in no slot
        while around in size:
            size[around] -= chars
            if around == WHOLE:
                break
            around = parent[around]
    main: set[int] = set()
    lesser: set[int] = set()
    if WHOLE in size and any(k in (ARTICLE, MAIN) for k in kind.values()):
        # an element around a valid one that is itself in no valid class is passed over
        main, lesser = main_slots({t: (parent[t] if parent[t] in size else WHOLE, kind[t], size[t]) for t in size})
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "template": [sorted(int(t) for t in texts["token"])],
                         "main": [sorted(int(t) for t in main)], "lesser": [sorted(int(t) for t in lesser)],
                         "held": [sorted(int(t) for t in elements.index[elements["said"] < 0])],
                         "left": [sorted(int(t) for t in elements.index[elements["said"] > 0])], "classes": [len(valid)]})


def templates(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """`host`, `template` (its text tokens), `main` and `lesser` (its `main_slots`), `held` and `left` (elements named as something
    else that mostly hold the main text, or do not), `classes` of every host with enough pages.

    Copies of a page on a host weigh once."""
    shipped(pages.sparkSession)
    page = F.coalesce(F.col(html), F.lit(""))
    known = pages.select(host_of(url).alias("host"), F.unhex(F.sha2(page, 256)).alias("digest"), page.alias("page")).where("host <> ''")
    counted = known.select("host", "digest").distinct().groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") >= PAGES)
    distinct = known.groupBy("host", "digest").agg(F.first("page").alias("page"))
    seen = distinct.select("host", "page").mapInArrow(_vectors, "host string, token long, kind int, parent long, v long, pages long, place long, size long, said long") \
        .groupBy("host", "token", "kind", "parent") \
        .agg(_wrapping_sum("v").alias("v"), F.sum("pages").alias("pages"), F.sum("place").alias("place"), F.sum("size").alias("size"),
             F.sum("said").alias("said")) \
        .where(F.col("pages") >= PAGES)
    return seen.join(counted, "host").where(F.col("pages") >= SUPPORT * F.col("n")).drop("n") \
        .groupBy("host").applyInPandas(_template, "host string, template array<long>, main array<long>, lesser array<long>, held array<long>, "
                                                  "left array<long>, classes int")


def _wrapping_sum(name: str) -> Column:
    """Sum modulo 2 ** 64 of its halves, so that no sum overflows."""
    low = F.sum(F.col(name).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))
    high = F.sum(F.shiftrightunsigned(name, 32))
    carried = (high + F.shiftrightunsigned(low, 32)).bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return F.shiftleft(carried, 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))


def extract(pages: DataFrame, *, url: str = "url", html: str = "html", out: str = "main_text") -> DataFrame:
    """`pages` with the text column `out`, empty if a page has no main text.

    Character references are decoded, white space inside a block is one space, blocks are joined by a line feed. Text of the
    host's template goes on every page. Of the slots, the main ones stay: those of article or main elements if they hold enough
    of the host's text (of the page's, where the host has no such template), else all but those of lesser articles and link
    lists; what is marked as something else inside goes. A null page is empty; a null or odd address has no host and no template; repeated rows are each answered; a column already
    called `out` is replaced; an empty table gives an empty result.
    """
    shipped(pages.sparkSession)
    found = staged(templates(pages, url=url, html=html))  # read again, so Spark knows its size: small ones are broadcast

    @F.arrow_udf("string")
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for page, *known in batches:
            rows = zip(page.to_pylist(), *(k.to_pylist() for k in known))
            yield pa.array([main_text(p, *(frozenset(k or ()) for k in of)) if p else "" for p, *of in rows], pa.string())

    named = pages.drop(out).withColumn("_host", host_of(url))
    parts = ["template", "main", "lesser", "held", "left"]
    joined = named.join(found.select(F.col("host").alias("_host"), *(F.col(p).alias(f"_{p}") for p in parts)), "_host", "left")
    return joined.withColumn(out, run.asNondeterministic()(F.col(html), *(F.col(f"_{p}") for p in parts))) \
        .drop("_host", *(f"_{p}" for p in parts))
