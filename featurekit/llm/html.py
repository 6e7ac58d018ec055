"""HTML extraction by equivalence-class template deduction.

A page is read as a sequence of tokens: its elements, each as the path of open elements (names and classes), and the block texts
at their paths.  Tokens of a host that have the same occurrence vector (how often on which page) form an equivalence class;
vectors are compared by the sum of hashed (page, count) pairs, which Spark adds up like any other aggregate, so no host's pages
ever meet in one task.  Pages with the same blocks count once, so copies of an article are no template.

Classes with ``MIN_TOKENS`` tokens on ``MIN_PAGES`` pages, and on ``MIN_SHARE`` of the host's, are looked up on every page again.
A class is *ordered* if its tokens come there as repetitions of one sequence, and *nested* if each repetition lies between two
successive tokens of one repetition of another class, the same two on all pages (or in none).  Classes for which all pages agree
are valid, and nest into the host's template; what stands between two successive template tokens is a slot.

Text is what the slots hold, in page order, less

* template texts: block texts that are tokens of a valid class;
* elements that aren't article text by their name, ``role``, ``hidden`` or ``aria-hidden`` (menus, headers, footers, sidebars, forms, scripts ...);
* slots of the template, outside ``article`` and ``main``, that hold links for ``MAX_LINKS`` of their text over all pages: menus of any name;
* elements whose class or id says as much (:func:`says_aside`).  Words only break ties: every word of the name must be known, and an element
  that holds half of the text that is left otherwise stays, whatever its name.

If a page has an ``article`` or ``main``, only slots inside count.  Hosts with few pages have no template; the rest holds for them as well.

Pages are never shuffled unless the templates (a few hashes per host) are too large to broadcast.  NULL and
empty html give an empty text; repeated rows give the same text again.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.llm.common import durable, maybe_broadcast, table

MIN_PAGES = 5
MIN_TOKENS = 2
MIN_SHARE = 0.5
MAX_LINKS = 0.8

BLOCKS = frozenset(
    "html head body p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd div section article main header footer nav aside form fieldset table thead"
    " tbody tfoot tr td th caption blockquote pre figure figcaption address details summary hr center menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page, read up to their end tag.
RAW = frozenset("script style noscript template iframe svg math textarea title select button object canvas audio video".split())
#: Elements that hold no main text.
ASIDE = frozenset("head nav footer aside form menu dialog fieldset".split())
#: Words of class and id that may say the same (fixed values) ...
MARKS = frozenset(
    "ad ads adbox advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer"
    " menu modal nav navbar navigation newsletter notice notices pager pagination popup promo related replies share sharing sidebar social"
    " sponsor sponsored subscribe toolbar masthead".split())
#: ... if beside them there are only such of layout.
LAYOUT = frozenset(
    "area articles bar block body bottom box buttons col column container content first footer global group header holder inner item items last left"
    " links list main menu outer page panel post posts primary region right row secondary section side site slot small sticky sub top unit"
    " widget widgets wrap wrapper zone".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form toolbar".split())
#: Start tags that end an open element of the given names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"""
                  r"""((?:[^>"'<]|"[^"<]*+"|'[^'<]*+')*+>|[^>]*>?)""", re.S)
_ATTRS = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Block(NamedTuple):
    path: str
    text: str
    aside: bool              # by an element's name or attributes
    inside: bool             # article or main
    marked: tuple[int, ...]  # open elements whose class or id may set them aside, by their number on the page
    links: int               # characters of the text inside links


def says_aside(value: str, inside: bool = False) -> bool:
    """Whether a class or id is made of MARKS and LAYOUT words alone, with one of MARKS (outside articles, "header" is one); numbers don't count."""
    words = [w for w in (x.lower() for x in _WORDS.findall(value)) if not w.isdigit()]
    marks = MARKS if inside or not MARKS else MARKS | {"header"}
    return any(w in marks for w in words) and all(w in marks or w in LAYOUT for w in words)


def _element(name: str, attrs: str, inside: bool) -> tuple[bool, bool, str]:
    """Whether an element is set aside by name or attribute, whether its class or id says so, and its name for the path."""
    aside, says, label = name in ASIDE or (name == "header" and not inside), False, name
    if len(attrs) > 1:
        for key, value in _ATTRS.findall(attrs):
            key, value = key.lower(), html.unescape(value[1:-1] if value[:1] in "\"'" else value)
            if key == "hidden" or (key == "aria-hidden" and value.strip().lower() == "true"):
                aside = True
            elif key == "role":
                aside |= value.strip().lower() in ROLES
            elif key == "id":
                says |= says_aside(value, inside)
            elif key == "class":
                names = value.split()
                says |= any(says_aside(x, inside) for x in names)
                label += "." + ".".join(sorted(names))
    return aside, says, label


def read_page(page: str | None) -> list[tuple[str, Block | None, bool]]:
    """(path, None, inside) of every element that begins, and (path, block, inside) of every block with text, in page order."""
    page, out, at = page or "", [], 0
    stack: list[tuple[str, bool, bool, str, tuple[int, ...]]] = []      # name, set aside, inside article or main, path, marked
    text: list[tuple[str, bool]] = []
    unclosed: set[str] = set()
    number = linked = 0

    def flush() -> None:
        if text:
            if words := " ".join(html.unescape("".join([t for t, _ in text])).split()):
                links = sum(len(t.strip()) for t, link in text if link)
                _, aside, inside, path, marked = stack[-1] if stack else ("", False, False, "", ())
                out.append((path, Block(path, words, aside, inside, marked, min(links, len(words))), inside))
            text.clear()

    while m := _TAG.search(page, at):
        if m.start() > at:
            text.append((page[at:m.start()], linked > 0))
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if name == "a":
            linked = max(0, linked - 1) if m[1] else 1
        if m[1]:
            if name in BLOCKS:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        del stack[i:]
                        break
        elif name in RAW:
            if not m[3].endswith("/>") and name not in unclosed:
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name in ("script", "style"):
                    at = len(page)
                else:
                    unclosed.add(name)
            text.append((" ", False))
        elif name == "br":
            text.append((" ", False))
        elif name in BLOCKS:
            flush()
            if name in VOID:
                continue
            shut = CLOSES.get(name, ())
            while stack and (stack[-1][0] == "p" or stack[-1][0] in shut):
                stack.pop()
            _, aside, inside, path, marked = stack[-1] if stack else ("", False, False, "", ())
            own, says, label = _element(name, m[3] or "", inside)
            aside, number, path = aside or own, number + 1, f"{path}/{label}"
            stack.append((name, aside, inside or (name in ("article", "main") and not aside), path, (*marked, number) if says else marked))
            out.append((path, None, stack[-1][2]))
    text.append((page[at:], linked > 0))
    flush()
    return out


def blocks(page: str | None) -> list[Block]:
    return [b for _, b, _ in read_page(page) if b]


def _host(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return (m[1] if m else "").lower()


def _token(path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{path}\n{text}") - (1 << 63)


def page_tokens(page: str | None) -> list[tuple[int, Block | None, bool]]:
    """As :func:`read_page`, with the token in place of the path."""
    return [(_token(path, b.text) if b else _token(path), b, inside) for path, b, inside in read_page(page)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(url, html) -> (host, page, token, count): elements and block texts of each page."""
    for b in batches:
        cols: tuple[list, ...] = ([], [], [], [])
        for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            found, host = page_tokens(page), _host(url)
            own = xxhash.xxh64_intdigest("\n".join(sorted(f"{x.path}\t{x.text}" for _, x, _ in found if x))) - (1 << 63)
            for key, n in Counter(t for t, _, _ in found).items():
                for c, v in zip(cols, (host, own, key, n), strict=True):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.int64(), pa.int32()), strict=True)], ["host", "page", "token", "n"])


def follow(tokens: list[int], class_of: dict[int, int]) -> tuple[dict[int, str | None], list[tuple[int, int] | None]]:
    """What a page says of each class, and the slot that each token stands in.

    Of a class: the sequence that its tokens repeat and the slot that all repetitions stand in, as text; None if there is no such
    sequence or slot.  A slot is (class, place): after the token at that place of the sequence, in a repetition that is open.
    """
    seen: dict[int, list[int]] = {}
    for t in tokens:
        if (c := class_of.get(t)) is not None:
            seen.setdefault(c, []).append(t)
    cycles: dict[int, list[int] | None] = {}
    for c, own in seen.items():
        size = own.index(own[0], 1) if own[0] in own[1:] else len(own)
        cycle = own[:size]
        cycles[c] = cycle if len(set(cycle)) == size and len(own) % size == 0 and own == cycle * (len(own) // size) else None
    open_: list[list[int]] = []                                  # class, place in its sequence
    parent: dict[int, set] = {}
    slots: list[tuple[int, int] | None] = []
    for t in tokens:
        c = class_of.get(t)
        if c is not None and (cycle := cycles[c]):
            at = cycle.index(t)
            if at == 0:
                while open_ and open_[-1][0] == c or open_ and open_[-1][1] == len(cycles[open_[-1][0]]) - 1 and any(x[0] == c for x in open_):
                    open_.pop()                                  # its last repetition, and complete ones inside it
                parent.setdefault(c, set()).add(tuple(open_[-1]) if open_ else None)
                open_.append([c, 0])
            else:
                while open_ and open_[-1][0] != c and open_[-1][1] == len(cycles[open_[-1][0]]) - 1:
                    open_.pop()                                  # complete repetitions end with the token around them
                if [c, at - 1] in open_:
                    while open_[-1] != [c, at - 1]:
                        cycles[open_.pop()[0]] = None            # still open inside: it overlaps this class
                    open_[-1][1] = at
                else:
                    cycles[c] = None
                    open_ = [x for x in open_ if x[0] != c]
        slots.append(tuple(open_[-1]) if open_ else None)
    said = {c: f"{cycle} {next(iter(parent[c]))}" if (cycle := cycles[c]) and len(parent.get(c, ())) == 1 else None for c in seen}
    return said, slots


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html, tokens, classes) -> what each page says of each class, and the text and links of its slots outside article and main."""
    for b in batches:
        cols: tuple[list, ...] = ([], [], [], [], [], [])
        for host, page, tokens, classes in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            found = page_tokens(page)
            said, slots = follow([t for t, _, _ in found], dict(zip(tokens, classes, strict=True)))
            held: dict[tuple, list[int]] = {}
            for (_, block, inside), slot in zip(found, slots, strict=True):
                if block and slot and not inside:
                    own = held.setdefault(slot, [0, 0])
                    own[0] += len(block.text)
                    own[1] += block.links
            rows = [(host, c, -1, text, 0, 0) for c, text in said.items()] + [(host, c, at, None, n, links) for (c, at), (n, links) in held.items()]
            for row in rows:
                for col, v in zip(cols, row, strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            cols, (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["host", "class", "place", "said", "chars", "links"])


def templates(pages: DataFrame) -> DataFrame:
    """``host, tokens, classes, menus``: tokens of the valid classes of each host and their class, and the slots of links as (class, place); materialised."""
    seen = (pages.select("url", "html").mapInArrow(_counts, "host string, page long, token long, n int")
            .groupBy("host", "token", "page").agg(F.first("n").alias("n")))     # pages with the same blocks once
    tokens = durable(seen.groupBy("host", "token").agg(
        F.count("*").alias("pages"), F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"))
        .where(F.col("pages") >= MIN_PAGES))
    whole = tokens.groupBy("host").agg(F.max("pages").alias("all"))
    often = tokens.join(whole, "host").where(F.col("pages") >= MIN_SHARE * F.col("all"))
    classes = often.groupBy("host", "vector").agg(F.count("*").alias("size"), F.min("token").alias("class")).where(F.col("size") >= MIN_TOKENS)
    member = durable(often.join(classes, ["host", "vector"]).select("host", "token", "class"))
    lists = lambda rows: rows.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("token", "class"))).alias("x")).select(
        "host", F.col("x.token").alias("tokens"), F.col("x.class").alias("classes"))
    judged = durable(_with_templates(pages, lists(member)).select("host", "html", "tokens", "classes").where("tokens is not null").mapInArrow(
        _judge, "host string, class long, place int, said string, chars long, links long")
        .groupBy("host", "class", "place").agg(F.count_distinct("said").alias("kinds"), F.count("*").alias("n"), F.count("said").alias("known"),
                                               F.sum("chars").alias("chars"), F.sum("links").alias("links")))
    valid = judged.where((F.col("place") < 0) & (F.col("kinds") == 1) & (F.col("n") == F.col("known"))).select("host", "class")
    menus = (judged.where((F.col("place") >= 0) & (F.col("chars") > 0) & (F.col("links") >= MAX_LINKS * F.col("chars"))).join(valid, ["host", "class"])
             .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("class", "place"))).alias("menus")))
    return durable(lists(member.join(valid, ["host", "class"])).join(menus, "host", "left"))


def _with_templates(pages: DataFrame, own: DataFrame) -> DataFrame:
    """Pages with the columns of their host's row of ``own``."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    own = durable(own)
    return pages.withColumn("host", host).join(maybe_broadcast(own, 4000), "host", "left")


def main_text(page: str | None, class_of: dict[int, int] | None = None, menus: frozenset = frozenset()) -> str:
    class_of = class_of or {}
    found = page_tokens(page)
    slots = follow([t for t, _, _ in found], class_of)[1] if class_of else [None] * len(found)
    left = [b for (t, b, inside), slot in zip(found, slots, strict=True)
            if b and not b.aside and t not in class_of and (inside or slot not in menus)]
    if any(b.inside for b in left):
        left = [b for b in left if b.inside]
    size: Counter = Counter()
    for b in left:
        size.update(dict.fromkeys(b.marked, len(b.text)))
    half = sum(len(b.text) for b in left) / 2
    return "\n".join(b.text for b in left if all(size[m] >= half for m in b.marked))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, known = [], {}
        for host, page, tokens, classes, menus in zip(*(b.column(i).to_pylist() for i in range(2, 7)), strict=True):
            if host not in known:
                known = {host: (dict(zip(tokens or (), classes or (), strict=True)), frozenset((x["class"], x["place"]) for x in menus or ()))}
            texts.append(main_text(page, *known[host]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                          pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))], ["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    pages = pages.select("page_id", "url", "html")
    rows = _with_templates(pages, templates(pages)).select("page_id", "url", "host", "html", "tokens", "classes", "menus")
    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars long")


def op6_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
