"""Main text of web pages by wrappers that are inferred for each host.

Pages of one host come from a few templates. Pages with the same parts outside the article are one layout. For a bounded
sample of each layout's pages the token streams (tags and texts) are aligned one after the other to a union-free regular
expression: equal tokens stay, tandem repeats become repeated groups, what only some pages have becomes optional, and
differing texts become slots. Every page is then matched whole against the expression of its layout, which gives the slot
of each of its texts, and all pages confirm what a slot carries: a text is the template's own where ``SAME`` of the pages
that fill the slot (or, over all layouts of the host, that have the part of the page) show it. Pages that tell the same
article count once. Elements and names of parts are what is believed beforehand: varying texts of parts such as navigation
stay out, since no expression tells a varying link from a varying sentence. Within an article or main part a text that pages
repeat may be the article's (a heading such as "Method", a refrain): it goes only with more pages (``ARTICLE_PAGES``) and where it
is no heading and stands before or after everything that varies in the article, or is mostly links; and names of parts count
there only as whole class names of parts, not of paragraphs. Parts named like a main part are the text of a page without an article
where they hold most of it.

Defined cases: a null or empty html has an empty text. Unclosed and wrongly nested elements close with the part around
them; an unclosed comment or script runs to the end. Hosts with one page have a wrapper without slots, and structure
alone decides. Rows that repeat are extracted each. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright.llm.common import settle
from casewright.llm.url_filter import host_of

#: Pages of a layout that propose its expression; all of its pages confirm it.
WRAPPER_PAGES = 8
#: Different pages that must show a text before it can be the template's own, within an article and elsewhere, and their
#: share among the pages that fill the slot.
ARTICLE_PAGES, OTHER_PAGES, SAME = 8, 3, 0.9
#: Cells of the alignment matrix, in bits, that are held at once.
HELD_BITS = 1 << 26

# Words chosen here for elements and names of parts that are not the article.
SKIPPED = frozenset("nav header footer aside form script style noscript template button select textarea svg iframe menu "
                    "dialog head title object canvas audio video datalist math".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PARTS = frozenset("html body div section article main nav header footer aside form ul ol dl table tbody thead tfoot tr td th "
                  "figure blockquote fieldset menu dialog button select details object canvas audio video datalist "
                  "center head noscript svg".split())
BLOCKS = PARTS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr figcaption caption address summary legend option".split())
NAMES = frozenset("nav navbar navigation menu header masthead footer sidebar side aside ad ads advert adverts advertisement "
                  "adsense sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr popup modal "
                  "overlay newsletter subscribe signup comment comments disqus respond reply replies share sharing social "
                  "related recommended recommendations breadcrumb breadcrumbs pagination pager widget widgets toolbar login "
                  "search copyright skip alert".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MAIN = frozenset("article main".split())
MAIN_NAMES = frozenset("article content main post entry story body text page".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, detail): ("open", tag, attributes), ("close", tag, ""), ("text", "", raw text)."""
    at, end = 0, len(page)
    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at:found.start()]
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                yield "text", "", found[0][9:-3] if found[0].endswith("]]>") else found[0][9:]
            continue
        if found[1] or found[4]:
            yield "close", name, ""
            continue
        detail = found[3] if found[2] else found[6]
        yield "open", name, detail or ""
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}\\b", re.I).search(page, at)
            at = close.start() if close else end


@lru_cache(10_000)
def described(name: str, detail: str) -> tuple[str, bool, bool, bool]:
    """(label, skipped, named like the main part, skipped also within an article) of a part of the page."""
    if not detail.strip():
        return name, name in SKIPPED, name in MAIN, name in SKIPPED
    words: set[str] = set()
    whole: set[str] = set()
    skipped, label = name in SKIPPED, name
    for key, value in _ATTRIBUTE.findall(detail):
        key, value = key.lower(), unescape(value.strip("\"'"))
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            skipped = True
        elif key == "style":
            skipped |= "display:none" in value.replace(" ", "").lower()
        elif key == "role":
            skipped |= bool(ROLES & set(value.lower().split()))
            words |= {"main"} & set(value.lower().split())
        elif key in ("class", "id"):
            words |= set(_WORD.findall(_CAMEL.sub(" ", value).lower()))
            whole |= set(value.lower().split())
            label += f".{value}" if key == "class" else f"#{value}"
    named = bool(NAMES & words) and name not in MAIN and name not in ("html", "body")
    return (label, skipped or named, name in MAIN or bool(words & MAIN_NAMES) and name in PARTS,
            skipped or (named and name in PARTS and bool(NAMES & whole)))


@dataclass
class Block:
    """A text block with the part that it stands in."""

    path: str
    text: str
    parts: list[str]
    skipped: bool
    article: bool
    main: bool
    heading: bool
    linked: int
    numbers: list[int]  # places of the parts among the texts of the page


def blocks(page: str) -> Iterator[Block]:
    """The text blocks of a page in order."""
    stack: list[tuple[str, str, bool, bool, bool]] = []  # tag, path, skipped, inside article or main, inside main-like
    here = ("", "", False, False, False)
    held: list[str] = []
    linked = number = 0
    heading = link = titled = False

    def flush() -> Iterator[Block]:
        nonlocal linked, number, titled
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                skipped = here[2] and not (heading and here[0] == "header" and here[3])
                parts = [p for p in (" ".join(unescape(h).split()) for h in held) if p]
                yield Block(here[1], text, parts, skipped, here[3], here[4], titled, linked, [*range(number, number + len(parts))])
                number += len(parts)
            held.clear()
        linked, titled = 0, False

    for kind, name, detail in tokens(page):
        if kind == "text":
            if name not in RAW:
                held.append(detail)
                titled |= heading
                if link:
                    linked += len(detail)
            continue
        if name in BLOCKS:
            yield from flush()
        elif name == "br":
            held.append(" ")
        if kind == "open":
            if name in HEADINGS:
                heading = True
            elif name == "a":
                link = True
            if name in PARTS or name in RAW or name == "li":
                if name in VOID:
                    continue
                if name == "li" and here[0] == "li":
                    here = stack.pop()
                label, skipped, main, strict = described(name, detail)
                skipped = strict if here[3] else skipped
                path = f"{here[1]}/{label}".removeprefix("/") if name in PARTS else here[1]
                stack.append(here)
                inner = name in MAIN or here[3]
                own_header = name == "header" and here[3]
                here = (name, path, here[2] or skipped or own_header, inner and not skipped or inner and own_header,
                        main or here[4])
            elif _has_mark(detail):
                _, skipped, _, strict = described(name, detail)
                if (strict if here[3] else skipped) and name not in VOID:
                    stack.append(here)
                    here = (name, here[1], True, here[3], here[4])
        else:
            if name in HEADINGS:
                heading = False
            elif name == "a":
                link = False
            if any(s[0] == name for s in stack) or here[0] == name:
                while here[0] != name and stack:
                    here = stack.pop()
                if stack and here[0] == name:
                    here = stack.pop()
    yield from flush()


def _has_mark(detail: str) -> bool:
    return "class" in detail or "id=" in detail or "hidden" in detail or "role" in detail or "style" in detail


# -- wrappers --------------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """An element of the expression: a tag, a text slot, or a group; ``key`` says what it aligns with."""

    key: str
    kind: str
    body: list[Node] = field(default_factory=list)
    texts: set[str] = field(default_factory=set)
    numbers: list[int] = field(default_factory=list)  # places of the texts among those of the page
    seen: int = 1
    optional: bool = False

    def pattern(self) -> str:
        inner = " ".join(n.pattern() for n in self.body)
        out = {"repeat": f"({inner})+", "slot": "#TEXT"}.get(self.kind, self.key)
        return f"({out})?" if self.optional else out


def stream(page: str) -> list[Node]:
    """The whole token stream of a page, tandem repeats folded."""
    out: list[Node] = []
    path: list[tuple[str, str]] = []  # tag and path of the open parts
    number = 0
    for kind, name, detail in tokens(page):
        if kind == "text":
            text = " ".join(unescape(detail).split())
            if text:
                out.append(Node("#TEXT " + (path[-1][1] if path else ""), "slot", texts={text}, numbers=[number]))
                number += 1
        elif name in PARTS:
            label = described(name, detail)[0] if kind == "open" else name
            if kind == "open":
                path.append((name, f"{path[-1][1]}/{label}" if path else label))
            elif any(tag == name for tag, _ in path):
                while path.pop()[0] != name:
                    pass
            out.append(Node(("/" if kind == "close" else "") + label, "tag"))
        else:
            out.append(Node(("/" if kind == "close" else "") + name, "tag"))
    return folded(out)


def folded(nodes: list[Node], longest: int = 8) -> list[Node]:
    """Adjacent equal groups of up to ``longest`` elements become one repeated group, shortest groups first."""
    for width in range(1, longest + 1):
        out: list[Node] = []
        at, size, keyed = 0, len(nodes), [n.key for n in nodes]
        while at < size:
            if at + width >= size or keyed[at + width] != keyed[at]:
                out.append(nodes[at])
                at += 1
                continue
            times = 1
            first = nodes[at: at + width]
            keys = [n.key for n in first]
            while len(first) == width and [n.key for n in nodes[at + times * width: at + (times + 1) * width]] == keys:
                for a, b in zip(first, nodes[at + times * width: at + (times + 1) * width], strict=True):
                    _joined(a, b)
                times += 1
            if times > 1 and not (width == 1 and first[0].kind == "repeat"):
                out.append(Node("(" + " ".join(keys) + ")+", "repeat", first))
                at += times * width
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def _joined(a: Node, b: Node) -> Node:
    a.texts |= b.texts
    a.numbers += b.numbers
    for x, y in zip(a.body, b.body, strict=False):
        _joined(x, y)
    return a


def repeats(nodes: list[Node]) -> dict[str, list[str]]:
    """The keys of the repeated groups, with the keys of their elements; inner groups before outer ones."""
    out: dict[str, list[str]] = {}
    for node in nodes:
        if node.kind == "repeat":
            out |= repeats(node.body)
            out[node.key] = [n.key for n in node.body]
    return out


def gathered(nodes: list[Node], known: dict[str, list[str]]) -> list[Node]:
    """Groups that stand once here and are known to repeat elsewhere become repeated groups too."""
    for key, keys in known.items():
        out: list[Node] = []
        at = 0
        while at < len(nodes):
            width = len(keys)
            if nodes[at].key == keys[0] and [n.key for n in nodes[at: at + width]] == keys:
                out.append(Node(key, "repeat", nodes[at: at + width]))
                at += width
            else:
                out.append(nodes[at])
                at += 1
        nodes = out
    return nodes


def _lengths(a: list[str], places: dict[str, int], width: int) -> Iterator[int]:
    """Rows of the matrix of longest common subsequences as bits: a zero where the length grows by one."""
    every = (1 << width) - 1
    row = every
    for key in a:
        here = row & places.get(key, 0)
        row = ((row + here) | (row - here)) & every
        yield row


def _places(b: list[str]) -> dict[str, int]:
    at: dict[str, list[int]] = {}
    for j, key in enumerate(b):
        at.setdefault(key, []).append(j)
    out = {}
    for key, listed in at.items():
        bits = bytearray(len(b) // 8 + 1)
        for j in listed:
            bits[j >> 3] |= 1 << (j & 7)
        out[key] = int.from_bytes(bits, "little")
    return out


def _growth(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _lengths(a, _places(b), len(b)):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(bits == 0)]


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of whole streams; halved while the matrix exceeds ``HELD_BITS``."""
    first, end_a, end_b = 0, len(a), len(b)
    while first < min(end_a, end_b) and a[first] == b[first]:
        first += 1
    while min(end_a, end_b) > first and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    out = [(i, i) for i in range(first)]
    x, y = a[first:end_a], b[first:end_b]
    if len(x) * len(y) > HELD_BITS and len(x) > 1:
        half = len(x) // 2
        cut = int((_growth(x[:half], y) + _growth(x[half:][::-1], y[::-1])[::-1]).argmax())
        inner = common(x[:half], y[:cut]) + [(i + half, j + cut) for i, j in common(x[half:], y[cut:])]
    else:
        rows = list(_lengths(x, _places(y), len(y)))
        inner = []
        i, j = len(x), len(y)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                inner.append((i, j))
        inner.reverse()
    out += [(i + first, j + first) for i, j in inner]
    return out + [(end_a + i, end_b + i) for i in range(len(a) - end_a)]


def aligned(wrapper: list[Node], page: list[Node]) -> list[Node]:
    """The wrapper widened to match one more page: what one of them lacks becomes optional."""
    out: list[Node] = []
    page = gathered(page, repeats(wrapper))
    wrapper = gathered(wrapper, repeats(page))
    i = j = 0
    for a, b in [*common([n.key for n in wrapper], [n.key for n in page]), (len(wrapper), len(page))]:
        for node in (*wrapper[i:a], *page[j:b]):
            node.optional = True
            out.append(node)
        if a < len(wrapper):
            _joined(wrapper[a], page[b]).seen += 1
            out.append(wrapper[a])
        i, j = a + 1, b + 1
    return out


def inferred(pages: list[str]) -> tuple[list[Node], set[tuple[str, str]]]:
    """The wrapper of some pages of a host, and its own texts with the part of the page they stand in: those of slots
    that are the same in all of at least three pages."""
    wrapper: list[Node] = []
    for n, page in enumerate(pages):
        now = stream(page)
        wrapper = aligned(wrapper, now) if n else now
    own: set[tuple[str, str]] = set()

    def look(nodes: list[Node], seen: int | None = None) -> None:
        for node in nodes:
            times = node.seen if seen is None else seen
            if node.kind == "slot" and len(node.texts) == 1 and times == len(pages) >= 3:
                own.add((node.key.removeprefix("#TEXT "), *node.texts))
            look(node.body, times if node.kind == "repeat" else seen)

    look(wrapper)
    return wrapper, own


def written(nodes: list[Node]) -> str:
    """The expression as a text that ``Wrapper`` reads."""
    plain = lambda listed: [plain(n.body) if n.kind == "repeat" else n.key for n in listed]
    return json.dumps(plain(nodes), ensure_ascii=False, separators=(",", ":"))


class Wrapper:
    """An expression that pages are matched against; pages of equal structure are aligned once."""

    def __init__(self, expression: str | None) -> None:
        self.slots = 0
        self.nodes = [self._read(item) for item in json.loads(expression or "[]")]
        self.keys = [n.key for n, _ in self.nodes]
        self.known = repeats([n for n, _ in self.nodes])
        self.matched: dict[tuple[str, ...], list[tuple[int, int]]] = {}

    def _read(self, item: str | list) -> tuple[Node, list]:
        """A node with the numbers of its slots: a number, or a list for a group."""
        if isinstance(item, list):
            body = [self._read(i) for i in item]
            key = "(" + " ".join(n.key for n, _ in body) + ")+"
            return Node(key, "repeat", [n for n, _ in body]), [numbers for _, numbers in body]
        if not item.startswith("#TEXT"):
            return Node(item, "tag"), []
        self.slots += 1
        return Node(item, "slot"), [self.slots - 1]

    def match(self, page: str) -> dict[int, int]:
        """The slot of each text of the page, by its place among the texts; texts beside the expression have none."""
        nodes = gathered(stream(page), self.known)
        keys = tuple(n.key for n in nodes)
        if keys not in self.matched:
            if len(self.matched) >= 200:
                self.matched.clear()
            self.matched[keys] = common(self.keys, list(keys))
        out: dict[int, int] = {}

        def fill(node: Node, slots: list) -> None:
            if node.kind == "repeat":
                for inner, numbers in zip(node.body, slots, strict=True):
                    fill(inner, numbers)
            elif node.kind == "slot":
                out.update(dict.fromkeys(node.numbers, slots[0]))

        for i, j in self.matched[keys]:
            fill(nodes[j], self.nodes[i][1])
        return out


def layout(page: str | None) -> int:
    """A number that pages with the same parts outside articles share; figures in names do not count."""
    paths, path, below = set(), [], 0  # tag and label of open parts; how many of them from the outermost article on
    for kind, name, detail in tokens(page or ""):
        if name not in PARTS or kind == "text":
            continue
        if kind == "open":
            below += bool(below or name in MAIN)
            path.append((name, re.sub(r"\d+", "0", described(name, detail)[0]) if not below else name))
            if below <= 1:
                paths.add("/".join(label for _, label in path))
        elif any(tag == name for tag, _ in path):
            while path:
                below = max(below - 1, 0)
                if path.pop()[0] == name:
                    break
    return _number(*sorted(paths))


def _number(*of: object) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(map(str, of)).encode("utf-8", "replace")) >> 1


def placed(page: str, wrapper: Wrapper, shape: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """(number of the text, its text as a number, slot in the layout, part in the host, within an article) of the texts
    that are not left out beforehand."""
    slots = wrapper.match(page)
    for block in blocks(page):
        if block.skipped:
            continue
        for number, text in zip(block.numbers, block.parts, strict=True):
            slot = slots.get(number, -1)
            yield (number, _number(text), _number(shape, slot, block.path, block.article),
                   _number(block.path, block.article), block.article)


def main_text(page: str | None, own: set[int] | frozenset = frozenset()) -> str:
    """The article's blocks, joined by line breaks; ``own`` has the places of the texts that are the template's."""
    if not page:
        return ""
    found = [b for b in blocks(page) if not b.skipped]
    inside = [b for b in found if b.article]
    if inside:
        varies = [n for n, b in enumerate(inside) if not own.issuperset(b.numbers)]
        first, last = (varies[0], varies[-1]) if varies else (len(inside), -1)
        stays = lambda n, b: b.heading or first < n < last and 2 * b.linked <= len(b.text)
        return "\n".join(b.text for n, b in enumerate(inside) if not own.issuperset(b.numbers) or stays(n, b))
    inside = [b for b in found if not own.issuperset(b.numbers)]
    told = lambda listed: sum(len(b.text) - b.linked for b in listed)
    named = [b for b in inside if b.main]
    inside = named if named and 2 * told(named) >= told(inside) else [b for b in inside if 2 * b.linked <= len(b.text)]
    return "\n".join(b.text for b in inside)


def shaped(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host, layout of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes = pa.array([layout(html) for html in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, shapes], ["page_id", "url", "html", "host", "layout"])

    return pages.select(F.col("page_id").cast("long"), "url", "html", F.coalesce(host_of(F.col("url")), F.lit("")).alias(
        "host")).mapInArrow(run, "page_id long, url string, html string, host string, layout long")


def wrappers(pages: DataFrame, sample: int = WRAPPER_PAGES) -> DataFrame:
    """(host, layout, pattern, expression) for each layout of the pages of ``shaped``.

    The sampled pages are those with the smallest hash of the id; each map task sends at most ``sample`` ids a layout.
    """
    keyed = pages.select("page_id", "host", "layout", F.xxhash64("page_id", "url").alias("h"))
    first = Window.partitionBy("host", "layout").orderBy("h", "page_id")
    chosen = settle("wrapper-pages", keyed.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample).select(
        F.col("page_id").alias("id"), F.col("host").alias("of"), F.col("layout").alias("shape"), "n").groupBy(
        "id", "of", "shape").agg(F.min("n").alias("n")))
    taken = pages.join(chosen, (F.col("page_id") == F.col("id")) & (F.col("host") == F.col("of")) & (
        F.col("layout") == F.col("shape"))).select("host", "layout", "n", "html").dropDuplicates(["host", "layout", "n"])

    def infer(group: pd.DataFrame) -> pd.DataFrame:  # at most ``sample`` ids
        listed = [h for h in group.sort_values("n")["html"].drop_duplicates().tolist() if h][:sample]
        found, _ = inferred(listed)
        return pd.DataFrame({
            "host": [group["host"].iloc[0]], "layout": [group["layout"].iloc[0]],
            "pattern": [" ".join(n.pattern() for n in found)], "expression": [written(found)]})

    return taken.groupBy("host", "layout").applyInPandas(
        infer, "host string, layout long, pattern string, expression string")


def confirmed(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The template's own texts by slot, as (own_host, own_layout, by_slot) and, over all layouts, (own_host, by_part),
    from all pages with the expression of their layout."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapper] = {}
        for batch in batches:
            out: dict[str, list] = {"host": [], "layout": [], "place": [], "text": [], "article": [], "inside": []}
            for html, host, shape, expression in zip(*(batch.column(n).to_pylist() for n in (
                    "html", "host", "layout", "expression")), strict=True):
                if not html:
                    continue
                found = list(placed(html, _wrapper(held, expression), shape))
                told = _number(*sorted({text for _, text, _, _, inside in found if inside} or {f[1] for f in found}))
                rows = {(level, place, text, inside) for _, mine, slot, part, inside in found
                        for level, place in ((shape, slot), (None, part)) for text in (mine, None)}
                for level, place, text, inside in rows:
                    for name, value in zip(out, (host, level, place, text, told, inside), strict=True):
                        out[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out["host"], pa.string()), *(
                pa.array(out[n], pa.int64()) for n in ("layout", "place", "text", "article")),
                pa.array(out["inside"], pa.bool_())], list(out))

    seen = matched.select("html", "host", "layout", "expression").mapInArrow(
        run, "host string, layout long, place long, text long, article long, inside boolean").distinct()
    keys = ["host", "layout", "place", "inside"]
    counted = settle("template-texts", seen.groupBy(*keys, "text").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= OTHER_PAGES))
    filled = counted.filter(F.col("text").isNull()).select(
        *(F.col(k).alias(f"f_{k}") for k in keys), F.col("n").alias("pages"))
    same = [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in keys]
    own = counted.filter(F.col("text").isNotNull()).join(filled, same).filter(
        (F.col("n") >= F.when(F.col("inside"), ARTICLE_PAGES).otherwise(OTHER_PAGES)) & (F.col("n") >= SAME * F.col("pages")))
    own = settle("own-texts", own.groupBy("host", "layout").agg(F.collect_list(F.struct("place", "text")).alias("own")))
    by_slot = own.filter(F.col("layout").isNotNull()).select(
        F.col("host").alias("own_host"), F.col("layout").alias("own_layout"), F.col("own").alias("by_slot"))
    return by_slot, own.filter(F.col("layout").isNull()).select(
        F.col("host").alias("part_host"), F.col("own").alias("by_part"))


def _wrapper(held: dict[str, Wrapper], expression: str | None) -> Wrapper:
    if expression not in held:
        if len(held) >= 100:
            held.clear()
        held[expression] = Wrapper(expression)
    return held[expression]


def extracted(pages: DataFrame, sample: int = WRAPPER_PAGES) -> DataFrame:
    """page_id, url, text for each page."""
    mine = settle("shaped-pages", shaped(pages))
    found = settle("wrappers", wrappers(mine, sample)).select(
        F.col("host").alias("w_host"), F.col("layout").alias("w_layout"), "expression")
    matched = mine.join(found, (F.col("host") == F.col("w_host")) & (F.col("layout") == F.col("w_layout")), "left")
    by_slot, by_part = confirmed(matched)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for html, shape, expression, *lists in zip(*(batch.column(n).to_pylist() for n in (
                    "html", "layout", "expression", "by_slot", "by_part")), strict=True):
                known = {(o["place"], o["text"]) for listed in lists for o in listed or ()}
                own = {number for number, text, slot, part, _ in placed(html, _wrapper(held, expression), shape)
                       if (slot, text) in known or (part, text) in known} if known and html else frozenset()
                texts.append(main_text(html, own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    joined = matched.join(by_slot, (F.col("host") == F.col("own_host")) & (F.col("layout") == F.col("own_layout")), "left").join(
        by_part, F.col("host") == F.col("part_host"), "left")
    return joined.select("page_id", "url", "html", "layout", "expression", "by_slot", "by_part").mapInArrow(
        run, "page_id long, url string, text string")
