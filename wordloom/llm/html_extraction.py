"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

A page is a stream of blocks and texts.  Where one key comes again among siblings, the stream
between becomes a repeated group.  A wrapper takes in one page after the other: streams are
aligned by the longest common order of keys; what only one side has becomes optional, keys in
another order become a repeated group, and texts that differ become slots.  Every key stands
once in its sequence, so a wrapper grows with the variety of a host's pages, not with their number,
and wrappers are merged with each other in the same way as with pages.

The wrapper says where a host's article is: the outermost article or main elements, or else the
element that holds most of the text that differs from page to page.  Text in a single place that is the same on every
page belongs to the template, if another single place differs.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from wordloom.llm.common import slices, stored, table
from wordloom.llm.pages import ARTICLE, HEADER, HEADING, HINTED, HOLDER, MAIN, NEVER, Element, Text, read

TEXT = "#text"
#: Different keys in one sequence beyond which its elements are told apart by their tags alone.
WIDE = 48
#: Pages on which a text has to be the same to belong to the template.
SAME_ON = 3
#: Share of an element's differing text that a child must hold to be its main part.
MAIN_PART = 0.6
#: Wrappers a task holds at a time; more are written as several for one host, which are merged.
HELD = 2_000
#: Groups that the wrappers of one host are merged in first.
SALTS = 64


@dataclass
class Item:
    """An element or a text of a wrapper; a text that is not always the same is a slot (``text`` is None)."""

    key: str
    marks: int = 0
    optional: bool = False
    repeated: bool = False
    pages: int = 1
    chars: int = 0
    links: int = 0
    text: int | None = None
    body: list[Item] = field(default_factory=list)
    groups: list[tuple[int, int]] = field(default_factory=list)

    def to_list(self) -> list:
        flags = self.optional + 2 * self.repeated
        return [self.key, self.marks, flags, self.pages, self.chars, self.links, self.text, [x.to_list() for x in self.body], self.groups]

    @classmethod
    def of_list(cls, x: list) -> Item:
        return cls(x[0], x[1], bool(x[2] & 1), bool(x[2] & 2), x[3], x[4], x[5], x[6], [cls.of_list(y) for y in x[7]], [tuple(g) for g in x[8]])

    def expression(self) -> str:
        """The wrapper as a regular expression: ``?`` optional, ``+`` repeated, ``#slot`` a text that differs."""
        said, opened = [], {lo: hi for lo, hi in self.groups}
        closed = set(opened.values())
        for n, x in enumerate(self.body):
            said.append("( " * (n in opened) + x.expression() + " )+" * (n in closed))
        inner = " ".join(said)
        name = ("#same" if self.text is not None else "#slot") if self.key == TEXT else f"<{self.key}>" + (f" {inner} " if inner else "") + "</>"
        mark = {(True, True): "*", (True, False): "?", (False, True): "+", (False, False): ""}[self.optional, self.repeated]
        return f"( {name} ){mark}" if mark and " " in name else name + mark


def joined(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Intervals of places, those that overlap as one, single places left out."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        elif lo < hi:
            out.append((lo, hi))
    return out


def absorb(a: Item, b: Item, same_page: bool = False) -> Item:
    """``a`` comes to match what ``b`` matches too; within a page the two are repetitions."""
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.marks |= b.marks
    a.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    a.chars, a.links = a.chars + b.chars, a.links + b.links
    if a.text != b.text:
        a.text = None
    if a.body or b.body:
        a.body, a.groups = aligned(a.body, a.groups, b.body, b.groups, same_page)
    return a


def folded(items: list[Item]) -> tuple[list[Item], list[tuple[int, int]]]:
    """A sequence in which every key stands once: what lies between the first and last place of a key is a repeated group."""
    first: dict[str, int] = {}
    spans: dict[str, list[int]] = {}
    for n, x in enumerate(items):
        if first.setdefault(x.key, n) != n:
            spans.setdefault(x.key, [first[x.key], n])[1] = n
    if not spans:
        return items, []
    body, groups, at = [], [], 0
    for lo, hi in joined([tuple(x) for x in spans.values()]):
        body += items[at:lo]
        at = hi + 1
        order: dict[str, int] = {}
        merged: list[Item] = []
        seen: list[int] = []
        last, turns = -1, 1
        for x in items[lo : hi + 1]:
            place = order.setdefault(x.key, len(merged))
            if place < last:
                turns += 1
            if place == len(merged):
                merged.append(x)
                seen.append(turns)
                x.optional |= turns > 1
                last = place
                continue
            if place == last or len(order) == 1:
                merged[place].repeated = True
            # a turn without the item makes it optional
            merged[place].optional |= seen[place] < turns - 1
            seen[place] = turns
            last = place
            absorb(merged[place], x, True)
        for x, turn in zip(merged, seen, strict=True):
            x.optional |= turn < turns
        if len(merged) > 1:
            groups.append((len(body), len(body) + len(merged) - 1))
        else:
            merged[0].repeated = True
        body += merged
    return body + items[at:], groups


def ordered(places: list[int]) -> set[int]:
    """Indexes of a longest rising run of places."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for n, x in enumerate(places):
        k = bisect_left(tails, x)
        before.append(ends[k - 1] if k else -1)
        tails[k:k + 1], ends[k:k + 1] = [x], [n]
    out, n = set(), ends[-1] if ends else -1
    while n >= 0:
        out.add(n)
        n = before[n]
    return out


def aligned(
    x: list[Item], x_groups: list[tuple[int, int]], y: list[Item], y_groups: list[tuple[int, int]], same_page: bool = False
) -> tuple[list[Item], list[tuple[int, int]]]:
    """Two sequences as one: mismatches become optional items or repeated groups."""
    if [i.key for i in x] == [i.key for i in y]:
        for a, b in zip(x, y, strict=True):
            absorb(a, b, same_page)
        return x, x_groups if x_groups == y_groups else joined([*x_groups, *y_groups])
    in_y = {i.key: n for n, i in enumerate(y)}
    common = [n for n, i in enumerate(x) if i.key in in_y]
    rising = ordered([in_y[x[n].key] for n in common])
    anchors = {common[n] for n in rising}
    taken = {in_y[x[n].key] for n in anchors}
    in_x = {i.key for i in x}
    body: list[Item] = []
    place_x, place_y = {}, {}
    moved: dict[str, int] = {}
    at = 0

    def rest(until: int) -> None:
        nonlocal at
        while at < until:
            b = y[at]
            place_y[at] = len(body)
            if b.key not in in_x:
                b.optional = True
                body.append(b)
            elif at not in taken:
                moved[b.key] = len(body)
            at += 1

    for n, a in enumerate(x):
        if n in anchors:
            rest(in_y[a.key])
            place_y[at] = len(body)
            at += 1
        place_x[n] = len(body)
        if a.key in in_y:
            absorb(a, y[in_y[a.key]], same_page)
        else:
            a.optional = True
        body.append(a)
    rest(len(y))
    last = len(body) - 1
    spans = [(place_x[lo], place_x[hi]) for lo, hi in x_groups] + [(place_y[lo], min(place_y[hi], last)) for lo, hi in y_groups]
    where = {i.key: n for n, i in enumerate(body)}
    for key, place in moved.items():
        lo, hi = sorted((where[key], min(place, last)))
        spans.append((lo, hi))
        for i in body[lo : hi + 1]:
            i.optional = True
    # in a group of one side, the other side's item stands without the rest
    groups = joined([(min(s), max(s)) for s in spans])
    if len(body) > WIDE and any("." in i.key or "[" in i.key for i in body):
        for i in body:
            i.key = plain(i.key)
        body, _ = folded(body)
        groups = [(0, len(body) - 1)] if len(body) > 1 else []
        for i in body:
            i.optional = True
    return body, groups


def plain(key: str) -> str:
    return key.split(".")[0].split("[")[0]


def excluded(x: Element, whole: int) -> bool:
    """No article text inside; a hint counts for nothing where the element holds the article and most of the page."""
    return bool(x.marks & NEVER) or bool(x.marks & HINTED) and not (x.holds and 2 * x.chars > whole)


def wrapper_of(page: Element) -> Item:
    """The wrapper that matches one page; parts without article text are not opened."""

    def item(x: Element | Text) -> Item:
        if isinstance(x, Text):
            return Item(TEXT, chars=len(x.text), links=x.links, text=zlib.crc32(x.text.encode("utf-8", "surrogatepass")))
        if excluded(x, page.chars):
            return Item(x.key, NEVER)
        body, groups = folded([item(c) for c in x.children])
        return Item(x.key, x.marks & ~(HINTED | NEVER), chars=x.chars, body=body, groups=groups)

    return item(page)


def rules_of(wrapper: Item) -> dict:
    """Where the article is, and template texts inside: paths of keys, joined by line breaks."""
    several = wrapper.pages >= SAME_ON

    def differing(x: Item) -> int:
        if x.key == TEXT:
            return 0 if several and x.text is not None else max(0, x.chars - x.links)
        return sum(map(differing, x.body)) if not x.marks & NEVER else 0

    found: dict[int, list[tuple[str, Item]]] = {ARTICLE: [], MAIN: [], HOLDER: []}
    wide: set[str] = set()

    def look(x: Item, path: str) -> None:
        for c in x.body:
            here = f"{path}\n{c.key}"
            if c.key == TEXT or c.marks & NEVER:
                continue
            for mark in found:
                if c.marks & mark and not any(here.startswith(p + "\n") for p, _ in found[mark]):
                    found[mark].append((here, c))
            look(c, here)

    look(wrapper, "")
    total = differing(wrapper)
    region = found[ARTICLE] or found[MAIN]
    if not region:
        best = max(found[HOLDER], key=lambda f: differing(f[1]), default=None)
        if best and 2 * differing(best[1]) >= total and differing(best[1]):
            region = [best]
    if not region:
        path, x = "", wrapper
        while True:
            inner = [c for c in x.body if c.key != TEXT and not c.marks & NEVER]
            best = max(inner, key=differing, default=None)
            if best is None or best.repeated or differing(best) <= MAIN_PART * differing(x):
                break
            path, x = f"{path}\n{best.key}", best
        region = [(path, x)]
    same: dict[str, int] = {}
    vary = False

    def template(x: Item, path: str) -> None:
        nonlocal vary
        inside = [any(lo <= n <= hi for lo, hi in x.groups) for n in range(len(x.body))]
        for c, grouped in zip(x.body, inside, strict=True):
            if grouped or c.repeated or c.marks & NEVER:
                continue
            if c.key != TEXT:
                template(c, f"{path}\n{c.key}")
            elif c.text is None:
                vary = True
            elif c.pages >= SAME_ON and not x.marks & HEADING:
                same[f"{path}\n{TEXT}"] = c.text

    if several:
        for path, x in region:
            if not x.repeated:
                template(x, path)
    if not vary:
        # nothing in a single place differs: copies of one page, or no way to tell
        same = {}

    def broad(x: Item, path: str) -> None:
        if len(x.body) > 1 and not any("." in c.key or "[" in c.key for c in x.body):
            wide.add(path)
        for c in x.body:
            broad(c, f"{path}\n{c.key}")

    broad(wrapper, "")
    prefixes = {p for p, _ in region} | set(same)
    used = sorted(w for w in wide if any(p.startswith(w) for p in prefixes))
    return {"region": sorted({p for p, _ in region}), "same": same, "wide": used}


def article(page: Element, rules: dict) -> str | None:
    """The blocks of the article in page order; None where the page has no such place."""
    region, same, wide = set(rules["region"]), rules["same"], set(rules["wide"])
    blocks: list[str] = []
    found = "" in region

    def walk(x: Element, path: str, inside: bool, headings: bool) -> None:
        nonlocal found
        for c in x.children:
            if isinstance(c, Text):
                if inside and not (headings and not x.marks & HEADING):
                    constant = same.get(f"{path}\n{TEXT}")
                    if constant is None or constant != zlib.crc32(c.text.encode("utf-8", "surrogatepass")):
                        blocks.append(c.text)
                continue
            if excluded(c, page.chars):
                continue
            here = f"{path}\n{c.key}"
            if path in wide and here not in region:
                here = f"{path}\n{plain(c.key)}"
            found |= here in region
            walk(c, here, inside or here in region, inside and (headings or bool(c.marks & HEADER)))

    walk(page, "", found, False)
    return "\n".join(blocks) if found else None


def main_text(html: str, rules: dict | None) -> str:
    """The page's article by its host's rules, or by the page's own where it has no place that they name."""
    page = read(html)
    text = article(page, rules) if rules else None
    if text is None:
        text = article(page, rules_of(wrapper_of(page)))
    return text or ""


def host_of(url: Column) -> Column:
    """The host in lower case without user and port; urls without one, and null, share the empty host."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", 1), F.lit(""))


_WRAPPER = "host string, salt int, wrapper string"


def _merged(found: DataFrame) -> DataFrame:
    """One wrapper for each host and salt, from sorted rows read as a stream."""
    schema = to_arrow_schema(found.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            for host, salt, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = Item.of_list(json.loads(text))
                if key == (host, salt):
                    held = absorb(held, new)
                    continue
                if key is not None:
                    yield _rows([(*key, held)], schema)
                key, held = (host, salt), new
        if key is not None:
            yield _rows([(*key, held)], schema)

    return found.repartition("host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(run, found.schema)


def _rows(found: list[tuple[str, int, Item]], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*((h, s, json.dumps(w.to_list(), separators=(",", ":"))) for h, s, w in found), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def wrappers(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """The wrapper of every host, over all its pages: host, wrapper (as lists), expression, rules (JSON) and number of pages.

    Tasks merge the pages they read and hand on one wrapper a host, so that a host with any share
    of the pages costs one small row a task; these are merged in two steps.  Null and empty pages count
    for nothing.
    """
    spark = pages.sparkSession
    given = pages.select(host_of(pages[url]).alias("host"), F.coalesce(pages[html].cast("string"), F.lit("")).alias("text"))
    form = spark.createDataFrame([], _WRAPPER).schema
    schema = to_arrow_schema(form)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Item] = {}
        for batch in batches:
            for host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                new = wrapper_of(read(text))
                held[host] = absorb(held[host], new) if host in held else new
                if len(held) >= HELD:
                    yield _rows([(h, 0, w) for h, w in held.items()], schema)
                    held = {}
        if held:
            yield _rows([(h, 0, w) for h, w in held.items()], schema)

    part = given.where(F.col("text") != "").mapInArrow(learn, form)
    part = part.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).cast("int"))
    found = _merged(_merged(part).withColumn("salt", F.lit(0)))
    out = spark.createDataFrame([], "host string, wrapper string, expression string, rules string, pages long").schema
    said = to_arrow_schema(out)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                w = Item.of_list(json.loads(text))
                row = (host, text, w.expression(), json.dumps(rules_of(w), sort_keys=True), w.pages)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, said, strict=True)], schema=said)

    return found.mapInArrow(describe, out)


@lru_cache(maxsize=4096)
def _parsed(rules: str) -> dict:
    return json.loads(rules)


def extracted(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """``row``, the page as a struct, and the text of its article: blocks joined by line breaks.

    References are decoded and white space inside a block is one space.  Null and empty pages, and pages
    without an article, have the empty text; repeated pages stay; pages with a null url share one wrapper.
    Rules are joined by host: small tables of rules reach the pages by broadcast, where Spark finds them small, else pages
    are shuffled by host and adaptive execution splits a host that has most of them.
    """
    rules = stored(wrappers(pages, url=url, html=html).select("host", "rules"))
    given = pages.select(
        host_of(pages[url]).alias("host"),
        F.struct(*[pages[c] for c in pages.columns]).alias("row"),
        F.coalesce(pages[html].cast("string"), F.lit("")).alias("text"),
    ).join(rules, "host", "left")
    form = given.select("row", "text").schema
    schema = to_arrow_schema(form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices(big, "text", 1 << 23):
                texts = [
                    main_text(text, _parsed(said) if said else None) if text else ""
                    for text, said in zip(batch.column("text").to_pylist(), batch.column("rules").to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, schema.field("text").type)], schema=schema)

    return given.select("row", "text", "rules").mapInArrow(run, form)


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extracted(pages)
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
