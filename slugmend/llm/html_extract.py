"""HTML extraction by equivalence classes of tokens and the template they nest into.

After Arasu and Garcia-Molina, "Extracting Structured Data from Web Pages"
(2003). Pages of one host come from one template. Tokens are tags and text runs,
told apart by their path of elements. An element that declares an article is evidence of
where the content is, no substitute for the template: each page goes through all steps.

1. *Occurrence vectors.* How often a token is in each page of its host; pages of
   equal tokens and text count once, so that copies are no evidence of a template. Vectors
   are compared by sums of hashes of (page, count), so a host's vectors are
   aggregated map-side and are never in one place.
2. *Equivalence classes.* Tokens with equal vectors. Large and frequent ones
   (at least ``MIN_TOKENS`` tokens, in at least ``MIN_SHARE`` of the host's
   pages and ``MIN_PAGES`` of them) are candidates. Text of declared articles is
   one in at least ``DECLARED_SHARE`` of the host's pages with such articles only.
3. *Validity.* A class is valid if its tokens come in the same order, round
   after round, in every page that has them, and if each class lies in one and
   the same gap of any more frequent class that is in the page. Invalid classes
   are dropped; the valid ones nest into the host's template.
4. *Slots and regions.* What stands between neighbouring template tokens, by
   template holder (``div``, ``section``, ... that is a template token). Summed over
   the host's pages, by whether they declare an article: plain text, text in links, text
   of declared articles, which weighs ``DECLARED_WEIGHT`` times as much. Slots
   with text of at least ``SLOT_SHARE`` of the largest (links taken off) tell where
   the content is; the region is their holder, and the holders around it as long as
   these add no more text in links than other text. Everything in the region is
   content, however short, but for holders beside the first one that are mostly links.
   What an article holds is content, and no reason to take what stands around it.
5. *Extraction.* A page's text is its declared articles, its text runs in the
   content region and in ``h1`` (outside of articles if they have none), without those in
   excluded places (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
   comments; see ``html_tree``) and without blocks of template text only, but for an article's
   headings of text. A page of nothing but template text keeps it, and so does an article of
   which less than half would be left: a copy. A page that has no part of the
   region is read for all that the template does not have.

A page whose host gives no template (fewer than ``MIN_PAGES`` pages, or none in
common) is read by its own structure: article text, else plain text.

Scale: pages are read twice (tokens; extraction); html is never shuffled
unless the templates outgrow the broadcast threshold as measured on the written
table, and then by host with AQE splitting a hot one. Classes and templates are
a few rows a host: a class has at most as many tokens as a page.

Edge cases: null and empty html give an empty text; a null or odd ``url`` is a
host of its own name; repeated rows count as one page and are extracted
alike; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from html import unescape
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slugmend.llm import html_tree as tree
from slugmend.llm.common import map_arrow, slices
from slugmend.sources.cuts import materialise

MIN_PAGES = 3
MIN_SHARE = 0.1
MIN_TOKENS = 2
SLOT_SHARE = 0.25
DECLARED_SHARE = 0.5
DECLARED_WEIGHT = 8

# Elements that name the text after them, by rank; elements that hold a part of a page.
LABELS = {"h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6, "th": 7, "dt": 7}
HOLDERS = frozenset("div section td center fieldset form article main".split())


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def _hash(said: str) -> int:
    return xxhash.xxh64_intdigest(said) - (1 << 63)


class Hashes(dict):
    """A task's cache of token hashes; emptied when large."""

    def __missing__(self, said: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[said] = _hash(said)
        return value


def token(item: tree.Item, hashes: Hashes) -> int | None:
    """The token of an item; None for white space. Text of a declared article is told apart from other text."""
    if item.kind == tree.TEXT:
        bare = " ".join(unescape(item.text).split())
        return _hash(f"{item.path}{chr(10) if item.role == tree.ARTICLE else ' '}{bare}") if bare else None
    return hashes[f"{'/' if item.kind == tree.CLOSE else ''}{item.path}"]


class Holders(dict):
    """A task's cache: path of an element -> path of the nearest holder that it is or stands in, "" if none."""

    def __missing__(self, path: str) -> str:
        if len(self) > 200_000:
            self.clear()
        at = path
        while at and at[at.rindex("/") + 1 :].split(".", 1)[0] not in HOLDERS:
            at = at[: at.rindex("/")]
        self[path] = at
        return at

    def around(self, path: str) -> str:
        """The holder around a holder."""
        return self[path[: path.rindex("/")]]


def is_declared(items: Iterable[tree.Item]) -> bool:
    return any(i.kind == tree.TEXT and i.role == tree.ARTICLE and not i.text.isspace() for i in items)


def content_hash(items: list[tree.Item]) -> int:
    """Equal for pages of equal tags, by path, and equal text; other attributes may differ."""
    said = xxhash.xxh64()
    for i in items:
        if i.kind != tree.TEXT:
            said.update(f"{i.kind}{i.path}\n")
        elif not i.text.isspace():
            said.update(f"{i.kind}{i.role}{' '.join(unescape(i.text).split())}\n")
    return said.intdigest() - (1 << 63)


def sequence(items: list[tree.Item], hashes: Hashes, holders: Holders) -> tuple[list[int], list[int], list[int], list[int], list[int]]:
    """Tokens of a page in order (0: text that is no token), each with its role, text length, whether in a link, and
    the place of the holder around (-1: none)."""
    tokens, roles, chars, links, above = [], [], [], [], []
    last: dict[str, int] = {}
    for item in items:
        t = token(item, hashes)
        n = 0 if item.kind != tree.TEXT or item.text.isspace() else len(item.text)
        if t is None and not n:
            continue
        is_holder = item.kind == tree.OPEN and item.name in HOLDERS
        above.append(last.get(holders.around(item.path) if is_holder else holders[item.path], -1) if n or is_holder else -1)
        if is_holder:
            last[item.path] = len(tokens)
        tokens.append(t or 0)
        roles.append(item.role)
        chars.append(n)
        links.append(int(item.in_link))
    return tokens, roles, chars, links, above


_SEQUENCE = (
    "host string, page long, declared boolean, tokens array<long>, roles array<int>, chars array<int>, links array<int>, "
    "above array<int>, own array<long>, counts array<int>, inside array<boolean>"
)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, holders = Hashes(), Holders()
    for batch in slices(batches, 64):
        pages = [list(tree.read(h or "")) for h in batch.column("html").to_pylist()]
        read = [sequence(items, hashes, holders) for items in pages]
        counts = [Counter(t for t in r[0] if t) for r in read]
        said = [{t for t, role, n in zip(*r[:3], strict=True) if n and role == tree.ARTICLE} for r in read]
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("host"), pa.array([content_hash(items) for items in pages], pa.int64()),
                pa.array([is_declared(items) for items in pages], pa.bool_()), pa.array([r[0] for r in read], longs),
                *(pa.array([r[i] for r in read], ints) for i in (1, 2, 3, 4)),
                pa.array([list(c) for c in counts], longs), pa.array([list(c.values()) for c in counts], ints),
                pa.array([[t in s for t in c] for c, s in zip(counts, said, strict=True)], pa.list_(pa.bool_())),
            ],
            names=["host", "page", "declared", "tokens", "roles", "chars", "links", "above", "own", "counts", "inside"],
        )


def distinct_pages(pages: DataFrame) -> DataFrame:
    """One row of each group of copies. Only the keys of groups are compared with the pages; ``row`` numbers written rows."""
    copies = (
        pages.groupBy("host", "page").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).filter(F.col("n") > 1)
        .select(F.col("host").alias("c_host"), F.col("page").alias("c_page"), "first")
    )
    copies = materialise(copies, "page-copies")
    same = (F.col("host") == F.col("c_host")) & (F.col("page") == F.col("c_page"))
    return pages.join(copies, same & (F.col("row") != F.col("first")), "left_anti")


def equivalence_classes(pages: DataFrame) -> DataFrame:
    """Per host with any: ``host``, ``classes`` of (token, class, pages) in large and frequent classes."""
    each = pages.select("host", "page", F.explode(F.arrays_zip("own", "counts", "inside")).alias("z")).select(
        "host", "page", F.col("z.own").alias("token"), F.col("z.counts").alias("n"), F.col("z.inside").alias("inside")
    )
    vectors = each.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.max("inside").alias("inside"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("page", "n")).alias("v"),
        F.sum(F.shiftrightunsigned(F.xxhash64("page", "n", F.lit(1)), 32)).alias("w"),
    )
    hosts = pages.groupBy(F.col("host").alias("of_host")).agg(
        F.count(F.lit(1)).alias("host_pages"), F.count_if("declared").alias("declared_pages")
    )
    least = F.when(F.col("inside"), F.lit(DECLARED_SHARE) * F.col("declared_pages")).otherwise(F.lit(MIN_SHARE) * F.col("host_pages"))
    frequent = vectors.filter(F.col("pages") >= MIN_PAGES).join(hosts, F.col("host") == F.col("of_host")).filter(F.col("pages") >= least)
    classes = (
        frequent.groupBy("host", "pages", "total", "v", "w").agg(F.collect_list("token").alias("tokens"))
        .filter(F.size("tokens") >= MIN_TOKENS)
        .select("host", "pages", F.xxhash64("pages", "total", "v", "w").alias("class"), F.explode("tokens").alias("token"))
    )
    return classes.groupBy("host").agg(F.collect_list(F.struct("token", "class", "pages")).alias("classes"))


class Template:
    """The candidate or valid classes of a host."""

    def __init__(self, entries: list[dict]):
        self.of = {e["token"]: e["class"] for e in entries}
        self.pages = {e["class"]: e["pages"] for e in entries}
        self.sizes = Counter(self.of.values())
        self.slots: dict[tuple[int, int], int] = {}

    def slot(self, left: int, right: int) -> int:
        """The name of the slot between two template tokens."""
        if (found := self.slots.get((left, right))) is None:
            found = self.slots[left, right] = _hash(f"{left} {right}")
        return found


class Templates(dict):
    """A task's cache host -> template; a host's classes are converted once, not for each of its pages."""

    def get_for(self, host: str, classes: pa.Array, row: int) -> Template:
        if host not in self:
            if len(self) > 1000:
                self.clear()
            self[host] = Template(classes[row].as_py() or [])
        return self[host]


def lists(column: pa.ListArray) -> Iterator[list[int]]:
    """Rows of a column of integer lists without nulls."""
    at = column.offsets.to_pylist()
    flat = column.values.slice(at[0], at[-1] - at[0]).to_numpy().tolist()
    return (flat[a - at[0] : b - at[0]] for a, b in pairwise(at))


def order_of(template: Template, tokens: list[int]) -> tuple[dict[int, list[int]], dict[int, int | None]]:
    """By class: the places of its tokens in the page; and a hash of their order, None if it differs between rounds."""
    places: dict[int, list[int]] = {}
    for i, t in enumerate(tokens):
        c = template.of.get(t)
        if c is not None:
            places.setdefault(c, []).append(i)
    orders: dict[int, int | None] = {}
    for c, at in places.items():
        n = template.sizes[c]
        first = [tokens[i] for i in at[:n]]
        same = len(at) % n == 0 and len(set(first)) == n and all(
            tokens[at[k]] == first[k % n] for k in range(n, len(at))
        )
        orders[c] = _hash(" ".join(map(str, first))) if same else None
    return places, orders


def gap_of(inner: list[int], outer: list[int], size: int) -> int | None:
    """In which gap of the outer class's round all of the inner class lies, None if in several."""
    gaps = set()
    k = 0
    for i in inner:
        while k < len(outer) and outer[k] < i:
            k += 1
        # before the first token, or after token number (k - 1) of its round
        gaps.add(-1 if k == 0 else (k - 1) % size)
    return gaps.pop() if len(gaps) == 1 else None


def _relations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, class and outer class (0: the class's own order): least and greatest signature seen, whether any page has none."""
    templates = Templates()
    for batch in slices(batches):
        seen: dict[tuple[str, int, int], list] = {}

        def note(key: tuple[str, int, int], value: int | None, seen=seen) -> None:
            low, high, bad = seen.get(key, (None, None, False))
            if value is None:
                seen[key] = (low, high, True)
            else:
                seen[key] = (value if low is None else min(low, value), value if high is None else max(high, value), bad)

        classes = batch.column("classes")
        for row, (host, tokens) in enumerate(zip(batch.column("host").to_pylist(), lists(batch.column("tokens")), strict=True)):
            template = templates.get_for(host, classes, row)
            places, orders = order_of(template, tokens)
            for c, order in orders.items():
                note((host, c, 0), order)
                for b, at in places.items():
                    if b != c and template.pages[b] > template.pages[c]:
                        note((host, c, b), gap_of(places[c], at, template.sizes[b]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.int64()),
                pa.array([k[2] for k in seen], pa.int64()), pa.array([v[0] for v in seen.values()], pa.int64()),
                pa.array([v[1] for v in seen.values()], pa.int64()), pa.array([v[2] for v in seen.values()], pa.bool_()),
            ],
            names=["host", "class", "outer", "low", "high", "bad"],
        )


def valid_classes(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """``host``, ``classes`` without the classes that are not ordered or not nested."""
    seen = (
        _of_host(pages.select("host", "tokens"), classes)
        .transform(map_arrow, _relations, "host string, class long, outer long, low long, high long, bad boolean")
        .groupBy("host", "class", "outer").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("bad").alias("bad"))
    )
    seen = materialise(seen, "relations")
    wrong = F.col("bad") | (F.col("low") != F.col("high"))
    unordered = seen.filter((F.col("outer") == 0) & wrong).select("host", "class")
    # A class may only be held against an outer class that is itself ordered.
    outer = unordered.select(F.col("host").alias("u_host"), F.col("class").alias("u_class"))
    crossing = (
        seen.filter((F.col("outer") != 0) & wrong)
        .join(outer, (F.col("host") == F.col("u_host")) & (F.col("outer") == F.col("u_class")), "left_anti")
        .select("host", "class")
    )
    invalid = unordered.unionByName(crossing).groupBy(F.col("host").alias("i_host")).agg(F.collect_set("class").alias("invalid"))
    kept = classes.join(invalid, F.col("host") == F.col("i_host"), "left")
    return kept.select(
        "host",
        F.filter("classes", lambda e: ~F.coalesce(F.array_contains("invalid", e["class"]), F.lit(False))).alias("classes"),
    )


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, kind of page, slot and holder (0: none): the template holders around it, nearest first; characters that
    are plain, in links, in declared articles."""
    templates = Templates()
    for batch in slices(batches):
        sums: dict[tuple[str, bool, int, int], list] = {}
        classes = batch.column("classes")
        kinds = (batch.column(c).to_pylist() for c in ("host", "declared"))
        columns = (lists(batch.column(c)) for c in ("tokens", "roles", "chars", "links", "above"))
        for row, (host, declared, tokens, roles, chars, links, above) in enumerate(zip(*kinds, *columns, strict=True)):
            template = templates.get_for(host, classes, row)
            for slot, i in slots_of(template, tokens):
                if chars[i] and roles[i] != tree.EXCLUDED:
                    chain, at = [], above[i]
                    while at >= 0:
                        if tokens[at] in template.of:
                            chain.append(tokens[at])
                        at = above[at]
                    s = sums.setdefault((host, declared, slot, chain[0] if chain else 0), [chain, 0, 0, 0])
                    s[3 if roles[i] == tree.ARTICLE else 2 if links[i] else 1] += chars[i]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.bool_()),
                pa.array([k[2] for k in sums], pa.int64()), pa.array([k[3] for k in sums], pa.int64()),
                pa.array([v[0] for v in sums.values()], pa.list_(pa.int64())),
                *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in (1, 2, 3)),
            ],
            names=["host", "declared", "slot", "holder", "chain", "plain", "linked", "article"],
        )


def content_of(slots: list[dict]) -> list[int]:
    """Of a host's slots, the holders whose text is content (0: what stands in none), declared or not."""
    inside: Counter[int] = Counter()  # by holder: characters less those in links, outside of articles
    by_slot: Counter[int] = Counter()
    chains: dict[int, list[int]] = {}
    for s in slots:
        worth = s["plain"] - s["linked"]
        chains[s["holder"]] = s["chain"]
        by_slot[s["slot"]] += worth + DECLARED_WEIGHT * s["article"]
        for holder in (*s["chain"], 0):
            inside[holder] += worth
    least = max(1, SLOT_SHARE * max(by_slot.values(), default=0))
    heavy = {
        s["holder"] for s in slots
        if by_slot[s["slot"]] >= least and s["plain"] - s["linked"] >= max(1, SLOT_SHARE * by_slot[s["slot"]])
    }
    tops = set()
    for holder in heavy:
        top = holder
        for around in chains[holder][1:]:
            if inside[around] < inside[top]:
                break
            top = around
        tops.add(top)
    content = []
    for holder, chain in chains.items():
        taken = any(h in heavy for h in chain)
        for h in () if taken else (*chain, 0):
            if h in tops:
                taken = True
                break
            if inside[h] < 0:
                break
        if taken:
            content.append(holder)
    return sorted(content)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host, the content of its pages without (``content``) and with declared articles (``beside``)."""
    longs = pa.list_(pa.int64())
    for batch in slices(batches, 16):
        hosts = batch.column("slots").to_pylist()
        found = [[content_of([s for s in slots if s["declared"] == kind]) for slots in hosts] for kind in (False, True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), *(pa.array(f, longs) for f in found)], names=["s_host", "content", "beside"]
        )


def slots_of(template: Template, tokens: list[int]) -> Iterator[tuple[int, int]]:
    """(slot, place) of every place that is not a template token; a slot is named by the template tokens around it."""
    fixed = [i for i, t in enumerate(tokens) if t in template.of]
    left, start = 0, 0
    for i in [*fixed, len(tokens)]:
        right = tokens[i] if i < len(tokens) else 0
        slot = template.slot(left, right) if i > start else 0
        for k in range(start, i):
            yield slot, k
        left, start = right, i + 1


def templates(pages: DataFrame) -> DataFrame:
    """Per host: ``host``, ``classes`` of its template, ``content`` and ``beside`` (its content holders by kind of page)."""
    candidates = materialise(equivalence_classes(pages), "candidate-classes")
    valid = materialise(valid_classes(pages, candidates), "valid-classes")
    # Slots and holders are named by template tokens: a few rows a host.
    slots = (
        _of_host(pages.select("host", "declared", "tokens", "roles", "chars", "links", "above"), valid)
        .transform(
            map_arrow, _slots,
            "host string, declared boolean, slot long, holder long, chain array<long>, plain long, linked long, article long",
        )
        .groupBy("host", "declared", "slot", "holder")
        .agg(F.min("chain").alias("chain"), *(F.sum(c).alias(c) for c in ("plain", "linked", "article")))
    )
    slots = materialise(slots, "slots")
    content = (
        slots.groupBy("host")
        .agg(F.collect_list(F.struct("declared", "slot", "holder", "chain", "plain", "linked", "article")).alias("slots"))
        .transform(map_arrow, _contents, "s_host string, content array<long>, beside array<long>")
    )
    found = valid.filter(F.size("classes") > 0).join(content, F.col("host") == F.col("s_host"), "left")
    return found.select("host", "classes", "content", "beside")


def _of_host(pages: DataFrame, per_host: DataFrame) -> DataFrame:
    """Pages with the row of their host. ``per_host`` is a written table, so its size is known to the planner."""
    return pages.join(per_host.withColumnRenamed("host", "t_host"), F.col("host") == F.col("t_host")).drop("t_host")


class Region:
    """The content holders of a host's template, for its pages with or without declared articles."""

    def __init__(self, template: Template, content: frozenset[int], hashes: Hashes, holders: Holders):
        self.template, self.content, self.hashes, self.holders = template, content, hashes, holders
        self.seen: dict[str, tuple[bool, bool]] = {}

    def place(self, path: str) -> tuple[bool, bool]:
        """Whether text in the element of that path is content by its nearest template holder, and whether a page's heading."""
        if (known := self.seen.get(path)) is None:
            if len(self.seen) > 100_000:
                self.seen.clear()
            at = self.holders[path]
            while at and self.hashes[at] not in self.template.of:
                at = self.holders.around(at)
            heading = any(label.split(".", 1)[0] == "h1" for label in path.split("/"))
            known = self.seen[path] = (self.hashes[at] if at else 0) in self.content, heading
        return known

    def is_in(self, items: list[tree.Item]) -> bool:
        """Whether a page has any part of the region, be it empty."""
        return 0 in self.content or any(i.kind == tree.OPEN and i.name in HOLDERS and self.hashes[i.path] in self.content for i in items)


def blocks_of(items: list[tree.Item], fit: list[bool]) -> list[list[int]]:
    """Places of the fitting text runs, by block."""
    blocks: list[list[int]] = [[]]
    for k, item in enumerate(items):
        if fit[k]:
            blocks[-1].append(k)
        elif item.block and blocks[-1]:
            blocks.append([])
    return blocks


def without_template(items: list[tree.Item], fit: list[bool], template: Template, hashes: Hashes) -> list[bool]:
    """The fitting text runs of blocks that have any which is not template text: a sentence keeps its common words."""
    taken = [False] * len(items)
    for block in blocks_of(items, fit):
        if any(not items[k].text.isspace() and token(items[k], hashes) not in template.of for k in block):
            for k in block:
                taken[k] = True
    return taken


def with_labels(items: list[tree.Item], article: list[bool], own: list[bool]) -> list[bool]:
    """``own`` and the headings of an article that every page has, if text of the page's own stands under them."""
    taken = list(own)
    under = 0  # labels above this rank have none
    for block in reversed(blocks_of(items, article)):
        if any(own[k] for k in block):
            under = 8
            continue
        rank = next((LABELS[n] for label in items[block[0]].path.split("/") if (n := label.split(".", 1)[0]) in LABELS), 8) if block else 8
        if rank < under:
            for k in block:
                taken[k] = True
            under = under if rank == 7 else rank
    return taken


def undeclared_text(items: list[tree.Item], plain: list[bool], region: Region, hashes: Hashes) -> list[bool]:
    """The main text among the plain text of a page without a declared article."""
    own = []
    if region.is_in(items):
        fit = [p and any(region.place(i.path)) for i, p in zip(items, plain, strict=True)]
        own = without_template(items, fit, region.template, hashes)
    if not any(own):  # a page unlike its host's others: what the template does not have
        own = without_template(items, plain, region.template, hashes)
    return own if any(own) else plain  # nothing but template text, which is then the page's text


def declared_text(items: list[tree.Item], article: list[bool], region: Region, hashes: Hashes) -> list[bool]:
    """The main text of a page with declared articles: theirs, and what the template shows to be content beside them."""
    headed = any(a and region.place(i.path)[1] for i, a in zip(items, article, strict=True))
    fit = list(article)
    for k, i in enumerate(items):
        if i.kind == tree.TEXT and i.role == tree.PLAIN:
            content, heading = region.place(i.path)
            fit[k] = content or heading and not headed
    own = with_labels(items, article, without_template(items, fit, region.template, hashes))
    if 2 * _chars(items, own) < _chars(items, article):  # a copy of the host's other articles
        own = [o or a for o, a in zip(own, article, strict=True)]
    return own


def _chars(items: list[tree.Item], taken: list[bool]) -> int:
    return sum(len(i.text) for i, t in zip(items, taken, strict=True) if t and not i.text.isspace())


def main_text(html: str, regions: tuple[Region | None, Region | None], hashes: Hashes) -> str:
    """Blocks of the main text, one a line. ``regions``: for a page without and with a declared article, None if not known."""
    items = list(tree.read(html))
    declared = is_declared(items)
    wanted = tree.ARTICLE if declared else tree.PLAIN
    taken = [i.kind == tree.TEXT and i.role == wanted for i in items]
    if (region := regions[declared]) is not None:
        taken = (declared_text if declared else undeclared_text)(items, taken, region, hashes)
    blocks: list[str] = []
    open_: list[str] = []

    def flush() -> None:
        if said := " ".join("".join(open_).split()):
            blocks.append(said)
        open_.clear()

    for item, take in zip(items, taken, strict=True):
        if take:
            open_.append(unescape(item.text))
        elif item.block:
            flush()
        elif item.name == "br":
            open_.append(" ")
    flush()
    return "\n".join(blocks)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page."""
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    read = rows.select("host", "html").transform(map_arrow, _sequences, _SEQUENCE)
    read = materialise(read.withColumn("row", F.monotonically_increasing_id()), "page-tokens")
    found = materialise(templates(distinct_pages(read)), "templates").withColumnRenamed("host", "t_host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[Region | None, Region | None]] = {}
        hashes, holders = Hashes(), Holders()
        for batch in slices(batches, 64):
            texts = []
            classes, content, beside = (batch.column(c) for c in ("classes", "content", "beside"))
            for row, (host, html) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True)):
                if host not in cache:
                    if len(cache) > 1000:
                        cache.clear()
                    template = Template(classes[row].as_py() or [])
                    # Without content, pages that declare none are read by their own structure.
                    kinds = content[row].as_py(), beside[row].as_py() or []
                    cache[host] = tuple(
                        Region(template, frozenset(found), hashes, holders) if template.of and (found or declared) else None
                        for declared, found in enumerate(kinds)
                    )
                texts.append(main_text(html or "", cache[host], hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = rows.join(found, F.col("host") == F.col("t_host"), "left").select(
        "page_id", "url", "html", "host", "classes", "content", "beside"
    )
    return joined.transform(map_arrow, run, f"page_id {kind}, url string, text string, n_chars long")
