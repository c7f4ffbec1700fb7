"""Main text of web pages by wrapper induction.

The DOM of a page becomes a tree in which siblings with one label (tag, class
and id words) are one node, so that a list or a run of paragraphs is one slot.
Each page of a host is aligned with the host's seed page (one of its commonest
layout) by simple tree matching. The content that most of the host's different
pages have in a slot is template; a page on which the slot says something else
keeps it, and slots that vary are content.

Where a page marks its article (``article``, ``main``), the text comes from
there: all of it but template boxes, and elements that are never main text
(menus, forms, adverts, comments, ...). Elsewhere the slots decide.

Only outlines of pages (labels and hashes) are aligned and counted; a host with
very many pages is split. Pages are re-read for the final text, and meet the
list of what to drop by key.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh
from corpusloom.operators.skew import salted_join
from corpusloom.scratch import Scratch

# A tag ends before the next one begins, so that a page of tags that never end is read once.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe)\b(?:\"[^\"]*\"|'[^']*'|[^<>\"'])*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^<>]*>|<(/?)([A-Za-z][^\s/<>]*)((?:\"[^\"]*\"|'[^']*'|[^<>\"'])*)>",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("td th tr tbody thead tfoot caption li dd dt option head body html".split())
PARAGRAPHS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre li dd dt td th figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset("nav header footer aside form head title select button menu dialog fieldset option input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
# Words in class and id that mark what isn't main text.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar aside rail menu "
    "nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar share sharing "
    "social comment comments disqus replies reply respond related recommended widget form search skip disclaimer".split()
)
SAME_SHARE = 60
LEAST_PAGES = 3


@dataclass
class Element:
    tag: str
    path: int  # a hash of the labels from the top
    noise: bool
    region: int  # 2 in an article, 1 in a main part, 0 elsewhere
    own_header: bool = False  # the header of an article, whose headings stay
    block: Element | None = None  # the innermost element that makes a block, itself included


@dataclass
class Block:
    path: int
    tag: str
    text: str
    noise: bool
    region: int
    linked: int = 0


@dataclass
class _Open:
    parts: list[str] = field(default_factory=list)
    linked: int = 0


#: Nodes of a page's tree: path to the path above and the label.
Nodes = dict[int, tuple[int, str]]


def blocks_of(page: str | None, nodes: Nodes | None = None) -> list[Block]:
    """The text blocks of a page in order, with their place in the tree, which ``nodes`` collects."""
    out: list[Block] = []
    top = Element("#", 0, False, 0)
    top.block = top
    stack = [top]
    inside: Counter[str] = Counter()
    now = _Open()

    def flush() -> None:
        nonlocal now
        text = " ".join(entities.unescape("".join(now.parts)).split())
        if text:
            e = stack[-1]
            noise = e.noise and not (e.own_header and e.block.tag in HEADINGS)
            out.append(Block(e.block.path, e.block.tag, text, noise, e.region, now.linked))
        now = _Open()

    def close(tag: str) -> None:
        while inside[tag]:
            last = stack.pop().tag
            inside[last] -= 1
            if last == tag:
                return

    def add(text: str) -> None:
        if text:
            now.parts.append(text)
            if inside["a"]:
                now.linked += len(text.strip())

    at, page = 0, page or ""
    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            now.parts.append(" ")
        if m[2]:
            close(tag)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P and inside["p"]:
            close("p")
        elif inside[tag] and tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            # An open one of the same list or table ends here.
            for x in reversed(stack):
                if x.tag in ("ul", "ol", "dl", "table", "select", "menu") or x.tag == "tr" and tag != "tr":
                    break
                if x.tag == tag:
                    close(tag)
                    break
        stack.append(_element(tag, m[4], stack[-1], nodes))
        inside[tag] += 1
    add(page[at:])
    flush()
    return out


def _element(tag: str, attributes: str, parent: Element, nodes: Nodes | None) -> Element:
    found = {a[1].lower(): (a[2] or a[3] or a[4] or "").lower() for a in ATTRIBUTE.finditer(attributes)} if attributes else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    label = tag + "".join("." + re.sub(r"\d+", "", n) for n in names)
    words = set(re.split(r"[-_\s]+", " ".join(names))) if names else set()
    role = found.get("role", "")
    region = parent.region
    if tag == "article" or "articlebody" in found.get("itemprop", ""):
        region = 2
    elif tag == "main" or role == "main":
        region = max(region, 1)
    own_header = parent.own_header or (tag == "header" and region == 2 and not parent.noise)
    noise = (
        parent.noise
        or tag in NEVER
        or role in ROLES
        or bool(words & NOISE and tag not in ("body", "html", "main"))
    )
    path = xxhash.xxh64_intdigest(f"{parent.path}/{label}".encode("utf-8", "surrogatepass")) - (1 << 63)
    if nodes is not None:
        nodes[path] = (parent.path, label)
    element = Element(tag, path, noise, region, own_header)
    element.block = element if tag in BLOCK else parent.block
    return element


def main_text(page: str | None, dropped: frozenset[int] = frozenset()) -> str:
    """The text without noise and the ``dropped`` slots."""
    blocks = [b for b in blocks_of(page) if not b.noise]
    best = max((b.region for b in blocks), default=0)
    kept = [b for b in blocks if b.region == best and b.path not in dropped]
    if best == 0:
        # Outside a marked article, blocks that are links for the most part are menus.
        kept = [b for b in kept if 2 * b.linked <= len(b.text)]
    return "\n".join(b.text for b in kept)


def outline(page: str | None) -> tuple[Nodes, list[tuple[int, int, bool]]]:
    """The page's tree, and ``(path, hash of the texts, may be dropped)`` of its slots, in order.

    A slot may be dropped if it isn't noise anyhow and, in a marked article, is
    a box of no text element's kind. The tree has what leads to slots.
    """
    nodes: Nodes = {}
    blocks = blocks_of(page, nodes)
    best = max((b.region for b in blocks if not b.noise), default=0)
    slots: dict[int, list[Block]] = {}
    for b in blocks:
        slots.setdefault(b.path, []).append(b)
    out, used = [], {}
    for path, own in slots.items():
        value = xxhash.xxh64_intdigest("\n".join(b.text for b in own).encode("utf-8", "surrogatepass"))
        free = all(not b.noise and b.region == best for b in own)
        out.append((path, value - (1 << 63), free and (best == 0 or own[0].tag not in PARAGRAPHS)))
        while path in nodes and path not in used:
            used[path] = nodes[path]
            path = nodes[path][0]
    return {path: node for path, node in nodes.items() if path in used}, out


def align(mine: Nodes, seed: Nodes) -> dict[int, int]:
    """Simple tree matching of two trees: my path -> the seed's path.

    Children match in order; the matching with the most nodes wins. Without
    recursion, as trees may be of any depth.
    """

    def children(nodes: Nodes) -> dict[int, list[tuple[str, int]]]:
        below: dict[int, list[tuple[str, int]]] = {}
        for path, (above, label) in nodes.items():
            below.setdefault(above, []).append((label, path))
        return below

    left, right = children(mine), children(seed)
    found: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def match(a: int, b: int) -> tuple[int, list[tuple[int, int]]]:
        """Nodes matched below a pair, and the pairs of its children; those of the children are known."""
        xs, ys = left.get(a, []), right.get(b, [])
        if [x for x, _ in xs] == [y for y, _ in ys]:
            pairs = [(x, y) for (_, x), (_, y) in zip(xs, ys, strict=True)]
            return sum(1 + found[pair][0] for pair in pairs), pairs
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, (x, one) in enumerate(xs, 1):
            for j, (y, two) in enumerate(ys, 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1])
                if x == y:
                    best[i][j] = max(best[i][j], best[i - 1][j - 1] + 1 + found[one, two][0])
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i][1], ys[j][1]))
        return best[-1][-1], pairs[::-1]

    stack = [(0, 0)]
    while stack:
        a, b = stack[-1]
        if (a, b) not in found:
            named = dict(right.get(b, []))
            needed = [(x, named[label]) for label, x in left.get(a, []) if label in named and (x, named[label]) not in found]
            if needed:
                stack += needed
                continue
            found[a, b] = match(a, b)
        stack.pop()
    out, walk = {}, [(0, 0)]
    while walk:
        for x, y in found[walk.pop()][1]:
            out[x] = y
            walk.append((x, y))
    return out


SLOTS = "array<struct<path:bigint,value:bigint,free:boolean>>"
NODES = "array<struct<path:bigint,above:bigint,label:string>>"


def _outlines(keyed: DataFrame, key: str, host: str, html_col: str) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = pa.struct([("path", pa.int64()), ("value", pa.int64()), ("free", pa.bool_())])
        node = pa.struct([("path", pa.int64()), ("above", pa.int64()), ("label", pa.string())])
        for batch in batches:
            layouts, values, slots, trees = [], [], [], []
            for page in batch.column(2):
                nodes, found = outline(page.as_py())
                layouts.append(xxhash.xxh64_intdigest(repr([p for p, _, _ in found]).encode()) - (1 << 63))
                values.append(xxhash.xxh64_intdigest(repr([f[:2] for f in found]).encode()) - (1 << 63))
                slots.append([{"path": p, "value": v, "free": f} for p, v, f in found])
                trees.append([{"path": p, "above": a, "label": x} for p, (a, x) in nodes.items()])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(layouts, pa.int64()),
                    pa.array(values, pa.int64()),
                    pa.array(slots, pa.list_(slot)),
                    pa.array(trees, pa.list_(node)),
                ],
                names=["key", "host", "layout", "content", "slots", "nodes"],
            )

    return keyed.select(key, host, html_col).mapInArrow(
        read, f"key string, host string, layout bigint, content bigint, slots {SLOTS}, nodes {NODES}"
    )


def host_of(url: Column) -> Column:
    """The host of a URL in small letters; null or odd URLs share the empty one."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def template_slots(outlines: DataFrame, scratch: Scratch, rows_per_slice: int) -> DataFrame:
    """``(key, paths)``: the slots of each page that are template and would be in its text.

    Pages of a host with the same content count once. What a slot says is template if at
    least ``LEAST_PAGES`` different pages say it, and ``SAME_SHARE`` per cent of those that have the
    slot. A page on which the slot says something else keeps it.
    """
    pages = scratch.save(
        outlines.groupBy("host", "content").agg(F.min(F.struct("key", "layout", "slots", "nodes")).alias("p"))
        .select("host", "p.key", "p.layout", F.col("p.slots").alias("slots"), F.col("p.nodes").alias("nodes")),
        "pages",
    )
    layouts = pages.groupBy("host", "layout").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "nodes")).alias("first")
    )
    seeds = scratch.save(
        layouts.groupBy("host").agg(F.sum("n").alias("n"), F.max(F.struct("n", "layout", "first")).alias("top"))
        .where(F.col("n") >= LEAST_PAGES)
        .select("host", "n", F.col("top.first.nodes").alias("seed")),
        "seeds",
    )

    def aligned(table: DataFrame, extra: str, kind: str) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = {"id": [], "path": [], "seed": [], "value": []}
                known: dict[tuple, dict[int, int]] = {}
                for name, slots, *trees in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                    mine, seed = ({n["path"]: (n["above"], n["label"]) for n in tree} for tree in trees)
                    # Paths are hashes of all labels, so they tell trees apart.
                    pair = (tuple(mine), tuple(seed))
                    if pair not in known:
                        known[pair] = align(mine, seed)
                    for s in slots:
                        if s["free"] and s["path"] in known[pair]:
                            out["id"].append(name)
                            out["path"].append(s["path"])
                            out["seed"].append(known[pair][s["path"]])
                            out["value"].append(s["value"])
                yield pa.RecordBatch.from_pydict(
                    out, pa.schema([("id", pa.string()), ("path", pa.int64()), ("seed", pa.int64()), ("value", pa.int64())])
                )

        return table.select(extra, "slots", "nodes", "seed").mapInArrow(run, "id string, path bigint, seed bigint, value bigint")

    free = F.exists("slots", lambda s: s["free"])
    small = seeds.select("host", "seed")
    met = salted_join(pages.where(free), small, ["host"], seeds, F.col("key"), rows_per_slice)
    values = aligned(met, "host", "host").groupBy("id", "seed", "value").agg(F.count(F.lit(1)).alias("n"))
    fixed = scratch.save(
        values.groupBy("id", "seed").agg(F.sum("n").alias("n"), F.max(F.struct("n", "value")).alias("most"))
        .where((F.col("most.n") >= LEAST_PAGES) & (100 * F.col("most.n") >= SAME_SHARE * F.col("n")))
        .groupBy(F.col("id").alias("host")).agg(F.collect_set(F.struct("seed", "most.value")).alias("fixed")),
        "fixed",
    )
    sizes = scratch.save(outlines.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "sizes")
    wrappers = small.join(fixed, "host")
    met = salted_join(outlines.where(free), wrappers, ["host"], sizes, F.col("key"), rows_per_slice)
    # What the seed's slots say as template goes with the page's key, so that one alignment tells both.
    met = met.withColumn("slots", F.filter("slots", lambda s: s["free"]))
    own = aligned(met, "key", "key").join(met.select(F.col("key").alias("id"), "fixed").distinct(), "id")
    return own.where(F.array_contains("fixed", F.struct("seed", "value"))).groupBy(F.col("id").alias("key")).agg(
        F.collect_set("path").alias("paths")
    )


def extract(
    pages: DataFrame,
    scratch: Scratch,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    into: str = "text",
    rows_per_slice: int = 100_000,
) -> DataFrame:
    """``pages`` with the main text as column ``into`` (in place of one of that name).

    Null and empty pages have the empty text. Repeated rows each give a row. A
    host with fewer than three different pages has no template. Pages may be of any length and
    depth. Of several layouts that are equally common the largest hash is the seed's.
    """
    key, host = fresh(pages, "_key", "_host")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in (id_col, url_col, html_col)]
    keyed = pages.withColumn(key, F.md5(F.concat_ws("\x01", *parts))).withColumn(host, host_of(F.col(url_col)))
    outlines = scratch.save(_outlines(keyed, key, host, html_col).dropDuplicates(["key"]), "outlines")
    drops = scratch.save(template_slots(outlines, scratch, rows_per_slice), "drops")

    @F.arrow_udf("string")
    def text(page: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array(
            [main_text(p, frozenset(d or ())) for p, d in zip(page.to_pylist(), paths.to_pylist(), strict=True)], pa.string()
        )

    (paths,) = fresh(keyed, "_paths")
    met = keyed.join(drops.select(F.col("key").alias(key), F.col("paths").alias(paths)), key, "left")
    return met.withColumn(into, text(F.col(html_col), F.col(paths))).drop(key, host, paths)
