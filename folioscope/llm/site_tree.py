"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is a path of elements with their classes,
neighbours of the same kind are one node. Each node knows, over the pages it is on, how its
text blocks are spread (content) and how the sequences of its children are (presentation), both
as entropies divided by their maximum: 0 if all pages have the same there, 1 if each has its own.
A node's importance is the content entropy of all below it, mixed with the presentation entropy
where it has children, and pulled towards 1 where few pages speak, since one page shows no
template. Branches of low importance are taken out of every page of the host.

What entropy cannot tell, names do: menus, adverts and reader comments may differ on every
page. An element whose tag, role, class or id says so (NOISE) has its importance divided by four,
which is always too low; forms and the like count by their tag. `main`, `article` and their
kin (CONTENT) mark the main text: where a page has one, what lies outside is left out, and
within it a branch must be nearly the same on all articles, and a minor part of their text, to go.
Copies of an article count once there, so that a much copied article is not taken for a
template; elsewhere copies of a page do. Title headings stay.

Statistics are sums over (node, block) rows, added up before they are shuffled; the rules of a
host are few (a node must be on a thousandth of its pages) and join the pages by host, which
Spark broadcasts if they are small and may split if they are not. Pages are parsed
once for the statistics and once for the text.

Odd rows: a null or empty html gives an empty text. A page without a host belongs to no site, and
names alone decide. Unclosed elements end with what holds them, a cut tag or comment is no text,
a script that never closes takes the rest. Elements deeper than DEPTH count as that one at DEPTH, and keep
their text. Repeated rows and ids keep a row each; an empty table gives no rows. Columns that are kept stay as they
are; one named `text` or `n_chars` is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, pieces, written
from folioscope.llm.url_lists import host_of

#: Importance below which a branch goes, on pages without and within marked main text; pages at which
#: a host's own figures weigh as much as the first guess; share of the host's pages and their number that a rule
#: needs; most of the text it may take; share of presentation; deepest element.
OUTSIDE, WITHIN, TRUST, SUPPORT, PAGES, MOST, STYLE, DEPTH = 0.75, 0.3, 20, 0.001, 10, 1 / 3, 0.25, 64

#: Elements by what they do.
RAW = frozenset("script style xmp iframe noembed noframes noscript title textarea".split())
UNSEEN = frozenset("script style iframe noembed noframes noscript title textarea head template svg math object applet audio video canvas map datalist select option button input meter progress dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = BLOCK - frozenset("body caption col colgroup frame frameset head html legend optgroup option select summary tbody td template tfoot th thead tr".split())
#: Elements that end when a neighbour of theirs begins, and what hides them from it.
NEIGHBOURS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    **{k: (frozenset(["thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"]), frozenset(["table"])) for k in ("thead", "tbody", "tfoot")},
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
WALLS = frozenset("table td th caption button object".split())
#: Tags, roles and words of classes and ids that name what is not the main text, and what is.
NOISE_TAGS = frozenset("nav footer aside form header fieldset menu search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion banner banners "
    "cookie cookies consent gdpr notice notices alert alerts popup popups modal overlay paywall newsletter subscribe subscription signup login "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager sidebar sidebars aside rail masthead header topbar footer foot bottombar "
    "comment comments commentlist disqus discussion respond reply replies reactions guestbook share sharing social related recommended recommendations teaser widget widgets toolbar skiplink".split()
)
BEGINNINGS = ("sidebar", "cookie", "advert", "comment", "navbar", "newsletter", "footer", "breadcrumb", "sponsor")
CONTENT_TAGS, CONTENT_ROLES = frozenset(["main", "article"]), frozenset(["main", "article"])
#: Of an article element only these words of its class or id say that it is none.
NO_ARTICLE = frozenset("comment comments reply replies ad ads advert sponsored promo teaser related recommended".split())
CONTENT_NAMES = frozenset("articlebody article-body articlecontent article-content entry-content post-content post-body main-content maincontent page-content story-body".split())

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<given>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?P<whole>>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
GIVEN = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
CLOSING = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PLAIN, NAMED, MARKED, HIDDEN = range(4)


#: What tags and attributes that were met say; emptied when it has so many.
KINDS_MET: dict[tuple[str, str], tuple[int, str]] = {}
MOST_KINDS = 1 << 16


def kind_met(name: str, given: str) -> tuple[int, str]:
    """kind_of, remembered."""
    if (found := KINDS_MET.get((name, given))) is None:
        if len(KINDS_MET) >= MOST_KINDS:
            KINDS_MET.clear()
        found = KINDS_MET[name, given] = kind_of(name, given)
    return found


def kind_of(name: str, given: str) -> tuple[int, str]:
    """(what an element's tag and attributes say, its name in the tree: tag, classes and id, without numbers of three digits or, in ids, any)."""
    if not given.strip(" \t\n\r\f/"):
        kind = HIDDEN if name in UNSEEN else MARKED if name in CONTENT_TAGS else NAMED if name in NOISE_TAGS else PLAIN
        return kind, name
    a = {}
    for m in GIVEN.finditer(given):
        a.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    labels = f"{a.get('class', '')} {a.get('id', '')}".split()
    key = ".".join([name, *sorted({re.sub(r"\d{3,}", "", x) for x in a.get("class", "").split()}), re.sub(r"\d+", "", a.get("id", ""))])
    words = {w.lower() for x in labels for w in WORDS.findall(x)}
    role, item = a.get("role", "").lower(), a.get("itemprop", "").lower()
    unseen = name in UNSEEN or "hidden" in a or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I)
    if unseen and name not in ("html", "body"):
        return HIDDEN, key
    if name in CONTENT_TAGS or role in CONTENT_ROLES:
        return (NAMED if words & NO_ARTICLE else MARKED), key
    if item == "articlebody" or {x.lower() for x in labels} & CONTENT_NAMES:
        return MARKED, key
    named = name in NOISE_TAGS or role in NOISE_ROLES or words & NOISE or any(w.startswith(BEGINNINGS) for w in words)
    return (NAMED if named and name not in ("html", "body") else PLAIN), key


@dataclass(slots=True)
class Element:
    """An element of a page: its node in the site's tree, and what decides about it."""

    name: str
    node: int
    parent: int
    kind: int
    depth: int
    inline: bool = False
    headed: bool = False
    root: int = -1
    children: list[int] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    """Elements in order, and blocks (element, text, characters in links)."""

    elements: list[Element]
    blocks: list[tuple[int, str, int]]


def node_below(parent: int, key: str) -> int:
    """A node's number: a hash of its path."""
    return xxhash.xxh64_intdigest(key.encode("utf-8", "replace"), parent)


def parsed(html: str, site: int = 0) -> Page:
    """Elements and text blocks of a page; its nodes are numbered from that of the site on. Inline
    elements are text of the block they are in; hidden ones and those named noise are no text."""
    elements = [Element("", site, -1, PLAIN, 0)]
    stack, blocks, buffer = [0], [], []
    linked, in_link, hidden, at = 0, False, 0, 0

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = "".join(buffer)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append((stack[-1], text, min(linked, len(text))))
            buffer.clear()
        linked = 0

    def shut(depth: int) -> None:
        """End the elements from a place of the stack on."""
        nonlocal hidden, in_link
        flush()
        in_link = False
        for i in stack[depth:]:
            hidden -= elements[i].kind == HIDDEN
        del stack[depth:]

    def last(names: frozenset[str], walls: frozenset[str]) -> int:
        """Place in the stack of the innermost element of one of the names that no wall hides, 0 if none."""
        for k in range(len(stack) - 1, 0, -1):
            name = elements[stack[k]].name
            if name in names:
                return k
            if name in walls:
                return 0
        return 0

    while True:
        m = TOKEN.search(html, at)
        upto = m.start() if m else len(html)
        if upto > at and not hidden:
            text = html[at:upto]
            buffer.append(text)
            linked += len(text) * in_link
        if not m:
            break
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if not m["whole"]:
            break  # the page ends within a tag
        if m["end"]:
            if name in BLOCK:
                if name == "p" and not last(frozenset(["p"]), WALLS):
                    flush()
                elif depth := last(frozenset([name]), NEIGHBOURS[name][1] if name in NEIGHBOURS else frozenset(["td", "th"]) if name not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot", "body", "html") else frozenset()):
                    shut(depth)
            elif name == "a":
                in_link = False
            if name not in BLOCK and len(stack) > 1 and elements[stack[-1]].inline and elements[stack[-1]].name == name:
                hidden -= elements[stack.pop()].kind == HIDDEN
            continue
        kind, key = kind_met(name, m["given"])
        if name in VOID or (kind == HIDDEN and name in ("input", "embed")):
            if name == "br" and not hidden:
                buffer.append(" ")
            elif name == "hr":
                if k := last(frozenset(["p"]), WALLS):
                    shut(k)
                flush()
            continue
        if name in RAW:
            end = CLOSING[name].search(html, at)
            at = html.find(">", end.start()) + 1 if end else len(html)
            at = at or len(html)
            if not hidden:
                buffer.append(" ")
            continue
        if name not in BLOCK:
            in_link |= name == "a"
            top = elements[stack[-1]]
            if kind in (HIDDEN, NAMED) or (top.inline and top.name == name):
                held = HIDDEN if kind in (HIDDEN, NAMED) else PLAIN
                stack.append(len(elements))
                elements.append(Element(name, node_below(top.node, key), stack[-2], held, top.depth, True, root=top.root))
                hidden += held == HIDDEN
            continue
        if name in ("html", "body") and any(elements[i].name == name for i in stack[1:]):
            continue
        if name in ENDS_P and (k := last(frozenset(["p"]), WALLS)):
            shut(k)
        if name in HEADINGS and elements[stack[-1]].name in HEADINGS:
            shut(len(stack) - 1)
        if name in NEIGHBOURS and (k := last(*NEIGHBOURS[name])):
            shut(k)
        flush()
        parent = elements[stack[-1]]
        i = len(elements)
        deep = parent.depth >= DEPTH
        root = parent.root if parent.root >= 0 else i if kind == MARKED and not hidden else -1
        elements.append(Element(name, parent.node if deep else node_below(parent.node, key), stack[-1], kind, parent.depth + (not deep), root=root))
        if not deep:
            parent.children.append(elements[i].node)
        if name in HEADINGS:
            for k in stack[1:]:
                elements[k].headed = True
        stack.append(i)
        hidden += kind == HIDDEN
    flush()
    return Page(elements, blocks)


def judged(page: Page) -> tuple[list[bool], list[int]]:
    """For each element: whether its name or an ancestor's puts it out, and the root of the marked main text it is in (-1: none).

    Noise that holds the only marked text of a page is none (a form around the whole page). A
    heading makes a header within the main text part of it.
    """
    els = page.elements
    noisy = [False] * len(els)
    for i, e in enumerate(els):
        own = e.kind == NAMED and not (e.headed and e.root >= 0 and e.root != i and (e.name == "header" or e.name == "hgroup"))
        noisy[i] = own or (e.parent >= 0 and noisy[e.parent])
    roots = {e.root for e in els if e.root >= 0}
    if roots and all(noisy[r] for r in roots):
        held = set()
        for r in roots:
            while r >= 0:
                held.add(r)
                r = els[r].parent
        for i, e in enumerate(els):
            noisy[i] = i not in held and (e.kind == NAMED or (e.parent >= 0 and noisy[e.parent]))
    return noisy, [-1 if e.root >= 0 and noisy[e.root] else e.root for e in els]


def holding(page: Page, roots: list[int]) -> set[int]:
    """The elements that are or hold the root of marked main text."""
    held: set[int] = set()
    for r in {r for r in roots if r >= 0}:
        while r >= 0 and r not in held:
            held.add(r)
            r = page.elements[r].parent
    return held


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def hash_of(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), seed)


def main_text(html: str | None, rules: frozenset[int] = frozenset(), host: str = "") -> str:
    """The page's main text without the branches that its site's rules name."""
    if not html:
        return ""
    page = parsed(html, hash_of(host))
    noisy, roots = judged(page)
    marked = any(r >= 0 for i, r in enumerate(roots) if not noisy[i])
    out = list(noisy)
    if rules:
        for i, e in enumerate(page.elements):
            out[i] = out[i] or signed(e.node) in rules or (e.parent >= 0 and out[e.parent])
    return "\n".join(t for i, t, _ in page.blocks if not out[i] and (roots[i] >= 0 or not marked))


#: Rows of the statistics: a block of a node (BLOCK_ROW), the children of a node, or its description.
BLOCK_ROW, CHILDREN_ROW, NODE_ROW = 0, 1, 2
ROWS = "node bigint, kind tinyint, unit bigint, feature bigint, chars bigint, linked bigint, host string, path array<bigint>, names string, state tinyint"
KINDS = (pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.string(), pa.int8())


def observed(pages: DataFrame) -> DataFrame:
    """ROWS of pages (host, html): what a page says about the nodes of its site. A unit is the marked main text a node is in, or the page's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in pieces(batches, "html"):
            hosts = batch.column("host").to_pylist()
            out: list[list] = [[] for _ in KINDS]
            known: set[int] = set()
            for r in range(batch.num_rows):
                page = parsed(data[off[r] : off[r + 1]].decode(), hash_of(hosts[r]))
                noisy, roots = judged(page)
                holds = holding(page, roots)
                texts: dict[int, list[str]] = {}
                for i, text, _ in page.blocks:
                    texts.setdefault(roots[i], []).append(text)
                whole = hash_of("\n".join(t for _, t, _ in page.blocks))
                units = {k: hash_of("\n".join(v), 1) if k >= 0 else whole for k, v in texts.items()}
                seen: dict[int, tuple[int, list[int]]] = {}
                for i, e in enumerate(page.elements[1:], 1):
                    if e.kind == HIDDEN or e.inline or e.node == page.elements[e.parent].node:
                        continue
                    node = signed(e.node)
                    seen.setdefault(node, (i, []))[1].extend(e.children)
                    if node not in known:
                        known.add(node)
                        path, names, k = [], [], i
                        while k > 0:
                            if page.elements[k].node != page.elements[page.elements[k].parent].node:
                                path.append(signed(page.elements[k].node))
                                names.append(page.elements[k].name)
                            k = page.elements[k].parent
                        state = 4 * (i not in holds) + 2 * noisy[i] + (roots[i] >= 0)
                        for c, v in zip(out, (node, NODE_ROW, 0, 0, 0, 0, hosts[r], path, "/".join(reversed(names)), state), strict=True):
                            c.append(v)
                for node, (i, children) in seen.items():
                    shape = hash_of(",".join(map(str, children)), 2)
                    for c, v in zip(out, (node, CHILDREN_ROW, signed(units.get(roots[i], whole)), signed(shape), 0, 0, None, None, None, None), strict=True):
                        c.append(v)
                for i, text, linked in page.blocks:
                    while page.elements[i].inline or page.elements[i].node == page.elements[page.elements[i].parent].node and page.elements[i].parent > 0:
                        i = page.elements[i].parent
                    if i <= 0 or page.elements[i].kind == HIDDEN:
                        continue
                    for c, v in zip(out, (signed(page.elements[i].node), BLOCK_ROW, signed(units[roots[i]] if roots[i] in units else whole), signed(hash_of(text)), len(text), linked, None, None, None, None), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, KINDS, strict=True)], names=[x.split()[0] for x in ROWS.split(", ")])

    return arrow_map(pages.where("host <> '' and html <> ''").select("host", "html"), run, ROWS)


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The merged trees of all hosts: (host, node, path, names, state, pages, chars, content, presentation, importance).

    pages are units (copies count once); content and presentation are entropies from 0 to 1;
    importance is what branches are judged by before names count. state adds 1 within marked main
    text, 2 for named noise, 4 where no marked main text lies below.
    """
    # a null, an empty page and one without a host tell nothing
    rows = observed(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")))
    facts = [F.max(c).alias(c) for c in ("host", "path", "names")] + [F.min("state").alias("state")]
    seen = rows.groupBy("node", "kind", "unit", "feature").agg(F.max("chars").alias("chars"), F.max("linked").alias("linked"), *facts)
    spread = seen.groupBy("node", "kind", "feature").agg(F.count("*").alias("u"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), *facts)

    def total(kind: int, value) -> F.Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, value)), F.lit(0.0))

    u = F.col("u").cast("double")
    sums = [total(k, v).alias(n) for k, v, n in ((BLOCK_ROW, u, "b"), (BLOCK_ROW, u * F.log(u), "bb"), (CHILDREN_ROW, u, "p"), (CHILDREN_ROW, u * F.log(u), "pp"))]
    # written: what follows reads it twice, and pages are parsed once
    nodes = written(spread.groupBy("node").agg(*sums, F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), *facts).where("host is not null"))
    # an inner node has the content of all nodes below it: few rows, as nodes of a site are
    below = nodes.select(F.explode("path").alias("node"), "b", "bb", "chars", "linked").groupBy("node").agg(F.sum("b").alias("b"), F.sum("bb").alias("bb"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    joined = nodes.select("node", "host", "path", "names", "state", "p", "pp").join(below, "node")

    def entropy(n: str, s: str) -> F.Column:
        """Of counts with sum n and sum of u ln u s, over its greatest value ln n; 1 for a single one."""
        return F.when(F.col(n) > 1, F.greatest(F.lit(0.0), 1 - F.col(s) / (F.col(n) * F.log(n)))).otherwise(F.lit(1.0))

    content, shape = entropy("b", "bb"), entropy("p", "pp")
    trust = F.col("p") / (F.col("p") + TRUST)
    own = F.when(F.col("b") > 0, (1 - STYLE) * content + STYLE * F.greatest(shape, content)).otherwise(F.lit(1.0))
    links = F.when((F.col("state") == 4) & (F.col("chars") > 0), 1 - 0.5 * F.col("linked") / F.col("chars")).otherwise(F.lit(1.0))
    return joined.select("host", "node", "path", "names", "state", F.col("p").cast("long").alias("pages"), "chars", content.alias("content"), shape.alias("presentation"), ((trust * own + 1 - trust) * links).alias("importance"))


def rules_of(tree: DataFrame) -> DataFrame:
    """(host, rules): the nodes of a host whose branches go. A node on fewer than PAGES pages or on less
    than SUPPORT of the host's pages is not judged, so a host has 1 / SUPPORT times as many
    rules as a page has nodes at most. Named noise needs no rule."""
    hosts = tree.groupBy("host").agg(F.max("pages").alias("__pages"), F.max("chars").alias("__chars"))
    found = tree.join(hosts, "host").where((F.col("pages") >= PAGES) & (F.col("pages") >= F.col("__pages") * SUPPORT) & (F.col("chars") <= F.col("__chars") * MOST))
    low = F.col("importance") < F.when(F.col("state") == 4, OUTSIDE).when(F.col("state") == 5, WITHIN)
    out = found.where(low & ~F.col("names").endswith("/h1"))
    return out.groupBy("host").agg(F.collect_set("node").alias("rules"))


def extracted(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url: str = "url", html: str = "html") -> DataFrame:
    """The kept columns, `text` (the page's main text, its blocks in order, one a line) and `n_chars`."""
    if clash := {k.lower() for k in keep} & {"text", "n_chars", "__host", "__html", "__rules"}:
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    rules = written(rules_of(style_tree(pages, url, html)).select(F.col("host").alias("__host"), F.col("rules").alias("__rules")))
    rows = pages.select(*keep, host_of(F.col(url)).alias("__host"), F.col(html).alias("__html")).join(rules, "__host", "left")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema) + ", text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, known = None, frozenset()
        for batch, data, off in pieces(batches, "__html"):
            hosts, rules = batch.column("__host").to_pylist(), batch.column("__rules")
            texts = []
            for r in range(batch.num_rows):
                if hosts[r] != host:
                    host, known = hosts[r], frozenset(rules[r].as_py() or ())
                texts.append(main_text(data[off[r] : off[r + 1]].decode(), known, host or ""))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return arrow_map(rows.select(*keep, "__host", "__html", "__rules"), run, ddl)
