"""Main text of web pages by site style trees."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import stored, tidy

MIN_PAGES = 8  # pages of a host that must share a node before it can be judged
RATIO = 2.0  # a branch goes whose composite entropy is at least so many times that of the host's main node
LEAST = 0.1  # and at least this
GAMMA = 0.9  # weight of a branch's content against its presentation, per presentation beyond the first
DEPTH = 512  # elements nested deeper count as the one at this depth; their text stays theirs
BROADCAST_NODES = 200_000  # nodes of low importance that tasks may hold; beyond it they are joined by host
_PAGES, _STYLE, _WORD, _AROUND = range(4)
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|template|noscript|iframe|textarea|svg|math|object)\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<[!?/](?![a-zA-Z])[^>]*>|<![a-zA-Z][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_HEAD = re.compile(r"<head\b[^<>]*>", re.I)
_HEAD_END = re.compile(r"</head\s*>|(?=<body\b)", re.I)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")  # one whole attribute after another
_NAME = re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr img br".split()
)
BOILERPLATE_TAGS = frozenset("nav footer aside form button select menu dialog".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu form".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar footer header masthead comment comments replies discussion disqus cookie cookies consent "
    "notice popup modal overlay newsletter subscribe signup login share sharing social related recommended widget pagination "
    "pager toolbar".split()
)
MAIN = frozenset(("article", "main"))
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


class Element:
    __slots__ = ("tag", "path", "boilerplate", "main", "styles", "nodes")

    def __init__(self, tag, path, boilerplate, main, nodes):
        self.tag, self.path, self.boilerplate, self.main = tag, path, boilerplate, main
        self.nodes = nodes  # of this element and all around it
        self.styles: list[str] = []  # children, runs of the same one once


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _open(parent: Element, tag: str, attrs: str) -> Element:
    names, whole, hidden, role = [], [], False, ""
    for key, a, b, c in _ATTR.findall(attrs) if attrs else ():
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden":
            hidden = True
        elif key == "role":
            role = value
        elif key in ("class", "id"):
            names += _NAME.findall(value)
            whole += value.split()
    label = ".".join([tag, *names])
    main = parent.main or tag in MAIN or role == "main"
    boilerplate = parent.boilerplate or (
        tag in BOILERPLATE_TAGS
        or (tag == "header" and not parent.main)
        or hidden
        or role in BOILERPLATE_ROLES
        or (tag not in ("body", "html") and not BOILERPLATE_NAMES.isdisjoint(whole if main else names) and not (tag == "header" and parent.main))
    )
    if not parent.styles or parent.styles[-1] != label:
        parent.styles.append(label)
    path, nodes = parent.path, parent.nodes
    if len(nodes) < DEPTH:
        path = _hash(f"{path}>{label}")
        nodes = (*nodes, path)
    return Element(tag, path, boilerplate, main, nodes)


def parse(page: str, host: int = 0) -> tuple[list[tuple[Element, str, tuple[str, ...]]], list[Element]]:
    """(text blocks in page order with the element that holds them and the targets of their links and images, all
    block elements). The names of nodes depend on the host."""
    root = Element("", host, False, False, (host,))
    stack, elements = [root], [root]
    blocks: list[tuple[Element, str, tuple[str, ...]]] = []
    parts: list[str] = []
    targets: list[str] = []

    def flush():
        if parts or targets:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text or targets:
                blocks.append((stack[-1], text, tuple(targets)))
            parts.clear()
            targets.clear()

    head = _HEAD.search(page)
    end = _HEAD_END.search(page, head.end()) if head else None
    if end:
        page = page[: head.start()] + page[end.end() :]
    at = 0
    for found in _MARKUP.finditer(page):
        if found.start() > at:
            parts.append(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                parts.append("\n")
            elif tag in ("a", "img") and found["attrs"]:
                targets += [f"{key.lower()}={a or b or c}" for key, a, b, c in _ATTR.findall(found["attrs"]) if key.lower() in ("href", "src")]
            continue
        flush()
        if found["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        while stack[-1].tag == "p" and len(stack) > 1:  # a paragraph holds no blocks
            stack.pop()
        ends = CLOSES.get(tag)
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ends:
                    del stack[depth:]
                    break
                if stack[depth].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        element = _open(stack[-1], tag, found["attrs"])
        elements.append(element)
        if tag not in VOID and not (found["attrs"] or "").rstrip().endswith("/"):
            stack.append(element)
    parts.append(page[at:])
    flush()
    return blocks, elements


def main_text(page: str, low: frozenset[int] = frozenset(), host: int = 0) -> str:
    """Blocks of the main text: those inside an article or main element, or of the whole body without one, that do
    not lie in a branch of low importance. Boilerplate by its tag, role or name goes as well. Where the tree would
    leave nothing of an article, it does not judge it; where it would leave nothing of another page, the node that
    holds most of its text stays."""
    blocks = [(e, t) for e, t, _ in parse(page, host)[0] if t]
    main = [(e, t) for e, t in blocks if e.main]
    named = [(e, t) for e, t in main or blocks if not e.boilerplate]
    kept = [t for e, t in named if low.isdisjoint(e.nodes)]
    if named and not kept:
        sizes: Counter = Counter()
        for e, t in named:
            sizes[e.path] += len(t)
        most = max(sizes, key=sizes.get)
        kept = [t for e, t in named if main or e.path == most]
    return "\n\n".join(kept)


def host_of(url: str) -> Column:
    """A hash of the host's name."""
    name = F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.xxhash64(F.coalesce(name, F.lit("")))


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, node, pages, importance, low) of the merged style tree of each host; hosts and nodes are hashes.

    A node is an element by its path of tags and names. Presentation: entropy of the sequences of children that its
    pages show. Content of a node that holds text itself: one less the mean entropy of its features (words, targets
    of links and images) over its pages; a feature of n of m pages has log n / log m. Content of a branch: the mean
    of its nodes', weighted by their features on all pages. Composite: presentation and content, the latter by
    GAMMA to the power of presentations beyond the first, as a single one says nothing.

    The main node of a host has the most features on all pages of those on MIN_PAGES pages or more. A branch on so
    many pages that does not hold it is low where its composite entropy, one less the importance, is RATIO times
    that of the main node's content and LEAST or more. So hosts whose pages are copies lose nothing.

    Each task counts what it reads, so a host of many pages is summed before the shuffle, which goes by feature.
    """
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())

    def run(batches):
        for batch in batches:
            seen: dict[tuple[int, int], Counter] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                blocks, elements = parse(page.as_py() or "", host)
                found: dict[tuple, set] = {}
                for e in elements:
                    found.setdefault((e.path, _STYLE), set()).add(" ".join(e.styles))
                    found[e.path, _PAGES] = {host}
                for e, text, targets in blocks:
                    features = found.setdefault((e.path, _WORD), set())
                    features.update(text.lower().split())
                    features.update(targets)
                    found[e.path, _AROUND] = e.nodes
                for key, features in found.items():
                    if key not in seen:
                        seen[key] = Counter()
                    seen[key].update(features)
            names: dict[str, int] = {}
            columns: tuple[list, ...] = ([], [], [], [])
            for (node, kind), counts in seen.items():
                if kind in (_PAGES, _AROUND):
                    features = list(counts)
                else:
                    features = [names[f] if f in names else names.setdefault(f, _hash(f)) for f in counts]
                for column, values in zip(columns, ([node] * len(counts), [kind] * len(counts), features, counts.values())):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "kind", "feature", "n"])

    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).cast("string").alias("html"))
    counts = rows.mapInArrow(tidy(run), "node long, kind int, feature long, n long")
    counts = counts.groupBy("node", "kind", "feature").agg(F.sum("n").alias("n"))

    def of(kind, value):
        return F.when(F.col("kind") == kind, value)

    nodes = stored(
        counts.groupBy("node").agg(
            F.max(of(_PAGES, F.col("n"))).alias("pages"),
            F.max(of(_PAGES, F.col("feature"))).alias("host"),
            F.count_if(F.col("kind") == _STYLE).alias("styles"),
            F.sum(of(_STYLE, F.col("n") * F.log("n"))).alias("style_nlogn"),
            F.count_if(F.col("kind") == _WORD).alias("features"),
            F.sum(of(_WORD, F.col("n"))).alias("weight"),
            F.sum(of(_WORD, F.log("n"))).alias("feature_log"),
            F.collect_set(of(_AROUND, F.col("feature"))).alias("around"),  # at most DEPTH
        )
    )
    m = F.log("pages")
    many = F.col("pages") > 1
    entropy = F.when(many, F.round(F.col("feature_log") / F.col("features") / m, 9)).otherwise(0.0)  # the order of sums decides nothing
    texts = nodes.where("features > 0").select("host", "node", "pages", "weight", entropy.alias("entropy"), "around")
    branches = (
        texts.select(F.explode("around").alias("node"), "weight", "entropy")
        .groupBy("node")
        .agg(F.round(F.sum(F.col("weight") * F.col("entropy")) / F.sum("weight"), 9).alias("content_entropy"))
    )
    order = F.struct("weight", "node")
    main = (
        texts.where(F.col("pages") >= MIN_PAGES)
        .groupBy("host")
        .agg(F.max_by("entropy", order).alias("main_entropy"), F.max_by("around", order).alias("main_around"))
    )
    presentation = F.when(many, (m - F.col("style_nlogn") / F.col("pages")) / m).otherwise(1.0)
    share = F.pow(F.lit(GAMMA), F.greatest(F.col("styles") - 1, F.lit(0)))
    importance = F.round((1 - share) * presentation + share * (1 - F.coalesce("content_entropy", F.lit(0.0))), 9)
    judged = nodes.join(branches, "node", "left").join(main, "host", "left")
    low = (F.col("pages") >= MIN_PAGES) & (1 - F.col("importance") >= F.greatest(RATIO * F.col("main_entropy"), F.lit(LEAST)))
    low = low & ~F.array_contains("main_around", F.col("node"))
    return judged.withColumn("importance", importance).select("host", "node", "pages", "importance", F.coalesce(low, F.lit(False)).alias("low"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of each page: id, url, text, n_chars.

    Null or empty html gives an empty text; a null url counts as one host without a name. Repeated rows and null ids
    stay rows of their own; pages of any length are read in one pass. Nodes of low importance are counted first: as
    many as tasks may hold are broadcast; more are joined to the pages as one list per host, and the skew join splits
    a large host's pages.
    """
    low = stored(style_tree(pages, url_col, html_col).where("low").select(F.col("host").alias("__host"), "node"))
    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col).cast("string").alias("__html"), host_of(url_col).alias("__host"))
    if low.count() <= BROADCAST_NODES:
        known = pages.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in low.select("node").toLocalIterator()))
        joined = rows.withColumn("__low", F.lit(None).cast("array<long>"))
    else:
        known = None
        joined = rows.join(low.groupBy("__host").agg(F.collect_set("node").alias("__low")), "__host", "left")
    joined = joined.select(id_col, url_col, "__html", "__host", "__low")

    def run(batches):
        shared = known.value if known is not None else None
        for batch in batches:
            texts = [
                main_text(page.as_py() or "", frozenset(low or ()) if shared is None else shared, host)
                for page, host, low in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[id_col, url_col, "text", "n_chars"],
            )

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return joined.mapInArrow(tidy(run), f"{id_col} {kinds[0]}, {url_col} {kinds[1]}, text string, n_chars long")
