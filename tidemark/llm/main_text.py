"""The main text of web pages, with templates that a site repeats taken out.

A page is parsed to a tree (missing end tags are supplied as browsers do). Elements that are never article text go:
scripts, navigation and the like, and forms and those whose class, id or role says so unless they hold what the page
is about. What is left of the articles (else the main elements, else the body) is read block by block. Block subtrees of all pages, inside article and main
too, are hashed and counted by host in Spark. One recurs if it is on at least MIN_PAGES pages and MIN_SHARE of the
host's; it is a template, and goes, if the pages' texts differ without all that recurs: min-hashes of these rests have
MIN_PAGES values or more, and no value is on over MOST_ALIKE of the pages. Pages with a rest under MIN_REST of their
words are copies and don't count, so what copies of an article have in common stays. Sites put what they repeat in elements
of its own; a running line of an article or main (LINES) is its text unless over LINE_SHARE of the host's pages have the subtree,
so a sentence or heading that many articles quote stays.

At scale: pages are parsed three times, the second time only on hosts where something recurs. Counting shuffles 16
bytes for each (page, subtree), and a row for each (page, recurring subtree, min-hash), both after partial
aggregation; what recurs is broadcast if its counted rows allow, else pages are joined by host.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import small, staged, table

MIN_PAGES, MIN_SHARE = 8, 0.3
MIN_REST, MOST_ALIKE = 0.2, 0.5
LINE_SHARE = 0.5
#: Odd factors of the min-hashes.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
GONE = frozenset(
    "head script style noscript template svg math iframe object embed canvas audio video button input select option textarea "
    "nav aside footer dialog menu noembed noframes title".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hr "
    "html li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
NO_P, BOUNDS = BLOCK - {"p"}, frozenset(("article", "body", "td", "th"))
RUN = "#run"
#: Subtrees of these can be templates: an inline element is a part of its sentence.
WHOLE = BLOCK - {"html", "body", "main", "article"} | {RUN}
#: What running text is made of.
LINES = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split()) | {RUN}
#: Whole names in a class, id or role that mark what is no article text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related "
    "recommended reply replies respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget "
    "complementary contentinfo search alert dialog".split()
)
#: An element of the first kind ends an open one of the second, up to the nearest of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
          "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"})}
#: A quote counts after an equals sign only. What never closes is text, and is given up at the next "<", so no page takes time in its length's square.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>=]++|=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s<>]*+))*+)>", re.S)
NAMED = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


class Node:
    __slots__ = ("tag", "gone", "marked", "inside", "children")

    def __init__(self, tag: str, gone: bool, marked: bool = False, inside: bool = False):
        self.tag, self.gone, self.marked, self.inside, self.children = tag, gone, marked, inside, []

    def can_go(self, subtree: int, common: frozenset[int]) -> bool:
        """Whether the element may be a template: no running line of an article or main, unless among the `common` ones."""
        return not (self.inside and self.tag in LINES) or subtree in common


def parse(page: str) -> Node:
    root = Node("html", False)
    open_, at = [root], 0
    count = dict.fromkeys(("article", "main", "p"), 0)

    def close(names, within) -> None:
        for name in names:
            if count.get(name):
                break
        else:
            return
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in names:
                for node in open_[i:]:
                    count[node.tag] -= 1
                del open_[i:]
                return
            if open_[i].tag in within:
                return

    while m := TOKEN.search(page, at):
        if m.start() > at:
            open_[-1].children.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                open_[-1].children.append(Node("br", False))
            else:
                close((tag,), BOUNDS - {tag} if tag not in BLOCK or tag in ("p", "li") else ())
            continue
        if tag in BLOCK:
            close(("p",), NO_P)
        if tag in CLOSES:
            close(*CLOSES[tag])
        marks = {w for v in NAMED.findall(m[3]) for w in v.strip("\"'").lower().split()} if m[3] else ()
        inside = count["article"] > 0 or count["main"] > 0
        node = Node(tag, tag in GONE or (tag == "header" and not inside), tag == "form" or (tag not in ("html", "body", "main") and not MARKS.isdisjoint(marks)), inside)
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            open_.append(node)
            count[tag] = count.get(tag, 0) + 1
    if at < len(page):
        open_[-1].children.append(page[at:])
    settle(root)
    grouped(root)
    return root


def settle(root: Node) -> None:
    """Marked elements go, except those that hold a main element, most of the page's text, or articles of a page that
    has none but in marked elements."""
    order: list[Node] = []
    todo: list[tuple[Node, bool]] = [(root, False)]
    free = False
    while todo:
        node, under = todo.pop()
        order.append(node)
        under = under or node.marked
        free = free or (node.tag == "article" and not under)
        todo += [(c, under) for c in node.children if not isinstance(c, str) and not c.gone]
    if not any(n.marked for n in order):
        return
    sizes: dict[int, int] = {}
    holds: set[int] = set()
    for node in reversed(order):
        inner = [c for c in node.children if not isinstance(c, str) and not c.gone]
        sizes[id(node)] = sum(len("".join(c.split())) for c in node.children if isinstance(c, str)) + sum(sizes[id(c)] for c in inner)
        # An article that is marked itself is none that would keep what is around it.
        if node.tag == "main" or (node.tag == "article" and not node.marked and not free) or any(id(c) in holds for c in inner):
            holds.add(id(node))
    for node in order:
        node.gone = node.marked and id(node) not in holds and 2 * sizes[id(node)] <= sizes[id(root)]


def grouped(root: Node) -> None:
    """Text and inline elements between blocks become subtrees of their own (tag RUN), which the blocks' text is not
    changed by."""
    todo = [root]
    while todo:
        node = todo.pop()
        inner = [c for c in node.children if not isinstance(c, str)]
        todo += inner
        if node.tag in BLOCK and any(c.tag in BLOCK for c in inner):
            out: list = []
            for c in node.children:
                if not isinstance(c, str) and c.tag in BLOCK:
                    out.append(c)
                else:
                    if not out or out[-1].tag != RUN:
                        out.append(Node(RUN, False, inside=node.inside or node.tag in ("article", "main")))
                    out[-1].children.append(c)
            node.children = out


def content(root: Node) -> tuple[list[Node], bool]:
    """The elements whose text is the page's, in page order: the outermost articles with text, else main elements, else
    all; and whether they are of the first two kinds."""
    for tag in ("article", "main"):
        found, todo = [], [root]
        while todo:
            node = todo.pop()
            if node.tag == tag:
                found.append(node)
            else:
                todo += [c for c in node.children[::-1] if not isinstance(c, str) and not c.gone]
        if found := [n for n in found if blocks([n])]:
            return found, True
    return [root], False


def digests(root: Node) -> dict[int, int]:
    """id(node) -> 64-bit hash of each kept element's subtree (tags and text, white space folded)."""
    out: dict[int, int] = {}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, done = todo.pop()
        if not done:
            todo.append((node, True))
            todo += [(c, False) for c in node.children if not isinstance(c, str) and not c.gone]
            continue
        parts = [" ".join(c.split()) if isinstance(c, str) else f"\1{out[id(c)]}" for c in node.children if isinstance(c, str) or not c.gone]
        out[id(node)] = int.from_bytes(hashlib.blake2b("\0".join([node.tag, *parts]).encode(errors="replace"), digest_size=8).digest(), "little", signed=True)
    return out


def blocks(nodes: list[Node], without: frozenset[int] = frozenset(), hashes: dict[int, int] | None = None, common: frozenset[int] = frozenset()) -> list[str]:
    """The text of each block in page order, references decoded and white space folded; empty ones, and subtrees `without` that can go, left out."""
    out, now = [], []

    def end() -> None:
        if text := " ".join(html.unescape("".join(now)).split()):
            out.append(text)
        now.clear()

    todo: list = nodes[::-1]
    while todo:
        c = todo.pop()
        if c is None:
            end()
        elif isinstance(c, str):
            now.append(c)
        elif c.gone or (hashes and hashes[id(c)] in without and c.can_go(hashes[id(c)], common)):
            if c.tag in BLOCK:
                end()
        elif c.tag == "br":
            now.append(" ")
        elif c.tag in BLOCK:
            end()
            todo.append(None)
            todo += c.children[::-1]
        else:
            todo += c.children[::-1]
    end()
    return out


def repeatable(nodes: list[Node], hashes: dict[int, int]) -> set[int]:
    """The hashes of subtrees that can be templates: whole blocks with text."""
    out: set[int] = set()
    todo: list[tuple[Node, Node | None]] = [(n, None) for n in nodes]
    above: dict[int, Node | None] = {}
    told: set[int] = set()
    while todo:
        node, parent = todo.pop()
        above[id(node)] = parent
        if any(isinstance(c, str) and not c.isspace() for c in node.children):
            up: Node | None = node
            while up is not None and id(up) not in told:
                told.add(id(up))
                if up.tag in WHOLE:
                    out.add(hashes[id(up)])
                up = above[id(up)]
        todo += [(c, node) for c in node.children if not isinstance(c, str) and not c.gone]
    return out


def context(rest: list[str]) -> np.ndarray:
    """A min-hash of the text's word triples for each factor. Near copies have most in common."""
    grams = {" ".join(rest[i : i + 3]) for i in range(max(1, len(rest) - 2))}
    found = np.array([zlib.crc32(g.encode(errors="replace")) + 1 for g in grams], np.uint64)
    return (found[:, None] * FACTORS).min(axis=0).view(np.int64)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, found = [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            root = parse(page or "")
            mine = repeatable([root], digests(root))
            hosts += [host] * len(mine)
            found += mine
        yield pa.RecordBatch.from_pydict({"host": pa.array(hosts, pa.string()), "subtree": pa.array(found, pa.int64())})


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, found, which, contexts = [], [], [], []
        for host, page, again in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "templates"))):
            top, _ = content(root := parse(page or ""))
            own = digests(root)
            if not (mine := frozenset(repeatable(top, own).intersection(again))):
                continue
            # Running lines that recur are no part of the rest either, whether or not they can go.
            rest = " ".join(blocks(top, mine, own, mine)).split()
            if rest and len(rest) >= MIN_REST * len(" ".join(blocks(top)).split()):
                for i, value in enumerate(context(rest).tolist()):
                    hosts += [host] * len(mine)
                    found += mine
                    which += [i] * len(mine)
                    contexts += [value] * len(mine)
        yield pa.RecordBatch.from_pydict(
            {"host": pa.array(hosts, pa.string()), "subtree": pa.array(found, pa.int64()), "i": pa.array(which, pa.int32()), "context": pa.array(contexts, pa.int64())}
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, gone, common in zip(*(batch.column(c).to_pylist() for c in ("html", "templates", "common"))):
            top, article = content(root := parse(page or ""))
            text = "\n".join(blocks(top, frozenset(gone), digests(root), frozenset(common)) if gone else blocks(top))
            # An article that other pages repeat is still the text of its own page.
            texts.append("\n".join(blocks(top)) if article and not text else text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def recurring(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, templates, common): the subtree hashes that are on at least min_pages pages and min_share of the host's, and
    those of them that are on over LINE_SHARE of the host's."""
    seen = pages.mapInArrow(_subtrees, "host string, subtree long").groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    many = seen.where(F.col("n") >= min_pages).join(totals, "host").where(F.col("n") >= min_share * F.col("pages"))
    common = F.when(F.col("n") > LINE_SHARE * F.col("pages"), F.col("subtree"))
    return many.groupBy("host").agg(F.collect_list("subtree").alias("templates"), F.collect_list(common).alias("common"))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, templates, common): the subtree hashes that recur on pages whose texts differ without what recurs; and as `recurring`."""
    again = small(staged(recurring(pages, min_pages, min_share), "site-repeats"))
    told = pages.join(again, "host").select("host", "html", "templates").mapInArrow(_contexts, "host string, subtree long, i int, context long")
    groups = told.groupBy("host", "subtree", "i", "context").agg(F.count(F.lit(1)).alias("n"))
    spread = groups.groupBy("host", "subtree", "i").agg(F.count(F.lit(1)).alias("n_values"), F.max("n").alias("most"), F.sum("n").alias("n"))
    sure = spread.groupBy("host", "subtree").agg(F.min("n_values").alias("n_values"), F.max(F.col("most") / F.col("n")).alias("alike"))
    sure = sure.where((F.col("n_values") >= min_pages) & (F.col("alike") <= MOST_ALIKE))
    return sure.groupBy("host").agg(F.collect_list("subtree").alias("templates")).join(again.select("host", "common"), "host")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of `pages` (page_id, url, html). A null html is empty; a url without
    a host, or null, belongs to the host ''. Repeated rows, and rows with a null page_id, are separate pages; no rows give no rows."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))
    read = pages.select("page_id", "url", "html", host.alias("host"))
    found = small(staged(templates(read.select("host", "html")), "site-templates"))
    none = F.array().cast("array<bigint>")
    joined = read.join(found, "host", "left").select("page_id", "url", "html", *(F.coalesce(c, none).alias(c) for c in ("templates", "common")))
    return joined.mapInArrow(_texts, "page_id long, url string, text string, n_chars long")


def op2_main_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
