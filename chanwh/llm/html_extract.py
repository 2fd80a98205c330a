"""Main text of web pages by wrapper induction.

A page is read into a *skeleton*, the tree of its block elements (tag and class; a run of equal
siblings is one node), and the text blocks below each node. Pages of one host are then aligned:
every skeleton is matched with the host's most frequent one by simple tree matching (the largest
order-preserving mapping between two trees with equal labels). A text that stands in the same node on
nearly all pages that align there is template; everything else is content.

Regions that say by tag, role or class that they are not article text (menus, adverts, forms,
comments and so on) are not content, whether or not they vary. Classes, ids and roles count as whole
words, never on article, main, headings or an element that the page's only articles are inside of. An
article or main element is what a page is about only if it has most of the text besides the template.

Node statistics are counts, sums of the texts' hash bits and sketches of the pages by (host, skeleton,
node), combined before they are shuffled, so a host with a third of all pages costs no more than its
number of skeletons.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanwh.llm.shared import written
from chanwh.llm.url_filter import host_and_path

BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
 figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td
 tfoot th thead tr ul caption""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; their text is skipped.
RAW = frozenset("script style textarea title noscript iframe template noembed noframes xmp svg math".split())
#: Elements that are never article text, and classes, ids and roles (whole ones) that say the same.
AWAY = frozenset("nav footer header aside form button select dialog menu head object canvas audio video".split())
AWAY_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion
 menu nav navbar navigation navigational breadcrumb breadcrumbs sidebar aside rail widget widgets footer foot masthead topbar toolbar
 header site-header page-header comment comments commentlist disqus respond replies reply cookie cookies consent gdpr notice notices
 alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended
 contentinfo complementary main-menu main-nav site-nav site-menu nav-menu nav-bar menu-bar side-bar site-footer page-footer
 footer-widgets sidebar-left sidebar-right left-sidebar right-sidebar comment-list comment-form comments-area cookie-notice cookie-banner
 cookie-consent cookie-bar ad-banner banner-ad social-links social-share share-buttons related-posts search-form newsletter-signup""".split())
MAIN_WORDS = frozenset({"main", "main-content", "maincontent"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
#: Elements to which the words do not apply.
UNNAMED = HEADINGS | {"html", "body", "main", "article"}
HEADING_IN_ARTICLE = frozenset({"header"})
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "option": {"option"}, "body": {"head"}}
LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "tbody": {"table"}, "tfoot": {"table"}}
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


class Node:
    """A node of the skeleton: its label, its children, and its number in preorder (set later)."""

    __slots__ = ("label", "kids", "number")

    def __init__(self, label: str):
        self.label, self.kids, self.number = label, [], -1


def attributes(text: str) -> tuple[str, set[str], bool]:
    """(first class, tokens of class, id and role, whether hidden)."""
    first, words, hidden = "", set(), False
    if text and not text.isspace():
        for m in ATTRIBUTE.finditer(text):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("hidden", "aria-hidden"):
                hidden |= name == "hidden" or value == "true"
                continue
            for token in value.split():
                words.add(token.replace("_", "-"))
            if name == "class":
                first = value.split()[0] if value.split() else ""
    return first, words, hidden


def read_page(html: str) -> tuple[str, list[tuple[int, str, bool, bool]]]:
    """(skeleton, blocks in page order). A block is (node, text, whether it is outside every region
    that is not content, whether it is inside an article or main element).

    Regions excluded by words, and forms, are content after all if the page has articles only inside of such."""
    root = Node("#")
    # open elements: tag, skeleton node, in an excluded region, in an article or main, begins an excluded
    # region, the innermost open region that may be content after all (-1: none)
    stack: list[tuple[str, Node, bool, bool, bool, int]] = [("#", root, False, False, False, -1)]
    found: list[tuple[Node, str, bool, bool, int]] = []
    # of these regions: the one around it, whether an article is inside
    around: list[int] = []
    holds: list[bool] = []
    free_article = False
    buffer: list[str] = []

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                _, node, away, main, _, region = stack[-1]
                found.append((node, text, not away, main, region))

    def close(tags, limit=()) -> None:
        """Close the innermost open element of ``tags``, unless one of ``limit`` is inside of it."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                if any(t[0] in BLOCK or t[4] for t in stack[k:]):
                    flush()
                del stack[k:]
                return
            if stack[k][0] in limit:
                return

    at, n = 0, len(html)
    while at < n:
        m = TOKEN.search(html, at)
        if not m:
            buffer.append(unescape(html[at:]))
            break
        if m.start() > at:
            buffer.append(unescape(html[at:m.start()]))
        at, tag = m.end(), m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "p" and not any(t[0] == "p" for t in stack):
                flush()
            else:
                close({tag}, () if tag in BLOCK else BLOCK)
            continue
        if tag == "br":
            buffer.append(" ")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else n
            continue
        first, words, hidden = attributes(m[3])
        _, parent, away, main, _, region = stack[-1]
        by_tag = hidden or (tag in AWAY and not (main and tag in HEADING_IN_ARTICLE))
        away_here = by_tag or (tag not in UNNAMED and bool(words & AWAY_WORDS))
        block = tag in BLOCK
        if block or away_here:
            flush()
            if block:
                close({"p"}, {"button", "table", "td", "th"}) if tag != "p" or any(t[0] == "p" for t in stack) else None
            if tag in CLOSED_BY:
                close(CLOSED_BY[tag], LIMITS.get(tag, ()))
            _, parent, away, main, _, region = stack[-1]
            if tag == "hr":
                continue
            label = f"{tag}.{first}" if first else tag
            if parent.kids and parent.kids[-1].label == label:
                node = parent.kids[-1]
            else:
                parent.kids.append(node := Node(label))
        else:
            node = parent
        article = tag in ("article", "main") or (tag not in HEADINGS and bool(words & MAIN_WORDS))
        if away_here and not main and not hidden and (not by_tag or tag == "form"):
            around.append(region)
            holds.append(False)
            region = len(around) - 1
        elif away_here:
            away = True
        if article and not away and not away_here:
            free_article |= region < 0
            up = region
            while up >= 0 and not holds[up]:
                holds[up], up = True, around[up]
        stack.append((tag, node, away, (main or article) and not away_here, away_here, region))
    flush()
    excluded: list[bool] = []
    for up, article_inside in zip(around, holds):
        excluded.append((up >= 0 and excluded[up]) or free_article or not article_inside)

    parts, number = [], 0
    todo: list = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            parts.append(node)
            continue
        node.number, number = number, number + 1
        parts.append("(" + re.sub(r"[()]", "", node.label))
        todo.append(")")
        todo.extend(reversed(node.kids))
    return "".join(parts), [(node.number, text, ok and (region < 0 or not excluded[region]), main) for node, text, ok, main, region in found]


def content_blocks(blocks: list[tuple[int, str, bool, bool]]) -> list[tuple[int, str]]:
    """The content of a page without a template: blocks outside the excluded regions, of the article if
    the page marks one that has most of their text."""
    kept = [b for b in blocks if b[2]]
    if 2 * sum(len(b[1]) for b in kept if b[3]) > sum(len(b[1]) for b in kept):
        kept = [b for b in kept if b[3]]
    return [(b[0], b[1]) for b in kept]


def parse_skeleton(text: str) -> list[tuple[str, list[int]]]:
    """(label, children's numbers) of each node, in preorder."""
    nodes: list[tuple[str, list[int]]] = []
    path: list[int] = []
    for m in re.finditer(r"\(([^()]*)|\)", text):
        if m[0] == ")":
            path.pop()
        else:
            if path:
                nodes[path[-1]][1].append(len(nodes))
            path.append(len(nodes))
            nodes.append((m[1], []))
    return nodes


def match_trees(a_text: str, b_text: str) -> list[int]:
    """Simple tree matching: for each node of ``a`` the node of ``b`` it is mapped to, or -1. Roots map
    to each other if their labels are equal; children are aligned in order by dynamic programming."""
    a, b = parse_skeleton(a_text), parse_skeleton(b_text)
    weights: dict[tuple[int, int], int] = {}
    tables: dict[tuple[int, int], list[list[int]]] = {}

    def weigh(x: int, y: int) -> int:
        """Nodes of the best mapping of the subtrees; children first, without recursion."""
        todo = [(x, y, False)]
        while todo:
            i, j, ready = todo.pop()
            if (i, j) in weights:
                continue
            if a[i][0] != b[j][0]:
                weights[i, j] = 0
                continue
            if not ready:
                todo.append((i, j, True))
                todo.extend((k, m, False) for k in a[i][1] for m in b[j][1] if (k, m) not in weights)
                continue
            table = [[0] * (len(b[j][1]) + 1)]
            for k in a[i][1]:
                above, row = table[-1], [0]
                for c, m in enumerate(b[j][1]):
                    row.append(max(row[-1], above[c + 1], above[c] + weights[k, m]))
                table.append(row)
            weights[i, j], tables[i, j] = table[-1][-1] + 1, table
        return weights[x, y]

    mapped = [-1] * len(a)
    if not a or not b or not weigh(0, 0):
        return mapped
    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        mapped[i] = j
        table, r, c = tables[i, j], len(a[i][1]), len(b[j][1])
        while r and c:
            k, m = a[i][1][r - 1], b[j][1][c - 1]
            if weights[k, m] and table[r][c] == table[r - 1][c - 1] + weights[k, m]:
                todo.append((k, m))
                r, c = r - 1, c - 1
            elif table[r][c] == table[r - 1][c]:
                r -= 1
            else:
                c -= 1
    return mapped


def hash64(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def read_pages(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Each page's host, skeleton and the blocks outside its excluded regions (node, text, hash of all the
    texts of the node, whether inside an article or main element)."""
    host, _ = host_and_path(url_col)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            skeletons, nodes, texts, hashes, mains = [], [], [], [], []
            for html in batch.column("html"):
                skeleton, blocks = read_page(html.as_py())
                blocks = [b for b in blocks if b[2]]
                skeletons.append(skeleton)
                nodes.append([b[0] for b in blocks])
                texts.append([b[1] for b in blocks])
                mains.append([b[3] for b in blocks])
                of: dict[int, list[str]] = {}
                for b in blocks:
                    of.setdefault(b[0], []).append(b[1])
                node_hash = {node: hash64("\n".join(own)) for node, own in of.items()}
                hashes.append([node_hash[b[0]] for b in blocks])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), batch.column("host"), pa.array(skeletons, pa.string()),
                 pa.array(nodes, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string())), pa.array(hashes, pa.list_(pa.int64())),
                 pa.array(mains, pa.list_(pa.bool_()))],
                names=["id", "url", "host", "skeleton", "nodes", "texts", "hashes", "mains"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(read, f"id {kinds['id']}, url {kinds['url']}, host string, skeleton string, nodes array<int>, texts array<string>, hashes array<bigint>, mains array<boolean>")


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def aligned(skeletons: pd.Series, references: pd.Series) -> pd.Series:
    return pd.Series([match_trees(a, b) for a, b in zip(skeletons, references)])


def template_nodes(read: DataFrame, least_pages: int, share: float) -> DataFrame:
    """(host, skeleton, drop): the nodes of each skeleton that are template on its host, with the hash of
    the template's text; a page with another text there keeps it. A reference node is template if
    ``share`` of the pages that align with it have the same text there, if these pages, whatever their
    skeletons, are at least ``share`` of the host's, and if they have at least ``least_pages`` different texts."""
    page = F.xxhash64(F.concat_ws("\n", "texts"))
    # one row for each page and node: the texts of a repeated node are taken together
    pages = read.where(F.col("host") != "")
    per_page = pages.select("host", "skeleton", page.alias("page"), F.explode(F.array_distinct(F.arrays_zip("nodes", "hashes"))).alias("b"))
    half = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned("b.hashes", k).bitwiseAND(half)).alias(f"s{k}") for k in range(32)]
    stats = written(per_page.groupBy("host", "skeleton", F.col("b.nodes").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("page", 10).alias("texts"), *sums), "slots")
    kinds = written(pages.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n")), "skeletons")
    hosts = kinds.groupBy("host").agg(F.max_by("skeleton", F.struct("n", "skeleton")).alias("reference"), F.sum("n").alias("pages"))
    maps = kinds.select("host", "skeleton").join(hosts, "host").withColumn("to", aligned("skeleton", "reference"))
    placed = stats.join(maps, ["host", "skeleton"]).withColumn("at", F.get("to", F.col("node"))).where(F.col("at") >= 0).drop("reference", "to")
    placed = written(placed, "placed")
    # a text that more than half of the pages have there has the hash whose bits are the majority's
    slots = placed.groupBy("host", "at").agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("texts")).alias("texts"),
                                             F.max("pages").alias("pages"), *(F.sum(f"s{k}").alias(f"s{k}") for k in range(32)))
    slots = slots.where((F.col("texts") >= least_pages) & (F.col("n") >= F.col("pages") * share))
    bits = []
    for k in range(32):
        low, high = F.col(f"s{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"s{k}", 32)
        bits += [F.when(c * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")) for c, b in ((low, k), (high, k + 32))]
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    slots = written(slots.select("host", "at", "n", bits[0].alias("h")), "slot-texts")
    nodes = placed.select("host", "skeleton", "node", "at").join(slots, ["host", "at"])
    # the pages that do have that text there are counted
    tried = written(nodes.groupBy("host", "skeleton").agg(F.collect_set(F.struct("node", "h", "at")).alias("tried")), "tried")
    has = F.filter("tried", lambda c: F.array_contains(F.arrays_zip("nodes", "hashes"), F.struct(c["node"].alias("nodes"), c["h"].alias("hashes"))))
    having = pages.select("host", "skeleton", "nodes", "hashes").join(tried, ["host", "skeleton"]).select("host", F.explode(has).alias("c"))
    having = having.groupBy("host", F.col("c.at").alias("at")).agg(F.count(F.lit(1)).alias("have"))
    constant = slots.join(having, ["host", "at"]).where((F.col("have") * 2 > F.col("n")) & (F.col("have") >= F.col("n") * share)).select("host", "at")
    drop = F.collect_set(F.struct(F.col("node").alias("nodes"), F.col("h").alias("hashes")))
    return nodes.join(constant, ["host", "at"]).groupBy("host", "skeleton").agg(drop.alias("drop"))


def extract_main_text(pages: DataFrame, least_pages: int = 5, share: float = 0.9, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (blocks joined by a line feed; empty if
    none), ``n_chars`` (its code points), ``template_blocks`` (blocks dropped as the host's template).

    A null page is an empty one. A page without a host, or of a host with fewer than
    ``least_pages`` different texts, has no template: only excluded regions are left out. Repeated
    pages cannot make their article template, as they are one text. Text outside any tag is a block.
    """
    read = written(read_pages(pages, id_col, url_col, html_col), "pages-read")
    drop = written(template_nodes(read, least_pages, share), "templates")
    # hosts x skeletons that have template nodes; Spark broadcasts them by its own size limit
    rows = read.join(drop, ["host", "skeleton"], "left").withColumn("drop", F.coalesce("drop", F.array().cast("array<struct<nodes:int,hashes:bigint>>")))
    kept = F.filter(F.arrays_zip("nodes", "texts", "hashes", "mains"), lambda b: ~F.array_contains(F.col("drop"), F.struct(b["nodes"].alias("nodes"), b["hashes"].alias("hashes"))))
    # what is left is the article's alone if that has most of it (as in content_blocks)
    rows = rows.withColumn("kept", kept).withColumn("article", F.filter("kept", lambda b: b["mains"]))
    chars = lambda blocks: F.aggregate(blocks, F.lit(0), lambda n, b: n + F.char_length(b["texts"]))
    body = F.when(chars("article") * 2 > chars("kept"), F.col("article")).otherwise(F.col("kept"))
    rows = rows.withColumn("body", body).withColumn("text", F.array_join(F.transform("body", lambda b: b["texts"]), "\n"))
    return rows.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("bigint").alias("n_chars"),
                       (F.size("nodes") - F.size("kept")).alias("template_blocks"))
