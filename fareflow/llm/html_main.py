"""Main text of web pages by site template removal (operator 3).

Every page is parsed whole into a tree, and each element subtree gets a hash
of its tags, attribute names and text.  Spark counts, per host, on how many
pages of different content each hash occurs; subtrees that recur on many of
them are the site's template and are deleted.  What is left is cleaned by
rule, which also covers hosts with too few pages to see a template: elements
that HTML marks as non-content (menus, headers, footers, asides, forms,
scripts, styles, class or id words for adverts, notices and comments) and, on
pages that mark their main content (``article`` / ``main``), whatever stands
outside it.

An article's own paragraphs are never deleted one by one for recurring: pages
that carry the same article count once.  Inside marked main content, containers
without paragraphs or headings (link lists, boxes) are judged like the rest of
a page.  Containers with some (notices, adverts, 'more stories') are judged by
the pages whose paragraphs outside the container differ; a page on which the
container holds most of the paragraphs' text does not count, because there it
may be the article.  An article that holds most of the paragraphs of the
``main`` around it is the main content in its place.

Pages are parsed twice: once for the hashes, which are kept on disk and
shuffled with page keys for counting, and once for the text that may be kept,
which travels once, without markup.  Its blocks name the hashes around them by
number within the page.  Few pages' trees are in memory at a time.

Defined results: null or empty html gives an empty text; repeated page ids
are separate rows; broken or unclosed markup is repaired by the usual rules
(a block start ends an open paragraph, an end tag closes up to its match, a
stray end tag is ignored); an unclosed script, style or comment ends with the
page; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import few_rows, keep_table

MIN_PAGES = 5
MIN_SHARE = 0.002
# On so many pages of different content a subtree is template on any host.
MAX_PAGES = 100
PAGES_PER_STEP = 128

# HTML element sets.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split())
DROPPED = frozenset(
    "nav aside footer form button select input menu dialog search object canvas audio video map"
    .split())
# Words in class, id or role that mark an element as not part of the article.
NOISE = frozenset(
    "ad ads advert advertisement adbox banner sponsor sponsored promo cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup login sidebar "
    "side nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar header "
    "masthead footer comment comments discussion disqus replies respond related recommended "
    "share sharing social widget skip complementary contentinfo dialog".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
WORD = re.compile(r"[a-z0-9]+")
P_ENDERS = BLOCK - {"body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr",
                    "li", "dd", "dt", "option", "optgroup", "legend", "summary", "figcaption"}
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote article main body html head".split())
PARAGRAPHS = frozenset("p pre blockquote".split())
CONTAINERS = frozenset("div section center details dl figure ol table ul".split())
SIBLING_ENDERS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                  "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"},
         "th": {"table"}, "option": {"select"}}


class Node:
    __slots__ = ("tag", "attrs", "kids", "parent")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.kids: list = []


def parse(html: str) -> Node:
    """A lenient tree: elements as nodes, text as strings, markup noise gone."""
    root = node = Node("#root", "", None)
    at, size = 0, len(html)
    while at < size:
        m = TOKEN.search(html, at)
        if m is None:
            node.kids.append(html[at:])
            break
        if m.start() > at:
            node.kids.append(html[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group().startswith("<![CDATA["):
                node.kids.append(m.group()[9:-3].replace("&", "&amp;"))
            continue
        name = name.lower()
        if m.group(1):
            up = node
            while up is not None and up.tag != name:
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end and not m.group(3).endswith("/") else at if end else size
            continue
        if name in P_ENDERS:
            node = _close(node, {"p"}, {"button", "td", "th", "li", "article", "main", "section",
                                        "div", "body"})
        if name in SIBLING_ENDERS:
            node = _close(node, SIBLING_ENDERS[name], SCOPE[name])
        new = Node(name, m.group(3), node)
        node.kids.append(new)
        if name not in VOID and not m.group(3).endswith("/"):
            node = new
    return root


def _close(node: Node, tags: set, scope: set) -> Node:
    """Close the nearest open element of ``tags`` that lies within ``scope``."""
    up = node
    while up.parent is not None and up.tag not in scope:
        if up.tag in tags:
            return up.parent
        up = up.parent
    return node


def _noise(node: Node, inside: bool) -> bool:
    if node.tag in DROPPED or node.tag == "header":
        # A header or footer of the article itself may hold its title.
        if node.tag == "header" and inside:
            return False
        return True
    if not node.attrs or node.tag in ("body", "html", "article", "main"):
        return False
    for name, value in ATTR.findall(node.attrs):
        low = name.lower()
        if low in ("class", "id", "role", "data-role") and not NOISE.isdisjoint(
                WORD.findall(value.lower())):
            return True
        if low == "aria-hidden" and value.strip("\"'").lower() == "true":
            return True
    return re.search(r"(?:^|\s)hidden(?:\s|$)", node.attrs) is not None


def _find_main(node: Node, out: list) -> None:
    stack = [node]
    while stack:
        n = stack.pop()
        if n.tag == "main" and not _noise(n, False):
            inner = [x for k in n.kids if isinstance(k, Node) for x in _articles(k)]
            sums = paragraph_sums(n) if inner else {}
            most = 2 * sum(sums[id(x)][1] for x in inner) > sums[id(n)][1] if inner else False
            out += inner if most else [n]
        elif n.tag == "article" and not _noise(n, False):
            out.append(n)
        else:
            stack += [k for k in reversed(n.kids) if isinstance(k, Node)
                      and not _noise(k, False)]


def _articles(node: Node) -> list[Node]:
    """The outermost articles of a subtree, in page order."""
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if _noise(n, True):
            continue
        if n.tag == "article":
            out.append(n)
        else:
            stack += [k for k in reversed(n.kids) if isinstance(k, Node)]
    return out


def _text(node: Node) -> str:
    parts, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            parts.append(n)
        else:
            stack += reversed(n.kids)
    return " ".join("".join(parts).split())


def paragraph_sums(root: Node) -> dict[int, tuple[int, int]]:
    """Per subtree by ``id(node)``: sum of its paragraphs' hashes, and their characters.

    Paragraphs that the rules drop count for nothing; what a paragraph holds
    counts with it and has no entry.
    """
    sums: dict[int, tuple[int, int]] = {}
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        if n is not root and _noise(n, True):
            sums[id(n)] = (0, 0)
        elif n.tag in PARAGRAPHS:
            text = _text(n)
            sums[id(n)] = (xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")), len(text))
        else:
            order.append(n)
            stack += [k for k in n.kids if isinstance(k, Node)]
    for n in reversed(order):
        kids = [sums[id(k)] for k in n.kids if isinstance(k, Node)]
        sums[id(n)] = sum(h for h, _ in kids) & (1 << 64) - 1, sum(c for _, c in kids)
    return sums


def subtree_hashes(root: Node) -> tuple[dict[int, int], set[int]]:
    """Signed 64-bit hash of every subtree by ``id(node)``; ids of those with prose."""
    done: dict[int, int] = {}
    prose: set[int] = set()
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack += [k for k in n.kids if isinstance(k, Node)]
    for n in reversed(order):
        names = "|".join(sorted(x for x, _ in ATTR.findall(n.attrs))) if n.attrs else ""
        parts = [n.tag, names]
        for k in n.kids:
            if isinstance(k, Node):
                parts.append(str(done[id(k)]))
                if id(k) in prose:
                    prose.add(id(n))
            else:
                parts.append(" ".join(k.split()))
        if n.tag in PROSE:
            prose.add(id(n))
        x = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))
        done[id(n)] = x - (1 << 64) if x >> 63 else x
    return done, prose


def page_blocks(html: str | None) -> tuple[int, list[tuple[str, list[int], bool]],
                                           dict[int, int | None]]:
    """The page's content hash, its blocks in page order, and what else containers count by.

    A block is ``(text, hashes of the judged subtrees around it, by_rule)``;
    ``by_rule`` blocks are never part of the result and carry no text.  A
    container with paragraphs inside main content counts by the hash of the
    paragraphs outside it, or not at all (None).
    """
    if not html:
        return 0, [], {}
    root = parse(html)
    mains: list[Node] = []
    _find_main(root, mains)
    hashes, prose = subtree_hashes(root)
    in_main = {id(n) for n in mains}
    content = hash_list([hashes[id(n)] for n in mains or [root]])
    blocks: list[tuple[str, list[int], bool]] = []
    run: list[str] = []
    rests: dict[int, int | None] = {}
    sums: dict[int, tuple[int, int]] = {}

    def rest_of(n: Node) -> int | None:
        if not sums:
            for m in mains:
                sums.update(paragraph_sums(m))
        own, size = sums.get(id(n), (0, 0))
        whole = sum(sums[id(m)][0] for m in mains)
        if 2 * size > sum(sums[id(m)][1] for m in mains):
            return None
        return hash_list([(whole - own) & (1 << 64) - 1])

    def flush(path: tuple, rule: bool) -> None:
        if run:
            text = " ".join(unescape("".join(run)).split())
            if text:
                blocks.append(("" if rule else text, list(path), rule))
            run.clear()

    # (node or text, hashes around it, inside main, dropped by rule, closing?)
    stack: list[tuple] = [(root, (), False, bool(mains), False)]
    while stack:
        n, path, inside, rule, closing = stack.pop()
        if closing:
            flush(path, rule)
            continue
        if isinstance(n, str):
            run.append(n)
            continue
        if n.tag in ("br", "wbr", "head", "hr"):
            run.append("" if n.tag == "wbr" else " ")
            continue
        around, around_rule = path, rule
        if id(n) in in_main:
            inside, rule = True, False
        elif _noise(n, inside):
            rule = True
        if n.parent is not None and (id(n) not in prose if inside or rule
                                     else n.tag not in ("html", "body")):
            path = (*path, hashes[id(n)])
        elif inside and not rule and n.tag in CONTAINERS:
            path = (*path, hashes[id(n)])
            rests[hashes[id(n)]] = rest_of(n)
        if n.tag in BLOCK or n.tag == "#root" or rule != around_rule:
            flush(around, around_rule)
            stack.append((n, path, inside, rule, True))
        stack += [(k, path, inside, rule, False) for k in reversed(n.kids)]
    flush((), bool(mains))
    return content, blocks, rests


def hash_list(values: list[int]) -> int:
    x = xxhash.xxh3_64_intdigest(",".join(map(str, values)).encode())
    return x - (1 << 64) if x >> 63 else x


def host_of(url: F.Column) -> F.Column:
    """Lower-case host of a URL; empty if it has none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)),
                      F.lit(""))


MARKED = ("host string, row_key long, content long, around array<long>, "
          "others array<struct<h:long,content:long>>")
PARSED = ("page_id long, url string, row_key long, "
          "blocks array<struct<text:string,around:array<int>,rule:boolean>>")


def _numbers(blocks: list[tuple[str, list[int], bool]]) -> dict[int, int]:
    """The distinct hashes around a page's blocks, numbered as they come."""
    return {h: i for i, h in enumerate(dict.fromkeys(h for _, a, _ in blocks for h in a))}


def _mark_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its content hash, the hashes around its blocks, and what else these count by."""
    other = pa.list_(pa.struct([("h", pa.int64()), ("content", pa.int64())]))
    for b in few_rows(batches, PAGES_PER_STEP):
        content, around, others = [], [], []
        for html in b.column(2).to_pylist():
            c, blocks, rests = page_blocks(html)
            numbers = _numbers(blocks)
            content.append(c)
            around.append(list(numbers))
            others.append([{"h": h, "content": x} for h, x in rests.items() if h in numbers])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(content, pa.int64()),
             pa.array(around, pa.list_(pa.int64())), pa.array(others, other)],
            names=["host", "row_key", "content", "around", "others"])


def _parse_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page its blocks, each with the numbers of the hashes around it."""
    kind = pa.list_(pa.struct([("text", pa.string()), ("around", pa.list_(pa.int32())),
                               ("rule", pa.bool_())]))
    for b in few_rows(batches, PAGES_PER_STEP):
        rows = []
        for html in b.column(3).to_pylist():
            _, blocks, _ = page_blocks(html)
            numbers = _numbers(blocks)
            out: list[dict] = []
            for t, a, r in blocks:
                # Neighbours that are sure to stay travel as one block.
                if out and not (a or r or out[-1]["around"] or out[-1]["rule"]):
                    out[-1]["text"] += "\n" + t
                else:
                    out.append({"text": t, "around": [numbers[h] for h in a], "rule": r})
            for x in out:
                x["text"] = x["text"].encode("utf-8", "replace").decode()
            rows.append(out)
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(rows, kind)],
                                         names=["page_id", "url", "row_key", "blocks"])


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", min_pages: int = MIN_PAGES,
              min_share: float = MIN_SHARE, max_pages: int = MAX_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars, n_template, n_rule`` of every page.

    A subtree is template if it occurs on at least ``min_pages`` pages of
    different content of its host and on ``min_share`` of the host's pages of
    different content, or on ``max_pages`` of them.
    ``n_template`` / ``n_rule`` count the blocks that recurrence / only the
    rules have deleted.
    """
    html = F.col(html_col)
    row_key = F.xxhash64(F.col(id_col), F.col(url_col), html).alias("row_key")
    # The hashes are few bytes and used three times; the texts are parsed out
    # once more, rather than kept on disk beside the shuffle.
    marked = keep_table(
        pages.select(host_of(F.col(url_col)).alias("host"), row_key, html.alias("html"))
        .mapInArrow(_mark_pages, MARKED), "page-marks")
    parsed = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                           row_key, html.alias("html"))
              .mapInArrow(_parse_pages, PARSED))
    marks = marked.select("host", "row_key", F.posexplode("around").alias("number", "h"))
    votes = F.concat(
        F.transform(F.array_except("around", F.col("others")["h"]),
                    lambda h: F.struct(h.alias("h"), F.col("content").alias("content"))),
        F.filter("others", lambda x: x["content"].isNotNull()))
    # Distinct contents first, so that a hot host's subtree is one row per
    # content and task before it is counted.
    seen = (marked.select("host", F.inline(votes)).distinct()
            .groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_pages")))
    hosts = (marked.select("host", "content").distinct()
             .groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")))
    enough = F.least(F.col("host_pages") * min_share, F.lit(float(max_pages)))
    template = (seen.filter(F.col("n_pages") >= min_pages).join(hosts, "host")
                .filter(F.col("n_pages") >= enough).select("host", "h"))
    found = (marks.join(template, ["host", "h"])
             .groupBy("row_key").agg(F.collect_set("number").alias("template")))
    known = F.coalesce("template", F.array().cast("array<int>"))
    hit = lambda b: F.arrays_overlap(b["around"], F.col("known"))
    judged = parsed.join(found, "row_key", "left").withColumn("known", known)
    kept = F.filter("blocks", lambda b: ~b["rule"] & ~hit(b))
    return (judged.select(
        "page_id", "url", F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias("text"),
        F.size(F.filter("blocks", hit)).alias("n_template"),
        F.size(F.filter("blocks", lambda b: b["rule"] & ~hit(b))).alias("n_rule"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .select("page_id", "url", "text", "n_chars", "n_template", "n_rule"))
