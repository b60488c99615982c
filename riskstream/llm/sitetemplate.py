"""Main text of web pages by removing site templates (operator 13).

Every element subtree of a page gets a hash of its tags and texts.  Spark counts
on how many pages of its host each subtree stands; a subtree that recurs on
``MIN_PAGES`` pages or more is template and is deleted.  Pages with one main
content count once, so copies of an article don't make it template.

What no count can show goes by markup: navigation, headers, footers, asides,
forms, scripts, styles, and elements whose class, id or role says that they are
menus, notices, adverts or comments.  If a page has an ``<article>`` (else a
``<main>``), the text is taken from there.

The html is read once; what goes on is its text blocks, each with the hashes of
the elements around it that may be deleted.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskstream.llm.common import small_batches, table, written

#: Pages of a host with different main content from which on a subtree is template.
MIN_PAGES = 4
#: Share of a host's pages from which on a plain paragraph outside an article is
#: template: paragraphs also recur as shared passages.
MIN_SHARE = 0.5

# HTML element names by what they mean for text, and the words
# by which sites name the parts that are not the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt "
            "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li "
            "main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADING | set("p li blockquote pre dd dt tr figcaption caption summary".split())
DROP = RAW | set("head nav footer aside form noscript template svg select button menu dialog "
                 "search object audio video canvas".split())
SAYS = set("ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo "
           "promotion banner banners nav navbar navigation menu menus breadcrumb breadcrumbs sidebar "
           "sidebars aside footer footers header headers masthead topbar cookie cookies consent gdpr "
           "notice notices notification notifications alert alerts popup modal overlay newsletter "
           "subscribe subscription signup share sharing social related recommended recommendations "
           "comment comments commentlist disqus replies reply respond widget widgets toolbar "
           "pagination pager skip login search form forms contentinfo complementary".split())
#: Said of an article itself, these make it none.
NOT_MAIN = set("ad advert advertisement sponsor sponsored promo related recommended comment "
               "comments reply replies respond teaser".split())
#: Elements that a start tag closes, and elements that such a search or an end
#: tag doesn't leave.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
          "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
FENCE = {"ul": {"li"}, "ol": {"li"}, "menu": {"li"}, "dl": {"dt", "dd"},
         "table": {"tr", "td", "th", "thead", "tbody", "tfoot"}}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*"
                   r"(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
WORDS = re.compile(r"[a-z0-9]+")
RAW_END = {tag: re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I | re.A) for tag in RAW}
HOST = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]+)")


class Node:
    """An element: kids are nodes and texts in order."""
    __slots__ = ("tag", "parent", "block", "kids", "named", "says", "drop", "main", "hash", "size")

    def __init__(self, tag: str, parent: Node | None, said: str = ""):
        self.tag, self.parent, self.kids = tag, parent, []
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.drop, self.hash, self.size = tag in DROP, 0, 0
        self.main = tag if tag in ("article", "main") else ""
        self.named = self.says = False
        if said:
            found = {k.lower(): (a or b or c).lower() for k, a, b, c in NAMED.findall(said)}
            words = {w for k in ("class", "id", "role") for w in WORDS.findall(found.get(k, ""))}
            self.named = bool(words)
            if found.get("itemprop") == "articlebody" or found.get("role") == "article":
                self.main = "article"
            elif found.get("role") == "main":
                self.main = "main"
            self.says = bool(words & (NOT_MAIN if self.main else SAYS)) and tag not in HEADING
            self.drop |= bool(HIDDEN.search(said))


def parse(page: str) -> list[Node]:
    """The page's elements in order of their start tags, the root first.

    Tags may be left open: a paragraph ends at the next block, an item at the
    next item, and an end tag closes all that is open inside its element.
    """
    root = now = Node("html", None)
    nodes, is_open = [root], Counter()
    at, end = 0, len(page)

    def close(node: Node) -> Node:
        """Close all from ``now`` up to ``node``; its parent is open then."""
        x = now
        while True:
            is_open[x.tag] -= 1
            if x is node:
                return x.parent
            x = x.parent

    while at < end:
        m = TOKEN.search(page, at)
        now.kids.append(page[at:m.start() if m else end])
        if m is None:
            break
        at = m.end()
        tag, said = (m[1] or m[2] or "").lower(), m[3] or ""
        if m[1]:
            if tag == "br":
                now.kids.append(" ")
            up = now if is_open[tag] else None
            while up is not None and up.tag != tag:
                up = None if tag in FENCE.get(up.tag, ()) else up.parent
            if up is not None:
                now = close(up)
        elif tag and tag != "html":
            if tag in BLOCK:
                if now.block.tag == "p":
                    now = close(now.block)
                if tag in HEADING and now.tag in HEADING:
                    now = close(now)
            if tag in CLOSES and any(is_open[x] for x in CLOSES[tag]):
                up, found = now, None
                while up is not None and up.tag not in FENCE:
                    found = up if up.tag in CLOSES[tag] else found
                    up = up.parent
                if found is not None:
                    now = close(found)
            node = Node(tag, now, said)
            now.kids.append(node)
            nodes.append(node)
            if tag in RAW:
                stop = RAW_END[tag].search(page, at)
                at = stop.end() if stop else end
            elif tag not in VOID:
                now = node
                is_open[tag] += 1
    return nodes


def clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def digest(parts: list[str]) -> int:
    said = "\x00".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(said, digest_size=8).digest(), "big", signed=True)


def measure(nodes: list[Node]) -> None:
    """Hashes and text sizes of all subtrees, from the leaves up; elements that
    go by what their markup says are marked."""
    for x in reversed(nodes):
        parts, size = [x.tag], 0
        for k in x.kids:
            if isinstance(k, Node):
                parts.append(str(k.hash))
                size += 0 if k.drop else k.size
            elif k and not k.isspace() and x.tag not in RAW:
                parts.append(clean(k))
                size += len(parts[-1])
        x.hash, x.size = digest(parts), size
    holds = set()
    for x in nodes:
        if x.main and not x.drop and not x.says and x.size:
            while x is not None and id(x) not in holds:
                holds.add(id(x))
                x = x.parent
    for x in nodes:
        if x.says and id(x) not in holds:
            x.drop |= bool(holds) or 2 * x.size <= nodes[0].size


def scopes(nodes: list[Node]) -> list[Node]:
    """The outermost articles, else the outermost main elements, else the page."""
    gone, found = set(), {"article": [], "main": []}
    for x in nodes:
        if x.drop or (x.parent is not None and id(x.parent) in gone):
            gone.add(id(x))
        elif x.main and x.size:
            found[x.main].append(x)
    for kind in ("article", "main"):
        own = {id(x) for x in found[kind]}
        outer = []
        for x in found[kind]:
            up = x.parent
            while up is not None and id(up) not in own:
                up = up.parent
            if up is None:
                outer.append(x)
            elif kind == "article" and up.size > x.size:
                x.drop = True  # an article in an article is a reader's comment
        if outer:
            return outer
    return nodes[:1]


def read_page(page: str):
    """Text blocks, each with the number of the nearest element around it that
    may be template (or -1); these elements' hashes and the numbers of such
    elements around them; the hash of the main content; all subtrees' hashes
    (elements, and plain paragraphs of a page without article)."""
    nodes = parse(page)
    measure(nodes)
    inside = scopes(nodes)
    in_article = inside[0] is not nodes[0]
    never = {id(nodes[0])}
    for x in inside:
        while x is not None and id(x) not in never:
            never.add(id(x))
            x = x.parent
    subtrees, plain, candidate = [], [], {}
    for x in nodes:
        if x.size and x.tag in BLOCK and x.tag != "body" and id(x) not in never:
            if x.tag not in PROSE or x.named:
                candidate[id(x)] = x.hash
                subtrees.append(x.hash)
            elif not in_article:
                candidate[id(x)] = digest(["plain", str(x.hash)])
                plain.append(candidate[id(x)])
    blocks, text, hashes, parents, near = [], [], [], [], -1

    def flush() -> None:
        said = clean_join(text)
        if said:
            blocks.append((said, near))
        text.clear()

    # (node, element around it, only headings) or a text, or None at a block's end
    for top in inside:
        stack = [(top, -1, False)]
        while stack:
            x, at, only = stack.pop()
            if isinstance(x, str):
                if not only and x:
                    text.append(x)
                    near = at
                continue
            if x is None:
                flush()
                continue
            if x.drop:
                continue
            if x.tag in ("br", "td", "th", "img"):
                text.append(" ")
            if id(x) in candidate:
                hashes.append(candidate[id(x)])
                parents.append(at)
                at = len(hashes) - 1
            only = (only or x.tag == "header" and in_article) and x.tag not in HEADING
            kids = [(k, at, only) for k in x.kids]
            if x.tag in BLOCK:
                flush()
                stack.append((None, -1, False))
            stack.extend(reversed(kids))
        flush()
    if in_article:
        main = digest([t for t, _ in blocks])
    else:
        own = [(sum(k.size for k in x.kids if isinstance(k, Node) and k.tag in PROSE), -i)
               for i, x in enumerate(nodes) if not x.drop]
        main = nodes[-max(own)[1]].hash if own else 0
    return blocks, hashes, parents, main, subtrees, plain


def clean_join(text: list[str]) -> str:
    return " ".join("".join(entities.unescape(t) for t in text).split())


PARSED = ("uid long, id string, url string, host string, main long, may_lose boolean, "
          "texts array<string>, near array<int>, hashes array<long>, parents array<int>, "
          "subtrees array<long>, plain array<long>")
ARROW = pa.schema([
    ("uid", pa.int64()), ("id", pa.string()), ("url", pa.string()), ("host", pa.string()),
    ("main", pa.int64()), ("may_lose", pa.bool_()),
    ("texts", pa.list_(pa.string())), ("near", pa.list_(pa.int32())),
    ("hashes", pa.list_(pa.int64())), ("parents", pa.list_(pa.int32())),
    ("subtrees", pa.list_(pa.int64())), ("plain", pa.list_(pa.int64()))])


def host_of(url: str | None) -> str | None:
    m = HOST.match(url or "")
    return m[1].lower() if m else None


def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: (uid, id, url, html) to rows of ``PARSED``."""
    for rows in batches:
        out = []
        for uid, doc_id, url, page in zip(*(rows.column(i).to_pylist() for i in range(4)),
                                          strict=True):
            blocks, hashes, parents, main, subtrees, plain = read_page(page or "")
            out.append({"uid": uid, "id": doc_id, "url": url, "host": host_of(url), "main": main,
                        "may_lose": any(n >= 0 for _, n in blocks),
                        "texts": [t for t, _ in blocks], "near": [n for _, n in blocks],
                        "hashes": hashes, "parents": parents, "subtrees": list(set(subtrees)), "plain": list(set(plain))})
        yield pa.RecordBatch.from_pylist(out, schema=ARROW)


LEFT = "id string, url string, texts array<string>"
LEFT_ARROW = pa.schema([("id", pa.string()), ("url", pa.string()), ("texts", pa.list_(pa.string()))])


def left(texts: list[str], near: list[int], hashes: list[int], parents: list[int],
         lost: set[int]) -> list[str]:
    """The texts that stand in no lost element; parents come before their kids."""
    gone = []
    for h, up in zip(hashes, parents, strict=True):
        gone.append(h in lost or (up >= 0 and gone[up]))
    return [t for t, n in zip(texts, near, strict=True) if n < 0 or not gone[n]]


def without_lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        yield pa.RecordBatch.from_pylist(
            [{"id": r["id"], "url": r["url"], "texts": left(
                r["texts"], r["near"], r["hashes"], r["parents"], set(r["lost"] or ()))}
             for r in rows.to_pylist()], schema=LEFT_ARROW)


def templates(parsed: DataFrame, min_pages: int = MIN_PAGES,
              min_share: float = MIN_SHARE) -> DataFrame:
    """host, hash, n_pages: subtrees on many pages of a host with different main
    content.  Pages without a host have no site."""
    sites = parsed.filter("host IS NOT NULL")
    seen = lambda col: (sites.select("host", "main", F.explode(col).alias("hash")).distinct()
                        .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n_pages")))
    pages = (sites.select("host", "main").distinct().groupBy("host")
             .agg(F.count(F.lit(1)).alias("pages")))
    paragraphs = (seen("plain").filter(F.col("n_pages") >= min_pages).join(pages, "host")
                  .filter(F.col("n_pages") >= min_share * F.col("pages")).drop("pages"))
    return seen("subtrees").filter(F.col("n_pages") >= min_pages).unionByName(paragraphs)


def main_texts(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html",
               min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """A row per row of ``pages``: its id, url, ``text`` (blocks joined by a line
    feed) and ``n_chars``.

    Null and empty pages, and pages without text, give an empty text.  Null ids
    and repeated rows stay rows of their own; a page without a host in its url
    loses nothing by count.  An empty table gives no rows.  Other columns are
    ignored, whatever their names.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.monotonically_increasing_id().alias("uid"),
                        F.col(page_id).cast("string").alias("id"), F.col(url).alias("url"),
                        F.col(html).alias("html"))
    parsed = written(rows.mapInArrow(read_pages, PARSED), "site-pages")
    may_lose = parsed.filter("may_lose")
    around = may_lose.select("uid", "host", F.explode(F.array_distinct("hashes")).alias("hash"))
    lost = (around.join(templates(parsed, min_pages, min_share), ["host", "hash"])
            .groupBy("uid").agg(F.collect_set("hash").alias("lost")))
    cut = (may_lose.join(lost, "uid", "left")
           .select("id", "url", "texts", "near", "hashes", "parents", "lost")
           .mapInArrow(without_lost, LEFT))
    out = parsed.filter("NOT may_lose").select("id", "url", "texts").unionByName(cut)
    text = F.array_join("texts", "\n")
    return out.select(F.col("id").cast(pages.schema[page_id].dataType).alias(page_id),
                      F.col("url").alias(url), text.alias("text"),
                      F.length(text).cast("long").alias("n_chars"))


def op13_site_templates(spark, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))
