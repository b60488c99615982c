"""Main texts by site templates: articles of the given pages, made-up sites
against a plain count, awkward markup."""

import html
import random
import re
from collections import Counter, defaultdict

import pytest
from fixtures import prose
from pyspark.sql import types as T

from riskstream.llm import sitetemplate as st

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                       T.StructField("uid", T.StringType()), T.StructField("text", T.StringType())])


def texts(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "h", "u", "t") for r in rows], SCHEMA).repartition(3)
    got = st.main_texts(df, **kw).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return Counter((r.page_id, r.url, r.text) for r in got)


def test_articles_of_given_pages(spark):
    """The given pages' articles, cut out by the tags of this very generator."""
    sf = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?h1>|</?p>", inner.replace("<br>", " ").replace("<b>", ""))
        said = [" ".join(html.unescape(x).split()) for x in parts]
        want[r.page_id] = (r.url, "\n".join(x for x in said if x))
    got = {r.page_id: (r.url, r.text) for r in st.op13_site_templates(spark, sf).collect()}
    assert got == want


def site_pages():
    """Pages without an article element: template blocks with names that say
    nothing, some in all pages of a host and some in a few; copies of pages."""
    r = random.Random(5)
    rows, want = [], []
    frames = {h: [f"<div class=x{k}><p>{prose(100 * i + k, 9)}</p><ul><li>{prose(k, 2)}</ul></div>"
                  for k in range(3)] for i, h in enumerate(("a.example", "b.example"))}
    for i in range(60):
        host = "a.example" if i % 3 else "b.example"
        body = [prose(1000 + (i // 2 if i < 20 else i), 12) for _ in range(r.randint(1, 3))]
        top, side, foot = frames[host]
        content = "".join(f"<p>{b}</p>" for b in body)
        page = f"<html><body>{top}<div class=c>{content}</div>{side if i % 2 else ''}{foot}"
        rows.append((i, f"http://{host}/{i}", page))
        want.append((i, f"http://{host}/{i}", "\n".join(body)))
    shared = frames["a.example"][0]  # a template elsewhere, seen twice on this host
    for i in (100, 101):
        rows.append((i, "https://c.example/", f"{shared}<p>{prose(i, 8)}</p>"))
        inner = [t for t, _ in st.read_page(rows[-1][2])[0]]
        want.append((i, "https://c.example/", "\n".join(inner)))
    return rows, want


def test_templates_without_names(spark):
    rows, want = site_pages()
    assert texts(spark, rows) == Counter(want)


def test_counts_equal_plain(spark):
    """Templates against a plain count over main contents."""
    rows, _ = site_pages()
    seen = defaultdict(set)
    for _, url, page in rows:
        _, _, _, main, subtrees, _ = st.read_page(page)
        for h in subtrees:
            seen[st.host_of(url), h].add(main)
    df = spark.createDataFrame([(*r, "h", "u", "t") for r in rows], SCHEMA)
    parsed = df.selectExpr("page_id AS uid", "'1' AS id", "url", "html").mapInArrow(
        st.read_pages, st.PARSED)
    got = {(r.host, r.hash): r.n_pages for r in st.templates(parsed, 3, 2.0).collect()}
    assert got == {k: len(v) for k, v in seen.items() if len(v) >= 3} and got


def test_a_copied_article_is_no_template(spark):
    copy = "<div class=body>" + "".join(f"<p>{prose(k, 20)}</p>" for k in range(3)) + "</div>"
    rows = [(i, "http://h.example/x", f"<div class=n><p>{prose(50 + i, 5)}</p></div>{copy}")
            for i in range(12)]
    for _, _, text in texts(spark, rows):
        assert prose(1, 20) in text


def test_shared_paragraphs_stay(spark):
    """A line in many articles of a host is content; so is one outside articles
    below the share."""
    line = prose(77, 12)
    rows = [(i, "http://h.example/x", f"<article><p>{prose(300 + i, 9)}</p><p>{line}</article>")
            for i in range(10)]
    rows += [(100 + i, "http://g.example/x",
              f"<div><p>{prose(400 + i, 9)}</p>{f'<p>{line}' if i < 5 else ''}</div>")
             for i in range(12)]
    got = {i: t for i, _, t in texts(spark, rows)}
    assert all(line in got[i] for i in range(10)) and all(line in got[100 + i] for i in range(5))


def test_awkward_rows(spark):
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (None, "http://x.example", None),
            (2, "not a url", ""), ((1 << 53) + 1, "http://u@x.example:80/?q", "  "),
            (3, "http://x.example", "<nav>n</nav>"), (4, "http://x.example", "x" * 200_000)]
    want = [(i, u, "a" if h == "<p>a" else (h or "") if "x" * 9 in (h or "") else "")
            for i, u, h in rows]
    assert texts(spark, rows) == Counter(want)
    assert not texts(spark, [])


@pytest.mark.parametrize("page,want", [
    ("<p>a<p>b", ["a", "b"]),
    ("<ul><li>x<li>y<ul><li>z</ul><li>w</ul>", ["x", "y", "z", "w"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1 2", "3"]),
    ("a<script>var t='<p>';</SCRIPT>b<!-- c -->d<style>e", ["abd"]),
    ("İ<SCRIPT>a</script >t", ["İt"]),
    ("<p>x<br>y  &amp;&lt;b&gt; &#233;&eacute;", ["x y &<b> éé"]),
    ("<p title='a>b' hidden>t</p><p title=\"<p>\">u", ["u"]),
    ("<article><header><h1>T</h1><p>by</header><div class='notice'>n</div><p>t</p>"
     "<section id=comments><p>c</section><article>reader</article></article><p>out", ["T", "t"]),
    ("<main><p>m</p><form>f</form></main><aside>s</aside>", ["m"]),
    ("<body class='with-sidebar'><div class='page-header-fixed'><p>all of the text</div>",
     ["all of the text"]),
    ("<div class='ad'>x</div><p>a long enough text", ["a long enough text"]),
    ("1 < 2 & 3 > 2 <3", ["1 < 2 & 3 > 2 <3"]), ("<scr<p>x", ["x"]), ("<!-- x", []), ("<p", []),
    ("<b>" * 5000 + "x<p>y" + "<div>" * 5000 + "z" + "</p>" * 100, ["x", "y", "z"])])
def test_markup(page, want):
    assert [t for t, _ in st.read_page(page)[0]] == want
