import html
import math
import random
import re
from collections import defaultdict

from helpers import got, prose
from pyspark.sql import functions as F

from corpusml.llm import extraction

COLUMNS = ["page_id", "url", "text", "n_chars"]


def texts(spark, pages, **settings):
    rows = [(i, url, body) for i, (url, body) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("extra") for c in ("host", "body", "node", "text", "page", "low")})
    result = extraction.extract(df, **settings)
    assert result.columns == COLUMNS
    found = {r["page_id"]: r for r in result.collect()}
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) and r["url"] == pages[i][0] for i, r in found.items())
    return [found[i]["text"] for i in range(len(rows))]


def alone(source):
    return extraction.main_text(source, "h", lambda ids: {})


def plain_site(n, seed=0):
    """Pages without any telling tag or class: what is common has to be found."""
    out, wanted = [], []
    menu = "".join(f"<div><a href='/{w}'>{w}</a></div>" for w in prose(77, 6).split())
    for i in range(n):
        own = [prose(1000 * seed + 10 * i + k, 20) for k in range(3)]
        out.append(("http://plain.example/%d" % i, f"""<html><head><title>{own[0][:20]}</title></head><body><div class=x1>{menu}</div>
            <div class=x2><h1>{own[0]}</h1><p>{own[1]}</p><div>{prose(5, 12)}</div><p>{own[2]}</p></div>
            <table><tr><td>{prose(6, 8)}<td>Visitors: {i}</table><div class=x3>All rights with us {2000 + i}</div></body></html>"""))
        wanted.append(" ".join(own))
    return out, wanted


def test_style_tree_finds_what_a_site_repeats(spark):
    pages, wanted = plain_site(12)
    # Another site has the same tree with texts of its own, and one page alone is no evidence.
    other = ("http://other.example/1", pages[0][1].replace("x2", "y2"))
    found = texts(spark, [*pages, other])
    assert found[:12] == wanted
    assert wanted[0].split()[0] in found[12] and "All rights with us 2000" in found[12]
    assert texts(spark, [*pages, other], broadcast_rows=0) == found


def test_copies_and_shared_passages_are_no_template(spark):
    article, passage = prose(1, 60), prose(2, 40)
    # One article under many addresses, and one passage in many articles.
    copies = [("http://c.example/%d" % i, f"<html><title>t</title><body><div><h1>t</h1><p>{article}</p></div><div>{prose(100 + i, 5)}</div></body></html>") for i in range(20)]
    shared = [("http://c.example/s%d" % i, f"<html><title>{prose(i, 3)}</title><body><section><p>{passage if i % 2 else prose(300 + i, 9)}</p><p>{prose(200 + i, 9)}</p></section></body></html>") for i in range(20)]
    found = texts(spark, copies + shared)
    assert all(article in t for t in found[:20]) and all(passage in t for t in found[21::2])


def test_declared_parts_are_left_out():
    source = """<!DOCTYPE html><html lang=en><head><title>No</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body class="has-sidebar comments-open">
        <header><a href=/>Site</a></header><nav><ul><li>Menu</ul></nav><div id="cookie-notice">We use cookies</div><div class="adSlot ad">Buy</div>
        <article class="post comment-count-3"><header><h1>Head &amp; line</h1></header><p>One &lt;b&gt; <b>bold</b>ly<br>two&nbsp;three &#x41;&#66;<p>Second <span class="ad">no</span>para<ul><li>x<li>y</ul>
        <aside>Side</aside><div class="share-buttons social">Share</div><form><input value=no>Mail <button>Send</button></form><table><tr><td>a<td>b</table>
        <section id="comments"><h2>2 comments</h2><article class="comment">I think</article></section></article>
        <div role="complementary">Rail</div><p style="display: none">hidden</p><footer>&copy; us</footer></body></html>"""
    assert alone(source) == "Head & line One <b> boldly two three AB Second para x y a b"


def test_broken_markup():
    assert alone("") == "" and alone("plain  text\n only") == "plain text only"
    assert alone("a < b and <3 &amp; c<") == "a < b and <3 & c<"
    assert alone("<p>one<!-- <p>no</p> --><p>two<!-- never closed <p>no") == "one two"
    assert alone("<p>one <script>if (a < b) {}</script>two<script>never closed") == "one two"
    assert alone("<article><p>x</article><div>outside") == "x"
    assert alone('<p>one <a href="never closed>two</a> three</p>') == "one two three"
    assert alone("<p>one</p><p tw") == "one" and alone("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == "a b c d e"
    assert alone("<nav>x<p>y</nav>z") == "z" and alone("<b><p>x</b>y</p>z") == "xy z"
    assert alone("in<i>li</i>ne wo<wbr>rd<span>s</span>") == "inline words"
    assert alone("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert alone("<p>" + "word " * 200_000) == ("word " * 200_000).strip()
    assert alone("<main></main><article><p>x</p></article>") == "x"
    assert alone('<form id=f><article>inside a form</article></form>') == "inside a form"


def test_awkward_rows(spark):
    body = "<nav>menu</nav><article><p>text</p></article>"
    pages = [(None, None), (None, body), ("no url", body), ("http://h.example/1", ""), ("http://H.example:80/1", body), ("http://h.example/1", body), ("http://h.example/1", body)]
    assert texts(spark, pages) == ["", "text", "text", "", "text", "text", "text"]
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    rows = spark.createDataFrame([(None, "u", body), (1, "u", body), (1, "u", body)], "page_id long, url string, html string")
    for limit in (0, 10):
        assert got(extraction.extract(rows, broadcast_rows=limit), *COLUMNS) == [(None, "u", "text", 4), (1, "u", "text", 4), (1, "u", "text", 4)]


def test_importances_against_brute_force(spark):
    pages, _ = plain_site(8)
    pages += [("http://b.example/%d" % i, f"<title>{i}</title><div><p>{'ab'[i % 2]}</p><p>{prose(i, 4)}</p></div>" + "<p>x</p>" * (i % 3)) for i in range(9)]
    seen = defaultdict(set)
    for url, body in pages:
        unit, nodes, variants, leaves = extraction.evidence(body, re.sub(r"http://([^/]+)/.*", r"\1", url))
        for node, variant, leaf in zip(nodes, variants, leaves):
            seen[node, leaf].add((variant, unit))
    wanted = {}
    for (node, leaf), pairs in seen.items():
        k = defaultdict(int)
        for variant, _ in pairs:
            k[variant] += 1
        m = len(pairs)
        if m > 1:
            if leaf:
                own, share = 1 - sum(math.log(n, m) for n in k.values()) / len(k) * m / (m + extraction.PRIOR), 0.0
            else:
                share = extraction.DAMPING ** len(k)
                own = (1 - share) * -sum(n / m * math.log(n / m, m) for n in k.values())
            if own < extraction.THRESHOLD:
                wanted[node] = (round(own, 9), round(share, 9))
    df = spark.createDataFrame(pages, "url string, html string").select(extraction.host_of(F.col("url")).alias("host"), F.encode("html", "UTF-8").alias("body"))
    found = {r["node"]: (round(r["own"], 9), round(r["share"], 9)) for r in extraction.importances(df).collect()}
    assert found == wanted and len(wanted) > 10


def test_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r["page_id"]: r["text"] for r in extraction.extract(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        assert found[r["page_id"]] == " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", " ", inner).replace("<b>", "")).split())
