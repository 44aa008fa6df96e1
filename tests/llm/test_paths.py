"""Articles of the given pages and of other layouts, and the queries' sums against plain Python."""

from __future__ import annotations

import html
import random
import re

import pytest

import __spark_entry__ as entries
from statloom.llm import paths

COLUMNS = "page_id long, url string, html string"


def plain_article(page):
    """The blocks of the article element, for pages built like the given ones."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = (re.sub(r"</?[a-zA-Z][^>]*>", "", b) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))


def test_given_pages(spark):
    rows = spark.read.parquet(f"{entries.SMOKE_DIR}/pages.parquet").collect()
    got = entries.queries()["op11_tag_path_ratios"](spark, entries.SMOKE_DIR).collect()
    want = sorted((r.page_id, r.url, plain_article(r.html)) for r in rows)
    assert sorted(tuple(r)[:3] for r in got) == want
    assert all(r.n_chars == len(r.text) for r in got) and any("&" in r.text for r in got)


def prose(rng, sentences):
    word = lambda: "".join(rng.choice("abcdeilmnorst") for _ in range(rng.randint(2, 9)))
    return " ".join(" ".join(word() for _ in range(rng.randint(6, 16))).capitalize() + "."
                    for _ in range(sentences))


LAYOUTS = {
    "divs": '<body><div id="top"><a href="/">Home</a> <a href="/x">More</a></div><div class="wrap">'
            '<div class="post"><h2>{title}</h2>{paragraphs}</div><div class="sidebar"><h3>Popular now</h3>'
            '<p>{other}</p></div></div><div class="footer">All rights. {other}</div></body>',
    "comments": "<body><header><p>{other}</p></header><main><article><header><h1>{title}</h1></header>{paragraphs}"
                "</article><section id=comments><h3>Two comments</h3><p>{long}</p><p>{long}</p></section></main>"
                "<aside><p>{other}</p></aside></body>",
    "notice": "<body class='page with-sidebar'><div role='dialog' class=\"cookie-notice\"><p>{long}</p></div>"
              "<h1>{title}</h1>{paragraphs}<form><label>{other}</label><textarea>{other}</textarea>"
              "<input value='x'><button>Send it.</button></form><script>if (a < b) {{ x('</p>') }}</script></body>",
    "table": "<table><tr><td class=menu><a href=a>One</a><br><a href=b>Two</a><td><h1>{title}</h1>{paragraphs}"
             "</td></tr></table><!-- <p>{other}</p> --><div class='newsletter-signup'>{other}</div>",
}


def made(rng, layout):
    title, paragraphs = prose(rng, 1)[:30].strip(), [prose(rng, rng.randint(1, 4)) for _ in range(rng.randint(3, 6))]
    paragraphs.insert(2, "Short one")
    page = LAYOUTS[layout].format(
        title=title, paragraphs="".join(f"<p>{p.replace(' ', ' <i>', 1).replace('.', '</i>.', 1)}" for p in paragraphs),
        other=prose(rng, 1), long=prose(rng, 5))
    return page, "\n\n".join([title, *paragraphs])


@pytest.mark.parametrize("layout", LAYOUTS)
def test_other_layouts(spark, layout):
    rng = random.Random(layout)
    pages = [made(rng, layout) for _ in range(30)]
    df = spark.createDataFrame([(i, f"http://{layout}.example/{i}", p) for i, (p, _) in enumerate(pages)], COLUMNS)
    got = {r.page_id: r.text for r in paths.extract(df).collect()}
    assert got == {i: text for i, (_, text) in enumerate(pages)}


def test_host_ratios(spark):
    """A host's ratio pools its pages, copies included; a hot host's too."""
    pages = [(i, f"HTTP://A.example:80/{i}" if i else None, "<p>" + "one, two." * (i % 5) + "</p><div>x<p>y")
             for i in range(40)] + [(3, "HTTP://A.example:80/3", "<p>" + "one, two." * 3 + "</p><div>x<p>y")] * 2
    df = spark.createDataFrame(pages, COLUMNS).repartition(5)
    keyed = paths._keyed(df)
    sums = {}
    for _, url, text in pages:
        for path, *own in paths.path_sums(paths.Page(text)):
            sums.setdefault((url is not None, path), []).append(own)
    want = {k: paths.ratio(*map(sum, zip(*v))) for k, v in sums.items()}
    rows = keyed.select("url", "key").distinct().join(paths.host_ratios(keyed), "key").collect()
    assert len(rows) == 40
    for r in rows:
        for path, value in r.ratios.items():
            assert value == pytest.approx(want[r.url is not None, path])


def test_text_nodes():
    page = paths.Page("a<p>b &lt;i&gt; <b>c</b>d<p>e<br>f<li>g<li>h</ul></nonsense><p class='X-1 y' id=z>i")
    assert page.texts == ["a", "b <i> ", "c", "d", "e ", "f", "g", "h", "i"]
    assert page.block == sorted(page.block) and page.block[1:4] == [page.block[1]] * 3
    at = 0
    for label in ("li", "p[class=x y][id=z]"):
        at = paths.path_hash(at, label)
    assert page.paths[-1] == at


def test_deep_nesting():
    """Time and memory follow the length, not the depth."""
    n = 30_000
    page = paths.Page("".join(f"<div><b>{i}" for i in range(n)) + "</x></p>" * n)
    assert len(page.texts) == n and len(set(page.paths)) == n
    assert paths.main_text(page, {}).endswith(f"{n - 2}\n\n{n - 1}")


def test_odd_rows(spark):
    text = "Words, and more words."
    long = "<article>" + f"<p>{text}</p>" * 20_000 + "</article>"
    rows = [(None, None, None), (1, None, ""), (2, "u", "   "), (3, "no host", f"<p>{text}"), (4, "http://h/", "<p>" * 3000 + text),
            (5, "http://h/", f"<p>{text}</p><!-- never closed {text}"), (5, "http://h/", f"<p>{text}</p><!-- never closed {text}"),
            (6, "http://h/", f"<div class=comment><p>{text}"), (7, "http://h/", long), (8, "http://h/", "a < b &amp;&nbsp; c <"),
            (9, "http://h/", "<script>var a;"), (10, "http://h/", "<p title='>" + text), (11, "//", "</p></div></html>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], COLUMNS + ", text string")
    df = df.selectExpr("*", "'clash' AS key", "'clash' AS host", "'clash' AS ratios").repartition(3)
    got = paths.extract(df).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert [texts[i] for i in (None, 1, 2, 9, 11)] == [""] * 5
    assert [texts[i] for i in (3, 4, 5, 6)] == [text] * 4
    assert texts[7] == "\n\n".join([text] * 20_000) and texts[8] == "a < b & c <"
    empty = paths.extract(spark.createDataFrame([], COLUMNS))
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0
