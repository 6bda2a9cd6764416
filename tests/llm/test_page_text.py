import html
import random
import re

import pytest

from filehaul.llm import page_text
from filehaul.llm.queries import op12_page_text


def text_of(page):
    return " ".join(page_text.judged_lines(page)[0])


def test_query(spark):
    """The given pages, by cutting out what stands between the article's marks."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    found = {row["page_id"]: row for row in op12_page_text(spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == len(pages)
    for page in pages:
        inside = re.search("(?s)<article>(.*)</article>", page["html"])[1]
        blocks = re.split("</?(?:p|h1)>", inside)
        plain = " ".join(filter(None, (" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in blocks)))
        row = found[page["page_id"]]
        assert row["text"] == plain and row["url"] == page["url"] and row["n_chars"] == len(plain)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<article></article>", ""),
        ("just text &amp; more", "just text & more"),
        ("<article><h1>A &lt;b&gt; &copy &am;</h1><p>x<b>y</b>z<p>one\n two<br>three</article>", "A <b> © &am; xyz one two three"),
        ("<article><p>a<script>var t='</p>'; if (a<b) x</script>b<style>p{}</style></p><!-- no --> <p>c</article>", "ab c"),
        ("<nav>m</nav><header>h</header><aside>s</aside><article><p>x</p></article><footer>f</footer><p>late</p>", "x"),
        ("<article><header><h1>T</h1><p>by me</p></header><p>x</p><footer>f</footer><aside>s</aside></article>", "T x"),
        ('<article><p>x</p><div class="ad-slot ad">no</div><form><p>q</p></form><div hidden>h</div><p style="display: none">d</p></article>', "x"),
        ('<article><p>x</p><section id="comments"><h2>2 comments</h2><article class="comment"><p>no</p></article></section></article>', "x"),
        ('<form id="page"><nav>m</nav><article><p>x</p></article></form>', "x"),
        ('<main><div class="cookie-notice">c</div><div><p>x</p> y</div></main><div>z</div>', "x y"),
        ("<div role=navigation>m</div><div role='main'><p>x</p></div>", "x"),
        ('<article><ul><li class="ad">n<li>x<li>y</ul><table><tr><td>1<td>2</table></article>', "x y 1 2"),
        ('<article><p>a <span class="ad">n <span>n</span> n</span> b</p></article>', "a b"),
        ('<article><p title="a>b">x</p><p>1 < 2 <3</p></article>', "x 1 < 2 <3"),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<article><p>cut <a href=\"x", "cut <a href=\"x"),
        ("<article><p><b>open<br><p>next</p></article>", "open next"),
        ("<title>no</title><article><textarea>no</textarea><button>no</button><select><option>no</select><p>x&nbsp;&#8217;</p></article>", "x ’"),
        ("<article><P>UP</P></ARTICLE><p>out", "UP"),
        ("<p>adapter</p><div class='shadow comma'>kept</div>", "adapter kept"),
    ],
)
def test_structure(page, text):
    assert text_of(page) == text


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [4, 1 << 28])
def test_alignment_is_a_longest_one(monkeypatch, bits):
    monkeypatch.setattr(page_text, "ALIGNMENT_BITS", bits)
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(25))] for _ in range(2))
        places = page_text.shared_places(a, b)
        rest = iter(b)
        assert places == sorted(set(places)) and all(a[place] in rest for place in places)
        assert len(places) == longest(a, b)


def soup(*lines):
    return "<html><body>" + "".join(f"<div>{line}</div>" for line in lines) + "</body></html>"


def extracted(spark, rows, schema="page_id long, url string, html string"):
    return {row["page_id"]: row["text"] for row in page_text.extract_text(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize("block", [2, 4096])
def test_pages_without_marks(spark, monkeypatch, block):
    """Shared lines go, with all other hosts between, and the nearest path decides what is shared."""
    monkeypatch.setattr(page_text, "NEIGHBOURS", block)
    rows = []
    for host in range(5):
        for section in ("/news/", "/shop/"):
            for page in range(6):
                lines = [f"site {host}", f"menu of {section}", f"story {host} {section} {page}", "repeated", f"more {page} {host}", "repeated", f"end {host}"]
                rows.append((len(rows), f"http://h{host}.example.com{section}{page}?q", soup(*lines)))
    found = extracted(spark, rows)
    for number, url, _ in rows:
        host, section, page = re.match(r"http://h(\d)[^/]*(/\w+/)(\d)", url).groups()
        assert found[number] == f"story {host} {section} {page} more {page} {host}"


def test_marked_prose_stays_and_bare_lines_go(spark):
    page = "<div>top</div><article><p>{}</p><p>Released under the MIT License.</p><div>Share this page</div></article>"
    rows = [(i, f"http://a.com/{i}", page.format(f"own {i}")) for i in range(4)]
    rows += [(9, "http://a.com/9", page.format("own 3"))]  # a mirror of its neighbour
    found = extracted(spark, rows)
    assert found == {i: f"own {min(i, 3)} Released under the MIT License." for i in (0, 1, 2, 3, 9)}


def test_odd_rows(spark):
    rows = [
        (1, None, None, "t"), (2, None, soup("x", "y"), "t"), (3, "no scheme", soup("x", "z"), "t"), (None, "http://a.b/1", soup("x"), "t"),
        (5, "http://a.b/1", soup("x"), "t"), (5, "http://a.b/1", soup("x"), "t"), (6, "http://a.b/1", "", "t"), (7, "http://c.d/", soup(*["w"] * 30_000), "t"),
        (8, "http://c.d/2", soup(*["w"] * 20_000, "v"), "t"),
    ]
    schema = "page_id long, url string, html string, text string, host string"
    table = spark.createDataFrame([(*row, None) for row in rows], schema)
    found = sorted(((r["page_id"] or 0, r["text"][:20]) for r in page_text.extract_text(table).collect()))
    # Copies have no neighbour but the empty page; without a host there is none.
    assert found == [(0, "x"), (1, ""), (2, "x y"), (3, "x z"), (5, "x"), (5, "x"), (6, ""), (7, "w w w w w w w w w w "), (8, "v")]
    assert page_text.extract_text(table.limit(0)).count() == 0
