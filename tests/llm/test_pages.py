import gzip
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tables import oracle, rows_of

from tallyglass.llm import html_text, queries, warc

PAGES = StructType(
    [StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType())]
)
LONG = "<p>" + "x" * 200 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=8), max_size=9))
def test_loser_tree_merges(runs):
    tree = warc.LoserTree([sorted(r) for r in runs], key=lambda x: x)
    assert list(tree) == sorted(x for r in runs for x in r)


def test_url_keys():
    assert warc.url_key("https://M.Example.org:80/A?b#c") == "org,example,m:80)/A?b#c"
    assert warc.url_key("http://example.org") == "org,example)/"
    assert warc.url_key(None) == warc.url_key("") == ""


def hard_pages(spark):
    rows = [
        (9, "http://b.org/1", LONG),
        (3, "http://a.org/2\r\nX: y", LONG),
        (3, "http://a.org/2", LONG),
        (5, None, None),
        (4, "", ""),
        (None, "http://a.org/", LONG),
        (None, "http://a.org/", "z" * 150),
        (7, "http://a.org/é", "short"),
        (8, "http://a.org/é", "short"),
        (1, "http://c.org", "日本語" * 100),
        (2, "http://c.org", "日本語" * 100),
    ]
    return rows, spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("records_per_file", [1, 3, 4000])
def test_hard_pages_round_trip(spark, records_per_file):
    rows, pages = hard_pages(spark)
    pages = pages.withColumn("digest", F.lit("x")).withColumn("run", F.lit(1))
    found = warc.archived_captures(pages, records_per_file=records_per_file)
    captures = found.collect()
    assert len(captures) == len(rows)
    keys = [(c.url_key.encode(), c.captured, c.page_id is None, c.page_id or 0) for c in captures]
    assert keys == sorted(keys)
    expected = []
    for page_id, _, page in rows:
        payload = (page or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = min(same) if same and len(payload) >= 100 else page_id
        expected.append((page_id, len(payload), None if page_id == first else first))
    assert sorted(((c.page_id, c.payload_bytes, c.refers_to) for c in captures), key=repr) == sorted(expected, key=repr)
    assert all((c.record_type == "revisit") == (c.refers_to is not None) for c in captures)


def test_cut_archives_are_noticed():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 90\r\n\r\nabc"
    with pytest.raises(ValueError):
        warc.captures_of("x", gzip.compress(record))


def test_no_pages(spark):
    empty = spark.createDataFrame([], PAGES)
    assert warc.archived_captures(empty).count() == 0
    assert html_text.extract(empty).count() == 0


def test_warc_query_agrees_with_sql(spark, sf_dir):
    columns, expected = oracle(sf_dir, queries.OP10_SQL)
    assert rows_of(queries.op10_warc(spark, sf_dir), columns) == expected


# ---------------------------------------------------------------- main text


def text(body):
    return html_text.main_text(body)


@pytest.mark.parametrize(
    "page, expected",
    [
        ("", ""),
        ("plain  text &amp; more", "plain text & more"),
        ("<p>a<p>b<br>c</p>d", "a b c d"),
        ("<article><h1>T</h1><p><b>x<br><p>y</p></article><footer>f</footer>", "T x y"),
        ("<nav>n</nav><main>m<aside>s</aside></main>after", "m"),
        ("<div class='ad x'>ad</div><div id=cookie-notice>c</div><div class=lead>l</div>", "l"),
        ("<p>in<b>line</b>s &lt;b&gt; &#233; &amp &am", "inlines <b> é & &am"),
        ("<script>var t='</p>';</script><style>p{}</style><p>x", "x"),
        ("<article>a</article><section class=comments><article>r</article></section><article>b</article>", "a b"),
        ("<p>1 < 2 <!-- no --> yes <", "1 < 2 yes <"),
        ("<p>cut off <a href='x", "cut off"),
        ("<p title='a>b'>t</p><p title=\"x\"\">u", "t u"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<form>f<input></form><button>b</button><header>h</header>t", "h t"),
        ("<p>a  b　c\n", "a b c"),
        ("</div></p>stray", "stray"),
    ],
)
def test_main_text(page, expected):
    assert text(page) == expected


def host_pages(n, host="h.org"):
    return [
        (
            i,
            f"http://{host}/{i}",
            f"<div class=top>Site name</div><div><p>Story {i} of many</p><p>Body {i * 7}</p></div>"
            f"<div class=end>All rights reserved</div>{'<i>only here</i>' if i == 2 else ''}",
        )
        for i in range(n)
    ]


def test_constant_slots_become_template(spark):
    rows = [*host_pages(8), *host_pages(3, "few.org"), (100, None, None), (None, "", "<p>x</p>"), (None, "", "<p>x</p>")]
    random.Random(0).shuffle(rows)
    pages = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("z")).withColumn("tree", F.lit(0))
    found = {(r.url, r.page_id): r.text for r in html_text.extract(pages).collect()}
    assert found["http://h.org/4", 4] == "Story 4 of many Body 28"
    assert found["http://h.org/2", 2] == "Story 2 of many Body 14 only here"
    # Too few different pages to tell template from content.
    assert found["http://few.org/1", 1] == "Site name Story 1 of many Body 7 All rights reserved"
    assert found[None, 100] == "" and found["", None] == "x"


def test_copies_are_no_evidence(spark):
    rows = [(i, f"http://h.org/{i}", "<h1>Same</h1><p>copy</p>") for i in range(20)]
    assert {r.text for r in html_text.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"Same copy"}


def texts_by_id(spark, rows):
    random.Random(1).shuffle(rows)
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_one_odd_page_hides_no_template(spark):
    """Neither a first page that is null or of another layout, nor one that differs inside a template slot."""
    rows = [(i + 10, url, page) for i, url, page in host_pages(12)]
    rows += [(0, "http://h.org/0", None), (1, "http://h.org/1", ""), (2, "http://h.org/2", "<table><tr><td>odd</table>")]
    rows.append((3, "http://h.org/3", rows[0][2].replace("All rights", "Not all rights")))
    found = texts_by_id(spark, rows)
    assert found[15] == "Story 5 of many Body 35"
    assert found[12] == "Story 2 of many Body 14 only here"
    assert found[0] == found[1] == "" and found[2] == "odd"
    assert found[3] == "Story 0 of many Body 0 Not all rights reserved"


def test_two_layouts_of_a_host(spark):
    other = "<section class=x>Shop</section><section><p>Item {0}</p></section><div class=y>Buy now</div>"
    rows = host_pages(7) + [(i, f"http://h.org/{i}", other.format(i)) for i in range(100, 107)]
    found = texts_by_id(spark, rows)
    assert found[4] == "Story 4 of many Body 28" and found[104] == "Item 104"


def test_copies_under_other_markup_are_no_evidence(spark):
    page = "<script>t={0}</script><div data-n={0}>Head</div><p>One story</p><div class=ad>{0}</div>"
    rows = [(i, f"http://h.org/{i}", page.format(i)) for i in range(9)]
    assert set(texts_by_id(spark, rows).values()) == {"Head One story"}
    # A page that is nothing but template keeps its text.
    rows = host_pages(8) + [(99, "http://h.org/99", "<div class=top>Site name</div><div class=end>All rights reserved</div>")]
    assert texts_by_id(spark, rows)[99] == "Site name All rights reserved"


STORY = "A long story that goes on and on. " * 4


@pytest.mark.parametrize(
    "page",
    [
        "<div>{0}</div><article>Teaser</article><article>Teaser two</article>",
        "<main><p>{0}</p><article>Teaser</article></main>",
        "<div>{0}</div>" + "<article>Teaser of some forty letters, all told</article>" * 5,
    ],
)
def test_teasers_do_not_hide_the_story(page):
    assert STORY.strip() in text(page.format(STORY))


def test_slots_choose_before_tags(spark):
    page = "<div>Site</div><div class=story><p>Story {0}</p></div><section><article>Teaser, the same everywhere</article></section>"
    found = texts_by_id(spark, [(i, f"http://h.org/{i}", page.format(i)) for i in range(8)])
    assert found[3] == "Story 3"


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><p>{0}</p></body>",
        "<body class='sidebar'><p>{0}</p></body>",
        "<article class='post comments-open'>{0}</article>",
        "<article class='post comments'>{0}</article>",
        "<div id='content' class='with-menu'>{0}</div>",
        "<form id='aspnetForm'><div class=menu>m</div><div>{0}</div></form>",
        "<div class=widget><p>x</p><article>{0}</article></div><div class=widget>w</div>",
        "<div class=notice>{0}</div><div class=share>s</div>",
        "<article><div class=entry-header><h1>A long</h1></div><p>story</p></article>",
        "<article>{0}</article><section id=comments><p>" + "c" * 900 + "</p></section>",
    ],
)
def test_names_do_not_hide_the_story(page):
    found = text(page.format(STORY))
    assert ("A long story" if "entry-header" in page else STORY.strip()) in found
    assert "ccc" not in found


def test_bulk_is_of_the_varying_text(spark):
    """A long template does not make the form that holds the story a small part."""
    page = "<div>" + "Same on all pages. " * 20 + "</div><form><p>Story {0}</p></form><div class=share>s</div>"
    found = texts_by_id(spark, [(i, f"http://h.org/{i}", page.format(i)) for i in range(8)])
    assert found[3] == "Story 3"


@pytest.mark.parametrize("n", [150, 250, 5000])
def test_deep_elements_close_themselves(n):
    deep = "<div>" * n + "in<nav>n<b>n</b></nav><div class=ad>a<nav>n</nav></div>" + "</div>" * n
    found = text(f"<div><article><p>a</p>{deep}<p>after</p></article>outside</div>")
    assert found == "a in after"


def plain_matching(a, b):
    """The most pairs of simple tree matching, by its recurrence."""
    if a.kind != b.kind:
        return 0
    x, y = a.children, b.children
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + plain_matching(x[i], y[j]))
    return best[-1][-1] + 1


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["<div>", "</div>", "<p>", "<b>", "</b>", "<ul><li>", "</ul>", "t"]), max_size=14))
def test_tree_matching(parts):
    a = html_text.Slot("html", [html_text.parse("".join(parts))])
    b = html_text.Slot("html", [html_text.parse("".join(parts[::-1]))])
    score, pairs = html_text.match(a, b)
    assert score == len(pairs) == plain_matching(a, b)
    assert all(x.kind == y.kind for x, y in pairs)


def test_html_query_against_plain_reading(spark, sf_dir):
    import html
    import re

    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op7_html_text(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[row.page_id].html, re.DOTALL).group(1)
        spaced = re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", article))
        expected = " ".join(html.unescape(spaced).split())
        assert (row.url, row.text, row.n_chars) == (pages[row.page_id].url, expected, len(expected))
