from __future__ import annotations

import time

from hypothesis import given, settings
from hypothesis import strategies as st

from lumenframe.llm import pages as P

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- <p>gone</p> --><div class="ad">Buy</div><div id="cookie-notice">Cookies</div>
<article><h1>Title &lt;1&gt;</h1><p>One  two&nbsp;three<br>four</p><p><b>Bold<br><p>Next <i>in</i>line</p><form><input value="x"><button>Go</button></form><aside>Side</aside>
<div class="comments"><p>Reader says</p></div><p>Last</article><aside>More</aside><footer>&copy; me</footer>"""


def text(html, shared=()):
    return P.main_text(P.lines_of(html), shared)


def test_article():
    assert text(PAGE) == "Title <1>\n\nOne two three four\n\nBold\n\nNext inline\n\nLast"


def test_odd_pages():
    assert text(None) == text("") == text("<") .replace("<", "") == ""
    assert text("plain & simple") == "plain & simple"
    assert text("<p>a < b &am &amp c") == "a < b &am & c"
    assert text("<article><p>cut off <b>he") == "cut off he"
    assert text('<article><p title="a>b">x</p></article') == "x"
    assert text("<ARTICLE><P>X</P></ARTICLE>tail") == "X"
    assert text("<article>a</article><article class='comment'>b</article>") == "a"
    assert len(text("<article>" + "<p>word</p>" * 20_000 + "</article>").split("\n\n")) == 20_000


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_alignment_is_longest(a, b):
    got = sorted(P.shared_lines(a, b))
    assert len(got) == lcs(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in got)  # a subsequence of b


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 3), max_size=40))
def test_alignment_in_halves_is_longest(a, b):
    before, P.ALIGN_BITS = P.ALIGN_BITS, 20
    try:
        got = sorted(P.shared_lines(a, b))
    finally:
        P.ALIGN_BITS = before
    assert len(got) == lcs(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in got)


def test_many_equal_lines_align_quickly():
    began = time.process_time()
    assert len(P.shared_lines([1] + [7] * 20_000 + [2], [3] + [7] * 20_000 + [4])) == 20_000
    assert time.process_time() - began < 2


def test_nearest_page_decides(spark):
    def page(*blocks):
        return "<body>" + "".join(f"<p>{b}</p>" for b in blocks) + "</body>"

    rows = [
        (1, "http://h.org/news/1", page("Menu", "Story one", "Legal"), "x"),
        (2, "http://h.org/news/2", page("Menu", "Story two", "Legal"), "x"),
        (3, "http://h.org/shop/9", page("Shop", "Ware", "Legal"), "x"),
        (4, "http://other.org/news/1", page("Menu", "Alone", "Legal"), "x"),
        (5, None, page("No address"), "x"),
        (6, "http://h.org/news/3", None, "x"),
        (7, "http://copy.org/a", "<article><p>Same</p></article><p>x</p>", "x"),
        (8, "http://copy.org/b", "<article><p>Same</p></article><p>y</p>", "x"),
        (1, "http://h.org/news/1", page("Menu", "Story one", "Legal"), "x"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    for parts in (1, 7):
        got = [(r.id, r.text, r.n_chars) for r in P.extract(pages.repartition(parts)).collect()]
        by = {i: t for i, t, _ in got}
        assert len(got) == 9 and all(n == len(t) for _, t, n in got)
        assert by[1] == "Story one" and by[2] == "Story two"
        assert by[4] == "Menu\n\nAlone\n\nLegal" and by[5] == "No address" and by[6] == ""
        assert by[7] == by[8] == "Same"
    assert P.extract(pages.limit(0)).collect() == []


def test_nearest_page_decides_inside_the_article(spark):
    def page(*blocks):
        return "<nav>Menu</nav><article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"

    notice = "Read our other stories as well"  # in no element that marks noise
    rows = [
        (1, "http://h.org/1", page("Story one", notice)),
        (2, "http://h.org/2", page("Story two", notice)),
        (3, "http://copy.org/a", page("Same", notice) + "<footer>x</footer>"),
        (4, "http://copy.org/b", page("Same", notice) + "<footer>y</footer>"),
    ]
    got = {r.id: (r.text, r.n_shared) for r in P.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == ("Story one", 2) and got[2] == ("Story two", 2)
    assert got[3][0] == got[4][0] == f"Same\n\n{notice}"


def test_runs_of_copies_are_compared_with_another_page(spark):
    def page(*blocks):
        return "<body>" + "".join(f"<p>{b}</p>" for b in ("Menu", *blocks, "Legal")) + "</body>"

    story = [f"This is the part {k} of a long story" for k in range(10)]
    rows = [(i, f"http://h.org/a/{i:02}", page("Copied story")) for i in range(12)]
    rows += [(20, "http://h.org/b", page("Other story")), (21, "http://h.org/b/none", None)]
    rows += [(30 + i, f"http://h.org/c/{i}", page(*story[:5], f"Version {i}", *story[5:])) for i in range(6)]
    rows += [(40 + i, f"http://copies.org/{i}", page("Copied story")) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in ("1", "4", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            by = {r.id: r.text for r in P.extract(pages).collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert {by[i] for i in range(12)} == {"Copied story"} and by[20] == "Other story" and by[21] == ""
        assert all(by[30 + i] == "\n\n".join([*story[:5], f"Version {i}", *story[5:]]) for i in range(6))
        assert {by[40 + i] for i in range(3)} == {"Menu\n\nCopied story\n\nLegal"}  # no other page on the host
