import random
import re

import pytest

from emisplit.llm import html_extract
from emisplit.llm.html_extract import PAGES, REPEAT, blocks, main_text, repeats


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><h1>T &amp; x</h1><p><b>one<br><p>two \n three</p><div class='comments'><p>c</p></div>four&nbsp;five", ["T & x", "one", "two three", "four five"]),
        ("<nav>menu</nav><main><header><h1>Head</h1>by</header><p>a<script>'</p>'</script>b</p><aside>no</aside></main>f", ["Head", "ab"]),
        ("<body><div class='sidebar'>s</div><div class='with-sidebar'>text <a href='x'>link</a>ed</div><p>1 &lt; 2", ["text linked", "1 < 2"]),
        ("<article class='comment'>x</article><article hidden>y</article><article>z<!-- <p>no</p> --></article>", ["z"]),
        ("<article>a<form>f</form><style>p{}</style><table><tr><td>c<td>d</table><p class='", ["a", "c", "d"]),
        ("x < y <ul><li>a<li>b</ul>", ["x < y", "a", "b"]),
        # Names around an article, and a form around the page, don't make it chrome.
        ("<div class='layout-with-sidebar'><article><p>a</p></article></div><div class='sidebar'>s</div>", ["a"]),
        ("<div id='page-header-wrap'><article><h1>t</h1>a</article></div>", ["t", "a"]),
        ("<div class='header'><main><p>a</p></main></div>", ["a"]),
        ("<form><nav>n</nav><article><p>a</p><form>f</form></article></form>", ["a"]),
        ("<div class='popup'><article>a</article></div>", ["a"]),
        ("<div class='related'><article>no</article></div><article>a</article>", ["a"]),
        ("<div id='comments'><article>no</article></div><article>a</article>", ["a"]),
        ("<article>a</article><aside><article>no</article></aside><div hidden><article>no</article></div>", ["a"]),
        # Inline chrome goes without cutting its block.
        ("<article><p>text <span class='ad'>BUY</span> more</p></article>", ["text more"]),
        ("<article><p>a <label>l</label>b<span hidden>h</span> <a class='share' href='x'>s</a>c</p></article>", ["a b c"]),
        ("<article><p>a <span class='ad'>x</p><p>b</p></article>", ["a", "b"]),
        # Comments that close at once, and one closed by --!>.
        ("<article>a<!-->b<!--->c<!-- x --!>d<!-- --></article>", ["abcd"]),
        ("", []),
    ],
)
def test_blocks_by_structure(html, text):
    found = blocks(html)
    where = html_extract.landmark(found) or "open"
    assert [t for p, t in found if p == where] == text


def test_repeats_match_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(3), i, [rng.randrange(3) for _ in range(rng.randrange(0, 30))]) for i in range(120)]
    rows += [(0, 500 + i, [7] * 40) for i in range(2)] + [(1, 600 + i, [8] * 9 + [i]) for i in range(40)]
    streams = spark.createDataFrame(rows, "host long, stream long, tokens array<long>").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = {tuple(r) for r in repeats(streams).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    seen: dict = {}
    for host, stream, tokens in rows:
        for i in range(len(tokens) - REPEAT + 1):
            seen.setdefault((host, tuple(tokens[i : i + REPEAT])), []).append((host, stream, i))
    want = {p for places in seen.values() if len({s for _, s, _ in places}) >= PAGES for p in places}
    assert got == want


def test_boilerplate_of_pages_without_landmark_goes(spark):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    boiler = "terms of use and privacy policy all rights reserved"
    rows = [(i, f"http://h.example/{i}", f"<div>{boiler}</div><p>{words(20)}</p><p>{words(3)}</p>", "x") for i in range(60)]
    rows += [(100 + i, "http://g.example/", f"<div>{boiler} {i}</div><p>{words(9)}</p>", "x") for i in range(PAGES - 1)]
    rows += [(200, None, None, "x"), (201, None, "", "x"), (202, "no url", "<p>a b</p>", "x"), (None, None, "<article>q</article>", None)]
    # Looks marked, but the mark is a comment's: repetition decides, on a host of its own.
    rows += [(250, "http://c.example/", "<p>a b</p><article class='comment'><i>no</i></article>", "x")]
    rows += [(300, "http://h.example/x", f"<article>{boiler} <p>own</article>", "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or -1), r.text, r.n_chars) for r in main_text(pages).collect())
    assert len(got) == len(rows)
    want = []
    for page_id, _, html, _ in rows:
        parts = re.findall(r"<(?:p|div|article)>([^<]+)", html or "")
        text = "\n".join(p.strip() for p in parts if not ((page_id or 0) < 100 and p == boiler))
        want.append((page_id or -1, text, len(text)))
    assert got == sorted(want)


@pytest.mark.parametrize("partitions", ["2", "7"])
def test_marked_pages_with_one_surrounding_count_each(spark, partitions):
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    head, foot = "news weather sport culture travel contact us", "terms of use and privacy policy all rights reserved"
    around = lambda inner: f"<div>{head}</div>{inner}<div>{foot}</div>"
    own = words(20)
    rows = [(i, "http://h.example/", around(f"<article>{words(15)}</article>")) for i in range(40)]
    rows += [(100, "http://h.example/u", around(f"<p>{own}</p>"))]
    # Copies of one marked page are one page: with the unmarked one they are two.
    rows += [(200 + i, "http://g.example/", around("<article>same</article>")) for i in range(40)]
    rows += [(300, "http://g.example/u", around(f"<p>{own}</p>"))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
        got = {r.page_id: r.text for r in main_text(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got[100] == own
    assert got[300] == f"{head}\n{own}\n{foot}"
    assert all(got[i] == re.findall("<article>(.*)</article>", h)[0] for i, _, h in rows if "article" in h)


@pytest.mark.parametrize("partitions", ["2", "7"])
def test_hosts_whose_pages_all_mark_their_text_are_searched(spark, partitions):
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared, foot = words(10), [words(8) for _ in range(4)]
    page = lambda i, own: f"<nav>{words(2)}</nav><article><p>{own}</p><p>{shared}</p></article><footer>{foot[i % 4]} {i % 7}</footer>"
    # What articles share stays, though a footer has it too.
    rows = [(i, f"http://h{i % 3}.example/", page(i, words(5))) for i in range(40)]
    rows += [(50 + i, "http://h0.example/", f"<main>{words(4)}</main><div>{shared}</div>") for i in range(4)]
    # One page often, another on two pages; a page with too few words outside, one with none, one with chrome alone, null.
    rows += [(60, "http://g.example/", page(1, "copy"))] * 5 + [(70 + i, "http://f.example/", page(2, words(3))) for i in range(2)]
    rows += [(80, "http://h0.example/", "<nav>a b</nav><article>c</article>"), (81, None, "<article>c</article>"), (82, None, f"<nav>{shared}</nav>"), (None, None, None)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
        got = sorted((r.page_id or -1, r.text, r.n_chars, r.n_searched, r.n_repeated) for r in main_text(pages).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    seen: dict = {}
    cut = []
    for page_id, url, html in rows:
        found = blocks(html or "")
        where = html_extract.landmark(found)
        outside = " ".join(t for p, t in found if where and p != where).split()
        windows = [(url, *outside[i : i + REPEAT]) for i in range(len(outside) - REPEAT + 1)]
        cut.append((page_id or -1, "\n".join(t for p, t in found if p == where), outside, windows))
        for window in windows:
            seen.setdefault(window, set()).add(html)
    want = []
    for page_id, text, outside, windows in cut:
        covered = {i + k for i, window in enumerate(windows) if len(seen[window]) >= PAGES for k in range(REPEAT)}
        want.append((page_id, text, len(text), len(outside), len(covered)))
    assert got == sorted(want)
    assert sum(w[4] for w in want if w[0] < 50) > 100 and not any(w[4] for w in want if w[0] >= 60)


def test_repeats_tell_whether_an_article_below_a_name_is_the_text(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    teaser, foot, own = words(12), words(9), [words(15) for _ in range(30)]
    related = f"<div class='related'><article>{teaser}</article></div>"
    rows = [(i, "http://h.example/", f"{related}<p>{own[i]}</p><div>{foot}</div>") for i in range(10)]
    # The article below such a name is the text where it is on no other page, on too few, or where nothing else is left.
    rows += [(10 + i, "http://g.example/", f"<form><article>{own[10 + i]}</article></form><div>{foot} {i}</div>") for i in range(10)]
    rows += [(20 + i, "http://f.example/", f"{related}<p>{own[20 + i]}</p>") for i in range(PAGES - 1)]
    rows += [(25 + i, "http://e.example/", f"{related}<nav>{own[25 + i]}</nav><div>{foot}</div>") for i in range(5)]
    # Or where only a few words are left, as on copies of a page that differ in a number.
    rows += [(30 + i, "http://d.example/", f"<form><article>{teaser}</article></form><div>{i} views</div>") for i in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in main_text(pages).collect()}
    assert got == {i: teaser if i >= 20 else own[i] for i, _, _ in rows}


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text(pages).collect() == []
