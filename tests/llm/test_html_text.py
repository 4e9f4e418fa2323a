"""Page differencing: tables with and without semantic tags, alignment against a plain table, all kinds of furniture."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from conftest import SF01
from datescore.llm import html_text as H

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>'
    '<header><h1>Site</h1></header><nav><ul><li><a href="/x">%(nav)s</a></li><li>more</li></ul></nav><div class="ad">%(ad)s</div>'
    "<article><h1>Head &amp; line</h1><p>First  <b>bold</b>\n text<br>next<p>Second &lt;p&gt;</p>%(body)s</article>"
    '<aside>side</aside><form>Name <input><button>Go</button></form><div id="comments"><p>Reader says</p></div>'
    "<footer>&copy; %(nav)s</footer></body></html>"
)


def page(nav="n", ad="a", body=""):
    return PAGE % {"nav": nav, "ad": ad, "body": body}


def test_main_text_of_a_full_page():
    a, b = H.page_lines(page("one", "x")), H.page_lines(page("two", "y", "<p>other</p>"))
    assert H.main_text(a, b) == "Head & line First bold text next Second <p>"
    assert H.main_text(b, a) == "Head & line First bold text next Second <p> other"
    assert H.main_text(a, None) == H.main_text(a, b) == H.main_text(a, a)


def test_shared_lines_of_unmarked_pages_are_deleted():
    """No semantic element: only the neighbour tells the template from the text."""

    def plain(text):
        return f"<body><div>Welcome to the site</div><div>Home</div><div>{text}</div><div>Home</div><div>All rights</div></body>"

    a, b = H.page_lines(plain("own words")), H.page_lines(plain("other words"))
    assert H.main_text(a, b) == "own words"
    assert H.main_text(a, None) == "Welcome to the site Home own words Home All rights"
    # A copy is not template: nothing would be left.
    assert H.main_text(a, a) == "Welcome to the site Home own words Home All rights"


def test_names_inside_the_article_need_the_neighbour():
    """A class or id alone does not drop text of the article; a place that the neighbour has too does."""

    def own(body):
        return H.page_lines(f"<body><article><h1>Head</h1>{body}</article></body>")

    section = own('<h2 id="related-work">Related work</h2><p>Others did</p><div class="post-header"><p>By line</p></div>')
    other = own('<p>Body</p><div class="share"><p>Send one</p></div>')
    again = own('<p>More</p><div class="share"><p>Send two</p><p>Send three</p></div>')
    for neighbour in (None, other):
        assert H.main_text(section, neighbour) == "Head Related work Others did By line"
    assert H.main_text(section, section).startswith("Head Related work Others did")
    assert (H.main_text(other, again), H.main_text(again, other)) == ("Head Body", "Head More")


def test_broken_html():
    assert H.main_text(H.page_lines("<article><p>Cut &am"), None) == "Cut &am"
    assert H.main_text(H.page_lines("<article><p>A<p>B</i></article></div>C"), None) == "A B"
    assert H.main_text(H.page_lines("no tags  at\nall"), None) == "no tags at all"
    assert H.main_text(H.page_lines("<p>x<!-- c --><span>y</span><p hidden>z</p>"), None) == "xy"
    assert H.page_lines("") == [] and H.main_text([], None) == ""


def test_common_is_a_longest_common_subsequence():
    rng = random.Random(1)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    for _ in range(2000):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = H.common(a, b)
        it = iter(b)
        assert len(got) == length(a, b) and all(any(x == y for y in it) for x in (a[i] for i in sorted(got)))
        assert [got[i] for i in sorted(got)] == sorted(set(got.values())) and all(a[i] == b[j] for i, j in got.items())


def test_pages_pair_with_the_nearest_path_of_their_host(spark):
    def plain(top, text):
        return f"<body><div>{top}</div><div>{text}</div></body>"

    rows = [(1, "http://h.example/a/1", plain("Section A", "one")), (2, "http://H.example/a/2?q", plain("Section A", "two")),
            (3, "https://h.example/b/1", plain("Section B", "three")), (4, "http://h.example/b/2#x", plain("Section B", "four")),
            (5, "http://other.example/b/1", plain("Section B", "five"))]
    got = {r.page_id: (r.text, r.n_chars) for r in H.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    # The page alone on its host has no neighbour.
    assert got == {1: ("one", 3), 2: ("two", 3), 3: ("three", 5), 4: ("four", 4), 5: ("Section B five", 14)}


def test_edge_cases(spark):
    rows = [(1, None, None, "x"), (2, "http://h.example/", "", "x"), (2, "http://h.example/", "", "x"), (None, "nonsense", page(), "x"),
            (4, "http://h.example/a", page(body="<p>" + "long " * 30_000 + "</p>"), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = H.extract_pages(df).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 43), (1, 0), (2, 0), (2, 0), (4, 43 + 5 * 30_000)]
    assert all(r.n_chars == len(r.text) for r in got)
    assert H.extract_pages(df.limit(0)).count() == 0


# --- the neighbours decide ------------------------------------------------------------------


def _hosts(spark, change):
    """The pages of the table by host, in URL order, with their html changed, and the text by the author's tags."""
    out = defaultdict(list)
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        host, path = re.match(r"[a-z]+://([^/?#]+)([^?#]*)", r.url).groups()
        gold = H.extract(H.page_blocks(H.page_lines(r.html)), []).text
        out[host].append(((path, str(r.page_id).zfill(20)), H.page_blocks(H.page_lines(change(r.html))), gold))
    return [sorted(pages, key=lambda p: p[0]) for pages in out.values()]


def _around(pages, k):
    return [pages[j][1] for j in range(max(0, k - H.NEAR), min(len(pages), k + H.NEAR + 1)) if j != k]


CHANGES = {
    "as it is": lambda html: html,
    "no article": lambda html: re.sub(r"<(/?)(article|main)\b", r"<\1div", html),
    "no semantic tag": lambda html: re.sub(r"<(/?)(article|main|nav|footer|aside|header|section)\b", r"<\1div", html),
}


@pytest.mark.parametrize("name", CHANGES)
def test_neighbours_alone_find_the_article(spark, name):
    """Without the tags' check: the blocks that the neighbours do not call template are the article, on 0.95 of the pages and more."""
    same = total = 0
    for pages in _hosts(spark, CHANGES[name]):
        for k, (_, blocks, gold) in enumerate(pages):
            if len(pages) < 3:
                continue
            verdicts = H.compare(blocks, _around(pages, k))
            same += " ".join(x.text for b, v in zip(blocks, verdicts) if not v.template for x in b.lines) == gold
            total += 1
    assert total > 100 and same >= 0.95 * total


@pytest.mark.parametrize("name", CHANGES)
def test_extraction_with_and_without_semantic_tags(spark, name):
    pages_of = _hosts(spark, CHANGES[name])
    got = [(H.extract(blocks, _around(pages, k)), gold) for pages in pages_of for k, (_, blocks, gold) in enumerate(pages)]
    assert sum(t.text == gold for t, gold in got) >= 0.95 * len(got)
    assert sum(t.deleted > 0 for t, _ in got) >= 0.9 * len(got)
    if name == "as it is":
        assert all(t.text == gold for t, gold in got)


def test_a_neighbour_changes_the_text():
    def plain(article, menu):
        return H.page_lines(f"<body><div><a>{menu}</a></div><div><h2>Title {menu}</h2><p>{article}</p></div><div>All rights {menu}</div></body>")

    a, b, c = plain("word " * 90, "one"), plain("word " * 30, "two"), plain("word " * 200, "three")
    assert H.main_text(a) == "one Title one " + "word " * 90 + "All rights one"
    assert H.main_text(a, b, c) == ("Title one " + "word " * 90).strip()


def test_a_near_copy_keeps_its_article():
    body = [" ".join(f"w{i}-{k}" for k in range(20)) for i in range(12)]

    def plain(paragraphs, menu):
        return H.page_lines(f"<body><div>{menu}</div><div>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div><div>All rights {menu}</div></body>")

    changed = [*body[:5], "something else here", *body[6:]]
    others = [plain([f"text {k} " * (9 * k + 4)] * (k + 1), f"m{k}") for k in range(4)]
    a, b = plain(body, "x"), plain(changed, "y")
    for page, near, text in ((a, b, body), (b, a, changed)):
        assert H.main_text(page, near, *others) == " ".join(text)
    # A repeated line of most neighbours goes from a page that marks nothing.
    share = [plain([f"text {k} " * (9 * k + 4), "Share this page"], "m") for k in range(4)]
    assert "Share this page" not in H.main_text(share[0], *share[1:])


def test_a_repeated_notice_inside_the_article_goes_and_a_copied_article_stays():
    def marked(text, notice="Terms apply to all"):
        return H.page_lines(f"<body><article><h1>Head {text[:3]}</h1><p>{text}</p><div class='x'>{notice}</div></article></body>")

    pages = [marked(f"a{k} " * (10 + 30 * k)) for k in range(5)]
    assert "Terms" not in H.main_text(pages[0], *pages[1:]) and "Terms" in H.main_text(pages[0])
    copies = [marked("one two three four five six seven") for _ in range(5)]
    assert H.main_text(copies[0], *copies[1:]).startswith("Head one one two three four five six seven")


def test_results_do_not_depend_on_ranges(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    odd = [(-1, None, "<p>a</p>"), (None, None, "<p>b b b</p>"), (None, None, "<p>c</p>"), (None, None, None)]
    pages = pages.select("page_id", "url", "html").unionByName(spark.createDataFrame(odd, "page_id long, url string, html string"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in (1, 7, 120):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(sorted(map(str, H.extract_pages(pages).collect())))
        assert results[0] == results[1] == results[2] and len(results[0]) == pages.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
