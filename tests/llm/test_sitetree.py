import os
from html.parser import HTMLParser

import pytest

from cadastria.llm import sitetree

SCHEMA = "page_id long, url string, html string, text string, template string, salt int"


def test_blocks_and_white_space():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav>menu</nav><article><h1>A &amp; B</h1>"
            "<p>one<b>two</b>\n three<br>four<p>five <i>six</i></article><footer>f</footer>")
    assert sitetree.main_text(page) == "A & B onetwo three four five six"


def test_scripts_comments_and_broken_markup():
    assert sitetree.main_text('<article>a<script>var t="</p><p>";</script><!-- <p>no</p> -->b</article>') == "ab"
    assert sitetree.main_text("<article><p>a <img alt='x > y'> b</p><p title=\"</p>\">c</p> 1 < 2 </b></article></div>") == "a b c 1 < 2"
    assert sitetree.main_text("<article>cut &am") == "cut &am"
    assert sitetree.main_text("<article>cut <p clas") == "cut"
    assert sitetree.main_text("<article>x<!-- open <p>y</p>") == "x"
    assert sitetree.main_text("") == sitetree.main_text("<html>") == ""
    assert sitetree.main_text("<ul><li>a<li>b</ul>c&nbsp;d&#233;") == "a b c dé"


def test_asides_by_name():
    page = ('<main><div class="top-ad">no</div><p>yes</p><form>no</form><div id="comments">no</div><section role="navigation">no</section>'
            '<p class="adverse">yes</p></main><div class="cookie-notice">no</div><header>no</header>')
    assert sitetree.main_text(page) == "yes yes"


def page(i: int, body: str) -> str:
    return f'<html><body><div class="t1">Same on all pages</div><div class="c1"><p>{body} {i}</p></div><div class="t2"><span>Site</span> map</div></body></html>'


def test_template_branches_go(spark, monkeypatch):
    rows = [(i, "http://h.example/x", page(i, f"text {i * 7}"), "t", "u", 1) for i in range(12)]
    rows += [(100 + i, "http://few.example/", page(i, "text"), None, None, None) for i in range(3)]
    rows += [(200, None, None, None, None, None), (201, "no host", "<p>a</p>", None, None, None), (0, *rows[0][1:])]
    # copies of a page whose main content is marked
    rows += [(300 + i, "http://copies.example/", "<div>x</div><article><p>all the same</p></article>", None, None, None) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got: dict = {}
    for r in sitetree.extracted(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert got[3] == ["text 21 3"] and got[0] == ["text 0 0"] * 2
    assert got[101] == ["Same on all pages text 1 Site map"]
    assert got[200] == [""] and got[201] == ["a"] and got[305] == ["all the same"]
    tree = {r["path"]: r for r in sitetree.site_trees(df).filter("host = 'h.example'").collect()}
    assert tree["/html/body/div.t1"]["importance"] == 0 and tree["/html/body/div.c1/p"]["content"] > 0.9
    assert sitetree.extracted(df.limit(0)).count() == 0


def test_a_node_stays_while_one_below_it_does():
    template = frozenset(["/html", "/html/body", "/html/body/div"])
    assert sitetree.main_text("<html><body><div>gone</div><p>here</p></body></html>", template) == "here"
    assert sitetree.main_text("<html><body><div>with <p>here</p></div></body></html>", template) == "with here"


def test_template_inside_marked_content(spark):
    def marked(i: int) -> str:
        return (f"<body><nav>n</nav><article><h1>Title {i}</h1><h2>Story</h2><p>text {i}</p>{'<p>more</p>' * (i % 3)}<p>own {i * 7}</p>"
                f"<table><tr><td>Price</td><td>{i} EUR</td></tr></table><h2>Follow</h2><p>Same <b>on</b> all.</p></article></body>")

    rows = [(i, "http://h.example/x", marked(i)) for i in range(40)]
    # copies that differ outside their main content only
    rows += [(100 + i, "http://copies.example/", f"<div>{i}</div><article><p>all the same</p></article>") for i in range(9)]
    # copies of a page without marked content
    rows += [(200 + i, "http://plain.example/", "<div><p>all the same</p></div>") for i in range(9)]
    # main content made of repeated texts only
    rows += [(300 + i, "http://whole.example/", "<article>" + "".join(f"<p>part {k}</p>" for k in range(9) if k != i) + "</article>")
             for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in sitetree.extracted(df).collect()}
    assert got[4] == "Title 4 Story text 4 more own 28 Price 4 EUR"
    assert got[105] == got[205] == "all the same"
    assert got[300] == " ".join(f"part {k}" for k in range(1, 9))


def test_names_inside_main_content():
    body = ('<section id="related-work"><p>a</p></section><h2 id="social-policy">b</h2><div class="social-policy">c</div><h2 id="comments">d</h2>'
            '<section id="Notice"><h3>Notice</h3>e</section><div class="share-buttons x">no</div><div id="related">no</div>')
    assert sitetree.main_text(f"<article>{body}</article>") == "a b c d Notice e"
    assert sitetree.main_text('<article>a<article class="comment">no</article></article><article class="comment-body">no</article>'
                              '<article class="comments-open">b</article><article class="post">c</article>') == "a b c"


def test_repeated_short_parts_of_articles_stay(spark):
    """What all pages of a host say between parts of their own, or in few words at the end, is the article's."""
    def marked(i: int) -> str:
        return (f"<article><h1>Title {i}</h1><p>Source: Agency.</p><ul><li>Yes</li><li>own {i}</li><li>No</li></ul><p>Text {i * 3} of it.</p>"
                f"<table><tr><td>Yes</td><td>No</td></tr></table><p>Paragraph {i}.</p><p>Source: Agency.</p><ul><li>Yes</li></ul></article>")

    rows = [(i, "http://h.example/", marked(i)) for i in range(12)]
    # a long notice at either end goes, the same in the middle does not
    notice = "This article first appeared in the paper of the town and is shown by its leave."
    rows += [(100 + i, "http://n.example/", f"<article><p>{notice}</p><h1>T{i}</h1><p>a{i}</p><div><p>{notice} 2</p></div><p>b{i}</p><p>{notice}</p></article>")
             for i in range(12)]
    got = {r.page_id: r.text for r in sitetree.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "Title 5 Source: Agency. Yes own 5 No Text 15 of it. Yes No Paragraph 5. Source: Agency. Yes"
    assert got[107] == f"T7 a7 {notice} 2 b7"


def test_large_hosts_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sitetree, "PART_PAGES", 7)
    rows = [(i, "http://h.example/x", page(i, f"text {i * 7}")) for i in range(60)]
    rows += [(100 + i, f"http://h{i}.example/", page(i, "alone")) for i in range(5)]
    got = {r.page_id: r.text for r in sitetree.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{i: f"text {i * 7} {i}" for i in range(60)}, **{100 + i: f"Same on all pages alone {i} Site map" for i in range(5)}}


def test_long_and_deep_pages():
    wide = "<article>" + "<p>a</p><aside>no</aside>" * 60_000 + "</article>"
    assert sitetree.main_text(wide) == " ".join(["a"] * 60_000)
    template = frozenset([f"/article/p {sitetree.said(['a'])}"])
    assert sitetree.main_text(wide + "<article><h1>own</h1>" + "<p>a</p>" * 60_000 + "</article>", template) == "own"
    deep = "<div>" * 30_000 + "<p>deep</p>" + "</div>" * 30_000
    assert sitetree.main_text(f"<article>{deep}</article>") == "deep"
    assert sitetree.main_text(deep, frozenset(["/div"])) == "deep"
    (main, (_, nodes)), = sitetree.styles(deep)
    assert not main and max(len(path) for path, _, _ in nodes) <= sitetree.LONGEST_PATH and len({path for path, _, _ in nodes}) == 30_001


class Plain(HTMLParser):
    """Text of the article by the standard library's parser."""

    BLOCKS = {"article", "p", "h1", "ul", "li", "div"}

    def __init__(self):
        super().__init__()
        self.inside, self.hidden, self.blocks = 0, 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        self.hidden += tag in ("script", "style")
        if tag in self.BLOCKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        self.hidden -= tag in ("script", "style")
        if tag in self.BLOCKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.blocks[-1] += data


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_pages_equal_another_parser(spark, sf):
    path = f"/root/testdata/{sf}/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("no test data")
    pages = spark.read.parquet(path)
    want = {}
    for r in pages.collect():
        plain = Plain()
        plain.feed(r.html)
        plain.close()
        want[r.page_id] = " ".join(t for t in (" ".join(b.split()) for b in plain.blocks) if t)
    assert {r.page_id: r.text for r in sitetree.extracted(pages).collect()} == want
