"""HTML extraction against the pages' own construction, and on hosts of other shapes."""

from __future__ import annotations

import html
import re

from llm_rows import documents, rows

from slugmend.llm import common
from slugmend.llm import html_extract as ext
from slugmend.llm import html_tree as tree
from slugmend.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def article(page):
    """Main text by a regular expression for the generated pages."""
    found = re.search("<article>(.*)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)\b[^>]*>", found[1].replace("<br>", " ")) if found else []
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_whole_table(spark):
    pages = documents("/root/testdata/sf0.01", "page_id, url, html", "pages")
    got = QUERIES["op1_html_extraction"](spark, "/root/testdata/sf0.01")
    want = sorted(((i, u, t := article(h), len(t)) for i, u, h in pages), key=lambda r: [(x is not None, str(x)) for x in r])
    assert rows(got) == want


def extracted(spark, pages):
    got = ext.extract_pages(spark.createDataFrame(pages, SCHEMA))
    return {r.page_id: r.text for r in got.collect()}


def test_odd_pages(spark):
    pages = [
        (1, "http://a.org/x", None), (2, None, ""), (3, "not a url", "<p>plain  text</p> tail"), (None, "http://a.org/y", "<p>x"),
        (4, "http://a.org/z", "<article><p>one<p>two &lt;b&gt; &#233;</article><div id=comments>no</div>"),
        (4, "http://a.org/z", "<article><p>one<p>two &lt;b&gt; &#233;</article><div id=comments>no</div>"),
        (5, "http://b.org/", "<article>" + "<p>word</p>" * 20000 + "</article>"), (6, "http://b.org/", "<" * 1000 + "a < b"),
        (7, "http://b.org/", "<script>var t='</p><p>no';</script><article>yes<!-- <p>no --><style>no</style></article"),
    ]
    got = extracted(spark, pages)
    assert got[1] == "" and got[2] == "" and got[3] == "plain text\ntail" and got[None] == "x"
    assert got[4] == "one\ntwo <b> é" and got[5] == "\n".join(["word"] * 20000) and got[7] == "yes"
    empty = spark.createDataFrame([], SCHEMA)
    assert ext.extract_pages(empty).count() == 0


def shop(i, body):
    return (
        f"<html><body><div class='top'><span>Our shop</span><a href='/{i}'>link {i}</a></div><div class='text'>{body}</div>"
        f"<div class='end'><span>All prices with tax</span></div></body></html>"
    )


def test_host_without_articles(spark):
    """No declared article: the template's constant text goes, the slot with the text stays."""
    bodies = [f"<p>{' '.join(f'word{i}x{j}' for j in range(40))}</p><p>second part {i}</p>" for i in range(8)]
    got = extracted(spark, [(i, f"http://shop.example/{i}", shop(i, b)) for i, b in enumerate(bodies)])
    for i in range(8):
        assert got[i] == f"{' '.join(f'word{i}x{j}' for j in range(40))}\nsecond part {i}"


def test_copies_keep_their_text(spark):
    """Pages that are all copies of one article: repeated text inside an article is still text."""
    page = "<html><body><nav><a>Home</a></nav><article><h1>Title</h1><p>Same text</p></article><footer>end</footer></body></html>"
    got = extracted(spark, [(i, "http://copies.example/", page) for i in range(5)])
    assert set(got.values()) == {"Title\nSame text"}


def test_classes_and_order(spark):
    """Equal vectors are one class; a class whose tokens change places between pages is not valid."""
    ab, ba = "<b></b><i></i>", "<i></i><b></b>"
    pages = [(k, "http://h.example/", f"<div><u></u>{ab if k % 2 else ba}</div>") for k in range(6)]
    df = spark.createDataFrame(pages, SCHEMA)
    read = df.select(ext.host_of(df.url).alias("host"), "html").transform(common.map_arrow, ext._sequences, ext._SEQUENCE).cache()
    classes = ext.equivalence_classes(read)
    (entry,) = classes.collect()
    assert len({e["class"] for e in entry.classes}) == 1 and len(entry.classes) == 8  # every tag is once in every page
    (kept,) = ext.valid_classes(read, classes).collect()
    assert kept.classes == []


def test_gaps():
    assert ext.gap_of([5, 6], [1, 9], 2) == 0 and ext.gap_of([0], [1, 9], 2) == -1 and ext.gap_of([10], [1, 9], 2) == 1
    assert ext.gap_of([2, 12], [1, 9, 11, 19], 2) == 0 and ext.gap_of([2, 10], [1, 9, 11, 19], 2) is None


def test_reader():
    said = [(i.kind, i.name, i.text) for i in tree.read("<ul><li>a<li>b</ul><p>c<div>d</div>")]
    opened = [n for k, n, _ in said if k == tree.OPEN]
    closed = [n for k, n, _ in said if k == tree.CLOSE]
    assert opened == ["ul", "li", "li", "p", "div"] and closed == ["li", "li", "ul", "p", "div"]
    roles = {i.text: i.role for i in tree.read("<body class='has-sidebar'><div class='cookie-notice'>x</div><main>y<aside>z</aside></main>") if i.text}
    assert roles == {"x": tree.EXCLUDED, "y": tree.ARTICLE, "z": tree.EXCLUDED}


def post(i):
    """A page without <article>: title, subheading, list, table, quote and inline words beside long paragraphs."""
    long = " ".join(f"word{i}x{j}" for j in range(200))
    return (
        f"<html><body><div class='top'><a href='/'>Start</a><a href='/{i}'>next {i}</a></div>"
        f"<div class='wrap'><div class='teaser'><a href='/t{i}'>teaser {i}</a></div><div class='post'><h1>Title {i}</h1>"
        f"<p>{long}</p><h2>Part {i}</h2><p>before <b>bold{i}</b> and <a href='/x'>linked{i}</a> <code>code{i}</code> after{i}</p>"
        f"<ul><li>first{i}</li><li>second{i}</li></ul><table><tr><td>cell{i}</td><td>value{i}</td></tr></table>"
        f"<blockquote>quoted{i}</blockquote><p>{long}</p></div></div><div class='end'>Imprint</div></body></html>"
    )


def test_short_parts_of_the_content_region(spark):
    got = extracted(spark, [(i, f"http://post.example/{i}", post(i)) for i in range(12)])
    for i in range(12):
        long = " ".join(f"word{i}x{j}" for j in range(200))
        assert got[i].split("\n") == [
            f"Title {i}", long, f"Part {i}", f"before bold{i} and linked{i} code{i} after{i}", f"first{i}", f"second{i}",
            f"cell{i}", f"value{i}", f"quoted{i}", long,
        ]


def test_parts_beside_the_largest_holder(spark):
    """A heading outside the region, and a short holder beside the one with most text."""
    page = "<html><body><h1>Name {0}</h1><div class='page'><div class='intro'>Short {0}</div><div class='text'><p>{1}</p></div></div></body></html>"
    got = extracted(spark, [(i, "http://beside.example/", page.format(i, " ".join(f"w{i}x{j}" for j in range(99)))) for i in range(5)])
    assert all(got[i].split("\n")[:2] == [f"Name {i}", f"Short {i}"] and got[i].endswith(f"w{i}x98") for i in range(5))


def test_declared_article_body(spark):
    page = "<body><p>out {0}</p><div itemprop='articleBody'><p>in {0}</p></div></body>"
    assert extracted(spark, [(i, "http://body.example/", page.format(i)) for i in range(4)]) == {i: f"in {i}" for i in range(4)}


def test_copies_without_articles_keep_their_text(spark):
    """Copies of a page, equal but for an attribute, on a host without <article>, and pages without a url."""
    copy = "<html><body data-t='{0}'><div class='text'><p>copied one</p><p>copied two</p><p>copied three</p></div></body></html>"
    own = [" ".join(f"own{i}x{j}" for j in range(40)) for i in range(17)]
    pages = [(i, "http://mixed.example/", shop(i, f"<p>{t}</p>")) for i, t in enumerate(own)]
    pages += [(100 + i, "http://mixed.example/", copy.format(i)) for i in range(3)]
    pages += [(200 + i, None, copy.format(i)) for i in range(4)] + [(300 + i, "odd", shop(i, f"<p>text{i}</p>")) for i in range(4)]
    got = extracted(spark, pages)
    assert all(got[i] == "copied one\ncopied two\ncopied three" for i in (*range(100, 103), *range(200, 204)))
    assert all(got[i] == t for i, t in enumerate(own))


def test_page_of_template_text_only(spark):
    """Text that other pages have too, and nothing else."""
    common = "<p>first common</p><p>second common</p>"
    pages = [(i, "http://t.example/", f"<body><div class='text'>{common}<p>own{i}</p></div></body>") for i in range(5)]
    got = extracted(spark, [*pages, (9, "http://t.example/", f"<body><div class='text'>{common}</div></body>")])
    assert got[9] == "first common\nsecond common" and got[3] == "own3"


def kept(page):
    return [i.text for i in tree.read(page) if i.kind == tree.TEXT and i.role != tree.EXCLUDED]


def test_names_around_and_inside_articles():
    """Layout names and slug ids exclude nothing; furniture of compound names, menus and comments stay excluded."""
    for around in ("class='layout has-sidebar'", "id='page-with-menu'", "class='social-science'", "class=widget", "id=overlay"):
        for name in ("main", "article"):
            assert kept(f"<body><div {around}><{name}><p>text</p></{name}></div></body>") == ["text"], around
    assert kept("<form id=aspnetForm><main>text</main><div>field</div></form>") == ["text"]
    inside = "<article><h2 id='related-work'>a</h2><section id='search-methods'>b</section><p class='side'>c</p><h3 id=search>d</h3></article>"
    assert kept(inside) == ["a", "b", "c", "d"]
    for around in ("class='site-footer'", "class=comments", "id='main-nav'", "class='commentList'", "role=navigation", "hidden"):
        assert kept(f"<div {around}><article>no</article></div>") == [], around
    for alone in ("share-buttons", "cookie-notice", "relatedPosts", "ad", "ad_box2", "newsletter-signup", "sidebar"):
        assert kept(f"<article>a<div class='{alone}'>no<article>teaser</article></div></article>") == ["a"], alone
        assert kept(f"<div class='{alone}'>no</div>") == [], alone
    assert kept("<nav><article>no</article></nav><aside><main>no</main></aside>") == []
    assert kept("<article><header><h1>t</h1><span>by</span></header>b</article>") == ["t", "b"]


def story(i):
    """A page with an article: its heading outside, text of every page of the host inside."""
    return (
        f"<html><body><div class='wrap'><h1>Title {i}</h1><article><p>{' '.join(f'word{i}x{j}' for j in range(60))}</p><p>short {i}</p>"
        f"<div class='tail'><p>Written for our readers</p><p>All text by the house</p></div></article></div>"
        f"<div class='rail'><a href='/{i}'>link {i}</a></div></body></html>"
    )


def test_template_on_pages_with_articles(spark, monkeypatch):
    """A declared article does not stand in for the template: with no templates found, results differ."""
    pages = [(i, "http://story.example/", story(i)) for i in range(6)]
    got = extracted(spark, pages)
    texts = [f"{' '.join(f'word{i}x{j}' for j in range(60))}\nshort {i}" for i in range(6)]
    assert [got[i] for i in range(6)] == [f"Title {i}\n{t}" for i, t in enumerate(texts)]
    monkeypatch.setattr(ext, "templates", lambda found, own=ext.templates: own(found).filter("false"))
    alone = extracted(spark, pages)
    assert [alone[i] for i in range(6)] == [f"{t}\nWritten for our readers\nAll text by the house" for t in texts]


def test_text_beside_small_articles(spark):
    """Teasers declared as articles, or an article for browsers without scripts, beside a far longer text."""
    page = "<body><div class='text'><p>{1}</p><p>end {0}</p></div><article><p>{2}</p></article></body>"
    long = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(5)]
    pages = [(i, "http://teaser.example/", page.format(i, long[i], f"teaser {i}")) for i in range(5)]
    pages += [(10 + i, "http://script.example/", page.format(i, long[i], "Please turn on scripts")) for i in range(5)]
    got = extracted(spark, pages)
    assert [got[i] for i in range(5)] == [f"{long[i]}\nend {i}\nteaser {i}" for i in range(5)]
    assert [got[10 + i] for i in range(5)] == [f"{long[i]}\nend {i}" for i in range(5)]


def test_near_copies_of_articles_keep_their_text(spark):
    """Versions of one article, and a passage of fewer than half of the host's articles."""
    shared = [f"passage {k} of every version" for k in range(4)]
    page = "<html><body><article>{}</article><footer>end</footer></body></html>"
    paragraphs = [[*shared, f"version {i}"] for i in range(5)]
    quoting = [[f"own {i} " + "text " * i, *(["a quoted passage", "in two parts"] if i < 4 else [])] for i in range(12)]
    pages = [(i, "http://versions.example/", page.format("".join(f"<p>{p}</p>" for p in ps))) for i, ps in enumerate(paragraphs)]
    pages += [(20 + i, "http://quoting.example/", page.format("".join(f"<p>{p}</p>" for p in ps))) for i, ps in enumerate(quoting)]
    got = extracted(spark, pages)
    assert [got[i] for i in range(5)] == ["\n".join(ps) for ps in paragraphs]
    assert [got[20 + i] for i in range(12)] == ["\n".join(" ".join(p.split()) for p in ps) for ps in quoting]


def test_page_without_the_region(spark):
    """A page of another layout than its host's others, with a heading: all of its own text stays."""
    pages = [(i, f"http://post.example/{i}", post(i)) for i in range(12)]
    other = "<html><body><div class='top'><a href='/'>Start</a></div><h1>About us</h1><div class='about'><p>who we are</p></div></body></html>"
    got = extracted(spark, [*pages, (50, "http://post.example/about", other)])
    assert got[50] == "About us\nwho we are" and got[3].startswith("Title 3\n")


def test_common_headings_of_articles(spark):
    """Headings that every article has stay with the text under them, and go with nothing but template text under them."""
    page = (
        "<body><main><h1>Kitchen</h1><p>About {0}, {1}</p><h2>What <i>you</i> need</h2><p>Serves four</p><ul><li>item {0}</li></ul>"
        "<table><tr><th>Time</th><th>Heat</th></tr><tr><td>{0} min</td><td>{0} C</td></tr></table>"
        "<h2>Steps</h2><h3>First</h3><p>step {0}</p><h2>More</h2><p>Ask our cooks</p></main></body>"
    )
    long = [" ".join(f"w{i}x{j}" for j in range(50)) for i in range(5)]
    got = extracted(spark, [(i, "http://cook.example/", page.format(i, long[i])) for i in range(5)])
    for i in range(5):
        assert got[i].split("\n") == [
            f"About {i}, {long[i]}", "What you need", f"item {i}", "Time", "Heat", f"{i} min", f"{i} C", "Steps", "First", f"step {i}",
        ]
