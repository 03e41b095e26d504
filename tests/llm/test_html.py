import json
import random
import re
import time
from html import unescape

from layerworks.llm import html

SF = "/root/testdata/sf0.01"
PAGES = [
    (1, "http://A.example/x", "<html><body><nav><a>menu</a></nav><article><h1>Title</h1><p>One &amp; two<p>three <b>bo</b>ld\n\n x<br>y</article><footer>foot</footer>"),
    (2, "http://a.example/y", "<html><body><header>top</header><div class='ad box'>buy</div><article><p>Solo&nbsp;text</p><div class=\"comments\"><p>me too</p></div></article><aside>s</aside></body></html>"),
    (3, "http://a.example/z", "<html><body><div>no article here</div><div id=cookie-notice>ok?</div><form><p>name</p></form></body></html>"),
    (4, None, None),
    (5, "", ""),
    (6, "not a url", "just text, a < b & c"),
    (7, "http://b.example/", "<body><ul><li>a<li>b<li>c</ul><div role='main'><table><tr><td>1<td>2<tr><td>3</table></div><script>if (a < b) document.write('<p>no</p>')</script></body>"),
    (8, "http://b.example/", "<body><ul><li>a</ul><div role='main'><p title=\"x > y\">m</p><style>p{}</style><!-- <p>no</p> --></div>"),
    (8, "http://b.example/", "<body><ul><li>a</ul><div role='main'><p title=\"x > y\">m</p><style>p{}</style><!-- <p>no</p> --></div>"),
    (9, "http://c.example/", "<p>" * 3000 + "deep" + "<div>" * 100_000 + "er"),
    (10, "http://c.example/", "<p \"" * 200),
    (11, "http://d.example/", "<article><p class='cookie-notice'>we use</p><p class=ad>buy<p>one <span class='comment'>no</span>two <math><mi>x</mi>+1</math> <svg><text>fig</text></svg></p>"
     "<section class='related-work'>kept</section><div class='section-header'>head</div><figure class='share-price'>42</figure><div class='social-history'>past</div><div class='share-buttons'>tweet</div><noscript>plain</noscript></article>"),
    (12, "http://d.example/", "<body>" + "".join(f"<div class='k{i % 7}'><ul><li>{i}</ul></div><section>{i}</section>" for i in range(10_000))),
    (13, "http://d.example/", "<body>" + "".join(random.Random(3).choice(("<div>a</div>", "<ul><li>b</ul>", "<section>c</section>", "d<br>")) for _ in range(20_000))),
]
TEXT = {
    1: "Title One & two three bold x y", 2: "Solo text", 3: "no article here", 4: "", 5: "", 6: "just text, a < b & c", 7: "1 2 3", 8: "m", 9: "deep er",
    11: "one two x+1 fig kept head 42 past plain", 12: " ".join(f"{i} {i}" for i in range(10_000)),
}


def test_pages(spark):
    df = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, text string, host int")
    began = time.time()
    out = html.extract(df).collect()
    assert len(out) == len(PAGES) and time.time() - began < 120
    for r in out:
        assert r.n_chars == len(r.text)
        if r.page_id in TEXT:
            assert r.text == TEXT[r.page_id], r
    assert html.extract(df.limit(0)).count() == 0


def test_given_pages(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in df.collect()}
    for r in html.extract(df).collect():
        body = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        body = re.sub(r"</?(?:p|h1|br)>", "\n\n", body)
        assert r.text == " ".join(unescape(re.sub(r"<[^>]+>", "", body)).split())


def neutral_host(rng, n, article):
    """Pages of a host whose names tell nothing, and the main text of each."""
    words = "harbour lantern meadow winter copper signal orchard velvet thunder pepper marble".split()
    say = lambda k: " ".join(rng.choice(words) for _ in range(k))
    pages = []
    for i in range(n):
        title, parts = say(4), [say(rng.randint(5, 30)) for _ in range(rng.randint(1, 6))]
        menu = "".join(f"<li><a href='/{k}'>{w}</a>" for k, w in enumerate(("Home", "Prices", "Contact")))
        links = "".join(f"<li><a href='/{k}'>{say(2)}</a>" for k in range(6))
        notice = "<div class='k9'>Tell your friends about Example Weekly.</div>" if i % 3 else ""
        body = f"<h2>{title}</h2>" + "".join(f"<p>{p}</p>" for p in parts) + notice
        body = f"<article><div class='w'>{body}</div></article>" if article else f"<div class='c2'>{body}</div>"
        tail = "<div class='c7'><p>Copyright Example Media Group</p><p>All rights reserved</p></div>"
        pages.append((f"<html><body><div class='c1'><ul>{menu}</ul></div><div class='c4'><ul>{links}</ul></div>{body}{tail}</body></html>", " ".join([title, *parts])))
    return pages


def test_the_wrapper_decides_where_names_are_neutral(spark):
    """Menus, notices and footers without telling names, with an article element and without."""
    rng = random.Random(5)
    rows, want = [], {}
    for host, n, article in (("one.example", 40, False), ("two.example", 40, True), ("three.example", 9, False)):
        for page, text in neutral_host(rng, n, article):
            rows.append((len(rows), f"http://{host}/{len(rows)}", page))
            want[len(want)] = text
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == want


def test_copies_and_single_pages_are_no_evidence(spark):
    """A host of one page, and a host of one page in many copies, keep all that names allow."""
    page, _ = neutral_host(random.Random(6), 1, False)[0]
    rows = [(0, "http://x.example/", page)] + [(i, "http://y.example/", page) for i in range(1, 30)]
    out = [r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert len(set(out)) == 1 and "Copyright Example" in out[0]
    # near copies of one article: the wrapper would leave nothing, so names decide
    near = [(i, "http://z.example/", page.replace("</body>", f"<!-- {i} --></body>")) for i in range(5)]
    assert {r.text for r in html.extract(spark.createDataFrame(near, "page_id long, url string, html string")).collect()} == {out[0]}


def test_expressions(spark):
    t = lambda s: [[x[0], x[1:] or "1"] for x in s.split()]
    show = lambda tokens: " ".join(x + (q if q != "1" else "") for x, q in tokens)
    assert show(html.folded(t("a b a b a b c"))) == "a+ b+ c"
    assert show(html.align(t("a b c"), t("a c"))) == "a b? c"
    assert show(html.align(t("a b c d"), t("x b d y"))) == "a? x? b c? d y?"
    assert show(html.align(t("a"), t("a a a"))) == "a+"
    assert show(html.align(t("a+ #"), t("a* # b"))) == "a* # b?"
    rng = random.Random(1)
    for _ in range(300):  # no label of either side is lost, and none is asked of a side that lacks it
        forms = [html.folded([[rng.choice("abcdef"), "1"] for _ in range(rng.randint(0, 12))]) for _ in range(2)]
        both = html.align(*forms)
        for f in forms:
            labels = {x for x, _ in f}
            assert labels <= {x for x, _ in both} and {x for x, q in both if q in "1+"} <= labels
    pages = [(f"http://h.example/{i}", f"<body><div class='m'><ul>{'<li>x' * (i + 1)}</ul></div>{'<section>s</section>' if i % 2 else ''}<p>t{i}") for i in range(6)]
    rows = {r.label: r for r in html.wrappers(spark.createDataFrame(pages, "url string, html string")).collect()}
    assert show(json.loads(rows["body"].expression)) == "div m section? #" and show(json.loads(rows["ul"].expression)) == "li+"
    assert rows["section"].pages == 3 and rows["section"].template and not rows["body"].template


def test_many_forms_of_one_path_meet_in_rounds(spark):
    pages = [("http://h.example/", "<body>" + "".join(f"<div class='c{(i >> b) & 1}{b}'>x</div>" for b in range(9))) for i in range(512)]
    found = html.wrappers(spark.createDataFrame(pages, "url string, html string"))
    body = [r for r in found.collect() if r.label == "body"]
    assert len(body) == 1 and body[0].pages == 512
    labels = [x for x, _ in json.loads(body[0].expression)]
    assert set(labels) == {f"div c{v}{b}" for v in "01" for b in range(9)}
