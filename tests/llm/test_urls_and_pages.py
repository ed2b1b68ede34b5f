from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from shelfwise.llm.html_text import extract_text, main_text
from shelfwise.llm.mincut import min_cut
from shelfwise.llm.reputation import host_and_path, host_reputation, judge_urls, prior_strength

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/")]


def test_host_and_path(spark):
    urls = ["HTTP://WWW.Ex.com/a?b", "https://a.b#c/d", "x://h?/p", "no", None, "a://", "a://h/p/q#r", "m://İ.x/É"]
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "n int, url string")
    host, path = host_and_path("url")
    got = [(r[0], r[1]) for r in frame.orderBy("n").select(host, path).collect()]
    assert got == [("www.ex.com", "/a"), ("a.b", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("h", "/p/q"), ("İ.x", "/É")]


def test_rules_and_reputation(spark):
    pages = [(i, f"http://bad.org/{i}") for i in range(40)] + [(100 + i, f"http://good.org/{i}") for i in range(40)]
    pages += [(200, "http://www.example.com/en/1"), (201, "http://x.example.com/en/1"), (202, "http://notexample.com/en/"), (203, None), (204, "http://new.bad.org/"), (200, "http://www.example.com/en/1")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string").withColumn("host", F.lit("clash"))
    outcomes = spark.createDataFrame([(i, 0 if i < 40 else 1) for i in range(0, 140)], "page_id bigint, outcome int")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(frame, outcomes, RULES).collect()}
    assert got[200] == ("www.example.com/en/", "allow") and got[201] == ("example.com/en/", "block") and got[202] == ("com/", "allow")
    assert got[3] == (None, "block") and got[103] == (None, "allow")
    assert judge_urls(frame, outcomes, RULES).count() == len(pages)
    assert judge_urls(frame.limit(0), outcomes, RULES).count() == 0
    assert judge_urls(frame, outcomes.limit(0), RULES).where("rule IS NULL").count() == 81 + 1


def test_shrinkage_by_hand(spark):
    rows = [("a.x.org", 0)] * 3 + [("a.x.org", 1)] + [("b.x.org", 1)] * 4 + [("c.y.net", None)]
    got = {r["host"]: r for r in host_reputation(spark.createDataFrame(rows, "host string, outcome int")).collect()}
    m = [prior_strength(8, 3, 1, 64, 9 / 8), prior_strength(8, 3, 1, 64, 9 / 8), prior_strength(8, 3, 2, 32, 9 / 4)]
    suffix = (3 + m[0] * (3.5 / 9)) / (8 + m[0])
    domain = (3 + m[1] * suffix) / (8 + m[1])
    assert abs(got["a.x.org"]["share"] - (3 + m[2] * domain) / (4 + m[2])) < 1e-12
    assert got["b.x.org"]["share"] < domain < got["a.x.org"]["share"]
    assert got["c.y.net"]["n"] == 0 and abs(got["c.y.net"]["share"] - 3.5 / 9) < 1e-9


def test_cut_is_minimal():
    for seed in range(150):
        r = random.Random(seed)
        n = r.randint(1, 9)
        gain = [r.gauss(0, 1.5) for _ in range(n)]
        edges = [(i, j, r.random()) for i in range(n) for j in range(i) if r.random() < 0.5]

        def worth(chosen, gain=gain, edges=edges):
            return sum(g for g, c in zip(gain, chosen) if c) - sum(w for i, j, w in edges if chosen[i] != chosen[j])

        best = max(worth(c) for c in itertools.product((False, True), repeat=n))
        assert abs(worth(min_cut(gain, edges)) - best) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:1}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><a href="/">Site</a></header><nav><ul><li><a href="/a">One</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to give you the best experience there is. Accept them.</p></div>
<article><h1>A title &amp; more</h1><p>First   paragraph with <b>bold</b>ness and
a <a href="#">link</a>.<p>Second&nbsp;one, &#233;t&eacute;.</p><div class="ad">Buy now! It is cheap, and it is good.</div><p>Third.</p></article>
<aside><p>You may also like this very long line about nothing at all.</p></aside>
<form><label>Name</label><textarea>typed text</textarea></form>
<section id="comments"><p>I liked this a lot, thank you so much for it!</p></section><footer>&copy; 2020</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "A title & more\n\nFirst paragraph with boldness and a link.\n\nSecond one, été.\n\nThird."
    assert main_text(PAGE[: PAGE.index("Third")] + "Thi") .endswith("Thi")


def test_odd_pages(spark):
    pages = ["", None, "<p", "<<<>>", "plain words, and no markup at all in it.", "<p>" * 3000 + "x", "<a title='" * 300, "&#x110000; &bogus; <p>Text that is long enough to be kept here."]
    frame = spark.createDataFrame([(i, p, "u") for i, p in enumerate(pages)], "page_id bigint, html string, text string")
    out = extract_text(frame).orderBy("page_id").collect()
    assert [r["n_chars"] for r in out] == [len(r["text"]) for r in out] and out[0]["text"] == out[1]["text"] == ""
    assert extract_text(frame).columns == ["page_id", "text", "n_chars"]
    assert extract_text(frame.limit(0)).count() == 0


def test_wrappers_named_after_what_stands_beside():
    title = "<h1>A title</h1>"
    body = "".join(f"<p>Paragraph {i} tells a good part of the story, at some length and with care.</p>" for i in range(4))
    want = "A title\n\n" + "\n\n".join(f"Paragraph {i} tells a good part of the story, at some length and with care." for i in range(4))
    side = '<div class="sidebar"><p>You may also like this long line about nothing at all.</p></div>'
    notes = '<section id="comments"><h3>Replies</h3>' + "<article class='comment'><p>I liked this a lot, thank you so much for it, and once more!</p></article>" * 9 + "</section>"
    inner = [f"<main>{title}{body}</main>", f"<article>{title}{body}</article>", f'<div class="col"><div>{title}{body}</div></div>']
    for wrapper in ('<div class="content-sidebar-wrap">', '<div class="has-sidebar">', '<div class="comments-open">', '<div id="with-side-nav">', '<form action="/">'):
        end = "</form>" if "form" in wrapper else "</div>"
        for text in inner:
            assert main_text(f"<body>{wrapper}{text}{end}{side}</body>") == want, (wrapper, text[:30])
            assert main_text(f"<body>{wrapper}{text}{side}{end}</body>") == want, (wrapper, text[:30])
        for text in inner[:2]:
            assert main_text(f"<body>{wrapper}{text}{notes}{side}{end}</body>") == want, (wrapper, text[:30])
    assert main_text(f"<body><form><div class='has-sidebar'><div class='comments-open'>{inner[1]}{notes}</div>{side}</div></form></body>") == want
    # Boilerplate alone is no content.
    assert main_text(f"<body>{side}<form><p>Give us your name and your address, please do it now.</p></form></body>") == ""
