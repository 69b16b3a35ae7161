"""HTML extraction: templates, broken markup, host vote and edge rows."""

import html
import re

import pytest

from stakeflow.llm import html_extract as H

SF = "/root/testdata/sf0.01"
ARTICLE = ["Title &amp; more", "First paragraph with <b>bold</b> text, commas, and words.",
           "Second paragraph,\n  over two lines &mdash; and &#8364;5 &lt; &eacute;.", "Third one is a bit longer, too."]
TEXT = ["Title & more", "First paragraph with bold text, commas, and words.",
        "Second paragraph, over two lines — and €5 < é.", "Third one is a bit longer, too."]
BODY = f"<h1>{ARTICLE[0]}</h1>" + "".join(f"<p>{p}</p>" for p in ARTICLE[1:])
PAGES = {
    "article": f"<article>{BODY}</article>",
    "div": f"<div class='post-content'>{BODY}</div>",
    "open paragraphs": f"<main><h1>{ARTICLE[0]}</h1><p>" + "<p>".join(ARTICLE[1:]) + "</main>",
    "sidebar": f"<div id=wrap><div class=sidebar><p>About me, I write long lines of text here.</p></div><article>{BODY}</article></div>",
    "comments": f"<article>{BODY}<section class='comments'><article><p>Great post, thanks!</p></article></section></article>",
    "comments below": f"<article>{BODY}</article><div id='comments'><p>I disagree, a lot, with all of this.</p></div>",
    "notice": f"<div class='cookie-notice'>We use cookies, accept?</div><article>{BODY}</article>",
    "form": f"<article>{BODY}<form><label>Mail</label><input name=a><button>Send</button></form></article>",
    "header": f"<header><h1>Site name</h1><p>The best site, ever.</p></header><article><header>{BODY[:BODY.find('<p>')]}<span>by me</span></header>{BODY[BODY.find('<p>'):]}</article>",
    "aside": f"<article>{BODY}<aside>Read also this, and that.</aside></article>",
    "open menu": f"<nav><ul><li><a href=/>Home</a><article>{BODY}</article>",
    "advert": f"<article>{BODY[:BODY.find('<p>Third')]}<div class='ad-slot'><p>Buy this, now.</p></div>{BODY[BODY.find('<p>Third'):]}</article>",
    "script": f"<article>{BODY}<script>var a='<p>no</p>';if(a<b)x();</script><style>p{{}}</style><!-- <p>no</p> --></article>",
    "cut": f"<article>{BODY}</article><footer>&copy; me <a hr",
}


@pytest.mark.parametrize("name", PAGES)
def test_templates(name):
    source = f"<!DOCTYPE html><html><head><title>T</title></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav>{PAGES[name]}<footer>&copy; me, all rights.</footer></body></html>"
    assert H.main_text(H.parse(source), None) == "\n\n".join(TEXT)


def test_odd_input():
    for source in ("", "no markup at all", "<", "<<<>>>", "<p", "<p>a", "</p></div>", "a < b", "<a title=\"x>y", "<!--", "<script>"):
        H.main_text(H.parse(source), ">html>body")
    assert H.main_text(H.parse("<p>a<p>b & c"), None) == "a\n\nb & c"
    assert len(H.main_text(H.parse("<article>" + "<p>word</p>" * 50_000), None)) == 6 * 50_000 - 2


def brute(source):
    """The article of the given pages, by plain substitution."""
    part = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)[1]
    out = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in x else "", x)).split())
           for x in re.split(r"</?(?:p|h1)>", part)]
    return "\n\n".join(x for x in out if x)


def test_whole_table(spark):
    want = {r.page_id: brute(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = H.op3_html_extract(spark, SF).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_host_vote(spark):
    page = "<body><div class='x{i}'><p>{t}</p></div><div class='tip'><p>{s}</p></div></body>"
    long, short = "A long story, told in many words. " * 5, "A tip, in short."
    rows = [(i, f"http://h.org/{i}", page.format(i=i, t=f"{long}{i}", s=short)) for i in range(5)]
    rows += [(9, "http://h.org/9", "<body><div class='x9'><p>Brief, but it is the story.</p></div><div class='tip'><p>Brief tip, to look at.</p></div></body>"),
             (10, None, None), (11, "", ""), (12, "http://other.org/", "<p>alone</p>"), (9, "http://h.org/9", None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as host", "2 as path")
    got = sorted((r.page_id, r.text) for r in H.extract(df).collect())
    assert [g for g in got if g[0] >= 9] == [(9, ""), (9, "Brief, but it is the story.\n\nBrief tip, to look at."),
                                             (10, ""), (11, ""), (12, "alone")]
    assert H.extract(df.limit(0)).count() == 0


def test_class_names_are_evidence_not_a_veto():
    body = "<article><p>Start of it, with words.</p><div class='share-of-market'><p>A fifth of it, they say.</p></div><section id='login-design'><p>How to log in, well.</p></section><div class='share-buttons'><p>Tell others, now!</p></div><div id='promo_box2'><p>Buy, please.</p></div></article>"
    assert H.main_text(H.parse(body), None) == "Start of it, with words.\n\nA fifth of it, they say.\n\nHow to log in, well."


def test_split_article_stays_whole(spark):
    """On a host whose pages mostly use one container, an article over two of them loses neither part."""
    part = "Some words of the story, told at length. "
    one = f"<body><div id=w><div class='story'><p>{part * 12}</p></div><div class='tip'><p><a href=x>{part}</a></p></div></div></body>"
    split = f"<body><div id=w><div class='story'><p>{part * 4}</p></div><section class='more'><p>{part * 8}</p></section></div></body>"
    rows = [(i, f"http://h.org/{i}", one) for i in range(6)] + [(9, "http://h.org/9", split)]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[0] == (part * 12).strip() and got[9] == f"{(part * 4).strip()}\n\n{(part * 8).strip()}"


def test_vote_replaces_a_page_s_own_choice(spark):
    """One page whose sidebar-like box outweighs its article: the host's path takes the article with it, and where
    the article holds most of the page's container, the article alone."""
    story, note = "The story goes on, in many words. ", "A note, by the way. "
    page = "<body><div class='wrap'><div class='story'><p>{a}</p></div><div class='note'><p>{b}</p></div></div></body>"
    plain = "<body><div class='wrap'><div class='story'><p>{a}</p></div></div></body>"
    rows = [(i, f"http://h.org/{i}", plain.format(a=story * 9)) for i in range(5)]
    rows += [(7, "http://h.org/7", page.format(a=story * 9, b=note * 2))]
    got = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[7] == (story * 9).strip()
    assert note.strip() in H.main_text(H.parse(rows[-1][2]), None)


def test_deep_and_broken_pages_stay_linear():
    import time
    import tracemalloc
    deep = "<div class='a1'>" * 20_000 + "<p>word</p>" + "</div>" * 20_000
    tracemalloc.start()
    H.main_text(H.parse(deep), ">div.a>div.a")
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()

    def seconds(n):
        t = time.process_time()
        H.main_text(H.parse("<p>" + "<b>x</i> " * n + "<font><em>y</u>" * n + "<p>z</p>" * n), None)
        return time.process_time() - t

    seconds(1000)
    assert seconds(40_000) < 30 * max(seconds(4000), 0.05)
    H.main_text(H.parse("".join(f"<div><p>t{i}" for i in range(20_000))), None)
