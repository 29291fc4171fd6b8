import html
import random
import re

from kelpline.llm import html_text as h

PAGES = "page_id long, url string, html string, text string"

LONG = "This paragraph is long enough to be the body of an article, with commas, clauses, and more words than any menu has."


def test_article_of_a_plain_page():
    page = f"""<html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
    <div id="top-nav"><a href=/>Home</a> <a href=/b>News</a></div><div class="cookie-notice">We use cookies, accept them all please.</div>
    <h2>The   heading</h2><p>{LONG}<br>after a &lt;break&gt; &amp;amp; more<p>short one<p>{LONG}
    <ul><li><a href=x>a linked line</a></ul><aside>{LONG}</aside><form>{LONG}<input></form>
    <div class="comments"><p>{LONG}</div><footer>&copy; {LONG}</footer></body></html>"""
    assert h.article(page) == f"The heading\n{LONG}\nafter a <break> &amp; more\nshort one\n{LONG}"


def test_article_keeps_short_lines_around_the_surge():
    page = f"<body><nav><p>{LONG}</p></nav><article><header><h1>Head</h1></header><p>a.</p><p>b\n\t c&nbsp;d</p><div class=ad>buy</div><p>{LONG}<p>end.<p><a href=x>link</a></p><section id=comments><p>{LONG}</p></section></article><p><a href=y>{LONG}</a></p>"
    want = f"Head\na.\nb c d\n{LONG}\nend."
    assert h.article(page) == want
    assert h.article(page.replace("<article>", "<div>").replace("</article>", "</div>").replace("<header>", "<div>").replace("</header>", "</div>")) == want


def brute(found):
    """Line-block distribution read off its definition: a line stays if a surge reaches it."""
    n = len(found)
    weight = [max(len(x.text) - x.linked, 0) for x in found]
    block = [sum(weight[i : min(i + h.WINDOW, n)]) for i in range(n)]
    surges = [i for i in range(n) if weight[i] and block[i] > h.SURGE]
    stays = set()
    for s in surges:
        stays.update(k for k in range(s, n) if all(weight[j] or block[j] > h.SURGE for j in range(s, k + 1)))
        up = [k for k in range(s + 1) if all(weight[j] for j in range(k, s + 1))]
        stays.update(up)
        if up[0] and found[up[0] - 1].heading:
            stays.add(up[0] - 1)
    return [x.text for i, x in enumerate(found) if i in stays or not surges and weight[i]]


def test_article_against_the_definition():
    rng = random.Random(11)
    for _ in range(400):
        parts = []
        for _ in range(rng.randrange(1, 14)):
            text = "word " * rng.choice([1, 2, 6, 15, 40])
            parts.append(rng.choice([f"<p>{text}</p>", f"<p><a href=x>{text}</a></p>", f"<h2>{text}</h2>", f"<h2><a href=x>{text}</a></h2>", f"<div>{text}<a href=x>more</a></div>"]))
        page = "".join(parts)
        assert h.article(page) == "\n".join(brute(h.lines(page)))


def test_pages_without_article_elements(spark, sf):
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        assert h.article(r.html.replace("<article>", "<div>").replace("</article>", "</div>")) == h.article(r.html)


def test_slashes_and_links():
    found = h.lines(f"<div/><p>{LONG}</p><a href=/>menu<a href=/b>more</a><p>{LONG}")
    assert [(x.text, x.linked) for x in found] == [(LONG, 0), ("menumore", 8), (LONG, 0)]


def test_edges():
    assert h.article(None) == h.article("") == h.article("<p></p>") == h.article("<!-- only a comment") == ""
    assert h.article("no markup") == "no markup"
    assert h.article("a < b &#x41;&#66; &bogus; 1 <2") == "a < b AB &bogus; 1 <2"
    assert h.article("<p title='a > b'>x</p></div></p><script>never closed <p>y") == "x"
    assert h.article("<p>" + "word " * 100000 + "</p>") == ("word " * 100000).strip()
    assert h.article("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


def test_query_against_the_pages_grammar(spark, sf):
    got = {r.page_id: r for r in h.query(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = re.search("<article>(.*?)</article>", p.html, re.S)[1]
        parts = re.split("</?p>|<br>|</?h1>", re.sub("</?b>", "", body))
        want = "\n".join(filter(None, (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in parts)))
        r = got[p.page_id]
        assert (r.text, r.n_chars, r.url) == (want, len(want), p.url)


def test_rows_and_columns(spark):
    rows = [(1, None, None, "x"), (1, "u", "<p>a", "x"), (1, "u", "<p>a", "x"), (None, "", "", None)]
    out = h.extract(spark.createDataFrame(rows, PAGES))
    assert out.columns == ["page_id", "url", "text", "__article"]
    assert sorted(r["__article"] for r in out.collect()) == ["", "", "a", "a"]
    assert h.extract(spark.createDataFrame([], PAGES)).collect() == []
