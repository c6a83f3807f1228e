import html
import re
import time

from tristar.llm.html_text import deduce_template, extract, extract_pages, op10, path_of, tokens

SF = "/root/testdata/sf0.01"


def expected(page):
    """Plain reading of these pages: the article's blocks."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)>", body)
    out = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in out if b)


def test_whole_table(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op10(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == expected(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def page(text, extra=""):
    return (f"<html><head><title>t</title><script>if (a</b>) '</p>'</script></head><body>"
            f"<header>Site</header><nav><a href=x>home</a></nav><div class='post'>{text}</div>{extra}"
            f"<div id=\"comments\"><p>first!</p></div><footer>&copy;</footer></body></html>")


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string")


def test_deduces_the_slot_without_article(spark):
    rows = [(i, "http://a.org/x", page(f"<h2>T{i}</h2><p>one &amp; two{i}<p>three\n  four</p>",
                                       "<div class=box>Visit us</div>" if i % 2 else ""), "p")
            for i in range(6)]
    got = {r["page_id"]: r["text"] for r in extract_pages(frame(spark, rows)).collect()}
    assert got[2] == "T2\none & two2\nthree four"
    template = deduce_template(frame(spark, rows)).collect()
    classes = {r["path"]: r["class"] for r in template}
    post, footer, words, box = (classes[path_of(f"html/body/{p}")]
                                for p in ("div.post", "footer", "div.post/p", "div.box"))
    assert post == footer != words and box != footer


def test_malformed_pages():
    assert extract("", None) == ""
    assert extract("no tags &lt;here", None) == "no tags <here"
    assert extract("<p>a<p>b<b>c", None) == "a\nbc"
    assert extract("a < b and c > d", None) == "a < b and c > d"
    assert extract("<p>x</p></div></div><p class='unclosed>y", None).startswith("x")
    assert extract("<article>a<script>bad", None) == "a"
    assert extract("<!-- <p>no</p> <p>yes", None) == ""
    assert extract("<body><p>a&nbsp; b<br>c</body>", path_of("html/none")) == "a b\nc"
    assert len(extract("<p>" + "word " * 200_000, None)) == 5 * 200_000 - 1


def test_edge_cases(spark):
    df = frame(spark, [(1, None, None, ""), (None, "nohost", "", ""), (2, "http://b/", "<p>x</p>", ""),
                       (2, "http://b/", "<p>x</p>", "")])
    rows = extract_pages(df).collect()
    assert sorted((r["page_id"] or 0, r["text"]) for r in rows) == [(0, ""), (1, ""), (2, "x"), (2, "x")]
    assert extract_pages(df.limit(0)).count() == 0


def test_deep_pages_are_linear():
    for part in ("<div>x ", "<div>", "<b><p>y</p>", "</i><div>", "<p><div><b>x"):
        page = part * (1_000_000 // len(part))
        start = time.time()
        tokens(page)
        extract(page, path_of("div"))
        assert time.time() - start < 15, part
    assert extract("<div>x " * 50_000, path_of("div")) == "\n".join("x" * 50_000)
