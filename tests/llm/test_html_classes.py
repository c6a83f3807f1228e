from pyspark.sql import functions as F

from tristar.llm.html_text import deduce_template, extract_pages, main_slots, nest_classes, path_of


def texts(spark, pages):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)],
                               "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in extract_pages(df).collect()}


def test_template_text_wrappers_and_odd_pages(spark):
    post = lambda i, more="": (f"<html><body><nav>home</nav><div class=post><h1>T{i}</h1>"  # noqa: E731
                               f"{more}<p>body of number {i}</p><p>see you</p></div></body></html>")
    box = "<div class=box7><p>Buy our paper</p><ul><li>now</ul></div>"
    wrapped = lambda i: (f"<html><body><p>x</p><div class='social share'><h1>T{i}</h1>"  # noqa: E731
                         f"<p>long article of number {i}, with many more words than the rest</p>"
                         f"<div class=alert>Sign up</div></div></body></html>")
    noted = lambda i: (f"<html><body><article><h1>T{i}</h1><p>text {i}</p></article>"  # noqa: E731
                       f"<div class=comments><p>{'a long comment on it ' * 20}{i}</p></div></body></html>")
    pages = ([("http://a.org/x", post(i, box)) for i in range(5)]
             + [("http://b.org/x", post(i)) for i in range(5)]
             + [("http://b.org/x", h) for h in (None, "", "<html><body><table><tr><td>odd</table>")]
             + [("http://c.org/x", wrapped(i)) for i in range(5)]
             + [("http://d.org/x", noted(i)) for i in range(5)]
             + [("http://e.org/x", post(7, box))] * 4)
    got = texts(spark, pages)
    for i in range(5):
        assert got[i] == f"T{i}\nbody of number {i}\nsee you"       # the box has no listed name
        assert got[5 + i] == f"T{i}\nbody of number {i}\nsee you"
        assert got[13 + i] == f"T{i}\nlong article of number {i}, with many more words than the rest"
        assert got[18 + i] == f"T{i}\ntext {i}"
    assert got[10] == got[11] == "" and got[12] == "odd"
    assert got[23] == "T7\nBuy our paper\nnow\nbody of number 7\nsee you"  # nothing tells them apart


def test_odd_pages_leave_the_slot(spark):
    # Without a slot of the host the whole body would come, with the line beside the post.
    page = lambda i: (f"<html><body><div class=post><p>{'long text ' * 30}{i}</p></div>"  # noqa: E731
                      f"<span>by me</span></body></html>")
    got = texts(spark, [("http://f.org/x", page(i)) for i in range(5)] + [("http://f.org/x", "")])
    assert all("by me" not in got[i] and got[i].startswith("long text") for i in range(5))


def test_slots_need_the_classes(spark):
    page = lambda i: (f"<html><body><div class=post><h1>T{i}</h1><p>text {i}</p></div>"  # noqa: E731
                      f"<div class=x><p>y{'' if i % 2 else '<p>z'}</p></div></body></html>")
    df = spark.createDataFrame([(i, "http://a.org/x", page(i) + "long " * 9) for i in range(6)],
                               "page_id long, url string, html string")
    template = deduce_template(df)
    nested = {r["path"]: r for r in nest_classes(template).collect()}
    root, post, words = (nested[path_of(p)] for p in ("html", "html/body/div.post", "html/body/div.x/p"))
    assert root["within"] is None and post["within"] == post["class"] == root["class"]
    assert words["within"] == root["class"] != words["class"]
    assert main_slots(template).count() == 1
    assert main_slots(template.withColumn("class", F.lit(0).cast("long"))).count() == 0


def test_changing_adverts_of_links(spark):
    page = lambda i: (f"<html><body><div class=post><h1>T{i}</h1><p>text of <a href=y>page</a> {i}</p>"  # noqa: E731
                      f"<div class=zq7><a href=z>Buy number {i * i}</a></div>"
                      f"<p>more of {i}, and a good deal longer than what stands in the box</p></div></body></html>")
    got = texts(spark, [("http://g.org/x", page(i)) for i in range(6)])
    for i in range(6):
        assert got[i] == (f"T{i}\ntext of page {i}\nmore of {i}, and a good deal longer than what "
                          "stands in the box")
