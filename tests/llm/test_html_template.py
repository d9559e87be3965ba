from matchlake.llm import html_template as H

PAGES = "page_id long, url string, html string"


def text(page, template=()):
    return H.main_text(page, frozenset(template))


def test_article_without_what_is_around_it():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><p>no";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
      <article><h1>Head &amp; tail</h1><p>One <b>two</b>\n\t three<br>four<p>Five<!-- no --><div class="ad">buy</div>
      <form>mail <input name=a></form><aside>more</aside><ul><li>x<li>y</ul><table><tr><td>1<td>2</table>
      <section id="comments"><p>nice</p></section><p>Six &lt;p&gt;</article>
      <div class="sidebar"><p>side</p></div><footer>&copy; us</footer></body></html>"""
    assert text(page) == "Head & tail\nOne two three four\nFive\nx\ny\n1\n2\nSix <p>"


def test_pages_without_an_article():
    page = "<body><div id=menu>m</div><div class=content><h2>T</h2><p>Hello</div><div><a href=x>one</a> <a href=y>two</a></div><footer>f</footer>"
    assert text(page) == "T\nHello"
    assert text("<body>x<main><p>in</p><div class='related'>r</div></main><p>out</p>") == "in"


def test_broken_and_empty_pages():
    assert text("") == "" and text("<article></article>") == "" and text("<<<") == "<<<"
    assert text("<article><p>cut &am") == "cut &am"
    assert text("<article><p>cut <a href='x") == "cut"
    assert text("<article><p>a</b></i></p></div>b<script>never closed") == "a\nb"
    assert text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    long = "<article>" + "".join(f"<p>block {k}</p>" for k in range(30000)) + "</article>"
    assert text(long).count("\n") == 29999


def host_pages(host, n):
    return [(k, f"https://{host}/p/{k}", f"<body><div><p>Welcome to our site</p></div><div class=c><p>story {k} of {host}</p><p>end {k * 7}</p></div>"
             "<div><p>All rights kept</p></div>") for k in range(n)]


def test_template_of_a_host(spark):
    rows = host_pages("A.example:80", 12)
    pages = spark.createDataFrame(rows + [(99, "https://single.example/", rows[0][2])], PAGES)
    known = {r.host: r for r in H.templates(pages).collect()}
    assert list(known) == ["a.example"] and len(known["a.example"].template) == 2
    got = {r.page_id: r.main_text for r in H.extract(pages).collect()}
    assert got[3] == "story 3 of A.example:80\nend 21"
    assert got[99].startswith("Welcome") and got[99].endswith("kept")


def test_classes_must_nest():
    assert H.nest([(1, 0, 10, 9), (2, 2, 4, 9), (3, 3, 12, 5), (4, 11, 14, 5)]) == {1, 2, 4}


def test_odd_rows(spark):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame([(1, None, None), (2, "no address", "<p>x</p>"), (2, "no address", "<p>x</p>"), (None, "http://h/", "")], PAGES) \
        .withColumn("main_text", F.lit("clash")).withColumn("template", F.lit(1)).withColumn("host", F.lit(2))
    got = sorted((str(r.page_id), r.main_text) for r in H.extract(pages).collect())
    assert got == [("1", ""), ("2", "x"), ("2", "x"), ("None", "")]
    assert H.extract(pages.limit(0)).count() == 0


def test_template_decides_inside_articles(spark):
    rows = [(k, f"http://inside.example/{k}", f"<body><article id='post-{k}'><h1>Head {k}</h1><div class=x1><p>Tell your friends</p></div><p>story {k}</p>"
             f"<p>{'more' if k % 3 else 'Call us today'}</p><p>end {k * 3}</p></article>") for k in range(9)]
    got = {r.page_id: r.main_text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[4] == "Head 4\nstory 4\nend 12" and got[3] == "Head 3\nstory 3\nCall us today\nend 9"


def test_article_that_is_a_teaser(spark):
    page = "<body><div class=c><h1>Head {0}</h1><p>{1}</p></div><article class=t><p>Read {0} too</p></article>"
    rows = [(k, f"http://teaser.example/{k}", page.format(k, f"long story {k} " * (1 if k == 5 else 30))) for k in range(9)]
    pages = spark.createDataFrame([*rows, (99, None, rows[0][2])], PAGES)
    got = {r.page_id: r.main_text for r in H.extract(pages).collect()}
    assert got[5] == "Head 5\nlong story 5" and got[99] == got[0] == "Head 0\n" + ("long story 0 " * 30).strip()


def test_copies_of_a_page_weigh_once(spark):
    rows = host_pages("copies.example", 6)
    many = rows + [(100 + k, f"http://copies.example/{k}", rows[0][2]) for k in range(40)]
    alone = {r.page_id: r.main_text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for parts in (1, 8):
        got = {r.page_id: r.main_text for r in H.extract(spark.createDataFrame(many, PAGES).repartition(parts)).collect()}
        assert {k: got[k] for k in alone} == alone and {got[k] for k in got if k >= 100} == {alone[0]}
    assert alone[0] == "story 0 of copies.example\nend 0"


def test_names_do_not_drop_the_main_slot(spark):
    article = "<article><h1>T</h1><p>one two three</p><p class='related-work'>four</p><p class='no-comment'>five</p><p class=ad>six</p></article>"
    for wrapper in ("class='content-sidebar-wrap'", "class='has-sidebar'", "id='page' class='nav-open'", "class=widget"):
        assert text(f"<body><div {wrapper}>{article}</div><div class=widget>w</div>") == "T\none two three\nfour\nfive"
    assert text("<div class=widget><p>all the text</p></div><div class=sidebar>s</div><p>more</p>") == "all the text\nmore"
    assert text("<article><p>short</p></article><div id=comments>" + "long " * 50 + "</div>") == "short"
    page = "<body><div class=c>{}</div><div class='notice'>{}</div>"  # the notice is the larger one on one page
    rows = [(k, f"http://named.example/{k}", page.format(f"story {k} " * (1 if k == 4 else 20), f"notice {k} " * 5)) for k in range(9)]
    got = {r.page_id: r.main_text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[4] == "story 4" and "notice" not in "".join(got.values())
