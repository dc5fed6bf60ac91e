from tessera.llm.site_text import host_of, main_text, main_texts


def test_blocks_and_markup():
    html = (
        "<html><head><title>T</title><style>p{}</style></head><body><header>H</header><nav><ul><li>m</li></ul></nav>"
        "<article><header><h1>Head</h1></header><p>a <b>b<br>c</b>&nbsp;&amp; d<p>unclosed<ul><li>one<li>two</ul>"
        '<script>var t="</p>";</script><div class="ad-box">buy</div><form>f</form><aside>s</aside>'
        '<section id="comments"><p>reader</p></section><pre>x\n  y</pre></article><footer>F</footer></body></html>'
    )
    assert main_text(html) == "Head\na b c & d\nunclosed\none\ntwo\nx y"


def test_odd_html():
    assert main_text(None) == main_text("") == main_text("<!-- only -->") == ""
    assert main_text("plain &lt;text&gt; 1 < 2") == "plain <text> 1 < 2"
    assert main_text("<p>a</p></p></div><p>b") == "a\nb"
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert main_text('<body><div class="cookie-notice">c</div><div>t</div><p hidden>h</p></body>') == "t"
    assert main_text("<p>&eacute;&#233;&#x1F600;</p>") == "éé😀"


def test_templates_by_subtree(spark):
    page = '<body><div class="z1">{t}</div><div id="q"><p>text {i} of its own</p><p>shared passage</p></div><div class="z2"><p>follow us</p></div></body>'
    rows = [(i, f"http://h.example/{i}", page.format(t="Top bar", i=i), "x") for i in range(8)]
    rows += [(50, "http://other.example/a", page.format(t="Top bar", i=50), "x"), (51, None, None, "x"), (52, "nonsense", "", "x")]
    rows += [(60, "http://h.example/60", "<article><div><p>copied article</p></div></article>", "x")] * 6
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {}
    for r in main_texts(df).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    for i in range(8):
        text = f"text {i} of its own\nshared passage"
        assert got[i] == [(text, len(text))]
    assert got[50][0][0] == "Top bar\ntext 50 of its own\nshared passage\nfollow us"
    assert got[51] == got[52] == [("", 0)]
    assert got[60] == [("copied article", 14)] * 6
    assert main_texts(df.limit(0)).collect() == []


def test_hosts(spark):
    urls = ["http://A.Example:80/x", "https://u:p@b.org?q", "//c.net/", None, "d"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in df.select(host_of(df["url"])).collect()] == ["a.example", "b.org", "c.net", "", ""]


def test_deep_nesting_takes_linear_work(spark):
    deep = "".join(f"<div>level {i} " for i in range(20_000))
    df = spark.createDataFrame([(i, f"http://h.example/{i}", f"{deep}page {i}") for i in range(4)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in main_texts(df).collect()}
    assert got[2].startswith("level 0\nlevel 1\n") and got[2].endswith("page 2") and got[2].count("\n") == 19_999


def test_names_do_not_take_the_article():
    story = "<article><h1>Head</h1><p>the story</p></article>"
    for wrapped in (
        f'<div class="layout with-sidebar">{story}<div class="sidebar"><p>links</p></div></div>',
        f'<div class="has-banner"><div class="page with-sidebar">{story}</div></div>',
        f'<form action="x"><div class="nav"><p>menu</p></div>{story}</form>',
        f'{story}<section id="comments"><article class="comment"><p>a reader with a much longer text than the story</p></article></section>',
        f'{story}<div><article class="teaser"><h2>Other</h2></article><article><h2><a href="o">Other</a></h2><p>more</p></article></div>',
        '<article><div class="post-header"><h1>Head</h1></div><div class="with-sidebar"><p>the story</p></div></article>',
        '<form><div class="post-header"><h1>Head</h1></div><p>the story</p><div class="footer">f</div></form>',
        f'<div class="with-sidebar">{story}<div id="comments"><article class="comment"><p>a reader with a longer text</p></article></div></div>',
        f'<div class="has-comments"><div class="with-share">{story}</div></div><p>footer</p>',
        f'<div><svg><path d="x"></div><head><title>t</head>{story}',
        f'<div><noscript><p>no script</div>{story}',
    ):
        assert main_text(f"<body>{wrapped}</body>") == "Head\nthe story", wrapped
    assert main_text("<article><p>one</p></article><article><p>part two</p></article>") == "one\npart two"
    assert main_text('<div class="comments-open"><p>all there is</p></div>') == "all there is"
    assert main_text("<body><script>var x</body><p>code") == ""


def test_deep_wrappers_take_linear_work():
    assert main_text('<div class="has-banner">' * 5000 + "<p>text</p>" + "</div>" * 5000) == "text"


def test_section_templates_of_large_hosts_go(spark):
    page = '<body><div class="z"><p>text {i}</p></div>{more}</body>'
    block = "<div class='x7'><p>Also in this section</p></div>"
    rows = [(i, f"http://h.example/{i}", page.format(i=i, more=block if i < 5 else f"<div><p>end {i}</p></div>")) for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in main_texts(df).collect()}
    assert got == {i: f"text {i}" if i < 5 else f"text {i}\nend {i}" for i in range(400)}


def test_names_never_take_running_text():
    for part in (
        '<h2 id="search">{}</h2>',
        '<h2 id="login-form">{}</h2>',
        '<p class="related-work">{}</p>',
        '<p class="share-price">{}</p>',
        '<p class="notice">{}</p>',
        '<blockquote class="notice-text">{}</blockquote>',
        '<dl><dt id="form">{}</dt></dl>',
        '<section id="comments-on-the-text"><p>{}</p></section>',
        '<div class="share-price">{}</div>',
        '<p>{} <a class="related" href="x">',
        "<p><math><mi>{}</mi></math>",
    ):
        html = f"<article><p>all that comes before</p>{part.format('kept words')}</article>"
        assert main_text(html) == "all that comes before\nkept words", part
    assert main_text("<article><p>E = <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>.</p></article>") == "E = mc2."
    for part in (
        '<div class="share-buttons"><a href="x">Share</a></div>',
        '<div class="related-posts"><h3>More</h3><ul><li>a</li></ul></div>',
        '<div class="cookie-law-info"><span>We use cookies</span><button>Accept</button></div>',
        '<section id="comments"><p>a reader</p></section>',
        '<div class="ad-box"><p>buy</p></div>',
        "<p><button>Copy</button></p>",
    ):
        assert main_text(f"<article><p>all that comes before</p>{part}</article>") == "all that comes before", part


def test_every_main_and_the_heading_before_the_article():
    assert main_text("<body><main><p>one</p></main><main><p>the second part</p></main></body>") == "one\nthe second part"
    assert main_text("<body><main><p>one</p><main><p>two</p></main></main></body>") == "one\ntwo"
    assert main_text("<body><h1>Site</h1><main><div><h1>Head</h1></div><article><p>text</p></article></main>") == "Head\ntext"
    assert main_text("<body><main><h1>Site</h1><article><h1>Head</h1><p>text</p></article></main>") == "Head\ntext"


def test_broken_tags_take_linear_time():
    import time

    for bad in ("<a x ", "<a b=", '<a b="', "<a 'x", "<!x", "<a x \"' ", "<", "</", "<!-", "<a <b "):
        for end in ("", ">", "'>", '">', "' \">"):
            text = bad * (500_000 // len(bad)) + end
            start = time.time()
            main_text(f"<p>one</p>{text}")
            assert time.time() - start < 5, (bad, end)
    assert main_text('<p title="a > b">x</p><p title=">y</p><p>z</p>') == "x\ny\nz"
    assert main_text("1 < 2 <b>and</b> 3 <4 <p") == "1 < 2 and 3 <4 <p"
