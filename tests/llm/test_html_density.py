from terrafold.llm import html_density as H

PAGE = """<!DOCTYPE html><html><head><title>Site | Tale</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body class="home">
<header class="site-header"><h1>Site</h1><nav><ul><li><a href="/">Home</a></li></ul></nav></header><div id="cookie-banner"><p>We use cookies to make this long notice.</p></div>
<div class="content"><h2>A  tale &amp; more</h2><p>First   para with <a href="x">a link</a> and <b>bold</b>&nbsp;words, long enough to count for something here.</p>
<!-- <p>hidden</p> --><aside>Related things</aside><p>Second para<br>with a break &lt;here&gt; &#x263A; and a good deal more text than the menus have.</p><ul><li>one item</li><li>two items</ul>
<form><label>Mail</label><input name="m"><button>Join our newsletter now</button></form><div class="ad-slot">Buy this thing now and be happy ever after</div></div>
<div class="sidebar"><p>Sidebar text that goes on about other matters at quite some length indeed.</p></div><section id="comments"><h3>Comments</h3><p>A reader wrote this at length, and then some more words.</p></section>
<footer>&copy; Site</footer></body></html>"""
TEXT = "A tale & more\nFirst para with a link and bold words, long enough to count for something here.\nSecond para\nwith a break <here> ☺ and a good deal more text than the menus have.\none item\ntwo items"


def test_article_without_marks():
    assert H.extract(PAGE) == TEXT


def test_article_element_is_taken_whole():
    page = "<body><nav><a href=a>menu</a></nav><article><header><h1>Title</h1></header><p>Short.</p><p>" + "long text " * 50 + "</p><div class='comments'>no</div></article><div>" + "noise " * 30 + "</div></body>"
    assert H.extract(page) == "Title\nShort.\n" + ("long text " * 50).strip()


def test_broken_markup():
    assert H.extract("<article><h1>x<p>One<p><b>two<br><p>three &am </article><footer>f") == "x\nOne\ntwo\nthree &am"
    assert H.extract("<p>open <script>var x = 1") == "open"
    assert H.extract("<p>a<!-- never closed") == "a"
    assert H.extract("a < b and <b>c</b>") == "a < b and c"
    assert H.extract("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert H.extract("<p>" + "w " * 200_000) == ("w " * 200_000).strip()
    assert [H.extract(x) for x in (None, "", "   ", "<html></html>")] == [""] * 4


def test_density_prefers_text_over_links():
    root = H.parse("<body><div>" + "<a href=x>link text here</a> " * 20 + "</div><div><p>plain text that is worth reading, as there is no link in it at all</p></div></body>")
    order = H.measure(root)
    links, plain = sorted((n for n in order if n.tag == "div"), key=lambda n: -n.link_chars)
    assert plain.density > links.density


def test_article_over_sibling_containers():
    lead, paras = "The lead of the tale, " + "which is told at length " * 8 + "here.", [f"Part {i} " + "of the tale goes on and on " * 12 + "then." for i in range(4)]
    links = "<div>" + "<a href=x>some other page</a> " * 15 + "</div>"
    body = f"<div><p>{lead}</p></div><div>{''.join(f'<p>{p}</p>' for p in paras)}</div>{links}"
    want = "\n".join([lead, *paras])
    assert H.extract(f"<body>{body}</body>") == want
    assert H.extract(f"<body><div>{links}{body}</div></body>") == want


def test_cuts_round_the_article_are_taken_back():
    paras = [f"Part {i} " + "of the tale goes on and on " * 12 + "then." for i in range(4)]
    told = "".join(f"<p>{p}</p>" for p in paras)
    rest = "<div class='site-footer'>The end of the site</div><div class='sidebar'><a href=x>more</a></div>"
    for name in ("site has-sidebar", "no-sidebar", "with-nav", "page-header-fixed", "menu"):
        for page in (f"<div class='{name}'><article>{told}</article>{rest}</div>", f"<div class='{name}'><div>{told}</div>{rest}</div>"):
            assert H.extract(f"<body>{page}</body>") == "\n".join(paras), name
    assert H.extract(f"<body><form id=f><div>{told}</div>{rest}</form></body>") == "\n".join(paras)
    assert H.extract(f"<body><form><main>{told}</main>{rest}</form></body>") == "\n".join(paras)
    sections = "<section id='discussion'><p>What it means.</p></section><section class='related-work'><p>What others did.</p></section>"
    assert H.extract(f"<body><article>{told}{sections}</article></body>") == "\n".join([*paras, "What it means.", "What others did."])
    assert H.extract(f"<body><article>{told}</article><div id='comments'><article>{told * 3}</article></div></body>") == "\n".join(paras)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "old", 9), (1, "u", PAGE, "old", 9), (None, None, None, None, None)], "page_id long, url string, html string, text string, n_chars int")
    rows = H.extract_pages(df).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in rows] == [(1, TEXT, len(TEXT))] * 2 + [(None, "", 0)]
    assert H.extract_pages(df.where("false")).count() == 0


def told(n=4):
    return [f"Part {i} " + "of the tale goes on and on " * 12 + "then." for i in range(n)]


LINKS = "<div>" + "<a href=x>some other page of the site</a> " * 20 + "</div>"
RAIL = "<div class='rail'><p>Try this new thing now.</p><p>Buy it, or read how others did.</p></div>"


def test_links_and_unlisted_sidebars_go_whatever_wraps_them():
    for n in (1, 4):
        text = f"<div>{''.join(f'<p>{p}</p>' for p in told(n))}</div>"
        for page in (LINKS + text + RAIL, RAIL + text + LINKS, f"<div>{LINKS}{text}{RAIL}</div>", f"<div><div>{LINKS}</div><div>{text}{RAIL}</div></div>", f"<div>{text}{LINKS}</div>{RAIL}"):
            assert H.extract(f"<body>{page}</body>") == "\n".join(told(n)), page[:80]
    inside = f"<article><h1>Title</h1>{''.join(f'<p>{p}</p>' for p in told())}<ul>{'<li><a href=x>more of this</a></li>' * 8}</ul></article>"
    assert H.extract(f"<body>{LINKS}{inside}{RAIL}</body>") == "\n".join(["Title", *told()])


def test_titles_outside_the_core():
    text = "".join(f"<p>{p}</p>" for p in told())
    assert H.extract(f"<body>{LINKS}<h1>The tale</h1><div>{text}</div>{RAIL}</body>") == "\n".join(["The tale", *told()])
    assert H.extract(f"<body><h1>The tale</h1><p>by A</p><h2>Start</h2><div>{text}</div></body>") == "\n".join(["The tale", "Start", *told()])


def test_short_articles_keep_out_long_footers():
    assert H.extract("<nav><a href=x>x</a></nav><article><h1>Hm.</h1><p><b>Hm.<br></article><footer>&copy; some.example &middot; " + "words of the site " * 20) == "Hm.\nHm."
    assert H.extract("<p><a href=x>only a link</a></p>") == "only a link"


def test_density_decides(monkeypatch):
    """Without any hint, density alone finds the text; with densities all alike it isn't found."""
    page = f"<body>{LINKS}<div>{''.join(f'<p>{p}</p>' for p in told())}</div>{RAIL}</body>"
    marked = f"<body><nav>{LINKS}</nav><article>{''.join(f'<p>{p}</p>' for p in told())}</article><footer>By the site.</footer></body>"
    monkeypatch.setattr(H, "boilerplate", lambda *a: False)
    assert H.extract(page) == H.extract(marked) == "\n".join(told())
    monkeypatch.setattr(H, "density", lambda node, share: float(bool(node.chars)))
    assert H.extract(page) != "\n".join(told())
    assert H.extract(marked.replace("article>", "div>")) != "\n".join(told())


def test_a_short_article_stands_beside_comments_of_any_length():
    said = "A reader wrote this at some length, and went on about it for a while. "
    for times in (1, 10, 100):
        comments = "".join(f"<p>{said * 3}</p>" for _ in range(times))
        page = f"<body><article><h1>Head</h1><p>{'What happened is told here in brief. ' * 5}</p><section class='comments'>{comments}</section></article><footer>The end</footer></body>"
        assert H.extract(page) == "Head\n" + ("What happened is told here in brief. " * 5).strip(), times
        page = f"<body><article><h1>Head</h1><p>Short.</p></article><section id='comments'>{comments}</section></body>"
        assert H.extract(page) == "Head\nShort.", times


def test_an_aside_of_any_length_stays_out():
    for times in (1, 5, 50):
        page = f"<body><article><h1>T</h1><p>Short.</p></article><aside>{'<p>Other matters that the site would have you read now.</p>' * times}</aside></body>"
        assert H.extract(page) == "T\nShort.", times


def test_page_columns_of_any_name_stay(spark):
    pages = spark.createDataFrame([(1, "u", "<p>hello there</p>", 3, 4, 5, "old")], "page_id long, url string, html string, `a.b` int, `q``w` int, `two words` int, Text string")
    out = H.extract_pages(pages)
    assert out.columns == ["page_id", "url", "a.b", "q`w", "two words", "text", "n_chars"]
    assert tuple(out.first()) == (1, "u", 3, 4, 5, "hello there", 11)
    assert H.extract_pages(pages.limit(0)).collect() == []
