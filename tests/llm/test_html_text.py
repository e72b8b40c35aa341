import pytest
from pyspark.sql import functions as F

from vitaspan.llm.html_text import extract, main_text

LONG = "The river runs to the sea and it is not far from the town that we have seen in the morning, with all of its boats. "
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- x --><div class="ad">Buy now.</div>
<article><h1>Head &amp; line</h1><p><b>%s<br><p>Short.</p><p>%s &eacute;&#33;&nbsp;x</p><ul><li>one</li><li>two</ul>
<div class="share-buttons">Share</div><aside>Side</aside><form><input><p>Form</p></form><div id="comments"><p>%s</p></div></article>
<div role="alert">Notice</div><footer>&copy; x</footer></body></html>""" % (LONG, LONG, LONG)


def test_article_page():
    text = LONG.strip()
    assert main_text(PAGE) == f"Head & line {text} Short. {text} é! x one two"


def test_page_without_article_uses_both_passes():
    menu = '<div><a href="/a">All about boats</a> <a href="/b">Harbours</a></div>'
    page = f"<body>{menu}<div>Small head</div><div>{LONG * 2}</div><div>A note.</div><div>{LONG * 2}</div>{menu}<div>tiny tail</div>{menu}</body>"
    assert main_text(page) == f"{(LONG * 2).strip()} A note. {(LONG * 2).strip()}"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("<nav>x</nav>", ""), ("<article>Only", "Only"),
    ("<article><p>a&amp</p><p>b &lt;c&gt; d", "a& b <c> d"), ("<article><header><h1>T</h1></header><p>x</p></article>", "T x"),
    ("<article><p>one\n\t two</p><pre>x  y</pre></article>", "one two x y"), ("<ARTICLE><P>up</P></ARTICLE>", "up"),
    ("<main><p>m</p><nav>n</nav></main><div>out</div>", "m"), ("<article><script>if(a<b){}</script><p>y</p>", "y"),
    ("<article><p hidden>no</p><p>yes</p><dialog>d</dialog></article>", "yes"), ("</p></div></article>", ""),
])
def test_small_pages(page, text):
    assert main_text(page) == text


TEXT = LONG.strip()
SIDE = '<div class="sidebar"><p>Side text of the page.</p></div>'


@pytest.mark.parametrize("page, text", [
    (f"<html><head><title>T</title><body><article><p>{LONG}</p></article></body>", TEXT),
    (f"<head><title>T</title><meta name=a><style>p{{}}</style><article><p>{LONG}</p></article>", TEXT),
    (f"<head><title>T</title><span>{LONG * 2}</span>", (LONG * 2).strip()), (f"<head><title>T</title>{LONG * 2}", (LONG * 2).strip()),
    ("<head><title>T</title><script>x</script></head><article>y</article>", "y"),
    (f'<body><div class="layout has-sidebar"><article><p>{LONG}</p></article>{SIDE}</div>', TEXT),
    (f'<div class="header"><main><p>{LONG}</p></main></div><footer>f</footer>', TEXT),
    (f'<div class="social"><div>{LONG * 2}</div></div><div class="ad">Buy.</div>', (LONG * 2).strip()),
    (f'<article><p>{LONG}</p>{SIDE}</article>', TEXT),
    (f'<article><p>{LONG}</p></article><div id="comments"><article class="comment"><p>{LONG * 3}</p></article></div>', TEXT),
    (f'<article><svg class="i" /><p>{LONG}</p><math/><p>End.</p></article>', f"{TEXT} End."),
    (f'<article><svg><path d="x"/><text>t</text></svg><p>{LONG}</p></article>', TEXT),
    (f'<body><form action="/a.aspx"><input type=hidden><article><p>{LONG}</p><select><option>o</select></article></form>', TEXT),
    (f'<article><p>{LONG}</p><form><p>Write to us</p></form></article>', TEXT),
])
def test_containers_do_not_lose_the_page(page, text):
    assert main_text(page) == text


def test_long_page():
    assert len(main_text("<article>" + f"<p>{LONG}</p>" * 20_000)) == 20_000 * len(LONG) - 1


def test_table(spark, rows):
    pages = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article>é</article>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    t = main_text(PAGE)
    assert rows(out) == sorted([(1, "u", t, len(t))] * 2 + [(2, None, "", 0), (None, "v", "é", 1)], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert extract(df.limit(0)).collect() == []


LOREM = "The river was low that summer and the boats lay on the mud for weeks while the men of the village talked in the shade about it."
JAPANESE = "夏の終わりに川の水は少なくなり、船は泥の上に並んでいた。村の人々は木の陰で話をしながら、雨が降るのを待っていた。" * 8


def test_linked_headings_and_paragraphs_of_an_article_stay():
    page = f"""<body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1><a href="/p/1">A title that is a link</a></h1><p>{LOREM}</p>
        <p><a href=/a>{LOREM[:60]}</a> {LOREM[60:100]}</p><p>Short one.</p><p><a href=/b>{LOREM}</a></p></article><footer>End</footer></body>"""
    assert main_text(page) == " ".join(["A title that is a link", LOREM, LOREM[:60] + " " + LOREM[60:100], "Short one.", LOREM])


def test_names_of_places_inside_an_article():
    page = f"""<article><div class="post-header"><h1>Title</h1><p>By someone</p></div><div class="side-note"><p>{LOREM}</p></div><p>{LOREM}</p>
        <div class="share-bar">Share this</div><div class="comments"><p>{LOREM} I agree.</p></div></article>"""
    assert main_text(page) == f"Title By someone {LOREM} {LOREM}"


def test_menus_inside_an_article_go():
    links = "".join(f"<li><a href=/{i}>Place {i}</a></li>" for i in range(5))
    assert main_text(f"<article><h1>Title</h1><ul>{links}</ul><p>{LOREM}</p></article>") == f"Title {LOREM}"
    two = "<ul><li><a href=/1>First source</a></li><li><a href=/2>Second source</a></li></ul>"
    assert main_text(f"<article><p>{LOREM}</p>{two}</article>") == f"{LOREM} First source Second source"


def test_scripts_without_blanks():
    assert main_text(f"<body><div class=menu>メニュー</div><div><p>{JAPANESE}</p></div><footer>著作権</footer></body>") == JAPANESE
    assert main_text(f"<article><h1>見出し</h1><p>{JAPANESE}</p><p>短い。</p></article>") == f"見出し {JAPANESE} 短い。"


def test_no_page_is_empty_that_has_text():
    assert main_text("<body><p>Just one line.</p></body>") == "Just one line."
    russian = "Летом река обмелела, и лодки лежали на берегу, пока люди ждали дождя."
    assert main_text(f"<nav><a href=/>Главная</a></nav><h1>Река</h1><p>{russian}</p><footer>Конец</footer>") == f"Река {russian}"
    assert main_text("<nav><ul><li>Home</li></ul></nav><footer>Imprint</footer>") == ""
    assert main_text("<p><a href=/>Home</a></p><p><a href=/b>News</a></p>") == ""
