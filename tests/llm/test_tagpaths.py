import html
import random
import re
import time
from collections import Counter

import pytest

from tripmart.llm import queries, tagpaths

LONG = "The quick brown fox, having slept all day, jumped over a lazy dog. It ran far away; nobody saw it again."


def plain(page):
    """The article element's blocks, for pages that have one."""
    inside = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1]
    parts = re.split(r"</?(?:p|h1)[^>]*>", re.sub(r"<br>|</?b>", " ", inside))
    texts = [" ".join(html.unescape(x).split()) for x in parts]
    return "\n".join(x for x in texts if x)


def test_query_extracts_every_article(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op8_tag_paths(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url
        assert r.text == plain(pages[r.page_id].html)
        assert r.n_chars == len(r.text)


AROUND = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News, and more.</a></li></ul></nav>",
    f"<header><div>{LONG}</div></header>",
    f"<footer>&copy; x &middot; {LONG}</footer>",
    f"<aside><p>{LONG}</p></aside>",
    f"<div class='ad'>{LONG}</div>",
    f"<div id=cookie-notice><p>{LONG}</p></div>",
    f"<form><label>{LONG}</label><input name=q><button>Go</button></form>",
    f"<script>var t = '</p>{LONG}';</script>",
    f"<style>p {{ content: '{LONG}' }}</style>",
    f"<!-- {LONG} -->",
    f"<section class='comments'><article><p>{LONG}</p></article></section>",
    f"<div style='display:none'>{LONG}</div>",
    "<ul>" + "".join(f"<li><a href='/{i}'>Another story, number {i}.</a></li>" for i in range(9)) + "</ul>",
]


@pytest.mark.parametrize("extra", AROUND)
@pytest.mark.parametrize("shape", [
    "<body>{0}<article><h1>Title</h1><p>{1}</p><p>Short.</p></article></body>",
    "<body><div class=page>{0}<div class=story><h1>Title</h1><p>{1}<p>Short.</div>{0}</div></body>",
    "<html><body><main><h1>Title</h1><p>{1}</p><p>Short.</p></main>{0}</body></html>",
])
def test_surroundings_are_left_out(shape, extra):
    page = "<!DOCTYPE html><head><title>T</title></head>" + shape.format(extra, LONG)
    assert tagpaths.main_text(page) == f"Title\n{LONG}\nShort."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("just text, no tags.", "just text, no tags."),
    ("<p>a &amp;&lt;b&gt; &#233;&eacute;<br>c\n\t d</p>", "a &<b> éé c d"),
    ("<p>unclosed <b>bold<p>next", "unclosed bold\nnext"),
    ("<p>1 < 2 and <a href='x>y'>link</a> it, all of it.</p>", "1 < 2 and link it, all of it."),
    ("<ul><li>one thing, said.<li>two things, said.</ul>", "one thing, said.\ntwo things, said."),
    ("<p title='broken>text here, all the same.</p>", "text here, all the same."),
    ("<script>never closed", ""), ("<!-- never closed", ""),
])
def test_markup(page, text):
    assert tagpaths.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<body class='right-sidebar'>{0}</body>", "<body class='with-comments'><div>{0}</div></body>",
    "<html class=no-sidebar><body id=overlay>{0}</body></html>",
    "<body><article class='post share-enabled'>{0}</article></body>",
    "<body><main id=search>{0}</main><footer>{1}</footer></body>",
    "<body><form action=/x><nav>Home</nav><div>{0}</div><footer>{1}</footer></form></body>",
    "<body><div class='widget'><nav>Home</nav><article>{0}</article></div></body>",
    "<html><head><title>T</title><meta charset=utf-8><body>{0}</body></html>",
    "<head><title>T</title>{0}", "<body>{0}<svg viewBox='0 0 1 1' /><math/></body>",
    "<body><p><svg/></p>{0}</body>",
])
def test_a_mark_on_the_whole_page_drops_nothing(page):
    text = f"<h1>Title</h1><p>{LONG}</p><p>Not <svg a='b' />so short, this.</p>"
    got = tagpaths.main_text(page.format(text, "Some, other."))
    assert got == f"Title\n{LONG}\nNot so short, this."


@pytest.mark.parametrize("tag", ["article", "div class=story"])
def test_tables_lists_and_links_of_the_article_stay(tag):
    prose = "Some words, and more of them. " * 13
    cells = "".join(f"<tr><td>cell {i}</td></tr>" for i in range(30))
    page = (
        f"<body><div class=page><ul><li><a href=/>Home</a><li><a href=/b>News</a><li><a href=/c>More</a></ul>"
        f"<{tag}>" + f"<p>{prose}</p>" * 10 + f"<table>{cells}</table>"
        f"<div class=facts><ul><li>short item<li>other item</ul></div><p><a href=/x>{LONG}</a></p>"
        f"<ol><li>A. Writer, <a href=/y>A long title of a work that is referred to here</a></ol>"
        f"</{tag.split()[0]}></div></body>"
    )
    got = tagpaths.main_text(page).split("\n")
    assert got[:10] == [prose.strip()] * 10
    assert got[10:] == [
        *[f"cell {i}" for i in range(30)], "short item", "other item", LONG,
        "A. Writer, A long title of a work that is referred to here",
    ]


def test_comments_longer_than_the_article_stay_out():
    page = f"<article><p>{LONG}</p></article><div class=comments>" + f"<p>{LONG}</p>" * 9 + "</div>"
    assert tagpaths.main_text(page) == LONG


def test_long_and_nested_pages_take_linear_time():
    started = time.perf_counter()
    deep = "<div>" * 3000 + "<p>" + LONG + "</p>" + "</div>" * 3000
    assert tagpaths.main_text(deep) == LONG
    wide = "".join(f"<p id=x{i} class=c{i % 50}>{LONG}</p>" for i in range(5000))
    assert tagpaths.main_text(wide).count("\n") == 4999
    tagpaths.main_text("<a " * 50_000)
    assert time.perf_counter() - started < 20


def test_messy_rows(spark):
    rows = [(1, None, None, 5), (None, "u", "<p>x, y.</p>", None), (2, "u", "", 1), (2, "u", "", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, N_CHARS int")
    out = tagpaths.extract(df)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    assert sorted(r.text for r in out.collect()) == ["", "", "", "x, y."]
    assert tagpaths.extract(df.limit(0)).count() == 0


def given_pages(sf_dir):
    import pyarrow.parquet as pq

    return pq.read_table(f"{sf_dir}/pages.parquet").column("html").to_pylist()


def scrambled(page, rng):
    """The article as a plain div and the advert under a name of no meaning."""
    name = "".join(rng.choice("qxzwvk") for _ in range(6))
    return re.sub(r"<(/?)article>", r"<\1div>", page).replace('class="ad"', f'class="{name}"')


def test_given_pages_without_names():
    rng = random.Random(1)
    kept = total = gone = rest = 0
    for page in given_pages("/root/testdata/sf0.1"):
        got = tagpaths.main_text(scrambled(page, rng))
        want, have = Counter(plain(page).split("\n")), Counter(got.split("\n"))
        kept += sum(len(t) * n for t, n in (want & have).items())
        total += sum(len(t) * n for t, n in want.items())
        around = [" ".join(x.split()) for x in re.findall(r'class="ad">(.*?)</div>|<footer>(.*?)</footer>', page, re.DOTALL)[0] if x]
        rest += sum(map(len, around))
        gone += sum(len(html.unescape(x)) for x in around if html.unescape(x) not in got)
    assert kept >= 0.99 * total and gone >= 0.95 * rest


PROSE = "".join(f"<p>{LONG}</p>" for _ in range(3))
OUTSIDE = [
    "<div>3 Comments</div>",
    "<div class=x1>" + "".join(f"<span>label number {i} </span>" for i in range(60)) + "</div>",
    "<div>" + "".join(f"<div>thing {i} of the shop</div>" for i in range(60)) + "</div>",
    "<div><table>" + "".join(f"<tr><td>size {i}</td><td>{i} cm</td></tr>" for i in range(50)) + "</table></div>",
    "<div class=kommentare>" + "".join(
        f"<div><b>User {i}</b> <time>12.03.</time><p>Yes, I do think so too.</p></div>" for i in range(4)) + "</div>",
    "<div class=werbung><div><p>Buy now! Only here.</p></div></div>",
    "<div><h3>Latest</h3><ul><li>Some other story<li>Yet another one</ul></div>",
]


@pytest.mark.parametrize("extra", OUTSIDE)
@pytest.mark.parametrize("shape", [
    "<body><div>{1}</div>{0}</body>", "<body>{0}<div><div>{0}<div class=q>{1}</div></div></div></body>",
])
def test_ratios_tell_the_article_where_no_name_does(shape, extra):
    page = shape.format(extra, f"<h1>Title</h1>{PROSE}<p>Short.</p>")
    assert tagpaths.main_text(page) == "\n".join(["Title", *[LONG] * 3, "Short."])


def test_without_ratios_the_longer_list_would_win(monkeypatch):
    monkeypatch.setattr(tagpaths, "path_ratios", lambda page: [1.0] * len(page.above))
    lost = 0
    for extra in OUTSIDE:
        page = f"<body><div><h1>Title</h1>{PROSE}<p>Short.</p></div>{extra}</body>"
        lost += tagpaths.main_text(page) != "\n".join(["Title", *[LONG] * 3, "Short."])
    assert lost >= 3


def test_items_of_readers_stay_out_however_long():
    items = "".join(f"<li><a href=/u{i}>User {i}</a><p>{LONG}</p></li>" for i in range(9))
    page = f"<body><div><h1>Title</h1>{PROSE}</div><div class=k><ol>{items}</ol></div></body>"
    assert tagpaths.main_text(page) == "\n".join(["Title", *[LONG] * 3])
    inside = f"<body><div><h1>Title</h1>{PROSE}<ol>{items}</ol></div></body>"
    assert tagpaths.main_text(inside) == "\n".join(["Title", *[LONG] * 3])


@pytest.mark.parametrize("part", [
    f"<section id='advertising'><h2>On it</h2><p>{LONG}</p></section>", "<h2 id='related-work'>On it</h2>",
    "<h2 id='social-media'>On it</h2>", "<div class='post-header'><h2>On it</h2></div>",
    f"<p class='notice'>{LONG}</p>", f"<p class='copyright'>{LONG}</p>", "<header><h2>On it</h2></header>",
])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_names_inside_the_article_drop_none_of_its_text(tag, part):
    page = f"<body><div>Menu</div><{tag}>{part}{PROSE}</{tag}></body>"
    own = [t for t in ("On it", LONG) if t in part]
    assert tagpaths.main_text(page) == "\n".join([*own, *[LONG] * 3])


def test_an_article_in_several_parts_is_kept_whole():
    halves = f"<div class=part><p>{LONG}</p><p>{LONG}</p></div>" * 2
    assert tagpaths.main_text(f"<body><div>Menu</div>{halves}</body>").count(LONG) == 4
    sections = f"<section><h2>Head</h2><p>{LONG}</p></section>" * 5
    got = tagpaths.main_text(f"<body><div><h1>Title</h1>{sections}</div></body>")
    assert got.count(LONG) == 5 and got.count("Head") == 5 and got.startswith("Title")


def test_many_paths_take_linear_time():
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("abcdef") for _ in range(9))
    page = "<body><div>" + "".join(f"<p class={name()}>{LONG}</p>" for _ in range(20_000)) + "</div>"
    started = time.perf_counter()
    assert tagpaths.main_text(page).count("\n") == 19_999
    deep = "<div>" * 2000 + f"<p>{LONG}</p>" * 2000 + "</div>" * 2000
    assert tagpaths.main_text(deep).count("\n") == 1999
    assert time.perf_counter() - started < 6
