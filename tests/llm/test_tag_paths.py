"""Main texts of pages against what they were made of, and odd input."""

import random
from html import escape

import pytest
from llm.helpers import prose

from quayside.llm import tag_paths

SCHEMA = "page_id bigint, url string, html string"


def made(rng: random.Random) -> tuple[str, str]:
    """A page and its article."""
    title, parts = prose(rng, 5), [prose(rng, rng.choice([1, 12, 60])) for _ in range(rng.randint(1, 9))]
    quoted = [escape(p) for p in parts]
    if rng.random() < 0.5:
        body = "".join(f"<p>{q}" + rng.choice(["", "</p>"]) for q in quoted)
    else:
        body = "".join(f"<div class='par'>{q.replace(' ', ' <b>', 1) + '</b>' if ' ' in q else q}</div>" for q in quoted)
    article = rng.choice(["<article><h1>{}</h1>{}</article>", "<main><h1>{}</h1>{}</main>"]).format(title, body)
    noise = prose(rng, 40)
    extras = [
        f'<aside>{noise}</aside>',
        f'<div class="cookie-notice">{noise}</div>',
        f'<section id="comments"><article class="comment"><p>{noise}</p></article></section>',
        f'<form><p>{noise}</p><textarea><p>{noise}</textarea></form>',
        f'<div class="ad">{noise}</div>',
        f'<div role="banner">{noise}</div>',
        f'<script>var x = "<p>{noise}</p>"</script><style>p{{}}</style><!-- <p>{noise}</p> -->',
    ]
    rng.shuffle(extras)
    cut = rng.randint(0, len(extras))
    before, after = "".join(extras[:cut]), "".join(extras[cut:])
    page = (
        f"<!DOCTYPE html><html><head><title>{title}</title></head><body><header><h1>{noise}</h1></header>"
        f"<nav><ul><li><a href='/a'>{prose(rng, 2)}</a><li><a href='/b'>{prose(rng, 2)}</a></ul></nav>"
        f"{before}{article}{after}<footer>{noise}</footer></body></html>"
    )
    return page, "\n".join(" ".join(t.split()) for t in [title, *parts])


def test_articles_come_back_whole():
    rng = random.Random(3)
    for _ in range(300):
        page, article = made(rng)
        assert tag_paths.main_text(page) == article


def test_pages_without_article_tags():
    text = [f"Paragraph {k}, with some commas, and a good deal of text that goes on for a while." for k in range(6)]
    page = (
        "<body><div id=top><a href=1>Home</a> <a href=2>News</a></div><div class=wrap><h1>Big news</h1><div class=text>"
        + "".join(f"<div class=par>{t}</div>" for t in text)
        + "<div class=par>Short.</div></div></div><div class=side><a href=1>Link one</a></div>"
        "<div class='comments list'><p>A long, long comment, that goes on and on, but is no article at all, is it?</p></div>"
        "<div>Copyright</div></body>"
    )
    assert tag_paths.main_text(page) == "\n".join(["Big news", *text, "Short."])


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        (" \n ", ""),
        ("just text  with\n breaks", "just text with breaks"),
        ("<p>cut off <b>here <scr", "cut off here"),
        ("<p>a < b and c > d &amp; e &#8364; &eacute &nbsp; 5</p><p>x", "a < b and c > d & e € é 5\nx"),
        ("<article><p>x</p><script>if (a<b) '</p>'</script><p>y</p><style>p{}", "x\ny"),
        ("<article><p title='a > b'>one<br>two<p>wo<i>r</i>d</article>", "one two\nword"),
        ("<article><ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</table></article>", "a\nb\nc\nd\ne\nf\ng"),
        ("<nav><a href=x>only a menu</a></nav>", ""),
        ("<div class='page sidebar-right'><nav>m</nav><main><h2>H</h2><p>t</p></main></div>", "H\nt"),
    ],
)
def test_cases(page, text):
    assert tag_paths.main_text(page) == text


def test_deep_and_broken_pages_take_linear_time():
    assert tag_paths.main_text("<div>" * 50_000 + "text, here." + "<p>x." * 3) == "text, here.\nx.\nx.\nx."
    for broken in ('<a b="', "<", "<!--", "<a ", "</div>", "<li>x", "&am", "='", "<table><td>"):
        tag_paths.main_text(broken * 50_000)


def test_odd_rows(spark):
    page, article = made(random.Random(8))
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<article>" + "word, " * 200_000)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as text", "'y' as key", "1 as n_chars")
    found = sorted(map(tuple, tag_paths.extract(pages).collect()), key=str)
    long = ("word, " * 200_000).strip()
    expected = [(1, "u", article, len(article))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", long, len(long))]
    assert found == sorted(expected, key=str)
    assert tag_paths.extract(pages.limit(0)).collect() == []
