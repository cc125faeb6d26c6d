import html
import random
import time

import pytest

from tillmarts.llm.html_text import extract, main_text


def page(article, head="", tail=""):
    return (
        '<!DOCTYPE html><html><head><title>T, t</title><style>p{a:b}</style><script>var t="</p>";f(1);</script></head>'
        f'<body><nav><ul><li><a href="/x">Menu, one</a></li></ul></nav><!-- <p>no</p> -->{head}{article}{tail}'
        "<footer>&copy; host &middot; Words, words, words.</footer></body></html>"
    )


AD = '<div class="ad">Buy this, buy that, buy all of it, right now, while it is cheap, today.</div>'


@pytest.mark.parametrize(
    ("article", "want"),
    [
        ("<article><h1>Title</h1><p>One,  two\n three.</p><p>Four.</p></article>", "Title\n\nOne, two three.\n\nFour."),
        ("<article><p><b>Open<br><p>Next.</p></article>", "Open\n\nNext."),
        ("<article><p>a<b>b</b> c &amp; &lt;d&gt; &#233; &nbsp; e</p></article>", "ab c & <d> é e"),
        ("<article><p>Short.</p><script>x='<p>'</script><style>p{}</style><p>More.</p></article>", "Short.\n\nMore."),
        ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", "one\n\ntwo\n\nx\n\ny"),
        ('<article><p>Body, text.</p><form><p>Name, please</p></form><div class="comments">I, a reader</div></article>', "Body, text."),
        ("<article></article>", None),
        ('<div class="content"><p>First, of the text.</p><div><p>Second, of it.</p></div></div>', "First, of the text.\n\nSecond, of it."),
        ("<main><div><p>Deep, in main.</p></div><aside><p>Side, bar, bar, bar</p></aside></main>", "Deep, in main."),
    ],
)
def test_articles(article, want):
    got = main_text(page(article, head=AD, tail=f'<div id="sidebar"><p>{"Side, " * 50}</p></div>'))
    assert got == (want or "")


def test_links_are_discounted():
    links = "".join(f'<p><a href="/{i}">A link, with, many, commas, in it, number {i}</a></p>' for i in range(30))
    text = "<p>The text, which is plain.</p><p>And more of it, here.</p>"
    assert main_text(page(f"<div>{links}</div><div>{text}</div>")) == "The text, which is plain.\n\nAnd more of it, here."


def test_a_sibling_with_a_good_share_is_kept():
    one = f"<div><p>{'Some text, and more. ' * 20}</p></div>"
    two = f"<div><p>{'Other text, and more. ' * 15}</p></div>"
    got = main_text(page(one + two))
    assert "Some text" in got and "Other text" in got and "Words" not in got


@pytest.mark.parametrize(
    "source", [None, "", " ", "<", "<p", "<!--", "</", "<a <b", "plain", "<script>", "&#xZZ;", "<p>" * 3000, "<div>" * 3000 + "x", '<a b="']
)
def test_broken_pages(source):
    got = main_text(source)
    assert isinstance(got, str) and "<p>" not in got
    assert got == {"plain": "plain", "<div>" * 3000 + "x": "x", "&#xZZ;": html.unescape("&#xZZ;")}.get(source, got)


def test_cut_off_page():
    whole = page("<article><p>One.</p><p>Two, three.</p></article>")
    assert main_text(whole[: whole.index("</footer>") - 3]) == "One.\n\nTwo, three."
    assert main_text(whole[: whole.index("Two,") + 3]) == "One.\n\nTwo"


def test_long_pages_take_linear_time():
    text = " ".join(random.Random(1).choice(["ab", "cd,", "<b>x", "&amp;", "'\""]) for _ in range(300_000))
    assert len(main_text(f"<article><p>{text}</p></article>")) > 500_000


@pytest.mark.parametrize(
    "source",
    ["<b>" * 100_000 + "<p>x</p>" * 100_000, "<ul><li><ul>" + "<b>" * 100_000 + "<li>x</li>" * 100_000],
)
def test_unclosed_inline_tags_take_linear_time(source):
    start = time.process_time()
    assert main_text(source) == "\n\n".join(["x"] * 100_000)
    assert time.process_time() - start < 20


def test_query_columns(spark):
    rows = [(1, "u", page("<article><p>x, y</p></article>")), (1, "u", page("<article><p>x, y</p></article>")),
            (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' AS text", "1 AS n_chars")
    got = sorted(map(tuple, extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "x, y", 4), (1, "u", "x, y", 4), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract(df.limit(0)).count() == 0
