import time

import pytest

from millrace.llm import page_text as p

PAGES = "page_id BIGINT, url STRING, html STRING"


def page(body, head="<title>no</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        (page("<nav>menu</nav><article><h1>A</h1><p>b  c\n d</p></article><footer>f</footer>"), "A b c d"),
        (page('<article><p>one <b>t</b>wo<br>three<p>four &amp; &lt;five&gt; &eacute;</article>'), "one two three four & <five> é"),
        (page('<div class="ad">buy</div><article>x<div id="comments"><p>nice</p></div></article>'), "x"),
        (page("<article>x<script>var a='</p>';</script><style>p{}</style><form>f</form><aside>s</aside>y</article>"), "x y"),
        (page("<main><p>in main</p></main><p>outside</p>"), "in main"),
        (page("<header>top</header><p>only body</p>"), "only body"),
        (page("<article><header><h1>T</h1></header><p>unclosed <b>tag"), "T unclosed tag"),
        (page("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>"), "a b c d"),
        (page('<article>ok</article><article class="comment">no</article>'), "ok"),
        (page("<article>a &am &unknown; &#65;&#x42;</article>"), "a &am &unknown; AB"),
        ("plain text &copy; only", "plain text © only"),
        ("<article><p>cut off in a tag <b cla", "cut off in a tag"),
    ],
)
def test_main_text(html, text):
    assert p.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (page("<div class='content no-sidebar'><p>the story</p></div>"), "the story"),
        (page("<form id='form1'><div class='sidebar'>side</div><p>all of the story</p></form>"), "all of the story"),
        (page("<article class='post category-advertising'><p>on adverts</p></article>"), "on adverts"),
        (page("<article>a<section id='social-study'>b</section><div class='related-work'>c</div></article>"), "a b c"),
        (page("<div class='text notice'><p>nearly the whole page</p></div><p>more</p>"), "nearly the whole page more"),
        (page("<article><p>story</p><div class='site-header'>x</div><div id='ad-slot-3'>a long advert</div>"
              "<div class='comment-list'>many long comments</div></article>"), "story"),
        (page("<p>a longer story here</p><form>Search <input></form><div class='cookie-banner'>we use cookies</div>"), "a longer story here"),
    ],
)
def test_marks_are_whole_names_and_never_take_most_of_a_page(html, text):
    assert p.main_text(html) == text


def run(spark, rows, **more):
    found = p.extracted(spark.createDataFrame(rows, PAGES), **more).collect()
    return sorted(((r.page_id, r.text, r.n_chars) for r in found), key=repr)


def test_subtrees_of_many_pages_of_a_host_go(spark):
    shell = '<div class="x1"><p>Our slogan, seen everywhere</p></div><div>{}</div><div><p>All rights</p></div>'
    rows = [(i, f"http://h.example/{i}", page(shell.format(f"<p>story {i}</p>"))) for i in range(6)]
    rows.append((100, "http://other.example/1", page(shell.format("<p>story</p>"))))
    found = {r[0]: r[1] for r in run(spark, rows)}
    assert found[3] == "story 3"
    assert found[100] == "Our slogan, seen everywhere story All rights"


def test_quoted_passages_stay_in_articles_but_link_lists_go(spark):
    links = '<div><a href="/a">More of this</a> <a href="/b">and that</a></div>'
    body = "<article><p>a passage that many quote</p><p>own {}</p>" + links + "</article>"
    rows = [(i, f"http://h.example/{i}", page(body.format(i))) for i in range(8)]
    assert {r[1] for r in run(spark, rows)} == {f"a passage that many quote own {i}" for i in range(8)}


def test_copies_count_once(spark):
    copy = page("<div><p>same story on every copy</p></div>")
    rows = [(i, "http://h.example/x", copy) for i in range(50)]
    assert {r[1] for r in run(spark, rows)} == {"same story on every copy"}


def test_nulls_repeated_rows_empty_tables_and_long_pages(spark):
    long = "word " * 200_000
    rows = [
        (None, None, None),
        (1, None, ""),
        (2, "not a url", page("<article>x</article>")),
        (2, "not a url", page("<article>x</article>")),
        (3, "http://u@h.example:80/", page(f"<article>{long}</article>")),
        (4, "http://h.example", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    found = run(spark, rows)
    assert [r for r in found if r[0] == 2] == [(2, "x", 1)] * 2
    assert (None, "", 0) in found and (1, "", 0) in found
    assert (3, long.strip(), len(long) - 1) in found and (4, "deep", 4) in found
    assert run(spark, rows[:0]) == []
    more = spark.createDataFrame(
        [(*rows[2], "a", "b")], PAGES + ", host STRING, templates STRING"
    )
    assert [r.text for r in p.extracted(more).collect()] == ["x"]


def test_broken_markup_takes_linear_time():
    """A page of a megabyte whose end tags match nothing, and one that nests without end."""
    for page in ("<div>a</b>" * 100_000, "<b><p>x" * 100_000, "</i></td>" * 100_000):
        started = time.process_time()
        p.Tree(page)
        assert time.process_time() - started < 20
