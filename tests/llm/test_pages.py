from __future__ import annotations

import random
import time

from tests.llm.corpus import multiset
from vecindad.llm import pages

SCHEMA = "page_id long, url string, html string, host string, texts string"


def table(spark, some):
    return spark.createDataFrame([(*r, "clash", "clash") for r in some], SCHEMA).repartition(3)


def page(k, body):
    return f"<html><head><title>t</title></head><body><nav><a href='/x'>Menu {k}</a></nav>{body}<footer>&copy; f</footer></body>"


def test_structure():
    html = """<html><body class=x><header>Top</header><div class="main-nav menu">no</div><article class="post">
    <h1>Title &amp;  more</h1><p>One <b>bold</b>
    line.<br>Next<script>var t="</p>";</script><style>p{}</style><form>no</form>
    <p>Two &lt;tag&gt; &eacute;<aside>no</aside><div id="comments"><p>no</p></div><ul><li>item</li></ul>
    <!-- no --></article><p class="cookie notice">no</p><footer>no</footer></body></html>"""
    assert [t for t, _ in pages.blocks(html)] == ["Title & more", "One bold line. Next", "Two <tag> é", "item"]
    assert pages.blocks("") == [] and [t for t, _ in pages.blocks("plain <i>text</i> <foot")] == ["plain text"]
    assert [t for t, _ in pages.blocks("<p>a</p></div></p><p>b")] == ["a", "b"]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randint(0, 5) for _ in range(rng.randint(0, 12))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(0, 12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(pages.shared_lines(a, b))
        assert len(set(found)) == len(found) == table[-1][-1]
        rest = iter(b)
        assert all(a[k] in rest for k in found)


def test_shared_lines_of_neighbours_go(spark):
    frame = "<p>Welcome to our site</p><p>Call us today</p>"
    some = [
        (k, f"http://h.org/a/{k}", page(k, f"{frame}<p>Story {k} has its own long and quite different words {k * 7}.</p>"))
        for k in range(30)
    ]
    some += [(100, "http://h.org/a/article", page(0, f"<article>{frame}<p>Kept.</p></article>"))]
    some += [(400 + k, f"http://two.org/{k}", page(k, f"<article><p>An end of both.</p><p>Story {k}.</p></article>")) for k in range(2)]
    some += [(200, None, "<p>alone</p>"), (201, "nonsense", None), (202, "http://z.org/", ""), (None, None, None)]
    some += [(300, "http://copy.org/1", page(1, "<p>Same text.</p>")), (301, "http://copy.org/2", page(1, "<p>Same text.</p>"))]
    some += [some[0]]
    got = pages.extract(table(spark, some)).collect()
    assert len(got) == len(some)
    text = {r.page_id: r.text for r in got}
    assert all(text[k] == f"Story {k} has its own long and quite different words {k * 7}." for k in range(30))
    assert text[100] == "Welcome to our site\nCall us today\nKept."
    assert all(text[400 + k] == f"An end of both.\nStory {k}." for k in range(2))
    assert (text[200], text[201], text[202], text[None], text[300]) == ("alone", "", "", "", "Same text.")
    assert multiset(r.n_chars for r in got) == multiset(len(r.text) for r in got)


def test_neighbours_do_not_depend_on_partitions(spark):
    some = [(k, f"http://h{k % 2}.org/p/{k * 37 % 101}", str(k)) for k in range(100)]
    keyed = pages._keyed(table(spark, some))
    host = {r._key: r._host for r in keyed.collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append({r._key: r.other for r in pages.neighbours(keyed).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == 100
    assert all(host[k] == host[v] for k, v in found[0].items())


def test_empty(spark):
    assert pages.extract(table(spark, [])).count() == 0


def test_shared_lines_inside_main_elements_go(spark):
    """Unnamed menus and notices that a main or article element wraps too."""
    some = []
    for k in range(12):
        tag = "main" if k % 2 else "article"
        own = f"<p>Story {k} has its own long and quite different words {k * 7}.</p><p>And an end {k}.</p>"
        some.append((k, f"http://m.org/a/{k}", page(k, f"<{tag}><p>Home, News</p>{own}<p>Tell your friends</p></{tag}>")))
    text = {r.page_id: r.text for r in pages.extract(table(spark, some)).collect()}
    assert text == {k: f"Story {k} has its own long and quite different words {k * 7}.\nAnd an end {k}." for k in range(12)}


def test_short_articles_in_a_large_frame(spark):
    frame = "".join(f"<p>Notice {n} of this site, which is longer than any story on it.</p>" for n in range(9))
    some = [(k, f"http://f.org/a/{k:03}", page(k, f"{frame}<p>Story {k}.</p>")) for k in range(20)]
    # Copies under neighbouring URLs, and two versions of one article on a host without a frame of that size.
    some += [(100 + k, f"http://c.org/a/{k:03}", page(k, f"<p>Call us.</p><p>The one story {k // 8} of copies.</p>")) for k in range(32)]
    long = "".join(f"<p>Part {n} of a long article.</p>" for n in range(6))
    some += [(200 + k, f"http://v.org/a/{k}", page(k, f"<p>Call us.</p>{long}<p>Version {k}.</p>")) for k in range(2)]
    some += [(210 + k, f"http://v.org/b/{k}", page(k, f"<p>Call us.</p><p>Another story {k}, with words of its own.</p>")) for k in range(40)]
    text = {r.page_id: r.text for r in pages.extract(table(spark, some)).collect()}
    assert all(text[k] == f"Story {k}." for k in range(20))
    assert all(text[100 + k] == f"The one story {k // 8} of copies." for k in range(32))
    whole = "\n".join(f"Part {n} of a long article." for n in range(6))
    assert all(text[200 + k] == f"{whole}\nVersion {k}." for k in range(2))
    assert all(text[210 + k] == f"Another story {k}, with words of its own." for k in range(40))


def texts(html):
    return [t for t, _ in pages.blocks(html)]


def test_end_tags_left_out():
    assert texts('<article><p class="share">Share this<p>Real text one<p>Real text two</article>') == ["Real text one", "Real text two"]
    assert texts('<ul><li class="ad">Ad<li>Item <b>one<li>Item two</ul><p>End') == ["Item one", "Item two", "End"]
    assert texts('<ul><li>A<ul><li class="ad">B</ul>C<li>D</ul>') == ["A", "C", "D"]
    assert texts('<dl><dt class="menu">no<dd>yes<dt>t<dd class="promo">no</dl>z') == ["yes", "t", "z"]
    assert texts('<table><tr><td class="ad">no<td>yes<tr class="ad"><td>no<tr><td><p>in</p></div>cell</table>z') == ["yes", "in", "cell", "z"]
    assert texts('<p class="ad">no<div>yes</div><p class="ad">no <b>no</b><h2>yes</h2>') == ["yes", "yes"]
    assert texts('<div class="ad">no<p>no<p>no</div>yes') == ["yes"]
    assert texts('<span><div class="ad">no</span> no</div>yes') == ["yes"]
    assert texts('<p class="ad"><button><p>no</button>no<p>yes') == ["yes"]


def test_article_by_share_of_text():
    story = "A long story in a plain element, with many more words than the teaser beside it."
    assert texts(f"<div>{story}</div><article>Teaser</article>") == [story, "Teaser"]
    assert texts(f"<div>Line</div><article>{story}</article>") == [story]
    assert texts(f'<article><div class="article-header"><h1>Title</h1></div><p class="job-search">{story}</p></article>') == ["Title", story]
    assert texts(f'<div class="site-header">no</div><div role="search">no</div><div class="job-search">{story}</div>') == [story]


def test_long_unclosed_pages_take_linear_time():
    def seconds(n):
        html = "<p><b><i>word" * n + "<a <a" * n + "<ul>" + "<li><span>x" * n + "<" * n
        start = time.perf_counter()
        found = pages.blocks(html)
        assert len(found) >= n
        return time.perf_counter() - start

    seconds(100)
    assert seconds(20000) < 40 * max(seconds(2000), 0.02)
