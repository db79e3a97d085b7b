import random
import time
from collections import Counter

import pytest

from sarraf.llm import pages

SCHEMA = "page_id long, url string, html string, text string, blocks int"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], SCHEMA)


def result(df):
    return {r.page_id: r.text for r in pages.extract(df).collect()}


@pytest.mark.parametrize("html, want", [
    (None, []), ("", []), ("plain &amp; simple", ["plain & simple"]), ("a <b>b</b>c<br>d\n\t e", ["a bc d e"]),
    ("<p>one<p>two <div>three</div>four", ["one", "two", "three", "four"]),
    ("<p><b>x<br><p>y</p></b> z", ["x", "y", "z"]),
    ("<script>var a='</p>';</script><style>p{}</style>t<!-- c > --><!doctype x>u", ["tu"]),
    ("<nav><p>menu</nav><header>top</header><article><header><h1>T</h1></header>x<footer>f</footer></article>", ["T", "x"]),
    ("<div class='ad box'>buy</div><div id=comments><p>reader</div><p>text", ["text"]),
    ("<div class=\"x\" hidden>a</div><p style='display:none'>b</p><p>c", ["c"]),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c", "d", "e"]),
    ("a < b &copy; &#233; &nbsp; x <3", ["a < b © é x <3"]), ("<p>open <a href='x>y'>link", ["open link"]),
    ("<form><p>f</form><button>b</button><select><option>o</select><noscript>n</noscript>t", ["t"]),
    ("<div class='content has-sidebar'>text<div class='user-comments'>no</div></div>", ["text"]),
    ("<!-- never closed", []), ("<script>never closed", []), ("<p>" * 3000 + "deep", ["deep"]), ("<div>" * 3000 + "deep", ["deep"]),
])
def test_blocks(html, want):
    assert [text for _, text, _ in pages.blocks(html)] == want


def test_tree_matching_keeps_order():
    a, b = pages._tree("/a/b\n/a/c\n/d"), pages._tree("/d\n/a/c\n/a/b")
    assert pages.tree_match(a, a)[0] == 4
    assert pages.tree_match(a, b)[0] == 2
    assert pages.aligned("/x/p\n/y/p\n/x/q", "/x/p\n/x/q") == ["/x/p", "/x/q"]


def test_template_of_a_host_goes_and_articles_stay(spark):
    def page(i, notice="All rights"):
        return f"<div class=top><p>Site {'A'}</p></div><div class=story><p>Story {i}</p><p>More {i}</p></div><div class=end><p>{notice}</p></div>"

    rows = [(i, f"http://A.example/{i}", page(i)) for i in range(20)]
    rows += [(100 + i, f"http://b.example/{i}", page(i)) for i in range(3)]  # too few pages for a template
    rows += [(200 + i, "http://c.example/x", "<article><p>Same</p></article><p>out</p>") for i in range(30)]
    rows += [(300, None, "<p>no url"), (301, "http://A.example/z", None), (302, "http://A.example/z", ""), (0, "http://A.example/0", page(0))]
    got = result(frame(spark, rows).repartition(3))
    assert all(got[i] == f"Story {i}\nMore {i}" for i in range(20))
    assert all(got[100 + i] == f"Site A\nStory {i}\nMore {i}\nAll rights" for i in range(3))
    assert all(got[200 + i] == "Same" for i in range(30))
    assert (got[300], got[301], got[302]) == ("no url", "", "")
    assert pages.extract(frame(spark, rows)).count() == len(rows)


def test_template_goes_from_articles_and_varying_text_is_the_root(spark):
    rows = [(i, f"http://a.example/{i}", f"<article><p>Story {i}</p><div class=tell><p>Tell a friend</p></div></article>") for i in range(12)]
    rows += [(100 + i, f"http://b.example/{i}", f"<div class=story><p>Long story number {i}</p></div><article><p>See {i}</p></article>") for i in range(12)]
    rows += [(200 + i, f"http://b2.example/{i}", f"<div class=x><p>Top</p></div><div class=story><p>Long story number {i}</p></div><article><p>See {i}</p></article>") for i in range(12)]
    got = result(frame(spark, rows))
    assert all(got[i] == f"Story {i}" for i in range(12))
    assert all(got[k + i] == f"Long story number {i}" for k in (100, 200) for i in range(12))


def test_every_layout_of_a_host_has_its_template(spark):
    """60 pages of one layout and 40 of another; the third has the slots of the first in another order."""

    def a(i):
        return f"<div class=top><p>Menu of layout A</p></div><div class=story><p>Story {i}</p></div>"

    def b(i):
        return f"<table><tr><td>Menu of layout B</td></tr></table><section><h2>Head {i}</h2><ul><li>Item {i}</ul></section><div class=end><p>End of B</p></div>"

    def c(i):
        return f"<section><h1>Report {i}</h1><div class=x><p>Deep {i}</p></div></section><div class=top><p>Menu of layout C</p></div>"

    rows = [(i, f"http://a.example/{i}", a(i)) for i in range(60)]
    rows += [(100 + i, f"http://a.example/b{i}", b(i)) for i in range(40)]
    rows += [(200 + i, f"http://a.example/c{i}", c(i)) for i in range(9)]
    got = result(frame(spark, rows))
    assert all(got[i] == f"Story {i}" for i in range(60))
    assert all(got[100 + i] == f"Head {i}\nItem {i}" for i in range(40))
    assert all(got[200 + i] == f"Report {i}\nDeep {i}" for i in range(9))


def test_equal_pages_are_one_page(spark):
    rows = [(i, "http://a.example/", "<p>The only page</p>") for i in range(20)]
    assert set(result(frame(spark, rows)).values()) == {"The only page"}


def plain_texts(rows):
    """The same rule without Spark: everything of a host in dictionaries."""
    parsed = [(i, url.split("/")[2], pages.blocks(html)) for i, url, html in rows]
    out = {}
    for host in {h for _, h, _ in parsed}:
        distinct = {str(own): own for _, h, own in parsed if h == host}
        shapes = Counter("\n".join(dict.fromkeys(s for s, _, _ in own)) for own in distinct.values())
        order = [s for s, _ in sorted(shapes.items(), key=lambda r: -r[1])]
        assert len(order) <= pages.LEADERS
        shape_slots = {s: pages.layout(s, tuple(order)) for s in order}
        held, counts = Counter(), Counter()
        for own in distinct.values():
            _, partners = shape_slots["\n".join(dict.fromkeys(s for s, _, _ in own))]
            leaders = {s: {k for k, p in partners if p == s} or {None} for s, _, _ in own}
            held.update((k, s) for s in leaders for k in leaders[s])
            counts.update((k, s, t) for s, t in {(s, t) for s, t, _ in own} for k in leaders[s])
        fixed = {(s, t) for (k, s, t), n in counts.items() if n >= pages.TEMPLATE_PAGES and n * 100 >= pages.TEMPLATE_PERCENT * held[k, s]}
        mine = [(i, own, [b for b in own if (b[0], b[1]) not in fixed]) for i, h, own in parsed if h == host]
        marked = [varying for _, own, varying in mine if any(b[2] for b in own)]
        inside, outside = (sum(len(b[1]) for v in marked for b in v if b[2] == side) for side in (True, False))
        for i, own, varying in mine:
            if any(b[2] for b in own):
                if len(marked) < pages.TEMPLATE_PAGES or inside + outside == 0:
                    varying = [b for b in own if b[2]]
                else:
                    varying = [b for b in varying if b[2] == (inside >= outside)]
            out[i] = "\n".join(b[1] for b in varying)
    return out


def test_hosts_against_plain_python(spark):
    draw = random.Random(5)
    parts = [
        lambda i: "<div class=top><p>Top of all</p></div>", lambda i: f"<p>Text {i}</p>", lambda i: "<ul><li>One<li>Two</ul>",
        lambda i: f"<section><h2>Head {i % 7}</h2></section>", lambda i: f"<article><p>Body {i}</p><p>Tell a friend</p></article>",
        lambda i: f"<table><tr><td>Cell {i % 2}</table>", lambda i: "<div class=end><p>Imprint</p></div>",
    ]
    layouts = [draw.sample(range(len(parts)), 4) for _ in range(6)]
    rows = []
    for i in range(400):
        host, order = draw.choice("aaaabc"), draw.choice(layouts)
        rows.append((i, f"http://{host}.example/{i}", "".join(parts[k](i // 2) for k in order)))
    assert result(frame(spark, rows)) == plain_texts(rows)


@pytest.mark.parametrize("html", [
    "<div><b>" * 20_000 + "</p>" * 20_000 + "end", "<p><table>" + "<div>" * 30_000 + "end", "<i><p>" + "<b>" * 20_000 + "</i>x" * 20_000,
    "<a \"x>" + "<b '>t" * 20_001, "<p>" + "<u>" * 20_000 + "t<u>" * 20_000,
])
def test_damaged_pages_take_linear_time(html):
    start = time.perf_counter()
    pages.blocks(html)
    assert time.perf_counter() - start < 2


def test_many_distinct_classes_align_in_little_time():
    one = "\n".join(f"/div.a{k}" for k in range(50_000))
    other = "\n".join(f"/div.a{k}" for k in range(25_000, 75_000))
    start = time.perf_counter()
    assert len(pages.aligned(one, other)) == 25_000
    assert time.perf_counter() - start < 5


@pytest.mark.parametrize("seed", range(20))
def test_tree_match_is_the_largest(seed):
    draw = random.Random(seed)

    def tree(depth):
        names = draw.sample("abcdef", draw.randint(0, 5)) if depth else []
        return {n: tree(depth - 1) for n in names}

    def largest(a, b):
        left, right = list(a.items()), list(b.items())
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, (x, p) in enumerate(left):
            for j, (y, q) in enumerate(right):
                here = best[i][j] + 1 + largest(p, q) if x == y else 0
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], here)
        return best[-1][-1]

    def count(pairs):
        return sum(1 + count(below) for _, below in pairs)

    a, b = tree(3), tree(3)
    size, pairs = pages.tree_match(a, b)
    assert size == largest(a, b) == count(pairs)


def test_empty_table_and_long_page(spark):
    assert result(frame(spark, []).limit(0)) == {}
    html = "<article>" + "".join(f"<p>par {k}</p>" for k in range(50_000)) + "</article>"
    assert result(frame(spark, [(1, "http://a/", html)]))[1].count("\n") == 49_999
