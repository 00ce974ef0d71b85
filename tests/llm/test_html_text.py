import random
from collections import Counter

import pytest

from touchtrail.llm import html_text

SCHEMA = "page_id bigint, url string, html string, main string, place int, host string, row int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "m", 1, "h", 2) for r in rows], SCHEMA).repartition(3)


def main_text(page):
    return [t for kind, t in html_text.blocks(page) if kind == "main"]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><h1>A &amp; b</h1><p><b>one<br><p>two  \n three</p></article>", ["A & b", "one", "two three"]),
        ("<nav>m</nav><main><p>x&nbsp;y<aside>s</aside><p>z</main><footer>f</footer>", ["x y", "z"]),
        ("<article>a<script>if (x<y) '</p>'</script>b<style>p{}</style><!-- <p>c --> d</article>", ["ab d"]),
        ("<article>t<div class='reader-comments'><p>c</div><form>name<input></form><p>u</article>", ["t", "u"]),
        ("<article><div class=\"ad\">buy</div><p title='a>b'>kept</article><div>out</div>", ["kept"]),
        ("<ARTICLE><P>up</P></ARTICLE>", ["up"]),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c<td>d</table></article>", ["one", "two", "c", "d"]),
        ("<header>h</header><article><header><h1>T</h1></header>x<footer>by</footer></article>", ["T", "x"]),
        ("<article>1 < 2 &lt;b&gt; &#233; &notanentity; &amp</article", ["1 < 2 <b> é ¬anentity; &"]),
        ("<div class='post-content'><p>p</p></div><div id=sidebar>s</div>", ["p"]),
        ("<article>never closed <p>end", ["never closed", "end"]),
        ("<article><p hidden>no</p><p style='display: none'>no</p>yes</article>", ["yes"]),
        ("<div class='wrap no-sidebar'><article><div class=article-header><h1>T</h1></div>x</article></div>", ["T", "x"]),
        ("", []),
        ("<<<>>>", []),
    ],
)
def test_main_part(page, want):
    assert main_text(page) == want


def brute_force(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(0, 14))] for _ in range(2))
        same = html_text.shared_lines(a, b)
        there = iter(b)
        assert sum(same) == brute_force(a, b)
        assert all(x in there for x, s in zip(a, same) if s)


def page(*lines):
    return "<html><head><title>t</title></head><body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body></html>"


def test_pages_without_a_marked_part_lose_what_their_neighbours_share(spark):
    top, low = ("Home", "News"), ("All rights", "Contact")
    rows = [
        (1, "http://a.example/x/1", page(*top, "first story " * 9, *low)),
        (2, "http://a.example/x/2", page(*top, "second story " * 9, "more of it", *low)),
        (3, "http://a.example/x/2?print", page(*top, "second story " * 9, "more of it", *low)),
        (4, "http://b.example/x/1", page(*top, "other host " * 9)),
        (5, "http://a.example/y", page(*top, "<article>marked</article>", *low)),
        (6, None, page("alone")),
        (7, "http://a.example/x/3", None),
        (None, "http://c.example/", ""),
        (8, "http://d.example/1", page("copy")),
        (8, "http://d.example/1", page("copy")),
    ]
    found = html_text.extract_text(frame(spark, rows)).collect()
    want = [
        (1, rows[0][1], ("first story " * 9).strip()),
        (2, rows[1][1], ("second story " * 9).strip() + "\nmore of it"),
        (3, rows[2][1], ("second story " * 9).strip() + "\nmore of it"),
        (4, rows[3][1], "\n".join([*top, ("other host " * 9).strip()])),
        (5, rows[4][1], "marked"),
        (6, None, "alone"),
        (7, rows[6][1], ""),
        (None, rows[7][1], ""),
        (8, rows[8][1], "copy"),
        (8, rows[9][1], "copy"),
    ]
    assert Counter(map(tuple, found)) == Counter(want)


def test_shared_text_over_four_fifths_goes_if_it_recurs_on_the_host(spark):
    menu = [f"menu entry {k} " + "m" * 40 for k in range(10)]
    story = {k: f"story {k} " + "s" * 90 for k in range(12)}
    rows = [(k, f"http://a.example/x/{k:02}", page(*menu[:5], story[k], *menu[5:])) for k in story]
    long = [f"paragraph {k} " + "p" * 200 for k in range(6)]
    copies = [
        (20, "http://a.example/y/1", page(*menu[:5], *long, "read 1", *menu[5:])),
        (21, "http://a.example/y/2", page(*menu[:5], *long, "read 2", *menu[5:])),
    ]
    few = [(k, f"http://b.example/{k}", page(*menu, story[k - 30])) for k in (30, 31, 32)]
    pair = [(k, f"http://c.example/{k}", page(*long, f"read {k}")) for k in (40, 41)]
    got = {r.page_id: r.text for r in html_text.extract_text(frame(spark, rows + copies + few + pair)).collect()}
    assert [got[k] for k in story] == list(story.values())
    assert [got[k] for k in (30, 31, 32)] == [story[k] for k in (0, 1, 2)]
    assert set(long) <= set(got[20].split("\n")) and set(long) <= set(got[21].split("\n"))
    assert not set(menu) & set((got[20] + "\n" + got[21]).split("\n"))
    assert [got[k] for k in (40, 41)] == ["\n".join([*long, f"read {k}"]) for k in (40, 41)]


def test_the_nearer_neighbour_is_told_by_whole_paths(spark):
    far = "http://a.example/" + "é/" * 200
    rows = [
        (1, far + "a", page("with the one before", "first " * 9)),
        (2, far + "b/1", page("with the one before", "with the one after", "second " * 9)),
        (3, far + "b/2", page("with the one after", "third " * 9)),
    ]
    got = {r.page_id: r.text for r in html_text.extract_text(frame(spark, rows)).collect()}
    assert got[2] == "with the one before\n" + ("second " * 9).strip()


def test_long_and_odd_pages(spark):
    rows = [(1, "u", "<article>" + "<p>word " * 20_000), (2, "u", "<div>" * 5000 + "deep"), (3, "%%%", "a" * 100_000)]
    got = {r.page_id: r.text for r in html_text.extract_text(frame(spark, rows)).collect()}
    assert got[1].count("\n") == 19_999 and got[2] == "deep" and len(got[3]) == 100_000


def test_empty_table(spark):
    assert html_text.extract_text(frame(spark, [])).count() == 0


def test_marked_parts_lose_the_lines_of_their_template_only(spark):
    def article(*lines):
        return "<body><article>" + "".join(f"<p>{x}</p>" for x in lines) + "</article></body>"

    top, low, quoted = "Listen to this page", "Rate what you read", "a passage that some articles quote " * 3
    own = {k: [f"first {k} " + "s" * 90, *([quoted] if k % 2 else []), f"last {k} " + "t" * 60] for k in range(12)}
    rows = [(k, f"http://a.example/x/{k:02}", article(top, *own[k], low)) for k in own]
    # Copies of one article, few pages, and a line that others have in their frame.
    same = [f"paragraph {k} " + "p" * 200 for k in range(6)]
    rows += [(20 + k, f"http://b.example/{k:02}", article(*same, f"read {k}")) for k in range(10)]
    rows += [(40 + k, f"http://c.example/{k}", article(top, f"story {k} " * 9)) for k in range(4)]
    rows += [(65, "http://d.example/05x", "<nav><li>Contact</li></nav><article><p>Contact 5<p>Contact</article>")]
    rows += [(70 + k, f"http://d.example/{k:02}", f"<nav><li>Contact</li></nav><article><p>story {k}</article>") for k in range(10)]
    got = {r.page_id: r.text for r in html_text.extract_text(frame(spark, rows)).collect()}
    assert [got[k] for k in own] == ["\n".join(x.strip() for x in own[k]) for k in own]
    assert all(got[20 + k] == "\n".join([*same, f"read {k}"]) for k in range(10))
    assert all(got[40 + k] == f"{top}\n" + (f"story {k} " * 9).strip() for k in range(4))
    assert got[65] == "Contact 5\nContact" and got[73] == "story 3"
