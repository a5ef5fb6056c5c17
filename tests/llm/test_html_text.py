from __future__ import annotations

import html.parser
import itertools
import os
import random

from brightloom.llm import html_text
from brightloom.llm.common import table


class Plain(html.parser.HTMLParser):
    """The article's blocks by a parser of another make."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks, self.now = False, [], ""

    def cut(self):
        text = " ".join(self.now.split())
        if text:
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "article"):
            self.cut()
        if tag == "br":
            self.now += " "
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "article"):
            self.cut()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.now += data


def test_whole_table_equals_another_parser(spark, sf_dir):
    for r in html_text.extract(table(spark, sf_dir, "pages")).join(table(spark, sf_dir, "pages"), ["page_id", "url"]).collect():
        plain = Plain()
        plain.feed(r.html)
        plain.close()
        plain.cut()
        assert r.text == "\n\n".join(plain.blocks) and r.n_chars == len(r.text)


def test_markup_rules():
    page = """<html><head><title>t</title></head><body><header>Top</header><div class="cookie-notice">We use cookies</div>
    <article><h1>A &lt;b&gt; title</h1><p class=lead>One<br>two&nbsp; three<p>Four <b>five</b>six &#233;</p><ul><li>a</li><li>b</li></ul>
    <div class='ads'>Buy</div><form>mail</form><!-- no > --><script>if (a < b) x("</p>")</script><table><tr><td>c</td><td>d</td></tr></table>
    <section id="comments"><p>me too</p></section></article><aside>side</aside><footer>&copy; end</footer>"""
    assert html_text.main_text(page, None).split("\n\n") == ["A <b> title", "One two three", "Four fivesix é", "a", "b", "c d"]
    assert html_text.main_text("plain text &amp; more", None) == "plain text & more"
    for broken in ("<", "<p", "<p class=\"x", "a<!-- b", "<script>x", "</div></div>x", "<p>a</article>b", None, "", "<article></article>"):
        assert isinstance(html_text.main_text(broken, None), str)
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000, None) == "deep"
    assert len(html_text.main_text("<article>" + "<p>x y</p>" * 50000, None).split("\n\n")) == 50000


def test_class_names_that_only_hint_do_not_lose_text():
    for page in ('<article class="post has-social"><p>whole</p></article>', '<article><div class="content with-sidebar"><p>whole</p></div></article>',
                 '<article><p class="share-price">whole</p></article>', '<article><div class="related-work">whole</div></article>',
                 '<article><p id="reply">whole</p></article>', '<main class="menu"><p>whole</p></main>', '<div class="site-search">whole</div>',
                 '<div class="menu-page"><p>whole</p></div>'):
        assert html_text.main_text(f"<body class='nav'>{page}</body>", None) == "whole", page
    wrapped = "<div class='popup'>" + "".join(f"<p>line {i} of the text</p>" for i in range(9)) + "</div><p>beside</p>"
    assert html_text.main_text(wrapped, None).startswith("line 0 of the text")
    teaser = "<article><p>Read on</p></article><div><p>The whole story is told here.</p><p>It has two parts.</p></div>"
    assert html_text.main_text(teaser, None) == "Read on\n\nThe whole story is told here.\n\nIt has two parts."


def test_neighbour_decides_lines_in_doubt(spark):
    """Hinted elements go where the neighbour has them too and stay where it has not."""
    def page(story, extra):
        return f'<article><h1>{story}</h1><div class="share">Tell your friends</div><div class="related-work">{extra}</div><p>{story} goes on</p></article>'

    rows = [(1, "http://h.org/a/1", page("One", "See the first")), (2, "http://h.org/a/2", page("Two", "See the second"))]
    got = {r.page_id: r.text.split("\n\n") for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: ["One", "See the first", "One goes on"], 2: ["Two", "See the second", "Two goes on"]}


def test_pairing_equals_brute_force_on_pages_without_articles(spark, sf_dir):
    """Every page of the table with its article markup taken out: menus, notices and stories stand side by side."""
    frame = table(spark, sf_dir, "pages")
    rows = []
    for i, r in enumerate(frame.orderBy("page_id").collect()):
        html = r.html.replace("<article>", "<div>").replace("</article>", "</div>").replace("<div class=\"ad\">", f"<div>Notice {i % 2}</div><div>")
        rows.append((r.page_id, f"http://h{i % 7}.org/{'ab'[i % 2]}/{i}", f"<div>Site of h{i % 7}</div>{html}<div>End of h{i % 7}</div>"))
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    found = {i: html_text.lines(h) for i, _, h in rows}
    hosts = {}
    for i, url, _ in rows:
        host, path = url[7:].split("/", 1)
        hosts.setdefault(host, []).append(("/" + path, i))

    def near(own, other):
        if other is None:
            return -1
        a, b = ({t for zone, t in found[x[1]] if zone in (html_text.OPEN, html_text.DOUBT)} for x in (own, other))
        if len(a & b) >= 0.9 * max(len(a), 1):
            return -1
        return len(os.path.commonprefix([own[0], other[0]]))

    shorter = 0
    for pages in hosts.values():
        pages.sort()
        for k, own in enumerate(pages):
            before, after = (pages[k - 1] if k else None), (pages[k + 1] if k + 1 < len(pages) else None)
            x, y = near(own, before), near(own, after)
            other = None if max(x, y) < 0 else after if y > x else before
            mine = [t for zone, t in found[own[1]] if zone == html_text.OPEN]
            if other:
                theirs = [t for zone, t in found[other[1]] if zone == html_text.OPEN]
                gone = plain_common(mine, theirs)
                shorter += bool(gone)
                mine = [t for i, t in enumerate(mine) if i not in gone]
                assert len(got[own[1]].split("\n\n")) == len(mine)
            else:
                assert got[own[1]] == "\n\n".join(mine)
    assert shorter > len(rows) / 2


def plain_common(a, b):
    """Places of ``a`` on one longest common subsequence, by the full table."""
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            size[i + 1][j + 1] = size[i][j] + 1 if a[i] == b[j] else max(size[i][j + 1], size[i + 1][j])
    out, i, j = set(), len(a), len(b)
    while i and j:
        if size[i][j] == size[i - 1][j]:
            i -= 1
        elif size[i][j] == size[i][j - 1]:
            j -= 1
        else:
            out.add(i - 1)
            i, j = i - 1, j - 1
    return out


def test_common_lines_is_a_longest_subsequence():
    draw = random.Random(1)
    for _ in range(300):
        a, b = ([draw.randrange(4) for _ in range(draw.randrange(0, 7))] for _ in "ab")
        shared = [x for x, s in zip(a, html_text.common_lines(a, b)) if s]
        left = iter(b)
        assert all(x in left for x in shared)
        best = max(n for n in range(len(a) + 1) if any(set_in(c, b) for c in itertools.combinations(a, n)))
        assert len(shared) == best


def set_in(c, b):
    left = iter(b)
    return all(x in left for x in c)


def test_shared_lines_of_the_neighbour_are_deleted(spark):
    def page(body):
        return f"<body><div>Home</div><div>News</div><div>{body}</div><div>All rights</div></body>"

    rows = [(1, "http://h.org/a/1", page("first story"), 0), (2, "http://h.org/a/2", page("second story"), 0), (3, "http://h.org/b/9", page("ninth story"), 0),
            (4, "http://other.org/x", page("alone"), 0), (5, None, None, 0), (6, "no url", "", 0), (1, "http://h.org/a/1", page("first story"), 0)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 7
    assert texts == {1: "first story", 2: "second story", 3: "ninth story", 4: "Home\n\nNews\n\nalone\n\nAll rights", 5: "", 6: ""}
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
