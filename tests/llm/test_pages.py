import html
import re

from lakeloom.llm import wrappers
from lakeloom.llm.common import table
from lakeloom.llm.dom import Node, matching, measure, parse

SF = "/root/testdata/sf0.01"


def page(body, head="<nav><a href=x>Home</a></nav>"):
    return f"<!doctype html><html><head><title>T</title><script>var a='</p>';</script></head><body>{head}{body}<footer>&copy; foot</footer></body></html>"


def test_given_pages_give_their_articles(spark):
    rows = {r.page_id: r for r in wrappers.extract_main_text(table(spark, SF, "pages")).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inner = re.sub(r"<[^>]*$", "", re.search(r"<article>(.*?)(</article>|$)", p.html, re.S)[1])
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in parts if b)
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want) and rows[p.page_id].url == p.url


def test_marks_names_and_roles():
    body = """<div class="cookie-notice">We use cookies</div><div id="sidebar">Side</div><main><h1>Title &amp; more</h1><p>One <b>two</b>
      three<br>four</p><div class="ad">Buy</div><form><input value=x>Search</form><ul><li>a<li>b</ul><section class="comments"><p>First!</p></section>
      <aside>see also</aside><div role="navigation">next</div><div hidden>gone</div><table><tr><td>x<td>y</table></main>"""
    assert wrappers.extract_group([page(body)]) == ["Title & more\nOne two three four\na\nb\nx\ny"]


def test_wrapper_tells_template_from_slots():
    def plain(k):
        return page(f"<div><div>Welcome to our site, dear reader of all things</div><div><h2>Story {k}</h2><p>Body of story {k} {'text ' * 30}{k}</p></div>"
                    "<div>All rights belong to somebody else entirely</div></div>", head="<div><a href=a>One</a> <a href=b>Two</a></div>")

    assert wrappers.extract_group([plain(k) for k in range(6)]) == [f"Story {k}\nBody of story {k} {'text ' * 30}{k}" for k in range(6)]


def test_copies_on_a_host_keep_their_text():
    same = page("<article><h1>H</h1><p>Same everywhere.</p></article>")
    assert wrappers.extract_group([same] * 9) == ["H\nSame everywhere."] * 9


def test_broken_pages(spark):
    rows = [(1, "http://a.example/x", None), (2, "http://a.example/y", ""), (3, None, "<article><p>cut &amp; off<p>here <b"), (4, "no url", "plain text"),
            (5, "http://a.example/z", "<p>a</p></p></div><p>b<!-- c"), (5, "http://a.example/z", "<p>a</p></p></div><p>b<!-- c"),
            (None, "http://A.example/", "<div><div><p>deep</div></div>"), (7, "http://b.example/", "<div>" * 3000 + "x")]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, part int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in wrappers.extract_main_text(pages).collect()), key=str)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "cut & off\nhere", 14), (4, "plain text", 10), (5, "a\nb", 3), (5, "a\nb", 3), (None, "deep", 4), (7, "x", 1)], key=str)
    assert wrappers.extract_main_text(pages.limit(0)).collect() == []


def test_hot_hosts_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "GROUP_PAGES", 5)
    rows = [(k, f"http://hot.example/{k}", page(f"<article><p>text {k}</p></article>")) for k in range(40)]
    got = {r.page_id: r.text for r in wrappers.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"text {k}" for k in range(40)}


def test_constant_nodes_decide_where_pages_are_marked():
    def marked(k):
        return page(f'<div class="layout no-sidebar" id="menu-closed"><article><p>Follow our house rules</p><h1>Story {k}</h1><p>Body {k}</p>'
                    f'<div class="social-history"><p>Past of {k}</p></div></article><div>More on {k}</div></div>')

    assert wrappers.extract_group([marked(k) for k in range(6)]) == [f"Story {k}\nBody {k}\nPast of {k}\nMore on {k}" for k in range(6)]
    assert wrappers.extract_group([marked(1)]) == ["Follow our house rules\nStory 1\nBody 1"]
    assert wrappers.extract_group([page('<form id="search"><div><p>One page in a form</p></div></form>')]) == ["One page in a form"]


def test_groups_of_a_host_are_even(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(wrappers, "GROUP_PAGES", 8)
    monkeypatch.setattr(wrappers, "extract_group", lambda pages: sizes.append(len(pages)) or [""] * len(pages))
    import pyarrow as pa

    rows = [("h", 0, k, "u", "<p>x") for k in range(33)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["host", "part", "page_id", "url", "html"])
    assert sum(b.num_rows for b in wrappers._extract([batch])) == 33
    assert min(sizes) >= wrappers.LEAST_PAGES and max(sizes) <= 8


def brute_weight(a: Node, b: Node) -> int:
    if a.tag != b.tag:
        return 0
    p, q = a.elements(), b.elements()
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i, u in enumerate(p):
        for j, v in enumerate(q):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_weight(u, v))
    return 1 + best[-1][-1]


def test_simple_tree_matching():
    import random

    rng = random.Random(7)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else ''}</{t}>" for t in rng.choices(["div", "span", "b", "i"], k=rng.randrange(4)))

    for _ in range(150):
        a, b = parse(tree(3)), parse(tree(3))
        measure(a)
        measure(b)
        pairs = matching(a, b)
        assert len(pairs) == brute_weight(a, b) and all(x.tag == y.tag for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
