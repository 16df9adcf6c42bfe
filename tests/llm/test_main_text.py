"""Main text of pages: what names, the tree of a host and odd markup decide."""

import math

import pytest

from staywise.llm import html

SCHEMA = "page_id long, url string, html string"
WRAPPERS = ["content has-sidebar", "no-sidebar", "ad-free", "comments-open", "page-header-fixed", "tags-python", "widget-area", "post share"]


def texts(spark, rows):
    return {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("names", WRAPPERS)
def test_a_named_branch_that_holds_the_article_stays(names):
    page = f"<div class='{names}'><div class='share'>Share</div><article><h2 class='social'>H</h2><p id='related-work'>P</p></article><div id='comments'><article class='comment'>no</article></div></div>"
    assert html.main_text(page, frozenset()) == "H\n\nP"


def test_names_mark_containers_and_whole_class_names_of_running_text():
    page = "<p>a</p><p class='ad'>b</p><p class='ad-hoc'>c</p><p>d <span class='share'>e</span> f</p><div class='ad-box'><p>g</p></div><div class='ad-free'>h</div>"
    assert html.main_text(page, frozenset()) == "a\n\nc\n\nd f\n\nh"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p data-x=it's>Hello don't go</p>", "Hello don't go"),
        ("<p title='a > b' id=x>one</p>two", "one\n\ntwo"),
        ("<p data-class='sidebar'>kept</p><p hidden>also kept</p>", "kept\n\nalso kept"),
        ("<form action=/all><article>in a form</article></form>", "in a form"),
        ("</div></p>a<li>b<li>c</ul>d", "a\n\nb\n\ncd"),
        ("a < b & c <", "a < b & c <"),
        ("<p title=\"never closed>x", "x"),
        ("<article></article><p>outside</p>", "outside"),
    ],
)
def test_odd_markup(page, text):
    assert html.main_text(page, frozenset()) == text


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "x", "<b><p>x</p>" * 50_000, "<li><div>x" * 30_000, "</i>" * 50_000 + "<i>" * 50_000 + "x", "<p a='" * 30_000])
def test_deep_and_unbalanced_pages_take_linear_time(page):
    assert html.main_text(page, frozenset()).count("x") == page.count("x")


def test_an_article_that_a_host_repeats_is_kept(spark):
    """Nine copies of a wire story with different stamps below it, and a page with its own story."""
    wire = "<article><h1>Wire</h1><p>The same story.</p></article>"
    rows = [(i, f"https://n.example/{i}", f"{wire}<p>stamp {i}</p>") for i in range(9)]
    rows.append((9, "https://n.example/9", "<article><h1>Own</h1><p>Another story.</p></article><p>stamp z</p>"))
    out = texts(spark, rows)
    assert all(out[i] == "Wire\n\nThe same story." for i in range(9)) and out[9] == "Own\n\nAnother story."


@pytest.mark.parametrize("pages", [1, 2, 3, 4, 12])
def test_hosts_of_any_number_of_pages(spark, pages):
    """Articles stay on small hosts, the strip goes as soon as three pages agree on it."""
    rows = [(i, f"https://s.example/{i}", f"<div class=strip>Welcome</div><div class=text><h1>T{i}</h1><p>Words of page {i}</p></div>") for i in range(pages)]
    strip = "" if pages > 2 else "Welcome\n\n"
    assert texts(spark, rows) == {i: f"{strip}T{i}\n\nWords of page {i}" for i in range(pages)}


def test_pages_without_other_text_keep_a_named_branch_if_it_differs(spark):
    rows = [(i, f"https://w.example/{i}", f"<div class='widget'><p>Story {i}</p></div>") for i in range(6)]
    rows += [(10 + i, f"https://c.example/{i}", f"<div class='cookie-notice'><p>We use cookies</p></div><!-- {i} -->") for i in range(6)]
    out = texts(spark, rows)
    assert all(out[i] == f"Story {i}" and out[10 + i] == "" for i in range(6))


def test_what_a_branch_shows_counts_beside_what_it_says(spark):
    """A constant label stays where the sequence of styles below it differs from page to page."""
    rows = [(i, f"https://l.example/{i}", f"<div class=a>Label<ul>{'<li>x' * 2}</ul></div><div class=b>Parts{''.join(f'<h{1 + (i >> k) % 2}>{i}-{k}</h{1 + (i >> k) % 2}>' for k in range(4))}</div>") for i in range(16)]
    out = texts(spark, rows)
    assert all("Label" not in t and "Parts" in t for t in out.values())


def test_tree_agrees_with_a_plain_one(spark):
    """The importance of each node, by dictionaries."""
    rows = []
    for i in range(40):
        notes = "".join(f"<p>n{i % 3}</p>" for _ in range(i % 4))
        rows.append((i, f"https://h{i % 3}.example/{i}", f"<div class='menu'>m{i % 5}</div><div class=x>Top{notes}</div><section>{'same' if i % 7 else i}</section><article><p>a{i % 11}</p></article>"))
    rows += rows[:5]
    found = {(r.host, r.node): (r.n, r.importance) for r in html.node_importance(html.style_counts(spark.createDataFrame(rows, SCHEMA))).collect()}
    tree: dict = {}
    for _, url, page in rows:
        story, nodes = html.page_nodes(page)
        for node, (marked, said, shape) in nodes.items():
            kept = tree.setdefault((url.split("/")[2], node), (marked, set(), set()))
            kept[1].add((story, said))
            if shape is not None:
                kept[2].add((story, shape))

    def entropy(pairs):
        values = [value for _, value in pairs]
        n = len(values)
        return 1.0 if n == 1 else -sum(values.count(v) / n * math.log(values.count(v) / n) for v in set(values)) / math.log(n)

    expected = []
    for marked, said, shapes in tree.values():
        n = max(len(said), len(shapes))
        shown = (1 - 0.9 ** len({v for _, v in shapes})) * entropy(shapes) if len(shapes) > 1 else 0.0
        expected.append((n, round((n * max(entropy(said), shown) + 4 * (0.0 if marked else 0.5)) / (n + 4), 9)))
    assert sorted((n, round(v, 9)) for n, v in found.values()) == sorted(expected)
    assert any(v < 0.3 for _, v in expected) and any(v > 0.3 for _, v in expected)


def test_empty_tables_and_nulls(spark):
    assert html.extracted(spark.createDataFrame([], SCHEMA)).count() == 0
    assert texts(spark, [(1, None, None), (2, None, ""), (3, "x", " ")]) == {1: "", 2: "", 3: ""}
