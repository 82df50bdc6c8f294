"""HTML extraction: the template against a plain deduction, and the text of pages with and without an article."""

import html
import json
from collections import Counter, defaultdict

import pytest

from pagestrata.llm.html_extract import LEFT_OUT_NAMES, Reader, _attach, extract_main_text, host_templates, slots


def made(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(spark, rows):
    return {r.page_id: r.text for r in extract_main_text(made(spark, rows).repartition(3)).collect()}


def item(k, i):
    return f"<li class='it'><b>name {k} {i}</b><i>price {k * 100 + i}</i></li>"


def listing(k):
    """A page of a shop: a skeleton, k items of two fields each, and a block that only some pages have."""
    extra = f"<section class='more'><p>extra {k}</p></section>" if k % 3 == 0 else ""
    return f"<html><body><div class='top'>Shop</div><ul class='list'>{''.join(item(k, i) for i in range(k))}</ul>{extra}<div class='end'>Seen {k}</div></body></html>"


def plain_template(pages):
    """Classes in order with their parent class and gap, by plain loops over all distinct pages."""
    reader = Reader()
    seqs = [[t for t in reader.tokens(p).tolist() if t] for p in sorted(set(pages))]
    counts = [Counter(s) for s in seqs]
    groups = defaultdict(set)
    for t in set().union(*counts):
        v = tuple(c[t] for c in counts)
        if sum(map(bool, v)) >= max(2, len(seqs) / 2):
            groups[v].add(t)
    classes = {}
    for v, tokens in groups.items():
        if len(tokens) < 2:
            continue
        orders = set()
        for s in seqs:
            own = [t for t in s if t in tokens]
            orders |= {tuple(own[i : i + len(tokens)]) for i in range(0, len(own), len(tokens))}
        if len(orders) == 1 and set(o := orders.pop()) == tokens:
            classes[v] = o

    def gap(c, p):
        found = set()
        for s in seqs:
            at, last, c_open = None, len(p) - 1, 0
            for t in s:
                if t in p:
                    if c_open:
                        return None
                    at = p.index(t) if p.index(t) < last else None
                if t in c:
                    found.add(at)
                    c_open = 0 if t == c[-1] else 1
        return found.pop() if len(found) == 1 and None not in found else None

    above = {c: {p: g for p in classes.values() if p != c and (g := gap(c, p)) is not None} for c in classes.values()}
    out = {}
    for c, holders in above.items():
        parent = max(holders, key=lambda p: len(above[p]), default=None)
        out[c] = (parent, holders.get(parent))
    return out


@pytest.mark.parametrize("pages", [[listing(k) for k in (1, 2, 3, 5, 6)], [listing(k) for k in (2, 2, 4)], [listing(3)], ["<p>a</p>", "<div>b</div>"], ["", ""]])
def test_template_is_that_of_a_plain_deduction(spark, pages):
    rows = [(i, f"http://h.x/{i}", p) for i, p in enumerate(pages)] + [(90, "http://other.x/", "<p>alone</p>")]
    base = made(spark, rows).selectExpr("regexp_extract(url, '//([^/]*)', 1) AS __host", "html").repartition(3)
    got = {r[0]: json.loads(r[1]) for r in host_templates(base).collect()}
    assert not got.get("other.x")
    own = got.get("h.x", [])
    have = {tuple(c["order"]): (None if c["parent"] is None else tuple(own[c["parent"]]["order"]), c["gap"]) for c in own}
    assert have == plain_template(pages)


def test_nested_classes_and_their_slots(spark):
    pages = [listing(k) for k in (1, 2, 4, 5)]
    base = made(spark, [(i, "http://h.x/", p) for i, p in enumerate(pages)]).selectExpr("'h.x' AS __host", "html")
    template = json.loads(host_templates(base).first()[1])
    assert any(c["parent"] is not None for c in template)  # the items lie in a gap of the skeleton
    reader = Reader()
    events, *_ = reader.read(pages[1])
    told = [(e[3], s) for e, s in zip(events, slots(events, reader, template), strict=True) if e[0] == 2]
    names = [s for t, s in told if t.startswith("name")]
    assert len(names) == 2 and len(set(names)) == 1 and names[0] not in [s for t, s in told if t.startswith("price")]
    assert [s for t, s in told if t == "Shop"] == [None]  # a template token


def test_crossing_order_and_small_classes_are_not_valid(spark):
    pages = ["<p class='a'>1</p><p class='b'>2</p>", "<p class='b'>3</p><p class='a'>4</p>"]
    base = made(spark, [(i, "", p) for i, p in enumerate(pages)]).selectExpr("'h' AS __host", "html")
    assert [json.loads(r[1]) for r in host_templates(base).collect()] == [[]]
    # a text that stands once on each page, in one of several items, ties the items to the skeleton's class: the smaller class goes
    tied = [listing(k).replace(f"price {k * 100}<", "price<") for k in (2, 3, 4)]
    base = made(spark, [(i, "", p) for i, p in enumerate(tied)]).selectExpr("'h' AS __host", "html")
    assert [len(json.loads(r[1])) for r in host_templates(base).collect()] == [1]


def test_joined_templates_give_the_same(spark, monkeypatch):
    from pagestrata.llm import html_extract

    rows = [(i, f"http://h{i % 2}.x/{i}", listing(i)) for i in range(8)]
    want = texts(spark, rows)
    monkeypatch.setattr(html_extract, "SMALL_BYTES", 0)
    monkeypatch.setattr(html_extract, "HOT_PAGES", 2)
    assert texts(spark, rows) == want
    assert _attach is html_extract._attach


def test_names_alone_decide_nothing_inside_an_article(spark):
    page = "<article><h2 id='discussion'>Discussion</h2><div class='alert'>Mind this.</div><p id='related'>Related work.</p><p class='comments'>A remark.</p><div class='comments section'>Kept.</div><div class='comments'>no</div><aside>no</aside><div role='note'>no</div></article>"
    assert texts(spark, [(1, "http://a.b/", page)]) == {1: "Discussion\nMind this.\nRelated work.\nA remark.\nKept."}
    assert all(n == n.lower() for n in LEFT_OUT_NAMES)


def test_pages_without_article(spark):
    """Brute force by hand: what every content of the host has once at one path is template, all else is text, in any container."""
    page = lambda a, b: f"<body><nav><a>Home</a></nav><div class='site'>My site</div><div class='a'><p>{a}</p></div><div class='ab'><p>{b}</p></div><div class='ad'>Buy</div><footer>foot</footer></body>"
    rows = [(i, f"http://a.b/{i}", page(*x)) for i, x in enumerate([("One.", "Two."), ("Three.", "Four."), ("One.", "Five.")])]
    assert texts(spark, rows) == {0: "One.\nTwo.", 1: "Three.\nFour.", 2: "One.\nFive."}
    main = "<body><div>Top</div><main><p>In.</p></main><div>End</div></body>"
    assert texts(spark, [(1, "http://a.b/", main)]) == {1: "In."}


def test_odd_pages(spark):
    """Null and empty html, null url, repeated rows, broken markup, a very long page, clashing columns, an empty table."""
    long = "<article>" + "".join(f"<p>w{i} &amp; {'x' * (i % 50)}</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, None), (2, None, ""), (3, "no url", "<article>a<b"), (4, "http://a.b/", "<article><p>x<p>y</article>"), (4, "http://a.b/", "<article><p>x<p>y</article>"), (5, "http://a.b/2", long), (None, "http://a.b/3", "<p a='>'>&eacute;\n é</p>"), (6, "http://a.b/4", "<a href='unclosed><p>t")]
    got = extract_main_text(made(spark, rows).selectExpr("*", "'old' AS text", "7 AS n_chars", "'h' AS host", "1 AS template", "2 AS classes", "3 AS _salt").repartition(3))
    found = {r.page_id: r for r in got.collect()}
    assert got.count() == len(rows) and {r.host for r in found.values()} == {"h"}
    assert [found[i].text for i in (1, 2, 3, 4, None)] == ["", "", "a<b", "x\ny", html.unescape("&eacute; é")]
    assert found[5].text == "\n".join(f"w{i} & {'x' * (i % 50)}".strip() for i in range(20_000)) and all(r.n_chars == len(r.text) for r in found.values())
    assert extract_main_text(made(spark, [])).count() == 0
