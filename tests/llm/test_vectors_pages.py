"""Vector search against brute force, and page text on pages of many kinds."""

import collections

import numpy as np
import pytest

from panelwright.llm import onebit_search, page_text


def test_search(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((700, 24)).astype(np.float32)
    base[100:160] = base[5]  # a hot vector
    rows = [(int(i), v.tolist()) for i, v in enumerate(base)]
    more = [(40, rows[40][1]), (41, rows[40][1]), (40, rows[7][1]), (3000, [1.0, 2.0]), (3001, [2.0, 1.0])]
    good = rows + more
    rows = good + [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] + [1.0] * 23), (2080, [float("inf")] * 24), (None, [1.0] * 24), (3020, [])]
    monkeypatch.setattr(onebit_search, "INDEX_BLOCK", 90)
    monkeypatch.setattr(onebit_search, "QUERY_BLOCK", 10)
    df = spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], "vec_id long, embedding array<float>, label int, score double").repartition(4)
    rows = onebit_search.nearest(df).collect()
    found = total = 0
    # every row counts, also as a query: rows that repeat an id have lists of their own
    for q in {i for i, _ in good}:
        lists = collections.Counter((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
        want = collections.Counter()
        for own, (i, v) in enumerate(good):
            if i == q and q % 20 == 0:
                x = np.array(v, float)
                scored = sorted((-(np.array(c, float) * x).sum(), j) for k, (j, c) in enumerate(good) if k != own and len(c) == len(v))[:20]
                want.update((k + 1, j, -s) for k, (s, j) in enumerate(scored))
        assert sorted(k for k, _, _ in lists.elements()) == sorted(k for k, _, _ in want.elements())
        total += sum(want.values())
        found += sum((collections.Counter(e[1:] for e in lists.elements()) & collections.Counter(e[1:] for e in want.elements())).values())
    assert found / total >= 0.99
    assert onebit_search.nearest(df.limit(0)).collect() == []


def test_bounds_hold_and_spare_work(spark):
    rng = np.random.default_rng(7)
    v = rng.standard_normal((3000, 64)) + 3 * rng.standard_normal((12, 64))[rng.integers(0, 12, 3000)]
    turned = (v - v.mean(0)) @ onebit_search.rotation(64).T
    norm = np.sqrt((turned ** 2).sum(1))
    aligned = np.abs(turned).sum(1) / norm / 8
    factors = np.stack([norm, aligned, v @ v.mean(0)], axis=1)
    ids = np.arange(3000).astype("<i8")
    block = onebit_search._Block(64, ids.tobytes(), ids.tobytes(), np.packbits(turned >= 0, axis=1).tobytes(), factors.tobytes(), v.tobytes(), "<f8")
    search = onebit_search._Search(64, ids[::20].tobytes(), ids[::20].tobytes(), v[::20].copy().tobytes(), "<f8", 20, v.mean(0))
    guess = sum(table[code] for table, code in zip(search.tables(3), block.signs))
    assert np.allclose(guess, np.where(turned >= 0, 1, -1) @ search.turned[3], atol=1e-3)
    search.add(block)
    same = 0
    for k, q in enumerate(range(0, 3000, 20)):
        s = (v * v[q]).sum(1)
        s[q] = -np.inf
        same += len(set(search.best[k][1]) & set(np.lexsort((np.arange(3000), -s))[:20]))
    assert same >= 0.98 * 150 * 20
    assert search.compared < 0.3 * 150 * 3000


PAGES = {
    1: ("<html><head><title>T</title><script>if (a<b) x('</p>')</script></head><body><nav><a href=/>Home</a></nav><article><h1>Head &amp; line</h1>"
        "<p>One <b>bo</b>ld,\n two.<p>Three&nbsp;four</article><footer>foot</footer></body></html>", "Head & line One bold, two. Three four"),
    2: (None, ""),
    3: ("", ""),
    4: ("<article><p>Never closed <i>at all", "Never closed at all"),
    5: ("<body><header class='site-header'>Site name</header><div class='cookie-notice'>We use cookies</div><div id=content><h2>Title</h2>"
        "<p>Body text, with words.</p><div class=\"ad\">Buy now</div><form><input><label>Name</label></form><ul><li>a<li>b</ul></div>"
        "<aside class=sidebar>Related</aside><section id=comments><p>Reader: nice!</p></section></body>", "Title Body text, with words. a b"),
    6: ("<article><p>a<br>b</p><!-- hidden > --><style>p{}</style><table><tr><td>c<td>d</table></article>", "a b c d"),
    7: ("<article><p>2 < 3 &lt; 4 &#233; <a href='x>y'>link</a></p></article>", "2 < 3 < 4 é link"),
    8: ("<nav>only menus</nav>", ""),
}


@pytest.fixture(scope="module")
def pages(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html")
    odd = spark.createDataFrame([(i + 10_000_000, "u", h) for i, (h, _) in PAGES.items()] + [(10_000_001, "u", PAGES[1][0])], "page_id long, url string, html string")
    from pyspark.sql import functions as F
    return given.unionByName(odd).withColumns({"text": F.lit("clash"), "n_chars": F.lit("clash")})


def test_pages(spark, pages):
    rows = page_text.extract(pages).collect()
    assert len(rows) == pages.count() and rows[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert all(r.n_chars == len(r.text) for r in rows)
    got = {r.page_id - 10_000_000: r.text for r in rows if r.page_id >= 10_000_000}
    assert got == {i: t for i, (_, t) in PAGES.items()}
    assert sum(bool(r.text) for r in rows if r.page_id < 10_000_000) == sum(r.page_id < 10_000_000 for r in rows)
    assert page_text.extract(pages.limit(0)).collect() == []


def test_choice_has_no_contradiction():
    page = page_text.Page("<div><p>good text</p><div><p>bad</p><p>fine</p></div></div>")
    keep = page_text.decode(page, np.array([0, -0.1, 2.0, -9.0, -3.0, 1.0]))
    assert keep.tolist() == [True, True, True, False, False, False]


def kept_by_signs(source):
    page = page_text.Page(source)
    away = page_text.features(page)[:, page_text.NAMES.index("away_up")]
    return page_text.main_text(page, page_text.decode(page, np.where(away > 0, -1.0, 1.0)))


@pytest.mark.parametrize(("source", "want"), [
    ('<p>Text <a class="related-link">x</a> and the rest</p>', "Text and the rest"),
    ('<p>Text <a class="share" href=1>x <a href=2>link</a> and the rest</p>', "Text link and the rest"),
    ("<p>Text <span class=ad>buy <span>now</span> cheap</span> and the rest</p>", "Text and the rest"),
    ("<p>Text <b class=promo>buy <a href=1>now <b>it</b></a> cheap</b> and the rest</p>", "Text and the rest"),
    ("<div>Text <span class=ad><p>buy <span>one<p>two</span> three</p></span> and the rest</div>", "Text and the rest"),
    ("<div>Text <b class=ad><table><tr><td><b>buy</td></tr></table></b> and the rest</div>", "Text and the rest"),
    ("<p>Text <span>a <a class=tags>x</a> b</span> c</a> and the rest</p>", "Text a b c and the rest"),
])
def test_end_tags_close_their_own_start(source, want):
    assert kept_by_signs(source) == want


def test_long_tags_keep_their_attributes():
    svg = "<svg class='nav'>" * 5000
    for long in (f'style="background: url(data:{svg})" class="sidebar"', f"data-x='{svg.replace(chr(39), chr(34))}' id=sidebar", f'class=sidebar data-y="{svg}"'):
        assert kept_by_signs(f"<p>Text</p><div {long}>away</div><p>and the rest</p>") == "Text and the rest"
    assert kept_by_signs(f'<p>Text</p><div data-y="{svg}">stays</div>') == "Text stays"
    assert kept_by_signs(f'<p title="x>Text</p>{svg}<div class=ad title="it">away</div><p>it\'s <b x=\'y>\'>bold</b>').startswith("Text")


def test_ends_of_tags_are_known():
    rng = np.random.default_rng(9)
    for _ in range(3000):
        s = "".join(rng.choice(list("<<ab >>\"'/="), 30))
        ends = page_text._Ends(s)
        for lt in range(len(s) - 1):
            if s[lt] == "<" and s[lt + 1] in "ab":
                assert ends.after(lt) == bool(page_text._TAG.match(s, lt))


def test_hard_markup_takes_linear_time():
    for text in ("<" * 200_000, "<a b=\"" * 30_000, "<!--" * 50_000, "<script>" * 30_000, "<div>" * 20_000):
        page = page_text.Page(text)
        page_text.decode(page, np.ones(len(page.tag)))
