"""Main text through template deduction."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ionweave.llm import htmlx

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p>";</script></head><body class="page"><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy</div><{box}><h1>Head {n}</h1><p>First&nbsp;&amp; <b>bold</b>   text {n}.<p>Second<br>line<!-- no --><div class="comments"><p>Nice</p></div><form><p>Mail</p></form></{box}>
<aside>Other</aside><footer>&copy; x</footer></body></html>"""


@pytest.mark.parametrize("box", ["article", 'div class="story"'])
def test_main_text(spark, box):
    page = PAGE.replace("</{box}>", "</" + box.split()[0] + ">").replace("<{box}>", f"<{box}>")
    more = " ".join(["word"] * 60)
    rows = [(i, f"http://h.example/{i}", page.format(n=f"{i} {more}", box=box)) for i in range(6)] + [(10, None, None), (11, "::bad", ""), (12, "http://one.example/", "<p>Only <i>this</i>"), (12, "http://one.example/", "<p>Only <i>this</i>"), (13, "http://h.example/x", "<ul><li>Another<li>layout</ul>")]
    got = [(r.page_id, r.text) for r in htmlx.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))).collect()]
    assert len(got) == len(rows)
    texts = dict(got)
    assert texts[3] == f"Head 3 {more}\nFirst & bold text 3 {more}.\nSecond line"
    assert texts[10] == texts[11] == "" and texts[12] == "Only this"
    assert texts[13] == "Another\nlayout"


def said(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(n))


def texts_of(spark, pages, url="http://plain.example/"):
    df = spark.createDataFrame([(i, f"{url}{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in htmlx.main_text(df).collect()}


def test_plain_boxes_without_telling_names(spark):
    """No article, no main, no class that says what it is: menu, advert, notice, share line and footer are found by their classes of tokens."""
    rng, pages, want = random.Random(1), [], []
    for i in range(12):
        title, lead, body = said(rng, 5), said(rng, 20), [said(rng, rng.randint(20, 40)) for _ in range(rng.randint(2, 6))]
        pages.append(
            f"<html><body class='x{i}'><div><a href=/a>{said(rng, 2)}</a> <a href=/b>{said(rng, 2)}</a></div><div class=k1>{said(rng, 8)}</div>"
            f"<div class=k2><h1>{title}</h1><p>{lead}</p><div>We keep small files on your machine to make this place better</div><div class=k3>{''.join(f'<p>{p}</p>' for p in body)}</div>"
            f"<div><span>Tell your friends</span></div></div><div>Made by people {said(rng, 3)}</div></body></html>"
        )
        want.append("\n".join([title, lead, *body]))
    got = texts_of(spark, pages)
    assert [got[i] for i in range(12)] == want
    # without the host's template the fixed lines inside the article can't be told
    assert all("We keep small files" in htmlx.extract(p, None) for p in pages)


def test_nothing_of_an_article_is_dropped_for_its_names(spark):
    page = "<body><article class='post category-social has-comments'><h1>T {n}</h1><section class='share-price'><p>Price {n}</p></section><div class='search-results-study'>Study {n}</div><div class='comments'><p>Nice {n}</p></div></article></body>"
    got = texts_of(spark, [page.format(n=i) for i in range(5)])
    assert got[2] == "T 2\nPrice 2\nStudy 2"
    wrapped = "<body><div class='content sidebar'><h1>T {n}</h1><p>Long text of {n}</p></div></body>"
    assert texts_of(spark, [wrapped.format(n=i) for i in range(5)])[2] == "T 2\nLong text of 2"
    assert htmlx.extract("<form><h1>T</h1><p>All in a form</p></form>", None) == "T\nAll in a form"


def test_copies_of_one_page_keep_their_text(spark):
    page = "<body><div><h1>Same title</h1><p>The same text on each page</p></div></body>"
    assert set(texts_of(spark, [page] * 5).values()) == {"Same title\nThe same text on each page"}


def test_headings_of_the_body_beside_the_text(spark):
    rng = random.Random(2)
    parts = [(said(rng, 4), said(rng, 10), said(rng, 60)) for _ in range(6)]
    got = texts_of(spark, [f"<body><div>{said(rng, 6)}</div><h1>{t}</h1><p>{lead}</p><div class=b><div>{x}</div></div><div>{said(rng, 5)}</div></body>" for t, lead, x in parts])
    assert [got[i] for i in range(6)] == ["\n".join(p) for p in parts]


@pytest.mark.parametrize("page", ['<a href="x ' * 95_000, "<a b='>' " * 110_000 + "'", "<b>" * 80_000 + "<div></div>" * 80_000, "<!x " * 250_000, "<p><table>" + "<b>" * 80_000 + "<div></div>" * 50_000, "<li>" * 200_000, "x<" * 400_000])
def test_malformed_pages_take_linear_time(page):
    began = time.process_time()
    htmlx.extract(page, None)
    assert time.process_time() - began < 10


def test_unclosed_quotes_and_odd_markup():
    assert htmlx.extract('<p data-x="unclosed>B', None) == "B"
    assert htmlx.extract("<p>a <b>b</b><title-box>c</title-box> 1 < 2 &amp; 3&nbsp;x", None) == "a b\nc\n1 < 2 & 3 x"
    assert htmlx.extract("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>x<td>y<tr><td>z</table>", None) == "a\nb\nc\nd\nx\ny\nz"


def test_a_very_long_page():
    text = said(random.Random(3), 300_000)
    assert htmlx.extract(f"<article><p>{text}</p></article>", None) == text


def test_deduction_equals_brute_force(spark):
    """Occurrence vectors as tuples over a host's pages, classes by comparing them, against the hashed ones of Spark."""
    rng, rows = random.Random(4), []
    for i in range(40):
        items = "".join(f"<li><b>Item</b> {said(rng, 1)}</li>" for _ in range(rng.randint(1, 4)))
        side = "<div class=s>Fixed words here</div>" if i % 3 else ""
        rows.append((i, f"http://h{i % 3}.example/", f"<body><h1>{said(rng, 2)}</h1>{side}<ul>{items}</ul><p>By {said(rng, 1)}</p></body>"))
    rows += [(40, None, None), (41, "http://h0.example/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = defaultdict(set)
    keyed = df.select(F.col("page_id").alias("key"), htmlx.host_of("url").alias("host"), "html")
    for r in htmlx.classes(htmlx.occurrences(keyed)).where("valid").collect():
        got[r.host, r.pages, r.v1, r.v2].add(r.token)
    want = []
    for host in {"h0.example", "h1.example", "h2.example"}:
        pages = [htmlx.tokens(h or "") for _, u, h in rows if u == f"http://{host}/"]
        by_vector = defaultdict(set)
        for token in {t for p in pages for t in p}:
            by_vector[tuple(p[token][3] if token in p else 0 for p in pages)].add(token)
        filled = sum(1 for p in pages if p)
        kinds = {t: r[1] for p in pages for t, r in p.items()}
        want += [(host, frozenset(c)) for v, c in by_vector.items() if 2 * sum(x > 0 for x in v) >= filled and len(c) >= 2 and not all(kinds[t] != "element" for t in c)]
    assert sorted((k[0], sorted(c)) for k, c in got.items()) == sorted((h, sorted(c)) for h, c in want)
    assert len(want) >= 6


FAMILIES = {
    # what an article says with the same words on every page stays where anything beside it varies
    "definitions": ("<article><h1>{t}</h1><dl><dt>Prep</dt><dd>{a}</dd><dt>Salt</dt><dd>{b}</dd></dl></article>", "{t}\nPrep\n{a}\nSalt\n{b}"),
    "table": ("<article><h1>{t}</h1><table><caption>Sums</caption><tr><th>Part</th><th>Total</th></tr><tr><td>Salt</td><td>{a}</td></tr></table></article>", "{t}\nSums\nPart\nTotal\nSalt\n{a}"),
    "items": ("<div class=s><h1>{t}</h1><p>{a}</p><ul><li>First of all</li><li>{b}</li><li>Last of all</li></ul></div>", "{t}\n{a}\nFirst of all\n{b}\nLast of all"),
    "figure": ("<article><h1>{t}</h1><p>{a}</p><figure><p>{b}</p><figcaption>Our picture</figcaption></figure></article>", "{t}\n{a}\n{b}\nOur picture"),
    "subheads": ("<article><h1>{t}</h1><h2>Background</h2><p>{a}</p><h2>Methods</h2><p>{b}</p></article>", "{t}\nBackground\n{a}\nMethods\n{b}"),
    # what is not of the article
    "title in a header": ("<header><div>Site</div><h1>{t}</h1></header><article><p>{a}</p><p>{b}</p></article>", "{t}\n{a}\n{b}"),
    "site in a header": ("<header><h1>The Site</h1></header><article><h2>{t}</h2><p>{a}</p></article>", "{t}\n{a}"),
    "named in two parts": ("<article><h1>{t}</h1><p>{a}</p><div class='ad-slot'>{n}</div><div class='comment-thread'><p>{b}</p></div><div id='advert-box'>{n}</div></article>", "{t}\n{a}"),
    "names that only look so": ("<article class='has-comments'><h1>{t}</h1><div class='ad-hoc'><p>{a}</p></div><section class='comment-culture'><p>{b}</p></section></article>", "{t}\n{a}\n{b}"),
    "fixed boxes": ("<article><h1>{t}</h1><div>We keep small files here</div><p>{a}</p><ul><li>Send</li><li>Print</li></ul><p>{b}</p></article>", "{t}\n{a}\n{b}"),
    "plain boxes": ("<div>{n}</div><div class=k><h1>{t}</h1><p>{a}</p><div><p>{b}</p></div></div><div>By {n}</div>", "{t}\n{a}\n{b}"),
    "several slots": ("<div><p>Menu of ours</p></div><h1>{t}</h1><div class=x><p>{a}</p></div><div class=y><p>{b}</p></div>", "{t}\n{a}\n{b}"),
}


@pytest.mark.parametrize("n", [2, 3, 50])
def test_families_of_pages(spark, n):
    """Twelve families, each on hosts of 2, 3 and 50 pages, with the wanted text written out."""
    rng, rows, want = random.Random(n), [], {}
    for f, (page, text) in FAMILIES.items():
        for i in range(n):
            values = {"t": said(rng, 6), "a": said(rng, 30), "b": said(rng, 25), "n": said(rng, 3)}
            key = len(rows)
            rows.append((key, f"http://{f.replace(' ', '-')}.example/{i}", f"<html><body>{page.format(**values)}</body></html>"))
            want[key] = (f, text.format(**values))
    got = {r.page_id: r.text for r in htmlx.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {want[k][0] for k in want if got[k] != want[k][1]} == set()


def test_a_third_page_does_not_change_the_first_two(spark):
    rng = random.Random(7)
    for f, (page, _) in FAMILIES.items():
        pages = [f"<html><body>{page.format(t=said(rng, 6), a=said(rng, 30), b=said(rng, 25), n=said(rng, 3))}</body></html>" for _ in range(3)]
        two, three = texts_of(spark, pages[:2]), texts_of(spark, pages)
        assert all(two[i] == three[i] for i in range(2)), f
