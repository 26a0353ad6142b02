import html
import re

import numpy as np
import pytest

from studylake.llm import html_extraction as extraction
from studylake.llm.queries import QUERIES

KIND = "page_id long, url string, html string, n_chars string, text int, tree string"
PROSE = "In the second year the harvest failed again, and the people of the valley began to leave for the coast."


def main_text(page):
    return extraction.main_texts([page], extraction.main_text_tree())[0]


def brute(page):
    """The article of a driver's page: its headings and paragraphs, by pattern."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", body.group(1) if body else "")
    plain = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n\n".join(b for b in plain if b)


def test_query_equals_brute_force(spark, small, table):
    df = QUERIES["op11_html_extraction"](spark, small)
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    pages = {r["page_id"]: r for r in table("pages")}
    rows = df.collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        page = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], brute(page["html"]), len(brute(page["html"])))


def test_the_tree_learns_its_table():
    x, y = extraction.labelled()
    tree = extraction.main_text_tree()
    assert len(y) > 150 and (tree(x) == (y == 1)).mean() > 0.97


def test_the_tree_on_pages_it_has_not_seen():
    """Every page left out once."""
    pages = extraction.PAGES
    right = size = 0
    for k in range(len(pages)):
        tree = extraction.grow(*extraction.labelled(pages[:k] + pages[k + 1:]))
        x, y = extraction.labelled(pages[k:k + 1])
        right, size = right + int((tree(x) == (y == 1)).sum()), size + len(y)
    assert right / size > 0.9


def test_a_split_equals_all_splits():
    draw = np.random.default_rng(3)
    x, y = draw.integers(0, 9, (60, 3)).astype(float), draw.integers(0, 2, 60)
    gini = lambda part: 2 * part.sum() * (len(part) - part.sum()) / len(part)
    best = min(
        gini(y[x[:, f] <= v]) + gini(y[x[:, f] > v]) for f in range(3) for v in np.unique(x[:, f])[:-1]
        if min((x[:, f] <= v).sum(), (x[:, f] > v).sum()) >= extraction.MIN_LEAF)
    tree = extraction.grow(x, y)
    low = x[:, tree.feature[0]] <= tree.limit[0]
    assert gini(y[low]) + gini(y[~low]) == pytest.approx(best)


PAGES = [
    # script and style with markup in strings, comments, references, a line break inside a paragraph
    ('<html><head><title>T</title><script>var a="</p><p>no</p>";</script><style>p>a{}</style></head><body>'
     '<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> --><article><h1>Caf&eacute; &amp; bar</h1>'
     f'<p>One<br>two&nbsp;three &#x41;&#66;\n\t {PROSE}</p><p>x &lt;b&gt; <i>it</i>alic</p></article></body></html>',
     f"Café & bar\n\nOne two three AB {PROSE}\n\nx <b> italic"),
    # header, cookie notice, advert, form, sidebar and comments of whole sentences
    (f'<body><header><div><p>{PROSE}</p></div></header><div class="cookie-banner"><p>{PROSE}</p></div><main>'
     f'<article><header><h1>Leaving</h1></header><p>{PROSE}</p><div class="advert"><p>{PROSE}</p></div><p>So.</p>'
     f'<form><p>{PROSE}</p></form></article><section id="comments"><article><p>{PROSE}</p></article></section></main>'
     f'<aside><p>{PROSE}</p></aside><footer><p>{PROSE}</p></footer>', f"Leaving\n\n{PROSE}\n\nSo."),
    # classes in place of elements; a class that only tells of a sidebar
    (f'<body class="has-sidebar no-ads"><div id="top-menu"><a href="/">Home</a></div><div class="main-content with-sidebar"><h2>Two</h2>'
     f'<p>{PROSE}</p><p class="byline">By nobody</p><ul><li>a boat</li></ul></div><div class="sidebar"><p>{PROSE}</p></div>',
     f"Two\n\n{PROSE}\n\nBy nobody\n\na boat"),
    # a page within a form
    (f'<body><form id="aspnet"><p>Search all pages</p><article><p>{PROSE}</p></article></form>', PROSE),
    # nothing names the article
    (f'<body><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul><p>{PROSE} {PROSE}</p><p>{PROSE}</p>'
     f'<p><a href="/x">Read how it began</a></p>', f"{PROSE} {PROSE}\n\n{PROSE}"),
    # never closed
    (f"<article><p>{PROSE}<p>Second<b>ly", f"{PROSE}\n\nSecondly"),
    (f"<article><p>{PROSE}<!-- open <p>no", PROSE),
    (f"<article><p>{PROSE}</p><script>no", PROSE),
    ("", ""), ("   \n", ""), ("<", ""), ("<article></article>", ""), ("<nav>only a menu</nav>", ""),
    ("<article><p>a < b and c > d</p>", "a < b and c > d"),
    ('<article><p title="a > b" class=\'x\'>Quoted.</p>', "Quoted."),
]


@pytest.mark.parametrize("page, wanted", PAGES)
def test_pages(page, wanted):
    assert main_text(page) == wanted


def test_odd_rows(spark):
    rows = [(k, f"u{k}", page, "c", 4, "t") for k, (page, _) in enumerate(PAGES)]
    rows += [rows[0], (None, None, None, None, None, None), (90, "u", "<p>" * 5000 + "</div>" * 5000, "", 0, ""),
             (91, "u", "<article>" + f"<p>{PROSE}</p>" * 20_000, "", 0, "")]
    df = extraction.extract_main_text(spark.createDataFrame(rows, KIND))
    assert df.columns == ["page_id", "url", "tree", "text", "n_chars"]
    found = {r["page_id"]: r for r in df.collect()}
    assert all(found[k]["text"] == wanted and found[k]["n_chars"] == len(wanted) for k, (_, wanted) in enumerate(PAGES))
    assert found[None]["text"] == found[90]["text"] == ""
    assert found[91]["text"] == "\n\n".join([PROSE] * 20_000)
    assert df.count() == len(rows)
    assert extraction.extract_main_text(spark.createDataFrame([], KIND)).collect() == []
