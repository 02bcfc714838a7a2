import html
import re

from cardsentry.llm import html_text as H
from cardsentry.llm.common import read

PAGE = """<!DOCTYPE html><html><head><title>no</title></head><body><header><h1>Site</h1><a href=/>Home</a></header>
<div id="cookie-notice">We use cookies, at length, and this text is really long, longer than most of what follows.</div>
<div class=wrap><div class="content"><h1>Title  here</h1><p>First &amp; <b>bold</b>,
 with a <a href=x>link</a>.<p>An unclosed one.<div>Second block<br>of words.<ul><li>One<li>Two</ul></div><p>Short.</p>
<section><h2>Sub</h2><p>Another paragraph in a section with enough text in it to count for something.</p></section>
<script>var t="</p><p>no</p>";</script><!-- no --><div class="adBox ad">Buy, buy, buy, buy, buy, buy, buy, buy.</div>
<div class="comments"><p>User: a very long comment that goes on and on and on and on, longer than the article is.</p></div>
</div><aside><p>side</p></aside></div><form><p>Subscribe</p></form><footer>&copy; 2020</footer></body></html>"""


def test_article_without_the_rest():
    assert H.main_text(PAGE).split("\n\n") == [
        "Title here", "First & bold, with a link.", "An unclosed one.", "Second block of words.", "One", "Two", "Short.",
        "Sub", "Another paragraph in a section with enough text in it to count for something.",
    ]


def test_pages_of_the_test_tables(spark):
    """A plain reading of these pages: what stands in <article>, cut at h1 and p."""
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    out = {r.page_id: r for r in H.op4_html(spark, "/root/testdata/sf0.01").collect()}
    for r in pages.collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        parts = [re.sub(r"<[^>]*>", " ", p) for p in re.split(r"</?(?:p|h1)>", inner)]
        blocks = [" ".join(html.unescape(p).split()) for p in parts]
        want = "\n\n".join(b for b in blocks if b)
        assert out[r.page_id].text == want and out[r.page_id].n_chars == len(want)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "<nav>menu</nav>"), (4, "plain words, no tags at all"), (4, "plain words, no tags at all"),
            (5, "<p>" * 3000 + "deep text" + "</div>" * 10), (6, "<article><p>" + "word " * 300_000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id int, html string").selectExpr("*", "1 as text", "2 as row")
    got = H.with_main_text(pages).collect()
    assert len(got) == 7 and set(got[0].asDict()) == {"page_id", "html", "row", "text"}
    text = {r.page_id: r.text for r in got}
    assert [text[i] for i in (1, 2, 3)] == ["", "", ""]
    assert text[4] == "plain words, no tags at all" and text[5] == "deep text"
    assert len(text[6]) == 5 * 300_000 - 1
    assert H.with_main_text(pages.limit(0)).collect() == []


STORY = "<p>The first paragraph of the story, long enough to be one.</p><p>The second, with a bit more of it to read.</p>"
TOLD = "The first paragraph of the story, long enough to be one.\n\nThe second, with a bit more of it to read."


def test_markup_that_says_nothing_about_the_article():
    for page in (
        f"<div class='layout has-sidebar'><article>{STORY}</article></div>",
        f"<div class='no-comments'><article>{STORY}</article></div>",
        f"<form><article>{STORY}</article></form>",
        f"<main><div id='search-results'>{STORY}</div></main>",
        f"<form action=/><div>{STORY}</div><input name=x></form>",
        f"<div class='sidebar'><main>{STORY}</main></div><footer>(c)</footer>",
        f"<div class='widget'>{STORY}</div><div class='ad'>Buy it.</div>",
    ):
        assert H.main_text(f"<html><body><nav><a href=/>Home</a></nav>{page}</body></html>") == TOLD, page


def test_inline_elements_stay_in_their_sentence():
    page = "<article><p>It has a <a class='related-link' href=x>word</a> inside, and <span class='alert'>one</span> here.</p></article>"
    assert H.main_text(page) == "It has a word inside, and one here."
    page = "<article><p>Seen <span hidden>unseen</span><i style='display: none'>no</i><script>x</script>again.</p></article>"
    assert H.main_text(page) == "Seen again."


def test_parts_of_the_article_with_telling_words_stay():
    page = f"<article>{STORY}<div class='social-history'><p>On the social history of the place.</p></div></article>"
    assert H.main_text(page) == TOLD + "\n\nOn the social history of the place."
    page = f"<article>{STORY}<div class='comments'><article class='comment'><p>{'So wrong! ' * 40}</p></article></div></article>"
    assert H.main_text(page) == TOLD


def test_two_plain_parts_of_different_density():
    long, short = "A sentence of some length that goes on for a while. " * 4, "Short ones follow here now. "
    first = "".join(f"<p>{long}</p>" for _ in range(5))
    second = "".join(f"<p>{short}</p>" for _ in range(6))
    got = H.main_text(f"<body><div>{first}</div><div>{second}</div></body>").split("\n\n")
    assert got == [long.strip()] * 5 + [short.strip()] * 6


def test_density_alone_decides(monkeypatch):
    """Nothing is marked here: link lists and a teaser column lose against the
    text by their density, and do not if densities are set to 0."""
    links = "".join(f"<li><a href=/{i}>Some other page {i}</a></li>" for i in range(12))
    teasers = "".join(f"<div><a href=/t{i}><b>Read on</b> what {i} said</a></div>" for i in range(8))
    page = f"<body><div><ul>{links}</ul></div><div><div>{STORY * 3}</div></div><div>{teasers}</div></body>"
    want = "\n\n".join([TOLD] * 3)
    assert H.main_text(page) == want
    plain = H.densities
    monkeypatch.setattr(H, "densities", lambda *a: tuple([0.0] * len(x) for x in plain(*a)[:2]) + plain(*a)[2:])
    assert H.main_text(page) != want


def test_formula_against_a_plain_tree():
    """Every node counted anew by walking its subtree."""
    import math

    page = "<body>x<div>Some text <a href=a>link</a><p>More <b>bold</b> text</p><ul><li><a>one</a><li>two</ul></div><p>End.</p></body>"
    tree = H.Tree()
    tree.feed(page)
    tree.close()
    blocks = [(node, " ".join("".join(p).split()), sum(k)) for node, p, k in tree.texts if "".join(p).strip()]
    density, total, _ = H.densities(tree, blocks, [False] * len(tree.parent))
    below = lambda i: [j for j in range(len(tree.parent)) if i in _up(tree, j)]

    def one(i):
        c = sum(len(t) for node, t, _ in blocks if node in below(i))
        lc = sum(k for node, _, k in blocks if node in below(i))
        t, lt = (max(1, sum(x[j] for j in below(i))) for x in (tree.tags, tree.link_tags))
        cb, lcb = sum(len(x) for _, x, _ in blocks), sum(k for _, _, k in blocks)
        return c / t * max(0, math.log(c * t / (max(1, lc) * lt))) / math.log(c * lc / max(1, c - lc) + lcb * c / cb + math.e)

    want = [one(i) for i in range(len(tree.parent))]
    assert all(abs(a - b) < 1e-9 for a, b in zip(density, want))
    children = [[j for j in range(len(want)) if tree.parent[j] == i] for i in range(len(want))]
    assert all(abs(total[i] - (sum(want[j] for j in c) if c else want[i])) < 1e-9 for i, c in enumerate(children))


def _up(tree, i):
    out = [i]
    while out[-1]:
        out.append(tree.parent[out[-1]])
    return out


def test_deep_pages_take_linear_time():
    import time

    def seconds(n):
        start = time.process_time()
        assert H.main_text("<div>x" * n).count("x") == n
        return time.process_time() - start

    seconds(500)
    assert seconds(16_000) < 40 * max(seconds(2_000), 0.01)
