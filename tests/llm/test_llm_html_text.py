"""Main text of pages: structure, page differencing, odd markup."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelsift.llm import html_text

PAGES = "page_id long, url string, html string, k long, text string, path string, place long"


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{x:y}}</style></head><body>{body}</body></html>"


def main(html):
    return "\n".join(t for k, t in html_text.page_blocks(html) if k == html_text.MAIN)


def test_structure():
    frame = '<nav><ul><li><a href="/x">Menu</a></li></ul></nav><header><h2>Site</h2></header><div class="ad-slot">Buy</div><aside>Side</aside>'
    after = '<section id="comments"><p>Nice!</p></section><form><p>Mail</p></form><footer>&copy; us</footer>'
    inner = '<h1>A &amp; B</h1><p>One  two<br>three<script>var t="</p>";</script></p><div class="cookie-notice">Cookies</div><p>Last<!-- no --></p>'
    assert main(page(f"{frame}<article>{inner}</article>{after}")) == "A & B\nOne two three\nLast"
    assert main(page(f"{frame}<main><p>In main</p></main>{after}")) == "In main"
    assert main(page("<article><p>un<b>bro</b>ken <i>word</i></p><ul><li>1<li>2</ul></article>")) == "unbroken word\n1\n2"
    assert main(page('<article><p title="a > b">x &lt;y&gt; &eacute;&#233;&#xe9;&nbsp;z</p></article>')) == "x <y> ééé z"


def test_unclosed_and_broken_markup():
    assert main("<article><p><b>one.<br><p>two</p></article>") == "one.\ntwo"
    assert main('<article><p class="x>one</p><p>two</p></article>').endswith("two")
    assert html_text.page_blocks("just < text & more") == [(html_text.OPEN, "just < text & more")]
    assert html_text.page_blocks("<header>x") == [(html_text.FRAME, "x")] and html_text.page_blocks("") == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("<>/\"'=-! apdivscriptnab&;x"), max_size=120))
def test_any_text_is_cut_into_blocks(text):
    for _, block in html_text.page_blocks(text):
        assert block == " ".join(block.split()) != ""


def lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            n[i + 1][j + 1] = n[i][j] + 1 if a[i] == b[j] else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


def test_shared_lines():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 12))] for _ in range(2))
        places = html_text.shared_lines(a, b)
        assert places == sorted(set(places)) and len(places) == lcs(a, b)
        rest = iter(b)
        assert all(a[p] in rest for p in places)


@pytest.fixture(scope="module")
def pages(spark):
    top, end = "<div>Welcome to the site</div><div>Home News Sport</div>", "<div>All rights reserved</div>"
    rows = [(k, f"https://h{k % 2}.example/news/{k}", page(f"{top}<p>Story {k} one</p><p>Story {k} two</p><p>Story {k} three</p>{end}")) for k in range(8)]
    rows += [(20, "https://h0.example/news/2/copy", page(f"{top}<p>Story 2 one</p><p>Story 2 two</p><p>Story 2 three</p>{end}"))]
    article = "<article><p>Repeated in all</p><p>Own {}</p></article>"
    rows += [(30 + k, f"https://h0.example/a/{k}", page(top + article.format(k))) for k in range(3)]
    rows += [(40, None, None), (41, "", ""), (42, "http://[bad", page("<p>Alone</p>")), (43, "https://one.example/", page("<p>Only page</p>")), (None, None, page("<p>No id</p>"))]
    rows += [(44, "https://x.example/1", page("<p>twice</p>"))] * 2
    return spark.createDataFrame([(*r, 1, "t", "p", 2) for r in rows], PAGES).repartition(3)


def test_frame_lines_go_and_articles_stay(pages):
    got = {}
    for r in html_text.extract_text(pages).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert all(got[k] == [f"Story {k} one\nStory {k} two\nStory {k} three"] for k in (1, 3, 5, 7))
    assert all(got[30 + k] == [f"Repeated in all\nOwn {k}"] for k in range(3))
    assert got[40] == got[41] == [""] and got[42] == ["Alone"] and got[43] == ["Only page"] and got[None] == ["No id"] and got[44] == ["twice", "twice"]
    assert "Story 2 two" in got[2][0] and "Story 2 two" in got[20][0]


def test_forms_of_the_join_agree(pages, monkeypatch):
    told = lambda: sorted(map(repr, html_text.extract_text(pages).collect()))
    whole = told()
    monkeypatch.setattr(html_text, "SENT_PAGES", 0)
    assert told() == whole


def test_empty_table(pages):
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_main_and_article_beside_each_other():
    kinds = lambda body: [(k, t) for k, t in html_text.page_blocks(page(body)) if k != html_text.FRAME]
    whole, teaser, extra = (html_text.MAIN, "Whole text"), (html_text.OPEN, "Teaser"), (html_text.OPEN, "Extra")
    assert kinds("<main><p>Whole text</p></main><article><p>Teaser</p></article>") == [whole, teaser]
    assert kinds("<main><article><p>Whole text</p></article><p>Extra</p></main><article>Teaser</article><p>Else</p>") == [whole, extra, teaser]
    assert kinds("<main><article><p>Whole text</p></article></main><aside><article>Side</article></aside>") == [whole]


def texts(spark, rows):
    table = spark.createDataFrame([(k, url, page(body)) for k, (url, body) in enumerate(rows)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_text.extract_text(table).collect()}


def test_copies_and_short_pages_lose_their_frame(spark):
    top, end = "".join(f"<div>Menu {n}</div>" for n in range(6)), "".join(f"<div>End {n}</div>" for n in range(4))
    story = lambda k, last="": f"{top}{''.join(f'<p>Story {k} line {n}</p>' for n in range(8))}{last}{end}"
    rows = [(f"https://copies.example/news/{k}", story(k)) for k in (1, 2, 3)]
    rows += [(f"https://copies.example/news/2?page={n}", story(2)) for n in range(30)]
    rows += [(f"https://copies.example/news/3/{n}", story(3, f"<p>Seen {n} times</p>")) for n in range(2)]
    rows += [(f"https://short.example/{k}", f"{top}<p>Short {k} a</p><p>Short {k} b</p>{end}") for k in range(4)]
    got = texts(spark, rows)
    whole = lambda k: "\n".join(f"Story {k} line {n}" for n in range(8))
    assert got[0] == whole(1) and all(got[k] == whole(2) for k in (1, *range(3, 33)))
    assert got[2] == whole(3) and got[33] == whole(3) + "\nSeen 0 times" and got[34] == whole(3) + "\nSeen 1 times"
    assert all(got[35 + k] == f"Short {k} a\nShort {k} b" for k in range(4))


def test_pages_with_an_article_tell_the_frame_of_those_without(spark):
    rows = [("https://h.example/a/1", "<nav><div>Home</div></nav><article><p>Text 1</p></article><footer><div>Rights</div></footer>")]
    rows += [("https://h.example/a/2", "<div>Home</div><p>Text 2</p><p>Text 1</p><div>Rights</div>")]
    assert texts(spark, rows) == {0: "Text 1", 1: "Text 2\nText 1"}


def test_names_in_main_text():
    kept = '<h2 id="search-results">A</h2><p id="social">B</p><p class="notice-period">C</p><div class="social-impact">D</div><div aria-label="Share of votes">E</div>'
    gone = '<div class="share-buttons">1</div><div id="comments">2</div><p class="notice">3</p><section role="search">4</section><div aria-label="Related">5</div>'
    assert main(f"<article>{kept}{gone}</article>") == "A\nB\nC\nD\nE"


def test_containers_of_the_frame_in_main_text():
    names = """comments comment-list comments-area reader-comments user-comments post-comments related-posts site-notice cookie-banner ad-top share-links newsletter-signup
        sponsored-content author-promo readerComments comments__thread"""
    for name in names.split():
        assert main(f'<article><p>Text</p><div class="{name}"><p>Gone</p></div><section class="x {name}"><p>Gone</p></section><p>End</p></article>') == "Text\nEnd", name
    for name in ("story-body", "share-price", "comment-culture-essay", "chapter"):
        assert main(f'<article><p>Text</p><div class="{name}"><p>Stays</p></div></article>') == "Text\nStays", name


def test_alignment_is_linear_in_space():
    import time
    import tracemalloc

    rng = random.Random(4)
    a, b = ([rng.choice([1, 1, 1, 1, 2, k]) for k in range(20_000)] for _ in range(2))
    for x, y in ((a, b), ([1] * 20_000, [1] * 19_000 + [2] * 500 + [1] * 900)):
        tracemalloc.start()
        start = time.time()
        places = html_text.shared_lines(x, y)
        assert time.time() - start < 20 and tracemalloc.get_traced_memory()[1] < 300 << 20
        tracemalloc.stop()
        assert len(places) == html_text._prefix_lengths(x, y)[-1]
        rest = iter(y)
        assert all(x[p] in rest for p in places)
