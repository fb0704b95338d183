import html
import re

import pytest

from cohortloom.llm import html_text as h
from cohortloom.llm.common import documents

LONG = "A sentence of the article that is long enough to make the distribution rise well above its threshold."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("no markup at all", "no markup at all"), ("plain\n short  text", "plain short text"), (LONG, LONG),
    ("<p>" + LONG + "<p>short<p>" + LONG, f"{LONG}\n\nshort\n\n{LONG}"),
    ("<nav><ul><li><a href=x>Menu</a></ul></nav><article><h1>T</h1><p>a &amp; b<br>c&nbsp; d</p><div class='ad'>buy</div><p>x</p></article><footer>f</footer>", "T\n\na & b c d\n\nx"),
    ("<main><p>one<script>var t='</p>'</script> two</p><form>send</form><aside>s</aside><!-- c <p>no</p> --><p>three</main>", "one two\n\nthree"),
    ("<article><p>kept</p><div id=comments><p>said</p></div><section class='comment-list'>more</section></article>", "kept"),
    ("<article><p>x < y and <b>bold</b>text</p></article>", "x < y and boldtext"),
    ("<article><p>unclosed <b>tag<br><p>next</article>", "unclosed tag\n\nnext"),
    ("<article><p>open comment <!-- gone", "open comment"),
    ("<article><p>open script <script>gone", "open script"),
    ("<article><div class='adventure reading'>kept</div><div class='cookie-notice'>gone</div></article>", "kept"),
    ("<article><p>caf&eacute; &#x41;&#66; &lt;tag&gt;</p></article>", "café AB <tag>"),
    ("<article><p title='a > b'>attribute</p></article>", "attribute"),
])
def test_pages(page, text):
    assert h.main_text(page or "") == text


@pytest.mark.parametrize("page,text", [
    ("<article><p>short</p><section class='comments'>" + LONG + "</section></article>", "short"),
    ("<div>a</div><div class='comments'>" + LONG + "</div>", "a"),
    ("<article><p>a</p><form>" + LONG + "</form></article>", "a"),
    ("<p>a</p><form><p>" + LONG + "</form>", "a"),
    ("<div class='comments'>only readers</div>", ""),
    ("<div class='widget'><p>a longer text</p><div class='comments'>" + LONG + "</div></div><div class='menu'>m</div>", "a longer text"),
    ("<div class='post comments'><article><p>a</p></article></div>", "a"),
])
def test_readers_and_forms_go_whatever_their_size(page, text):
    assert h.main_text(page) == text


def test_distribution():
    assert h.kept_lines([5, 0, 0, 60, 50, 2, 40, 0, 0, 0, 9], 3, 80) == [False, False, False, True, True, True, True, False, False, False, False]
    assert h.kept_lines([], 3, 80) == []


def test_table(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "<article>x"), (2, None, "<article>x"), (None, "u", "")], "page_id long, url string, html string").selectExpr("*", "'t' AS text", "1 AS id")
    rows = h.extract_text(pages).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, [h.extract_text(pages).where("page_id = 1").first(), *[r for r in rows if r["page_id"] != 1]]))
    assert sorted(r["text"] for r in rows) == ["", "", "x", "x"]
    assert h.extract_text(pages.limit(0)).count() == 0


def test_very_long_page():
    assert len(h.main_text("<article>" + "<p>word word</p>" * 50_000)) == 50_000 * 11 - 2


def test_given_pages(spark):
    pages = {r["page_id"]: r["html"] for r in documents(spark, "/root/testdata/sf0.001", "pages").collect()}
    for row in h.extract_text(documents(spark, "/root/testdata/sf0.001", "pages")).collect():
        inside = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert row["text"] == "\n\n".join(b for b in blocks if b)


@pytest.mark.parametrize("page,text", [
    *[(f"<div {named}><p>{LONG}</p></div>", LONG) for named in (
        "class='content has-sidebar'", "id='page' class='site no-sidebar'", "class='layout with-nav'", "class='without_left_nav'")],
    ("<section class='post no-comments'><article><p>a</p></article></section>", "a"),
    ("<div class='widget-area'><nav>menu</nav><article><p>a</p><div class='ad'>b</div></article><p class=x>other text, longer</p></div>", "a"),
    (f"<form><div class='sidebar'>s</div><p>{LONG}</p></form>", LONG),
    ("<article>a</article><div class='related'><article>teaser</article></div><p>some more text of the page here</p>", "a"),
    (f"<p>{LONG}</p><div class='has-ads sidebar'>gone</div>", LONG),
    (f"<div hidden><p>{LONG}</p></div>", ""),
])
def test_wrappers_named_after_furniture_stay(page, text):
    assert h.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<p>A short page.</p>", "A short page."), ("<h1>T</h1><nav>menu</nav><p>a</p><footer>f</footer>", "T\n\na"),
    (f"<nav>menu</nav><h1>Head</h1><p>By A</p><p>May</p><p>Place</p><p>{LONG}</p>", f"Head\n\nBy A\n\nMay\n\nPlace\n\n{LONG}"),
    (f"<div><a href=a>Home</a></div><div><a>News</a></div><div><a>About</a></div><h1>T</h1><p>{LONG}</p><p><a>Source</a></p><p>End</p>",
     f"T\n\n{LONG}\n\nSource\n\nEnd"),
    (f"<p>{LONG}</p><ul><li><a>Terms</a><li><a>Legal</a><li><a>Imprint</a></ul>", LONG),
    (f"<p>{LONG}</p><nav><li>a<li>b<li>c<li>d</nav><p>The end.</p><footer>f</footer>", f"{LONG}\n\nThe end."),
])
def test_pages_without_main_lose_furniture_only(page, text):
    assert h.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    (f"<p>{LONG}</p><nav><li>a<li>b<li>c</nav><div>Example Corp</div><div>All rights reserved</div>", LONG),
    (f"<p>{LONG}</p><nav><li>a<li>b<li>c</nav><p>Then</p><p>{LONG}</p>", f"{LONG}\n\nThen\n\n{LONG}"),
    (f"<p>{LONG}</p><nav><li>a<li>b</nav><div>Example Corp</div>", f"{LONG}\n\nExample Corp"),
    ("<p>One</p><nav><li>a<li>b<li>c</nav><p>Two</p>", "One\n\nTwo"),
])
def test_text_ends_at_the_dive_behind_the_last_surge(page, text):
    assert h.main_text(page) == text


def test_dive_point():
    assert h.dive_point([50, 0, 40, 0, 0, 0, 9, 0, 0, 0], 3, 80) == 3
    assert h.dive_point([90, 0, 0, 0, 9, 0, 0, 0, 90], 3, 80) == 9
    assert h.dive_point([40, 0, 0, 0, 45], 3, 80) == 5
    assert h.dive_point([], 3, 80) == 0


def test_article_pages_go_through_the_distribution(monkeypatch):
    seen = []
    sums = h.kept_lines
    monkeypatch.setattr(h, "kept_lines", lambda sizes, *rest: seen.append(sizes) or sums(sizes, *rest))
    assert h.main_text("<p>before</p><article><p>ab</p><div class=ad>x</div><p>c</p></article><p>after</p>") == "ab\n\nc"
    assert seen == [[2 + h.SURGE_CHARS, 1 + h.SURGE_CHARS]]
