"""Main text of pages."""

import re
import time
from html import unescape

import pytest

from tessera.llm import html_text, queries


def test_pages_give_their_articles(spark, small):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.op4_block_rules(spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        parts = [re.sub(r"<[^>]*>", "", p.replace("<br>", " ")) for p in re.split(r"</?(?:p|h1)\b[^>]*>", body)]
        assert r.text == "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        assert r.n_chars == len(r.text)


PROSE = "This is the text of an article that is not marked, and it has a lot of the words that make up prose."


def test_rules_without_a_marked_article():
    page = f"""<body><div class="top menu"><a href=a>Home</a></div><div id=cookie-consent>We use them and you know all of it.</div>
    <h2>A heading</h2><p>{PROSE}</p><p>Short one.</p><ul><li><a href=x>More of this and that, to be read by all of you</a>
    <li><a href=y>Less of this and that, to be read by all of you who can</a></ul><div class=comments><p>{PROSE}</p></div></body>"""
    assert html_text.main_text(page) == f"A heading\n{PROSE}\nShort one."


def test_blocks_and_characters():
    text = html_text.main_text
    assert text("<article>one<br>two<br><br>three <span class=ad>x</span> four</article>") == "one two\nthree\nfour"
    assert text("<article><p>a&amp;b &lt;i&gt; &#233;&nbsp;x</p><script>if (a<b) '</p>'</script><p>c</article>") == "a&b <i> é x\nc"
    assert text("<main><header>Title</header><form>no</form><p hidden>no</p><p>yes</main><footer>no</footer>") == "Title\nyes"
    assert text("<p>x<!-- never closed") == "" and text("") == "" and text("<") == ""
    assert text('<article><p title="a>b">in</p></article>') == "in"


def test_odd_rows(spark):
    rows = [(1, None, "u", 5), (1, "", "u", 5), (None, "<article>" + "<p>word</p>" * 20_000 + "</article>", None, None)]
    schema = "page_id long, html string, text string, n_chars int"
    got = html_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, 99_999]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0


PROSE = {
    "pt": "O gato preto dorme tranquilamente no telhado vermelho enquanto chove muito forte hoje na cidade.",
    "pl": "Czarny kot spokojnie śpi na czerwonym dachu, podczas gdy pada bardzo silny deszcz nad miastem.",
    "ja": "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。薄暗いじめじめした所で泣いていた。",
    "it": "Il gatto nero dorme tranquillo sul tetto rosso mentre piove molto forte sulla città vecchia stanotte.",
}


@pytest.mark.parametrize("language", PROSE)
def test_prose_of_other_languages_on_unmarked_pages(language):
    text = PROSE[language]
    menu = "<div><a href=a>Menu eins</a> <a href=b>Menu zwei</a></div><div class='site-footer-links'><p>Impressum und mehr</p></div>"
    page = f"<html><body>{menu}<div><p>{text}</p><p>{text}</p></div><div class=cookie-banner><p>{text} cookies</p></div></body></html>"
    assert html_text.main_text(page) == f"{text}\n{text}"


def test_compound_class_names_drop_what_they_name_only():
    stay = ["share-price", "search-tips", "product-notice", "login-guide", "ad-hoc", "comment"[:3]]
    go = ["share-buttons", "comment-list", "newsletter-signup", "ads", "site-footer", "main nav", "reader-comments"]
    parts = "".join(f'<p class="{c}">The paragraph called {c} is one of those in the article.</p>' for c in [*stay, *go])
    text = html_text.main_text(f"<article>{parts}</article>")
    assert text.split("\n") == [f"The paragraph called {c} is one of those in the article." for c in stay]


def test_many_tags_without_partners_take_linear_time():
    began = time.monotonic()
    html_text.main_text("<div>" * 40_000 + "text" + "</span>" * 40_000)
    html_text.main_text("<div><p>" * 20_000 + "</div>" * 40_000)
    assert time.monotonic() - began < 5
