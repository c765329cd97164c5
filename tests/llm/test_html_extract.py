import math
import re
import statistics

import pyarrow.parquet as pq
import pytest

from casewatch.llm.html_extract import blocks, extract, main_text, path_ratios

from .helpers import tuples

LONG = "A long paragraph, with commas, and several sentences. It goes on and on. " * 3


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>a<p>b<br>c", "a b c"),
        ("<p>foo<b>bar</b>baz</p>", "foobarbaz"),
        ("<p>a &lt;b&gt; &#233;&eacute;&nbsp;x</p>", "a <b> éé x"),
        ("<p>x<!-- no --><script>var t='</p>';</script>y<style>p{}</style>z</p>", "x y z"),
        ("<div><p><a>x</a></p></div><div><p><a>y</a></p></div>", "x y"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<title>no</title><p>yes</p><!-- open", "yes"),
        ("<p>one</p><footer>no</footer><nav><ul><li>no</ul></nav>", "one"),
        ("<article><h1>Title</h1><p>Some text.</p><aside>no</aside><form>no</form></article><p>out</p>", "Title Some text."),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_article_without_its_surroundings():
    page = f"""<html><head><title>t</title></head><body><header>Site</header><div id="menu"><a>Home</a></div>
      <div class="cookie-notice">We use cookies</div><div class="content"><h2>Title</h2><p>{LONG}</p><p>Short.</p>
      <ul><li>one<li>two</ul><div class="ad">Buy</div></div><div class="comments"><p>{LONG}</p></div>
      <div class="sidebar">Other</div></body></html>"""
    assert main_text(page) == f"Title {' '.join(LONG.split())} Short. one two"


@pytest.mark.parametrize(
    "attributes",
    [
        'aria-label="Hidden costs of war"', "data-title='the hidden life'", "data-x=\"a class='ad' b\"", "hidden-title=x",
        'class="content has-sidebar"', 'class="no-sidebar"', 'class="post share-enabled"', "data-class=ad",
    ],
)
def test_attributes_that_mark_no_boilerplate(attributes):
    assert main_text(f"<div {attributes}><p>{LONG}</p></div><p>Other.</p>").startswith("A long paragraph")


@pytest.mark.parametrize("attributes", ["hidden", "x=1 HIDDEN=''", "aria-hidden = true", "class=ad", 'title="a" class="x ad-slot"', "id='sidebar-left'"])
def test_attributes_that_mark_boilerplate(attributes):
    assert main_text(f"<div {attributes}><p>{LONG}</p></div><p>Other, text.</p>") == "Other, text."


def test_class_words_never_leave_a_page_empty():
    assert main_text(f'<div class="search"><p>{LONG}</p><nav>no</nav></div>') == " ".join(LONG.split())


def test_short_boilerplate_path_falls_below_the_threshold():
    links = "".join(f"<div><span>link {n}</span></div>" for n in range(20))
    page = f"<body><section><p>{LONG}</p><p>{LONG}</p></section><table>{links}</table></body>"
    assert "Long" not in main_text(page) and main_text(page).startswith("A long paragraph")
    assert "link 19" not in main_text(page)


def test_very_long_and_broken_pages_are_read_whole():
    page = "<div>" * 3000 + "<p>" + "word " * 50_000 + "<a href=\"x>y"
    assert main_text(page).count("word") == 50_000
    assert main_text("<p>" + "< " * 2000 + "tail").endswith("tail")


def test_table_with_nulls_repeated_rows_and_clashing_names(spark):
    rows = [(1, None, None, "e"), (None, "u", "<p>a", "e"), (2, "u", "<p>b", "e"), (2, "u", "<p>b", "e")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = tuples(extract(pages), "row.page_id", "row.text", "text", "n_chars")
    assert found == sorted([(1, "e", "", 0), (None, "e", "a", 1), (2, "e", "b", 1), (2, "e", "b", 1)], key=repr)
    assert tuples(extract(pages.limit(0))) == []


def only_divs(page):
    """The page without names: article, nav, header, aside and footer are divs, and there is no class."""
    page = re.sub(r"<(/?)(?:article|nav|header|aside|footer|main)\b", r"<\1div", page)
    return re.sub(r' (?:class|id|role)="[^"]*"', "", page)


def test_ratios_alone_find_the_article_of_pages_made_of_divs():
    pages = [p for p in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist() if p]
    same = sum(main_text(p) == main_text(only_divs(p)) for p in pages)
    assert same >= 0.95 * len(pages)


def test_one_of_several_sections_alike_is_not_taken_for_the_article():
    page = f"<div>Home</div><div><section><h2>A</h2><p>{LONG * 3}</p></section><section><h2>B</h2><p>{LONG}</p></section></div>"
    assert main_text(page) == f"A {' '.join((LONG * 3).split())} B {' '.join(LONG.split())}"


def test_paths_that_are_mostly_links_are_no_content():
    links = "".join(f'<li><a href="/{n}">A linked headline, with punctuation, number {n}.</a></li>' for n in range(9))
    assert main_text(f"<div><p>{LONG}</p><ul>{links}</ul></div>") == " ".join(LONG.split())


def brute_ratios(found, sigma):
    """Every block's ratio by its definition, one block and one neighbour at a time."""
    def mean(of, path):
        values = [of(b) for b in found if b.path == path]
        return sum(values) / len(values)

    def smooth(of, at):
        reach = max(1, round(2 * sigma))
        near = [i for i in range(at - reach, at + reach + 1) if 0 <= i < len(found)]
        weights = [math.exp(-0.5 * ((i - at) / sigma) ** 2) for i in near]
        return sum(w * mean(of, found[i].path) for w, i in zip(weights, near)) / sum(weights)

    fused = []
    for at, b in enumerate(found):
        plain = 1 - mean(lambda b: b.linked, b.path) / mean(lambda b: len(b.text), b.path)
        marks = smooth(lambda b: sum(c in ".,;:!?。，、；：！？" for c in b.text), at)
        fused.append(smooth(lambda b: len(b.text), at) * (1 + marks) * plain)
    return [statistics.median(f for f, other in zip(fused, found) if other.path == b.path) for b in found]


@pytest.mark.parametrize("sigma", [0.5, 1.0, 2.5])
def test_path_ratios_equal_their_definition(sigma):
    page = f'<div><h1>T.</h1><p>{LONG}</p><p>a <a href="x">link, here</a> b</p></div><ul><li><a>x</a><li>y, z.</ul><div>end.</div>'
    found, _ = blocks(page)
    assert path_ratios(found, sigma) == pytest.approx(brute_ratios(found, sigma))
    assert path_ratios(found[:1], sigma) == pytest.approx(brute_ratios(found[:1], sigma))


def test_deeply_nested_pages_take_memory_in_proportion():
    assert main_text("<div>" * 200_000 + f"<p>{LONG}</p>") == " ".join(LONG.split())
