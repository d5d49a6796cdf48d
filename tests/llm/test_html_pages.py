"""HTML extraction on hand-marked pages of other sites, and on hostile markup."""

import time
import tracemalloc

import pyarrow.parquet as pq
import pytest

from ledgerlake.llm import html_extract
from ledgerlake.llm.html_extract import BiLstm, Labeller, Reader, blocks, main_texts, train

SF = "/root/testdata/sf0.01"
#: (html, what a reader would call the text); marked by hand
STORY = ["A long first sentence tells what happened in the town, and to whom it happened.",
         "The second paragraph explains why, at some length, with the names of those who were there.",
         "Nobody expected the third one, which closes the story in a calm tone."]
MARKED = {
    "comments inside the article": (
        "<html><body><article><h1>Title of it</h1>" + "".join(f"<p>{s}</p>" for s in STORY)
        + "<section class='comments'><p>Nice one, thanks for it!</p><p>I do not agree at all.</p></section>"
          "</article></body></html>", " ".join(["Title of it", *STORY])),
    "a notice and a form inside": (
        "<html><body><main><div class='notice'><p>We use cookies on this site, accept?</p></div><article>"
        + "".join(f"<p>{s}</p>" for s in STORY)
        + "<form><div>Your mail <input name=m> for our letter</div></form></article></main></body></html>", " ".join(STORY)),
    "a sidebar inside": (
        "<body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav><article>"
        + f"<p>{STORY[0]}</p><aside><p>Read also: ten other things</p></aside><p>{STORY[1]}</p><p>{STORY[2]}</p>"
        + "</article><footer><p>Copyright of the paper</p></footer></body>", " ".join(STORY)),
    "an article in a div": (
        "<html><body><div class='menu'><ul><li><a href=/>Home</a></li><li><a href=/b>Blog</a></li></ul></div>"
        "<div class='story-text'>" + "".join(f"<p>{s}</p>" for s in STORY) + "</div>"
        "<div class='discussion'><p>First! I was here before all of you.</p></div>"
        "<div class='footer'><p>Imprint</p></div></body></html>", " ".join(STORY)),
}


@pytest.fixture(scope="module")
def net():
    pages = pq.read_table(f"{SF}/pages.parquet", columns=["html"])["html"].to_pylist()
    return train(sorted(p for p in pages if p)[:300], Labeller())


@pytest.mark.parametrize("name", MARKED)
def test_marked_pages(net, name):
    html, want = MARKED[name]
    assert main_texts([html], net, Reader()) == [want]


HOSTILE = {"nested": "<div>x " * 40_000, "unclosed quotes": '<a "' * 250_000, "unclosed tags": "<a" * 500_000,
           "ends in quotes": '<a ">" ' * 150_000, "closed elsewhere": "<div>" * 50_000 + "</x>" * 150_000,
           "links in depth": "<div>" * 30_000 + "<a>x" * 150_000, "mixed quotes": "<a \"' " * 150_000 + ">",
           "open comment": "<p>x" * 1000 + "<!-- " * 150_000}


@pytest.mark.parametrize("name", HOSTILE)
def test_hostile_markup_costs_one_pass(name):
    began = time.process_time()
    found = blocks(HOSTILE[name])
    assert time.process_time() - began < 4 and len(found) < 200_000
    tracemalloc.start()
    blocks(HOSTILE[name][:200_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6


def test_deep_pages_are_labelled():
    """A path is as long as the page is deep; its blocks still share it."""
    page = "<div>x " * 3000
    assert len(main_texts([page], BiLstm(4), Reader())) == 1
    node = blocks(page)[-1].node
    assert node.depth == 3000 and len(node.path()) == 3000


def test_tags_that_never_end_are_text():
    assert [b.text for b in blocks('<p>a <b "x</p><p>b</p>')] == ['a <b "x', "b"]
    assert [b.text for b in blocks("1 < 2 <p title='>'>three</p> <")] == ["1 < 2", "three", "<"]
    assert [b.text for b in blocks("<p>a<!-- <p>gone")] == ["a"]


def test_sample_is_of_least_hash_and_distinct(spark):
    pages = spark.createDataFrame([(i, "u", f"<p>page {i % 50}</p>" if i % 3 else "<p>same</p>") for i in range(400)],
                                  "page_id long, url string, html string")
    some = html_extract._sample(pages, Labeller(sample_pages=20))
    whole = html_extract._sample(pages, Labeller(sample_pages=500))
    assert len(some) == len(set(some)) == 20 and set(some) <= set(whole) and some == whole[:20]
    assert set(whole) == {r.html for r in pages.collect()}
    assert html_extract._sample(pages.limit(0), Labeller()) == []
