"""Pages that stall a parser, parts named by pieces of a class, link lists in articles, and what the ratio decides."""

import time

import numpy as np
import pytest

from reelgrain.llm import html_text as h

LONG = "word " * 60


@pytest.mark.parametrize("page", [
    "<p>x" + "<i>" * 16_000 + "</b>" * 16_000, "<b><div>" + "<i>" * 16_000 + "</b>" * 16_000, "<i>" * 16_000 + "<div></div>" * 16_000,
    "<p>text</p>" + "<a " * 8_000, "</a " * 8_000, "<" * 8_000, "<a href='" * 8_000])
def test_no_page_takes_long(page):
    begin = time.process_time()
    h.main_text(page)
    assert time.process_time() - begin < 2


def test_an_unfinished_tag_is_no_text():
    assert h.main_text("<p>some text</p><a href=") == "some text" and h.main_text("a < b") == "a < b"


@pytest.mark.parametrize("name", ["comments-area", "comment-section", "user-comments", "ad-box", "box_ads", "site-header", "page-footer", "top-nav", "cookie-bar"])
def test_names_by_their_parts(name):
    for attribute in ("class", "id"):
        page = f"<main><p>{LONG}</p><p>{LONG}</p><div {attribute}='{name}'><p>other words</p></div></main>"
        assert "other" not in h.main_text(page) and h.main_text(page).count("word") == 120


@pytest.mark.parametrize("name", ["has-comments", "with-ads", "adamant", "post-header", "headers", "commentary", "article-header"])
def test_no_name_takes_out_the_article(name):
    assert h.main_text(f"<div class='{name}'><article><h1>Title</h1><p>{LONG}</p></article></div>").split("\n")[0] == "Title"
    assert "kept" in h.main_text(f"<main><p>{LONG}</p><div class='{name}-{name}x'><p>kept</p></div></main>") or "comments" in name or "ads" in name


def test_lists_of_links_in_an_article():
    links = "".join(f"<li><a href={i}>Another page {i}</a></li>" for i in range(5))
    text = h.main_text(f"<article><h2><a href=0>Heading</a></h2><p>{LONG}</p><ul>{links}</ul><p>{LONG}</p><p><a href=1>one link</a></p></article>")
    assert "Another" not in text and "Heading" in text and "one link" in text and text.count("word") == 120


def test_the_ratio_decides_without_marks(monkeypatch):
    noise = "".join(f"<div><a href={i}>x{i}</a><b>y</b></div>" for i in range(12))
    page = f"<body>{noise}<div><p>{LONG}</p><p>{LONG}</p></div>{noise}</body>"
    text = h.main_text(page)
    assert text.count("word") == 120 and "x3" not in text
    monkeypatch.setattr(h, "smooth", lambda values: np.ones(len(values)))
    assert h.main_text(page) != text
