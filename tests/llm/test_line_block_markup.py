"""Markup that a page gets wrong, names that only look like furniture, and time linear in the page."""

import time

import pytest

from riskframe.llm.line_blocks import main_text, tokens_of

LONG = "This paragraph is long enough to make the distribution surge, since it has well over eighty characters of text."
P = f"<p>{LONG}</p>"


@pytest.mark.parametrize("page, text", [
    # never closed: an advert ends with its own line, other furniture with its parent
    (f'<div class="ad">Buy<div><p>{LONG}', LONG),
    (f"<section><nav><ul><li>Home</section><p>{LONG}", LONG),
    (f"{P}<footer><p>Imprint of the page {LONG}", LONG),
    (f"<head><meta charset='x'><title>T</title><body><p>{LONG}", LONG),
    # names inside an article that only look like furniture
    (f'<article><p class="no-comments">{LONG}</p></article>', LONG),
    (f'<article>{P}<section class="legal"><p>Law.</p></section></article>', f"{LONG} Law."),
    (f'<article>{P}<p class="related-work">Others.</p><p class="share price">Up.</p></article>', f"{LONG} Others. Up."),
    (f'<article><h2 id="comments-on-law">Head</h2>{P}</article>', f"Head {LONG}"),
    (f'<div class="layout has-sidebar">{P}</div>', LONG),
    # names that are furniture
    (f'{P}<ul class="responses"><li>{LONG}</li></ul>', LONG),
    (f'{P}<div class="site-footer">{LONG}</div><div id="cookie_banner">{LONG}</div>', LONG),
    (f'<article>{P}<div class="post-comments"><p>{LONG}</p></div></article>', LONG),
    # a list of links between paragraphs stays, a menu does not
    (f"{P}<ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul>{P}", f"{LONG} One Two {LONG}"),
    (f"{P}<p>Short.</p><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul>{P}", f"{LONG} Short. {LONG}"),
    # inline
    (f"{P}<p>foo<img src='x'>bar b<my-mark>a</my-mark>z<br>end</p>", f"{LONG} foobar baz end"),
    # text that is no markup, quotes that hide or break the end of a tag
    ("<p>a < b and 3 <4 c</p>", "a < b and 3 <4 c"),
    ('<p title="a > b">x</p>', "x"),
    ('<p title="a > b">x</p><p title="it>y</p>', "x y"),
    (f"<svg>{P}", LONG),
])
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("piece", ['<div "', "<div ", "<!", "<a href='\"", "<script ", "<![CDATA[", "<a<"])
@pytest.mark.parametrize("end", ["", ">"])
def test_a_megabyte_of_broken_tags(piece, end):
    page = piece * (1_000_000 // len(piece)) + end
    start = time.time()
    assert main_text(page) == ""
    assert time.time() - start < 1


@pytest.mark.parametrize("piece", ["<svg>", "<div>", "<li><a>x", '<div class="ad">x', "<nav><p>"])
def test_a_megabyte_of_open_tags(piece):
    start = time.time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.time() - start < 15


def test_tokens_cover_the_markup():
    page = '<!-- a > b --><p class=x>t<br/></P><script>1 < 2</script><![CDATA[ <b> ]]><?xml?><i'
    assert [page[t.start:t.end] for t in tokens_of(page)] == [
        "<!-- a > b -->", "<p class=x>", "<br/>", "</P>", "<script>1 < 2</script>", "<![CDATA[ <b> ]]>", "<?xml?>"]
    assert [(t.name, t.closing, t.raw) for t in tokens_of(page)] == [
        ("", False, ""), ("p", False, ""), ("br", False, ""), ("p", True, ""), ("", False, "script"), ("", False, ""), ("", False, "")]
