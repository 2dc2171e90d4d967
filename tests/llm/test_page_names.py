"""Which elements of a page are left out, and where they end."""

from __future__ import annotations

import pytest

from tripflow.llm import html_text

LONG = "A long line of the text that the page is about, with many words in it. " * 4
ENDS = {
    '<article><p class="notice">n<p>real one<p>real two</article>': "real one real two",
    '<article><ul><li class="ad">buy<li>first<li>second</ul><p>after</article>': "first second after",
    '<article><table><tr><td class="sidebar">side<td>main text<tr><td>more</table></article>': "main text more",
    '<article><table><tr class="ad"><td>x<tr><td>main text</table></article>': "main text",
    '<article><dl><dt class="ad">x<dd>main text</dl></article>': "main text",
    "<article><p class='notice'>n<div>real</div></article>": "real",
    "<body><div><p class='notice'>n</div><div><p>real text here</div>": "real text here",
    "<main><article><p class='notice'>n</article><article><p>real</article></main>": "real",
    "<html><head><title>t</title><meta charset=x><body><p>real</p>": "real",
    "<article><ul><li>one<nav><ul><li>x<li>y</ul></nav><li>two</ul></article>": "one two",
}
NAMES = {
    f'<div class="layout has-sidebar"><article><p>{LONG}</article></div>': LONG,
    f'<div class="content no-sidebar"><p>{LONG}</div>': LONG,
    f'<div class="with-comments"><p>{LONG}</div>': LONG,
    f'<article><p>start</p><div class="search-results"><p>{LONG}</div></article>': "start " + LONG,
    f'<article><p>start</p><div id="social-history"><p>{LONG}</div></article>': "start " + LONG,
    f'<article><p>start</p><section class="related-work"><p>{LONG}</section></article>': "start " + LONG,
    f'<form action="x"><div><p>{LONG}</p><p>{LONG}</p></div></form>': LONG + LONG,
    f'<form action="x"><nav><a href=y>menu</a></nav><main><p>{LONG}</p></main></form>': LONG,
    f'<div class="search"><article><p>{LONG}</article></div>': LONG,
    f'<header><article><p>{LONG}</article></header>': LONG,
    f'<article><h2 id="search">Search</h2><p>{LONG}</article>': "Search " + LONG,
    # Still left out.
    f'<article><p>{LONG}</article><div class="post-comments"><p>{LONG}</p><p>{LONG}</p></div>': LONG,
    f'<article><p>{LONG}</article><div class="comments"><article><p>{LONG}</article></div>': LONG,
    f'<article><p>{LONG}</p><form><p>form</form><div class="share-buttons">share</div></article>': LONG,
    f'<div><p>{LONG}</p></div><div class="cookie-notice"><p>cookies</div><div class="site-footer">foot</div>': LONG,
}


@pytest.mark.parametrize("page", ENDS | NAMES)
def test_what_is_left_out(page):
    assert html_text.main_text(page) == (ENDS | NAMES)[page].strip().replace("  ", " ")
