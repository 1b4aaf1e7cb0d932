"""Operator 6: what is cut and what stays, with the exact text of each page."""

import itertools
import random

import pytest

from vitrine.llm.html_text import main_text

PARA = "A long paragraph, with commas, that scores for its container. " * 4
P = f"<p>{PARA}</p>"
TEXT = " ".join(PARA.split())
ARTICLE = f"<article><h1>Title</h1>{P}</article>"


@pytest.mark.parametrize("open_,close", [('<div class="layout has-sidebar">', "</div>"), ('<section id="content-no-sidebar">', "</section>"), ('<div class="with-navbar">', "</div>"),
                                         ('<div id="ad-free">', "</div>"), ('<div class="sidebar">', "</div>"), ('<form id="aspnetForm">', "</form>"), ('<div role="search">', "</div>"),
                                         ('<div class="modal">', "</div>"), ("<div><div><div>", "</div></div></div>"), ("<main>", "</main>")])
def test_wrappers_never_cut_the_article(open_, close):
    menu = '<nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy this now.</div>'
    assert main_text(f"<body>{menu}{open_}{ARTICLE}{close}<footer>foot</footer>") == f"Title\n{TEXT}"
    assert main_text(f"<body>{menu}{open_}<div><h1>Title</h1>{P}{P}</div>{close}<footer>foot</footer>") == f"Title\n{TEXT}\n{TEXT}"


@pytest.mark.parametrize("part,text", [
    ('<section id="sharing-economy"><h2>Sharing</h2><p>One.</p></section>', "Sharing\nOne."),
    ('<section class="related-work"><p>Earlier work.</p></section>', "Earlier work."),
    (f'<section class="share">{P}{P}</section>', f"{TEXT}\n{TEXT}"),
    ('<article class="comment"><p>Reader says.</p></article>', ""),
    ('<div class="comments"><article><p>Reader says.</p></article></div>', ""),
    (f'<section id="reader-comments"><h3>Comments</h3>{P * 9}</section>', ""),
    ('<p class="advert">Buy.</p>', ""), ('<p class="notice">We use your data.</p>', ""), ('<p>Kept <span class="ad">bought</span> words.</p>', "Kept words."),
    ('<div class="ad-1">Buy.</div><div class="adSlot">Buy.</div><div class="left_sidebar2">side</div><div class="post-footer">foot</div>', ""),
    ('<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding="t">x=2</annotation></math> be.</p>', "Let x=2 be."),
    ("<p hidden>gone</p><p hidden=''>gone</p><div aria-hidden='true'>gone</div><div style='display: none'>gone</div>", ""),
    ('<h2 class="widget">Head</h2><h3 id="comments">On comments</h3><pre class="token comment"># code</pre>', "Head\nOn comments\n# code"),
    ('<div class="promotion"><a href="/x">See more</a></div><ul class="social-links"><li><a href=x>f</a></ul>', ""),
    ('<div class="banner"><h1>Second title</h1></div>', "Second title"),
    ('<aside>side</aside><form>field</form><div role="navigation">menu</div>', ""),
])
def test_parts_of_an_article(part, text):
    assert main_text(f"<body><article><h1>Title</h1>{P}{part}<p>End.</p></article></body>") == "\n".join(x for x in ("Title", TEXT, text, "End.") if x)


@pytest.mark.parametrize("page,blocks", [
    (f"<main><article><p>One, a.</p>{P}</article><article><p>Two, b.</p></article></main>", ["One, a.", TEXT, "Two, b."]),
    (f"<div><article>{P}</article><article><p>Two.</p></article><article><a href=x>Other story</a></article></div>", [TEXT, "Two."]),
    (f"<div><div><article>{P}</article></div><div><section><article><p>Two.</p></article></section></div></div>", [TEXT, "Two."]),
    (f"{ARTICLE}<div id='comments'><ol><li><article class='comment-body'>{P}</article></ol></div>", ["Title", TEXT]),
    (f"<div class='comments'>{P * 6}</div>{ARTICLE}", ["Title", TEXT]),
    (f"<article class='comment'>{P}</article>", [TEXT]),
    (f"<div class='sidebar'><article><p>Teaser, teaser.</p></article></div><main><h1>Title</h1><article>{P}</article></main>", [TEXT]),
])
def test_several_articles(page, blocks):
    assert main_text(f"<body><header>site</header>{page}<footer>foot</footer>") == "\n".join(blocks)


def test_generated_pages():
    """Menus, adverts, notices, comments and footers around and inside articles, with and without article elements."""
    r = random.Random(5)
    junk = ['<nav><a href="/">Home</a></nav>', '<div class="ad top">Buy now, buy.</div>', '<div class="cookie-notice"><p>We use cookies, many.</p></div>', "<script>var t='</p>';</script>",
            '<div class="share-buttons"><a href=x>f</a></div>', '<section class="comments"><article><p>First, reader, here!</p></article></section>', '<form><input value="x">go</form>', "<!-- <p>no</p> -->"]
    wraps = [("", ""), ('<div class="layout has-sidebar">', "</div>"), ('<div id="page"><div class="with-navbar">', "</div></div>"), ("<main>", "</main>"), ('<section id="content-no-sidebar">', "</section>")]
    for k, (wrap, tag, sections) in enumerate(itertools.product(wraps, ("article", "div"), (0, 1, 3))):
        blocks, inner = ["Title of it"], "<h1>Title of it</h1>"
        for part in range(max(1, sections)):
            own = [f"Words, {r.choice(['more', 'yet more'])}, of part {part}, number {i}: " + "text " * r.randint(20, 60) for i in range(r.randint(2, 5))]
            own = [" ".join(x.split()) for x in own]
            body = "".join(f"<p>{x}</p>" + r.choice(junk + [""] * 6) for x in own)
            inner += f"<section><h2>Part {part}</h2>{body}</section>" if sections else body
            blocks += ([f"Part {part}"] if sections else []) + own
        page = f"<html><body>{r.choice(junk)}{wrap[0]}{r.choice(junk)}<{tag}>{inner}</{tag}>{r.choice(junk)}{wrap[1]}{r.choice(junk)}<footer>foot, 2024</footer></body></html>"
        assert main_text(page) == "\n".join(blocks), (k, page)
