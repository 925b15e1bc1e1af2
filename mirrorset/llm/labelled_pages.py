"""Labelled pages that the extraction model learns from.

``keep`` marks an element whose text belongs to the article, ``drop`` one whose text does not;
both hold for everything inside until another mark. The pages are put together by rule from kinds
of heads, articles and surroundings.
"""

from __future__ import annotations

_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/b">About us</a></li><li><a href="/c">News</a></li></ul>'
_FORM = "<label>Mail</label><input><select><option>A</option></select><textarea>Say</textarea><button>Send</button>"
_COMMENTS = "<h3>2 comments</h3><div class='comment reply'><p>First!</p><p>I disagree with it.</p></div>"

HEADS = [
    "",
    "<head drop><meta charset='utf-8'><title>T</title><style>p{}</style><script>x()</script></head>",
    "<head drop><title>Title of it</title><link><script>y</script></head>",
]

PARTS = [
    "<h1>Title</h1><p>First paragraph with <a href='#'>a link</a> in it.</p><p>Second one, <b>bold</b> and <i>more</i>.</p><p>Short.</p>",
    "<header><h1>Title</h1></header><p>One paragraph.</p><h2>Part</h2><p>Another <em>one</em>.</p><ul><li>Item</li><li>Item two</li></ul><p>End.</p>",
    "<p>Only text.<br>And more.</p><blockquote><p>Quote</p></blockquote><p>Then.</p><figure><figcaption>Caption</figcaption></figure>",
    "<h2>Name</h2><div>Plain block</div><div>Second <span>block</span></div><table><tr><th>Head</th><td>Cell</td></tr></table><pre>code</pre>",
    "<h1>Long</h1><p>A.</p><p>B.</p><p>C <a href='/'>link</a>.</p><h3>Sub</h3><ol><li><p>Step</p></li></ol><p>D.</p><dl><dt>Term</dt><dd>Text</dd></dl>",
]

ARTICLES = [
    "<article keep>{}</article>",
    "<main keep>{}</main>",
    "<main><article keep>{}</article></main>",
    "<div id='content' class='content' keep>{}</div>",
    "<div class='post entry article-body' keep>{}</div>",
    "<section keep>{}</section>",
    "<div role='main' class='main' keep>{}</div>",
    "<div class='story text page' keep>{}</div>",
    "<div keep>{}</div>",
    "<div class='container wrapper'><div keep>{}</div></div>",
    "<article class='post' keep><div>{}</div></article>",
]

SURROUNDINGS = [
    f"<nav drop>{_MENU}</nav>",
    "<footer drop>&copy; site &middot; words about it</footer>",
    "<div class='ad' drop>Buy this now.</div>",
    "<div class='ad' drop><p>Buy one today.</p></div>",
    "<div class='ad ads advert' drop><p>Offers of the week</p><p><a href='/o'>See them</a></p></div>",
    f"<nav class='menu navbar navigation' drop>{_MENU}</nav>",
    f"<header drop><h1>Site</h1><p>Slogan</p>{_MENU}</header>",
    "<header class='site-header masthead' drop><p>Paper of record</p></header>",
    f"<aside drop><h3>More</h3><p>Words beside it.</p>{_MENU}</aside>",
    "<aside class='sidebar widget' drop><p>About the writer</p></aside>",
    f"<div id='sidebar' class='sidebar side widget' drop><p>Popular now</p>{_MENU}</div>",
    f"<div id='nav' class='nav menu topbar' drop>{_MENU}</div>",
    "<div id='footer' class='footer copyright bottom' drop><p>All rights reserved.</p></div>",
    f"<footer drop><p>Contact us</p>{_MENU}</footer>",
    "<div class='cookie notice consent gdpr' drop><p>We use cookies.</p><button>OK</button></div>",
    "<div class='notice alert warning message' role='alert' drop><p>Your browser is old.</p></div>",
    "<section class='notice' drop><p>We have moved.</p></section>",
    "<p class='notice' drop>Read our new terms.</p>",
    "<div class='banner advert advertisement ads sponsored sponsor promo promotion' drop><p>Sale today.</p></div>",
    "<aside class='ad advert' drop>Advertisement</aside>",
    "<p class='ad' drop>Sponsored words.</p>",
    f"<form drop>{_FORM}<p>No spam.</p></form>",
    f"<form class='newsletter search' drop>{_FORM}</form>",
    f"<div class='subscribe signup login newsletter' drop><p>Join us</p><form>{_FORM}</form></div>",
    "<div class='search' role='search' drop><form><input><p>Find</p></form></div>",
    f"<section class='comments' id='comments' drop>{_COMMENTS}<article class='comment'><p>Nice.</p></article></section>",
    f"<div class='comments discussion responses' drop>{_COMMENTS}<form>{_FORM}</form></div>",
    "<ol class='commentlist comment' drop><li><p>Great text.</p></li><li class='comment'><p>No.</p></li></ol>",
    "<div class='comment' drop><b>Reader</b><p>I agree.</p></div>",
    f"<div class='related recommended popular more' drop><h3>See also</h3>{_MENU}</div>",
    "<div class='share social sharing' drop><a href='t'>Tweet</a> <a href='f'>Post</a></div>",
    "<div class='breadcrumb breadcrumbs crumbs' drop><a href='/'>Home</a> <a href='/x'>X</a></div>",
    "<div class='pagination pager' drop><a href='2'>2</a> <a href='3'>3</a></div>",
    "<div class='popup modal overlay' role='dialog' drop><p>Wait, read this first.</p></div>",
    "<dialog drop><p>Hello</p></dialog>",
    "<noscript drop><p>No script here</p></noscript>",
    "<script drop>var t='x';</script>",
    "<style drop>p{}</style>",
    "<div class='disclaimer legal terms' drop><p>No advice.</p></div>",
    "<div role='complementary' drop><p>Side</p></div>",
    "<div role='contentinfo' drop><p>Info</p></div>",
    f"<div role='navigation' drop>{_MENU}</div>",
    "<button drop>Press</button>",
    "<template drop><p>t</p></template><svg drop><text>s</text></svg><iframe drop>f</iframe>",
]


def labelled_pages() -> list[str]:
    """Each surrounding before, behind and inside of articles, and articles without any."""
    pages = []
    n = len(SURROUNDINGS)
    for i in range(n):
        article = ARTICLES[i % len(ARTICLES)]
        part = PARTS[i % len(PARTS)]
        around = [SURROUNDINGS[(i * 5 + 7 * j) % n] for j in range(3)]
        pages.append(f"<html>{HEADS[i % 3]}<body>{SURROUNDINGS[i]}{article.format(part)}{around[0]}{around[1]}</body></html>")
        inside = part.replace("</p>", "</p>" + SURROUNDINGS[i], 1)
        pages.append(f"{HEADS[(i + 1) % 3]}<body>{around[2]}{ARTICLES[(i + 3) % len(ARTICLES)].format(inside)}{around[1]}</body>")
    for article in ARTICLES:
        for part in PARTS:
            pages.append(f"<body>{article.format(part)}</body>")
    for part in PARTS:
        pages += [f"<body keep>{part}</body>", f"<html><body keep>{part}</body></html>", f"<body keep>{part}{SURROUNDINGS[0]}{SURROUNDINGS[1]}</body>"]
        pages += [f"<div keep>{part}</div>", "<p keep>Text</p><p keep>More text</p>", "<b keep>Words</b><i keep>alone</i>"]
    return pages
