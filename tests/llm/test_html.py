import numpy as np
import pytest

from mirrorset.llm import html
from mirrorset.llm.labelled_pages import labelled_pages

CASES = [
    ("<body><header><p>Head</p></header><div class='notice'>N</div><article><h1>T</h1><p>A &amp; B</p><aside>x</aside>"
     "<form><input><button>go</button></form><p>C</p><div class='ad'>ad</div></article>"
     "<section class='comments'><h3>Comments</h3><p>c1</p></section><div class='sidebar'><ul><li>x</li></ul></div>", "T\nA & B\nC"),
    ("<nav><a href=/>Home</a></nav><article><p><b>One<br><p>Two  \n words&nbsp;here</p></article><footer>&copy; x", "One\nTwo words here"),
    ("<article><p>a<br>b</p>tail <i>it</i>alic<p>c</p></article>", "a b\ntail italic\nc"),
    ("<script>if (a<b) '<p>no</p>'</script><article><p>yes</p></article>", "yes"),
    ("<article><p>cut &am <b>off", "cut &am off"),
    ("<article><p>1 < 2 & 3 > 2</p><!-- <p>hidden</p> --></article>", "1 < 2 & 3 > 2"),
    ("<article><p>" + "word " * 50_000 + "</p></article>", ("word " * 50_000).strip()),
    ("<article><p>x</p><ul><li>i<li>j</ul></article>", "x\ni\nj"),
    ("", ""),
    (None, ""),
    ("<nav><a href=/>Home</a></nav>", ""),
]


@pytest.mark.parametrize("source,text", CASES)
def test_main_text(source, text):
    assert html.main_texts([source], html.trained()) == [text]


def test_labelled_pages_are_learned():
    model = html.trained()
    right = 0
    for source in labelled_pages():
        page = html.parse(source, marked=True)
        kept = np.array([m == html.KEEP and t is not None for m, t in zip(model._labels(page), page.text)])
        right += html.main_texts([source], model)[0] == html._written(page, kept)
    assert right / len(labelled_pages()) > 0.95


def test_messages_give_exact_marginals():
    """Against the sum over all states of a small tree."""
    rng = np.random.default_rng(5)
    parent = np.array([0, 0, 0, 1, 1, 2])
    depth = np.array([0, 1, 1, 2, 2, 2])
    unary, pairs = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    total = np.zeros((6, 3))
    for states in np.ndindex(*[3] * 6):
        weight = np.exp(sum(unary[i, s] for i, s in enumerate(states)) + sum(pairs[states[parent[i]], states[i]] for i in range(1, 6)))
        for i, s in enumerate(states):
            total[i, s] += weight
    np.testing.assert_allclose(html.marginals(unary, parent, depth, pairs), total / total.sum(axis=1, keepdims=True))


def test_deep_nesting_and_query_columns(spark):
    deep = "<div>" * 3000 + "<p>deep</p>"
    rows = [(1, "u", deep, 5), (None, None, None, 6), (1, "u", deep, 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = html.extract(pages).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("deep", 4), ("deep", 4)]
    assert html.extract(pages.limit(0)).count() == 0


def test_parsing_is_linear():
    """A megabyte of open elements and of end tags that end nothing."""
    import time

    begun = time.time()
    for source in ("<div>" * 100_000 + "</b>" * 130_000, "<p><table>" + "<div>" * 200_000, "<b>" * 150_000 + "</i></p>" * 50_000):
        assert len(html.parse(source).tag) > 100_000
    assert time.time() - begun < 15


def made_page(seed):
    """A page put together by chance, and its article's text by plain joining."""
    import random

    rng = random.Random(seed)
    word = lambda: rng.choice(["stone", "river", "ünder", "日本", "a &amp; b", "paper", "x&lt;y", "cloud", "12", "it's"])
    say = lambda n: " ".join(word() for _ in range(rng.randint(1, n)))
    plain = lambda s: s.replace("&amp;", "&").replace("&lt;", "<")
    blocks, lines = [], []

    def block(tag, text):
        blocks.append(f"<{tag}>{text}</{tag}>")
        lines.append(plain(text))

    block("h1", say(5))
    for _ in range(rng.randint(2, 7)):
        kind = rng.randrange(5)
        if kind == 0:
            block("h2", say(4))
        elif kind == 1:
            items = [say(4) for _ in range(rng.randint(1, 4))]
            linked = rng.random() < 0.4
            blocks.append("<ul>\n" + "".join(f"<li>{f'<a href=/{i}>{t}</a>' if linked else t}</li>\n" for i, t in enumerate(items)) + "</ul>")
            lines.extend(map(plain, items))
        elif kind == 2:
            first, link, last = say(6), say(2), say(6)
            blocks.append(f"<p>{first} <a href='/l'>{link}</a> <em>{last}</em></p>")
            lines.append(plain(f"{first} {link} {last}"))
        else:
            block("p", say(30))
    between = rng.choice(["", "<div class='ad'><p>Buy now</p></div>", "<aside class='sidebar'><p>Read also</p></aside>", "<script>var a = '<p>no</p>';</script>"])
    at = rng.randrange(1, len(blocks))
    article = "\n".join([*blocks[:at], between, *blocks[at:]])
    head = rng.choice(["", "<head><title>Site</title><style>p{color:red}</style></head>"])
    menu = rng.choice(["<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>", "<header><a href=/>Logo</a></header>", ""])
    tail = rng.choice(["<footer><p>© Site</p></footer>", "<section class='comments'><h3>2 comments</h3><p>First!</p></section><footer>Imprint</footer>", ""])
    wrap = rng.choice(["<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>"])
    return f"<html>{head}<body>{menu}{wrap.format(article)}{tail}</body></html>", "\n".join(lines)


def test_pages_with_known_articles():
    pages = [made_page(seed) for seed in range(300)]
    got = html.main_texts([source for source, _ in pages], html.trained())
    assert [i for i, (text, (_, want)) in enumerate(zip(got, pages)) if text != want] == []


@pytest.mark.parametrize("tag", ["article", "main"])
def test_linked_lists_of_an_article_stay(tag):
    source = f"<nav><ul><li><a href=/>Home</a></li></ul></nav><{tag}><ul><li><a>one</a></li><li><a>two</a></li></ul></{tag}>"
    assert html.main_texts([source], html.trained()) == ["one\ntwo"]
