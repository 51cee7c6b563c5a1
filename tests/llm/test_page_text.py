import pytest

from tamizal.llm.page_text import main_text, page_texts

LONG = "A paragraph of the article, with some commas, that is long enough to be scored as text of a page."
CASES = [
    ("", ""),
    ("<body><nav>menu</nav><footer>foot</footer></body>", ""),
    ("a < b and c > d", "a < b and c > d"),
    ("<p>a<!-- c -->b</p>", "ab"),
    ("<p title='>'>q &lt;b&gt; &amp;amp; &eacute;&nbsp;x</p>", "q <b> &amp; é x"),
    ("<script>var a='</p><p>x</p>'</script><p>ok</p>", "ok"),
    (f"<div id=c><p>{LONG}</p><p>{LONG}</p></div><div class='comments'><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<article><h1>T</h1><p><b>{LONG}<br><p>two\n  lines</article><div class=ad>{LONG}</div>", f"T {LONG} two lines"),
    (f"<div><a href=x>{LONG}</a><a href=y>{LONG}</a></div><div><p>{LONG}</p></div>", LONG),
    (f"<section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>{LONG}</p></section>", f"A {LONG} B {LONG}"),
    ("<main><div class='cookie-notice'>we use</div><h2>H</h2><ul><li>one<li>two</ul><form>q</form></main>", "H one two"),
    ("<main><ul><li><a href=a>one</a><li><a href=b>two</a></ul><p>text</p></main>", "text"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert main_text(page) == text


TWO = f"<p>{LONG}</p><p>{LONG}</p>"
SIDE = f"<div class=sidebar><p>{LONG}</p></div>"
WRAPPERS = [
    f"<body><div class='layout has-sidebar'><article>{TWO}</article>{SIDE}</div></body>",
    f"<body><div class='page with-ads'><div class='content-with-menu'>{TWO}</div><div class=ad>{LONG}</div></div></body>",
    f"<div class='post no-comments'><main>{TWO}</main></div>{SIDE}",
    f"<div id='main-widget'>{TWO}</div>",
    f"<main><article class='post promoted'>{TWO}</article></main>{SIDE}",
    f"<main><div class='layout has-sidebar'><article>{TWO}</article></div><div class=comments>{TWO}{TWO}</div></main>",
    f"<article>{TWO}</article><div id=comments><article class='comment'>{TWO}{TWO}</article></div>",
    f"<article>{TWO}<article class='comment'><p>{LONG}</p></article></article>",
    f"<div class='with-ads'>{TWO}<div class=comments>{TWO}</div></div>",
]


@pytest.mark.parametrize("page", WRAPPERS)
def test_layout_around_the_article_is_no_mark(page):
    assert main_text(page) == f"{LONG} {LONG}"


SHORT = "A few words."
PROBES = [  # ordinary pages whose article must come out whole
    (f"<article><p>{LONG}</p><div class='social-history'><p>{LONG}</p></div></article>", f"{LONG} {LONG}"),
    (f"<article><p class='share-price'>{LONG}</p><p>{LONG} <span class='related'>with this</span> too.</p></article>", f"{LONG} {LONG} with this too."),
    (f"<div><article>{TWO}</article><article>{TWO}</article></div>{SIDE}", " ".join([LONG] * 4)),
    (f"<body><section>{TWO}</section><section><h2>B</h2>{TWO}</section><section><h2>End</h2><p>{SHORT}</p></section></body>", f"{LONG} {LONG} B {LONG} {LONG} End {SHORT}"),
    (f"<article><header><h1>T</h1><p>{SHORT}</p></header>{TWO}</article>", f"T {SHORT} {LONG} {LONG}"),
    (f"<div id=x><div class='story'>{TWO}</div><div>{SHORT}</div><div>{TWO}</div></div>", f"{LONG} {LONG} {SHORT} {LONG} {LONG}"),
    (f"<body><header><p>{LONG}</p></header><article>{TWO}</article></body>", f"{LONG} {LONG}"),
]


@pytest.mark.parametrize("page,text", PROBES)
def test_article_comes_out_whole(page, text):
    assert main_text(page) == text


def _made_page(rng):
    """A page drawn from parts, and its article: what is not article stands in parts that say so by kind or name."""
    words = "alfa beta gama delta kappa lamda omega sigma".split()

    def sentence(least, most):
        return " ".join(rng.choice(words) + rng.choice(["", ","]) for _ in range(rng.randint(least, most))) + "."

    texts: list[str] = []

    def article_part():
        kind, text = rng.choice(["p", "p", "p", "h2", "blockquote", "ul", "pair", "note"]), sentence(12, 50)
        if kind == "ul":
            items = [sentence(3, 9) for _ in range(3)]
            texts.extend(items)
            return "<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>"
        if kind == "h2":
            text = sentence(2, 5)
        texts.append(text)
        if kind == "pair":
            return f"<div class='share-price table-{rng.randint(1, 9)}'><p>{text}</p></div>"
        if kind == "note":
            return f"<p class='{rng.choice(['lead', 'social-life', 'with-menu'])}'>{text[:20]}<b>{text[20:30]}</b>{text[30:]}</p>"
        return f"<{kind}>{text}</{kind}>"

    def noise():
        text = sentence(5, 60)
        links = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in words)
        return rng.choice([
            f"<nav><ul>{links}</ul></nav>", f"<aside><p>{text}</p></aside>", f"<div class='sidebar'><p>{text}</p></div>", f"<div id='comments'><div class='comment-7'><p>{text}</p></div></div>",
            f"<div class='ad-slot'>{text}</div>", f"<form>{text}<input></form>", f"<div class='cookie-notice'>{text}</div>", f"<script>var x='<p>{text}</p>'</script>", f"<ul>{links}</ul>",
            f"<div role='navigation'>{text}</div>", f"<footer>{text}</footer>", f"<div class='related posts'><p>{text}</p></div>", f"<!-- {text} -->", f"<div style='display: none'>{text}</div>",
        ])

    open_, shut = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<div class='story-text'>", "</div>"), ("<div class='page has-sidebar'><article>", "</article></div>")])
    first = sentence(60, 90)
    body = [open_, f"<p>{first}</p>"]
    texts.append(first)
    for _ in range(rng.randint(3, 9)):
        body.append(noise() if rng.random() < 0.2 else article_part())
    body.append(shut)
    before, after = ("".join(noise() for _ in range(rng.randint(0, 4))) for _ in range(2))
    return f"<html><head><title>{sentence(2, 4)}</title></head><body>{before}{''.join(body)}{after}</body></html>", " ".join(texts)


def test_made_pages_give_their_articles():
    import random

    for seed in range(400):
        page, text = _made_page(random.Random(seed))
        assert main_text(page) == text, seed


DEEP = [
    "<body>" + "<div>x " * 100_000, "<b>" * 60_000 + "x" + "</i>" * 60_000, "<div>" * 50_000 + "<li>x" * 50_000, "<b><div>" * 30_000 + "</b>" * 30_000, "<p>" + "<i>" * 50_000 + "<p>x" * 50_000,
    "<article>" * 30_000 + "x", "<div>" * 50_000 + "</p>" * 50_000, "<section>" + "<section>x</section>" * 30_000,
]


@pytest.mark.parametrize("page", DEEP, ids=range(len(DEEP)))
def test_time_is_linear_in_depth(page):
    import time

    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 6


def test_heading_tells_what_holds_the_article():
    page = f"<div><p>{LONG}</p></div><div class='grid-sidebar'><h1>T</h1>{TWO}{TWO}</div>"
    assert main_text(page).endswith(f"T {LONG} {LONG} {LONG} {LONG}")


@pytest.mark.parametrize("page", ["<" * 100_000, "<a " * 30_000, "<div>" * 5000 + "x", '<p a="' * 20_000, "&" * 100_000, "<p>x" * 20_000])
def test_broken_and_long_pages_end(page):
    main_text(page)


def test_rows(spark):
    rows = [(i, f"u{i}", p, "x") for i, (p, _) in enumerate(CASES)] + [(98, None, None, None), (None, "u", CASES[6][0], "y"), (0, "u0", "", "x")]
    got = page_texts(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()
    assert len(got) == len(rows) and all(r.text == CASES[r.page_id][1] for r in got if r.page_id is not None and r.page_id < 90)
    assert [r.text for r in got if r.page_id == 98] == [""]
    assert page_texts(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
