import random
import time

import pytest

from depscope.llm import extract, quotes

LONG = "A sentence with commas, clauses, and some length to it. " * 6

CASES = [
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b<div>c</div>", "a b c"), ("<script>var a='<p>x';</script><style>p{}</style>", ""),
    ("<p>a &lt;b&gt; &amp;&#233; &nbsp; c</p>", "a <b> &é c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<p>in<b>line</b> te<i>x</i>t<br>next", "inline text next"), ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"), ("a < b and c > d", "a < b and c > d"),
    (f"<body><nav><a href=x>menu</a></nav><div class='ad'>buy</div><article><h1>T</h1><p>{LONG}</p></article><footer>f</footer></body>", f"T {LONG}".strip()),
    (f"<main><h1>T</h1><div class=content><p>{LONG}</p><p>{LONG}</p></div><aside>s</aside></main>", " ".join(f"T {LONG} {LONG}".split())),
    (f"<body><div id=sidebar>{LONG}</div><div id=story><p>{LONG}</p><p>short</p></div><div class='comments'><p>{LONG}</p></div>", f"{LONG}short"),
    (f"<div><p>{LONG}</p></div><div><ul><li><a href=1>{LONG}</a></li></ul></div>", LONG.strip()),
    (f"<article><p>{LONG}</p><form><p>sign up</p></form><section class='reader-comments'><p>{LONG * 3}</p></section></article>", LONG.strip()),
    (f"<div role=navigation>{LONG}</div><p hidden>{LONG}</p><p style='display: none'>x</p><article><p>kept, text</p></article>", "kept, text"),
    ("<p>İİİ<script>var a = '</scriptx>';</SCRIPT >b</p>", "İİİb"),
    (f"<div class='article-with-sidebar'><p>{LONG}</p></div>", LONG.strip()), ("<div>" * 3000 + "deep", "deep"), ("<" * 5000, "<" * 5000),
]


@pytest.mark.parametrize("page, text", CASES, ids=range(len(CASES)))
def test_main_text(page, text):
    assert extract.main_text(page) == text


PART = "<p>" + "word and word, " * 4 + "word " * 48 + "</p>"
SHORT = "<p>" + "a few, " + "words " * 24 + "</p>"
LINKS = "<div><a href=1>one link</a> <a href=2>another link</a></div>"

DIVISIONS = [
    (f"<body><div id=content><div class=section>{PART * 3}</div><div class=section>{SHORT * 2}</div></div></body>", PART * 3 + SHORT * 2),
    (f"<body><div id=content>{PART.replace('p>', 'div>') * 2}{SHORT.replace('p>', 'div>')}<div>end</div></div></body>", PART * 2 + SHORT + " end"),
    (f"<div><div><div>{PART * 3}</div>{LINKS}</div><div><div>{SHORT}</div></div></div>", PART * 3 + SHORT),
    (f"<div>first words<div>{PART * 3}</div>last <b>words</b>{LINKS}</div>", "first words" + PART * 3 + " last words"),
    (f"<div><a href=1>one</a> | <a href=2>two</a><div>{PART * 3}</div></div><div>{SHORT}</div>", PART * 3 + SHORT),
    (f"<div><article>{PART * 3}</article><div>{SHORT}</div>{LINKS}</div><div>outside</div>", PART * 3 + SHORT),
]


NAMED = [
    f"<article class='post has-comments'><p>{LONG}</p></article>", f"<div class='content comments-open'><p>{LONG}</p></div>",
    f"<main id=main class=social><p>{LONG}</p></main>", f"<div class='ad-free reading'><p>{LONG}</p></div>",
    f"<div class=comments><p>{LONG}</p></div><p>few words</p>", f"<div id=text><p>{LONG}</p></div><div id=bottom>Copyright somebody</div>",
    f"<div id=text><p>{LONG}</p></div><div id=discussion><p>{LONG}</p><p>{LONG}</p></div>", f"<div id=text><p>{LONG}</p></div><div id=credits>All rights</div>",
    f"<article><p>{LONG}</p><div class='article-comments'><p>{LONG * 3}</p></div></article>",
]


@pytest.mark.parametrize("page", NAMED, ids=range(len(NAMED)))
def test_words_in_class_and_id(page):
    """A word lowers a score; it costs no article, and brings no comments in."""
    assert extract.main_text(page).removesuffix(" few words") == LONG.strip()


def test_formula_stays():
    assert extract.main_text(f"<article><p>{LONG}<math><mi>x</mi></math></p></article>") == LONG + "x"


BROKEN = {"open tags": "<a " * 350_000, "open quote": "<a x " * 200_000 + "\">", "open spans": "<span>x</div>" * 80_000,
          "stopped": "<b><div>" + "<span>x" * 50_000 + "</b>" * 50_000, "bodies": "<head>" + "<i>" * 50_000 + "<body>" * 50_000,
          "comments": "<!-- " * 200_000, "signs": "<" * 1_000_000, "suspects": "<p class=ad>x" * 50_000, "nested": "<div class=ad>x" * 50_000}


@pytest.mark.parametrize("page", BROKEN.values(), ids=BROKEN)
def test_long_broken_pages(page):
    begin = time.monotonic()
    extract.main_text(page)
    assert time.monotonic() - begin < 12  # a quadratic reader takes minutes


def test_very_long_page():
    assert extract.main_text(f"<article>{f'<p>{LONG}</p>' * 5000}</article>") == " ".join([LONG.strip()] * 5000)


@pytest.mark.parametrize("page, text", DIVISIONS, ids=range(len(DIVISIONS)))
def test_divisions(page, text):
    """What is no block of links stays, however short it is beside the best part."""
    assert extract.main_text(page) == " ".join(text.replace("<p>", " ").replace("</p>", " ").split())


def test_sample_pages(llm):
    """The sample pages have one template, which a plain pattern can cut."""
    import html
    import re
    pages = llm.read.parquet("/root/testdata/sf0.001/pages.parquet")
    text = {r.page_id: (r.text, r.n_chars) for r in extract.extract(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"</?b>", "", re.sub(r"</?p>|</?h1>|<br>", " ", re.search("<article>(.*?)</article>", r.html, re.S)[1]))
        want = " ".join(html.unescape(body).split())
        assert text[r.page_id] == (want, len(want))


def test_pages_messy(llm):
    rows = [(1, "u", "<p>a</p>", "clash"), (1, "u", "<p>a</p>", "clash"), (None, None, None, None), (2, "v", "", "x")]
    df = llm.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(map(str, extract.extract(df).collect())) == sorted(
        f"Row(page_id={p}, url={u!r}, text={t!r}, n_chars={len(t)})" for p, u, t in ((1, "u", "a"), (1, "u", "a"), (None, None, ""), (2, "v", "")))
    assert extract.extract(df.limit(0)).count() == 0


CHAT = [
    (1, 0, "user", "Hello there.\nHow do I sort a list?\n\nThanks a lot"), (1, 1, "assistant", "> How do I sort a list?\n\nUse sorted()."),
    (1, 2, "user", "something else"), (1, 3, "assistant", "> > How do I  SORT a list?\n> Use sorted().\n\nIndeed it works"),
    (1, 4, "user", "> never said\nok"), (1, 5, "user", ">> Hello there.\n>> How do I sort a list?\n>> \n>> Thanks a lot\nback to that"),
    (None, 0, "user", None), (None, 0, "user", None), (1, None, "user", "> Hello there.\nx"), (2, 300, "a", "z"), (2, 5, "a", "y"), (2, 5, "a", "y"),
    (2, 900, "a", "> y\n>\n> z\nw"), (3, 1, None, ""), (4, 0, "a", "> y\nother conversation"),
]


def test_replies(llm):
    df = llm.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").repartition(3)
    got = sorted((tuple(r) for r in quotes.reply_ordered(df).collect()), key=str)
    want = sorted([
        (1, 0, None, "user", "x", None, 1, 0), (1, 1, 0, "user", "Hello there.\nHow do I sort a list?\n\nThanks a lot", None, 0, 0),
        (1, 2, 1, "assistant", "Use sorted().", 0, 1, 1), (1, 3, 2, "user", "something else", 1, 0, 0),
        (1, 4, 3, "assistant", "Indeed it works", 1, 2, 2), (1, 5, 4, "user", "ok", 3, 1, 0), (1, 6, 5, "user", "back to that", 0, 2, 2),
        (None, 0, 0, "user", None, None, 0, 0), (None, 1, 0, "user", None, 0, 0, 0), (2, 0, 5, "a", "y", None, 0, 0), (2, 1, 5, "a", "y", 5, 0, 0),
        (2, 2, 300, "a", "z", 5, 0, 0), (2, 3, 900, "a", "w", 5, 2, 2), (3, 0, 1, None, "", None, 0, 0), (4, 0, 0, "a", "other conversation", None, 1, 0),
    ], key=str)
    assert got == want


def test_replies_by_shuffled_joins(llm, monkeypatch):
    df = llm.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    usual = sorted(map(str, quotes.reply_ordered(df).collect()))
    monkeypatch.setattr(quotes, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(quotes, "BLOCK_TURNS", 2)
    assert sorted(map(str, quotes.reply_ordered(df).collect())) == usual


def test_crowded_blocks(llm, monkeypatch):
    """Many messages without a conversation share a few turns; many are alike."""
    rng = random.Random(4)
    rows = [(None, rng.choice([None, 0, 1, 2, 300]), rng.choice(["user", "assistant"]), rng.choice(["ok", "> ok\nyes", None, "text"]) if k % 3 else f"m {k}")
            for k in range(900)]
    rows += [r for r in CHAT if r[0] is not None] + [(None, 1, "user", "ok")] * 400
    df = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    usual = sorted(map(str, quotes.reply_ordered(df).collect()))
    monkeypatch.setattr(quotes, "BLOCK_ROWS", 50)
    assert sorted(map(str, quotes.reply_ordered(df).collect())) == usual and len(usual) == len(rows)
    known = [r for r in quotes.reply_ordered(df).collect() if r.conv_id is None]
    assert sorted(r.position for r in known) == list(range(len(known)))


def test_replies_messy(llm):
    df = llm.createDataFrame([(*r, "clash", 1) for r in CHAT], "conv_id long, turn long, role string, text string, position string, block int")
    assert quotes.reply_ordered(df).count() == len(CHAT)
    assert quotes.reply_ordered(df.limit(0)).count() == 0


def test_long_conversation(llm):
    rows = [(1, k, "u", f"message {k}" if k % 50 else f"> message {k // 2 + 1}\nsee {k}") for k in range(1, 1200)]
    got = {r.turn: r for r in quotes.reply_ordered(llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[k].position for k in range(1, 1200)] == list(range(1199))
    assert all(got[k].reply_to == (k - 1 if k % 50 or (k // 2 + 1) % 50 == 0 else k // 2 + 1) for k in range(2, 1200))
