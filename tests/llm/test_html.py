import random

import pytest

from skillscope.llm.html_text import extract_pages, main_text

LONG = "A paragraph of text that is long enough to pass the threshold of a surge, for certain."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>abc", "abc"), ("<script>x</script>", ""), ("<nav>menu</nav>", ""),
    ("<article><h1>T</h1><p>a &amp; b&nbsp; c\n d</p></article>", "T\na & b c d"),
    ("<nav>m</nav><main><p>one<br>two</p><aside>s</aside><p>three</main><footer>f", "one two\nthree"),
    ("<article><p>a<b>b</b>c</p><div class='comments'><p>First!</p></div></article>", "abc"),
    ("<article><p>a<!-- <p>no --></p><style>p{}</style><script>'</p>'</script><form>f<input></form>b</article>", "a\nb"),
    (f"<header>h</header><div id=cookie-notice>{LONG}</div><h2>Head</h2><p>{LONG}</p><p>short</p><ul class=menu><li><a href=x>Home</a></ul>",
     f"Head\n{LONG}\nshort"),
    ("<article><p>x &lt;b&gt; &#233;&amp", None),
    (f"<div role=navigation>{LONG}</div><div><p>{LONG}", LONG),
    ("<article><p>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"),
])
def test_pages(page, text):
    assert main_text(page) == ("x <b> é&" if text is None else text)


def test_long_and_broken_markup_is_linear():
    for page in ("<a title=\"" * 50_000, "<" * 300_000, "<b>" * 50_000 + "x", "<div class='ad'>" * 2000 + "x" + "</div>" * 2000):
        main_text(page)


def test_rows(spark):
    rows = [(1, "u", "<p>" + "é " * 9 + "x"), (None, None, None), (1, "u", "<p>b"), (1, "u", "<p>b")]
    made = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, text int")
    got = sorted(map(tuple, extract_pages(made).collect()), key=str)
    assert got == sorted([(1, "u", "é " * 9 + "x", 19), (None, None, "", 0), (1, "u", "b", 1), (1, "u", "b", 1)], key=str)
    assert extract_pages(made.limit(0)).count() == 0


def line_blocks(weights, named, window=3, least=60):
    """Numbers of the lines from each surge up to its dive, looked for from every line anew."""
    def total(i):
        return sum(w for k, w in enumerate(weights) if i <= k < i + window)
    kept, i = [], 0
    while i < len(weights):
        dive = next((k for k in range(i + 1, len(weights)) if total(k) == 0), len(weights))
        surges = [k for k in range(i, dive) if weights[k] and total(k) >= least]
        if weights[i] and surges:
            kept += range(i if named else surges[0], dive)
        i = dive if weights[i] else i + 1
    return kept


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_line_blocks_by_brute_force(wrap):
    rng, cut = random.Random(7), 0
    for _ in range(300):
        texts = [(rng.choice(["p", "a", "a", "a"]), "x" * rng.choice([3, 10, 25, 70])) for _ in range(rng.randint(4, 25))]
        texts.insert(rng.randrange(len(texts)), ("p", "y" * 60))
        page = wrap.format("".join(f"<p>{t}</p>" if tag == "p" else f"<p><a href=x>{t}</a></p>" for tag, t in texts))
        kept = line_blocks([len(t) if tag == "p" else 0 for tag, t in texts], "div" not in wrap)
        assert main_text(page) == "\n".join(texts[i][1] for i in kept)
        cut += len(kept) < len(texts)
    assert cut > 200


def test_links_inside_the_content_element_are_cut():
    more = "".join(f"<li><a href=/{i}>Another story {i}</a></li>" for i in range(5))
    assert main_text(f"<article><h1>T</h1><p>{LONG}</p><ul>{more}</ul><p>{LONG}</p><ul>{more}</ul></article>") == f"T\n{LONG}\n{LONG}"
    assert main_text(f"<article><h1>T</h1><p>By X</p><p>May</p><p>{LONG}</p><ul>{more}</ul><p>short</p></article>") == f"T\nBy X\nMay\n{LONG}"
    assert main_text("<article><p>a</p><p>bb</p><p>c</p><p>ddd</p></article>") == "a\nbb\nc\nddd"
    assert main_text("<article><p><a href=x>only a link</a></p></article>") == "only a link"


@pytest.mark.parametrize("page, text", [
    # Only an attribute named hidden hides.
    (f"<article style='overflow:hidden'><p>{LONG}</p></article>", LONG),
    (f"<div title='Hidden costs'><article><p>{LONG}</p></article></div>", LONG),
    (f"<div title='a class=ad b'><p>{LONG}</p></div>", LONG),
    (f"<article><p hidden>secret</p><p HIDDEN=until-found>secret</p><p>{LONG}</p></article>", LONG),
    # A name does not exclude what holds the content.
    *[(f"<nav>n</nav><div class='{c}'><div id='sidebar'>{LONG} no</div><article class='x-share'><p>{LONG}</p>"
       f"<div class=comments>{LONG} no</div></article></div>", LONG)
      for c in ("content has-sidebar", "with-header", "post-share-enabled")],
    (f"<div class='content has-sidebar'><p>{LONG}</p><p>b</p><div class=ad>no</div></div>", f"{LONG}\nb"),
    (f"<form id=page><article><p>{LONG}</p><form>no</form></article></form>", LONG),
    (f"<article><p>{LONG}</p></article><div class=related><article><p>{LONG} no</p></article></div>", LONG),
    # The head ends where the body starts.
    (f"<html><head><title>t</title><meta charset=x><body><p>{LONG}</p>", LONG),
    (f"<head id=header class=hidden><title>t</title><link href=x><article><p>{LONG}</p></article>", LONG),
    (f"<head><title>t</title><style>p</style></head><p>{LONG}</p>", LONG),
    # Self-closing tags end at once, also after quoted marks.
    *[(f"<article><p>a</p>{tag}<p>{LONG}</p></article>", f"a\n{LONG}")
      for tag in ("<svg width='1' />", "<svg/>", "<iframe src='x'/>", "<textarea/>", "<svg aria-label='a>b'/>", "<iframe allowfullscreen/>")],
    (f"<article><script src=/a/>no</script><iframe src=http://x/>no</iframe><p>{LONG}</p></article>", LONG),
])
def test_ordinary_markup_loses_no_article(page, text):
    assert main_text(page) == text
