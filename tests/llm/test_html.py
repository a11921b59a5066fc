import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkmill.llm import html

WORDS = "the quick brown fox jumps over the lazy dog while seven old sailors watch a silver moon rise above quiet hills".split()


def prose(n: int, seed: int = 0) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


A, B, C = prose(60, 1), prose(50, 2), prose(70, 3)
MENU = "<nav><ul><li><a href=#>Home</a></li><li><a href=#>About</a></li></ul></nav>"

LAYOUTS = {
    "article": (f"<body>{MENU}<div class=ad>{prose(9)}</div><article><h1>Title</h1><p>{A}</p><p>{B}</p></article><footer>{prose(30)}</footer></body>", ["Title", A, B]),
    "divs without an article": (f"<body><div id=top><a href=1>One</a> <a href=2>Two</a></div><div class=content><h2>Head</h2><p>{A}</p><p>Short one.</p><p>{B}</p></div><div id=foot><a href=3>Imprint</a></div></body>", ["Head", A, "Short one.", B]),
    "two articles": (f"<body>{MENU}<article><p>{A}</p><p>{B}</p></article><article><p>{C}</p></article></body>", [A, B, C]),
    "comments of readers": (f"<body><article><p>{A}</p><p>{B}</p><p>{C}</p></article><div class=comments><div class=comment><p>{prose(12)}</p></div></div></body>", [A, B, C]),
    "a page in a form": (f"<body><form><div><p>{A}</p><p>{B}</p></div><label>Name</label><input></form></body>", [A, B]),
    "a class that only mentions a sidebar": (f"<body><div class='content has-sidebar'><p>{A}</p><p>{B}</p></div></body>", [A, B]),
    "paragraphs in containers of their own": (f"<body><div><div><p>{A}</p></div><div><p>So.</p></div><div><p>{B}</p></div></div></body>", [A, "So.", B]),
    "a list of links inside": (f"<body><article><p>{A}</p><p>{B}</p><ul><li><a href=1>{prose(3)}</a></li><li><a href=2>{prose(4)}</a></li></ul></article></body>", [A, B]),
    "a list of the text": (f"<body><article><p>{A}</p><ul><li>one</li><li>two</li></ul><p>{B}</p></article></body>", [A, "one", "two", B]),
}


@pytest.mark.parametrize("name", sorted(LAYOUTS))
def test_layout(name):
    page, blocks = LAYOUTS[name]
    assert html.main_text(page) == "\n\n".join(blocks)


def test_the_smoothed_ratios_decide():
    page, blocks = LAYOUTS["article"]
    lines = html.lines_of(page)
    level = html.smoothed(html.text_to_tag(lines))
    text = lambda x: [lines[i].text for i in html.content_lines(lines, x)]
    assert text(level) == blocks
    assert text(np.ones(len(lines))) != blocks
    falling = level.max() - level
    assert text(falling) != blocks


def test_ratio_kernel_and_threshold_by_hand():
    lines = html.lines_of(f"<p>{'x' * 40}</p><p><a href=#>{'y' * 40}</a></p><script>{'z' * 999}</script><article><p>{'w' * 30}</p></article>")
    shown = [(x.text[:1], x.tags) for x in lines if x.text]
    ratios = html.text_to_tag(lines)
    want = []
    for x in lines:
        if x.at is None:
            want.append(0.0)
        else:
            want.append((4.0 if x.text[:1] == "w" else 1.0) * len(x.text) / max(1, x.tags))
    assert shown[0][0] == "x" and ratios.tolist() == pytest.approx(want)
    assert dict(shown)["y"] == 1 + 3 + 3 + 1 and ratios.max() == pytest.approx(max(want))
    e = [np.exp(-k * k / 2) for k in (-2, -1, 0, 1, 2)]
    by_hand = [sum(e[k + 2] / sum(e) * want[i + k] for k in range(-2, 3) if 0 <= i + k < len(want)) for i in range(len(want))]
    assert html.smoothed(ratios).tolist() == pytest.approx(by_hand)


BROKEN = ["<![foo bar[ x ]]>", "<![CDATA[ x ]]> y", "<!doctype", "<!", "<!-", "<!--", "</", "</>", "<a <b", "<p a='", "&#xffffffff;&#0;&bogus;&amp", "<script>x", "<![if IE]>t<![endif]>", "<?xml", "\x00<p>\ud800</p>"]


@pytest.mark.parametrize("bad", BROKEN)
def test_broken_html(bad):
    html.main_text(bad)
    assert A in html.main_text(f"<p>{A}</p>{bad}") or "<!--" in bad
    html.main_text(f"{bad}<p>{A}</p>")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/![]-='\"&;# apdivscript\n", max_size=60))
def test_any_text_is_a_page(page):
    html.main_text(page)


def test_deep_and_long_pages_take_linear_time():
    start = time.perf_counter()
    assert html.main_text("<div>" * 50_000 + A) == A
    assert html.main_text("<div>" * 20_000 + A + "</p></span></div>" * 20_000) == A
    assert len(html.main_text(f"<p>{A}</p>" * 20_000)) == 20_000 * (len(A) + 2) - 2
    assert time.perf_counter() - start < 20


NEED = "page_id long, url string, html string, TEXT long, n_chars string, `o.w``n` int"


def test_every_row_of_any_table(spark):
    page = LAYOUTS["article"][0]
    rows = [(1, "u", page, 1, "n", 5), (1, "u", page, 1, "n", 5), (None, None, None, None, None, None), (2, "v", "", 2, "", 6), (3, "w", "<![foo bar[ x ]]>", 3, "", 7)]
    got = html.extract(spark.createDataFrame(rows, NEED)).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == sorted([("1", "\n\n".join(LAYOUTS["article"][1]))] * 2 + [("None", ""), ("2", ""), ("3", "")])
    assert got[0].asDict().keys() == {"page_id", "url", "text", "n_chars", "o.w`n"}
    assert html.extract(spark.createDataFrame([], NEED)).collect() == []


ARTICLE_TEXT = "The harbour was quiet when the first boats came in, and nobody on the pier spoke of the storm that had passed in the night."


def comments(n, kind="entry", head="p"):
    return "".join(f'<div class={kind}><{head}>Reader {i}</{head}><p>I was there in the year {i} and saw all of it from the hill, a long time before it was in any paper, believe me.</p></div>' for i in range(n))


@pytest.mark.parametrize("article", ["<article><h1>Boats</h1><p>{}</p></article>", "<div class=text><h1>Boats</h1><p>{}</p></div>"])
def test_comments_without_a_telling_name_are_left_out(article):
    page = f"<html><body>{article.format(ARTICLE_TEXT)}<section id=discussion>{comments(30)}</section></body></html>"
    assert html.main_text(page) == f"Boats\n\n{ARTICLE_TEXT}"


def test_sections_alike_are_no_comments():
    parts = "".join(f"<div class=part><h2>Part {i}</h2><p>{ARTICLE_TEXT}</p></div>" for i in range(4))
    got = html.main_text(f"<html><body><div class=intro><p>{ARTICLE_TEXT}</p></div><div>{parts}</div></body></html>")
    assert got.count(ARTICLE_TEXT) == 5 and "Part 3" in got
    plain = "".join(f"<div class=part><p>{ARTICLE_TEXT}</p><p>{ARTICLE_TEXT}</p></div>" for _ in range(4))
    assert html.main_text(f"<html><body><div class=intro><p>{ARTICLE_TEXT}</p></div><div>{plain}</div></body></html>").count(ARTICLE_TEXT) == 9
    alone = html.main_text(f"<html><body><div>{comments(5)}</div></body></html>")  # nothing else is content
    assert alone.count("Reader") == 5


def test_a_box_in_a_doubtful_article_stays_out():
    body = f"<div class=comments-open><h1>Boats</h1><p>{ARTICLE_TEXT}</p><p>{ARTICLE_TEXT}</p><div class=widget><p>Our letter brings you the best of the week, every week, at no cost.</p></div><p>{ARTICLE_TEXT}</p></div>"
    got = html.main_text(f"<html><body>{body}</body></html>")
    assert got.count(ARTICLE_TEXT) == 3 and "letter" not in got


def test_smoothing_decides():
    # one long line alone among short ones of links has a high ratio, which the lines around it take down
    links = "".join(f"<div><a href=x>More {i}</a> <a href=y>and {i}</a></div>" for i in range(6))
    notice = "<div>" + "All rights to these pages and what is on them are with their owners. " + "</div>"
    page = f"<html><body><div class=text>{''.join(f'<p>{ARTICLE_TEXT}</p>' for _ in range(6))}</div>{links}{notice}{links}</body></html>"
    lines = html.lines_of(page)
    ratios = html.text_to_tag(lines)
    text = lambda level: "\n".join(lines[i].text for i in html.content_lines(lines, level))
    assert "rights" not in text(html.smoothed(ratios)) and "rights" in text(ratios) and html.main_text(page).count(ARTICLE_TEXT) == 6
