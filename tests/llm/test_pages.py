"""Pages whose article is known: the query on planted pages, what scores decide, deep and broken pages."""

from __future__ import annotations

import random
import time

import pytest

from airshed.llm import html, queries

TEXTS = [f"Sentence {i} tells something of its own, at some length; then it ends." for i in range(6)]
LINKS = '<ul class="x">' + "".join(f'<li><a href="/{i}">Another page {i}</a></li>' for i in range(6)) + "</ul>"


def paragraphs(texts) -> str:
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("wrap", [
    "<article>{}</article>", "<main><div>{}</div></main>", "<div class='story'>{}</div>",
    "<form action='/'><div>{}</div></form>", "<form><fieldset><article>{}</article></fieldset></form>",
    "<form><div class='has-sidebar'><main>{}</main></div></form>"])
def test_link_lists_and_forms(wrap):
    """A list of links goes, in the article and beside it; a form around the whole page does not hide it."""
    want = "\n\n".join(["Title", *TEXTS])
    inner = f"<h1><a href='/'>Title</a></h1>{paragraphs(TEXTS[:3])}{LINKS}{paragraphs(TEXTS[3:])}"
    assert html.main_text(f"<body>{LINKS}{wrap.format(inner)}</body>") == want
    form = "<form class='f'><p>Sign up for our letter, today.</p><input><label>Name</label></form>"
    assert html.main_text(f"<body><article>{inner}{form}</article></body>") == want


def test_only_a_form():
    assert html.main_text("<body><form><label>Search</label><p>Find it.</p></form></body>") == ""


def test_linked_list_items_with_prose_stay():
    items = [f"See page {i}, which, as said above, holds more of it; worth a look." for i in range(4)]
    page = "".join(f"<li><a href='/'>{t[:20]}</a>{t[20:]}</li>" for t in items)
    assert html.main_text(f"<article>{paragraphs(TEXTS)}<ul>{page}</ul></article>") == "\n\n".join(TEXTS + items)


def test_scores_decide(monkeypatch):
    """The same page with scores put to a constant gives another text, in an article element and without."""
    pages = [f"<body><article>{paragraphs(TEXTS)}{LINKS}</article></body>",
             f"<body><div>{LINKS}</div><div>{paragraphs(TEXTS)}</div></body>"]
    right = [html.main_text(p) for p in pages]
    assert right == ["\n\n".join(TEXTS)] * 2
    monkeypatch.setattr(html, "_scores", lambda found, _: ([1.0] * len(found), [True] * len(found)))
    assert all(html.main_text(p) != t for p, t in zip(pages, right, strict=True))


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + TEXTS[0], "<b " * 100_000, '<i ">" ' * 50_000, "<article><p>Well, yes. " * 30_000,
    "".join(f'<div class="ad">word {i}.' for i in range(20_000)), "<form><p>a, b." * 20_000,
    "<ul><li>x " * 50_000, "<script" * 50_000, '<b class="' * 50_000])
def test_time_is_linear(page):
    """10^5 nested or broken tags; a quadratic reader takes minutes for each."""
    start = time.process_time()
    html.main_text(page)
    assert time.process_time() - start < 8


def test_query_on_planted_pages(spark, tmp_path):
    """Random pages of known articles between menus, adverts, notices and comments, some rows repeated."""
    r = random.Random(7)
    noise = ["<nav><a href='/'>Home</a></nav>", "<div class='cookie-notice'><p>We use cookies, as all do.</p></div>",
             "<aside><p>Elsewhere: other news, in brief.</p></aside>", LINKS, "<form><p>Write to us.</p></form>",
             "<div id='comments'><p>Well said, I think so too.</p></div>", "<footer>Ours.</footer>", "<script>x<y</script>"]
    rows = [(None, None, None), (1, "u", "")]
    want = [(None, None, ""), (1, "u", "")]
    for i in range(200):
        texts = [f"{t} {r.random()}." for t in r.sample(TEXTS, r.randint(2, 6))]
        body = "".join(f"<p>{t.replace(' tells', ' <b>tells</b>&#32;')}</p>" for t in texts)
        inner = [x.replace("class='f'", "") for x in r.sample(noise, 2)]
        page = (f"<html><body>{''.join(r.sample(noise, 3))}<article><h1>Head {i} &amp; more</h1>{body}"
                f"{inner[0]}</article>{inner[1]}")
        rows += [(i, f"u{i}", page)] * (1 + i % 2)
        want += [(i, f"u{i}", "\n\n".join([f"Head {i} & more", *texts]))] * (1 + i % 2)
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.QUERIES["op2_html_extraction"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, want)) == sorted(repr((x.page_id, x.url, x.text)) for x in got)
    assert all(x.n_chars == len(x.text) for x in got)
