"""The training-data operators against brute force, and on awkward rows: nulls in any column, empty
and long texts, ties, repeated rows, empty tables and clashing extra columns."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airshed.llm import (
    common,
    components,
    decontamination,
    html,
    jaccard,
    language,
    licenses,
    mixing,
    pii,
    quality,
    sharding,
    topk,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, n int"
WORD = re.compile(common.WORD)
RNG = np.random.default_rng(3)
VOCABULARY = [f"w{i}" for i in range(60)] + ["the", "of", "été"]
LONG = " ".join(RNG.choice(VOCABULARY, 3000))
ITEM = " ".join(f"bench{i}" for i in range(25))


def _texts() -> list[str | None]:
    base = " ".join(RNG.choice(VOCABULARY, 60))
    near = base.split()
    near[3] = "changed"
    return [None, "", "  \n ", "...", "one", "One two.", base, base, " ".join(near), LONG,
            LONG + " more", f"Before {ITEM.upper()} after", "x " + " ".join(ITEM.split()[5:16]),
            " ".join(ITEM.split()[:9]), "Released under the MIT License.", "a b short item c",
            "mail bob@example.com or 10.0.0.1, 4111 1111 1111 1111 and +1 (555) 010-9999."]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, ["en", "fr", None][i % 3], ["s1", None, "s2"][i % 3], 1, 7, 8)
           for i, t in enumerate(_texts())]
    return out + [out[6], (None, "null id", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(s):
    return (s or "").translate({i: i + 32 for i in range(65, 91)})


def test_decontamination(spark, docs, rows, empty):
    bench = [(1, ITEM), (2, ITEM), (10, "Short item"), (3, None), (4, "!!")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    wins = {}
    for i, t in bench:
        w = WORD.findall(lower(t))
        n = min(10, len(w))
        for a in range(len(w) - n + 1) if n else ():
            wins.setdefault(tuple(w[a:a + n]), set()).add(str(i))
    want = Counter()
    for r in rows:
        w = WORD.findall(lower(r[1]))
        hit, ids = set(), set()
        for n in {len(k) for k in wins}:
            for a in range(len(w) - n + 1):
                if found := wins.get(tuple(w[a:a + n])):
                    hit |= set(range(a, a + n))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        want[r[0], len(w), len(hit), len(ids), digest, bool(hit)] += 1
    got = decontamination.decontaminate(docs, items)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(k[5] for k in want) == 3
    assert decontamination.decontaminate(empty, items).count() == 0
    assert not decontamination.decontaminate(docs, items.limit(0)).where("contaminated").head(1)


def test_repeated_words_keep_windows(spark):
    """A run of equal words keeps one hash over many windows."""
    items = spark.createDataFrame([(1, "a " * 12)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x " + "a " * 200 + "y")], "doc_id long, text string")
    assert decontamination.decontaminate(docs, items).first()["n_hit"] == 200


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    total = F.lit(n).cast("long")
    got = (spark.range(n).select("id", sharding.permute(F.col("id"), total, 5).alias("y"))
           .withColumn("x", sharding.unpermute(F.col("y"), total, 5)).collect())
    assert sorted(r["y"] for r in got) == list(range(n))
    assert all(r["x"] == r["id"] for r in got)


def test_sharding(docs, rows, empty):
    got = sharding.shard_documents(docs, 4).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - len(rows) / 4) < 1
    again = sharding.shard_documents(docs.repartition(5), 4).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert sharding.shard_documents(empty).count() == 0


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 0)], "s string, n long")
    got = {r["s"]: r["target"] for r in mixing.source_targets(sizes, "s", "n").collect()}
    want, left, free = {}, 1510.0, {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}
    cap = {"a": 30.0, "b": 3000.0, "c": 1500.0, None: 0.0}
    while True:
        share = {k: left * w / sum(free.values()) for k, w in free.items()}
        over = [k for k in free if share[k] > cap[k]]
        if not over:
            break
        for k in over:
            want[k] = cap[k]
            left -= cap[k]
            del free[k]
    assert got == pytest.approx(want | share)


def test_mixing(spark, docs, rows, empty):
    many = spark.createDataFrame(
        [(i, " ".join(["w"] * (1 + i * 7919 % 400)), f"s{i % 5 if i % 3 else 0}")
         for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.mix(many, F.col("doc_id"), mixing.text_key(F.col("text")), F.col("source"),
                     mixing.word_count(F.col("text")), block=256).toPandas()
    by = got.assign(taken=got["size"] * got["copies"]).groupby("source")
    assert len(got) == 3000 and got["copies"].max() <= 3
    assert (by["taken"].sum() / by["target"].first() - 1).abs().max() < 0.01
    expected = by["target"].first() / by["source_size"].first() * by["size"].count()
    assert (by["copies"].sum() - expected).abs().max() <= 0.03 * 3000
    one, two = mixing.mix_documents(docs).collect(), mixing.mix_documents(docs.repartition(6)).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, two)) and len(one) == len(rows)
    assert mixing.mix_documents(empty).count() == 0


def test_topk(spark):
    x = RNG.integers(-3, 4, (300, 6)).astype(float)
    x[50:120] = x[50]
    bad = [(900, None), (901, [1.0] * 5 + [float("nan")]), (902, [None] * 6), (None, [0.5] * 6),
           (950, [0.25] * 3)]
    e = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(x)] + bad,
                              "vec_id long, embedding array<float>")
    got = topk.top_k(topk.whole_vectors(e), topk.whole_vectors(e).where("vec_id % 10 = 0"), 5, 64, 16)
    want = set()
    for q in range(0, 300, 10):
        s = x @ x[q]
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], i))[:5]
        want |= {(q, k + 1, i, int(s[i])) for k, i in enumerate(best)}
    assert set(map(tuple, got.collect())) == want
    assert topk.search_embeddings(e.limit(0)).count() == 0


def test_reading_stops_early():
    """One long vector is found without reading the lists to the end."""
    x = RNG.normal(0, 1, (500, 4)).round()
    x[7] = [100, 100, 100, 100]
    q, ids, score = topk.read_lists(x, np.arange(500), np.ones((1, 4)), np.array([-1]), 1)
    assert ids.tolist() == [7] and score.tolist() == [400]


def test_jaccard(docs, rows, empty):
    sets = {}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(r[1]))
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [tuple(w)] * bool(w)
        sets[r[0]] = frozenset(grams)
    ids = sorted((i for i in sets if i is not None))
    root = {i: i for i in ids}
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                old, new = root[b], root[a]
                root = {k: new if v == old else v for k, v in root.items()}
    for boundary in (None, 1, 30):
        got = jaccard.link(docs, boundary=boundary).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == Counter(
            (r[0], len(sets[r[0]]), root.get(r[0])) for r in rows)
    assert jaccard.link(empty).count() == 0


def test_jaccard_near_copies(spark):
    """Copies of one text with one to six changed words: only some link, across blocks too."""
    base = [f"t{i}" for i in range(150)]
    texts = []
    for i in range(120):
        w = list(base)
        for j in RNG.choice(150, 1 + i % 6, replace=False):
            w[j] = f"new{RNG.integers(9)}"
        texts.append(" ".join(w))
    sets = [set(jaccard.shingles(t).tolist()) for t in texts]
    root = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.link(docs).collect()}
    assert got == dict(enumerate(root)) and 1 < len(set(root)) < len(root)


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5)])
def test_linked_sets_share_a_key(num, den):
    """Any two sets of at least the similarity share a key; unrelated ones hardly any."""
    rng = np.random.default_rng(5)
    new = lambda n: rng.integers(1, 2**63, n).astype(np.uint64)
    alien = 0
    for boundary in (1, 9, 30):
        plan = jaccard.Plan(boundary, num, den)
        sizes = [*range(5, 26), *range(31, 400, 7)]
        for s in sizes if boundary < 30 else sizes[30:]:
            a = new(s)
            out = int(rng.integers(0, s + 1)) * (den - num) // den
            into = max(0, (s - out) * den // num - s)
            b = np.concatenate([a[out:], new(into)])
            if (s - out) * den >= (s + into) * num:
                assert np.intersect1d(plan.keys(np.sort(a)), plan.keys(np.sort(b))).size
            alien += s > 60 and np.intersect1d(plan.keys(np.sort(a)), plan.keys(new(s))).size
    assert alien == 0


def test_jaccard_null_ids(spark):
    """Sets whose rows have no doc_id link as others do, and lead lists."""
    base = [f"t{i}" for i in range(150)]
    texts = [" ".join(base)]  # without an id; the others are near it, and some not near each other
    for at in ((20,), (60,), (100,), (5, 140), (40, 80)):
        texts.append(" ".join(f"new{i}" if i in at else w for i, w in enumerate(base)))
    rows = [(i or None, t) for i, t in enumerate(texts)] + [(None, texts[0])]
    got = jaccard.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == {
        (i, 1) for i in (None, *range(1, len(texts)))} and len(got) == len(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(40, 50), (50, 45), (60, 60)]
    got = {tuple(r) for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(21)} | {(40, 40), (45, 40), (50, 40)}


def test_boundary_follows_the_sizes():
    assert jaccard.choose_boundary({15: 1000}) >= 15
    assert jaccard.choose_boundary({40: 1000}) < 40


def test_licenses(docs, rows, empty):
    got = {r["doc_id"]: r for r in licenses.scan_documents(docs).collect()}
    assert len(got) == len({r[0] for r in rows})
    for r in rows:
        w = WORD.findall(lower(r[1]))
        places = sorted(i for p, _ in licenses.PHRASES for i in range(len(w))
                        if w[i:i + len(p.split())] == p.split())
        x = got[r[0]]
        assert (x["n_words"], x["n_base"]) == (len(w), len(places))
        assert (x["first_word"], x["last_word"]) == ((places[0], places[-1]) if places else (None,) * 2)
    assert got[14]["labels"] == "mit" and got[14]["score"] == 1.0
    assert licenses.scan_documents(empty).count() == 0


def test_matching_statistics():
    texts = ["abcbcabd", "bcbdabca"]
    auto = licenses.Automaton([[ord(c) for c in t] for t in texts])
    for _ in range(30):
        s = "".join(RNG.choice(list("abcd"), 25))
        got = {(end, n) for end, n, _ in auto.matches([ord(c) for c in s], 1)}
        want = []
        for end in range(1, len(s) + 1):
            n = max(k for k in range(end + 1) if any(s[end - k:end] in t for t in texts))
            want.append((end, n))
        # a run counts where the next character does not continue it
        want = {(e, n) for i, (e, n) in enumerate(want)
                if n and (i + 1 == len(want) or want[i + 1][1] != n + 1)}
        assert got == want


def test_cover_label():
    scanner = licenses.Scanner()
    text = "Intro. " + licenses.TEMPLATES[6][1].replace("source", "any") + " rest"
    cover = scanner.cover(licenses.split_words(text))
    assert cover["bsd"][0] > 0.8


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="post"><h1>Title &amp; more</h1><p><b>First   paragraph, with words.<br>And a line.
<p>Second one; also long enough to count.</p><div class="ad-box">Buy now</div><ul><li>Item</ul></div>
<aside>Side</aside><div id="comments"><p>Nice article, thanks a lot, really. Yes.</p></div>
<form><p>Sign up</p></form><footer>&copy; me</footer>"""


def test_html(spark):
    want = ("Title & more\n\nFirst paragraph, with words. And a line.\n\n"
            "Second one; also long enough to count.\n\nItem")
    assert html.main_text(PAGE) == want
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == ""
    assert html.main_text("plain") == "plain"
    assert html.main_text("<article><p>Text one. &am") == "Text one. &am"
    html.main_text("<" * 5000 + "<p" * 2000 + "<div>" * 300)
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["n_chars"] for r in html.extract_pages(pages).collect()}
    assert got == {1: len(want), None: 0}
    assert html.extract_pages(pages.limit(0)).count() == 0


PARTS = [f"Paragraph {i} of the article, with a good number of words in it; and more." for i in range(4)]
BODY = "".join(f"<p>{x}</p>" for x in PARTS)


@pytest.mark.parametrize("wrapper", [
    '<div class="page has-sidebar">{}</div>', '<div class="no-sidebar">{}</div>',
    '<main class="has-banner">{}</main>', '<article class="comments-open">{}</article>',
    '<article class="post category-social tag-legal">{}</article>',
    '<div class="has-sidebar"><article><div id="social-story">{}</div></article></div>'])
def test_html_wrapper_names(wrapper):
    """Names of wrappers do not hide the article; small named parts in them stay out."""
    inner = BODY + '<div class="sidebar"><p>Other news, briefly.</p></div><div class="ad">Buy.</div>'
    assert html.main_text("<body>" + wrapper.format(inner)) == "\n\n".join(PARTS)
    ad = f'<div class="ad"><p>{PARTS[0]} {PARTS[1]}</p></div>'
    assert html.main_text(f"<body>{ad}<article><p>Short.</p></article></body>") == "Short."
    half = [f'<div class="{c}"><p>{x}</p></div>' for c, x in zip(
        ["has-banner", "category-social"], PARTS, strict=False)]
    assert html.main_text("".join(half)).startswith(PARTS[0])


def test_html_keeps_all_parts():
    """Without one article element, no part of the article is lost to a larger one."""
    a, b, c, d = PARTS
    long = " ".join(PARTS)
    tag = lambda name, *x: f"<{name}>{''.join(x)}</{name}>"
    p = lambda *x: "".join(tag("p", t) for t in x)
    menu = '<ul><li><a href="/x">Home</a></li><li><a href="/y">News</a></li></ul>'
    cases = [
        (tag("div", p(a, b)) + tag("div", p(c)), [a, b, c]),
        (tag("article", p(a, b, c)) + tag("article", p(d)), [a, b, c, d]),
        (tag("article", p(a, b)) + "<h2>Two</h2>" + tag("article", p(c)), [a, b, "Two", c]),
        (tag("div", p(a), tag("blockquote", p(long, long)), p(b)), [a, long, long, b]),
        (tag("div", p(a), tag("ul", *[tag("li", long)] * 3), p(b)), [a, long, long, long, b]),
        (tag("div", p(a, f'<a href="/z">{b}</a>', c)), [a, b, c]),
        (menu + tag("div", "<h1>Title</h1>", p(a, b, c), p("End.")), ["Title", a, b, c, "End."])]
    for page, want in cases:
        assert html.main_text(f"<body>{page}</body>") == "\n\n".join(want), page


def test_quality(spark, docs, rows, empty):
    good = [(i, " ".join(RNG.choice(VOCABULARY, 40)) + ".", 1) for i in range(100, 400)]
    junk = [(i, " ".join(w.upper() + "!!" for w in RNG.choice(VOCABULARY, 30)), 0)
            for i in range(400, 700)]
    both = spark.createDataFrame([x[:2] for x in good + junk], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + junk] + [(100, None), (None, 1)],
                                   "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score_documents(both, labels).collect()}
    held = [(i, q) for i, _, q in good + junk if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["held_out"] for i, _ in held)
    assert np.mean([got[i]["predicted"] == q for i, q in held]) > 0.95
    flat = quality.score_documents(docs, labels.limit(0))
    assert {r["score"] for r in flat.collect()} == {0.5} and flat.count() == len(rows)
    assert quality.score_documents(empty, labels).count() == 0


def test_isotonic():
    x, y = quality.isotonic(np.arange(5.0), np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert y.tolist() == [0, 0.5, 1, 1] or y.tolist() == [0, 0.5, 1]
    assert (np.diff(x) > 0).all()


def test_marginals_match_enumeration():
    e, t = RNG.normal(size=(7, 3)), RNG.normal(size=(3, 3))
    post, pair, log_z = language.marginals(e, t, np.array([4, 3]))
    want, pairs, log_want = np.zeros((7, 3)), np.zeros((3, 3)), 0.0
    for start, n in ((0, 4), (4, 3)):
        paths = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T
        s = np.array([sum(e[start + i, p[i]] for i in range(n))
                      + sum(t[p[i], p[i + 1]] for i in range(n - 1)) for p in paths])
        w = np.exp(s) / np.exp(s).sum()
        log_want += np.log(np.exp(s).sum())
        for p, x in zip(paths, w, strict=True):
            for i in range(n):
                want[start + i, p[i]] += x
                if i:
                    pairs[p[i - 1], p[i]] += x
    assert np.allclose(post, want) and np.allclose(pair, pairs) and np.isclose(log_z, log_want)


def test_language(spark, docs, rows, empty):
    words = {"en": "the and with that this house water".split(),
             "fr": "le les avec cette maison été eau".split()}
    data = [(i, " ".join(RNG.choice(words[x], 20)), x)
            for i, x in enumerate(["en", "fr"] * 100, start=1000)]
    data += [(1, None, "en"), (2, "12 ... 5", "fr"), (3, "", None)]
    got = {r["doc_id"]: r for r in language.identify_documents(
        spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["lang_pred"] == x for i, _, x in data if i >= 1000)
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert got[1001]["held_out"] == (zlib.crc32(b"1001") % 4 == 2)
    mixed = language.train([(t, x) for _, t, x in data if t and x])
    sums = language.read(["the house with water\nle maison avec été " * 3], mixed)[0]
    assert min(sums) / sum(sums) > 0.3  # words of both languages are told apart
    assert language.identify_documents(docs).count() == len(rows)
    assert language.identify_documents(empty).count() == 0


def test_pii(docs, rows, empty):
    expressions = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                   r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
                   r"\+[0-9][\x20().0-9-]+[0-9]")
    got = pii.find_personal_data(docs)
    assert got.count() == len(rows)
    row = got.where("doc_id = 16").first()
    spans = [(m.start(), i, m.end()) for i, e in enumerate(expressions)
             for m in re.finditer(e, rows[16][1])]
    spans = [s for s in sorted(spans) if not (s[1] == 2 and s[2] - s[0] < 14)]
    text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    assert row["spans"] == text and row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert [row[f"n_{k}"] for k in pii.KINDS] == [1] * 4
    assert pii.find_personal_data(empty).count() == 0


def test_pii_finds_by_context(spark):
    """Account numbers that no expression knows stand where cards stand."""
    cards = ["4111111111111111", "5500005555555559", "340000000000009", "30000000000004"]
    data = [(i, f"é please charge {c} now") for i, c in enumerate(cards)]
    data += [(10, "please charge AB-12-345678 now"), (11, "room 12345678 is free"),
             (12, "a.b@c.d_e@f.g 256.1.1.1 1.2.3.4.5.6.7.8 " + "9" * 3000)]
    got = {r["doc_id"]: r for r in pii.find_personal_data(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[0]["spans"] == "card:16:32"
    assert got[10]["spans"] == "card:14:26" and got[10]["n_card"] == 0
    assert got[11]["spans"] == ""
    assert (got[12]["n_email"], got[12]["n_ip"], got[12]["n_card"]) == (2, 2, 0)


def test_pii_context_without_digits(spark):
    """Emails without digits are seeds; unseen addresses have no digits and may follow a digit word."""
    mails = ["alice@example.com", "bob@example.org", "carol@some.net", "dave@an.example"]
    data = [(i, f"é on 7  please write (to) {m}, soon") for i, m in enumerate(mails)]
    data += [(9, "é on 7  please write (to) zoe-at-example, soon"), (10, "write zoe-at-example x")]
    cards = ["4111 1111 1111 1111", "5500 0055 5555 5559", "6011 1111 1111 1117", "4012 8888 8888 1881"]
    data += [(20 + i, f"room n7x {c} is paid by mail a@b.cc") for i, c in enumerate(cards)]
    data += [(30, "room n7x AB-9 is paid")]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(
        spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[0] == "email:26:43" and got[9] == "email:26:40" and got[10] == ""
    assert got[30] == "card:9:13"
