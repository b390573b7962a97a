from collections import Counter

import numpy as np
import pytest
import corpus_pipeline
from pyspark.sql import functions as F

from aeroweave.llm import html, lines, mixing, quality, urls

WORDS = [f"word{i}" for i in range(40)]
CLEAN = " ".join(WORDS)


# Mixing

def test_poisson_table_inverts_the_distribution():
    for rate in (0.3, 1.0, 7.5, 900.0):
        table = mixing.poisson_table(rate)
        draws = np.searchsorted(table, (np.arange(20_000) + 0.5) / 20_000)
        assert abs(draws.mean() - rate) < 0.01 * rate + 0.01 and abs(draws.var() - rate) < 0.03 * rate + 0.02
    assert mixing.poisson_table(0.0).tolist() == [1.0]


def test_mixing_reaches_the_weights_and_keeps_columns(spark, documents):
    rows = [(i, "x" * 50, "big") for i in range(3000)] + [(i, "x" * 50, "small") for i in range(3000, 3300)]
    docs = documents(rows)
    found = mixing.mix_sources(docs, {"big": 1.0, "small": 3.0})
    counts = Counter(r.source for r in found.collect())
    total = counts["big"] + counts["small"]
    assert abs(total - 3300) < 250 and abs(counts["small"] / total - 0.75) < 0.03
    assert found.columns == [*docs.columns, "__copy"]
    again = mixing.mix_sources(docs.repartition(7), {"big": 1.0, "small": 3.0})
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, again.collect()))


def test_mixing_edge_cases(documents):
    rows = [(1, None, "a"), (2, "", "a"), (None, "text", None), (None, "text", None), (4, "text", "b"), (4, "text", "b")]
    found = mixing.mix_sources(documents(rows), epochs=40).collect()
    assert {r.source for r in found} == {None, "b"}  # a source without characters has rate 0
    by = Counter((r.source, r["__copy"]) for r in found)
    assert all(n == 2 for n in by.values())
    assert mixing.mix_sources(documents(rows), {"c": 1.0}).count() == 0
    assert mixing.mix_sources(documents(rows).limit(0)).count() == 0
    with pytest.raises(Exception, match="repeated more than"):
        mixing.mix_sources(documents(rows), epochs=1e6).count()


def test_a_source_far_smaller_than_the_others_is_repeated_as_often_as_it_takes(documents):
    rows = [(i, "x" * 60_000, "big") for i in range(20)] + [(100, "y" * 25, "small")]
    found = Counter((r.source, r.doc_id) for r in mixing.mix_sources(documents(rows)).select("source", "doc_id").collect())
    rate = (20 * 60_000 + 25) / 50
    assert rate > 20_000 and abs(found["small", 100] - rate) < 8 * rate**0.5
    copies = [r["__copy"] for r in mixing.mix_sources(documents(rows)).filter("source = 'small'").select("__copy").collect()]
    assert sorted(copies) == list(range(1, len(copies) + 1)) and len(copies) == found["small", 100]


def test_the_part_of_a_poisson_table_inverts_like_the_whole():
    for rate in (10_500.0, 123_456.7):
        (low, part), whole = mixing.poisson_part(rate), mixing.poisson_table(rate)
        draws = (np.arange(5000) + 0.5) / 5000
        assert low > 0 and np.array_equal(low + np.searchsorted(part, draws), np.searchsorted(whole, draws))
    assert mixing.poisson_part(7.5)[0] == 0 and len(mixing.poisson_part(1.5e9)[1]) < 1_000_000


# URL filters

def slow_verdict(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


@pytest.mark.parametrize("limit", [urls.BROADCAST_RULES, 0])
def test_urls_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(urls, "BROADCAST_RULES", limit)
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "", "block"),
             ("a.com", "/x", "allow"), ("com", "/x/y", "block"), ("net", "/z", "allow"), ("net", "/z", "block"), (None, "/", "block")]
    seen = ["http://Example.org/es/1", "https://www.example.org/en/1234?q#f", "http://example.org", "http://b.a.com/x/y", "http://a.com?x=/x",
            "ftp://xorg/", "no scheme", None, "", "http://", "://org/", "http://net/z", "http://com", "http://a..com/x", "http://é.org/ü",
            "http://org/#://com/", "http://" + "a." * 200 + "org/" + "p" * 5000, "http://example.org/es/1", "HTTP://EXAMPLE.ORG/ES/"]
    pages = spark.createDataFrame([(i if i else None, u, "clash", "clash") for i, u in enumerate(seen)], "page_id long, url string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages, table).collect())
    given = [r for r in rules if r[0] is not None]
    assert found == [(i, *slow_verdict(u, given)) for i, u in enumerate(seen)]
    assert urls.filter_urls(pages.limit(0), table).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, table.limit(0)).collect()} == {"allow"}


# Quality rules

def test_repeated_words_equal_brute_force():
    rng = np.random.default_rng(3)
    for n in (0, 4, 5, 6, 30, 80):
        words = [str(x) for x in rng.integers(0, 3, n)]
        grams = [tuple(words[i:i + 5]) for i in range(n - 4)]
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert quality.repeated_words(words) == len(covered)


def test_common_lines_deplete_documents_but_copies_do_not(documents):
    own = lambda i: " ".join(chr(97 + i % 26) + chr(97 + i // 26) + chr(97 + k % 26) * (1 + k // 26) for k in range(40))
    banner = "accept all our many cookies please now or leave this fine site right away"
    rows = [(i, own(i) + "\n" + banner, "a") for i in range(30)] + [(i, own(i), "a") for i in range(30, 60)]
    rows += [(i, banner + "\n" + banner.upper(), "a") for i in (100, 101)] + [(200, CLEAN, "a")] * 40 + [(i, CLEAN, "a") for i in range(300, 340)]
    rows += [(400, None, "a"), (401, "", None), (402, "a b c", "a"), (403, CLEAN, None), (None, CLEAN, "a")]
    docs = documents(rows)
    judged = quality.judge_quality(docs).collect()
    assert len(judged) == len(rows)
    kept = {r.doc_id for r in judged if r.kept}
    assert kept == {*range(60), 200, *range(300, 340), 403, None}
    by = {r.doc_id: r for r in judged}
    assert (by[400].n_words, by[400].base_failed, by[400].kept) == (0, True, False)
    assert by[0].n_common_words == 14 and by[100].n_common_words == 28
    clean = quality.clean_quality(docs)
    assert clean.count() == sum(r.kept for r in judged) and clean.columns == [*docs.columns, "__n_cut"]
    assert quality.judge_quality(docs.limit(0)).count() == 0


def test_kept_documents_come_without_the_common_lines_of_their_host(spark, documents):
    own = lambda i: "\n".join(" ".join(f"{chr(97 + (i * 7 + k) % 26)}{chr(97 + i // 26)}w{chr(97 + k)}" for k in range(j, j + 10)) for j in (0, 10))
    banner = "accept all our many  cookies please Now"
    rows = [(i, f"{own(i)}\n\n{banner} {i % 10}", "a") for i in range(30)] + [(100, f"{own(50)}\n{banner} 5", "b"), (101, own(51), None), (102, None, "a")]
    found = {r.doc_id: r for r in corpus_pipeline.keep_quality(spark, documents(rows), "").collect()}
    assert sorted(found) == [*range(30), 100, 101]
    assert all(found[i].text == own(i) + "\n" and found[i].n_chars == len(found[i].text) for i in range(30))
    assert (found[100].text, found[101].text) == (rows[30][1], own(51))  # common on one host is not common on another
    assert quality.clean_quality(documents(rows).limit(0)).count() == 0


def test_a_common_line_needs_more_texts_on_a_larger_host_but_a_smaller_share(documents):
    own = lambda i: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}{chr(97 + k)}" for k in range(12))
    rows = [(i, own(i) + ("\nread more of this here" if i < 110 else "\nnot so common a line" if i < 190 else ""), "a") for i in range(2500)]
    rows += [(3000 + i, own(i) + ("\nread more of this here" if i < 21 else "\nnot so common a line" if i < 40 else ""), "b") for i in range(90)]
    texts = {r.doc_id: r.text for r in quality.clean_quality(documents(rows)).collect()}
    count = lambda line, low: sum(line in t for i, t in texts.items() if (i < 3000) == (low < 3000))
    assert len(texts) == 2590
    assert (count("read more", 0), count("not so common", 0)) == (0, 80)  # 110 and 80 of 2,500; the limit is 100
    assert (count("read more", 3000), count("not so common", 3000)) == (0, 19)  # 21 and 19 of 90; the limit is 20


def test_counts_of_one_text():
    assert quality.text_counts("a  b\n\na  b\r\na  b\n#*$ x|é퟿")[:5] == (8, 13, 4, 1, 0)


# Line dedup

def test_lines_on_many_sites_go_but_for_the_first(documents):
    rows = [(i, f"own {i}\nShared Line\nshared line ", f"s{i % 12}") for i in range(5, 30)]
    rows += [(i, f"only nine {i}\nnine sites", f"s{i % 9}") for i in range(40, 60)] + [(70, "", "s1"), (71, None, None), (72, "\n \n", "s2")]
    docs = documents(rows)
    found = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert found[5].text == "own 5\nShared Line" and found[5]["__n_removed"] == 1
    assert all(found[i].text == f"own {i}" and found[i]["__n_removed"] == 2 for i in range(6, 30))
    assert all(found[i].text.endswith("nine sites") for i in range(40, 60))
    assert (found[70].text, found[71].text, found[72].text) == ("", None, "\n \n") and found[71]["__n_lines"] == 0
    assert lines.dedup_lines(docs).columns == [*docs.columns, "__n_lines", "__n_removed"]
    assert lines.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("band", [0.0, 0.1, 0.95])
def test_spread_is_exact_near_the_threshold(spark, band):
    rows = [(key, f"site{s}", s) for key in range(1, 60) for s in range(key)] + [(59, None, 99)] * 5
    df = spark.createDataFrame(rows, "key long, site string, doc long")
    found = {r.key: r.first_doc for r in lines.spread_lines(df, 30, band).collect()}
    assert found == {k: 0 for k in range(30, 60)}


def test_repeated_rows_and_null_ids_of_lines(documents):
    rows = [(None, "same", f"s{i}") for i in range(11)] + [(1, "same\nmore", "s1")] * 2
    found = Counter((r.doc_id, r.text) for r in lines.dedup_lines(documents(rows)).collect())
    assert found == {(None, ""): 11, (1, "same\nmore"): 2}


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">Menu one</a></li></ul></nav><!-- <p>gone</p> --><div class="cookie-notice">We use cookies a lot.</div>
<article><h1>Head &amp; more</h1><p><b>First   para&#8217;s
text.<br>Next<p>Second &lt;b&gt;<div class="ad">Buy now</div><p>Third <a href="x>y">link</a></p><aside>Side</aside><form>Name <input></form>
<section class="comments"><p>A reader writes</p></section><p>Ti.</article><div id="sidebar"><p>Long sidebar text that is not the article at all.</p></div>
<footer>&copy; 2024</footer></body></html>"""


def test_article_is_found_in_marked_pages():
    assert html.main_text(PAGE) == "Head & more\nFirst para’s text. Next\nSecond <b>\nThird link\nTi."


def test_blocks_surge_and_dive_in_pages_without_marks():
    text = "A sentence of the article that goes on for quite a while, as sentences do in articles. "
    page = ("<body><ul>" + "<li><a href=/>Menu</a></li>" * 9 + "</ul><div>" + f"<p>{text}</p>" * 3 + "<p>Short.</p>" + f"<p>{text * 2}</p></div>"
            + "<ul>" + "<li><a href=/>Tag</a></li>" * 9 + "</ul><p>Imprint</p></body>")
    assert html.main_text(page) == "\n".join([text.strip()] * 3 + ["Short.", (text * 2).strip()])


def test_pages_with_and_without_the_mark_give_the_same_text():
    assert html.main_text(PAGE.replace("<article>", "<div>").replace("</article>", "</div>")) == html.main_text(PAGE)
    text = "Words of an article that goes on for a while, and then for a while longer. "
    links = '<p><a href="/x">elsewhere</a></p>' * 4
    page = f"<body><div><h1>Head</h1><p>{text * 3}</p>{links}<p>{text}</p><p>End.</p></div><div>{links}</div><p>Imprint</p></body>"
    assert html.main_text(page) == "\n".join(["Head", (text * 3).strip(), text.strip(), "End."])
    cards = "<article><p>Teaser one.</p></article>" + f"<article><p>{text * 5}</p><p>Last.</p></article>" + "<article><p>Teaser two.</p></article>"
    assert html.main_text(f"<body>{cards}</body>") == (text * 5).strip() + "\nLast."


@pytest.mark.parametrize("page,expected", [
    ("", ""), ("<article></article>", ""), ("<article>a &am", "a &am"), ("<article><p>x<p>y</art", "x\ny"), ("<article>1 < 2 &amp b", "1 < 2 & b"),
    ("<article><p>a<script>b", "a"), ("<article>a<!-- b", "a"), ("<article><p title='>'>q</p>", "q"), ("<div>no</div>", "no"), ("<h1>Head</h1><div>The lake froze at dawn.</div>", "Head\nThe lake froze at dawn."), ("<p><a href=/>link</a></p>", "link"),
    ("<article>&nbsp;a&nbsp;&nbsp;b&#x20;</article>", "a b"), ("<main><p hidden>no<p>yes</main>", "yes"),
])
def test_odd_pages(page, expected):
    assert html.main_text(page) == expected


def test_extraction_keeps_every_row(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "c"), (1, "u", PAGE, "c"), (None, None, None, "c"), (3, "v", "<article>" + "<p>long</p>" * 50_000, "c")],
                                  "page_id long, url string, html string, text string")
    found = html.extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 0), (1, len(html.main_text(PAGE))), (1, len(html.main_text(PAGE))), (3, 249_999)]
    assert html.extract_text(pages.filter(F.lit(False))).count() == 0
