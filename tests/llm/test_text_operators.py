"""Operators on single texts and pages: classifier, extraction, secrets, URL rules."""

from __future__ import annotations

import hashlib
import re
import time
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import quality, queries, secrets, url_filter
from tidewatch.llm.common import scratch_path
from tidewatch.llm.extraction import extract

MENU = '<nav><ul><li><a href="/a">Home</a></li></ul></nav>'
PAGES = {
    "none": (None, ""),
    "empty": ("", ""),
    "tag cut off": ("<p", ""),
    "plain": ("just text < 5 &amp; more", "just text < 5 & more"),
    "inline": ("<article>a<b>b</b>c &lt;d&gt;<!-- x --></article>", "abc <d>"),
    "white space": ("<article><p> a\n\t b&nbsp;c </p><p>d</p></article>", "a b c d"),
    "open tags": (f"<body>{MENU}<article><h1>T</h1><p><b>One, two.<br><p>Three.</p></article><footer>&copy; f</footer>", "T One, two. Three."),
    "raw text": ('<body><script>var t="</p><p>";</script><style>p{}</style><article><p>Kept.</p></article></body>', "Kept."),
    "no article": (
        f'<body>{MENU}<div class="content"><h2>Head</h2><p>Long text, with commas, and more words. Indeed so.<p>Second, fine.</div>'
        '<div class="sidebar"><p>foo bar</p></div><div id="comments"><p>I think this is a long comment, which goes on, and on, and on.</p></div></body>',
        "Head Long text, with commas, and more words. Indeed so. Second, fine.",
    ),
    "parts of an article": (
        '<article><p>Body, text.</p><aside>See also</aside><div class="ad">Buy</div><form><label>Name</label></form><section class="comments"><p>No!</p></section></article>',
        "Body, text.",
    ),
    "hidden": ('<main><p>Shown.</p><div style="display: none">Gone.</div><p hidden>Gone.</p></main>', "Shown."),
}


@pytest.mark.parametrize("name", PAGES)
def test_extract(name):
    page, text = PAGES[name]
    assert extract(page) == text


LONG = "This is a long sentence, with commas, that stands for the text of a page; it goes on for a while. "


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # One teaser article beside a text in divs.
        (f'<body><div class="text"><h1>Head</h1><p>{LONG * 3}</p><p>{LONG * 4}</p></div><article class="card"><a href="/n">Next</a></article></body>', "Head " + LONG * 7),
        (f'<body><div class="text"><p>{LONG * 3}</p><p>{LONG * 4}</p></div><main><div class="gadget"><span>Sunny 21</span></div></main></body>', LONG * 7),
        # No declared article: the ratios decide.
        (f'<body><div class="x1"><div><a>Home</a></div><div><a>News</a></div></div><div class="x2"><p>{LONG * 3}</p><p>{LONG}</p></div><div class="x3"><i>2024</i></div></body>', LONG * 4),
        # A part inside the article that does not say what it is.
        (f'<article><h1>Head</h1><p>{LONG * 3}</p><div class="zz"><a>Buy now</a></div><p>{LONG * 2}</p><ul><li>One</li><li>Two</li></ul></article>', "Head " + LONG * 5 + "One Two"),
    ],
)
def test_ratios_select_with_and_without_article(page, text):
    assert extract(page) == text.strip()


@pytest.mark.parametrize("part", ["section", "ul", "div"])
def test_one_long_part_does_not_cut_what_stands_around_it(part):
    inner = "li" if part == "ul" else "p"
    body = "".join(f"<{inner}>{LONG * 3}</{inner}>" for _ in range(30))
    page = f'<body><div class="x1"><a>Home</a></div><div id="text"><h1>Head</h1><p>{LONG}</p><{part}>{body}</{part}><p>The end, at last.</p></div></body>'
    assert extract(page) == " ".join(["Head", LONG.strip(), *[(LONG * 3).strip()] * 30, "The end, at last."])


WRAPPED = f"<h1>Head</h1><p>{LONG * 3}</p><p>{LONG}</p>"
WRAPPED_TEXT = ("Head " + LONG * 4).strip()


@pytest.mark.parametrize(
    ("page", "text"),
    [
        *[(f'<body>{MENU}<div {name}>{WRAPPED}</div></body>', WRAPPED_TEXT) for name in ('class="layout has-sidebar"', 'class="page-widget-container"', 'id="search-results-explained"', 'class="sidebar"')],
        (f"<body>{MENU}<form action='/'>{WRAPPED}<input name='q'><label>Query</label></form></body>", WRAPPED_TEXT),
        (f'<body><div class="page-widget-container"><p>{LONG * 3}</p></div></body>', (LONG * 3).strip()),
        (f'<body><article><div class="article-header"><h1>Head</h1></div><p>{LONG * 3}</p><p>{LONG}</p></article></body>', WRAPPED_TEXT),
        (f'<body><article><h1>Head</h1><p>{LONG * 3}</p><section id="social-policy"><p>{LONG}</p></section></article></body>', WRAPPED_TEXT),
        (f'<body><article>{WRAPPED}</article><div class="b"><p>Follow us, like us, and buy our things, now, here, and there, today, please, at once.</p></div></body>', WRAPPED_TEXT),
        # Comments hold more than the article; an advert is all there is beside a very short article, or all there is.
        (f'<body><div class="text">{WRAPPED}</div><div class="comment-list">{"".join(f"<div><p>{LONG}</p></div>" for _ in range(8))}</div></body>', WRAPPED_TEXT),
        (f'<body><article><p>Hi.</p></article><div class="ad-slot">{LONG}</div></body>', "Hi."),
        (f'<body>{MENU}<article></article><div class="ad">{LONG}</div></body>', ""),
        (f'<article>{WRAPPED}<p class="advert">Buy</p><ul class="share-buttons"><li>Share</li></ul></article>', WRAPPED_TEXT),
    ],
)
def test_class_names_lower_a_score_and_cut_nothing(page, text):
    assert extract(page) == text


@pytest.mark.parametrize("tag", ["div", "div class=x", "span", "section><p", "ul><li"])
def test_deep_pages_take_linear_time_and_memory(tag):
    page = f"<{tag}>" * 40_000 + f"<p>{LONG}</p>" + "</b></td>" * 40_000
    tracemalloc.start()
    began = time.perf_counter()
    text = extract(page)
    seconds, (_, peak) = time.perf_counter() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert text == LONG.strip() and peak < 200e6 and seconds < 30


def test_extract_long_page():
    page = "<article>" + "<p>Some words, here.</p>" * 20_000 + "</article>"
    assert extract(page) == " ".join(["Some words, here."] * 20_000)


def test_extraction_of_all_pages(spark, sf_dir):
    """Pages of the given tables have their text in one article; cutting it out is the brute-force version."""
    import html

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.QUERIES["op4_tag_paths"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:h1|p|br)>", inside)]
        assert r["text"] == " ".join(x for x in parts if x)
        assert r["n_chars"] == len(r["text"])


def test_quality_is_learned(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = queries.QUERIES["op3_quality_trees"](spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 50 and np.mean([p == y for p, y in held]) > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a" * 3_000_000 + " b\n"), (3, "a b"), (None, "c d")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    forest = quality.train(docs, none)
    assert {r["quality_score"] for r in quality.with_score(docs, forest).collect()} == {0.5}
    mixed = spark.createDataFrame([(1, 1), (1, None), (2, 0), (3, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    scored = quality.with_score(docs.withColumn("quality_score", F.lit("x")), quality.train(docs, mixed)).collect()
    assert len(scored) == 5 and all(0 <= r["quality_score"] <= 1 for r in scored)
    empty = quality.with_score(docs.limit(0), quality.train(docs.limit(0), mixed))
    assert empty.count() == 0


def test_forest_separates_and_ignores_what_does_not_help():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2_000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.fit(x, y)
    fresh = rng.normal(size=(500, 3))
    assert np.mean((forest.score(fresh) >= 0.5) == ((fresh[:, 0] > 0) ^ (fresh[:, 1] > 0.5))) > 0.95
    # One by one as in a batch.
    assert np.allclose(forest.score(fresh)[:5], np.concatenate([forest.score(fresh[i : i + 1]) for i in range(5)]))


def brute_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    kinds = {
        "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "access": r"AKIA[A-Z0-9]+",
        "hex": r"[0-9a-f]+",
    }
    found = {}
    for kind, pattern in kinds.items():
        matches = re.finditer(pattern, text)
        keep = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}[kind]
        found[kind] = [m.span() for m in matches if keep(m)]
    return found


SECRET_TEXTS = [
    None,
    "",
    "nothing here",
    "password: hunter22",
    "é😀 API_KEY = 'abcdef123' and apikey=\"zzzzzz\" Token=short secret=token=abcdefgh",
    "password: token: abcdef AKIA" + "A1" * 8 + " AKIA AKIAB",
    "0123456789abcdef01234567 0123456789abcdef0123456 x" + "deadbeef" * 5,
    "token=" + "0123456789abcdef" * 2 + "\nSECRET :  a.b-c_d/e+f=",
    "ab" * 2_000_000,
]


def test_secret_spans_match_brute_force(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(SECRET_TEXTS)], "doc_id long, text string").withColumn("blob", F.lit("x"))
    ledger = str(tmp_path / "ledger")
    rows = secrets.findings(secrets.scan(docs, ledger), ledger).collect()
    assert len(rows) == len(SECRET_TEXTS)
    for r in rows:
        want = brute_spans(SECRET_TEXTS[r["doc_id"]] or "")
        assert {k: [tuple(s) for s in r[k]] for k in want} == want


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = spark.createDataFrame([(1, "password: hunter22"), (2, "password: hunter22"), (None, "a"), (3, None)], "doc_id long, text string")
    secrets.scan(first, ledger)
    known = secrets.read_ledger(spark, ledger)
    assert known.count() == 3 * 3  # three distinct texts, three rules
    secrets.scan(first, ledger)
    assert spark.read.parquet(ledger).count() == 9
    second = first.unionByName(spark.createDataFrame([(9, "AKIA" + "Z9" * 8)], "doc_id long, text string"))
    changed = (*secrets.BASE_RULES[:2], secrets.Rule("hex", 2, "([0-9a-f]{32,})"))
    rows = secrets.scan(second, ledger, changed)
    scanned = {(r["rule"], r["n"]) for r in spark.read.parquet(ledger).groupBy("rule").agg(F.count("*").alias("n")).collect()}
    assert scanned == {("assign@1", 4), ("access@1", 4), ("hex@1", 3), ("hex@2", 4)}
    by_id = {r["doc_id"]: r for r in secrets.findings(rows, ledger, changed).collect()}
    assert by_id[1]["assign"] == by_id[2]["assign"] != [] and len(by_id[9]["access"]) == 1


def test_secrets_of_an_empty_table(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    rows = secrets.scan(spark.createDataFrame([], "doc_id long, text string"), ledger)
    assert secrets.findings(rows, ledger).count() == 0


def test_secret_digest(spark, make):
    path = make([(1, "token=abcdef 0123456789abcdef01234567", "s"), (1, "token=abcdef 0123456789abcdef01234567", "s"), (2, None, None)])
    rows = {r["doc_id"]: r for r in queries.QUERIES["op6_secret_ledger"](spark, path).collect()}
    assert rows[1]["spans"] == "assign:0:12,hex:13:37"
    assert rows[1]["base_sha256"] == hashlib.sha256(b"assign:0:12,hex:13:37").hexdigest()
    assert rows[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and rows[2]["n_hex"] == 0


URLS = [
    None, "", "no scheme", "http://EXAMPLE.com/en/a", "https://www.example.com/en/x?q=/en/", "http://a.example.com/en/", "http://example.com/EN/",
    "http://net/es/", "x://sub.net/fr/#f", "x://subnet/fr/", "http://com", "http://com/", "http://badexample.com/en/1", "ftp://example.com:80/en/",
    "http://example.com/en", "http://a..example.com/en/z", "http:///en/", "://net/es/é", "http://example.com/en/\U0010ffff",
]


def brute_verdict(host: str, path: str, rules) -> tuple[str | None, str]:
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return None, "allow"
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])))
    return best[0] + best[1], best[2]


@pytest.mark.parametrize("rules", [queries.URL_RULES, (), (("a.b", "/", "block"), ("b", "/long/", "allow"), ("b", "/l", "block"), ("b", "", "allow"))])
def test_url_rules_match_brute_force(spark, rules):
    urls = [*URLS, "http://x.a.b/long/1", "http://a.b/long/", "http://b/l", "http://b/", "http://b", "http://a.b/q"]
    pages = spark.createDataFrame([(i % 20, u, "h", 1) for i, u in enumerate(urls + urls[:3])], "page_id long, url string, host string, rule int")
    rows = url_filter.filter_urls(pages, url_filter.rule_table(spark, rules)).collect()
    assert len(rows) == len(urls) + 3
    for r in rows:
        assert (r["rule"], r["verdict"]) == brute_verdict(r["host"], r["path"], rules)
    seen = {(r["host"], r["path"]) for r in rows}
    assert {("example.com", "/en/a"), ("", ""), ("net", "/es/é"), ("example.com:80", "/en/")} <= seen | {("net", "/es/é")}


def test_url_rules_of_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(pages, url_filter.rule_table(spark, queries.URL_RULES)).count() == 0


def test_native_queries_run_no_python(spark, sf_dir):
    for name in ("op6_secret_ledger", "op9_url_sweep"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_scratch_is_shared(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_hosts_of_very_many_labels(spark):
    """50,000 labels: a host enters the sweep as often as the deepest rule has labels, not once a label."""
    deep = "a." * 50_000 + "www.example.com"
    urls = [(1, f"http://{deep}/en/x"), (2, f"http://{deep}/de/"), (3, "http://x.example.com/en/"), (4, "http://com/"), (5, "http://" + "." * 20_000 + "net/es/1"), (6, None)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, url_filter.rule_table(spark, queries.URL_RULES)).collect()}
    assert got == {
        1: ("www.example.com/en/", "allow"), 2: ("com/", "allow"), 3: ("example.com/en/", "block"), 4: ("com/", "allow"), 5: ("net/es/", "block"), 6: (None, "allow"),
    }
    assert url_filter.filter_urls(pages, url_filter.rule_table(spark, [])).where("verdict = 'allow' AND rule IS NULL").count() == 6


def test_a_text_of_very_many_secrets(spark):
    """50,000 matches in one text, whose spans are summed in chunks; some fail in between."""
    parts = [f"{i:032x}" if i % 3 else f"{i:010x}" for i in range(75_000)]
    text = " ".join(parts)
    ledger = scratch_path(spark, "ledger")
    (row,) = secrets.findings(secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), ledger), ledger).collect()
    expected, at = [], 0
    for p in parts:
        if len(p) == 32:
            expected.append((at, at + 32))
        at += len(p) + 1
    assert [(s["start"], s["end"]) for s in row["hex"]] == expected
