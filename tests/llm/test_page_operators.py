"""URL filter, HTML extraction, links and the pipeline."""

import math
import time
from collections import Counter

import pytest

import corpus_pipeline
from textpack.llm import components, html, urls
from textpack.llm.queries import URL_RULES
from tests.llm.helpers import by_row, odd_rows, table
from tools import check


def brute_judge(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


URLS = [None, "", "no host", "http://", "http://A.Example.ORG/en/12?x", "https://example.org/es/1", "http://notexample.org/es/",
        "http://org", "http://org/", "a://b://c/d", "http://x.com/de/", "http://com/fr/#a", "http://x.com?/de/", "http://xcom/de/",
        "http://É.com/de/é", "http://example.org\n/es/", "http://example.org/en/1" + "x" * 5000, "http://.org/", "http://a..com/fr/"]


def test_urls(spark):
    rows = list(enumerate(URLS)) + [(None, URLS[4]), (4, URLS[4])]
    pages = table(spark, rows, key="page_id", text="url")
    found = by_row(tuple(r) for r in urls.judge(pages, URL_RULES).collect())
    assert found == by_row((k, *brute_judge(u, URL_RULES)) for k, u in rows)
    assert urls.judge(pages.limit(0), URL_RULES).count() == 0
    assert all(r.rule is None and r.verdict == "block" for r in urls.judge(pages, [], "block").collect())


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda text: 7)
    rules = [("allow", f"h{i}.org", "/") for i in range(20)]
    array = urls.RuleArray(urls.rule_bytes(rules))
    assert [array.string(i) for i in array.longest([f"h{i}.org" for i in range(20)], ["/x"] * 20)] == [
        f"h{i}.org\n/".encode() for i in range(20)]
    assert array.longest(["h99.org"], ["/"]) == [-1]


PAGE = ("<html><head><title>t</title><script>if (a<b) '</p>'</script></head><body><nav><li>menu</nav><div class='cookie-notice'>ok</div>"
        "<article><h1>Head &amp; line </h1><p>One\n two &lt;b&gt; <b>bold<br><p>Three <i>four</i>five<form>f</form>"
        "<div id=comments><p>said</div></article><aside>s</aside><footer>&copy; x</footer></body></html>")


@pytest.mark.parametrize("page, text", [
    (PAGE, "Head & line\nOne two <b> bold\nThree fourfive"), ("", ""), ("plain", "plain"), ("<p>a<p>b<div", "a\nb"),
    ("<p>1 < 2 & 3</p>", "1 < 2 & 3"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<!-- x --><p>a<!-- b", "a"),
    ('<p title="a>b">c</p>', "c"), ("<article>a<p>b</article></article>c", "a\nb\nc"), ("<script>only", ""), ("x" * 20000, "x" * 20000)])
def test_pages(page, text):
    assert "\n".join(b["text"] for b in html.parse_page(page)[1]) == text


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><article>a</article></body>", "<html class=no-menu><p>a", "<div class='content no-sidebar'><p>a</div>",
    "<article class='post share-enabled'>a<div class='footer'>b</div></article>", "<main class='widget'>a</main>",
    "<article class='related'>a</article>", "<div class='social_nav--menu'>b</div><p>a"])
def test_names_that_only_mention_a_frame(page):
    assert "\n".join(b["text"] for b in html.parse_page(page)[1]) == "a"


def test_frames_are_found_by_the_site(spark):
    """Pages without names: what is alike on all pages of a host goes, what differs stays."""
    def page(host, i):
        return (f"<body><div id=a><span>Home</span> Contact</div><div id=b><p>Story {host} {i}</p>{'<p>more</p>' * (i % 4)}</div>"
                "<div id=c>All rights reserved</div></body>")
    rows = [(n, f"http://{host}/{i}", page(host, i)) for n, (host, i) in enumerate((h, i) for h in ("a.org", "b.org") for i in range(12))]
    rows += [(100, None, None), (101, "", "<p>lone</p>"), (None, "http://a.org/1", PAGE), (0, "http://c.org", "<div id=a>Home</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {(r.page_id, r.url): r.text for r in html.extract(pages).collect()}
    assert len(found) == len(rows)
    assert found[1, "http://a.org/1"] == "Story a.org 1\nmore" and found[100, None] == "" and found[101, ""] == "lone"
    assert found[None, "http://a.org/1"].startswith("Head & line") and found[0, "http://c.org"] == "Home"
    assert html.extract(pages.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (5, 5)]
    found = dict(map(tuple, components.connect(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {k for k, v in found.items() if v == 0} >= set(range(1, 61)) and found[200] == found[300] == 100


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_substring_dedup", "op5_url_filter"])
def test_same_as_sql(spark, name):
    assert check.differences(spark, check.connect(FOLDER), FOLDER, name) == []


def test_pipeline(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
    assert result.count() == result.select("doc_id").distinct().count() > 0.5 * docs.select("text").distinct().count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_awkward_tables(spark, stage):
    more = "cast(null as string) lang", "cast(null as string) source", "cast(length(text) as bigint) n_chars"
    docs = table(spark, odd_rows(), clashes=True).selectExpr("*", *more)
    found = stage(spark, docs, FOLDER)
    assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert "n_tokens" in found.columns or found.columns == docs.columns
    assert 0 < found.count() <= len(odd_rows())


@pytest.mark.parametrize("page, text", [
    ("<p title='a > b'>text", "text"), ("""<p title='say "x' id="y">text""", "text"), ('<p title="open>text <b>more</b>', "text more"),
    ("<p title=don't>text</p> it's", "text\nit's"), ('<a href="x"y">one</a> two', "one two")])
def test_quotes(page, text):
    assert "\n".join(b["text"] for b in html.parse_page(page)[1]) == text


@pytest.mark.parametrize("name", [
    "comment-list", "commentlist", "comments-area", "post-comments", "site-header", "site-footer", "ad-slot", "main-menu",
    "wp-block-navigation", "share-buttons", "newsletter-signup"])
def test_names_of_frames_in_an_article(name):
    assert [b["text"] for b in html.parse_page(f"<article><p>a</p><div class='{name}'>b</div></article>")[1]] == ["a"]


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<p title=\"x>y" * 20_000, "<div class='a" * 20_000, "<li>x" * 20_000])
def test_hostile_pages_take_time_in_proportion(page):
    def seconds(n):
        start = time.perf_counter()
        html.parse_page(page[:len(page) // n])
        return time.perf_counter() - start

    assert seconds(1) < 4 * 4 * seconds(4) + 1
    assert len(html.parse_page(page)[0]) <= 20_001


def brute_importance(pages):
    """Importance of every node, with all pages of a host side by side."""
    by_host = {}
    for host, page in pages:
        nodes, _ = html.parse_page(page)
        by_host.setdefault(host, {})[html.identity(nodes)] = by_host.get(host, {}).get(html.identity(nodes), set()) | {
            (n["node"], n["style"], n["content"]) for n in nodes}
    found = {}
    for host, seen in by_host.items():
        rows = [(n, s, c) for own in seen.values() for n, s, c in own]
        for node in {r[0] for r in rows}:
            own = [r for r in rows if r[0] == node]
            shares = []
            for place in (1, 2):
                counts = Counter(r[place] for r in own)
                shares.append(-sum(c / len(own) * math.log(c / len(own)) for c in counts.values()))
            found[host, node] = max(shares) / math.log(len(own)) if len(own) >= html.LEAST_PAGES else 1.0
    return found


def site(i, story):
    return (f"<body><div><a>Home</a> About</div><div><article><div class=toplinks>Read also</div><h1>T{i}</h1><p>{story}</p>"
            f"<div><p>box {story}</p></div><div class=legal>All rights reserved</div></article></div><div>Imprint</div>"
            f"<div class='comment-list'><p>reader {i}</p></div></body>")


def test_the_tree_judges_every_node(spark):
    """Unnamed menus, footers and boxes that all pages share go, in the article too; what varies stays; copies stay whole."""
    rows = [(i, f"http://a.org/{i}", site(i, f"story {i}")) for i in range(30)]
    rows += [(100 + i, f"http://a.org/c{i}", site(7, "story 7")) for i in range(40)]  # copies of one page
    rows += [(200 + i, f"http://b.org/{i}", site(5, "one story")) for i in range(30)]  # a site of copies only
    rows += [(300 + i, f"http://c.org/{i}", f"<div>Menu</div><div>story {i}</div><div>Imprint</div>") for i in range(30)]
    rows += [(400 + i, f"http://d.org/{i}", site(i, f"few {i}")) for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == f"T{i}\nstory {i}\nbox story {i}" for i in range(30))
    assert all(found[100 + i] == "T7\nstory 7\nbox story 7" for i in range(40))
    everything = "Home About\nRead also\nT5\none story\nbox one story\nAll rights reserved\nImprint"
    assert all(found[200 + i] == everything for i in range(30))
    assert all(found[300 + i] == f"story {i}" for i in range(30))
    assert all(found[400 + i].startswith("Home About\nRead also") for i in range(3))
    parsed = html.parsed_pages(pages, "page_id", "url", "html")
    expected = brute_importance([(r[1].split("/")[2], r[2]) for r in rows])
    got = {(r.host, r.node): r.importance for r in html.importance(parsed).collect()}
    assert got == pytest.approx(expected)


def test_given_pages_have_nodes(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    parsed = html.parsed_pages(pages, "page_id", "url", "html")
    assert parsed.where("size(nodes) < 3").count() == 0 and html.importance(parsed).count() > 100


def test_pages_with_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org", "<p>a", "k", "t", "r", 5)],
                                  "page_id long, url string, html string, key string, text string, row string, low int")
    assert [tuple(r) for r in html.extract(pages).collect()] == [(1, "http://a.org", "a")]


def test_hosts_of_very_many_labels():
    array = urls.RuleArray(urls.rule_bytes([("block", "b.example.org", "/"), ("allow", "org", "/")]))
    start = time.perf_counter()
    found = array.longest(["a." * 20_000 + "b.example.org", "x" * 30_000 + ".org", "." * 20_000, "b.example.org.", ""], ["/"] * 5)
    assert time.perf_counter() - start < 1
    assert [array.string(i).decode() if i >= 0 else None for i in found] == ["b.example.org\n/", "org\n/", None, None, None]
