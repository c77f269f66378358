import re
from collections import Counter

from pyspark.sql import functions as F

from quillstat.llm.html_extract import _uncovered, blocks, main_text
from quillstat.llm.queries import op9_html

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def page(spark, *pages):
    return main_text(spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], SCHEMA))


def test_marked_elements_and_references(spark):
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
      <header>Top</header><nav><ul><li>Menu <b>x</li></ul></nav><div class="cookie-notice"><div>We use</div> cookies</div>
      <article><h1>Caf&eacute;&nbsp; &amp; <i>more</i></h1><!-- no <p>comment --><p>One<b>two</b>
      three<br>four <script>var a="</p>";</script><aside>side</aside><form>Name <input></form><p class="ad">buy<p>five &lt;b&gt; 6 &#60; 7</p>
      <div class="comments"><div><p>first!</p></div></div> tail</article><footer>&copy; foot</footer></body></html>"""
    assert texts(page(spark, ("http://h/", html))) == {0: "Café & more Onetwo three four five <b> 6 < 7 tail"}


def test_broken_markup():
    assert blocks("<article><p>a<p>b</div></article>") == [("a", True, False), ("b", True, False)]
    assert blocks("<article>x <script>never closed") == [("x", True, False)]
    assert blocks("a < b <!-- open") == [("a < b", False, False)]
    assert blocks(None) == [] == blocks("")
    assert blocks("<nav><ul><li>m</nav><p>t") == [("m", False, True), ("t", False, False)]
    assert blocks("<p title='a>b'>x</p>") == [("x", False, False)]


def test_boilerplate_of_a_host(spark):
    boiler = "subscribe now to read all our stories today"
    bodies = [f"<p>{boiler}</p><p>page {i} has own{i} words{i} here{i} number {i * 7} indeed</p><p>short</p>" for i in range(4)]
    got = texts(page(spark, *[("http://one.example/x", b) for b in bodies], ("http://two.example", bodies[0])))
    assert got[4] == f"{boiler} page 0 has own0 words0 here0 number 0 indeed short"  # another host
    for i in range(4):
        assert got[i] == f"{i} has own{i} words{i} here{i} number {i * 7} indeed short"  # "page" ends the repeated run


def brute_runs(streams, run):
    """Positions of each stream in a run of tokens that another stream has too."""
    out = []
    for i, s in enumerate(streams):
        grams = {tuple(t[p : p + run]) for j, t in enumerate(streams) if j != i for p in range(len(t) - run + 1)}
        out.append([p for p in range(len(s) - run + 1) if tuple(s[p : p + run]) in grams])
    return out


def test_repeated_runs_against_brute_force(spark):
    import random

    rng = random.Random(1)
    streams = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(12)]
    streams = [list(x) for x in {tuple(s) for s in streams}]
    got = texts(page(spark, *[("http://h/p", f"<p>{' '.join(s)}</p>") for s in streams]))
    for i, (s, starts) in enumerate(zip(streams, brute_runs(streams, 6))):
        assert got[i] == " ".join(filter(None, _uncovered([{"pos": 0, "text": " ".join(s)}] if s else [], starts, 6)))


def test_runs_inside_articles(spark):
    """The array takes a long run from most pages' articles, in whatever blocks it stands; copies and quotes stay."""
    import random

    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    share, quote, short = words(30), words(40), words(10)
    copy = f"<p>{words(60)}</p><p>{share}</p>"
    bodies = [(words(50), words(20)) for _ in range(20)]
    pages = [("http://h/", f"<article><p>{a}</p><p>{share}</p><p>{b} {quote if i < 9 else ''} {short}</p></article>") for i, (a, b) in enumerate(bodies)]
    pages += [("http://two/", f"<article>{copy}<p>{words(3)}</p></article>") for _ in range(8)]
    got = texts(page(spark, *pages))
    for i, (a, b) in enumerate(bodies):
        assert got[i] == " ".join(f"{a} {b} {quote if i < 9 else ''} {short}".split())
    assert all(got[i] == " ".join(re.sub("<[^>]*>", " ", pages[i][1]).split()) for i in range(20, 28))


def test_article_runs_against_brute_force(spark):
    import random

    rng = random.Random(4)
    passages = [[f"p{k}x{i}" for i in range((20, 30, 40, 60)[k])] for k in range(4)]
    streams = []
    for i in range(12):
        s = [f"own{i}x{j}" for j in range(150)]
        for p in passages:
            if rng.random() < 0.85:
                at = rng.choice((0, 50, 100)) if s[0] == f"own{i}x0" else len(s)
                s[at:at] = p[rng.randint(0, 3) :]
        streams.append(s)
    need = 7
    held = Counter(g for s in streams for g in {tuple(s[p : p + 24]) for p in range(len(s) - 23)})
    got = texts(page(spark, *[("http://h/p", f"<main>{' '.join(s)}</main>") for s in streams]))
    changed = 0
    for i, s in enumerate(streams):
        starts = [p for p in range(len(s) - 23) if held[tuple(s[p : p + 24])] >= need]
        changed += bool(starts)
        covered = {p + j for p in starts for j in range(24)}
        assert got[i] == " ".join(w for j, w in enumerate(s) if j not in covered)
    assert changed >= need


def test_edges(spark):
    rows = [(1, None, None), (2, "x", ""), (None, None, "<p>lone words of a page without any host here</p>"), (4, "http://a", "<article>" + "w " * 60000), (4, "http://a", "<article>dup</article>"), (4, "http://a", "<article>dup</article>")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"text": F.lit(1), "host": F.lit(2), "hash": F.lit(3), "parts": F.lit(4)})
    got = sorted(((r.page_id or 0), r.n_chars) for r in main_text(df).collect())
    assert got == [(0, len("lone words of a page without any host here")), (1, 0), (2, 0), (4, 3), (4, 3), (4, 119999)]
    assert main_text(df.limit(0)).collect() == []


def test_query_keeps_the_articles(spark):
    got = {r.page_id: r for r in op9_html(spark, SF).collect()}
    import html

    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        plain = re.sub(r"</?(?:p|h1|br|li|ul|div)[^>]*>", " ", article)
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", "", plain)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))


def test_copies_and_phrases_of_a_large_host_stay(spark):
    phrase, boiler = "as we have said so often before", "all rights of this site are reserved"
    bodies = [f"<p>own{i} {phrase if i < 3 else ''} text{i}</p><p>{boiler}</p>" for i in range(40)]
    copy = "<p>one long article that stands on two pages of the host word by word</p>"
    got = texts(page(spark, *[("http://h/", b) for b in [*bodies, copy, copy]], *[("http://two/", copy)] * 2))
    assert [got[i] for i in range(3)] == [f"own{i} {phrase} text{i}" for i in range(3)]
    assert [got[i] for i in range(3, 40)] == [f"own{i} text{i}" for i in range(3, 40)]
    assert {got[i] for i in range(40, 44)} == {copy[3:-4]}


def kept(html):
    return " ".join(t for t, main, other in blocks(html) if main and not other)


def test_hints_do_not_cut_the_article():
    assert kept('<div class="sidebar">intro<main>text</main></div>') == "text"
    assert blocks('<div class="sidebar">intro<main>text</main></div>')[0] == ("intro", False, False)
    assert kept('<div class="content-sidebar-wrap"><main>a</main></div>') == "a"
    assert kept('<div class="site has-sidebar"><article>a</article></div>') == "a"
    assert kept('<article><h2 id="related-work">R</h2><p class="share-price">s<section id="search-methods">m</section><h2 id="comments">c</h2></article>') == "R s m c"
    assert kept('<article>a <span class="ad">b</span> c<p class="ad">d</p></article>') == "a b c"
    assert kept('<article><ul><li class="ad">x<li>y</ul><div><div class="ad">z</div>k</div><div class="ad">q</article><main>r</main>') == "y k r"
    assert kept('<article>a</article><div id="comments"><article>c</article></div>') == "a"


def test_raw_and_unshown_elements():
    assert kept('<article>a<svg class="i"/>b <iframe src=x/>c<p>d</p></iframe></article><main>e</main>') == "ab e"
    assert kept('<article>a <svg><path d="M0"/><p>b</p><select><option>c</select><math>d <p>e</article>') == "a b d e"
    assert kept('<article>a<svg><title>t</title><text>u</text></svg> b<iframe>c</article>') == "a bc"
    assert kept('<article>a <svg/> b <svg><text>u</text></svg>c<object data="x"/>d</article>') == "a b cd"
    assert kept('<article>a <script src="x"/> b <script src=/x/>c</script>d</article>') == "a b d"
