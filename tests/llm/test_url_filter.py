import math
import re

from pyspark.sql import functions as F

from quillstat.llm import url_filter as U
from quillstat.llm.queries import URL_RULES, op4_url_filter

SF = "/root/testdata/sf0.01"


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fit = [
        r for r in URL_RULES if (host == r.text.split("/")[0] or host.endswith("." + r.text.split("/")[0])) and path.startswith("/" + r.text.split("/", 1)[1])
    ]
    return max(fit, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1", "http://example.org/en/12", "http://badexample.org/en/12", "http://x.org",
    "http://x.org?a=/", "https://h.com/fr/a#b", "https://com/de/x", "https://a.b.com/de/", "x://y://z/w", "http://ÄB.net/p?q=1&r=2", "http://a.net/" + "s/" * 30000,
    "http://x.org/\n/?", "http://example.org/es/\\E[",
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, None)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "label": F.lit("x"), "f_length": F.lit(0)})
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(df, URL_RULES).collect())
    assert [g[0] for g in got] == sorted(i for i, _ in rows)
    for i, host, path, rule, verdict in got:
        assert (host, path) == brute_host_path(rows[i][1])
        want = brute_rule(host, path)
        assert rule == (want and want.text) and (verdict == want.verdict if want else verdict in ("allow", "block"))


def test_features(spark):
    url = "http://a-b.example.com/en/x1/y?p=1&q=22#f"
    row = U.with_features(
        spark.createDataFrame([(url, *brute_host_path(url))], "url string, host string, path string")
    ).first()
    p = [url.count(c) / len(url) for c in set(url)]
    assert math.isclose(row.f_entropy, -sum(x * math.log2(x) for x in p))
    assert (row.f_length, row.f_depth, row.f_params, row.f_labels, row.f_hyphens) == (len(url), 3, 2, 3, 1)
    assert math.isclose(row.f_digits, 4 / len(url)) and (row.suffix, row.segment) == ("com", "com/en")


def test_nothing_labelled_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in U.filter_urls(df, URL_RULES).collect()} == {"allow"}
    assert U.filter_urls(df.limit(0), URL_RULES).collect() == []
    one = spark.createDataFrame([("http://z.net", 1), (None, None)], "url string, label int")
    assert {r.verdict for r in U.filter_urls(df, URL_RULES, labelled=one).collect()} == {"block"}


def test_sample_holds_both_labels_and_its_bound(spark, monkeypatch):
    """Thousands of copies of one url neither fill the sample nor keep it out."""
    seen = []
    real = U._with_rates

    def spy(urls, *args, own):
        if own:
            seen.append(urls)
        return real(urls, *args, own=own)

    monkeypatch.setattr(U, "_with_rates", spy)
    for copies in ("http://bad.com/de/x", "http://good.org/a"):
        rows = [(copies, int("bad" in copies))] * 3000 + [(f"http://h{i}.net/{i}", i % 2) for i in range(30)]
        model = U.train(spark.createDataFrame(rows, "url string, label int"), sample=20)
        got = seen.pop().select("url", "label", "weight").collect()
        assert len(got) == len({r.url for r in got}) == 20 and sum(r.label for r in got) == 10
        assert all(r.weight in (1.5, 1.6) for r in got) and model.trees is not None


def test_held_out_accuracy(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    parts = {"host": U.host_of(F.col("url")), "path": U.path_of(F.col("url"))}
    ruled = pages.withColumn("r", U.apply_rules(parts["host"], parts["path"], URL_RULES)).where("r IS NOT NULL")
    labelled = ruled.select("url", (F.col("r.verdict") == "block").cast("int").alias("label"), "page_id")
    model = U.train(labelled.where("page_id % 4 <> 2"))
    test = U.judge(labelled.where("page_id % 4 = 2").withColumns(parts), model)
    right = test.agg(F.avg(((F.col("learned") == "block").cast("int") == F.col("label")).cast("double")), F.count("*")).first()
    assert right[1] > 200 and right[0] >= 0.9


def test_query(spark):
    got = op4_url_filter(spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    rows = got.collect()
    assert len(rows) == len(urls)
    for r in rows:
        want = brute_rule(*brute_host_path(urls[r.page_id]))
        assert (r.host, r.path) == brute_host_path(urls[r.page_id]) and r.rule == (want and want.text)
