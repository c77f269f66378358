"""The pipeline against the brute-force version of every stage."""

import importlib.util
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from test_bpe import LIBRARY  # noqa: E402
from test_line_dedup import brute as brute_lines  # noqa: E402
from test_mixing import brute_copies, brute_targets  # noqa: E402
from test_quality import brute as brute_measures  # noqa: E402
from test_simhash import brute_components  # noqa: E402

pytestmark = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")
SF = "/root/testdata/sf0.001"


def brute(rows):
    kept = []
    for doc, text, source in rows:
        n, _, symbols, dup, repeat, shout, lines = brute_measures(text)
        if not (n < 10 or 100 * repeat > 20 * n or 10 * symbols > n or 2 * dup > lines or 2 * shout > n):
            kept.append((doc, text, source))
    sources = {doc: s for doc, _, s in kept}
    deduped = brute_lines([(doc, text) for doc, text, _ in kept])
    first = {doc for doc, _, group in brute_components(deduped) if doc == group}
    deduped = [(doc, text) for doc, text in deduped if doc in first]
    sizes = {}
    for doc, text in deduped:
        sizes[sources[doc]] = sizes.get(sources[doc], 0) + len(text.split())
    targets = brute_targets(sizes)
    out = []
    for doc, text in deduped:
        s = sources[doc]
        rate = targets[s] / sizes[s] if sizes[s] else 0.0
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        out += [(doc, b"".join(i.to_bytes(4, "little") for i in ids))] * brute_copies(rate, doc, text, 0, "mix")
    return sorted(out)


def test_run(spark):
    import corpus_pipeline

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    got = corpus_pipeline.run(spark, SF)
    out = got.collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in out) == brute(rows)
    assert all(r.round_trip and r.n_tokens == len(r.ids) // 4 for r in out)


def test_stages_on_difficult_rows(spark):
    import corpus_pipeline

    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "w x y z " * 3000, None, "a", 9), (2, "w x y z " * 3000, None, "a", 9), (3, " ".join(map(str, range(30))), "de", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, table, SF)
            got.collect()
            if n < len(corpus_pipeline.STAGES) - 1:
                assert got.columns == docs.columns, name
