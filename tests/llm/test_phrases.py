"""Collocations against plain counting; the query also has SQL."""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quillstat.llm import phrases

SF = "/root/testdata/sf0.001"


def brute_force(rows, least, most_words=4, first=2000):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", folded):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for m in range(1, most_words + 1):
                for i in range(len(words) - m + 1):
                    key = lang, tuple(words[i : i + m])
                    counts[key] = counts.get(key, 0) + 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    found = {}
    for (lang, w), a in candidates.items():
        cuts = [(counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w))]
        score, k = min((2_000_000 * a // (l + r), k) for k, (l, r) in enumerate(cuts))
        inside = any(
            o == lang and len(v) > len(w) and 100 * b >= 80 * a and any(v[i : i + len(w)] == w for i in range(len(v)))
            for (o, v), b in candidates.items()
        )
        if not inside:
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), *cuts[k]))
    return {
        (lang, rank, p.decode(), -a, l, r, totals[lang], -s)
        for lang, some in found.items()
        for rank, (s, a, p, l, r) in enumerate(sorted(some)[:first], 1)
    }


def _rows(df):
    rows = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


HARD = [
    ("en", "New York City is big. New York City, new york! A new york city\tnew york city"),
    ("en", "new york city is big; a a a a a a a a"),
    ("en", None),
    (None, ""),
    (None, "the end the end the end\x0bthe end\rthe  end \t the end"),
    ("und", "The end, the end."),
    ("fr", "l'été l'été É é l'été \x85 l'été É é \xa0 É é"),
    ("en", "new york city is big; a a a a a a a a"),
    ("fr", " . , ;; ::\n\n"),
    ("de", "wort " * 5000),
]


def test_hard_texts(spark):
    docs = spark.createDataFrame(HARD, "lang string, text string").selectExpr("*", "1 AS id", "2 AS block", "3 AS word", "4 AS n")
    for least, first, block, bucket in ((2, 2000, 1, 20), (3, 3, 1 << 20, 1 << 20)):
        got = _rows(phrases.collocations(docs, least=least, first=first, block=block, bucket=bucket))
        assert got == brute_force(HARD, least, first=first)


def test_real_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert _rows(phrases.collocations(docs, least=12)) == brute_force(rows, 12)


def test_nothing_frequent(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert _rows(phrases.collocations(empty)) == set()
    assert _rows(phrases.collocations(spark.createDataFrame(HARD[:2], "lang string, text string"))) == set()


def test_tiles(monkeypatch):
    rng = np.random.default_rng(3)
    for tile, dense in ((4, 1), (4, 1000), (256, 8)):
        monkeypatch.setattr(phrases, "TILE", tile)
        monkeypatch.setattr(phrases, "DENSE", dense)
        ids = np.where(rng.random(5000) < 0.01, 70_000, rng.geometric(0.15, 5000) - 2)
        left, right, n, place = phrases.count_pairs(ids)
        want = Counter((a, b) for a, b in zip(ids.tolist(), ids[1:].tolist()) if a >= 0 and b >= 0)
        assert dict(zip(zip(left.tolist(), right.tolist()), n.tolist())) == want
        for i, p in enumerate(place.tolist()):
            assert (p >= 0) == (ids[i] >= 0 and ids[i + 1] >= 0)
            assert p < 0 or (left[p], right[p]) == (ids[i], ids[i + 1])
    for ids in (np.zeros(0, dtype=np.int64), np.array([3]), np.array([-1, 4, -1])):
        assert len(phrases.count_pairs(ids)[0]) == 0


def test_scores_beyond_64_bits(spark):
    rows = [(40_000_000_000_000, 40_000_000_000_001, 40_000_000_000_000), (1, 1, 1), (30, 31, 7_000_000)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [2_000_000 * a // (l + r) for a, l, r in rows]
