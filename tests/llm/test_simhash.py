import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from quillstat.llm import simhash
from quillstat.llm.components import connected_components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def brute_fingerprint(text, n=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits=3):
    fps = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            groups[find(i)] = min(doc, groups.get(find(i), doc))
    return sorted((doc if doc is not None else -1, f"{fp:016x}", groups.get(find(i), -1)) for i, ((doc, _), fp) in enumerate(zip(rows, fps)))


def result(df):
    return sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in df.collect())


ROWS = [
    (1, "A b c d e"), (2, "a B C d E"), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, "ONE two"), (8, "ünï cödé Ä\u00a0b ß"),
    (9, "x " * 70000 + "tail"), (10, "x " * 70000 + "tails"), (1, "A b c d e"), (None, "a b c d e"), (None, "alone in the world"),
]


def test_edges_against_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"fp": F.lit("x"), "component_id": F.lit(9), "id": F.lit(0)})
    assert result(simhash.near_duplicates(df)) == brute_components(ROWS)


def test_table_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    from quillstat.llm.queries import op1_simhash

    assert result(op1_simhash(spark, SF)) == brute_components(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_duplicates(empty).collect() == []


@pytest.mark.parametrize("hot,chunk", [(64, 2048), (2, 5), (1, 3)])
def test_links_have_the_components_of_all_pairs(spark, hot, chunk):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):  # families around a centre, and a pair of families that share a half
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(15)}
        fps |= {centre ^ (rng.getrandbits(32) << 32) for _ in range(3)}
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in fps], "fp long"), 3, hot, chunk)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {x: roots.get(x, x) for x in fps} == {x: find(x) for x in fps}


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1050)]
    links = spark.createDataFrame(chain + star + [(5, 5), (None, 3), (160, 100), (100, 101)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1050)]}
    assert connected_components(links.limit(0)).collect() == []


def test_one_of_each_group_stays(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"fp__": F.lit("x"), "source": F.lit("s")})
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    want = {}
    for doc, _, group in brute_components(ROWS):
        want.setdefault(group, doc)
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    # (None, "alone ...") is the only group without an id
    assert ids == sorted(want)
