"""Alignment against the two libraries, link by link."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quillstat.llm import align
from quillstat.llm.queries import PIECES, VOCABULARY, op13_align

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def aligner():
    with open(VOCABULARY, "rb") as f, open(PIECES, "rb") as g:
        return align.Aligner(f.read(), g.read())


def _shown_bytes():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _tokens(libraries, text):
    a, b = libraries
    of = _shown_bytes()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.encode(text)
    raw_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
    raw_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, map(b.id_to_piece, ids_b))
    ]
    whole = (" " + text).encode()
    if not text or b"".join(raw_a) != whole or b"".join(raw_b) != whole:
        return [], []
    return list(zip(ids_a, np.cumsum([len(r) for r in raw_a]).tolist())), list(zip(ids_b, np.cumsum([len(r) for r in raw_b]).tolist()))


def brute_force(libraries, rows):
    """Contract rows, one token at a time."""
    found, counts = [], Counter()
    for _, text in rows:
        a, b = _tokens(libraries, text or "")
        links = [(i, j) for i, e in a for j, f in b if e == f] if len(a) < 300 else None
        if links is None:
            at = {f: j for j, f in b}
            links = [(i, at[e]) for i, e in a if e in at]
        counts.update(links)
        found.append((a, b, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for (doc_id, _), (a, b, links) in zip(rows, found):
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        groups, a_left, b_left = [], list(a), list(b)
        for cut in cuts:
            members = []
            for side in (a_left, b_left):
                n = next((n for n, (_, e) in enumerate(side) if e > cut), len(side))
                members.append(",".join(str(i) for i, _ in side[:n]))
                del side[:n]
            groups.append("|".join(members))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha,
        ))
    return out


COLUMNS = "id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
HARD = [
    (1, "The quick brown fox isn't here."),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "<|endoftext|> is text, <s> and </s> too"),
    (6, "▁not given back"),
    (7, "naïve façade – 中文字符 👩‍👩‍👧 \u0000 \x07"),
    (8, "  two  spaces\t\ttabs\r\n\nlines   "),
    (9, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20),
    (None, "The quick brown fox isn't here."),
    (1, "The quick brown fox isn't here."),
    (10, "word " * 3_000),
]


def _vocabularies(spark):
    return align.load(spark, VOCABULARY, PIECES)


def test_hard_texts(spark, libraries):
    docs = spark.createDataFrame(HARD, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS pairs", "2 AS block", "3 AS id")
    for block in (1, 1000, align.BLOCK):
        rows = align.align(docs, "doc_id", "text", _vocabularies(spark), block).select(*COLUMNS).collect()
        assert Counter(map(tuple, rows)) == Counter(brute_force(libraries, HARD))


def test_query_is_brute_force(spark, libraries):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = op13_align(spark, SF).select("doc_id", *COLUMNS[1:]).collect()
    assert Counter(map(tuple, rows)) == Counter(brute_force(libraries, docs))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(docs, "doc_id", "text", _vocabularies(spark)).count() == 0


def test_row_products_are_matrix_products(monkeypatch):
    rng = np.random.default_rng(7)
    monkeypatch.setattr(align, "RUN", 17)
    for _ in range(20):
        a, b = (rng.random(s) < 0.3 for s in ((12, 30), (30, 9)))
        csr = [align.Csr(np.append(0, np.cumsum(m.sum(1))), np.nonzero(m)[1], m.shape[1]) for m in (a, b)]
        rows, cols, values = align.row_products(*csr)
        full = np.zeros((12, 9), dtype=int)
        full[rows, cols] = values
        assert (full == a.astype(int) @ b.astype(int)).all()
        assert (values > 0).all()


def test_overlaps_and_shared_groups(aligner):
    x = aligner.align(["unbelievable naïveté, 12345 tokens"])
    start_a, start_b = (np.append(0, e[:-1]) for e in (x.a_ends, x.b_ends))
    want = {
        (i, j): n
        for i in range(len(x.a))
        for j in range(len(x.b))
        if (n := min(x.a_ends[i], x.b_ends[j]) - max(start_a[i], start_b[j])) > 0
    }
    assert dict(zip(zip(*(v.tolist() for v in x.overlaps()[:2])), x.overlaps()[2])) == want
    ga, gb = (g.indices for g in x.groups())
    shared = set(zip(*(v.tolist() for v in x.shared_groups()[:2])))
    assert shared == {(i, j) for i, g in enumerate(ga) for j, h in enumerate(gb) if g == h}
    assert set(want) <= shared


def test_links_of_each_text(spark, aligner):
    docs = spark.createDataFrame(HARD[:9], "doc_id long, text string")
    rows = {r["id"]: r for r in align.links(docs, "doc_id", "text", _vocabularies(spark)).collect()}
    x = aligner.align([HARD[0][1]])
    assert [(l["a"], l["b"], l["bytes"]) for l in rows[1]["links"]] == list(zip(*(v.tolist() for v in x.overlaps())))
    assert sum(l["together"] for l in rows[1]["links"]) == len(rows[1]["groups"])
    assert rows[2]["a"] == rows[3]["links"] == rows[6]["groups"] == []
