import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillstat.llm import bpe
from quillstat.llm.queries import VOCABULARY, op5_bpe

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
CODEC = bpe.Codec(open(VOCABULARY, "rb").read())


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    packed = CODEC.encode(text)
    got = [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]
    assert got == want, text
    assert CODEC.decode(packed) == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "\n\n  x", "Hello world's   end", "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|endoftext", "x" * 3000, "\u00e9\u4e2d\U0001f600\u200d\ufeff",
        "tab\t\ttab \x0b\x0c\x1c\x1d\x85\xa0\u2028 z", "123456789012345 1,000.5", "don't WE'LL 'S", "ab" * 2000, "\x00\x01\x7f", "ſ ﬀ Ⅷ ² ½ ௧", " \u3000 \u3000x", "!" * 500,
    ],
)
def test_cases(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_random_texts(text):
    same(text)


def test_cuts_are_forced():
    tokens = set(CODEC.tokens.values())
    data = "zq\u4e2dxqj #$vwq".encode()
    for i in range(1, len(data)):
        assert (i in CODEC.cuts(data)) == (not any(data[i - 1 : i + 1] in t for t in tokens))


def test_query_against_the_library(spark):
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in op5_bpe(spark, SF).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_null_empty_and_repeated_rows(spark):
    v = bpe.load(spark, VOCABULARY)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (3, "word"), (4, "long " * 40000)], "doc_id long, text string")
    out = bpe.decode(bpe.encode(df.withColumn("decoded_", F.lit(1)), "text", v, "ids"), "ids", v, "back")
    assert sorted((r.doc_id, r.back) for r in out.collect()) == [(1, ""), (2, ""), (3, "word"), (3, "word"), (4, "long " * 40000)]
    assert bpe.encode(df.limit(0), "text", v, "ids").collect() == []


def test_vocabulary_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_VOCABULARY", 1000)
    with pytest.raises(ValueError):
        bpe.load(spark, VOCABULARY)


def test_pretokens_follow_the_pattern(monkeypatch):
    import random

    import regex

    monkeypatch.setattr(bpe, "GROUP", 40)
    monkeypatch.setattr(bpe, "REMEMBERED", 200)
    rng = random.Random(7)
    signs = [" ", "  ", "\n", "\t", "a", "the", "é", "1", ".", "'", "'s", "'re", "'ll", "'S", "!", "　", "\xa0", "\x1c", "中", "😀", "²", "<|endoftext|>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text, packed in zip(texts, CODEC.encode_all(texts)):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert packed == b"".join(i.to_bytes(4, "little") for i in ids), text
    for text in texts:
        if text:
            points = bpe.np.array([ord(c) for c in text], dtype=bpe.np.int64)
            start = CODEC._starts(points, bpe.np.array([0])).tolist()
            assert [text[a:b] for a, b in zip(start, [*start[1:], len(text)])] == regex.findall(bpe.PATTERN, text)
