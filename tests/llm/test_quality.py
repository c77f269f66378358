import re

from pyspark.sql import functions as F

from quillstat.llm import quality as Q

SCHEMA = "doc_id long, text string"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    shouted = [w for w in words if len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered), len(shouted), len(lines),
    )


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e a b c d e", "a a a a a a a", "x y z w v u " * 30, "LOUD!! LOUD!! É!! ÉA AB", "# $ % | plain", "l1\nl1\nl1 \n\nl2",
    "\x1cword\x85w2\u00a0w3 \u2028 end", "\U0001f600 ünï", "w" * 50000, "a b c d e f g h i j " + "k l m n o " * 2 + "p q r s t", " ".join(str(i) for i in range(3000)),
]


def test_measures_against_brute_force():
    for text in TEXTS:
        assert Q.measure(text) == brute(text), text


def test_ledger(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, None), (None, "x")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n_words": F.lit("clash"), "failed": F.lit(0)})
    out = Q.ledger(df, "text", "m")
    for r in out.collect():
        n, chars, symbols, dup, repeat, shout, lines = brute(r.text)
        bits = [n < 10, 100 * repeat > 20 * n, 10 * symbols > n, 2 * dup > lines, 2 * shout > n, chars > 20 * n]
        assert r.m.failed == sum(1 << i for i, b in enumerate(bits) if b)
    assert Q.ledger(df.limit(0), "text", "m").collect() == []


def test_policies_and_ablations(spark):
    bits = [0, 1, 2, 4, 5, 16, 17, 32, 20, 4]
    df = spark.createDataFrame([(b,) for b in bits], "failed long")
    policy = Q.PRODUCTION
    assert [r[0] for r in df.select(Q.passes(F.col("failed"))).collect()] == [b & policy.mask == 0 for b in bits]
    got = {(r.policy, r.version, r.rule): (r.rejected, r.rejected_without, r.alone) for r in Q.ablations(df, list(Q.POLICIES.values())).collect()}
    assert len(got) == sum(len(p.rules) for p in Q.POLICIES.values())
    for p in Q.POLICIES.values():
        for rule in p.rules:
            bit = 1 << list(Q.RULES).index(rule)
            rejected, without = sum(b & p.mask != 0 for b in bits), sum(b & p.mask & ~bit != 0 for b in bits)
            assert got[p.name, p.version, rule] == (rejected, without, sum(b & p.mask == bit for b in bits))
            assert rejected - without == sum(b & p.mask == bit for b in bits)


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    from quillstat.llm.queries import op8_quality

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    r = op8_quality(spark, sf).join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double"))).collect()
    kept = dict(r)
    assert kept[1] >= 0.95 and kept[0] <= 0.05
