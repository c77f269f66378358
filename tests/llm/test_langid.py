from collections import Counter

from pyspark.sql import functions as F

from quillstat.llm import langid
from quillstat.llm.queries import op3_language

SF = "/root/testdata/sf0.01"


def brute_grams(text):
    out = []
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split(" "):
        if word:
            out.extend(word)
            padded = "\1" + word + "\1"
            out += [padded[i : i + 2] for i in range(len(padded) - 1)]
            out += [padded[i : i + 3] for i in range(len(padded) - 2)]
    return Counter(out)


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def brute_rank(counts, size):
    return [g for g, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:size]]


def test_ngrams_against_brute_force():
    for text in ["", "12 !", "a", "The cat, the hat.", "Übergrößen—naïve Ⅷ 東京 x", "a  b\n\nc9d", "\u0130stanbul"]:
        grams = Counter(langid.ngrams(text).tolist())
        assert grams == {code(g): n for g, n in brute_grams(text).items()}, text


def test_distance_against_brute_force(spark):
    learned = [("en", "the cat and the other hat"), ("de", "der hund und die katze"), ("fr", "le chat et la souris"), (None, "x"), ("en", None)]
    df = spark.createDataFrame(learned, "lang string, text string").withColumn("n", F.lit(1)).withColumn("gram", F.lit(1))
    size = 30
    profiles = langid.Profiles.of(langid.learn(df, "text", "lang", size), size)
    assert profiles.langs == ("de", "en", "fr")
    ranks = {
        lang: brute_rank(sum((brute_grams(t) for l, t in learned if l == lang and t), Counter()), size) for lang in profiles.langs
    }
    for text in ["the hat", "die katze und der", "la", "zzz", "et le chat the"]:
        own = brute_rank(brute_grams(text), size)
        away = {
            lang: sum(abs(r.index(g) - i) if g in r else size for i, g in enumerate(own)) for lang, r in ranks.items()
        }
        best = min(away, key=lambda l: (away[l], l))
        assert profiles.judge(text) == (best, 1 - away[best] / (size * len(own)))


def test_edges(spark):
    nothing = spark.createDataFrame([], "lang string, text string")
    profiles = langid.Profiles.of(langid.learn(nothing, "text", "lang"))
    rows = [(1, None), (2, ""), (3, "1 2"), (4, "word " * 50000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit(0))
    assert {tuple(r) for r in langid.predict(df, "text", profiles, "p").select("p.*").collect()} == {("und", 0.0)}
    assert langid.predict(df.limit(0), "text", profiles, "p").collect() == []


def test_held_out_accuracy(spark):
    got = op3_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    row = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score"), F.count("*")).first()
    assert row[3] > 100 and row[0] >= 0.97 and 0 <= row[1] <= row[2] <= 1
