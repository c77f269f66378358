"""The registered queries of this subpackage, and DuckDB SQL where SQL can express them.

Each query applies its operator with production parameters to the whole table
and returns the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table
from . import align, bpe, html_extract, langid, line_dedup, mixing, phrases, quality, rule_ensemble, sharding, simhash, topk, url_filter
from .common import count_words, cut

#: The vocabulary file that encoding uses.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The sentencepiece model that alignment sets beside it.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Shards that the sharding query fills.
SHARDS = 40
#: The url rules.
URL_RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), runs_col="runs")
    size = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    return done.select(
        "doc_id",
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_runs"),
        F.coalesce(size, F.lit(0)).cast("long").alias("n_deleted"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        "lang",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)).alias("held_out"),
    )
    known = docs.where("NOT held_out AND doc_id IS NOT NULL")
    profiles = langid.Profiles.of(langid.learn(known, "text", "lang"))
    return langid.predict(docs.drop("lang"), "text", profiles, "p").select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op5_bpe(spark: SparkSession, sf_dir: str, vocabulary_path: str = VOCABULARY) -> DataFrame:
    vocabulary = bpe.load(spark, vocabulary_path)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, "text", vocabulary, "ids"), "ids", vocabulary, "decoded")
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str, maps: str | None = None) -> DataFrame:
    """``maps`` is the folder of the map's versions: the newest is edited for the table.  Without one, a new folder."""
    text = F.coalesce("text", F.lit(""))
    records = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    slotted = sharding.slotted(cut(records), ["doc_id", "text_crc32", "size"])
    slot_map = sharding.current_map(spark, maps or sharding.new_folder(spark), sharding.slot_sizes(slotted), SHARDS)
    return sharding.assign(slotted, ["doc_id", "text_crc32", "size"], slot_map).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cut(topk.quantized(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
    return topk.top_k(rows, rows.where("id % 50 = 0"), k=5)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.ledger(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "m")
    base = ~quality.passes(F.col("m.failed"), quality.BASE)
    return judged.select(
        "doc_id",
        "m.n_words",
        "m.word_chars",
        "m.n_symbols",
        "m.n_dup_lines",
        "m.n_repeat_words",
        base.alias("base_failed"),
        quality.passes(F.col("m.failed")).alias("kept"),
        "m.failed",
    )


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(read_table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.planned(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    known = read_table(spark, sf_dir, "labels").where(~held_out)
    ensemble = rule_ensemble.fit(rule_ensemble.sample(docs.where("NOT held_out"), known, "doc_id", "text", "quality"))
    scored = rule_ensemble.score(docs, "text", ensemble, "score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = align.load(spark, VOCABULARY, PIECES)
    return align.align(read_table(spark, sf_dir, "documents"), "doc_id", "text", vocabularies).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_line_dedup,
        op3_language,
        op4_url_filter,
        op5_bpe,
        op6_sharding,
        op7_top_k,
        op8_quality,
        op9_html,
        op10_mixing,
        op11_quality_rules,
        op12_phrases,
        op13_align,
    )
}

#: Lines with a word, numbered among themselves between two sentinels; windows of two, and of one line of 20 words
#: or more; later holders delete.
_LINES = r"""
lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL),
items AS (
  SELECT doc_id, text, i, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM lines),
worded AS (
  SELECT doc_id, text, i, t, row_number() OVER (PARTITION BY doc_id, text ORDER BY i) AS s,
         lead(t) OVER (PARTITION BY doc_id, text ORDER BY i) AS after_t,
         lead(i) OVER (PARTITION BY doc_id, text ORDER BY i) AS after_i
  FROM items WHERE t <> ''),
windows AS (
  SELECT doc_id, text, 2 AS size, 0 AS s, NULL AS a, t AS b, i AS first, i AS last FROM worded WHERE s = 1
  UNION ALL
  SELECT doc_id, text, 2, s, t, after_t, i, coalesce(after_i, i) FROM worded
  UNION ALL
  SELECT doc_id, text, 1, s, t, NULL, i, i FROM worded WHERE len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) >= 20),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY size, a, b ORDER BY doc_id, s) AS n FROM windows),
gone AS (
  SELECT DISTINCT doc_id, text, unnest(range(first, last + 1)) AS i FROM ranked WHERE n > 1),
kept AS (
  SELECT l.doc_id, l.text, string_agg(l.line, chr(10) ORDER BY l.i) AS left_text
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.text = g.text AND l.i = g.i
  GROUP BY ALL),
runs AS (
  SELECT doc_id, text, count(*) AS n_deleted,
         sum(CASE WHEN i = before + 1 THEN 0 ELSE 1 END) AS n_runs
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id, text ORDER BY i) AS before FROM gone) GROUP BY ALL)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
WITH {_LINES}
SELECT d.doc_id, CAST(coalesce(r.n_runs, 0) AS BIGINT) AS n_runs, coalesce(r.n_deleted, 0) AS n_deleted,
       length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.left_text, '') END) AS n_chars,
       md5(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.left_text, '') END) AS text_md5
FROM documents d
LEFT JOIN runs r ON d.doc_id = r.doc_id AND d.text = r.text
LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
""",
    "op7_top_k": """
WITH fine AS (
  SELECT DISTINCT vec_id AS id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
numbered AS (SELECT *, row_number() OVER () AS n FROM fine),
scored AS (
  SELECT q.n, q.id AS query_id, r.id AS vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM numbered q JOIN numbered r ON q.n <> r.n AND q.id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
""",
    "op8_quality": r"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
split_words AS (SELECT row, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts),
words AS (SELECT row, unnest(w) AS word, unnest(range(len(w))) AS i FROM split_words),
grams AS (
  SELECT row, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS gram,
         lead(word, 4) OVER o AS fifth
  FROM words WINDOW o AS (PARTITION BY row ORDER BY i)),
twice AS (SELECT row, i FROM (SELECT *, count(*) OVER (PARTITION BY row, gram) AS n FROM grams WHERE fifth IS NOT NULL) WHERE n > 1),
covered AS (
  SELECT row, count(*) AS n FROM (SELECT DISTINCT row, unnest(range(i, i + 5)) AS i FROM twice) GROUP BY row),
lines AS (
  SELECT row, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
sums AS (
  SELECT row, count(*) AS n_words, sum(length(word)) AS word_chars,
         sum(length(word) - length(regexp_replace(word, '[#*$%&|<>]', '', 'g'))) AS n_symbols,
         count(*) FILTER (regexp_matches(word, '[A-Z].*[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS n_shouted
  FROM words GROUP BY row),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(coalesce(n_symbols, 0) AS BIGINT) AS n_symbols, coalesce(n_lines - n_distinct, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words, coalesce(n_shouted, 0) AS n_shouted, coalesce(n_lines, 0) AS n_lines
  FROM texts LEFT JOIN sums USING (row) LEFT JOIN lines USING (row) LEFT JOIN covered c USING (row)),
failures AS (
  SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_shouted > n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed & 31 = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM failures
""",
    "op10_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS key FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key, source) - 1 AS number FROM sized),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST(CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS w, 2.0 * source_size AS most FROM sums),
ordered AS (
  SELECT *, most / w AS full_at,
         CAST(1.5 * (SELECT sum(source_size) FROM sums) AS DOUBLE)
           - coalesce(sum(CAST(most AS DOUBLE)) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_pot,
         (SELECT sum(w) FROM weighted)
           - coalesce(sum(w) OVER (ORDER BY most / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_w
  FROM weighted),
level AS (
  SELECT left_pot / left_w AS l FROM ordered WHERE full_at * left_w > left_pot ORDER BY full_at, place LIMIT 1),
targets AS (
  SELECT source, source_size,
         CAST(CASE WHEN full_at * left_w <= left_pot THEN most ELSE (SELECT l FROM level) * w END AS DOUBLE) AS target
  FROM ordered),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(('0x' || substr(md5(key || ':' || number || ':mix'), 1, 13)) AS BIGINT) / 4503599627370496.0 AS draw
  FROM numbered d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
""",
    "op12_phrases": r"""
WITH texts AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
  FROM documents),
pieces AS (SELECT doc, lang, unnest(p) AS piece, unnest(range(len(p))) AS i FROM texts),
listed AS (SELECT doc, lang, i, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT doc, lang, i, unnest(w) AS w1, unnest(range(len(w))) AS j FROM listed),
grams AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM words WINDOW o AS (PARTITION BY doc, i ORDER BY j)),
counted AS (
  SELECT lang, [w1] AS w, count(*) AS a FROM grams GROUP BY ALL
  UNION ALL SELECT lang, [w1, w2], count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM grams WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counted WHERE len(w) = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE len(w) > 1),
cuts AS (SELECT lang, w, a, unnest(range(1, len(w))) AS k FROM candidates),
scores AS (
  SELECT c.lang, c.w, c.a, c.k, l.a AS l, r.a AS r, CAST(CAST(c.a AS HUGEINT) * 2000000 // (l.a + r.a) AS BIGINT) AS score
  FROM cuts c JOIN counted l ON l.lang = c.lang AND l.w = c.w[1:c.k] JOIN counted r ON r.lang = c.lang AND r.w = c.w[c.k + 1:]),
weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
spans AS (SELECT lang, w, a, unnest(range(1, len(w) + 1)) AS s FROM candidates),
parts AS (SELECT lang, w, a, s, unnest(range(s + 1, len(w) + 1)) AS e FROM spans),
longer AS (SELECT lang, w[s:e] AS part, max(a) AS most FROM parts WHERE e - s + 1 < len(w) GROUP BY ALL),
kept AS (
  SELECT k.* FROM weakest k LEFT JOIN longer g ON g.lang = k.lang AND g.part = k.w WHERE g.most IS NULL OR 100 * g.most < 80 * k.a),
ranked AS (
  SELECT *, array_to_string(w, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(w, ' '))) AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
}
