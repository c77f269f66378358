import random

import pytest
from pyspark.sql import functions as F

from quillstat.llm.line_dedup import dedup_lines, repeated_runs

SCHEMA = "doc_id long, text string"
WHITE = " \t\n\x0b\x0c\r"


def brute(rows, window=2):
    """Every window of every text against all earlier ones."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = set(), {}
    for doc, text in docs:
        items = [(x.strip(WHITE), i) for i, x in enumerate(text.split("\n")) if x.strip(WHITE)]
        if not items:
            continue
        items = [(None, -1), *items, (None, -1)]
        for s in range(max(1, len(items) - window + 1)):
            w = items[s : s + window]
            key, at = tuple(x for x, _ in w), [i for _, i in w if i >= 0]
            if not at:
                continue
            if key in seen:
                gone.setdefault((doc, text), set()).update(range(min(at), max(at) + 1))
            seen.add(key)
    return sorted(
        (-1 if doc is None else doc, text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get((doc, text), ())))
        for doc, text in rows
    )


def got(df, window=2):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in dedup_lines(df, window=window).collect())


def key(rows):
    return [(a, b or "") for a, b in rows]


@pytest.mark.parametrize("window", [1, 2, 3, 4])
def test_random_texts_against_brute_force(spark, window):
    rng = random.Random(window)
    lines = ["alpha", "beta", "gamma x", " gamma x ", "", "  ", "delta", "tail line"] + [f"own {i}" for i in range(30)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14)))) for i in range(1, 61)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df, window) == brute(rows, window)


def test_edges(spark):
    copy = "a b\nc d\ne f"
    rows = [
        (1, copy), (2, copy), (2, copy), (3, None), (4, ""), (5, "\n \n"), (6, "a b"), (7, "new\nc d\ne f\nmore"),
        (8, "\n".join(["same"] * 500)), (9, "\n".join(f"l{i}" for i in range(5000))), (10, "\n".join(f"l{i}" for i in range(2500, 7000))),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit(1), "runs": F.lit("x"), "th__": F.lit(2), "lines__": F.lit(3)})
    out = dedup_lines(df, runs_col="gone")
    assert out.columns == [*df.columns, "gone"]
    assert sorted(((r.doc_id, r.text or "") for r in out.collect())) == key(brute(rows))
    assert dict(out.where("doc_id = 10").select("doc_id", F.col("gone")).collect())[10][0].asDict() == {"first": 0, "last": 2499}


def test_null_ids_and_empty_table(spark):
    rows = [(None, "x y\nz"), (1, "x y\nz"), (2, "x y\nother")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup_lines(empty).collect() == [] and repeated_runs(empty).collect() == []


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, "a\nb")], SCHEMA)
    plan = dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_long_line_alone(spark):
    long = " ".join(f"w{i}" for i in range(20))
    short = " ".join(f"v{i}" for i in range(19))
    rows = [
        (1, f"a\n{long}\nb\n{short}\nc"),
        (2, f"d\n {long}\ne\n{short}\nf"),  # the long line goes, the short one has other neighbours
        (3, f"g\n\n{long}\nb\nh"),  # and so does what repeats beside it
        (4, f"i\n{long}\nj\n{long}\nk"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == [(1, rows[0][1]), (2, f"d\ne\n{short}\nf"), (3, "g\n\nh"), (4, "i\nj\nk")]
    as_windows = [(r.doc_id, r.text) for r in dedup_lines(df, alone=None).orderBy("doc_id").collect()]
    assert as_windows == [rows[0], rows[1], (3, "g\n\nh"), rows[3]]


def test_given_table_keeps_no_later_long_line(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = set()
    for r in sorted(corpus_pipeline.dedup_lines(spark, docs, "").select("doc_id", "text").distinct().collect()):
        for line in (r.text or "").split("\n"):
            line = line.strip(WHITE)
            if len(line.split()) >= 20:
                assert line not in seen, r.doc_id
                seen.add(line)
