"""Catalog: sources, sinks, streaming runs and end-to-end jobs (S*, T8–T11, R17, K18, D5, P13, V12).

File-based operators write data derived from the driver tables into a fresh
folder under the session's shared ``spark.checkpoint.dir`` and read it back,
so the scan/sink code path is exercised on whole tables.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions.distributions import inverse_normal_sql
from ..functions.kernels import mix_hash_sql
from ..operators import charts as V
from ..operators import classify as K
from ..operators import cleaning as C
from ..operators import ensemble as E
from ..operators import metrics as M
from ..operators import profiling as P
from ..operators import reduce as D
from ..operators import regression as R
from ..operators import series as TS
from ..operators import splits as S
from ..session import ensure_checkpoint_dir
from ..sources import files as IO
from ..sources.generate import oscillating_series
from ..streaming import live as L
from .catalog import register, table
from .q_cleaning import INJECTED_SQL, injected_orders
from .q_models import DOC_FEATURES, doc_table
from .q_models import _ols2_sql
from .q_usage import LOG_SQL, quota2_sql, usage_log


_OLS1_SQL = ("fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, "
             "regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)")


def _scratch(spark, name: str) -> str:
    """A fresh folder URI under the shared checkpoint dir (created by the Spark writer)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quillstat-io/{name}-{uuid.uuid4().hex[:12]}"


def live_from_events(spark, sf):
    """Live-table view of ``events``: timestamp = ts, t = logical time (event_id / 2), value1 = value, value2 = user_id / 10."""
    ev = table(spark, sf, "events")
    return ev.select(F.col("ts").alias("timestamp"), (F.col("event_id") * 0.5).alias("t"),
                     F.col("value").alias("value1"), (F.col("user_id") / 10.0).alias("value2"))


_LIVE_SQL = ("live AS (SELECT ts AS timestamp, CAST(event_id AS DOUBLE) * 0.5 AS t, value AS value1, "
             "CAST(user_id AS DOUBLE) / 10.0 AS value2 FROM events)")


# S1 / S5 --------------------------------------------------------------------
@register("s_csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
          ops=("S1", "S5"))
def s_csv_roundtrip(spark, sf):
    o = table(spark, sf, "orders")
    path = _scratch(spark, "orders-csv")
    IO.write_table(o, path, "csv")
    return IO.load_csv(spark, path, o.schema)


# S2 / T11 -------------------------------------------------------------------
@register("s_read_live", f"""WITH {_LIVE_SQL},
w AS (SELECT * FROM live WHERE timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 86400 SECOND),
c AS (SELECT count(*) AS n FROM w),
chosen AS (SELECT * FROM w WHERE (SELECT n FROM c) > 0 UNION ALL
           SELECT * FROM (SELECT * FROM live ORDER BY timestamp DESC, t DESC LIMIT 300) WHERE (SELECT n FROM c) = 0)
SELECT * FROM chosen WHERE t >= 100.0 ORDER BY timestamp DESC, t DESC LIMIT 300""", ops=("S2", "T1", "T2", "T3", "T4"))
def s_read_live(spark, sf):
    path = _scratch(spark, "live-csv")
    IO.write_table(live_from_events(spark, sf), path, "csv")
    return IO.read_live(spark, path, "2024-01-31 00:00:00", limit=300, last_seconds=86400, since_t=100.0)


@register("t_export_live", f"WITH {_LIVE_SQL} SELECT * FROM live", ops=("T11", "S5"))
def t_export_live(spark, sf):
    path = _scratch(spark, "live-export")
    # whole table in time order: a distributed (range-partitioned) sort, not a top-k
    IO.write_table(live_from_events(spark, sf).orderBy("timestamp", "t"), path, "csv")
    return IO.load_csv(spark, path, IO.LIVE_SCHEMA)


# S4 / S6 --------------------------------------------------------------------
@register("s_usage_log_roundtrip", f"""WITH {LOG_SQL}
SELECT ts, provider, method, prompt_tokens, completion_tokens, cost, success, error FROM log""", ops=("S4", "S6"))
def s_usage_log_roundtrip(spark, sf):
    log = usage_log(spark, sf)
    path = _scratch(spark, "usage-log")
    # two appends (calls before / after day 15), as a running process would produce
    cut = F.lit(1705276800)
    IO.append_usage(log.where(F.col("ts") < cut).drop("call_id", "user_id"), path)
    IO.append_usage(log.where(F.col("ts") >= cut).drop("call_id", "user_id"), path)
    back = IO.read_json_log(spark, path)
    return back.select("ts", "provider", "method", "prompt_tokens", "completion_tokens", "cost",
                       F.col("extra.success").alias("success"), F.col("extra.error").alias("error"))


# S7 -------------------------------------------------------------------------
@register("s_append_observations", f"""SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS o_orderkey,
       c_custkey AS o_custkey, NULL::VARCHAR AS o_orderstatus, NULL::DOUBLE AS o_totalprice, NULL::TIMESTAMP AS o_orderdate,
       '3-MEDIUM' AS o_orderpriority FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 0""", ops=("S7",))
def s_append_observations(spark, sf):
    new = table(spark, sf, "customer").where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 0)).select(
        F.col("c_custkey").alias("o_custkey"), F.lit("3-MEDIUM").alias("o_orderpriority"))
    return IO.append_observations(table(spark, sf, "orders"), new, "o_orderkey", ["o_custkey"],
                                  null_cols=["o_orderstatus", "o_totalprice", "o_orderdate"])


# S8 / T9 / T8 ---------------------------------------------------------------
@register("s_report_bundle", f"""WITH {_LIVE_SQL},
snap AS (SELECT * FROM live ORDER BY timestamp DESC, t DESC LIMIT 1000)
SELECT timestamp, t, value1, value2 FROM (
  SELECT *, max(value1) OVER w AS mx, sum(value1) OVER w AS sm, count(value1) OVER w AS ct, count(*) OVER w AS rws
  FROM snap WINDOW w AS (ORDER BY timestamp, t ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
WHERE rws = 3 AND ct = 3 AND value1 = mx AND value1 > (sm - value1) / 2.0""", ops=("S8",))
def s_report_bundle(spark, sf):
    live = live_from_events(spark, sf)
    snapshot = TS.last_n(live, ["timestamp", "t"], 1000)
    peaks = TS.find_peaks(snapshot.withColumn("series", F.lit(1)), "value1", ["timestamp", "t"], ["series"], 1)
    base = IO.write_report(snapshot, peaks.drop("series"), ensure_checkpoint_dir(spark), f"r{uuid.uuid4().hex[:10]}")
    return IO.load_csv(spark, f"{base}/peaks", IO.LIVE_SCHEMA)


# C9 -------------------------------------------------------------------------
@register("c_clean_job", f"""WITH {INJECTED_SQL},
m AS (SELECT o_orderpriority AS v FROM injected WHERE o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
       coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM injected)) AS o_totalprice,
       coalesce(o_orderpriority, (SELECT v FROM m)) AS o_orderpriority, 0 AS n_duplicates,
       (SELECT count(*) - count(o_totalprice) + count(*) - count(o_orderpriority) FROM injected) AS n_missing FROM injected""", ops=("C9",))
def c_clean_job(spark, sf):
    """The cleaning run over whole orders, keys and dates included: its report, its duplicates, and the table it wrote."""
    path = _scratch(spark, "clean")
    orders = injected_orders(spark, sf)
    done = C.clean_job(orders, path, exclude=("o_orderkey", "o_custkey"))
    n_missing = done["report"].agg(F.sum("n_missing")).first()[0]
    return IO.load_csv(spark, path, orders.schema).withColumns(
        {"n_duplicates": F.lit(done["n_duplicates"]), "n_missing": F.lit(n_missing)})


# S9 / T8 / T9 ---------------------------------------------------------------
@register("s_live_ensemble", f"""WITH {_LIVE_SQL}
SELECT timestamp, t, value1, value2, true AS in_range, true AS label_follows, true AS vote_adds_up FROM live ORDER BY timestamp DESC, t DESC LIMIT 1000""",
          ops=("S9", "T8", "T9"))
def s_live_ensemble(spark, sf):
    """The live job: models fitted on the older rows score the snapshot as a weighted ensemble, the predictions are
    written beside the report bundle, and read back."""
    live = live_from_events(spark, sf)
    order, feats = ["timestamp", "t"], ["value1", "value2"]
    snapshot = TS.last_n(live, order, 1000).checkpoint()
    first = snapshot.agg(F.min("timestamp").alias("m")).first()["m"]
    older = live.where(F.col("timestamp") < F.lit(first)).withColumn("label", (F.col("value1") > 50).cast("int"))
    models = {"logistic": K.scaled_pipeline(older, feats, lambda d: K.logistic(d, "label")),
              "random_forest": K.scaled_pipeline(older, feats, lambda d: K.random_forest(d, "label", 100, 8))}
    wide, probas, preds = E.predict_all(snapshot, {n: (m, feats) for n, m in models.items()}, lambda df, _: df)
    scored = E.ensemble_predict(wide, probas, preds, weights={"logistic": 1.0, "random_forest": 2.0})
    peaks = TS.find_peaks(snapshot, "value1", order, [], 1)
    base = IO.write_report(snapshot, peaks, ensure_checkpoint_dir(spark), f"e{uuid.uuid4().hex[:10]}")
    out = scored.select(*live.columns, *probas.values(), "ensemble_proba", "ensemble_pred")
    IO.write_table(out, f"{base}/predictions", "csv")
    back = IO.load_csv(spark, f"{base}/predictions", out.schema)
    p = F.col("ensemble_proba")
    return back.select(*live.columns, p.between(0.0, 1.0).alias("in_range"),
                       ((p >= 0.5).cast("int") == F.col("ensemble_pred")).alias("label_follows"),
                       (F.abs(p - (F.col(probas["logistic"]) + 2 * F.col(probas["random_forest"])) / 3) < 1e-9).alias("vote_adds_up"))


# S10 / K18 / R17 ------------------------------------------------------------
@register("k_train_pipeline", None, ops=("K18", "S10", "K9"))
def k_train_pipeline(spark, sf):
    """Train, save with the scaler, reload, evaluate: test metrics, cross-validation and the confusion matrix, long."""
    docs = S.hash_split(doc_table(spark, sf), "doc_id", 20, 42).checkpoint()
    train = docs.where(~F.col("is_test"))

    def fit(rows):
        return K.scaled_pipeline(rows, DOC_FEATURES, lambda d: K.logistic(d, "quality"))

    path = _scratch(spark, "model")
    IO.save_model(fit(train), path, DOC_FEATURES, "logistic")
    loaded, _, kind = IO.load_model(path, PipelineModel)
    scored = K.proba_col(loaded.transform(docs.where(F.col("is_test")))).checkpoint()
    metrics = K.evaluate_scored(scored, "quality")
    test = metrics.unpivot([], metrics.columns, "item", "value").select(F.lit("test").alias("part"), "item", "value")
    folds = K.cross_validate(S.stratified_folds(train, "doc_id", "quality", 5, 42), "quality", fit)
    cv = spark.createDataFrame([("cv", f"fold {r['fold']} f1", r["f1"]) for r in folds], "part string, item string, value double")
    confusion = M.confusion_matrix(scored, "quality", "prediction").select(
        F.lit("confusion").alias("part"), F.format_string("actual %d predicted %d", "actual", "predicted").alias("item"),
        F.col("count").cast("double").alias("value"))
    return test.unionByName(cv).unionByName(confusion).withColumn("model", F.lit(kind))


@register("k_saved_model_checks", f"""SELECT doc_id, true AS same FROM labels
WHERE doc_id IN (SELECT doc_id FROM documents) AND {mix_hash_sql("doc_id", "split")} % 100 < 20""", ops=("S10", "K8"))
def k_saved_model_checks(spark, sf):
    """A model that is saved and loaded again scores raw rows as before: its scaler is part of it."""
    docs = S.hash_split(doc_table(spark, sf), "doc_id", 20, 42)
    fitted = K.scaled_pipeline(docs.where(~F.col("is_test")), DOC_FEATURES, lambda d: K.logistic(d, "quality"))
    path = _scratch(spark, "model")
    IO.save_model(fitted, path, DOC_FEATURES, "logistic")
    test = docs.where(F.col("is_test"))
    before = K.proba_col(fitted.transform(test)).select("doc_id", F.col("proba").alias("p0"))
    after = K.proba_col(IO.load_model(path, PipelineModel)[0].transform(test)).select("doc_id", "proba")
    return before.join(after, "doc_id").select("doc_id", (F.abs(F.col("p0") - F.col("proba")) < 1e-12).alias("same"))


# S12 ------------------------------------------------------------------------
@register("s_weights_roundtrip", """SELECT source AS model, count(*) / sum(count(*)) OVER () AS weight
FROM documents JOIN labels USING (doc_id) GROUP BY source""", ops=("S12",))
def s_weights_roundtrip(spark, sf):
    # weights = share of each document source among labelled documents (data-derived map)
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    shares = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per source
    total = sum(r["n"] for r in shares)
    path = _scratch(spark, "weights")
    E.save_weights(spark, path, {r["source"]: r["n"] / total for r in shares})
    back = E.load_weights(spark, path)
    return E.weights_frame(spark, back)


# S16 ------------------------------------------------------------------------
@register("s_oscillating_series", """SELECT event_id, t, round(sin(t * 0.5) + 0.2 * sin(t * 3.0), 12) AS value1,
       round(cos(t * 0.25), 12) AS value2 FROM (SELECT event_id, CAST(event_id AS DOUBLE) * 0.5 AS t FROM events)""",
          ops=("S16",))
def s_oscillating_series(spark, sf):
    ev = table(spark, sf, "events").select("event_id")
    n = ev.agg(F.max("event_id")).first()[0] + 1
    osc = oscillating_series(spark, n, interval=0.5, noise=0.0).withColumn("event_id", (F.col("t") / 0.5).cast("long"))
    return ev.join(osc, "event_id").select("event_id", "t", F.round("value1", 12).alias("value1"),
                                           F.round("value2", 12).alias("value2"))


# P13 ------------------------------------------------------------------------
_ORDER_NUM = ("o_orderkey", "o_custkey", "o_totalprice")
_SUMMARY_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS col_name, count({c}) AS count, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,
       round(min({c}), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS q25, round(quantile_cont({c}, 0.5), 3) AS q50,
       round(quantile_cont({c}, 0.75), 3) AS q75, round(max({c}), 3) AS max FROM orders""" for c in _ORDER_NUM)


@register("p_stats_bundle_summary", _SUMMARY_SQL, ops=("P13",))
def p_stats_bundle_summary(spark, sf):
    bundle = P.stats_bundle(table(spark, sf, "orders"))
    return bundle["summary"]


_SUMMARY_ITEMS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")
_MOMENT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, skewness({c}) AS skewness, kurtosis({c}) AS kurtosis FROM orders" for c in _ORDER_NUM)


@register("p_stats_bundle", f"""WITH s AS ({_SUMMARY_SQL}), m AS ({_MOMENT_SQL})
""" + "\nUNION ALL\n".join(
    [f"SELECT 'summary' AS frame, col_name, '{i}' AS item, round(CAST({i} AS DOUBLE), 6) AS value FROM s" for i in _SUMMARY_ITEMS]
    + [f"SELECT 'skew_kurtosis', col_name, '{i}', round({i}, 6) FROM m" for i in ("skewness", "kurtosis")]
    + [f"SELECT 'correlations', '{a}', '{b}', round(corr({a}, {b}), 6) FROM orders" for a in _ORDER_NUM for b in _ORDER_NUM]
    + [f"SELECT 'categorical_counts', '{c}', {c}, round(round(count(*) / sum(count(*)) OVER (), 3), 6) FROM orders WHERE {c} IS NOT NULL GROUP BY {c}"
       for c in ("o_orderstatus", "o_orderpriority")]), ops=("P13",))
def p_stats_bundle(spark, sf):
    return P.bundle_rows(P.stats_bundle(table(spark, sf, "orders")))


# V12 ------------------------------------------------------------------------
@register("v_qq_points", f"""WITH {_OLS1_SQL},
r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice - (intercept + slope * l_quantity) AS e FROM lineitem, fit)
SELECT row_number() OVER (ORDER BY e, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank, round(e, 4) AS value FROM r""", ops=("V12",))
def v_qq_points(spark, sf):
    from .q_charts import LI_ORDER, _scored_lineitem

    r = _scored_lineitem(spark, sf).withColumn("residual", F.col("l_extendedprice") - F.col("pred"))
    return V.qq_points(r.select(*LI_ORDER, "residual"), "residual", LI_ORDER).select("rank", F.round("value", 4).alias("value"))


@register("v_qq_quantiles", f"""WITH {_OLS1_SQL},
r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice - (intercept + slope * l_quantity) AS e FROM lineitem, fit),
o AS (SELECT row_number() OVER (ORDER BY e, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rank, e, count(*) OVER () AS n FROM r),
m AS (SELECT rank, e, CASE rank WHEN 1 THEN 1 - power(0.5, 1.0 / n) WHEN n THEN power(0.5, 1.0 / n) ELSE (rank - 0.3175) / (n + 0.365) END AS p FROM o)
SELECT rank, round(e, 4) AS value, round({inverse_normal_sql("CAST(p AS DOUBLE)")}, 8) AS theoretical FROM m""", ops=("V12",))
def v_qq_quantiles(spark, sf):
    """The points with their normal quantiles."""
    from .q_charts import LI_ORDER, _scored_lineitem

    r = _scored_lineitem(spark, sf).withColumn("residual", F.col("l_extendedprice") - F.col("pred"))
    return V.qq_points(r.select(*LI_ORDER, "residual"), "residual", LI_ORDER).select(
        "rank", F.round("value", 4).alias("value"), F.round("theoretical", 8).alias("theoretical"))


# D5 -------------------------------------------------------------------------
@register("d_reduction_run", None, ops=("D5", "D6"))
def d_reduction_run(spark, sf):
    """The full run: PCA scores, the discriminant axis and the two-dimensional map of every labelled document."""
    docs = doc_table(spark, sf)
    pca = D.pca_fit(docs, DOC_FEATURES)
    lda = D.lda_fit(docs, ["n_chars", "n_lines"], "quality")
    scored = docs.select("doc_id", "quality", *pca.scores(len(DOC_FEATURES)), lda.projection().alias("lda_axis"))
    axes = [c for c in scored.columns if c.startswith("pc")]
    placed = D.landmark_mds(scored.withColumn("v", F.array(*axes)), "v", "doc_id", keep=["doc_id", "quality", "pc1", "pc2", "lda_axis"])
    return placed


# T10 + streaming twins -------------------------------------------------------
def _land_events(spark, sf, name, batches: int = 6):
    """Land ``events`` in a shared inbox in ``batches`` time-ordered slices (Spark appends: new files = new data).

    Returns (events, root, inbox, land) where land(i) appends slice i; land.count = number of slices.
    """
    ev = table(spark, sf, "events")
    root = _scratch(spark, name)
    inbox = f"{root}/inbox"
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]  # one row per day
    per = max(1, -(-len(days) // batches))
    slices = [days[i:i + per] for i in range(0, len(days), per)]

    def land(i):
        ev.where(F.to_date("ts").isin(slices[i])).write.mode("append").parquet(inbox)

    land.count = len(slices)
    return ev, root, inbox, land


def _run_stream(spark, sf, name, job, order=None):
    """Feed the landed events to ``job(stream)`` slice by slice (in ``order``), close it, return what was written.

    A file source never says that it has ended, so heartbeats far behind the
    last event move the watermark past all of them; their own rows stay open.
    Each batch overwrites its own folder, so a batch that is run again leaves no second copy.
    """
    ev, root, inbox, land = _land_events(spark, sf, name)
    out = f"{root}/out"
    order = [i for i in order or range(land.count) if i < land.count]
    land(order[0])
    stream = job(L.live_stream(spark, inbox, ev.schema, "parquet"))

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = stream.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", f"{root}/ck").start()
    try:
        q.processAllAvailable()
        for i in order[1:]:
            land(i)
            q.processAllAvailable()
        last = ev.agg(F.max("ts").alias("ts"))
        for days in (30, 60):  # the second lets the first one's watermark take effect
            beat = last.select((F.col("ts") + F.expr(f"INTERVAL {days} DAYS")).alias("ts")).where("ts IS NOT NULL")
            beat.select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in ev.schema.fields]) \
                .write.mode("append").parquet(inbox)
            q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(stream.schema).parquet(out), last.first()["ts"]


#: Slices are landed in this order, each second one before the one before it, so rows come out of order.
_SWAPPED = [1, 0, 3, 2, 5, 4]
_SWAPPED_DELAY = "11 days"


@register("t_stream_peaks", """SELECT user_id, ts, event_id, value FROM (
  SELECT *, max(value) OVER w AS mx, sum(value) OVER w AS sm, count(value) OVER w AS ct, count(*) OVER w AS rws
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
WHERE rws = 3 AND ct = 3 AND value = mx AND value > (sm - value) / 2.0""", ops=("T7", "T10"))
def t_stream_peaks(spark, sf):
    """Peaks from a Structured Streaming query over events landed out of order (state per user)."""
    got, _ = _run_stream(spark, sf, "stream-peaks", lambda st: L.stream_peaks(
        st, ["user_id"], "ts", "event_id", "value", 1, delay=_SWAPPED_DELAY), _SWAPPED)
    return got.select("user_id", "ts", "event_id", "value")


@register("l_stream_quota", quota2_sql("src AS (SELECT event_id, user_id, ts FROM events)", "ts", "INTERVAL 3600 SECOND",
                                      tie="event_id", time_type="TIMESTAMP"), ops=("L5", "T10"))
def l_stream_quota(spark, sf):
    """Quota admission as a stateful stream over events landed out of order."""
    got, _ = _run_stream(spark, sf, "stream-quota", lambda st: L.stream_quota(
        st.select("event_id", "user_id", "ts"), ["user_id"], "ts", "event_id", 2, delay=_SWAPPED_DELAY), _SWAPPED)
    return got.where(F.col("event_id").isNotNull()).select("event_id", "user_id", "ts", "admitted")


@register("t_periodic_window_stats", """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n, round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS std_value,
       min(value) AS min_value, max(value) AS max_value FROM events GROUP BY ALL""", ops=("T10",))
def t_periodic_window_stats(spark, sf):
    """Periodic job (foreachBatch) writing hourly live statistics."""
    got, end = _run_stream(spark, sf, "periodic", lambda st: L.window_stats(st, "ts", ["value"], "1 hour", "1 hour"))
    return got.where(F.col("window_start") <= F.lit(end)).select(
        "window_start", "window_end", "n", F.round("mean_value", 6).alias("mean_value"), F.round("std_value", 6).alias("std_value"),
        "min_value", "max_value")


@register("l_stream_cost_windows", """SELECT start AS window_start, start + INTERVAL 1 HOUR AS window_end,
       round(sum(value), 4) AS cost_last_hour, count(*) AS count_last_hour, round(sum(value), 4) >= 500 AS alert
FROM (SELECT value, unnest([time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE FOR k IN range(12)]) AS start FROM events)
GROUP BY start""", ops=("L4", "T10"))
def l_stream_cost_windows(spark, sf):
    """Hourly cost alert as a stream: sliding 1-hour windows over the landed usage log."""
    got, end = _run_stream(spark, sf, "stream-cost", lambda st: L.hourly_cost_windows(
        st.select("ts", F.col("value").alias("cost")), "ts", "cost", threshold=500.0).select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"), F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            "cost_last_hour", "count_last_hour"))
    cost = F.round("cost_last_hour", 4)
    return got.where(F.col("window_start") <= F.lit(end)).select(
        "window_start", "window_end", cost.alias("cost_last_hour"), "count_last_hour", (cost >= 500).alias("alert"))


# R17 (scoring of new observations with a fitted linear model, clipped) ------
@register("r_score_new", f"""WITH {_ols2_sql()}
SELECT p_partkey, round(b0 + b1 * CAST(p_size AS DOUBLE) + b2 * 0.05, 6) AS predicted,
       round(least(greatest(b0 + b1 * CAST(p_size AS DOUBLE) + b2 * 0.05, 0.0), 100000.0), 6) AS predicted_clipped
FROM part, fit""", ops=("R17",))
def r_score_new(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = R.fit_linear(li, ["l_quantity", "l_discount"], "l_extendedprice")
    new = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("l_quantity"),
                                          F.lit(0.05).alias("l_discount"))
    return new.select("p_partkey", F.round(fit.predict(), 6).alias("predicted"),
                      F.round(F.least(F.greatest(fit.predict(), F.lit(0.0)), F.lit(100000.0)), 6).alias("predicted_clipped"))

