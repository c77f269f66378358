"""Scans and sinks.

Every reader takes an explicit schema (no inference at scale).  Writers are
plain DataFrame writers: Spark commits output atomically per job, so a lost
executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kernels import nan_to_null, with_positions
from ..operators import series as TS
from ..operators.usage import USAGE_SCHEMA

# CSV keeps microseconds (Spark's default timestamp text stops at milliseconds).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

LIVE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("t", T.DoubleType()),
    T.StructField("value1", T.DoubleType()),
    T.StructField("value2", T.DoubleType()),
])


# S1 -------------------------------------------------------------------------
def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header, UTF-8, fixed schema.  A missing path raises FileNotFoundError (as the reference)."""
    try:
        df = (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
              .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).csv(path))
        df.schema  # noqa: B018 - resolve now so a missing path fails here
        return nan_to_null(df)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(path) from e
        raise


# S2 -------------------------------------------------------------------------
def read_live(spark: SparkSession, path: str, now, limit: int = 500, last_seconds: float | None = None,
              since_t: float | None = None, schema: T.StructType = LIVE_SCHEMA, fmt: str = "csv",
              ts: str = "timestamp", tcol: str = "t") -> DataFrame:
    """Live snapshot read.  Any read error (missing file ...) gives an EMPTY frame, not an exception.

    Steps in the reference's order: clock correction (T5) -> trailing window
    with fallback (T1/T2) -> since_t (T3) -> last ``limit`` rows ascending (T4).
    The fallback uses the corrected rows (the reference re-reads uncorrected).
    """
    try:
        reader = spark.read.schema(schema)
        df = (reader.option("header", True).option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
              .csv(path)) if fmt == "csv" else reader.format(fmt).load(path)
        df.schema  # noqa: B018
    except Exception:  # noqa: BLE001 - contract: errors -> empty table
        return spark.createDataFrame([], schema)
    order = [ts, tcol]
    df = TS.fix_future_clock(nan_to_null(df), ts, now)
    if last_seconds is not None:
        df = TS.window_or_fallback(df, ts, now, last_seconds, limit, order)
    if since_t is not None:
        df = TS.since(df, tcol, since_t)
    return TS.last_n(df, order, limit)


# S4 -------------------------------------------------------------------------
def read_json_log(spark: SparkSession, path: str, schema: T.StructType = USAGE_SCHEMA, array_file: bool = False) -> DataFrame:
    """Usage log: JSON lines (this library's sink) or one JSON array file (``array_file=True``, the
    reference's format); unreadable / blank / missing -> empty frame."""
    try:
        df = spark.read.schema(schema).option("multiLine", array_file).option("mode", "PERMISSIVE").json(path)
        df.schema  # noqa: B018
        return df
    except Exception:  # noqa: BLE001
        return spark.createDataFrame([], schema)


# S5 / S6 --------------------------------------------------------------------
def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).csv(path)
    else:
        w.format(fmt).save(path)


def append_usage(df: DataFrame, path: str) -> None:
    """Append-only usage sink (JSON lines, one file set per append)."""
    df.write.mode("append").json(path)


# S7 -------------------------------------------------------------------------
def append_observations(existing: DataFrame, new: DataFrame, id_col: str, order: Sequence[str],
                        null_cols: Sequence[str] = ()) -> DataFrame:
    """New rows get ids max(existing id) + 1.. (in ``order``), target columns NULL; returns the rows to append.

    Ids come from the split-safe position kernel, so a large appended batch is
    numbered without a single-task window.
    """
    top = F.broadcast(existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_max")))
    numbered = with_positions(new, [], list(order))
    out = numbered.crossJoin(top).withColumn(id_col, F.col("_max") + F.col("_pos") + 1).drop("_max", "_pos")
    for c in null_cols:
        out = out.withColumn(c, F.lit(None).cast(existing.schema[c].dataType))
    return out.select(*existing.columns)


# S8 -------------------------------------------------------------------------
def write_report(snapshot: DataFrame, peaks: DataFrame, out_dir: str, run_id: str, fmt: str = "csv") -> str:
    """Report bundle: {out_dir}/report_id={run_id}/{snapshot,peaks} (PNG/ZIP packaging is not built)."""
    base = f"{out_dir.rstrip('/')}/report_id={run_id}"
    write_table(snapshot, f"{base}/snapshot", fmt)
    write_table(peaks, f"{base}/peaks", fmt)
    return base


# S10 ------------------------------------------------------------------------
def save_model(model, path: str, features: Sequence[str], kind: str) -> None:
    """Spark ML persistence + a JSON sidecar with the feature names and model type (never pickles)."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    meta = spark.createDataFrame([(kind, list(features))], "kind string, features array<string>")
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_model(path: str, loader):
    """``loader`` = the fitted model class (e.g. LogisticRegressionModel). Returns (model, features, kind)."""
    spark = SparkSession.getActiveSession()
    meta = spark.read.json(f"{path}/meta").first()
    return loader.load(f"{path}/model"), list(meta["features"]), meta["kind"]


__all__ = ["load_csv", "read_live", "read_json_log", "write_table", "append_usage", "append_observations",
           "write_report", "save_model", "load_model", "LIVE_SCHEMA"]
