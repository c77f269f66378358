"""Shared physical kernels.

Every kernel keeps row-proportional work in executors.  What reaches the
driver is bounded by the number of columns, groups-by-columns, or a bucket
count — never by rows.

* ``exact_quantiles``   exact linear-interpolated quantiles without sending a
                        whole group to one task (approximate bracket, then an
                        exact count inside a narrow value band).
* ``gram``              augmented Gram matrix ``[1,x]^T [1,x]`` in one aggregation.
* ``mix_hash``          reproducible mixing hash (same expression in DuckDB).
* ``lay_out``           rows range-partitioned by the full order, the layout all
                        ordered kernels share: ties and hot keys split over tasks.
* ``with_positions``    dense 0-based row position per key.
* ``previous_values``   the value of the row before, across partitions.
* ``chunked_frame``     rows-between frames evaluated on bounded chunks.
* ``prefix_sum``        running sums in two levels (partition totals + inside).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Hex digits of the digest that make a hash: 52 bits, which doubles hold exactly.
HASH_DIGITS = 13


# --------------------------------------------------------------------------- dtype dispatch

def numeric_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a value in Spark but 'missing' in the reference: normalise once at ingestion."""
    floats = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(t)) for c, t in floats.items()}) if floats else df


def mix_hash(key: Column | str, purpose: str, seed: int = 42) -> Column:
    """52 uniform bits from ``md5(purpose:seed:key)`` as a long.

    Each ``purpose`` (split, fold, sample, a column's name, ...) draws independently of the
    others, keys of any size and type work, and NULL counts as the empty key.
    """
    k = F.col(key) if isinstance(key, str) else key
    text = F.concat(F.lit(f"{purpose}:{seed}:"), F.coalesce(k.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def mix_hash_sql(key: str, purpose: str, seed: int = 42) -> str:
    """The same hash as DuckDB SQL."""
    return (f"CAST(('0x' || substr(md5(concat('{purpose}:{seed}:', coalesce(CAST({key} AS VARCHAR), ''))), 1, {HASH_DIGITS}))"
            " AS BIGINT)")


# --------------------------------------------------------------------------- exact quantiles

def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    qs: Sequence[float],
    by: Sequence[str] = (),
    accuracy: int = 20000,
    band_limit: int = 2_000_000,
) -> DataFrame:
    """Exact quantiles (linear interpolation, as ``percentile``/``quantile_cont``).

    Returns long rows ``(*by, col_name, q, value)``.

    Pass 1 (one aggregation, wide): per group and column the non-null count
    and an approximate bracket ``[approx(q-e), approx(q+e)]`` from
    ``percentile_approx`` (Greenwald–Khanna, rank error <= n/accuracy, so the
    true order statistics lie inside).
    Pass 2: rows outside every bracket only feed conditional counts and the
    nearest value below/above (plain aggregates, no row expansion); the few
    rows inside a bracket are grouped by value.  The band holds about
    ``4n/accuracy`` distinct values, so the final ordered scan per
    (group, column, q) is bounded however many rows share a value.  For small
    groups the summary is exact and the bracket can sit one rank off the
    interpolation neighbour; the nearest below/above values resolve that case.
    """
    by, cols = list(by), list(cols)
    qs = [float(q) for q in qs]
    eps = 4.0 / accuracy
    probes: list[float] = []
    for q in qs:
        probes += [max(q - eps, 0.0), min(q + eps, 1.0)]
    nq = len(qs)
    base = df.select(*by, *[F.col(c).cast("double").alias(f"_x{k}") for k, c in enumerate(cols)])
    for k in range(len(cols)):
        base = base.withColumn(f"_x{k}", F.nanvl(F.col(f"_x{k}"), F.lit(None).cast("double")))

    aggs = []
    for k in range(len(cols)):
        x = F.col(f"_x{k}")
        aggs += [F.count(x).alias(f"_n{k}"), F.min(x).alias(f"_mn{k}"), F.max(x).alias(f"_mx{k}"),
                 F.percentile_approx(x, probes, accuracy).alias(f"_br{k}")]
    if not by:
        return _exact_quantiles_global(base, cols, qs, probes, eps, base.agg(*aggs).first(), band_limit=band_limit,
                                       accuracy=accuracy)
    stats = base.groupBy(*by).agg(*aggs)
    for k in range(len(cols)):
        for i, q in enumerate(qs):
            lo = F.col(f"_br{k}")[2 * i]
            hi = F.col(f"_br{k}")[2 * i + 1]
            stats = stats.withColumn(f"_lo{k}_{i}", F.when(F.lit(q - eps <= 0.0), F.col(f"_mn{k}")).otherwise(lo)) \
                         .withColumn(f"_hi{k}_{i}", F.when(F.lit(q + eps >= 1.0), F.col(f"_mx{k}")).otherwise(hi))
    stats = stats.drop(*[f"_br{k}" for k in range(len(cols))])
    ncols = len(cols)
    pairs = [(k, i) for k in range(ncols) for i in range(nq)]
    gprobes = [g / 1000 for g in range(1001)]

    def outside_aggs():
        out = []
        for k, i in pairs:
            x = F.col(f"_x{k}")
            lo, hi = F.col(f"_lo{k}_{i}"), F.col(f"_hi{k}_{i}")
            out += [F.count(F.when(x < lo, 1)).alias(f"_nb{k}_{i}"), F.max(F.when(x < lo, x)).alias(f"_bm{k}_{i}"),
                    F.min(F.when(x > hi, x)).alias(f"_am{k}_{i}"),
                    F.count(F.when((x >= lo) & (x <= hi), 1)).alias(f"_ni{k}_{i}")]
        return out

    # grouped: the statistics are computed once; few groups are sent to the rows, which are not sorted by group for it
    stats = stats.checkpoint()
    joined = base.join(few_groups(stats), by)
    # (a) outside the brackets: counts + nearest values, no row expansion.  The per-group table is
    # small; it is checkpointed (shared folder) because the band-size check and the final plan share it.
    outside_w = joined.groupBy(*by).agg(*outside_aggs()).checkpoint()
    for _ in range(8):  # each round shrinks oversized brackets ~250x
        widest = outside_w.agg(F.greatest(*[F.max(f"_ni{k}_{i}") for k, i in pairs]).alias("m")).first()["m"]
        if widest is None or widest <= band_limit:
            break
        grids = joined.groupBy(*by).agg(*[
            F.percentile_approx(F.when((F.col(f"_x{k}") >= F.col(f"_lo{k}_{i}")) & (F.col(f"_x{k}") <= F.col(f"_hi{k}_{i}")),
                                       F.col(f"_x{k}")), gprobes, accuracy).alias(f"_g{k}_{i}") for k, i in pairs])
        st = stats.join(outside_w, by).join(grids, by)
        sel = [F.col(c) for c in stats.columns if not c.startswith(("_lo", "_hi"))]
        for k, i in pairs:
            cnt, nb, g = F.col(f"_ni{k}_{i}"), F.col(f"_nb{k}_{i}"), F.col(f"_g{k}_{i}")
            t_lo = F.greatest(F.floor(F.lit(qs[i]) * (F.col(f"_n{k}") - 1)) - nb, F.lit(0))
            t_hi = F.least(t_lo + 1, cnt - 1)
            f_lo = F.least(t_lo / F.greatest(cnt - 1, F.lit(1)), F.lit(1.0))
            f_hi = F.least(F.greatest(t_hi, F.lit(0)) / F.greatest(cnt - 1, F.lit(1)), F.lit(1.0))
            i_lo = F.least(F.greatest(F.floor(f_lo * 1000) - 2, F.lit(0)), F.lit(1000)).cast("int")
            i_hi = F.least(F.greatest(F.floor(f_hi * 1000) + 3, F.lit(0)), F.lit(1000)).cast("int")
            wide = (cnt > band_limit) & g.isNotNull()
            sel += [F.when(wide, F.element_at(g, i_lo + 1)).otherwise(F.col(f"_lo{k}_{i}")).alias(f"_lo{k}_{i}"),
                    F.when(wide, F.element_at(g, i_hi + 1)).otherwise(F.col(f"_hi{k}_{i}")).alias(f"_hi{k}_{i}")]
        stats = st.select(*sel).checkpoint()
        joined = base.join(few_groups(stats), by)
        outside_w = joined.groupBy(*by).agg(*outside_aggs()).checkpoint()
    meta = F.explode(F.array(*[F.struct(
        F.lit(cols[k]).alias("col_name"), F.lit(i).alias("qi"), F.col(f"_nb{k}_{i}").alias("_below"),
        F.col(f"_bm{k}_{i}").alias("_bmax"), F.col(f"_am{k}_{i}").alias("_amin")) for k, i in pairs]))
    outside = outside_w.select(*by, meta.alias("m")).select(*by, "m.*")
    counts = stats.select(*by, F.explode(F.array(*[F.struct(F.lit(cols[k]).alias("col_name"), F.col(f"_n{k}").alias("_n"))
                                                   for k in range(len(cols))])).alias("m")).select(*by, "m.*")

    # (b) inside a bracket: only those rows are expanded, then grouped by value
    lo_hi = [[(F.col(f"_lo{k}_{i}"), F.col(f"_hi{k}_{i}")) for i in range(nq)] for k in range(len(cols))]
    band = _band_counts(joined, by, cols, nq, lo_hi)
    keys = by + ["col_name"]
    band = band.join(outside, keys + ["qi"]).join(counts, keys)
    return _pick(band, keys, qs)


#: Groups whose statistics are sent to the rows.
FEW_GROUPS = 10_000


def few_groups(stats: DataFrame) -> DataFrame:
    """A (checkpointed) table of a row per group, for a join with the rows: broadcast if it is short."""
    return F.broadcast(stats) if stats.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS else stats


def _band_counts(frame: DataFrame, by: list, cols: Sequence[str], nq: int, lo_hi) -> DataFrame:
    entries = [F.when((F.col(f"_x{k}") >= lo_hi[k][i][0]) & (F.col(f"_x{k}") <= lo_hi[k][i][1]),
                      F.struct(F.lit(cols[k]).alias("col_name"), F.lit(i).alias("qi"), F.col(f"_x{k}").alias("v")))
               for k in range(len(cols)) for i in range(nq)]
    any_in = None
    for e in entries:
        any_in = e.isNotNull() if any_in is None else any_in | e.isNotNull()
    band = frame.where(any_in).select(*by, F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")) \
        .select(*by, "e.*").groupBy(*by, "col_name", "qi", "v").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(*by, "col_name", "qi").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return band.withColumn("_cum", F.sum("c").over(w))


def _pick(band: DataFrame, keys: list, qs: Sequence[float]) -> DataFrame:
    """band rows with _cum, _below, _bmax, _amin, _n -> interpolated value per (keys, qi)."""
    qarr = F.array(*[F.lit(q) for q in qs])
    band = (band.withColumn("_pos", qarr[F.col("qi")] * (F.col("_n") - 1))
            .withColumn("_rlo", F.floor("_pos"))
            .withColumn("_rhi", F.least(F.col("_rlo") + 1, F.col("_n") - 1))
            .withColumn("_absc", F.col("_below") + F.col("_cum")))
    picked = band.groupBy(*keys, "qi").agg(
        F.min(F.when(F.col("_absc") > F.col("_rlo"), F.col("v"))).alias("_blo"),
        F.min(F.when(F.col("_absc") > F.col("_rhi"), F.col("v"))).alias("_bhi"),
        F.first("_pos").alias("_pos"), F.first("_rlo").alias("_rlo"), F.first("_rhi").alias("_rhi"),
        F.first("_below").alias("_below"), F.first("_bmax").alias("_bmax"), F.first("_amin").alias("_amin"),
    )

    def at(rank, band_value):
        # rank just below the band -> nearest value below; just above -> nearest value above
        return F.when(F.col(rank) < F.col("_below"), F.col("_bmax")).when(
            band_value.isNotNull(), band_value).otherwise(F.col("_amin"))

    vlo, vhi = at("_rlo", F.col("_blo")), at("_rhi", F.col("_bhi"))
    value = vlo + (vhi - vlo) * (F.col("_pos") - F.col("_rlo"))
    return picked.select(*keys, qarr[F.col("qi")].alias("q"), value.alias("value"))


def _exact_quantiles_global(base: DataFrame, cols: Sequence[str], qs: Sequence[float], probes, eps: float, row,
                            band_limit: int = 2_000_000, grid: int = 1000, accuracy: int = 20000):
    """Ungrouped case: the single statistics row is collected (size = #columns x #quantiles) and the
    remaining passes use literal brackets — each pass is one scan, no joins.

    While a bracket still holds more than ``band_limit`` rows (very large n),
    one more pass fetches a ``grid``-point approximate grid of that bracket and
    narrows it around the target ranks (~grid/4 times smaller per pass), so the
    final in-band sort stays bounded whatever the table size.
    """
    spark = base.sparkSession
    nq = len(qs)
    ncols = len(cols)
    lo = [[None] * nq for _ in range(ncols)]
    hi = [[None] * nq for _ in range(ncols)]
    n = [int(row[f"_n{k}"]) for k in range(ncols)]
    for k in range(ncols):
        br = row[f"_br{k}"]
        for i, q in enumerate(qs):
            if n[k]:
                lo[k][i] = row[f"_mn{k}"] if q - eps <= 0.0 else br[2 * i]
                hi[k][i] = row[f"_mx{k}"] if q + eps >= 1.0 else br[2 * i + 1]
    gprobes = [g / grid for g in range(grid + 1)]
    refine: set = set()
    while True:
        aggs = []
        for k in range(ncols):
            x = F.col(f"_x{k}")
            for i in range(nq):
                lo_c, hi_c = F.lit(lo[k][i]).cast("double"), F.lit(hi[k][i]).cast("double")
                inside = (x >= lo_c) & (x <= hi_c)
                aggs += [F.count(F.when(x < lo_c, 1)).alias(f"_nb{k}_{i}"), F.max(F.when(x < lo_c, x)).alias(f"_bm{k}_{i}"),
                         F.min(F.when(x > hi_c, x)).alias(f"_am{k}_{i}"), F.count(F.when(inside, 1)).alias(f"_ni{k}_{i}")]
                if (k, i) in refine:
                    aggs.append(F.percentile_approx(F.when(inside, x), gprobes, accuracy).alias(f"_g{k}_{i}"))
        orow = base.agg(*aggs).first()
        todo = set()
        for k in range(ncols):
            for i, q in enumerate(qs):
                if (k, i) in refine and orow[f"_g{k}_{i}"] is not None:
                    g = orow[f"_g{k}_{i}"]
                    cnt = int(orow[f"_ni{k}_{i}"])
                    pos = q * (n[k] - 1)
                    t_lo = max(int(math.floor(pos)) - int(orow[f"_nb{k}_{i}"]), 0)
                    t_hi = min(t_lo + 1, cnt - 1)
                    f_lo, f_hi = min(t_lo / max(cnt - 1, 1), 1.0), min(max(t_hi, 0) / max(cnt - 1, 1), 1.0)
                    i_lo = min(max(int(f_lo * grid) - 2, 0), grid)
                    i_hi = min(max(int(f_hi * grid) + 3, 0), grid)
                    new_lo, new_hi = g[i_lo], g[i_hi]
                    if (new_lo, new_hi) != (lo[k][i], hi[k][i]):
                        lo[k][i], hi[k][i] = new_lo, new_hi
                        todo.add((k, i))
                elif (k, i) not in refine and int(orow[f"_ni{k}_{i}"] or 0) > band_limit:
                    todo.add((k, i))
        if not todo:
            break
        refine = todo
    meta = [(cols[k], i, int(orow[f"_nb{k}_{i}"]), orow[f"_bm{k}_{i}"], orow[f"_am{k}_{i}"], n[k])
            for k in range(ncols) for i in range(nq)]
    lo_hi = [[(F.lit(lo[k][i]).cast("double"), F.lit(hi[k][i]).cast("double")) for i in range(nq)] for k in range(ncols)]
    side = spark.createDataFrame(meta, "col_name string, qi int, _below long, _bmax double, _amin double, _n long")
    band = _band_counts(base, [], cols, nq, lo_hi)
    band = band.join(F.broadcast(side), ["col_name", "qi"])  # #columns x #quantiles rows
    return _pick(band, ["col_name"], qs)


def quantile_row(df: DataFrame, col: str, qs: Sequence[float], by: Sequence[str] = (), prefix: str = "q") -> DataFrame:
    """Wide form: one row per group with columns ``{prefix}{int(q*100)}``."""
    long = exact_quantiles(df, [col], qs, by)
    names = {q: f"{prefix}{int(round(q * 100))}" for q in qs}
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("q") == F.lit(q), F.col("value"))).alias(n) for q, n in names.items()]
    )


def kth_smallest(df: DataFrame, col: str, tiebreak: str, k: int, accuracy: int = 20000,
                 band_limit: int = 200_000, grid: int = 1000) -> tuple:
    """Exact k-th smallest (1-based) pair ``(col, tiebreak)`` in bounded passes.

    Each pass is one aggregation over the rows still inside the value band:
    it counts rows below the band and fetches a ``grid``-point approximate
    quantile grid of the band.  The band then narrows to the two grid points
    around the target rank (about 1/grid of its rows).  Once the band holds
    at most ``band_limit`` rows the remaining order statistic is taken with
    a bounded sort.  Only O(grid) numbers reach the driver per pass.
    """
    x = F.col(col).cast("double")
    lo, hi, below = None, None, 0
    probes = [i / grid for i in range(grid + 1)]
    total = df.count()
    r = k
    while total > band_limit:
        in_band = F.lit(True) if lo is None else ((x >= F.lit(lo)) & (x <= F.lit(hi)))
        under = F.lit(False) if lo is None else (x < F.lit(lo))
        row = df.agg(
            F.sum(F.when(under, 1).otherwise(0)).alias("under"),
            F.sum(F.when(in_band, 1).otherwise(0)).alias("cnt"),
            F.percentile_approx(F.when(in_band, x), probes, accuracy).alias("g"),
        ).first()
        below = int(row["under"] or 0)  # rows below the current band (counted over all rows)
        cnt = int(row["cnt"] or 0)
        r = k - below  # 1-based rank inside the band
        if cnt <= band_limit or row["g"] is None:
            break
        g = row["g"]
        f = (r - 1) / max(cnt - 1, 1)
        i_lo = max(int(f * grid) - 2, 0)
        i_hi = min(int(f * grid) + 3, grid)
        new_lo, new_hi = g[i_lo], g[i_hi]
        if lo is not None and new_lo == lo and new_hi == hi:
            break  # cannot narrow further (heavy ties): finish with the bounded sort
        lo, hi = new_lo, new_hi
    in_band = F.lit(True) if lo is None else ((x >= F.lit(lo)) & (x <= F.lit(hi)))
    top = df.where(in_band).orderBy(x, F.col(tiebreak)).select(x.alias("v"), F.col(tiebreak).alias("t")).limit(r).tail(1)
    return (top[0]["v"], top[0]["t"]) if top else (None, None)


# --------------------------------------------------------------------------- Gram

def gram(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), listwise: bool = True) -> DataFrame:
    """Augmented Gram sums in one (partial + final) aggregation.

    Output columns: *by, n, s_<c>, p_<a>_<b> (a <= b).  Listwise deletion of NULLs.
    """
    base = df
    if listwise:
        cond = None
        for c in cols:
            cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
        base = df.where(cond)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.col(c).cast("double")).alias(f"s_{c}") for c in cols]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"p_{a}_{b}"))
    return base.groupBy(*by).agg(*aggs)


def gram_to_numpy(row, cols: Sequence[str]) -> tuple[int, np.ndarray]:
    """Augmented matrix G = [1,x]^T[1,x] from one collected gram row (d+1)x(d+1)."""
    d = len(cols)
    g = np.zeros((d + 1, d + 1))
    g[0, 0] = row["n"]
    for i, a in enumerate(cols):
        g[0, i + 1] = g[i + 1, 0] = row[f"s_{a}"]
        for j in range(i, d):
            b = cols[j]
            g[i + 1, j + 1] = g[j + 1, i + 1] = row[f"p_{a}_{b}"]
    return int(row["n"]), g


# --------------------------------------------------------------------------- ordered layout

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, place in it below


def lay_out(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``(keys, order)``, with ``_part`` and ``_at``.

    The range covers the full order, so rows that tie on the leading columns
    and keys with most of the rows split over partitions like any others; NULL
    and NaN have their place in Spark's order.  The layout is written to the shared
    checkpoint folder: partition numbers come from sampled ranges, and a task that
    is run again must see the same ones.
    """
    by = [*keys, *order]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
            .withColumn("_mid", F.monotonically_increasing_id()).checkpoint())
    return laid.withColumns({"_part": F.shiftright("_mid", _LOCAL_BITS),
                             "_at": F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))}).drop("_mid")


def _join_segments(laid: DataFrame, seg: DataFrame, keys: Sequence[str], add: Sequence[str]) -> DataFrame:
    """``laid`` with the columns ``add`` of its segment (key, partition); NULL keys are a key."""
    names = {c: f"_seg{i}" for i, c in enumerate([*keys, "_part"])}
    seg = seg.select(*[F.col(c).alias(n) for c, n in names.items()], *add)
    cond = F.lit(True)
    for c, n in names.items():
        cond = cond & laid[c].eqNullSafe(F.col(n))
    return laid.join(seg, cond).drop(*names.values())


def _earlier_segments(keys: Sequence[str]):
    """The segments of a key before the current one: at most one row per partition."""
    return Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_pos``: 0-based position of each row inside its key, by ``order`` (a total order within a key)."""
    keys = list(keys)
    laid = lay_out(df, keys, order)
    seg = laid.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_cnt"), F.min("_at").alias("_first"))
    seg = seg.withColumn("_off", F.coalesce(F.sum("_cnt").over(_earlier_segments(keys)), F.lit(0)) - F.col("_first"))
    return _join_segments(laid, seg, keys, ["_off"]).withColumn("_pos", F.col("_off") + F.col("_at")).drop("_off", "_part", "_at")


def previous_values(laid: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """A laid-out frame with ``values`` {new column: column}: the value in the key's row before (NULL in its first)."""
    keys = list(keys)
    seg = laid.groupBy(*keys, "_part").agg(*[F.max_by(F.struct(c), "_at").alias(f"_end_{n}") for n, c in values.items()])
    before = Window.partitionBy(*keys).orderBy("_part")
    seg = seg.select(*keys, "_part", *[F.lag(f"_end_{n}").over(before)[c].alias(f"_end_{n}") for n, c in values.items()])
    inside = Window.partitionBy(*keys, "_part").orderBy("_at")
    out = _join_segments(laid, seg, keys, [f"_end_{n}" for n in values])
    first = F.row_number().over(inside) == 1
    return out.withColumns({n: F.when(first, F.col(f"_end_{n}")).otherwise(F.lag(c).over(inside)) for n, c in values.items()}) \
        .drop(*[f"_end_{n}" for n in values])


def running_sums(laid: DataFrame, keys: Sequence[str], values: dict[str, str]) -> DataFrame:
    """A laid-out frame with ``values`` {new column: column}: sums up to and including the row (NULL until a value)."""
    keys = list(keys)
    seg = laid.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_tot_{n}") for n, c in values.items()])
    seg = seg.select(*keys, "_part", *[F.sum(f"_tot_{n}").over(_earlier_segments(keys)).alias(f"_tot_{n}") for n in values])
    inside = Window.partitionBy(*keys, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    out = _join_segments(laid, seg, keys, [f"_tot_{n}" for n in values])
    run = {n: F.sum(c).over(inside) for n, c in values.items()}
    return out.withColumns({n: F.coalesce(F.col(f"_tot_{n}") + r, F.col(f"_tot_{n}"), r) for n, r in run.items()}) \
        .drop(*[f"_tot_{n}" for n in values])


def halo_chunks(df_pos: DataFrame, halo: int, chunk_rows: int) -> DataFrame:
    """Assign ``_chunk`` and duplicate ``halo`` boundary rows into the neighbouring chunks.

    Output keeps original columns + ``_chunk``, ``_halo`` (True for copies).
    """
    c = F.floor(F.col("_pos") / F.lit(chunk_rows))
    r = F.col("_pos") - c * F.lit(chunk_rows)
    targets = F.array(
        F.struct(c.alias("ch"), F.lit(False).alias("h")),
        F.when(r < F.lit(halo), F.struct((c - 1).alias("ch"), F.lit(True).alias("h"))),
        F.when(r >= F.lit(chunk_rows - halo), F.struct((c + 1).alias("ch"), F.lit(True).alias("h"))),
    )
    exploded = df_pos.withColumn("_t", F.explode(F.filter(targets, lambda s: s.isNotNull() & (s["ch"] >= 0))))
    return exploded.withColumn("_chunk", F.col("_t.ch")).withColumn("_halo", F.col("_t.h")).drop("_t")


def chunked_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str], halo: int,
                  chunk_rows: int = 1_000_000):
    """Prepare ``df`` for a rows-between window of reach ``halo`` with bounded partitions.

    Returns ``(frame, partition_cols, order_cols)``: rows with positions, in
    chunks of ``chunk_rows`` with ``halo`` copied boundary rows.  The chunk size
    changes how the work is cut and nothing else.
    """
    pos = with_positions(df, keys, order)
    return halo_chunks(pos, halo, max(chunk_rows, 2 * halo + 1)), [*keys, "_chunk"], ["_pos"]


def finish_chunked(df: DataFrame) -> DataFrame:
    """Drop the copied boundary rows after the window is evaluated."""
    return df.where(~F.col("_halo")).drop("_chunk", "_halo", "_pos")


def prefix_sum(df: DataFrame, values: dict[str, str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with running sums ``values`` {new column: column} per key in ``order`` (inclusive)."""
    return running_sums(lay_out(df, keys, order), keys, values).drop("_part", "_at")
