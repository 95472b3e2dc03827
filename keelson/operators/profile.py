"""Column profiling: missing counts, summaries, correlations, quantiles, histograms,
densities and box statistics (AGG1, AGG2, AGG12–AGG20).

Every statistic skips NaN (NaN → NULL first).  Quantiles are exact with linear
interpolation: values are ranked by the balanced ordinal and only the rows at
the needed ranks are picked, so no group is ever collected into one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import as_list, is_missing, nan_to_null, unpivot
from keelson.operators.ordering import attach, checked_small, keyed_running_total

# Density grid size and cut (in bandwidths) of the plotted curve.
KDE_GRID = 200
KDE_CUT = 3.0


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_missing) for every column, from one aggregate pass."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count(F.when(is_missing(df, c), 1)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_missing")


def frame_summary(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows, n_non_null, n_missing) from one aggregate pass."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count(F.when(is_missing(df, c), 1)).alias(c) for c in cols])
    long = wide.unpivot(["_rows"], cols, "column", "n_missing")
    types = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return long.select("column", types[F.col("column")].alias("dtype"), F.col("_rows").alias("n_rows"),
                       (F.col("_rows") - F.col("n_missing")).alias("n_non_null"), "n_missing")


def _pair(a: str, b: str) -> tuple[Column, Column]:
    x = F.when(nan_to_null(b).isNotNull(), nan_to_null(a))
    y = F.when(nan_to_null(a).isNotNull(), nan_to_null(b))
    return x, y


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair (x, y) on pairwise-complete rows, one pass.

    A constant column gives NULL (``corr`` would raise under ANSI mode).
    """
    cols = list(columns)
    aggs, names = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            x, y = _pair(a, b)
            tag = f"{i}_{cols.index(b)}"
            aggs += [F.covar_pop(x, y).alias("c" + tag), F.stddev_pop(x).alias("sa" + tag),
                     F.stddev_pop(y).alias("sb" + tag), F.count(x).alias("n" + tag)]
            names.append((a, b, tag))
    wide = df.agg(*aggs)
    rows = []
    for a, b, tag in names:
        r = F.try_divide(F.col("c" + tag), F.col("sa" + tag) * F.col("sb" + tag))
        rows.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r.alias("r"), F.col("n" + tag).alias("n")))
        if a != b:
            rows.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), r.alias("r"), F.col("n" + tag).alias("n")))
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def top_correlated(df: DataFrame, features: Sequence[str], target: str, k: int) -> DataFrame:
    """Features ranked by |r| with the target, top k (ties by name)."""
    cm = correlation_matrix(df, [*features, target])
    ranked = cm.where((F.col("y") == target) & (F.col("x") != target)).select(
        F.col("x").alias("feature"), "r", F.abs("r").alias("abs_r"))
    return ranked.orderBy(F.col("abs_r").desc_nulls_last(), "feature").limit(k)


# Rank error of the bracketing sketch is at most one in this many rows.
SKETCH = 10_000


def _bracketed(vals: DataFrame, keys: list[str], probs: Sequence[float], key_bound: int | None) -> DataFrame:
    """Counts (keys, _v, _gap, _c) of equal values that may hold a wanted rank.

    A mergeable sketch gives each rank a bracket of values, wide enough for the sketch's error.  Values in a
    bracket are counted one by one; all others between two brackets are one row (``_gap``), named by the
    end of the bracket below.
    """
    off = 2.0 / SKETCH
    ends = [F.lit(max(0.0, p - off)) for p in probs] + [F.lit(min(1.0, p + off)) for p in probs]
    found = vals.groupBy(*keys).agg(F.percentile_approx("_v", F.array(*ends), F.lit(SKETCH)).alias("_e"))
    m = len(probs)
    # The outermost ranks are open to their side.
    low = [F.lit(float("-inf")) if p <= off else F.col("_e")[j] for j, p in enumerate(probs)]
    high = [F.lit(float("inf")) if p >= 1 - off else F.col("_e")[m + j] for j, p in enumerate(probs)]
    found = found.select(*keys, *[c.alias(f"_l{j}") for j, c in enumerate(low)], *[c.alias(f"_h{j}") for j, c in enumerate(high)])
    rows = attach(vals, found, keys, bound=key_bound)
    inside, below = F.lit(False), [F.lit(float("-inf"))]
    for j in range(m):
        inside = inside | F.col("_v").between(F.col(f"_l{j}"), F.col(f"_h{j}"))
        below.append(F.when(F.col(f"_h{j}") < F.col("_v"), F.col(f"_h{j}")))
    at = F.when(inside, F.col("_v")).otherwise(F.greatest(*below, F.lit(float("-inf"))))
    return rows.select(*keys, at.alias("_v"), (~inside).alias("_gap")).groupBy(*keys, "_v", "_gap").agg(F.count(F.lit(1)).alias("_c"))


def exact_quantiles(long: DataFrame, keys, value: str, probs: Sequence[float],
                    key_bound: int | None = None) -> DataFrame:
    """(keys, p, q): exact quantiles with linear interpolation (``quantile_cont``).

    pos = p·(n−1); q = v[floor] + (pos − floor)·(v[ceil] − v[floor]).  A sketch brackets each rank, one
    counting pass makes it exact, and only the brackets' values are ordered.  Equal
    values are counted first (with partial aggregation), so a value that most
    rows share is one row; a value covers the ranks from its running total on.
    Should a rank lie outside of its bracket, all values are counted and ordered.
    NULL/NaN values are skipped.
    """
    keys = as_list(keys)
    # one representative per number: -0.0 and 0.0 group together
    vals = long.select(*keys, (nan_to_null(value) + F.lit(0.0)).alias("_v")).where(F.col("_v").isNotNull())
    out, missed = _ranked_quantiles(_bracketed(vals, keys, probs, key_bound), keys, probs, key_bound)
    if missed:
        counts = vals.groupBy(*keys, "_v", F.lit(False).alias("_gap")).agg(F.count(F.lit(1)).alias("_c"))
        out, _ = _ranked_quantiles(counts, keys, probs, key_bound)
    return out


def _ranked_quantiles(counts: DataFrame, keys: list[str], probs: Sequence[float], key_bound: int | None) -> tuple[DataFrame, bool]:
    """The quantiles, and whether a wanted rank lay in a gap."""
    ranked = keyed_running_total(counts, keys, ["_v", "_gap"], "_c", "_from")
    # the totals come from the same materialised table, whatever its size
    n = ranked.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    plist = F.array(*[F.lit(float(p)) for p in probs])
    need = (n.select(*keys, "_n", F.explode(plist).alias("p"))
            .withColumn("_pos", F.col("p") * (F.col("_n") - 1))
            .withColumn("_lo", F.floor("_pos").cast("long"))
            .withColumn("_hi", F.ceil("_pos").cast("long"))
            .withColumn("_frac", F.col("_pos") - F.col("_lo")))
    # a few wanted ranks per key, in one row
    wanted = need.groupBy(*keys).agg(F.collect_list(F.struct("p", "_frac", "_lo", "_hi")).alias("_want"))
    picked = attach(ranked, wanted, keys, bound=key_bound)
    inside = lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_c"))
    hits = picked.select(*keys, "_v", "_gap", "_from", "_c", F.explode(F.filter("_want", lambda w: inside(w["_lo"]) | inside(w["_hi"]))).alias("_w"))
    agg = hits.groupBy(*keys, F.col("_w.p").alias("p")).agg(
        F.max(F.when(inside(F.col("_w._lo")), F.col("_v"))).alias("_vlo"),
        F.max(F.when(inside(F.col("_w._hi")), F.col("_v"))).alias("_vhi"),
        F.first("_w._frac").alias("_frac"), F.max("_gap").alias("_gap"))
    agg, _ = checked_small(agg)  # a row per key and rank
    missed = agg.where("_gap").limit(1).count() > 0
    return agg.select(*keys, "p", (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("q")), missed


def quantile_table(long: DataFrame, keys, value: str, probs: dict[str, float],
                   key_bound: int | None = None) -> DataFrame:
    """Exact quantiles pivoted to named columns (``{"q1": .25, ...}``)."""
    keys = as_list(keys)
    q = exact_quantiles(long, keys, value, list(probs.values()), key_bound)
    return q.groupBy(*keys).agg(*[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("q"))).alias(name)
                                  for name, p in probs.items()])


def histogram(df: DataFrame, features: Sequence[str], id_cols: Sequence[str] = ()) -> DataFrame:
    """Per feature: automatic bin width min(Freedman–Diaconis, Sturges), zero-filled bins.

    (feature, bin, lo, hi, count); the maximum falls into the last bin.
    """
    feats = list(features)
    long = unpivot(df, list(id_cols), feats).where(nan_to_null("x").isNotNull())
    stats = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"))
    quart = quantile_table(long, ["feature"], "x", {"q1": 0.25, "q3": 0.75}, key_bound=len(feats))
    st = stats.join(quart, "feature")
    fd = 2 * (F.col("q3") - F.col("q1")) * F.pow(F.col("n"), F.lit(-1.0 / 3.0))
    sturges = (F.col("mx") - F.col("mn")) / (F.log2(F.col("n")) + 1)
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    nb = F.when(F.col("mx") == F.col("mn"), F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil((F.col("mx") - F.col("mn")) / width))).cast("int")
    lo = F.when(F.col("mx") == F.col("mn"), F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(F.col("mx") == F.col("mn"), F.col("mx") + 0.5).otherwise(F.col("mx"))
    st = st.select("feature", nb.alias("nbins"), lo.alias("lo"), hi.alias("hi"))
    binned = attach(long, st, ["feature"], bound=len(feats)).withColumn(
        "bin", F.least(F.floor((F.col("x") - F.col("lo")) * F.col("nbins") / (F.col("hi") - F.col("lo"))),
                       F.col("nbins") - 1).cast("int"))
    counts = binned.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = st.select("feature", "nbins", "lo", "hi", F.explode(F.sequence(F.lit(0), F.col("nbins") - 1)).alias("bin"))
    edge = lambda b: F.col("lo") + (F.col("hi") - F.col("lo")) * b / F.col("nbins")
    return (grid.join(counts, ["feature", "bin"], "left")
            .select("feature", "bin", edge(F.col("bin")).alias("bin_lo"), edge(F.col("bin") + 1).alias("bin_hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def density(df: DataFrame, features: Sequence[str], grid: int = KDE_GRID, cut: float = KDE_CUT) -> DataFrame:
    """Gaussian kernel density per feature on ``grid`` points, Scott bandwidth.

    bandwidth h = n^(-1/5)·stddev_samp; grid from min − cut·h to max + cut·h.
    Pass 1 is a per-feature aggregate; pass 2 counts equal values, so repeated ones
    cost one row; pass 3 is one aggregate with a weighted sum per grid point (no
    join of data with the grid, no pairs).
    """
    feats = list(features)
    long = unpivot(df, [], feats).where(nan_to_null("x").isNotNull())
    st = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx"),
                                     F.stddev_samp("x").alias("sd"))
    h = F.pow(F.col("n"), F.lit(-0.2)) * F.col("sd")
    st = st.select("feature", "n", h.alias("h"), (F.col("mn") - cut * h).alias("g0"),
                   ((F.col("mx") - F.col("mn") + 2 * cut * h) / (grid - 1)).alias("step"))
    counts = long.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("_k"))
    joined = attach(counts, st, ["feature"], bound=len(feats))
    # grid points in chunks of a few sums per row, so that the generated method of the
    # aggregate stays small enough to be compiled; each counted value is copied per chunk
    chunk = 10
    n_chunks = (grid + chunk - 1) // chunk
    rows = joined.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    away = lambda j: (F.col("g0") + (F.col("_c") * chunk + j) * F.col("step") - F.col("x")) / F.col("h")
    sums = [F.sum(F.col("_k") * F.exp(-0.5 * away(j) * away(j))).alias(f"d{j}") for j in range(chunk)]
    agg = rows.groupBy("feature", "n", "h", "g0", "step", "_c").agg(*sums)
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    point = lambda j: F.col("_c") * chunk + j
    pts = F.array(*[F.struct(point(j).alias("point"), (F.col("g0") + point(j) * F.col("step")).alias("grid_x"),
                             (F.col(f"d{j}") / norm).alias("density")) for j in range(chunk)])
    out = agg.select("feature", F.explode(pts).alias("_p")).select("feature", "_p.*")
    return out.where(F.col("point") < grid)


def regression_lines(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """slope, intercept, r2 of target ~ feature for every feature, one pass."""
    rows = []
    aggs = []
    for i, f in enumerate(features):
        x, y = nan_to_null(f), nan_to_null(target)
        aggs += [F.regr_slope(y, x).alias(f"s{i}"), F.regr_intercept(y, x).alias(f"i{i}"),
                 F.regr_r2(y, x).alias(f"r{i}"), F.regr_count(y, x).alias(f"n{i}")]
        rows.append(F.struct(F.lit(f).alias("feature"), F.col(f"s{i}").alias("slope"),
                             F.col(f"i{i}").alias("intercept"), F.col(f"r{i}").alias("r2"), F.col(f"n{i}").alias("n")))
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def tercile_edges(df: DataFrame, target: str, labels: Sequence[str] = ("Low", "Medium", "High")) -> DataFrame:
    """One row: edges e0..e3 of three equal-count bins (exact quantiles)."""
    long = df.select(F.lit(target).alias("feature"), F.col(target).cast("double").alias("x"))
    return quantile_table(long, ["feature"], "x", {"e0": 0.0, "e1": 1 / 3, "e2": 2 / 3, "e3": 1.0}, key_bound=1)


def tercile_label(value: Column, e1: Column, e2: Column, labels=("Low", "Medium", "High")) -> Column:
    """Right-closed bins, lowest value included."""
    return (F.when(value <= e1, F.lit(labels[0])).when(value <= e2, F.lit(labels[1]))
            .when(value.isNotNull(), F.lit(labels[2])))


def with_terciles(df: DataFrame, target: str, name: str = "tercile") -> DataFrame:
    edges = tercile_edges(df, target)
    return (attach(df, edges.select("e1", "e2"), [])
            .withColumn(name, tercile_label(nan_to_null(target), F.col("e1"), F.col("e2"))).drop("e1", "e2"))


def box_stats(long: DataFrame, keys, value: str = "x", key_bound: int | None = None) -> DataFrame:
    """Quartiles, IQR, whiskers (1.5·IQR, clipped to data) and outlier count per key."""
    keys = as_list(keys)
    vals = long.select(*keys, nan_to_null(value).alias("x")).where(F.col("x").isNotNull())
    q = quantile_table(vals, keys, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, key_bound)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    joined = attach(vals, q.select(*keys, "lo_fence", "hi_fence"), keys, bound=key_bound)
    ext = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(F.col("x") >= F.col("lo_fence"), F.col("x"))).alias("whisker_lo"),
        F.max(F.when(F.col("x") <= F.col("hi_fence"), F.col("x"))).alias("whisker_hi"),
        F.count(F.when((F.col("x") < F.col("lo_fence")) | (F.col("x") > F.col("hi_fence")), 1)).alias("n_outliers"))
    return q.join(ext, keys)
