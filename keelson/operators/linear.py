"""Keyed line fits on standardised data, scored on held-out rows (the minimum slice).

split (exact, seeded) → mean/std on training rows per key → standardise both
sides → least-squares line on training rows (``regr_slope``/``regr_intercept``)
→ predict test rows → back to original units → metrics per key.  Every step is
a grouped aggregate or a join of a per-key table: all shuffles are on the key
or on the balanced ordinal, no Python in the plan after the split ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import nan_to_null, unit_if_zero
from keelson.operators.metrics import regression_metrics
from keelson.operators.ordering import attach
from keelson.operators.prep import drop_missing
from keelson.operators.split import exact_split


def line_fit(df: DataFrame, x: str, y: str, keys) -> DataFrame:
    """slope, intercept and r2 of ``y ~ x`` per key."""
    return df.groupBy(*keys).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                                 F.regr_r2(y, x).alias("fit_r2"))


def keyed_fit_eval(df: DataFrame, key: str, feature: str, target: str, id_cols, ratio: float = 0.2,
                   seed=42, key_bound: int | None = None) -> DataFrame:
    """Per key: exact split, train-only scaler and line fit, metrics on test rows.

    The split feeds two branches only: one grouped aggregate over training rows
    (scaler statistics and the least-squares moments in the same pass) and the
    test rows joined with that per-key table.  In standardised units the line
    has slope ``regr_slope(y, x)·sx/sy`` and intercept 0, so no second pass
    over scaled training rows is needed.
    """
    base = drop_missing(df.select(*dict.fromkeys([key, *id_cols, feature, target])), [feature, target])
    split = exact_split(base, id_cols, ratio, seed, keys=[key])
    stats = (split.where(~F.col("is_test")).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_train"),
        F.avg(feature).alias("mx"), F.stddev_pop(feature).alias("sx"),
        F.avg(target).alias("my"), F.stddev_pop(target).alias("sy"),
        F.regr_slope(target, feature).alias("slope_raw"), F.regr_intercept(target, feature).alias("intercept")))
    stats = stats.withColumn("slope", F.col("slope_raw") * unit_if_zero("sx") / unit_if_zero("sy"))
    test = attach(split.where(F.col("is_test")), stats, [key], bound=key_bound)
    zx = (F.col(feature) - F.col("mx")) / unit_if_zero("sx")
    pred = test.withColumn("pred", (F.col("slope") * zx) * unit_if_zero("sy") + F.col("my"))
    metrics = regression_metrics(pred, target, "pred", by=[key]).withColumnRenamed("n", "n_test")
    return stats.select(key, "n_train", "slope", "intercept").join(metrics, key, "left")
