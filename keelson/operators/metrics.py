"""Evaluation metrics as single-pass grouped aggregates (AGG7–AGG11, AGG21, AGG23).

Edge rules: a zero label makes that row's percentage error undefined; it is
skipped (``try_divide``) and counted in ``n_zero_target``.  A constant label
gives r2 = 1.0 for a perfect fit, else 0.0.  Divisions by zero in the
classification report give 0.0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import as_list, nan_to_null


def _r2(ss_res: Column, ss_tot: Column) -> Column:
    return (F.when(ss_tot == 0, F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
            .otherwise(F.lit(1.0) - F.try_divide(ss_res, ss_tot)))


def regression_metric_aggs(label: str, pred: str) -> list[Column]:
    y, p = nan_to_null(label), nan_to_null(pred)
    err = p - y
    return [
        F.count(err).alias("n"),
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(F.try_divide(y - p, y))) * 100).alias("mape"),
        F.count(F.when(y == 0, 1)).alias("n_zero_target"),
        F.sum(err * err).alias("_ss_res"),
        (F.var_pop(F.when(err.isNotNull(), y)) * F.count(err)).alias("_ss_tot"),
    ]


def regression_metrics(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    """n, mse, rmse, mae, mape (%), r2 and n_zero_target in one aggregate."""
    by = as_list(by)
    aggs = regression_metric_aggs(label, pred)
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return (out.withColumn("rmse", F.sqrt("mse"))
            .withColumn("r2", _r2(F.col("_ss_res"), F.col("_ss_tot")))
            .select(*by, "n", "mse", "rmse", "mae", "mape", "r2", "n_zero_target"))


def regressor_summary(df: DataFrame, label: str, pred: str, prefix: str = "", by=None) -> DataFrame:
    """Regression metrics plus example count, label sum/mean and max error, names prefixed."""
    by = as_list(by)
    err = nan_to_null(pred) - nan_to_null(label)
    aggs = regression_metric_aggs(label, pred) + [
        F.sum(nan_to_null(label)).alias("sum_on_target"),
        F.avg(nan_to_null(label)).alias("mean_on_target"),
        F.max(F.abs(err)).alias("max_error"),
    ]
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    out = (out.withColumn("rmse", F.sqrt("mse"))
           .withColumn("r2", _r2(F.col("_ss_res"), F.col("_ss_tot"))))
    names = {"n": "example_count", "mse": "mean_squared_error", "rmse": "root_mean_squared_error",
             "mae": "mean_absolute_error", "mape": "mean_absolute_percentage_error", "r2": "r2_score",
             "sum_on_target": "sum_on_target", "mean_on_target": "mean_on_target", "max_error": "max_error"}
    return out.select(*by, *[F.col(k).alias(prefix + v) for k, v in names.items()])


def accuracy(df: DataFrame, label: str, pred: str, by=None) -> DataFrame:
    by = as_list(by)
    agg = F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy")
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Long form (label, prediction, count) over all label pairs, zero-filled.

    The class set is small by nature; the pair grid is built by exploding it twice.
    """
    counts = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")) \
               .agg(F.count(F.lit(1)).alias("count"))
    classes = (df.select(F.col(label).alias("c")).union(df.select(F.col(pred).alias("c")))
               .distinct().agg(F.array_sort(F.collect_list("c")).alias("cs")))
    grid = (classes.select(F.explode("cs").alias("label"), "cs")
            .select("label", F.explode("cs").alias("prediction")))
    return (grid.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """precision / recall / f1 / support per class, macro and weighted averages, accuracy."""
    counts = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    n, none = F.col("n"), F.lit(0).cast("long")
    # each counted pair speaks once for its label and once for its prediction
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("l").alias("label"), F.when(F.col("l") == F.col("p"), n).otherwise(none).alias("tp"), n.alias("support"), none.alias("predicted")),
        F.struct(F.col("p").alias("label"), none.alias("tp"), none.alias("support"), n.alias("predicted")))))
    per = sides.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    precision = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = per.withColumn("precision", precision.cast("double")).withColumn("recall", recall.cast("double"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    classes = per.select(F.col("label").cast("string").alias("class"), "precision", "recall", "f1",
                         F.col("support").cast("long").alias("support"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").cast("long").alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                 F.col("n").cast("long").alias("support")))).alias("r")).select("r.*")
    return classes.unionByName(summary)


def best_by(df: DataFrame, metric: str, order_col: str, keys=None, columns: Sequence[str] | None = None) -> DataFrame:
    """Row with the lowest ``metric`` per key; the earliest ``order_col`` wins ties.

    ``min(struct(metric, order, row))`` is a partial aggregate: no sort, no
    window, map-side combine before the shuffle.
    """
    keys = as_list(keys)
    cols = [c for c in (columns or df.columns) if c not in keys]
    m = nan_to_null(metric)
    best = F.min(F.when(m.isNotNull(), F.struct(m.alias("_m"), F.col(order_col).alias("_o"),
                                                 F.struct(*cols).alias("_row"))))
    out = df.groupBy(*keys).agg(best.alias("_b")) if keys else df.agg(best.alias("_b"))
    return out.select(*keys, "_b._row.*")
