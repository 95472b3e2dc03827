"""Least squares on several features per key, from sums of products that can be merged.

A row is the vector z = (1, features, label), all but the first less the key's shifts; its key's *Gram
state* is the sum of z zᵀ, kept as the packed upper triangle.  A task multiplies the rows of each key in
its batches (numpy) and sends one partial state for each, which are summed by element, so a hot key
costs a few rows in the shuffle.  Two states add up, and the fit of all rows ever added follows from the
state alone: new rows extend a model without the old ones being read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.exprs import as_list
from keelson.operators.ordering import checked_small
from keelson.operators.selection import join_null_safe
from keelson.session import ship

# Rows that a key must have before it gets a model, for each coefficient.
ROWS_EACH = 2


def _partial(names: list[str]):
    """Rows (keys, z) -> one packed partial state for each key of a batch."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            z = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            upper = np.triu_indices(z.shape[1])
            code = np.zeros(batch.num_rows, np.int64)
            if names:
                code = batch.select(names).to_pandas().groupby(names, dropna=False, sort=False).ngroup().to_numpy()
            order = np.argsort(code, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(code[order])) + 1)
            keys = batch.select(names).take(pa.array([p[0] for p in parts])).columns if names else []
            grams = [(z[p].T @ z[p])[upper] for p in parts]
            yield pa.RecordBatch.from_arrays([*keys, pa.array([g.tolist() for g in grams], pa.list_(pa.float64()))], names=[*names, "gram"])

    return run


def gram_states(rows: DataFrame, keys: Sequence[str], z: str = "z") -> DataFrame:
    """(keys, gram): the packed sum of products of the row vectors ``z`` (arrays of one length, without
    NULL or NaN) of each key.  NULL is a key; a key without rows is not there."""
    keys = list(keys)
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("gram", T.ArrayType(T.DoubleType()))])
    parts = rows.select(*keys, z).mapInArrow(_partial(keys), schema)
    sums = parts.select(*keys, F.posexplode("gram").alias("_i", "_s")).groupBy(*keys, "_i").agg(F.sum("_s").alias("_s"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_s"))), lambda e: e["_s"])
    return sums.groupBy(*keys).agg(packed.alias("gram"))


def gram_add(a: Column, b: Column) -> Column:
    """Sum of two states; NULL is an empty one."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.zip_with(a, b, lambda x, y: x + y))


def unpack(packed: np.ndarray) -> np.ndarray:
    """The symmetric matrix of a packed state."""
    n = int((np.sqrt(8 * len(packed) + 1) - 1) / 2)
    out = np.zeros((n, n))
    out[np.triu_indices(n)] = packed
    return out + np.triu(out, 1).T


def solve(gram: np.ndarray) -> np.ndarray:
    """Coefficients (constant first) of the label on the features: least squares of smallest norm in
    columns of equal length, so dependent features are no error."""
    a, b = gram[:-1, :-1], gram[:-1, -1]
    scale = np.sqrt(np.diag(a))
    scale[scale == 0] = 1
    found = np.linalg.lstsq(a / np.outer(scale, scale), b / scale, rcond=1e-13)[0]
    return found / scale


def _solved(rows_each: int, extra: bool):
    def run(batches):
        for batch in batches:
            gram = batch.column(batch.schema.get_field_index("gram")).to_pylist()
            last = batch.column(batch.schema.get_field_index("extra")).to_pylist() if extra else [None] * len(gram)
            out = []
            for g, z in zip(gram, last):
                m = unpack(np.array(g, dtype=float)) if g is not None else 0
                if z is not None:
                    m = m + np.outer(z, z)
                enough = np.ndim(m) == 2 and m[0, 0] >= rows_each * (len(m) - 1)
                out.append(solve(m).tolist() if enough and np.isfinite(m).all() else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float64()))], names=[*batch.schema.names, "coef"])

    return run


def with_coefficients(states: DataFrame, rows_each: int = ROWS_EACH) -> DataFrame:
    """Adds ``coef`` to rows with ``gram`` and, if there is such a column, one more row vector
    ``extra`` that is not in the state; NULL with fewer than ``rows_each`` rows for each coefficient."""
    schema = T.StructType([*states.schema.fields, T.StructField("coef", T.ArrayType(T.DoubleType()))])
    return states.mapInArrow(_solved(rows_each, "extra" in states.columns), schema)


def predicted(coef: Column, features: Column, shift: Column) -> Column:
    """Prediction from an array of features; ``shift`` has one number for each of them and the label's.
    NULL without a model or with too few features."""
    n = F.size(features)
    shifted = F.zip_with(features, F.slice(shift, F.lit(1), n), lambda x, s: x - s)
    total = F.aggregate(F.zip_with(F.slice(coef, F.lit(2), n), shifted, lambda c, x: c * x), F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(coef) == n + 1) & (F.size(shift) == n + 1), F.element_at(shift, -1) + F.element_at(coef, 1) + total)


def fit(df: DataFrame, keys, features: Sequence[str], label: str, rows_each: int = ROWS_EACH) -> DataFrame:
    """Per key: ``shift`` (means of features and label), ``gram``, ``n_rows`` and ``coef``.  Rows with a missing feature or
    label do not count.  Two aggregates: means, then products of deviations."""
    ship(df.sparkSession)
    keys = as_list(keys)
    finite = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in [*features, label]]
    keep = finite[0]
    for f in finite[1:]:
        keep = keep & f
    rows = df.where(keep).select(*keys, *[F.col(c).cast("double").alias(c) for c in [*features, label]])
    shift = rows.groupBy(*keys).agg(F.array(*[F.avg(c) for c in [*features, label]]).alias("shift"), F.count(F.lit(1)).alias("_n"))
    shift = shift.where("_n > 0").drop("_n")
    z = F.array(F.lit(1.0), *[F.col(c) - F.col("shift")[i] for i, c in enumerate([*features, label])])
    shift, small = checked_small(shift)
    state = gram_states(join_null_safe(rows, shift, keys, "inner", small).select(*keys, z.alias("z")), keys)
    return with_coefficients(join_null_safe(state, shift, keys, "inner", small), rows_each).withColumn("n_rows", F.element_at("gram", 1).cast("long"))
