"""Document quality by hierarchical empirical Bayes over sites.

Evidence of a document is a logistic classifier on the frequencies of its bytes and a few shape
features, fitted on a bounded sample of labelled rows.  Its mean over all documents is the global
rate; hosts shrink towards it and paths towards their host.  The weight of each prior, in documents, is
the variance inside sites over the variance between them, estimated by moments from all sites: what
sites of that size would differ by chance is subtracted, so where sites do not differ they say nothing,
and a sparse site always says little.  The posterior odds of a document are the classifier's odds times
the odds of its path without the document itself, relative to the global ones.

Site sums are grouped aggregates with map-side combination, so a host with a third of the rows
sends one partial sum per task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import join_small, persisted
from keelson.session import ship

# Labelled rows that the classifier is fitted on, at most (the ones with the smallest id hashes).
SAMPLE = 12_000
PENALTY = 1e-4
# A document is rejected below this posterior probability of being good.
REJECT = 0.5
EXTRA = 4


def features(text: str | None) -> np.ndarray:
    """Square roots of the byte frequencies (A-Z folded), and shape: log length, mean word length,
    lines per word, distinct share of the words."""
    raw = (text or "").encode()
    out = np.zeros(256 + EXTRA, np.float32)
    if not raw:
        return out
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    out[:256] = np.sqrt(hist / len(raw))
    out[256] = np.log1p(len(raw)) / 10
    out[257] = min(4.0, len(raw) / (len(words) + 1) / 10)
    out[258] = min(4.0, hist[10] / (len(words) + 1))
    out[259] = len(set(words)) / (len(words) + 1)
    return out


class Classifier:
    """Logistic regression by Newton steps."""

    def __init__(self, weights: np.ndarray, centre: np.ndarray):
        self.weights, self.centre = weights, centre

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 25) -> Classifier:
        centre = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        a = np.c_[np.ones(len(x)), x - centre].astype(np.float64)
        w = np.zeros(a.shape[1])
        if len(x):
            w[0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        ridge = np.full(len(w), penalty * max(len(x), 1))
        ridge[0] = 1e-9
        for _ in range(steps if len(x) and 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve((a.T * (p * (1 - p) + 1e-9)) @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(w, centre)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[0] + (x - self.centre) @ self.weights[1:], -20, 20)


def fit_classifier(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Classifier:
    """Fitted on at most ``sample`` labelled documents, chosen by a hash of their ids.  Rows with a
    null id, text or label are no examples; a document with several labels counts for each.  Without
    both labels the classifier is constant."""
    ship(docs.sparkSession)
    some = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y"))
    some = persisted(some.orderBy(F.md5(F.col("_id").cast("string")), "_y").limit(sample))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(some), "_id")  # at most ``sample`` rows

    def run(batches):
        for batch in batches:
            x = [features(t).astype("<f4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(2)], names=["x", "y"])

    found = rows.select("_id", "_text", "_y").mapInArrow(run, "x binary, y double").limit(2 * sample).collect()
    found.sort(key=lambda r: hashlib.md5(bytes(r["x"])).digest())  # the sums do not depend on the order of arrival
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in found), "<f4").reshape(len(found), 256 + EXTRA)
    return Classifier.fit(x, np.array([r["y"] for r in found], dtype=float))


def _score(model: Classifier, text: str, names: list[str]):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            x = np.stack([features(t) for t in texts]) if texts else np.zeros((0, 256 + EXTRA), np.float32)
            cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(model.logit(x), pa.float64())], names=[*names, "_logit"])

    return run


def _logit(p):
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


# Bounds of a prior's weight, in documents.
WEAKEST, STRONGEST = 1.0, 1e4


def strength(inside, free_inside, between, free_between, spread):
    """Weight of the prior: variance inside sites over variance between sites (analysis of variance of
    unequal groups).  ``inside`` and ``between`` are sums of squares with their degrees of freedom;
    ``spread`` is n - sum(n_site^2 / n_parent).  Without repeated sites, or if sites differ no more than
    chance, the prior has its greatest weight."""
    within = F.try_divide(inside, free_inside)
    across = F.try_divide(between - free_between * within, spread)
    found = F.when(across > 0, within / across).otherwise(F.lit(STRONGEST))
    return F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), F.coalesce(found, F.lit(STRONGEST))))


def posteriors(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scored rows (_host, _path, _logit) -> one row (m0, k0, k1): the global rate and the weights of
    the priors; and one row per path: sums of its probabilities and documents (s, n) and its host's
    (hs, hn), m0, k0, k1, and the posteriors host_post and path_post."""
    p = 1 / (1 + F.exp(-F.col("_logit")))
    paths = persisted(scored.groupBy("_host", "_path").agg(F.sum(p).alias("s"), F.sum(p * p).alias("q"), F.count(F.lit(1)).cast("double").alias("n")))
    square = lambda s, n: F.col(s) * F.col(s) / F.col(n)
    hosts = paths.groupBy("_host").agg(F.sum("s").alias("hs"), F.sum("q").alias("hq"), F.sum("n").alias("hn"), F.count(F.lit(1)).alias("paths"),
                                       F.sum(square("s", "n")).alias("path_squares"), F.sum(F.col("n") * F.col("n")).alias("path_sizes"))
    hosts = persisted(hosts)
    total = hosts.agg(F.sum("hs").alias("s"), F.sum("hq").alias("q"), F.sum("hn").alias("n"), F.count(F.lit(1)).alias("hosts"), F.sum("paths").alias("paths"),
                      F.sum(square("hs", "hn")).alias("host_squares"), F.sum(F.col("hn") * F.col("hn")).alias("host_sizes"),
                      F.sum("path_squares").alias("path_squares"), F.sum(F.col("path_sizes") / F.col("hn")).alias("path_sizes"))
    k0 = strength(F.col("q") - F.col("host_squares"), F.col("n") - F.col("hosts"), F.col("host_squares") - square("s", "n"), F.col("hosts") - 1,
                  F.col("n") - F.col("host_sizes") / F.col("n"))
    k1 = strength(F.col("q") - F.col("path_squares"), F.col("n") - F.col("paths"), F.col("path_squares") - F.col("host_squares"), F.col("paths") - F.col("hosts"),
                  F.col("n") - F.col("path_sizes"))
    rates = total.select(((F.coalesce("s", F.lit(0.0)) + 1) / (F.coalesce("n", F.lit(0.0)) + 2)).alias("m0"), k0.alias("k0"), k1.alias("k1"))
    rates = persisted(rates)  # one row
    sites = paths.join(hosts.select(F.col("_host").alias("_h"), "hs", "hn"), F.col("_host").eqNullSafe(F.col("_h"))).drop("_h", "q").crossJoin(F.broadcast(rates))
    sites = sites.withColumn("host_post", (F.col("hs") + F.col("k0") * F.col("m0")) / (F.col("hn") + F.col("k0")))
    return rates, sites.withColumn("path_post", (F.col("s") + F.col("k1") * F.col("host_post")) / (F.col("n") + F.col("k1")))


def score_quality(docs: DataFrame, model: Classifier, host: str = "source", path: str = "lang", text: str = "text", keep: list[str] | None = None, threshold: float = REJECT) -> DataFrame:
    """Adds to the columns ``keep`` (default: all) ``_evidence`` (classifier probability),
    ``_host_post``, ``_path_post``, ``_quality`` (posterior probability) and ``_good``.

    ``_host_post`` and ``_path_post`` are the sites' posteriors from all of their documents; a document's
    ``_quality`` leaves its own evidence out of them, so a document alone on its site is judged by
    itself and its parents.

    Null and empty texts have the evidence of a text without bytes and count for their sites.  Null
    hosts and paths are sites of their own.  Repeated rows count each.  An empty table gives no rows.
    The new columns' names must be free (it raises).

    Texts are featurised once and the scores written, if the texts are not among ``keep``; otherwise
    writing them would cost more than a second pass.
    """
    names = list(keep if keep is not None else docs.columns)
    clash = {"_logit", "_host", "_path", "_site", "_sums"} & set(docs.columns) | {"_evidence", "_host_post", "_path_post", "_quality", "_good"} & set(names)
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    ship(docs.sparkSession)
    wanted = list(dict.fromkeys([*names, text]))
    source = docs.select(*wanted, F.col(host).cast("string").alias("_host"), F.col(path).cast("string").alias("_path"))
    out = [*names, "_host", "_path"]
    schema = T.StructType([*[source.schema[n] for n in out], T.StructField("_logit", T.DoubleType())])
    scored = source.mapInArrow(_score(model, text, out), schema)
    if text in names:
        slim = source.select(F.col(text), "_host", "_path")
        slim = slim.mapInArrow(_score(model, text, ["_host", "_path"]), "_host string, _path string, _logit double")
    else:
        scored = persisted(scored)
        slim = scored.select("_host", "_path", "_logit")
    _, sites = posteriors(slim)
    # A key without nulls, so that sites join by plain equality.
    site = F.to_json(F.struct("_host", "_path")).alias("_site")
    sites = sites.select(site, "m0", "k0", "k1", "s", "n", "hs", "hn", F.col("host_post").alias("_host_post"), F.col("path_post").alias("_path_post"))
    sites = sites.select("_site", "_host_post", "_path_post", F.struct("m0", "k0", "k1", "s", "n", "hs", "hn").alias("_sums"))
    joined = join_small(scored.select("*", site), sites, ["_site"], F.octet_length("_site") + 80, "left")
    own = 1 / (1 + F.exp(-F.col("_logit")))
    at = lambda c: F.col("_sums")[c]
    host = (at("hs") - own + at("k0") * at("m0")) / (at("hn") - 1 + at("k0"))
    path_rate = (at("s") - own + at("k1") * host) / (at("n") - 1 + at("k1"))
    odds = F.col("_logit") + _logit(path_rate) - _logit(at("m0"))
    quality = 1 / (1 + F.exp(-odds))
    return joined.select(*names, own.alias("_evidence"), "_host_post", "_path_post", quality.alias("_quality"), (quality >= F.lit(threshold)).alias("_good"))
