"""Quality classifier with hierarchical empirical Bayes (operator 2).

A document classifier gives each text its own evidence. Sites give a prior:
all documents' probabilities are added up per path and per host, host means
are shrunk to the global mean and path means to their host's, each by a
strength estimated from how much hosts (paths) really differ, so that a
site with little evidence falls back to its parent. A document's odds are
the site's prior odds times the likelihood ratio of its own evidence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.llm.common import hash_sample, small_batches, staged, thinned

# Labelled documents the classifier is fitted on at most (those with the
# smallest id hashes; of an id with several texts, the smallest text hashes).
# Everything else covers all documents.
FIT_ROWS = 8000
N_FEATURES = 50


def features(text: str | None) -> np.ndarray:
    """Style of a whole text: log share of each byte class, word repetition,
    word and line lengths. NULL is like an empty text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n = max(len(raw), 1)
    marks = np.concatenate((counts[33:48], counts[58:65], counts[91:97], counts[123:127]))
    share = np.concatenate((marks, [counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(),
                                    counts[128:].sum(), counts[32], counts[10], counts[:32].sum() - counts[10]]))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_words = max(len(words), 1)
    # words as numbers: distinct pairs and triples of a very long text are counted in arrays
    known: dict[bytes, int] = {}
    code = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    pairs, pair = np.unique(code[:-1] * len(known) + code[1:], return_inverse=True)
    triples = np.unique(pair[:-1] * len(known) + code[2:])
    other = [
        math.log1p(len(words)),
        len(known) / n_words,
        len(known) / math.sqrt(n_words),
        (n - counts[32]) / n_words / 10,
        len(pairs) / n_words,
        len(set(lines)) / max(len(lines), 1),
        math.log1p(n_words / max(len(lines), 1)),
        np.count_nonzero(code[1:] == code[:-1]) / n_words,
        len(triples) / n_words,
        sum(map(bytes.isupper, words)) / n_words,
        float(not words),
    ]
    return np.concatenate((np.log(share / n + 1e-3), other))


@dataclass
class Classifier:
    """Logistic regression on standardised features."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float  # log odds of a good label where it was fitted

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights + self.bias, -30, 30)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Classifier:
    """Ridge logistic regression by Newton steps. With no rows, or one class
    only, every document gets the same evidence."""
    if not len(y):
        return Classifier(np.zeros(1), np.ones(1), np.zeros(1), 0.0, 0.0)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    prior = math.log(rate / (1 - rate))
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.hstack(((x - mean) / scale, np.ones((len(x), 1))))
    w = np.zeros(z.shape[1])
    w[-1] = prior
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + penalty * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), grad)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(mean, scale, w[:-1], float(w[-1]), prior)


def fit(documents: DataFrame, labels: DataFrame, target: str = "quality",
        fit_rows: int = FIT_ROWS) -> Classifier:
    """Fit the document classifier on at most ``fit_rows`` labelled documents.

    Labels that are NULL are left out; a label above 0 is good. The labelled
    ids taken are few enough to broadcast, so only their texts are shuffled.
    Repeated labels, and repeated rows of one id and text, count once.
    """
    spark = documents.sparkSession
    small_batches(spark)
    known = labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("_id"), (F.col(target) > 0).cast("int").alias("_good"))
    few = hash_sample(known.distinct(), fit_rows, "_id", "_good")
    few = staged(few, "quality-labels")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "good": b["good"], "x": [features(t) for t in b["text"]]})

    taken = documents.select(F.col("doc_id").cast("bigint").alias("id"), "text")
    taken = (taken.join(F.broadcast(few), F.col("id") == F.col("_id"))  # at most fit_rows labels
             .select("id", F.col("_good").alias("good"), "text", F.xxhash64("text").alias("h")))
    picks = _picks(staged(taken.select("id", "good", "h").distinct(), "quality-texts"), fit_rows)
    rows = (taken.join(F.broadcast(picks), ["id", "good", "h"], "left_semi")
            .select("id", "good", "text").distinct()
            .mapInPandas(run, "id bigint, good int, x array<double>")
            .orderBy("id", "good", "x").collect())
    x = np.array([r.x for r in rows]) if rows else np.zeros((0, 1))
    return fit_logistic(x, np.array([r.good for r in rows], float))


def _picks(texts: DataFrame, n: int) -> DataFrame:
    """At most ``n`` of the distinct ``(id, good, h)``: every id and label gives its
    text of the smallest hash before any gives a second one, and so on.

    An id with many texts is thinned before they meet, so no task holds them all.
    """
    by = ["id", "good"]
    of = staged(texts.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("h").alias("_h")), "quality-ids")
    each = 4 * math.ceil(n / max(of.count(), 1))
    near = texts.join(F.broadcast(of), by).filter(  # at most n ids
        (F.col("h") == F.col("_h")) | thinned(F.lit(each) / F.col("_n"), "id", "good", "h"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
    return (near.select(*by, "h", place.alias("_place"))
            .orderBy("_place", F.xxhash64(F.lit("rank"), *by, "h"), *by, "h").limit(n).select(*by, "h"))


def evidence(spark: SparkSession, model: Classifier, text: str = "text") -> Column:
    """The classifier's log odds of a good document; only the text goes to Python."""
    small_batches(spark)

    @F.pandas_udf("double")
    def logit(texts: pd.Series) -> pd.Series:
        if len(model.weights) == 1 or not len(texts):  # nothing was learned
            return pd.Series(np.zeros(len(texts)))
        return pd.Series(model.logits(np.array([features(t) for t in texts])))

    return logit(F.col(text))


def _strength(mean: float, spread: float, noise: float) -> float:
    """Prior strength (in documents) of a Beta prior whose members' means vary
    by ``spread``, of which ``noise`` is sampling."""
    true = max(spread - noise, 1e-6)
    return float(np.clip(mean * (1 - mean) / true - 1, 2.0, 1e6))


def site_priors(scores: DataFrame) -> tuple[DataFrame, float]:
    """``(host, path, prior)`` -- posterior mean quality of each path -- and the
    global mean. ``scores`` has ``host, path, p`` for all documents.

    Two grouped sums (documents to paths to hosts), each with partial
    aggregation, so a host with a third of all rows costs no more than
    another. NULL hosts and paths are groups of their own. Only five
    scalars per level reach the driver.
    """
    paths = staged(scores.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")),
                   "quality-paths")
    hosts = staged(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")), "quality-hosts")
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    if not total.n:
        return paths.select("host", "path", F.lit(0.5).alias("host_prior"), F.lit(0.5).alias("prior")), 0.5
    mean = float(np.clip(total.s / total.n, 1e-4, 1 - 1e-4))

    def strength(rows: DataFrame, n: str, m: Column, around: Column, size: float) -> float:
        r = rows.agg(F.sum(F.col(n) * (m - around) ** 2).alias("spread"),
                     F.count(F.lit(1)).alias("k")).first()
        return _strength(mean, r.spread / size, mean * (1 - mean) * r.k / size)

    host_mean = F.col("hs") / F.col("hn")
    k_host = strength(hosts, "hn", host_mean, F.lit(mean), total.n)
    hosts = hosts.select(F.col("host").alias("_host"),
                         ((F.col("hs") + k_host * mean) / (F.col("hn") + k_host)).alias("host_prior"))
    both = staged(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "quality-both")
    k_path = strength(both, "n", F.col("s") / F.col("n"), F.col("host_prior"), total.n)
    prior = (F.col("s") + k_path * F.col("host_prior")) / (F.col("n") + k_path)
    return staged(both.select("host", "path", "host_prior", prior.alias("prior")), "quality-priors"), mean


def posterior(rows: DataFrame, priors: DataFrame, mean: float) -> DataFrame:
    """Add ``host_prior``, ``prior`` and the posterior ``quality`` to rows with
    ``host``, ``path`` and ``doc_logit``."""
    p = priors.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "host_prior", "prior")
    joined = rows.join(p, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")),
                       "left").drop("_host", "_path")
    safe = F.least(F.greatest(F.coalesce("prior", F.lit(mean)), F.lit(1e-4)), F.lit(1 - 1e-4))
    shift = F.log(safe / (1 - safe)) - math.log(mean / (1 - mean))
    return joined.withColumn("quality", 1 / (1 + F.exp(-(F.col("doc_logit") + shift))))


def url_site(url) -> tuple[Column, Column]:
    """Host and first path segment of a URL column."""
    u = F.col(url) if isinstance(url, str) else url
    return (F.lower(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)),
            F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1))


def _model_and_priors(documents: DataFrame, labels: DataFrame, host: Column, path: Column):
    model = fit(documents, labels)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), host.alias("host"),
                            path.alias("path"), evidence(documents.sparkSession, model).alias("doc_logit"))
    rows = staged(rows, "quality-evidence")
    p = 1 / (1 + F.exp(-F.col("doc_logit")))
    priors, mean = site_priors(rows.select("host", "path", p.alias("p")))
    return model, rows, priors, mean


def classify(documents: DataFrame, labels: DataFrame, host: Column, path: Column,
             threshold: float = 0.5) -> DataFrame:
    """One row per document: ``doc_id, host, path, doc_logit, host_prior,
    path_prior, quality, kept``.

    NULL or empty texts get the evidence of an empty text. NULL hosts and
    paths are sites of their own. Repeated rows are rows of their own, and
    other columns do not matter. With no labels every document has the same
    evidence and is kept.
    """
    _, rows, priors, mean = _model_and_priors(documents, labels, host, path)
    return (posterior(rows, priors, mean)
            .select("doc_id", "host", "path", "doc_logit", "host_prior",
                    F.col("prior").alias("path_prior"), "quality",
                    (F.col("quality") >= threshold).alias("kept")))


def good(documents: DataFrame, labels: DataFrame, host: Column, path: Column,
         threshold: float = 0.5) -> DataFrame:
    """The documents ``classify`` keeps, with all their columns.

    Texts are scored a second time in the pass that filters, which costs
    less than shuffling them to join the first pass's scores.
    """
    model, _, priors, mean = _model_and_priors(documents, labels, host, path)
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(row.alias("row"), host.alias("host"), path.alias("path"),
                            evidence(documents.sparkSession, model).alias("doc_logit"))
    scored = posterior(rows, priors, mean)
    return scored.filter(F.col("quality") >= threshold).select("row.*")
