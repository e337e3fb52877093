"""Quality classifier: hierarchical empirical Bayes over documents, paths, hosts.

A logistic regression on counts of the whole text gives each document its
evidence (log odds against the training share).  The mean evidence-based
probability of each host and of each path within it is shrunk towards its
parent (path -> host -> all): the parent counts as much as k documents, k from
the spread of the children (method of moments), so a sparse site follows its
parent and a large one itself.  A document's posterior joins its evidence with
the posterior of its path; below ``keep_at`` it is rejected.

The regression is fitted on at most ``SAMPLE`` labelled rows (least hashes of the
id) whose crc32(id) mod 3 is not 1, one text of each id; the others are held out.  Site sums cover
all documents.

Defined cases: a null text counts as empty; a null host or path is a site of its own;
null ids are never training rows; with no label of either class the evidence is 0 and
everything follows the prior 0.5 (kept); repeated rows are rows like others.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, materialise, text_key
from tessera.llm.textstats import FIELDS, stats

SAMPLE = 8_000       # labelled rows of each class the regression is fitted on, at most
STRENGTH = (2.0, 1e4)  # least and most documents a parent counts as


def features(texts) -> np.ndarray:
    s = np.array([stats(t) for t in texts], dtype=np.float64).reshape(-1, len(FIELDS))
    w = np.maximum(s[:, 0], 1)
    lines = np.maximum(s[:, 5], 1)
    chars = np.maximum(s[:, 1], 1)
    return np.stack([s[:, 2] / w, np.minimum(s[:, 2] / chars * 20, 3), s[:, 4] / w, s[:, 3] / lines, s[:, 1] / w / 10, np.log1p(s[:, 0]) / 10,
                     s[:, 6] / np.minimum(w, 400), s[:, 7] / w, s[:, 8] / lines, (s[:, 0] < 50).astype(np.float64)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> dict:
    """Ridge logistic regression by Newton steps on standardised columns."""
    mean, sd = x.mean(axis=0), x.std(axis=0)
    sd[sd == 0] = 1
    z = np.c_[np.ones(len(x)), (x - mean) / sd]
    b = np.zeros(z.shape[1])
    pen = np.full(len(b), ridge * weight.sum())
    pen[0] = 0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        g = z.T @ (weight * (y - p)) - pen * b
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(pen + 1e-9)
        step = np.linalg.solve(h, g)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return {"mean": mean, "sd": sd, "b": b}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """The document model: regression and ``prior``, the share of label 1."""
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 3 != 1))
           .groupBy(F.col(id_col).alias("_lid")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y")))
    lab = materialise(lab, "labelled")
    n = {r.y: r.n for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {"mean": 0.0, "sd": 1.0, "b": None, "prior": 0.5}
    # at most 2 * sample rows
    part = [lab.where(F.col("y") == y).orderBy(F.xxhash64("_lid"), "_lid").limit(sample) for y in (0, 1)]
    pick = F.broadcast(part[0].unionByName(part[1]))
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(pick, F.col("_id") == F.col("_lid")).select("_lid", text_key(F.col("_text")).alias("k"), "_text", "y")

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"_lid": b["_lid"], "k": b["k"], "x": list(features(b["_text"])), "y": b["y"]})

    # one row of each id, that of the least text key: at most 2 * sample
    rows = (d.mapInPandas(run, f"_lid {dict(d.dtypes)['_lid']}, k binary, x array<double>, y int")
            .groupBy("_lid").agg(F.min(F.struct("k", "x", "y")).alias("e")).select("_lid", "e.x", "e.y").toPandas().sort_values("_lid"))
    if rows["y"].nunique() < 2:
        return {"mean": 0.0, "sd": 1.0, "b": None, "prior": 0.5}
    y = rows["y"].to_numpy(dtype=np.float64)
    share = n[1] / (n[0] + n[1])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return fit_logistic(np.stack(rows["x"]), y, weight) | {"prior": share}


def evidence(model: dict, texts) -> np.ndarray:
    """Log odds of quality beyond the training share."""
    if model["b"] is None:
        return np.zeros(len(texts))
    x = (features(texts) - model["mean"]) / model["sd"]
    return np.clip(model["b"][0] + x @ model["b"][1:], -30, 30) - math.log(model["prior"] / (1 - model["prior"]))


def _logit(c):
    return F.log(c / (1 - c))


def _strength(children: DataFrame, parent) -> float:
    """Documents a parent counts as: mean(1 - mean) over the variance between
    children beyond that of their own documents, less one."""
    r = children.select(F.col("n"), F.col("p"), parent.alias("m"), F.col("v")).agg(
        F.sum("n"), F.sum(F.col("n") * (F.col("p") - F.col("m")) ** 2), F.sum("v"), F.sum(F.col("n") * F.col("m") * (1 - F.col("m")))).first()
    if not r[0]:
        return STRENGTH[0]
    between = max(0.0, (r[1] - (r[2] or 0.0)) / r[0])
    spread = r[3] / r[0]
    return min(STRENGTH[1], max(STRENGTH[0], spread / between - 1 if between > 0 else STRENGTH[1]))


def site_priors(scored: DataFrame, prior: float) -> DataFrame:
    """(host, path, evidence) -> one row per path: host, path, n, host_mean, path_mean."""
    p = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(math.log(prior / (1 - prior))))))
    paths = materialise(scored.withColumn("q", p).groupBy("host", "path")
                        .agg(F.count("*").alias("n"), F.sum("q").alias("s"), F.sum(F.col("q") * F.col("q")).alias("s2")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("s2").alias("s2"))
    total = hosts.agg(F.sum("n"), F.sum("s")).first()
    mu = min(1 - 1e-6, max(1e-6, total[1] / total[0])) if total[0] else prior
    # v: n times the variance of the mean of a child's documents
    spread = (F.col("s2") / F.col("n") - (F.col("s") / F.col("n")) ** 2).alias("v")
    k = _strength(hosts.select("n", (F.col("s") / F.col("n")).alias("p"), spread), F.lit(mu))
    hosts = hosts.select(F.col("host").alias("_h"), ((F.col("s") + k * mu) / (F.col("n") + k)).alias("host_mean"))
    both = paths.join(broadcast_if_small(materialise(hosts, "hosts")), F.col("host").eqNullSafe(F.col("_h"))).drop("_h")
    k = _strength(both.select("n", (F.col("s") / F.col("n")).alias("p"), spread, "host_mean"), F.col("host_mean"))
    mean = (F.col("s") + k * F.col("host_mean")) / (F.col("n") + k)
    return both.select("host", "path", "n", "host_mean", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), mean)).alias("path_mean"))


def _scored(docs: DataFrame, model: dict, id_col: str, text_col: str, host_col: str, path_col: str) -> DataFrame:
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))

    def run(batches):
        for b in batches:
            out = b[["id", "host", "path"]].copy()
            out["evidence"] = evidence(model, b["_text"])
            yield out

    return materialise(d.mapInPandas(run, f"id {dict(d.dtypes)['id']}, host string, path string, evidence double"), "evidence")


def quality_classifier(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                       path_col: str = "lang", label_col: str = "quality", keep_at: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """One row per document: id, evidence, host_mean, path_mean, quality (posterior), kept."""
    model = train(docs, labels, id_col, text_col, label_col, sample)
    s = _scored(docs, model, id_col, text_col, host_col, path_col)
    sites = materialise(site_priors(s, model["prior"]), "sites").withColumnRenamed("host", "_h").withColumnRenamed("path", "_p")
    s = s.join(broadcast_if_small(sites), F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    q = 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_mean")))))
    return s.select(F.col("id").alias(id_col), "evidence", "host_mean", "path_mean", q.alias("quality"), (q >= keep_at).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
              path_col: str = "lang", label_col: str = "quality", keep_at: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are not rejected, columns unchanged.  The
    evidence is computed again beside the text, which is never shuffled."""
    model = train(docs, labels, id_col, text_col, label_col, sample)
    sites = materialise(site_priors(_scored(docs, model, id_col, text_col, host_col, path_col), model["prior"]), "sites")
    sites = broadcast_if_small(sites.select(F.col("host").alias("_qh"), F.col("path").alias("_qp"), _logit(F.col("path_mean")).alias("_qprior")))
    d = docs.join(sites, docs[host_col].cast("string").eqNullSafe(F.col("_qh")) & docs[path_col].cast("string").eqNullSafe(F.col("_qp")), "left")
    at = math.log(keep_at / (1 - keep_at))

    @F.pandas_udf("double")
    def weigh(t: pd.Series) -> pd.Series:
        return pd.Series(evidence(model, t))

    return d.where(weigh(F.col(f"`{text_col}`")) + F.coalesce("_qprior", F.lit(0.0)) >= at).select(*[F.col(f"`{c}`") for c in docs.columns])
