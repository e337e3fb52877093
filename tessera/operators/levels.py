"""Linear and ridge models with a categorical of any number of levels.

Indicator columns make the Gram matrix as wide as there are levels.  A row has
one level only, so the levels' block of that matrix is diagonal, the rows of each
level.  Eliminating it leaves a system of the other features:

  S = sum(x x') - sum over levels of sx sx' / (n + alpha),  S beta = sum(x y) - sum over levels of sx sy / (n + alpha),

and a level's coefficient is (sy - sx beta) / (n + alpha).  Levels stay rows: no list of
them, and nothing of their number, reaches the driver or the plan.  As with indicator columns
(``models.cv_predictions``), each fold drops the first level of its training rows, the intercept
bears no penalty, and a level that the training rows lack, or NULL, is all zeros.
If the other features alone are collinear within the levels, the solution of least norm of S is taken.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import models as MD
from tessera.session import written

BROADCAST_ROWS = 200_000     # (level, fold) coefficients that are broadcast, at most; more are joined by a shuffle


def level_sums(df: DataFrame, level: str, features: list[str], target: str, fold_col: str = "fold") -> DataFrame:
    """(level, per fold n, sy and sx, totals): one row per level, with at most as many entries as folds."""
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    per = df.where(F.col(level).isNotNull()).groupBy(F.col(level).alias("level"), F.col(fold_col).cast("int").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("double")).alias("sy"), F.array(*[F.sum(c) for c in x]).alias("sx"))
    return per.groupBy("level").agg(
        F.collect_list(F.struct("fold", "n", "sy", "sx")).alias("own"), F.sum("n").alias("n"), F.sum("sy").alias("sy"),
        F.array(*[F.sum(F.col("sx")[i]) for i in range(len(x))]).alias("sx"))


def training_sums(sums: DataFrame, folds: list[int]) -> DataFrame:
    """(level, fold, n, sy, sx) over the rows outside of each fold, where there are any."""
    d = sums.select("*", F.explode(F.array(*map(F.lit, folds))).alias("fold"))
    d = d.withColumn("out", F.filter("own", lambda e: e["fold"] == F.col("fold")))
    left = F.size("out") > 0
    d = d.select("level", "fold", F.when(left, F.col("n") - F.col("out")[0]["n"]).otherwise(F.col("n")).alias("n"),
                 F.when(left, F.col("sy") - F.col("out")[0]["sy"]).otherwise(F.col("sy")).alias("sy"),
                 F.when(left, F.zip_with("sx", F.col("out")[0]["sx"], lambda a, b: a - b)).otherwise(F.col("sx")).alias("sx"))
    return d.where("n > 0")


def corrections(train: DataFrame, alphas: dict[str, float], d: int) -> dict[tuple[str, int], np.ndarray]:
    """(model, fold) -> sums over levels of sx sx' / (n + alpha) and sx sy / (n + alpha), flat."""

    def partial(batches):
        acc: dict = {}
        for b in batches:
            for f, at in b.groupby("fold").indices.items():
                sx, n, sy = np.array(b["sx"].iloc[at].tolist()), b["n"].to_numpy(float)[at], b["sy"].to_numpy()[at]
                for m, a in alphas.items():
                    w = sx / (n + a)[:, None]
                    acc[m, int(f)] = acc.get((m, int(f)), 0) + np.r_[(sx.T @ w).ravel(), w.T @ sy]
        yield pd.DataFrame([(m, f, v.tolist()) for (m, f), v in acc.items()], columns=["model", "fold", "v"])

    parts = train.select("fold", "n", "sy", "sx").mapInPandas(partial, "model string, fold int, v array<double>")
    got: dict = {}
    summed = parts.select("model", "fold", F.posexplode("v").alias("i", "x")).groupBy("model", "fold", "i").agg(F.sum("x").alias("x"))
    for r in summed.collect():      # models x folds x (d^2 + d) numbers, d the features besides the level
        got.setdefault((r.model, r.fold), np.zeros(d * d + d))[r.i] = r.x
    return got


def cv_level_predictions(df: DataFrame, features: list[str], level: str, target: str, models=("linear", "ridge"),
                         fold_col: str = "fold", alpha: float = MD.RIDGE_ALPHA) -> DataFrame:
    """Out-of-fold (model, fold, y, pred) of linear and ridge on ``features`` and the levels of ``level``."""
    stats = MD.fold_statistics(df, features, target, fold_col)
    folds, d = sorted(stats), len(features) + 1
    alphas = {m: alpha if m == "ridge" else 0.0 for m in models}
    train = written(training_sums(level_sums(df, level, features, target, fold_col), folds), "levels")
    first = {r.fold: r.level for r in train.groupBy("fold").agg(F.min("level").alias("level")).collect()}    # one row per fold
    dropped = F.lit(False)
    for f, lv in first.items():
        dropped = dropped | ((F.col("fold") == f) & (F.col("level") == F.lit(lv)))
    train = train.where(~dropped)
    fix = corrections(train, alphas, d)
    beta = {}
    for m, a in alphas.items():
        for f in folds:
            tr, v = MD._train_stats(stats, f), fix.get((m, f), np.zeros(d * d + d))
            beta[m, f] = MD.solve(tr["xx"] - v[: d * d].reshape(d, d), tr["xy"] - v[d * d:], a)

    def by_fold(fold, value):
        out = F.lit(None).cast("double")
        for f in folds:
            out = F.when(fold == f, value(f)).otherwise(out)
        return out

    def own(m, f):
        dot = sum((F.lit(float(b)) * F.col("sx")[i] for i, b in enumerate(beta[m, f])), F.lit(0.0))
        return (F.col("sy") - dot) / (F.col("n") + F.lit(alphas[m]))

    coefs = train.select(F.col("level").alias("__l"), F.col("fold").alias("__f"),
                         *[by_fold(F.col("fold"), lambda f, m=m: own(m, f)).alias(f"__{m}") for m in models])
    if coefs.count() <= BROADCAST_ROWS:
        coefs = F.broadcast(coefs)
    rows = df.select(F.col(fold_col).cast("int").alias(fold_col), F.col(target).cast("double").alias("y"), F.col(level).alias("__level"), *features)
    j = rows.join(coefs, (F.col("__level") == F.col("__l")) & (F.col(fold_col) == F.col("__f")), "left")
    each = [F.struct(F.lit(m).alias("model"), (by_fold(F.col(fold_col), lambda f, m=m: MD._predict(beta[m, f], features))
                                               + F.coalesce(F.col(f"__{m}"), F.lit(0.0))).alias("pred")) for m in models]
    return j.select(fold_col, "y", F.explode(F.array(*each)).alias("p")).select("p.model", fold_col, "y", "p.pred")
