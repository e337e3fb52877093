"""Quality rules by weak supervision.

Each rule looks at a few counts of the whole text and votes good (+), bad (-)
or abstains (0).  Expectation-maximisation over all documents that pass the
base rules estimates how accurate each rule is (how often it votes either way
on good and on bad texts), and a text is kept when its posterior probability
of being good reaches ``keep_at``.  Documents are counted by vote pattern
first (at most 3^rules of them), so the iterations see the counts only.  A
text that fails the base rules (under 50 words, or more than half of its words
in repeated three-word windows) is never kept.

Defined cases: a null text counts as empty (all counts 0, fails the base);
null ids and repeated rows are rows like others; without rows, no rows.
Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.llm.textstats import FIELDS, stats

COUNTS = FIELDS[:5]
#: (name, value from the counts, bad if beyond, good if within, words needed to vote)
RULES = (
    ("symbols", lambda s: s["n_symbols"] / s["n_words"], 0.10, 0.03, 1),
    ("symbol_density", lambda s: s["n_symbols"] / np.maximum(s["word_chars"], 1), 0.04, 0.005, 10),
    ("repeats", lambda s: s["n_repeat_words"] / s["n_words"], 0.30, 0.10, 10),
    ("dup_lines", lambda s: s["n_dup_lines"] / np.maximum(s["n_lines"], 1), 0.30, 0.10, 20),
    ("word_length", lambda s: np.abs(s["word_chars"] / s["n_words"] - 5.5), 4.0, 2.5, 1),
    ("brevity", lambda s: 1 / np.maximum(s["n_words"], 1), 1 / 20, 1 / 60, 0),
    ("vocabulary", lambda s: 1 - s["n_distinct"] / np.minimum(s["n_words"], 400), 0.75, 0.55, 40),
    ("letters", lambda s: 1 - s["n_letter_words"] / s["n_words"], 0.25, 0.08, 1),
    ("line_ends", lambda s: 1 - s["n_ended_lines"] / np.maximum(s["n_lines"], 1), 0.80, 0.50, 10),
)


def votes(s: pd.DataFrame) -> list[str]:
    """One of + - 0 per rule."""
    out = []
    for _, value, bad, good, least in RULES:
        with np.errstate(divide="ignore", invalid="ignore"):
            v = value(s).to_numpy(dtype=np.float64)
        may = (s["n_words"].to_numpy() >= least) & np.isfinite(v)
        out.append(np.where(may & (v > bad), "-", np.where(may & (v <= good), "+", "0")))
    return ["".join(x) for x in zip(*out, strict=True)]


def _counted(batches):
    for b in batches:
        s = pd.DataFrame([stats(t) for t in b["_text"]], columns=list(FIELDS))
        out = s[list(COUNTS)].astype("int64")
        out.insert(0, "_id", b["_id"].to_numpy())
        out["votes"] = votes(s)
        yield out


#: how often a rule votes - / abstains / votes +, on a bad and on a good text, before
#: any text is seen; it counts as much as ``STRENGTH`` of all documents
START = np.array([[0.30, 0.10, 0.60], [0.005, 0.095, 0.90]])
GOOD, STRENGTH = 0.85, 0.05


def expectation_maximisation(patterns: dict[str, int], rounds: int = 100) -> dict:
    """{vote pattern: documents} -> prior of a good text, votes (class x rule x
    (-, 0, +) probabilities; class 0 is bad), posterior of good by pattern."""
    names = sorted(patterns)
    prior, p = GOOD, np.repeat(START[:, None, :], len(RULES), axis=1)
    if not names:
        return {"prior": prior, "votes": p, "posterior": {}}
    seen = np.eye(3)[[["-0+".index(c) for c in x] for x in names]]
    n = np.array([patterns[x] for x in names], dtype=np.float64)
    weight = STRENGTH * n.sum()

    def posterior() -> np.ndarray:
        bad, good = np.einsum("prv,crv->cp", seen, np.log(p))
        return 1 / (1 + np.exp(np.clip(bad - good + np.log((1 - prior) / prior), -700, 700)))

    for _ in range(rounds):
        q = posterior()
        by_class = np.stack([n * (1 - q), n * q])
        p = (np.einsum("cp,prv->crv", by_class, seen) + weight * START[:, None, :]) / (by_class.sum(axis=1) + weight)[:, None, None]
        prior = float(np.clip((by_class[1].sum() + weight * GOOD) / (n.sum() + weight), 1e-6, 1 - 1e-6))
    return {"prior": prior, "votes": p, "posterior": dict(zip(names, posterior().tolist(), strict=True))}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """One row per document: id, the counts, base_failed, votes, quality (posterior), kept."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = dict(d.dtypes)["_id"]
    s = materialise(d.mapInPandas(_counted, f"_id {id_type}, " + ", ".join(f"{c} long" for c in COUNTS) + ", votes string"), "counts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # at most 3^9 = 19683 patterns
    fit = expectation_maximisation({r.votes: r.n for r in s.where(~failed).groupBy("votes").agg(F.count("*").alias("n")).collect()})
    post = spark.createDataFrame(list(fit["posterior"].items()), "votes string, quality double")
    s = s.join(F.broadcast(post), "votes", "left").withColumn("quality", F.when(failed, 0.0).otherwise(F.col("quality")))
    return s.select(F.col("_id").alias(id_col), *COUNTS, failed.alias("base_failed"), "votes", "quality",
                    (~failed & (F.col("quality") >= keep_at)).alias("kept"))
