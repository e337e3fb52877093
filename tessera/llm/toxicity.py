"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max
inverted indexes, distance-weighted votes, calibrated scores, evidence.

Terms are lower-case words and their first 4 and 5 letters.  The ``TERMS`` terms
that tell the labelled classes apart best (chi-square over the labelled
sample) span the vectors; weights are (1 + ln count) * ln((N + 1) / df) with document
frequencies over all documents.  The index holds at most ``SAMPLE`` labelled
examples of each class (least hashes of the id, crc32(id) mod 3 not 1), in
blocks of ``BLOCK``: a block whose bound, the sum of query weight times greatest
weight in the block, can't reach the k-th best similarity found is never scored, so the k
nearest are exact.  Votes weigh 1 / (1.05 - similarity); the vote is calibrated
by logistic regression on leave-one-out votes of the examples, weighted to the classes'
true shares.  A text that shares no term with any example gets the smoothed
rate of such examples.

Defined cases: a null text counts as empty; null ids are scored but never
training rows, and held_out is false for them; without labels of both classes
all scores are the share of label 1 (0 without labels); repeated rows are rows like others.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, text_key
from tessera.llm.quality_classifier import fit_logistic

SAMPLE = 4_000    # examples of each class, at most
TERMS = 512       # terms that span the vectors, at most
BLOCK = 64        # examples of a block of the index
K = 15
LEAST_CHI, LEAST_DF = 25.0, 5
WORD = re.compile(r"\w+")


def terms(text: str | None) -> dict[str, int]:
    """Term counts of a whole text; prefixes are marked by their length."""
    words: dict[str, int] = {}
    for w in WORD.findall((text or "").lower()):
        words[w] = words.get(w, 0) + 1
    out = dict(words)
    for w, n in words.items():
        for k in (4, 5):
            if len(w) > k:
                p = f"{k}:{w[:k]}"
                out[p] = out.get(p, 0) + n
    return out


def examples(labels: DataFrame, id_col: str, label_col: str, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """(at most 2 * sample rows (_lid, y), labelled rows by class)."""
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 3 != 1))
           .groupBy(F.col(id_col).alias("_lid")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y")))
    lab = materialise(lab, "labelled")
    n = {r.y: r.n for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = [lab.where(F.col("y") == y).orderBy(F.xxhash64("_lid"), "_lid").limit(sample) for y in (0, 1)]
    return materialise(pick[0].unionByName(pick[1]), "examples"), n


def choose_terms(texts: DataFrame, most: int = TERMS) -> list[str]:
    """(_text, y) -> the terms with the greatest chi-square."""

    def count(batches):
        for b in batches:
            n: dict[str, list[int]] = {}
            for t, y in zip(b["_text"], b["y"], strict=True):
                for w in terms(t):
                    n.setdefault(w, [0, 0])[y] += 1
            yield pd.DataFrame([(w, a, c, 0, 0) for w, (a, c) in n.items()] + [("", 0, 0, int((b["y"] == 0).sum()), int((b["y"] == 1).sum()))],
                               columns=["term", "a0", "a1", "n0", "n1"])

    c = materialise(texts.mapInPandas(count, "term string, a0 long, a1 long, n0 long, n1 long")
                    .groupBy("term").agg(*[F.sum(x).alias(x) for x in ("a0", "a1", "n0", "n1")]), "terms")
    n0, n1 = c.agg(F.sum("n0"), F.sum("n1")).first()
    if not n0 or not n1:
        return []
    a0, a1 = F.col("a0").cast("double"), F.col("a1").cast("double")
    n = float(n0 + n1)
    chi = n * (a1 * (n0 - a0) - a0 * (n1 - a1)) ** 2 / ((a0 + a1) * (n - a0 - a1) * n0 * float(n1))
    best = (c.where((F.col("term") != "") & (a0 + a1 >= LEAST_DF) & (a0 + a1 < n)).withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI)
            .orderBy(F.desc("chi"), "term").limit(most).collect())
    return [r.term for r in best]


def vectorise(vocabulary: list[str]):
    at = {w: i for i, w in enumerate(vocabulary)}

    def run(batches):
        for b in batches:
            idx, tf = [], []
            for t in b["_text"]:
                got = sorted((at[w], n) for w, n in terms(t).items() if w in at) if at else []
                idx.append([i for i, _ in got])
                tf.append([n for _, n in got])
            yield pd.DataFrame({"id": b["_id"], "idx": idx, "tf": tf})

    return run


def document_frequencies(vec: DataFrame, n: int) -> np.ndarray:
    """Texts that hold each of the ``n`` terms, summed inside each task first."""

    def count(batches):
        have = np.zeros(n, dtype=np.int64)
        for b in batches:
            flat = [np.asarray(x, dtype=np.int64) for x in b["idx"] if len(x)]
            if flat:
                have += np.bincount(np.concatenate(flat), minlength=n)
        at = np.flatnonzero(have)
        yield pd.DataFrame({"i": at, "n": have[at]})

    df = np.ones(max(1, n))
    for r in vec.select("idx").mapInPandas(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # at most n rows
        df[r.i] = r.n
    return df


class Index:
    """Block-max inverted index over unit TF-IDF vectors."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, block: int = BLOCK):
        """rows: (id, label, idx, tf), none with an empty vector."""
        self.idf, self.block = idf, block
        # like examples side by side make the blocks' bounds tight
        rows = sorted(rows, key=lambda r: (list(r[2]), r[0]))
        self.ids = [r[0] for r in rows]
        self.y = np.array([r[1] for r in rows], dtype=np.float64)
        self.blocks = -(-len(rows) // block)
        post: dict[int, list] = {}
        for n, (_, _, idx, tf) in enumerate(rows):
            for i, w in zip(idx, self.weights(idx, tf), strict=True):
                post.setdefault(int(i), []).append((n, w))
        self.post = {i: (np.array([n for n, _ in p]), np.array([w for _, w in p])) for i, p in post.items()}
        self.top = {}
        for i, (n, w) in self.post.items():
            m = np.zeros(self.blocks)
            np.maximum.at(m, n // block, w)
            self.top[i] = m

    def weights(self, idx, tf) -> np.ndarray:
        w = (1 + np.log(np.asarray(tf, dtype=np.float64))) * self.idf[np.asarray(idx, dtype=np.int64)]
        norm = np.sqrt(w @ w)
        return w / norm if norm else w

    def nearest(self, idx, tf, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, similarities) of the k most similar with similarity over 0; ties by place."""
        q = [(i, w) for i, w in zip(map(int, idx), self.weights(idx, tf), strict=True) if i in self.post]
        if not q:
            return np.empty(0, dtype=np.int64), np.empty(0)
        bound = sum(w * self.top[i] for i, w in q)
        score = np.zeros(len(self.ids))
        order = np.argsort(-bound, kind="stable")
        done, floor = 0, 0.0
        step = 4
        while done < self.blocks and bound[order[done]] > floor - 1e-12 and bound[order[done]] > 0:
            take = order[done: done + step]
            use = np.zeros(self.blocks, dtype=bool)
            use[take[(bound[take] > 0) & (bound[take] > floor - 1e-12)]] = True
            for i, w in q:
                n, v = self.post[i]
                pick = use[n // self.block]
                score[n[pick]] += w * v[pick]
            if skip >= 0:
                score[skip] = 0.0
            done += len(take)
            step *= 2
            floor = float(np.partition(score, -k)[-k]) if len(score) >= k else 0.0
        best = np.lexsort((np.arange(len(score)), -score))[:k]
        best = best[score[best] > 0]
        return best, np.minimum(score[best], 1.0)

    def vote(self, near: np.ndarray, sim: np.ndarray, prior: float) -> float:
        w = 1 / (1.05 - sim)
        return float((w @ self.y[near] + prior) / (w.sum() + 1))


def fit(index: Index | None, rows: list[tuple], n: dict[int, int], k: int) -> dict:
    """Calibration from leave-one-out votes; rows as for Index, empty vectors included."""
    total = sum(n.values())
    share = n.get(1, 0) / total if total else 0.0
    if index is None or not n.get(0) or not n.get(1):
        return {"prior": share, "none": share, "b": None}
    kept = {y: sum(r[1] == y for r in rows) for y in (0, 1)}
    weight = {y: n[y] / total / max(1, kept[y]) * len(rows) for y in (0, 1)}
    place = {i: p for p, i in enumerate(index.ids)}
    x, y, w, none = [], [], [], [2 * share, 2.0]
    for i, label, idx, tf in rows:
        near, sim = index.nearest(idx, tf, k, place[i]) if len(idx) else ((), ())
        if len(near):
            x.append(index.vote(near, sim, share))
            y.append(label)
            w.append(weight[label])
        else:
            none[0] += weight[label] * label
            none[1] += weight[label]
    model = {"prior": share, "none": none[0] / none[1], "b": None}
    return model | (fit_logistic(np.array(x)[:, None], np.array(y, dtype=np.float64), np.array(w), ridge=1e-4) if len(set(y)) == 2 else {})


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             threshold: float = 0.7, k: int = K, sample: int = SAMPLE, most_terms: int = TERMS) -> DataFrame:
    """One row per document: id, held_out, score, predicted, vote (before
    calibration, null without neighbours), evidence (ids of the 3 nearest examples)."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = dict(d.dtypes)["_id"]
    pick, n = examples(labels, id_col, label_col, sample)
    # at most 2 * sample rows; copies are one example, as they are no further evidence
    texts = d.join(F.broadcast(pick), F.col("_id") == F.col("_lid")).withColumn("_key", text_key(F.col("_text")))
    texts = materialise(texts.groupBy("_key").agg(F.min(F.struct("_lid", "y", "_text")).alias("e")).select("e.*"), "texts")
    vocabulary = choose_terms(texts.select("_text", "y"), most_terms)
    vec = materialise(d.mapInPandas(vectorise(vocabulary), f"id {id_type}, idx array<int>, tf array<int>"), "vectors")
    idf = np.log((vec.count() + 1) / document_frequencies(vec, len(vocabulary)))
    got = (vec.join(F.broadcast(texts.select("_lid", "y")), F.col("id") == F.col("_lid"))
           .groupBy("id").agg(F.first(F.struct("y", "idx", "tf")).alias("v")).collect())
    rows = [(r.id, r.v.y, r.v.idx, r.v.tf) for r in got]
    full = [r for r in rows if len(r[2])]
    index = Index(full, idf) if full else None
    model = fit(index, rows, n, k)
    shared = spark.sparkContext.broadcast((index, model))

    def run(batches):
        index, model = shared.value
        known: dict = {}
        for b in batches:
            out = []
            for idx, tf in zip(b["idx"], b["tf"], strict=True):
                key = (tuple(idx), tuple(tf))
                if key not in known:
                    if len(known) > 50_000:
                        known.clear()
                    near, sim = index.nearest(idx, tf, k) if index is not None and len(idx) else ((), ())
                    if len(near):
                        v = index.vote(near, sim, model["prior"])
                        s = v
                        if model["b"] is not None:
                            z = model["b"][0] + model["b"][1] * (v - model["mean"][0]) / model["sd"][0]
                            s = float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                        known[key] = (s, v, [index.ids[i] for i in near[:3]])
                    else:
                        known[key] = (model["none"], None, [])
                out.append(known[key])
            yield pd.DataFrame({"id": b["id"], "score": [o[0] for o in out], "vote": [o[1] for o in out], "evidence": [o[2] for o in out]})

    s = vec.mapInPandas(run, f"id {id_type}, score double, vote double, evidence array<{id_type}>")
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    return s.select(F.col("id").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "vote", "evidence")
