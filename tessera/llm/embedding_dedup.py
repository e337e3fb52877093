"""Embedding near-dedup with a forest of random-projection trees.

Each tree splits the unit vectors by random directions at medians; vectors
within ``spill`` of a split go to both sides.  The trees are grown from a
bounded sample (``SAMPLE`` vectors, least hashes of the id); every vector is
then sent down every tree.  Vectors are compared within leaves by exact
cosine in double precision; links found are united into groups, and in each
group all pairs are compared, in blocks, so that a link is counted once and a
group of any size is whole.

A leaf over ``node`` rows is not compared in one task.  Angles are a metric:
every partner of a vector within the link angle of a pivot lies within twice
that angle of the pivot, so such vectors are tied to the pivot and leave the
leaf, and the others are split again by directions drawn for that leaf, until
no leaf is too large.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length never link; equal
vectors are compared once and counted each; a null id never names a component
unless all its ids are null (the row is then kept).  Other columns are not
read.  No rows give no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, sorted_groups
from tessera.llm.graph import block_pairs, connected_components, forest

SAMPLE = 16_384    # vectors the trees are grown from, at most
LEAF = 512         # rows aimed at in a leaf
NODE = 8192        # rows compared in one task, at most
BLOCK = 512
TREES = 6
SPILL = 0.3        # of the link distance's deviation along a direction, to either side
PIVOTS = 8


def _valid(v) -> np.ndarray | None:
    """Unit vector in double precision, or None if it can't link."""
    if v is None or not len(v):
        return None
    x = np.array([math.nan if c is None else c for c in v], dtype=np.float64)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / math.sqrt(float(x @ x))


def _units(batches):
    for b in batches:
        keys, vecs = [], []
        for v in b["_vec"]:
            u = _valid(v)
            vecs.append(None if u is None else u.tobytes())
            keys.append(None if u is None else hashlib.md5(np.array(v, dtype=np.float64).tobytes()).digest())
        yield pd.DataFrame({"id": b["_id"], "key": keys, "u": vecs})


def _rows(col) -> np.ndarray:
    return np.frombuffer(b"".join(col), dtype=np.float64).reshape(len(col), -1)


def _direction(seed: list[int], dim: int) -> np.ndarray:
    d = np.random.default_rng(seed).standard_normal(dim)
    return d / np.linalg.norm(d)


def grow(sample: np.ndarray, tree: int, depth: int, width: float) -> list:
    """[(direction, median, left, right)] by node, children -1 for a leaf."""
    nodes: list = []

    def build(rows: np.ndarray, level: int) -> int:
        if level == depth or len(rows) < 16:
            return -1
        me = len(nodes)
        nodes.append(None)
        d = _direction([tree, me], sample.shape[1])
        p = sample[rows] @ d
        t = float(np.median(p))
        left, right = build(rows[p <= t + width], level + 1), build(rows[p >= t - width], level + 1)
        nodes[me] = (d, t, left, right)
        return me

    build(np.arange(len(sample)), 0)
    return nodes


def descend(nodes: list, x: np.ndarray, width: float) -> list[tuple[int, np.ndarray]]:
    """(leaf number, rows) for all rows of ``x``, spilled rows in several leaves."""
    out, todo = [], [(0 if nodes else -1, 0, np.arange(len(x)))]
    while todo:
        node, leaf, rows = todo.pop()
        if not len(rows):
            continue
        if node < 0:
            out.append((leaf, rows))
            continue
        d, t, left, right = nodes[node]
        p = x[rows] @ d
        todo += [(left, 2 * node + 1, rows[p <= t + width]), (right, 2 * node + 2, rows[p >= t - width])]
    return out


def _compare(threshold: float, chunk: int = 1024):
    """Spanning edges of the links inside each leaf."""

    def run(b: pd.DataFrame, starts: np.ndarray):
        key = b["key"].to_numpy(dtype=object)
        aa, bb = [], []
        for lo, hi in zip(starts, np.r_[starts[1:], len(b)], strict=True):
            if hi - lo > 1:
                m = _rows(b["u"].iloc[lo:hi].tolist())
                for c in range(0, len(m), chunk):
                    i, j = np.nonzero(m[c: c + chunk] @ m.T >= threshold)
                    use = i + c < j
                    aa.append(i[use] + c + lo)
                    bb.append(j[use] + lo)
        if aa:
            lab = forest(len(b), np.concatenate(aa), np.concatenate(bb))
            move = np.flatnonzero(lab != np.arange(len(b)))
            if len(move):
                yield pd.DataFrame({"a": key[move], "b": key[lab[move]]})

    return run


def _deal(threshold: float, width: float, planes: int = 3):
    """Rows of leaves too large for a task: ties to pivots, and the rest sent
    to the cells of ``planes`` more spilled directions through the medians of
    the leaf's pivots."""
    tie_at = 2 * threshold * threshold - 1

    def run(batches):
        for b in batches:
            for leaf, g in b.groupby("leaf", sort=False):
                m, key = _rows(g["u"].tolist()), g["key"].to_numpy(dtype=object)
                pk = [p["key"] for p in g["pivots"].iloc[0]]
                pv = _rows([p["u"] for p in g["pivots"].iloc[0]])
                s = m @ pv.T
                for p in range(len(pk)):
                    x = key[s[:, p] >= tie_at - 1e-9]
                    yield pd.DataFrame({"a": x, "b": [pk[p]] * len(x), "leaf": None, "u": None}).astype({"leaf": "Int64"})
                rest = np.flatnonzero((s < threshold).all(axis=1))
                if not len(rest):
                    continue
                cells = [(int(leaf) & (2**62 - 1), rest)]
                for k in range(planes):
                    d = _direction([int(leaf) & (2**62 - 1), k], m.shape[1])
                    t = float(np.median(pv @ d))
                    nxt = []
                    for name, rows in cells:
                        p = m[rows] @ d
                        nxt += [(name * 2 + 1, rows[p <= t + width]), (name * 2 + 2, rows[p > t - width])]
                    cells = nxt
                for name, rows in cells:
                    if len(rows):
                        at = int(hashlib.md5(f"{leaf}/{name}".encode()).hexdigest()[:15], 16)
                        yield pd.DataFrame({"a": key[rows], "b": None, "leaf": pd.array([at] * len(rows), dtype="Int64"), "u": g["u"].to_numpy(dtype=object)[rows]})

    return run


def _verify(threshold: float):
    def run(b: pd.DataFrame, starts: np.ndarray):
        key, blk = b["key"].to_numpy(dtype=object), b["_b"].to_numpy()
        mult = b["copies"].to_numpy().astype(np.float64)
        first, second = b["_i"].to_numpy(), b["_j"].to_numpy()
        ea, eb, who, links = [], [], [], []
        for lo, hi in zip(starts, np.r_[starts[1:], len(b)], strict=True):
            m = _rows(b["u"].iloc[lo:hi].tolist())
            ok = m @ m.T >= threshold
            np.fill_diagonal(ok, False)
            if first[lo] != second[lo]:
                ok &= blk[lo:hi, None] != blk[None, lo:hi]
            lab = forest(hi - lo, *np.nonzero(np.triu(ok)))
            move = np.flatnonzero(lab != np.arange(hi - lo))
            ea += list(key[lo + move])
            eb += list(key[lo + lab[move]])
            cnt = ok @ mult[lo:hi]
            hit = np.flatnonzero(cnt)
            who += list(key[lo + hit])
            links += list(cnt[hit].astype(np.int64))
        if who:
            yield pd.DataFrame({"a": ea + who, "b": eb + [None] * len(who), "links": [0] * len(ea) + links})

    return run


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
                         trees: int = TREES, leaf: int = LEAF, node: int = NODE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id``, ``kept``."""
    v = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_vec"))
    id_type = dict(v.dtypes)["_id"]
    s = materialise(v.mapInPandas(_units, f"id {id_type}, key binary, u binary"), "units")
    classes = materialise(s.where("key IS NOT NULL").groupBy("key")
                          .agg(F.count("*").alias("copies"), F.min("id").alias("rep"), F.first("u").alias("u")), "classes")
    total = classes.count()
    sample = classes.orderBy(F.xxhash64("key")).limit(SAMPLE).select("u").collect()
    by_dim: dict[int, list[bytes]] = {}
    for (u,) in sample:
        by_dim.setdefault(len(u), []).append(bytes(u))
    depth = max(0, math.ceil(math.log2(max(1, total) / leaf)))
    gap = math.sqrt(2 - 2 * threshold)  # distance of unit vectors at the threshold
    plan = {}
    for size, us in by_dim.items():
        width = SPILL * gap / math.sqrt(size / 8)
        x = _rows(us)
        plan[size] = (width, [grow(x, t, depth, width) for t in range(trees)])

    def send(batches):
        for b in batches:
            u, key = b["u"].to_numpy(dtype=object), b["key"].to_numpy(dtype=object)
            lens = np.array([len(x) for x in u])
            for size in np.unique(lens):
                rows = np.flatnonzero(lens == size)
                x = _rows(u[rows].tolist())
                width, forest_ = plan.get(int(size), (0.0, [[]]))
                for t, nodes in enumerate(forest_):
                    for number, sub in descend(nodes, x, width):
                        yield pd.DataFrame({"leaf": (t * 100_003 + int(size)) * 2**32 + number, "key": key[rows[sub]], "u": u[rows[sub]]})

    leaves = materialise(classes.select("key", "u").mapInPandas(send, "leaf long, key binary, u binary"), "leaves")
    n = leaves.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
    rows = leaves.join(n, "leaf")
    parts, dim_width = [], {k: w for k, (w, _) in plan.items()}
    while True:
        small, large = rows.where(F.col("n") <= node), rows.where(F.col("n") > node)
        parts.append(materialise(sorted_groups(small.select("leaf", "key", "u"), ["leaf"], _compare(threshold), "a binary, b binary"), "edges"))
        if large.isEmpty():
            break
        pivots = (large.groupBy("leaf", F.pmod(F.xxhash64("key", "leaf"), F.lit(PIVOTS)).alias("_s"))
                  .agg(F.min(F.struct("key", "u")).alias("p")).groupBy("leaf").agg(F.collect_list("p").alias("pivots")))
        dealt = materialise(large.select("leaf", "key", "u").join(pivots, "leaf")
                            .mapInPandas(_deal(threshold, min(dim_width.values(), default=0.0)), "a binary, b binary, leaf long, u binary"), "dealt")
        parts.append(dealt.where("b IS NOT NULL AND a <> b").select("a", "b"))
        sub = dealt.where("b IS NULL").select("leaf", F.col("a").alias("key"), "u")
        rows = materialise(sub.join(sub.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1"), "leaf"), "leaves")
    edges = parts[0]
    for p in parts[1:]:
        edges = edges.unionByName(p)
    groups = connected_components(edges)
    member = materialise(groups.join(classes, groups.v == F.col("key")).select("comp", "key", "copies", "u"), "groups")
    found = materialise(sorted_groups(block_pairs(member, "comp", "key", block), ["comp", "_i", "_j"], _verify(threshold),
                                      "a binary, b binary, links long"), "links")
    near = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    c = materialise(classes.select("key", "copies", "rep").join(comp, F.col("key") == comp.v, "left")
                    .join(near, F.col("key") == near.a, "left")
                    .select("key", "copies", "rep", F.coalesce("comp", "key").alias("comp"),
                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classed")
    ids = c.groupBy("comp").agg(F.min("rep").alias("component_id"))
    per = c.join(ids, "comp").select(F.col("key").alias("k"), "component_id", "n_links")
    cid = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return (s.select("id", "key").join(per, F.col("key") == F.col("k"), "left")
            .select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), cid.alias("component_id"),
                    F.coalesce(F.col("id") == cid, cid.isNull()).alias("kept")))
