"""N-gram Jaccard join by chosen paths.

Every text becomes the set of its n-word windows, embedded as ``T`` minhash
values.  In each run a text picks shared random coordinates (the same for all
texts) and goes to one node per pick, named by (coordinate, value): two texts
of similarity J share a node with probability J per pick, and 1/threshold
picks are expected, so linked texts stay together while others part.  A node of
few texts is compared by brute force on the minhash values; a larger node is
split again by coordinates drawn for that node, 1/threshold expected.  The whole
is repeated until the target recall (``runs``: from the branching process at the
threshold); a node that several runs reach is worked on once.

Candidate groups are verified exactly: all pairs of a group, in blocks, by the
Jaccard similarity of their window sets.

A node that does not part (a mass of near copies) would be split forever, so
pivots are taken from it first: the Jaccard distance is a metric, so every
partner of a text within 0.2 of a pivot lies within 0.4 of that pivot; the
text is tied to it and leaves, its partners are tied too and go on.

Defined cases: a null text counts as empty; a text without words links with
nothing but its exact copies; a text of fewer than n words is one window; rows of
equal text are one class, whatever their ids; a null id is kept as it is and
is never a class id unless all ids of the class are null.  Columns other than
id and text are not read.  No rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, sorted_groups, text_key_bytes
from tessera.llm.graph import block_pairs, connected_components, forest
from tessera.llm.shingles import mix, shingles

T = 64                 # minhash values of a text
LEAF = 256             # a node of at most so many texts is compared by brute force
NODE = 8192            # a node of at most so many texts is split inside one task
BLOCK = 256            # rows of a block when a candidate group is verified
MARGIN = 0.18          # candidates may fall short of the threshold by so much: > 3 deviations of T values
PIVOTS = 8


def runs_for(recall: float, threshold: float, depth: int = 3) -> int:
    """Runs until a pair at the threshold meets in a leaf with probability
    ``recall``, if leaves lie ``depth`` splits deep."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)  # picks are Poisson(1/threshold), each survived with the threshold
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240501)
    return r.integers(1, 2**63, T, dtype=np.uint64) | np.uint64(1), r.integers(0, 2**63, T, dtype=np.uint64)


def picks(node: int, run: int, threshold: float) -> np.ndarray:
    """The coordinates that all texts of a node use in a run."""
    r = np.random.default_rng([node & (2**63 - 1), run])
    return np.flatnonzero(r.random(T) < 1 / (threshold * T))


def _child(node, coord: int, value: np.ndarray) -> np.ndarray:
    """Name of the node reached over (coordinate, value)."""
    x = np.uint64(node & (2**64 - 1)) ^ np.uint64((coord + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    return mix(mix(value.astype(np.uint64) + np.uint64(1)) ^ x).view(np.int64)


def minhash(sets: list[np.ndarray]) -> np.ndarray:
    """len(sets) x T uint32; sets must not be empty."""
    a, b = _seeds()
    flat = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), T), dtype=np.uint32)
    for i in range(T):
        out[:, i] = np.minimum.reduceat((flat * a[i] + b[i]) >> np.uint64(32), at)
    return out


def _sketches(n: int, threshold: float, runs: int):
    coords = sorted({int(c) for r in range(runs) for c in picks(0, r, threshold)})

    def run(batches):
        for b in batches:
            keys = [text_key_bytes(t) for t in b["_text"]]
            first = {}
            for i, k in enumerate(keys):
                first.setdefault(k, i)
            sets = {k: shingles(b["_text"].iloc[i], n) for k, i in first.items()}
            some = [k for k in sets if len(sets[k])]
            sk, l1 = {}, {}
            for lo in range(0, len(some), 200):
                part = some[lo: lo + 200]
                m = minhash([sets[k] for k in part])
                nodes = np.stack([_child(0, c, m[:, c]) for c in coords], axis=1) if coords else np.zeros((len(part), 0), np.int64)
                for k, row, nd in zip(part, m, nodes, strict=True):
                    sk[k], l1[k] = row.tobytes(), nd
            yield pd.DataFrame({"id": b["_id"], "key": keys, "sk": [sk.get(k) for k in keys], "nodes": [l1.get(k) for k in keys]})

    return run


def _star(members: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
    """Edges (member, least member of its group) of a spanning forest."""
    lab = forest(len(members), a, b)
    move = np.flatnonzero(lab != np.arange(len(members)))
    return list(members[move]), list(members[lab[move]])


def _near(m: np.ndarray, starts: np.ndarray, need: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs inside groups (row ranges from ``starts``) agreeing in >= need coordinates."""
    gid = np.zeros(len(m), dtype=np.int64)
    gid[starts[1:]] = 1
    gid = np.cumsum(gid)
    aa, bb = [], []
    d = 1
    while d < len(m):
        i = np.flatnonzero(gid[d:] == gid[:-d])
        if not len(i):
            break
        for lo in range(0, len(i), 20_000):
            j = i[lo: lo + 20_000]
            hit = j[(m[j] == m[j + d]).sum(axis=1) >= need]
            aa.append(hit)
            bb.append(hit + d)
        d += 1
    z = np.empty(0, dtype=np.int64)
    return (np.concatenate(aa), np.concatenate(bb)) if aa else (z, z)


def _against(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Share of agreeing coordinates, rows x pivots."""
    return np.stack([(m == p).mean(axis=1) for p in pivots], axis=1)


def _split(node: int, m: np.ndarray, idx: np.ndarray, threshold: float, leaf: int, out: list) -> list[np.ndarray]:
    """Recursion inside one task over rows ``idx`` of ``m``: appends (a, b) index
    arrays of ties to pivots, returns the leaves."""
    todo, leaves = [(node, idx)], []
    while todo:
        node, idx = todo.pop()
        if len(idx) <= leaf:
            leaves.append(idx)
            continue
        r = np.random.default_rng(node & (2**63 - 1))
        pv = r.choice(len(idx), min(PIVOTS, len(idx)), replace=False)
        s = _against(m[idx], m[idx[pv]])
        tie = s >= 2 * threshold - 1 - MARGIN
        for p in range(len(pv)):
            x = idx[tie[:, p]]
            out.append((x, np.full(len(x), idx[pv[p]])))
        rest = idx[(s < threshold).all(axis=1)]
        for c in picks(node, 0, threshold) if len(rest) else ():
            v = _child(node, int(c), m[rest, c])
            order = np.argsort(v, kind="stable")
            v, sub = v[order], rest[order]
            at = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
            for lo, hi in zip(at, np.r_[at[1:], len(v)], strict=True):
                if hi - lo > 1:
                    todo.append((int(v[lo]), sub[lo:hi]))
    return leaves


def _leaves(threshold: float, leaf: int):
    def run(b: pd.DataFrame, starts: np.ndarray):
        m = np.frombuffer(b"".join(b["sk"]), dtype=np.uint32).reshape(len(b), T)
        member = b["key"].to_numpy(dtype=object)
        ends = np.r_[starts[1:], len(b)]
        big = np.flatnonzero(ends - starts > leaf)
        aa, bb = [], []
        groups = []
        keep = np.ones(len(b), dtype=bool)
        for g in big:
            out: list = []
            keep[starts[g]: ends[g]] = False
            groups += _split(int(b["node"].iloc[starts[g]]), m, np.arange(starts[g], ends[g]), threshold, leaf, out)
            aa += [x for x, _ in out]
            bb += [y for _, y in out]
        # all leaves one after another
        rows = np.concatenate([np.flatnonzero(keep), *groups]).astype(np.int64)
        gid = np.concatenate([np.repeat(np.arange(len(starts)), ends - starts)[keep], *[np.full(len(x), len(starts) + i) for i, x in enumerate(groups)]])
        heads = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]]) if len(rows) else np.empty(0, dtype=np.int64)
        for k in range(0, len(heads), 2000):
            lo, hi = heads[k], heads[k + 2000] if k + 2000 < len(heads) else len(rows)
            at = np.flatnonzero(np.r_[True, gid[lo + 1: hi] != gid[lo: hi - 1]])
            a, c = _near(m[rows[lo:hi]], at, (threshold - MARGIN) * T)
            aa.append(rows[lo:hi][a])
            bb.append(rows[lo:hi][c])
        if aa:
            x, y = _star(member, np.concatenate(aa), np.concatenate(bb))
            if x:
                yield pd.DataFrame({"a": x, "b": y})

    return run


def _deal(threshold: float):
    """Rows (node, key, sk, pivots) of nodes too large for a task: ties to the
    pivots (edge rows) and children of the texts that are near none."""

    def run(batches):
        for b in batches:
            for node, g in b.groupby("node", sort=False):
                m = np.frombuffer(b"".join(g["sk"]), dtype=np.uint32).reshape(len(g), T)
                pk = [p["key"] for p in g["pivots"].iloc[0]]
                s = _against(m, np.stack([np.frombuffer(p["sk"], dtype=np.uint32) for p in g["pivots"].iloc[0]]))
                key = g["key"].to_numpy(dtype=object)
                for p in range(len(pk)):
                    x = key[s[:, p] >= 2 * threshold - 1 - MARGIN]
                    if len(x):
                        yield pd.DataFrame({"a": x, "b": [pk[p]] * len(x), "node": None, "sk": None}).astype({"node": "Int64"})
                rest = (s < threshold).all(axis=1)
                for c in picks(int(node), 0, threshold) if rest.any() else ():
                    yield pd.DataFrame({"a": key[rest], "b": None, "node": pd.array(_child(int(node), int(c), m[rest, c]), dtype="Int64"), "sk": g["sk"].to_numpy(dtype=object)[rest]})

    return run


def candidates(classes: DataFrame, threshold: float, leaf: int, node: int) -> DataFrame:
    """(key, sk, nodes) -> spanning edges (a, b) of the candidate groups."""
    light = classes.select("key", F.explode("nodes").alias("node"))
    full = light.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
    rows = light.join(full, "node").join(classes.select("key", "sk"), "key")
    rows = materialise(rows.select("node", "key", "sk", "n"), "nodes")
    spec = "a binary, b binary"
    edges = sorted_groups(rows.where(F.col("n") <= node).select("node", "key", "sk"), ["node"], _leaves(threshold, leaf), spec)
    large = rows.where(F.col("n") > node)
    parts = [materialise(edges, "edges")]
    while not large.isEmpty():
        pivots = (large.groupBy("node", F.pmod(F.xxhash64("key", "node"), F.lit(PIVOTS)).alias("_s"))
                  .agg(F.min(F.struct("key", "sk")).alias("p")).groupBy("node").agg(F.collect_list("p").alias("pivots")))
        dealt = materialise(large.select("node", "key", "sk").join(pivots, "node")
                            .mapInPandas(_deal(threshold), "a binary, b binary, node long, sk binary"), "dealt")
        parts.append(dealt.where("b IS NOT NULL").select("a", "b"))
        sub = dealt.where("b IS NULL").select("node", F.col("a").alias("key"), "sk")
        rows = materialise(sub.join(sub.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "node"), "nodes")
        parts.append(materialise(sorted_groups(rows.where(F.col("n") <= node).select("node", "key", "sk"), ["node"],
                                               _leaves(threshold, leaf), spec), "edges"))
        large = rows.where(F.col("n") > node)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _verify(n: int, threshold: float):
    from tessera.llm.shingles import jaccard_links

    def run(b: pd.DataFrame, starts: np.ndarray):
        out_a, out_b, links, who = [], [], [], []
        for lo, hi in zip(starts, np.r_[starts[1:], len(b)], strict=True):
            if hi - lo < 2:
                continue
            g = b.iloc[lo:hi]
            key, blk, m = g["key"].to_numpy(dtype=object), g["_b"].to_numpy(), g["copies"].to_numpy()
            ok = jaccard_links([shingles(t, n) for t in g["_text"]], threshold)
            if g["_i"].iloc[0] != g["_j"].iloc[0]:  # pairs inside a block are counted where both are that block
                ok &= blk[:, None] != blk[None, :]
            x, y = np.nonzero(np.triu(ok))
            a, c = _star(key, x, y)
            out_a += a
            out_b += c
            cnt = ok @ m.astype(np.float64)
            hit = np.flatnonzero(cnt)
            who += list(key[hit])
            links += list(cnt[hit].astype(np.int64))
        if who:
            yield pd.DataFrame({"a": out_a + who, "b": out_b + [None] * len(who), "links": [0] * len(out_a) + links})

    return run


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8,
                       recall: float = 0.995, leaf: int = LEAF, node: int = NODE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: id, ``text_key``, ``class_id`` (least id of
    its group of linked texts), ``n_links`` (other rows whose text is equal to or links with
    its text directly) and ``class_size`` (rows of the group)."""
    runs = runs_for(recall, threshold)
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = dict(d.dtypes)["_id"]
    s = materialise(d.mapInPandas(_sketches(n, threshold, runs), f"id {id_type}, key binary, sk binary, nodes array<bigint>"), "sketch")
    classes = materialise(s.groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("rep"),
                                               F.first("sk").alias("sk"), F.first("nodes").alias("nodes")), "classes")
    edges = candidates(classes.where("sk IS NOT NULL").select("key", "sk", "nodes"), threshold, leaf, node)
    groups = connected_components(edges)
    member = groups.join(classes.select("key", "copies", "rep"), groups.v == F.col("key")).select("comp", "key", "copies", "rep")
    d = d.withColumn("_k", F.unhex(F.md5(F.coalesce("_text", F.lit("")))))
    texts = d.join(member, (F.col("_k") == F.col("key")) & F.col("_id").eqNullSafe(F.col("rep"))).select("comp", "key", "copies", "_text")
    texts = materialise(texts.dropDuplicates(["key"]), "texts")
    pairs = block_pairs(texts, "comp", "key", block)
    found = materialise(sorted_groups(pairs, ["comp", "_i", "_j"], _verify(n, threshold), "a binary, b binary, links long"), "links")
    near = found.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    c = (classes.select("key", "copies", "rep").join(comp, F.col("key") == comp.v, "left")
         .join(near, F.col("key") == near.a, "left")
         .select("key", "copies", "rep", F.coalesce("comp", "key").alias("comp"), F.coalesce("links", F.lit(0)).alias("links")))
    c = materialise(c, "classed")
    ids = c.groupBy("comp").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    per = c.join(ids, "comp").select("key", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return s.select("id", "key").join(per, "key").select(F.col("id").alias(id_col), F.col("key").alias("text_key"), "class_id", "n_links", "class_size")
