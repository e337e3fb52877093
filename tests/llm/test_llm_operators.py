"""The training-data operators against plain versions on small tables, with
nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex

import corpus_pipeline
from tessera.llm import license_scan, line_dedup, mixing
from tessera.llm.embedding_dedup import embedding_near_dedup
from tessera.llm.graph import connected_components
from tessera.llm.line_dedup import dedup_lines, edit_distance, line_lists, line_table, normalise, similar
from tessera.llm.ngram_join import ngram_jaccard_join
from tessera.llm.packing import hilbert, pack
from tessera.llm.pii import digest, pii_spans, sanitise
from tessera.llm.quality_classifier import keep_good, quality_classifier, train
from tessera.llm.quality_rules import quality_rules
from tessera.llm.shingles import words
from tessera.llm.toxicity import toxicity

DIR = "/root/testdata/sf0.001"
ODD = [(-1, None), (-2, ""), (-3, " \n\t"), (None, "a null id"), (None, None), (-4, "x" * 20000), (-5, "long " * 8000),
       (-6, "same row twice, with enough words to count"), (-6, "same row twice, with enough words to count"), (-7, "a b \U0001F600 <|endoftext|> end")]


@pytest.fixture(scope="module")
def docs(spark):
    """sf0.001 and the odd rows, with extra columns whose names clash with inner ones."""
    given = spark.read.parquet(f"{DIR}/documents.parquet")
    extra = [(i, t, "xx", None, None) for i, t in ODD]
    d = given.unionByName(spark.createDataFrame(extra, given.schema))
    return d.selectExpr("*", "1 AS id", "'k' AS key", "2 AS comp", "3 AS node", "4 AS _id", "'t' AS _text", "5 AS size", "6 AS path", "7 AS copies", "8 AS v", "9 AS a").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DIR}/labels.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def sort(xs):
    return sorted(xs, key=repr)


def windows(t, n=5):
    w = words(t)
    return {tuple(w[i: i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(n, links):
    lab = list(range(n))
    for a, b in links:
        x, y = lab[a], lab[b]
        if x != y:
            lab = [min(x, y) if v in (x, y) else v for v in lab]
    return lab


def least(xs):
    return min((x for x in xs if x is not None), default=None)


def jaccard_classes(rows):
    sets = [windows(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] or "") == (rows[j][1] or "") or (
        sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
    lab = components(len(rows), links)
    n = [0] * len(rows)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return [(rows[i][0], least(rows[j][0] for j in range(len(rows)) if lab[j] == lab[i]), n[i]) for i in range(len(rows))]


@pytest.mark.parametrize("params", [{}, {"leaf": 4, "node": 16, "block": 4}])
def test_ngram_join_equals_all_pairs(docs, rows, params):
    got = ngram_jaccard_join(docs, **params).select("doc_id", "class_id", "n_links").collect()
    assert sort(map(tuple, got)) == sort(jaccard_classes(rows))


def test_ngram_join_of_a_large_group_of_near_copies(spark):
    r = random.Random(1)
    base = [r.choice("abcdefgh") * r.randint(1, 6) + str(i) for i in range(120)]
    texts = []
    for _ in range(60):
        t = base[:]
        t[r.randrange(120)] = f"other{r.random()}"
        texts.append(" ".join(t))
    rows = list(enumerate(texts)) + [(99, texts[0])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_jaccard_join(d, leaf=8, node=16, block=8).select("doc_id", "class_id", "n_links").collect()
    assert sort(map(tuple, got)) == sort(jaccard_classes(rows))


def test_lines_equal_a_plain_version(docs, rows):
    ids = [i for i, t in rows if t is not None]
    single = [(i, t) for i, t in rows if i is not None and ids.count(i) == 1 and t is not None]
    d = docs.where("doc_id IS NOT NULL AND doc_id <> -6")
    occ = [(i, n, " ".join(normalise(x))) for i, t in sorted(single) for n, x in enumerate(t.split("\n")) if normalise(x)]
    names = list(dict.fromkeys(o[2] for o in occ))
    # all pairs by edit similarity alone; those whose letters differ by more than the edits allowed need no distance
    bags = np.array([np.bincount(np.frombuffer(x.encode("utf-32-le"), dtype=np.uint32) % 251, minlength=251) for x in names])
    links = []
    for i in range(len(names)):
        more = bags[:i] - bags[i]
        least = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
        longer = np.maximum(bags[:i].sum(axis=1), len(names[i]))
        links += [(i, int(j)) for j in np.flatnonzero(least <= 0.1 * longer + 1e-9) if similar(names[i], names[j], 0.9)]
    assert len(links) > 20
    group = dict(zip(names, components(len(names), links), strict=True))
    seen, want = set(), {}
    for i, n, x in occ:
        if group[x] in seen:
            want.setdefault(i, []).append(n)
        seen.add(group[x])
    for params in ({}, {"node": 3, "block": 4}):
        got = {r.doc_id: [int(x) for x in r.removed.split(",")] for r in line_lists(d, **params).collect() if r.n_removed}
        assert got == want
    left = {r.doc_id: r.text for r in dedup_lines(d).collect()}
    for i, t in single:
        keep = [x for n, x in enumerate(t.split("\n")) if n not in want.get(i, [])]
        assert left.get(i) == ("\n".join(keep) if keep else None)


def test_lines_equal_all_pairs_by_edit_similarity(spark):
    """Against all pairs by edit similarity alone, from one changed word in short lines to lines of 120 words."""
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(400)]
    lines = []
    for n in (5, 6, 8, 10, 14, 20, 30, 60, 120):
        for _ in range(12):
            base = [r.choice(vocabulary) for _ in range(n)]
            changed, dropped = base[:], base[:]
            changed[r.randrange(n)] = r.choice(vocabulary)
            del dropped[r.randrange(n)]
            typed = list(" ".join(base))
            for _ in range(max(1, len(typed) // 30)):
                typed[r.randrange(len(typed))] = r.choice("abcdefghij")
            lines += [" ".join(base), " ".join(changed), " ".join(dropped), "".join(typed)]
    r.shuffle(lines)
    names = list(dict.fromkeys(" ".join(normalise(x)) for x in lines if len(normalise(x)) >= 5))
    sim = line_table(names, 1)[3]
    links = [(i, j) for i in range(len(names)) for j in range(i) if similar(names[i], names[j], 0.9)]
    assert sum(int(sim[i] ^ sim[j]).bit_count() > 3 for i, j in links) > 100
    group = components(len(names), links)
    want = {i for i in range(len(names)) if group[i] != i}
    d = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    assert {x.doc_id for x in line_lists(d).collect() if x.emptied} == want


def test_exact_repeats_of_short_lines(spark):
    rows = [(1, "All rights reserved\nfirst\n\n--\n这是一个很长的没有空格的句子"), (2, "ALL rights  reserved!\nsecond\n\n--\n这是一个很长的没有空格的句子"), (3, "all right reserved\nfirst"), (4, "First")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.removed, x.emptied) for x in line_lists(d).collect()}
    assert got == {1: ("", False), 2: ("0,4", False), 3: ("0,1", True), 4: ("0", True)}


def test_near_lines_of_any_script_and_few_words(spark):
    rows = [(1, "Contact our support team\n这是一个没有空格的很长的句子它在这里有超过三十个字符可以用来比较两行文字\nab cd"), (2, "Contact our support teams\n这是一个没有空格的很长的句子它在那里有超过三十个字符可以用来比较两行文字\nab ce")]
    got = {x.doc_id: x.removed for x in line_lists(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "0,1"}


def test_lines_of_one_template_are_not_compared_in_all_pairs(spark, monkeypatch):
    """Lines that share most of their words, and so their bands, but have too many other letters to link."""
    template = "the quick brown fox jumps over the lazy dog near the old mill by the river"
    rows = [(i, f"{template} {c * 10} {c * 11} {c * 9}") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    compared, plain = [], line_dedup._similar_pairs

    def counted(texts, pairs, similarity):
        compared.append(pairs.count())
        return plain(texts, pairs, similarity)

    monkeypatch.setattr(line_dedup, "_similar_pairs", counted)
    got = line_lists(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert not any(x.n_removed for x in got)
    assert compared[0] > 10 and compared[1] < len(rows)


def test_counts_of_characters_rule_out_no_similar_pair():
    r = random.Random(5)
    some = []
    for _ in range(400):
        a = [r.choice("abcdefgh é这\U0001F600") for _ in range(r.choice((10, 40, 150, 4000)))]
        b = a[:]
        for _ in range(r.randint(0, len(a) // 10)):
            k = r.randrange(len(b))
            b[k: k + r.randint(0, 1)] = r.choice(["", "x", "y"])
        some.append(("".join(a), "".join(b)))
    x, y = (line_dedup.kind_counts([p[k] for p in some]) for k in range(2))
    near = line_dedup.near_counts(x, y, np.array([int(0.1 * max(len(a), len(b)) + 1e-9) for a, b in some]))
    assert near[[similar(a, b, 0.9) for a, b in some]].all()
    assert not line_dedup.near_counts(line_dedup.kind_counts(["a" * 20]), line_dedup.kind_counts(["b" * 20]), np.array([2])).any()


def test_near_lines_of_repeated_rows_and_null_ids(spark, monkeypatch):
    """Texts are read alike whether the wanted lines are broadcast or shuffled, and once for rows equal in id and text."""
    rows = [(None, "a line that is of no id at all"), (None, "a line that is of no id at all"), (None, "another text\na line that is of no ids at all"),
            (1, "a line that was of no id at all\nand one more line of its own"), (1, "a line that was of no id at all\nand one more line of its own"), (2, "and one more line of its owns")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    seen, plain = [], line_dedup._similar_pairs

    def counted(texts, pairs, similarity):
        seen.append((texts.count(), texts.select("v").distinct().count()))
        return plain(texts, pairs, similarity)

    monkeypatch.setattr(line_dedup, "_similar_pairs", counted)
    # of null ids the text with the least key stays
    want = [(None, "0", True), (None, "0", True), (None, "", False), (1, "0", False), (1, "0", False), (2, "0", True)]
    for few in (line_dedup.FEW, 0):
        monkeypatch.setattr(line_dedup, "FEW", few)
        got = [(x.doc_id, x.removed, x.emptied) for x in line_lists(d).collect()]
        assert sort(got) == sort(want)
    assert all(n == m > 0 for n, m in seen)


def test_texts_of_pairs_that_counts_rule_out_are_not_fetched(spark, monkeypatch):
    """Lines of one template share bands; only the two whose characters allow a link are read again for their texts."""
    template = "the quick brown fox jumps over the lazy dog near the old mill by the river"
    rows = [(i, f"{template} {c * 10} {c * 11} {c * 9}") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    rows.append((26, f"{template} {'z' * 10} {'z' * 11} {'z' * 8}"))
    fetched, fetch = [], line_dedup._node_texts

    def counted(d, nodes, wanted, *turns):
        out = fetch(d, nodes, wanted, *turns)
        fetched.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "_node_texts", counted)
    got = line_lists(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [x.doc_id for x in got if x.n_removed] == [26]
    assert sum(fetched) == 2


def test_lines_shuffled_in_turns_equal_all_at_once(spark, monkeypatch):
    """Texts shipped to one pair a turn and documents in turns give the same lines."""
    r = random.Random(3)
    lines = [" ".join(r.choice(("alpha", "beta", "gamma", "delta", "epsilon")) + str(r.randrange(3)) for _ in range(n)) for n in (4, 9, 30) for _ in range(4)]
    rows = [(i, "\n".join(x + end for x in lines[i % 3::3])) for i, end in enumerate(("", "", "", " a", " b", " c"))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = sort(map(tuple, line_lists(d).collect()))
    pairs, plain = [], line_dedup.materialise_turns

    def counted(parts, tag):
        parts = list(parts)
        pairs.append((tag, len(parts)))
        return plain(parts, tag)

    monkeypatch.setattr(line_dedup, "materialise_turns", counted)
    monkeypatch.setattr(line_dedup, "PAIRS_AT_ONCE", 1)
    monkeypatch.setattr(line_dedup, "FEW", 0)
    assert sort(map(tuple, line_lists(d).collect())) == want
    assert ("nodes", line_dedup.TURNS) in pairs and ("texts", line_dedup.TURNS) in pairs and any(x[2] for x in want)


def test_lines_of_odd_rows(docs):
    out = dedup_lines(docs)
    assert out.columns == docs.columns
    r = [x.text for x in out.where("doc_id = -6").collect()]
    assert len(r) == 2  # rows equal in id and text are one document
    assert out.where("doc_id = -1 AND text IS NULL").count() == 1


def test_edit_distance_and_long_lines():
    def plain(a, b):
        d = list(range(len(b) + 1))
        for i, c in enumerate(a):
            p, d = d, [i + 1]
            for j, e in enumerate(b):
                d.append(min(p[j] + (c != e), p[j + 1] + 1, d[-1] + 1))
        return d[-1]

    r = random.Random(3)
    for _ in range(500):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in range(2))
        assert edit_distance(a, b) == plain(a, b)
        for most in range(6):
            assert (edit_distance(a, b, most) <= most) == (plain(a, b) <= most)
    t = ["a b " * 40000, "", "\n\n c"]
    text, no, _, _ = line_table(t, 1)
    assert list(zip(text.tolist(), no.tolist(), strict=True)) == [(0, 0), (2, 2)]


@pytest.mark.parametrize("params", [{}, {"node": 40, "block": 8, "leaf": 16}])
def test_embeddings_equal_all_pairs(spark, params):
    r = np.random.default_rng(4)
    base = r.standard_normal((120, 16))
    v = [*base, *(base[7] + 0.02 * r.standard_normal((90, 16))), base[3], base[3]]
    rows = [(i, [float(c) for c in x]) for i, x in enumerate(v)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 0.0]), (906, [2.0, 0.0]), (None, rows[5][1]), (5, rows[5][1])]
    d = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "vec_id long, embedding array<double>, label int, key int")
    n = len(rows)
    unit = [np.array(x) / np.linalg.norm(x) if x and None not in x and np.isfinite(x).all() and any(x) else None for _, x in rows]
    links = [(i, j) for i in range(n) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95]
    lab, deg = components(n, links), [sum(i in x for x in links) for i in range(n)]
    want = []
    for i in range(n):
        c = least(rows[j][0] for j in range(n) if lab[j] == lab[i])
        want.append((rows[i][0], deg[i], c, c is None or rows[i][0] == c))
    assert sort(map(tuple, embedding_near_dedup(d, **params).collect())) == sort(want)


def test_components(spark):
    e = [(1, 2), (2, 3), (5, 4), (7, 7), (9, 8), (8, 3), (None, 3)] + [(100 + i, 101 + i) for i in range(50)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(e, "a long, b long")).collect()))
    assert got == {**{v: 1 for v in (1, 2, 3, 8, 9)}, 4: 4, 5: 4, **{v: 100 for v in range(100, 151)}}


RULE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "card":
        return 16 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return all(int(p) <= 255 for p in v.split(".")) if kind == "ip" else 8 <= len(d) <= 15 if kind == "phone" else True


def test_pii_base_spans_equal_the_plain_patterns(spark, docs, rows):
    r = random.Random(5)
    more = [(1000 + i, "".join(r.choice("a1.@+- (9_\U0001F600\n") for _ in range(r.randint(1, 120)))) for i in range(400)]
    more += [(2000, "4111 1111 1111 1111 +1 (22) 333-44 55 1.2.3.4.5.6.7.8 a@b@c.de a@b.c-_d@e.fg"), (2001, "a" * 30000 + " " + "1." * 9000)]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    want = []
    for i, t in rows + more:
        s = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, t or "") if passes(k, m[0])] for k, p in RULE.items()]
        want.append((i, *map(len, s), ",".join(sum(s, []))))
    got = [(x.doc_id, x.n_email, x.n_ip, x.n_card, x.n_phone, re.sub(",?term:[0-9]+:[0-9]+", "", x.spans)) for x in digest(pii_spans(d)).collect()]
    assert sort(got) == sort(want)


def test_pii_terms_that_disclose_an_entity(spark):
    r = random.Random(6)
    filler = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ep") for b in ("pha", "ta", "mma", "lta", "silon")]
    rows = [(i, " ".join(r.choice(filler) for _ in range(30))) for i in range(300)]
    rows += [(500 + i, f"{r.choice(filler)} Zanzibar {r.choice(filler)} {i} mail joe@corp.example {r.choice(filler)}") for i in range(6)]
    rows += [(600, "only here: zanzibar.\nnext"), (601, None)]
    d = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, terms int")
    got = {x.doc_id: x.spans for x in digest(pii_spans(d)).collect()}
    at = rows[-2][1].index("zanzibar")
    assert got[600] == f"term:{at}:{at + 8}" and got[601] == "" and "term:" in got[500] and got[0] == ""
    clean = {x.doc_id: x.text for x in sanitise(d).collect()}
    assert "anzibar" not in clean[600] and "joe@" not in clean[503] and "<EMAIL>" in clean[503] and clean[601] is None and clean[4] == rows[4][1]


def test_pii_terms_of_any_form_equal_plain_counts(spark):
    """Handles, hyphenated and short names and numbers are terms like words; parts of entities aren't.  PMI and IC are counted plainly."""
    r = random.Random(8)
    filler = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ep") for b in ("pha", "ta", "mma", "lta", "silon")]
    some = lambda: " ".join(r.choice(filler) for _ in range(3))
    names = ["Wanda", "jdoe42", "Jean-Luc", "Bo", "AC.77-19"]
    rows = [(i, some() + " " + some()) for i in range(400)]
    rows += [(500 + i, f"{some()} " + " ".join(f"{n} {r.choice(filler)}" for n in names) + " w.k@corp.example call +1 (22) 333-44 55\n" + some()) for i in range(5)]
    rows += [(600 + i, f"{n} met {n.upper()}, 333-44") for i, n in enumerate(names)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    token = lambda t: [w for w in regex.split(r"(?:[^\p{L}\p{N}@._%+-]|[._%+-](?![\p{L}\p{N}@]))++", t.lower()) if w]
    every = Counter(w for _, t in rows for w in token(t))
    total = sum(every.values())
    met, near, in_lines = Counter(), {}, Counter()
    for _, t in rows:
        for line in t.split("\n"):
            ent = [f"{k}:{m[0].lower()}" for k, p in RULE.items() for m in re.finditer(p, line) if passes(k, m[0])]
            own = {w for e in ent for w in token(e.split(":", 1)[1])}
            w = token(line)
            for e in set(ent):
                in_lines[e] += len(w)
                for j, x in enumerate(w):
                    if x not in own:
                        met[e, x] += 1
                        near.setdefault((e, x), set()).add((w[j - 1] if j else None, w[j + 1] if j + 1 < len(w) else None))
    want = set()
    for (e, x), n in met.items():
        if len(near[e, x]) >= 3 and regex.search(r"[\p{L}\p{N}]", x):
            if np.log2(n * total / (every[x] * in_lines[e])) >= 0.7 * np.log2(total / in_lines[e]):
                want.add(x)
    assert {n.lower() for n in names} <= want and not want & {"333-44", "22", "w.k@corp.example"}
    got = {x.doc_id: {dict(rows)[x.doc_id][s.start: s.end].lower() for s in x.terms} for x in
           pii_spans(d, disclose=0.7).withColumnRenamed("id", "doc_id").collect()}
    for i, t in rows:
        assert got[i] == want & set(token(t)), (i, t)


def test_quality_rules_counts(docs, rows):
    def plain(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        tri = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
        n = {x: tri.count(x) for x in set(tri)} if len(tri) < 4000 else {x: 2 if len(set(tri)) < len(tri) else 1 for x in set(tri)}
        rep = {j for i, x in enumerate(tri) if n[x] > 1 for j in range(i, i + 3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep), base)

    small = [(i, t) for i, t in rows if len(t or "") < 9000]
    d = docs.where("coalesce(length(text), 0) < 9000")
    got = quality_rules(d).collect()
    assert sort((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sort((i, *plain(t)) for i, t in small)
    assert not any(r.kept and r.base_failed for r in got)


def test_quality_verdicts_follow_the_labels(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    y = {r.doc_id: r.quality for r in lab.collect()}
    kept = {r.doc_id: r.kept for r in quality_rules(d).where("NOT base_failed").collect()}
    good = [kept[i] for i in kept if y.get(i) == 1]
    assert np.mean(good) > 0.97
    held = {r.doc_id: r.kept for r in quality_classifier(d, lab).where("crc32(cast(doc_id AS string)) % 3 = 1").collect()}
    assert np.mean([held[i] == bool(y[i]) for i in held if i in y]) > 0.95


def test_quality_classifier_and_filter_agree(docs, labels, none):
    r = quality_classifier(docs, labels).collect()
    assert len(r) == docs.count()
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sort(x.doc_id for x in kept.collect()) == sort(x.doc_id for x in r if x.kept)
    assert all(x.kept for x in quality_classifier(docs, labels.limit(0)).collect())


def test_quality_training_rows_of_a_repeated_id(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1][:8]
    label = {i: n % 2 for n, i in enumerate(ids)}
    text = {i: "good words in a row. " * 20 if y else "bad!" * (2 + i) for i, y in label.items()}
    rows = [(ids[1], text[ids[1]])] * 400 + [(i, text[i]) for i in ids]
    labels = spark.createDataFrame(list(label.items()), "doc_id long, quality int")
    once, often = (train(spark.createDataFrame(r, "doc_id long, text string").coalesce(1), labels, sample=4) for r in (rows[400:], rows))
    assert often["b"] is not None and np.array_equal(often["b"], once["b"])


def test_toxicity_on_held_out_rows(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    y = {r.doc_id: r.toxic for r in lab.collect()}
    r = [x for x in toxicity(d, lab).collect() if x.held_out and x.doc_id in y]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 3 == 1) for x in r)
    assert np.mean([x.predicted == y[x.doc_id] for x in r]) > 0.9
    assert all(0 <= x.score <= 1 for x in r)


def test_toxicity_neighbours_are_exact():
    from tessera.llm.toxicity import Index

    r = random.Random(8)
    idf = np.linspace(1, 5, 40)
    ex = [(i, i % 2, sorted(r.sample(range(40), r.randint(1, 6))), None) for i in range(700)]
    ex = [(i, y, t, [r.randint(1, 3) for _ in t]) for i, y, t, _ in ex]
    index = Index(ex, idf, block=16)
    dense = np.zeros((700, 40))
    place = {e: p for p, e in enumerate(index.ids)}
    for i, _, t, n in ex:
        dense[place[i], t] = index.weights(t, n)
    for _ in range(60):
        t = sorted(r.sample(range(40), r.randint(1, 8)))
        n = [r.randint(1, 4) for _ in t]
        near, sim = index.nearest(t, n, 15)
        q = np.zeros(40)
        q[t] = index.weights(t, n)
        full = np.sort(dense @ q)[::-1][: len(sim)]
        assert np.allclose(sim, full) and np.allclose((dense @ q)[near], sim)


def test_toxicity_odd_rows(docs, labels):
    assert toxicity(docs, labels).count() == docs.count()
    r = toxicity(docs, labels.limit(0)).collect()
    assert {x.score for x in r} == {0.0} and not any(x.held_out for x in r if x.doc_id is None)


def test_mixing_equals_sql_and_meets_targets(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(mixing.SQL).fetchall()
    r = mixing.sampled(docs)
    got = [(x.id, x.size, x.source_size, x.target, x.copies * x.size) for x in r.collect()]
    assert sort((a, b, c, round(d, 6), e) for a, b, c, d, e in got) == sort((a, b, c, round(d, 6), e) for a, b, c, d, e in want)
    assert all(e <= 2 * b for _, b, _, _, e in got)
    total = sum(x[1] for x in got)
    assert abs(sum(t for _, t in {(x.source, x.target) for x in r.collect()}) - 1.5 * total) < 1e-3


def test_license_scan(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    r = license_scan.license_scan(docs)
    rel = con.execute(license_scan.oracle())
    names = [c[0] for c in rel.description]
    assert names == r.columns and sort(map(tuple, r.collect())) == sort(rel.fetchall())
    text = ("Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License.\nYou may obtain a copy of the License at x.org.\n\n"
            "Released under the MIT License. Some permission we do not know.")
    x = license_scan.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (x.licenses, x.unmatched, x.n_unknown, x.license_class) == ("Apache-2.0,MIT", "", 1, "permissive")


def test_license_sentences_without_a_licence_word(spark):
    want = {"Text is available under CC-BY-SA 4.0.": "CC-BY-SA", "Released under the GNU GPL v3.": "GPL-3.0", "distributed under GPLv3": "GPL-3.0",
            "This software is provided as is.": "", "In no event shall the authors be liable": "", "All rights\nreserved": "All-Rights-Reserved",
            "nor the names of its contributors may be used to endorse or promote products": "", "or, at your option, any later version": ""}
    d = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {x.doc_id: x for x in license_scan.license_scan(d).collect()}
    for i, (t, licences) in enumerate(want.items()):
        assert (got[i].n_sentences, got[i].n_unknown, got[i].licenses) == (1, 0, licences), t
        assert got[i].license_class != "none"


def test_license_oracle_on_planted_sentences(spark):
    """The SQL restates the operator: names that share a sentence, sentences without a licence word, any cut and any case."""
    pick = random.Random(4)
    names = ["MIT License", "Apache License, Version 2.0", "Apache License", "GNU GPL v3", "GPLv2", "GNU General Public License", "CC BY-NC-SA 4.0", "CC-BY", "CC0",
             "BSD-3-Clause", "modified BSD license", "SPDX-License-Identifier: MIT", "Mozilla Public License 2.0", "public\ndomain", "proprietary", "LGPL"]
    rest = ["This software is provided as is", "in no event shall the authors be liable", "without any warranty", "All rights reserved", "Copyright 2020", "or later",
            "at your option, any later version", "neither the name of X nor the names of its contributors may be used to endorse or promote products",
            "Permission is hereby granted, free of charge", "see the accompanying LICENSE file", "some permission", "plain words", "Ünï", ""]
    glue = [" ", " or the ", ". ", ".\n", "; ", "\n", "\n \n", ", ", "! ", " / "]
    texts = ["".join(pick.choice((str, str.upper, str.lower))(pick.choice(names + rest)) + pick.choice(glue) for _ in range(pick.randint(1, 9))) for _ in range(600)]
    rows = [(None if i % 97 == 0 else i // 2, t) for i, t in enumerate([*texts, None, ""])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    r = license_scan.license_scan(d)
    got = sort(map(tuple, r.collect()))
    assert got == sort(con.execute(license_scan.oracle()).fetchall())
    assert sum("," in x[r.columns.index("licenses")] for x in got) > 200


def test_license_names_that_share_a_sentence(spark):
    want = {"Dual-licensed under the MIT License or the Apache License 2.0.": ("mit-name,apache2", {"MIT", "Apache-2.0"}, "permissive"),
            "a: MIT License\nb: GNU General Public License v3\nc: proprietary": ("mit-name,gpl3,proprietary", {"MIT", "GPL-3.0", "Proprietary"}, "restricted"),
            "GNU General Public License, or the MIT License, or later": ("gpl-later,mit-name", {"GPL-or-later", "MIT"}, "copyleft"),
            "CC BY-NC-SA for the text and CC BY for the data": ("cc-by-nc-sa,cc-by", {"CC-BY-NC-SA", "CC-BY"}, "noncommercial"),
            "Apache License 2.0 (see the Apache License)": ("apache2", {"Apache-2.0"}, "permissive"),
            "Copyright 2020 by us, all rights reserved": ("all-rights", {"All-Rights-Reserved"}, "restricted"),
            "THE SOFTWARE IS PROVIDED AS IS, WITHOUT ANY WARRANTY": ("as-is", set(), "unknown")}
    d = spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")
    got = {x.doc_id: x for x in license_scan.license_scan(d).collect()}
    for i, (t, (sequence, licences, cls)) in enumerate(want.items()):
        x = got[i]
        assert (x.n_sentences, x.sequence, set(filter(None, x.licenses.split(","))), x.license_class) == (1, sequence, licences, cls), t


def test_packing_is_an_exact_round_trip(docs, rows):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    r = pack(docs).collect()
    by_seq, by_doc = {}, {}
    for x in r:
        by_seq.setdefault(x.sequence_id, []).append((x.offset, x.length))
        by_doc.setdefault((x.doc_id, x.doc_tokens), []).append(x)
    for s in by_seq.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    want = {}
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.setdefault((i, len(ids)), []).append(ids)
    assert {k: len(v) for k, v in want.items()} == {k: sum(x.start == 0 for x in v) for k, v in by_doc.items()}
    for k, pieces in by_doc.items():
        assert sum(x.length for x in pieces) == k[1] * len(want[k])
        for x in pieces:
            assert any(zlib.crc32(ids[x.start: x.start + x.length].tobytes()) == x.ids_crc32 for ids in want[k])


def test_hilbert_steps_are_neighbours():
    pts = np.array([[x, y, z] for x in range(8) for y in range(8) for z in range(8)])
    key = hilbert(pts, 3)
    assert sorted(key) == list(range(512)) and set(np.abs(np.diff(pts[np.argsort(key)], axis=0)).sum(axis=1)) == {1}


def test_empty_tables(none, labels, spark):
    e = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (ngram_jaccard_join(none), line_lists(none), dedup_lines(none), digest(pii_spans(none)), sanitise(none), quality_rules(none), mixing.sampled(none),
               license_scan.license_scan(none), pack(none), quality_classifier(none, labels), keep_good(none, labels), toxicity(none, labels), embedding_near_dedup(e)):
        assert df.count() == 0


def test_stages_keep_columns_with_inner_names(spark, docs, none):
    d = docs.selectExpr("*", "10 AS stays", "11 AS _i", "12 AS _k", "13 AS h", "14 AS bucket", "15 AS bin", "16 AS at", "17 AS row", "18 AS removed", "19 AS left", "20 AS rid", "21 AS _copy", "22 AS col")
    for stage in (corpus_pipeline.line_stage, corpus_pipeline.near_duplicate_stage, corpus_pipeline.mixing_stage):
        out = stage(spark, d, DIR)
        assert out.columns == d.columns and out.count() > 0
        assert {(r.stays, r._i, r._k, r.h, r.bucket, r.bin, r.at, r.row, r.removed, r.left, r.rid, r.col, r.comp, r.size) for r in out.collect()} == {
            (10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 22, 2, 5)}
        assert stage(spark, none, DIR).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    cols, ids, names = docs.columns, {r.doc_id for r in docs.collect()}, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DIR)
        path = str(tmp_path / name)
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        names.append(name)
        if name != "packing":
            assert docs.columns == cols and {r.doc_id for r in docs.collect()} <= ids
        if name == "ngram_jaccard_join":
            classes = {i: c for i, c, _ in jaccard_classes([(r.doc_id, r.text) for r in before.collect()])}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(set(classes.values()))
        if name == "mixing":
            want = {r.id: r.copies for r in mixing.sampled(before).collect()}
            got = [r.doc_id for r in docs.collect()]
            assert {i: got.count(i) for i in want} == want
    assert names == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "mixing", "packing"]
    assert docs.count() == corpus_pipeline.run(spark, DIR).count()
