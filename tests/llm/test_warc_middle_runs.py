"""WARC data source, fill-in-middle and periodic runs against plain versions, with nulls,
empty and long texts, ties, repeated rows, empty tables and extra columns."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.llm import fill_in_middle as fim
from tessera.llm import periodic_runs as pr
from tessera.llm import warc

DIR = "/root/testdata/sf0.001"
CLASH = ["1 AS id", "2 AS text_", "'h' AS h1", "'f' AS form", "3 AS n", "'o' AS output", "4 AS tail", "5 AS hex", "6 AS k", "7 AS h", "8 AS same", "9 AS payload", "10 AS copy"]
ODD = [(-1, None), (-2, ""), (-3, " \n\t"), (None, "a null id"), (None, None), (-4, "x" * 20000), (-5, "long " * 8000), (-5, "other text of one id"),
       (-6, "same row"), (-6, "same row"), (-7, "é\U0001F600 <P> marker"), (-8, "Grüße \U0001F600\U0001F600 an 漢字 alle\x0b!"), (-9, "a b " * 300 + "c " + "a b c " * 200)]


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    return given.unionByName(spark.createDataFrame(ODD, given.schema)).selectExpr("*", *CLASH).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fill-in-middle ----------------------------------------------------------

def plain_middle(i, t):
    t = t or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n, h = len(units), sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[k: k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (i, n, "plain", None, None, t)
    if h4 % 100 < 20:
        return (i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("block", [1, 7, fim.BLOCK])
def test_middles_equal_a_plain_version_and_come_back(docs, rows, block):
    r = fim.fill_in_middle(docs, block=block)
    got = r.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(x)[:6] for x in got) == Counter(plain_middle(i, t) for i, t in rows)
    assert Counter((x.doc_id, x.back) for x in got) == Counter((i, t or "") for i, t in rows)
    assert {x.form for x in got} == {"plain", "psm", "spm"}


def test_middle_digest_and_empty_table(docs, rows):
    got = Counter(tuple(x) for x in fim.digest(fim.fill_in_middle(docs)).collect())
    assert got == Counter((*plain_middle(i, t)[:5], sha(plain_middle(i, t)[5]), sha(t or "")) for i, t in rows)
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_fenwick_descent_over_any_blocks():
    r = random.Random(5)
    for _ in range(200):
        blocks = [(r.choice([0, 0, 1, 5]), r.randrange(4)) for _ in range(r.randrange(1, 40))]
        tree = fim.Fenwick()
        for b in blocks:
            tree.append(*b)
        n = sum(u for u, _ in blocks)
        for unit in range(n):
            at, rest, chars = tree.find(unit)
            before = [sum(x[k] for x in blocks[:at]) for k in (0, 1)]
            assert before == [unit - rest, chars] and rest < blocks[at][0]
        assert tree.find(n)[0] == len(blocks)


def test_cuts_in_one_long_text_need_windows():
    t = "".join(random.Random(2).choices(["ab", "é", " ", "\U0001F600", "Z", "1"], k=50_000))
    raw = np.frombuffer(t.encode(), dtype=np.uint8)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    tree, n = fim.count_blocks(raw, 16)   # several windows of 256 blocks
    assert n == len(units)
    for unit in (0, 1, 999, n // 2, n - 1, n):
        head = "".join(units[:unit])
        assert fim.cut(raw, tree, unit, 16) == (len(head.encode()), len(head))


# --- periodic runs -----------------------------------------------------------

def plain_runs(w):
    """All stretches of every period, the smallest period of each kept."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            e = i
            while e + 1 < n and w[e + 1] == w[e + 1 - q]:
                e += 1
            if e - i + q + 1 >= max(12, 2 * q):
                best.setdefault((i - q, e), q)
            i = e + 1
    return sorted(((s, e - s + 1, q) for (s, e), q in best.items()), key=lambda x: (x[0], x[2]))


def plain_words(i, t, tail=True):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    h = None if i is None else zlib.crc32(str(i).encode())
    if tail and h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    return w


def plain_digest(i, t):
    w = plain_words(i, t)
    found = plain_runs(w)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (i, len(found), *top, 1000 * top[1] // top[2] if found else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_runs_of_the_table_equal_a_plain_version(docs, rows):
    short = [(i, t) for i, t in rows if len((t or "").split()) <= 1500]
    assert len(short) > 150
    got = pr.digest(pr.periodic_runs(docs, tail=pr.tenth())).collect()
    want = Counter(plain_digest(i, t) for i, t in short)
    keys = {k[0] for k in want} - {-5}
    assert Counter(tuple(r) for r in got if r.doc_id in keys) == Counter({k: v for k, v in want.items() if k[0] in keys})
    assert len(got) == len(rows)
    assert pr.periodic_runs(docs.limit(0)).collect() == []


def test_runs_of_random_words_equal_a_plain_version():
    r = random.Random(11)
    for _ in range(1500):
        kind, n = r.randrange(4), r.randrange(8, 160)
        if kind == 0:
            w = [r.randrange(2) for _ in range(n)]
        elif kind == 1:                                       # powers beside each other
            w = []
            while len(w) < n:
                w += [r.randrange(3) for _ in range(r.randrange(1, 9))] * r.randrange(1, 6)
        elif kind == 2:                                       # powers of powers
            root = [0] * r.randrange(1, 20) + [r.randrange(3) for _ in range(r.randrange(1, 4))]
            w = root * (n // len(root) + 1)
            w[r.randrange(len(w))] = 7
        else:                                                 # Fibonacci words hold most runs
            a, b = [0], [0, 1]
            while len(b) < n:
                a, b = b, b + a
            w = b[:n]
        assert pr.runs(np.array(w, dtype=np.int64)) == plain_runs(w), w


def test_runs_of_long_periodic_texts():
    assert pr.runs(np.zeros(300_000, dtype=np.int64)) == [(0, 300_000, 1)]
    w = np.r_[np.arange(5000), np.arange(5000), np.arange(2000), [9999]]
    assert pr.runs(w) == [(0, 12_000, 5000)]


def test_words_left_after_the_first_period(spark):
    d = spark.createDataFrame([(1, "go " + "a b c " * 4 + "end"), (2, "x " * 11)], "doc_id long, text string")
    got = {r.doc_id: r for r in pr.periodic_runs(d).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 12, 3)] and got[1].collapsed == "go a b c end"
    assert got[2].runs == [] and got[2].collapsed == " ".join("x" * 11)


# --- WARC --------------------------------------------------------------------

PAGES = [(1, "u1", "same é"), (2, "u2", "same é"), (2, "u2", "same é"), (3, "u3", "same é"), (3, "u3", "same é"), (3, "u0", "same é"), (4, "u4", None), (5, "u5", ""),
         (6, None, "alone"), (None, "u7", "no id"), (None, "u8", "no id"), (7, "u\r\n9", "WARC/1.1\r\nWARC-Type: fake\r\n\r\n"), (8, "u10", "z" * 200_000), (9, "u11", "HTTP/1.1 200 OK\r\n\r\nx")]


def plain_pages(rows, least=0):
    out, seen = [], set()
    for i, u, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), reverse=True):
        data = (t or "").encode()
        known = [x for x in out if x[-1] == data and x[3] == "response"] if len(data) >= least else []
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if known else "response", known[0][0] if known else None, data))
    return Counter(x[:5] for x in out)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", *CLASH).repartition(3)


@pytest.mark.parametrize("least", [0, 3])
def test_pages_written_and_read(spark, pages, tmp_path, least):
    path = f"file://{tmp_path}/a{least}"
    warc.archive_pages(pages, path, min_bytes=least)
    assert Counter(map(tuple, warc.page_digest(spark, path).collect())) == plain_pages(PAGES, least)


def test_pages_of_the_table(spark, tmp_path):
    p = spark.read.parquet(f"{DIR}/pages.parquet")
    p = p.unionByName(p.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 100_000))
    warc.archive_pages(p, f"{tmp_path}/a", file_bytes=50_000, split_bytes=10_000)
    rows = [(r.page_id, r.url, r.html) for r in p.collect()]
    assert Counter(map(tuple, warc.page_digest(spark, f"{tmp_path}/a").collect())) == plain_pages(rows)
    got = warc.read_warc(spark, f"{tmp_path}/a", partition_bytes=15_000)
    assert got.rdd.getNumPartitions() > 5
    by_id = {r.record_id: r for r in got.collect()}
    assert len(by_id) == len(rows)
    for r in by_id.values():                     # revisits point at a response with their payload
        if r.record_type == "revisit":
            assert r.payload is None and by_id[r.refers_to].payload_digest == r.payload_digest and by_id[r.refers_to].record_type == "response"
    assert warc.read_warc(spark, f"{tmp_path}/a", verify=True).where("payload IS NOT NULL").count() == sum(r.payload is not None for r in by_id.values())


def test_empty_pages(spark, pages, tmp_path):
    warc.archive_pages(pages.limit(0), f"{tmp_path}/none")
    assert warc.page_digest(spark, f"{tmp_path}/none").collect() == []


def test_predicates_and_columns_are_pushed_down(spark, pages, tmp_path):
    path = f"{tmp_path}/a"
    warc.archive_pages(pages, path)
    r = warc.read_warc(spark, path)
    everything = spark.createDataFrame(r.collect(), r.schema)
    for where in ("record_type = 'response'", "record_type IN ('revisit', 'x')", "content_length >= 100", "target_uri LIKE 'u1%'", "refers_to IS NULL",
                  "NOT record_type = 'revisit'", "record_type <=> 'revisit'", "target_uri IS NOT NULL AND payload IS NOT NULL", "payload_length < 7", "refers_to > 'a' AND content_length < 90"):
        got = warc.read_warc(spark, path).where(where)
        assert Counter(r.record_id for r in got.collect()) == Counter(r.record_id for r in everything.where(where).collect()), where
    plan = warc.read_warc(spark, path, ["record_id", "record_type"]).where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "Filter[" not in plan and "+- Filter" not in plan


def test_unwanted_payloads_are_not_inflated(tmp_path):
    """Only bytes of wanted records are read behind the headers."""
    rows = [{"record_id": f"<urn:{k}>", "record_type": "response" if k % 2 else "resource", "payload": random.Random(k).randbytes(300_000)} for k in range(6)]
    data = b"".join(warc.member(warc.serialise(r, "2020-01-01T00:00:00Z")) for r in rows)
    (tmp_path / "a.warc.gz").write_bytes(data)

    class Counted:
        def __init__(self, f):
            self.f, self.n = f, 0

        def read(self, k=-1):
            b = self.f.read(k)
            self.n += len(b)
            return b

        def __getattr__(self, name):
            return getattr(self.f, name)

    with open(tmp_path / "a.warc.gz", "rb") as f:
        c = Counted(f)
        got = [r.payload() for r in warc.records(c, 0, len(data), True, "a", lambda h: h["warc-record-id"] == "<urn:3>")]
    assert got == [rows[3]["payload"]] and c.n < 300_000 + 7 * 2 * warc.CHUNK
    assert b"".join(gzip.decompress(data) for _ in [0]).count(b"WARC/1.1\r\n") == 6   # any reader of gzip takes it


def test_files_of_other_writers(spark, tmp_path):
    """Plain files, one gzip stream, members without lengths, folded headers, records that aren't HTTP."""
    def record(kind, name, block, extra=""):
        return f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: {name}\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\nX: y\r\n\r\nbody"
    recs = [record("warcinfo", "<a>", b"software: x\r\n"), record("response", "<b>", http, "Content-Type: application/http;\r\n msgtype=response\r\n"),
            record("metadata", "<c>", b""), record("response", "<d>", http * 5000, "Content-Type: application/http\r\n")]
    (tmp_path / "plain.warc").write_bytes(b"".join(recs))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(recs)))
    (tmp_path / "each.warc.gz").write_bytes(b"".join(map(gzip.compress, recs)))
    (tmp_path / "notes.txt").write_text("not an archive")
    got = warc.read_warc(spark, str(tmp_path), partition_bytes=1).collect()
    body = http.partition(b"\r\n\r\n")[2] + http * 4999
    want = {"<a>": ("warcinfo", b"software: x\r\n"), "<b>": ("response", b"body"), "<c>": ("metadata", b""), "<d>": ("response", body)}
    assert len(got) == 12 and all((r.record_type, r.payload) == want[r.record_id] for r in got)
    assert {r.content_type for r in got if r.record_id == "<b>"} == {"application/http; msgtype=response"}


def test_broken_files_raise(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(b"no archive at all")
    with pytest.raises(PySparkException, match="no WARC record here"):
        warc.read_warc(spark, str(tmp_path)).collect()
    rec = warc.member(warc.serialise({"record_id": "<x>", "record_type": "response", "payload": b"abc", "payload_digest": "A" * 32}, "now"))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.warc.gz").write_bytes(rec)
    assert warc.read_warc(spark, f"{tmp_path}/b").collect()[0].payload == b"abc"
    with pytest.raises(PySparkException, match="payload and digest differ"):
        warc.read_warc(spark, f"{tmp_path}/b", verify=True).collect()
    (tmp_path / "b" / "a.warc.gz").write_bytes(rec[:-30])
    with pytest.raises(PySparkException):
        warc.read_warc(spark, f"{tmp_path}/b").collect()


def test_uncommitted_files_are_not_read(spark, pages, tmp_path):
    warc.archive_pages(pages, f"{tmp_path}/a")
    n = warc.read_warc(spark, f"{tmp_path}/a").count()
    (tmp_path / "a" / "part-lost.warc.gz").write_bytes(b"half a file of a lost task")
    assert warc.read_warc(spark, f"{tmp_path}/a").count() == n == len(PAGES)
    warc.write_warc(warc.read_warc(spark, f"{tmp_path}/a").drop("headers").where("record_type = 'response'"), f"{tmp_path}/a", mode="overwrite")
    assert warc.read_warc(spark, f"{tmp_path}/a").count() < n
