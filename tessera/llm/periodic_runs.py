"""Periodic runs of words, by online sparse dynamic programming over diagonals.

Word i of a text meets earlier words that equal it; each such pair lies on the diagonal
of its lag.  A diagonal is active while word after word matches the one a lag before; when it
breaks off, what it covers is emitted as a run if it is long enough.  Words are
visited in order, and a run is known as soon as its last word is passed.

Only diagonals that can become runs are opened: a run of period q >= 12 needs q matches
in a row, a shorter period 6 at least.  So occurrences are those of whole windows that
end at the word, of 6 words for lags below 12 and of m = 12, 24, 48, ... words for lags from m to
below 2m.  Windows are numbered by doubling.  In texts without periods hardly any
word has such an occurrence.  Lags that are multiples of a period that is active
over both windows are passed over: they begin and end with it and are never smallest.
So are diagonals between two runs of one period with words between them: these
break off before they are long enough, unless both runs end together, and then the
window behind their ends opens the diagonal, from its true beginning on.

A run is a maximal stretch with smallest period q and at least max(12, 2q)
words.  Two equal stretches differ in period only by a multiple, so of
those that end together with one start, the first by lag is the run.

Defined cases: a null text has no words; fewer than 12 words hold no run;
repeated rows each get their row; other columns are not read.  No rows, no output.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 12          # words of a run
WINDOW = 6          # matches in a row that the shortest runs need
BATCH_BYTES = 16 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _number(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs (a[i], b[i]), smaller than len(a)."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]


def _windows(w: np.ndarray):
    """(m, numbers of the m-word windows by first word), m = 6, 12, 24, ... while
    windows repeat and a run of period m has room."""
    two = _number(w[:-1], w[1:])
    three = _number(two[:-1], w[2:])
    m, number = WINDOW, _number(three[:-3], three[3:])
    while True:
        yield m, number
        if 4 * m > len(w) or int(number.max()) + 1 == len(number):
            return
        number = _number(number[:-m], number[m:])
        m *= 2


def runs(w: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of the word numbers ``w``, by start, then period."""
    n = len(w)
    if n < LEAST:
        return []
    levels, due = [], np.zeros(n, dtype=np.int64)
    for m, number in _windows(w):
        order = np.argsort(number, kind="stable")
        again = number[order[1:]] == number[order[:-1]]
        near = np.flatnonzero(again & (order[1:] - order[:-1] < 2 * m))
        if len(near):
            due[order[near + 1] + m - 1] |= 1 << len(levels)
            first = np.r_[0, np.flatnonzero(~again) + 1]
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            head = first[np.searchsorted(first, rank, side="right") - 1]
            levels.append((m, order.tolist(), rank.tolist(), head.tolist()))
    if not levels:
        return []

    word, bits, found = w.tolist(), due.tolist(), []
    active: dict[int, int] = {}     # lag -> first word that matches the one a lag before
    closed: dict[int, tuple[list[int], list[int]]] = {}     # lag -> starts and ends of the stretches over

    def begin(a: int, q: int) -> int:
        """First word of the matches at lag ``q`` that hold the window from ``a`` on."""
        if a == q or word[a - 1] != word[a - 1 - q]:
            return a
        other = np.flatnonzero(w[q:a] != w[: a - q])
        return q + (int(other[-1]) + 1 if len(other) else 0)

    def close(lags: list[int], end: int) -> None:
        begun = set()
        for q in sorted(lags):
            start = active.pop(q) - q
            starts, ends = closed.setdefault(q, ([], []))
            starts.append(start)
            ends.append(end)
            if end - start + 1 >= max(LEAST, 2 * q) and start not in begun:
                begun.add(start)
                found.append((start, end - start + 1, q))

    stops = np.flatnonzero(due).tolist()
    i = stops[0]
    while True:
        over = [q for q in active if word[i] != word[i - q]]
        if over:
            close(over, i - 1)
        if bits[i]:
            for level, (m, order, rank, head) in enumerate(levels):
                if bits[i] >> level & 1:
                    a = i - m + 1
                    # lags of at least m (all of them for the shortest window), and not inside an active stretch of period <= m
                    last = min([a - (1 if m == WINDOW else m), *(f - p - 1 for p, f in active.items() if p <= m)])
                    k = bisect_right(order, last, head[a], rank[a]) - 1
                    p = min((p for p, f in active.items() if 2 * p <= m and f - p <= a), default=0)
                    starts, ends = closed.get(p, ([], []))
                    while k >= head[a] and a - order[k] < 2 * m:
                        before = order[k]
                        t = bisect_left(ends, before + m - 1)
                        if t < len(ends) and starts[t] <= before and ends[t] < active[p] - p - 1:
                            k = bisect_left(order, starts[t], head[a], k)
                        elif a - before not in active:
                            active[a - before] = begin(a, a - before)
                        k -= 1
        if active:
            i += 1
        else:
            k = bisect_left(stops, i + 1)
            i = stops[k] if k < len(stops) else n
        if i >= n:
            break
    close(list(active), n - 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeated_tail(n: int, h: int) -> np.ndarray:
    """Which of ``n`` > 0 words stands at each place once the words from g % n on repeat, g = h // 10."""
    g, at = h // 10, np.arange(n)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.where(at >= a, a + (at - a) % p, at)


def _find(batches):
    for b in batches:
        ids, size, rows = b.column("id"), 0, []
        for i, (text, h) in enumerate(zip(b.column("text"), b.column("tail").to_pylist(), strict=True)):
            raw = text.as_py()
            words = raw.split()     # bytes split at exactly the bytes x20 and x09 to x0D
            seen: dict[bytes, int] = {}
            w = np.fromiter((seen.setdefault(x, len(seen)) for x in words), dtype=np.int64, count=len(words))
            if h is not None and len(w):
                at = repeated_tail(len(w), h)
                w, words = w[at], [words[k] for k in at.tolist()]
            found = runs(w)
            if found:
                gone = np.zeros(len(w) + 1, dtype=np.int64)
                for s, length, q in found:
                    gone[s + q] += 1
                    gone[s + length] -= 1
                words = compress(words, (np.cumsum(gone[:-1]) == 0).tolist())
            rows.append((i, len(w), found, b" ".join(words)))
            size += len(raw)
            if size >= BATCH_BYTES or i == len(ids) - 1:
                yield _batch(ids, rows)
                size, rows = 0, []


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    at, n, found, left = zip(*rows, strict=True)
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    flat = np.array([r for f in found for r in f], dtype=np.int64).reshape(-1, 3)
    values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN))
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(at)), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), values), pa.array(left, pa.binary())],
        ["id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, tail: Column | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) for each row of ``docs``: its runs (start, length,
    period), and the words that no run holds after its first period.

    ``tail``: a number for each row; where it is not null, the row's words are first
    made to repeat as :func:`repeated_tail` says."""
    id_, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = docs.select(id_.alias("id"), text.cast("binary").alias("text"), (F.lit(None) if tail is None else tail).cast("long").alias("tail"))
    spec = f"id {d.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
    return d.mapInArrow(_find, spec).select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def tenth(id_col: str = "doc_id") -> Column:
    """crc32 of the decimal id where it is divisible by ten, else null."""
    h = F.crc32(F.col(f"`{id_col}`").cast("string"))
    return F.when(h % 10 == 0, h)


def digest(r: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The registered query's columns: the longest run, and all runs and the words left as hashes."""
    best = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    d = r.select("*", best.alias("best"), F.array_join(lines, "").alias("lines"))
    return d.select(id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                    F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


# All pairs of equal 6-word windows of a text, as diagonals; crc32 bit by bit.
SQL = r"""
WITH h AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda k: (-1)::BIGINT))))),
             lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) AS h
  FROM documents
), g AS (
  SELECT doc_id, w, len(w) AS n, h, h // 10 AS g FROM h
), a AS (
  SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM g
), p AS (
  SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a
), t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                         THEN list_concat(w[1:a], list_transform(range(n - a), lambda i: w[a + i % p + 1])) ELSE w END AS w FROM p
), word AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM t
), win AS (
  SELECT doc_id, n, unnest(list_transform(range(n - 5), lambda i: array_to_string(w[i + 1:i + 6], ' '))) AS v, unnest(range(n - 5)) AS i
  FROM t WHERE n >= 12
), pair AS (
  SELECT x.doc_id, x.i - y.i AS q, x.i FROM win x JOIN win y ON x.doc_id = y.doc_id AND x.v = y.v AND y.i < x.i AND 2 * (x.i - y.i) <= x.n
), diagonal AS (
  SELECT doc_id, q, min(i) AS f, max(i) + 5 AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair)
  GROUP BY doc_id, q, island
), stretch AS (
  SELECT doc_id, f - q AS s, e - f + q + 1 AS length, q FROM diagonal WHERE e - f + q + 1 >= greatest(12, 2 * q)
), run AS (
  SELECT * FROM stretch QUALIFY row_number() OVER (PARTITION BY doc_id, s, length ORDER BY q) = 1
), best AS (
  SELECT doc_id, s, length, q FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, s, q) = 1
), listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s + q, s + length)) AS i FROM run
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, b.length::BIGINT AS length, q::BIGINT AS period,
       (1000 * b.length // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best b USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
