"""Fill-in-middle transformation: prefix, middle and suffix of each text in a new order.

A text's units are its runs of ASCII letters and its other characters, one by one.
Two hashed draws over the units place the cuts.  The text stands as UTF-8 in blocks of
``BLOCK`` bytes; a Fenwick tree over the blocks holds how many units and code points
begin in each.  A cut is found by binary-lifting descent to the block in which its
unit begins, whose bytes alone are then looked at again.  Counting goes through the
text in windows of ``WINDOW`` blocks, so beside the text only the tree grows.

Output: plain, the text; psm, ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; spm,
``<S>`` suffix ``<P>`` prefix ``<M>`` middle.  ``restored`` rebuilds the text from
output and form.  No marker can arise across a cut, because no proper end of a
marker is a beginning of one.

Defined cases: a null text counts as empty; empty texts and texts that hold a marker
are plain; a null id hashes like an empty one; repeated rows each get their row;
rows with one id and several texts are cut each by its own units.  Other columns are
not read.  No rows, no output.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK, WINDOW = 4096, 256
BATCH_BYTES = 16 << 20
# The markers.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_LETTER = np.array([chr(i).isascii() and chr(i).isalpha() for i in range(256)])
_LEAD = np.array([(i & 0xC0) != 0x80 for i in range(256)])


class Fenwick:
    """Units and code points of a row of blocks, appended in order."""

    def __init__(self):
        self.tree = [(0, 0)]

    def append(self, units: int, chars: int) -> None:
        i = len(self.tree)
        low, k = i - (i & -i), i - 1
        while k > low:
            units, chars = units + self.tree[k][0], chars + self.tree[k][1]
            k -= k & -k
        self.tree.append((units, chars))

    def find(self, unit: int) -> tuple[int, int, int]:
        """(block in which ``unit`` begins, units of that block before it, code points
        before the block); the number of blocks where there is no such unit."""
        at, chars, step = 0, 0, 1 << len(self.tree).bit_length()
        while step:
            if at + step < len(self.tree) and self.tree[at + step][0] <= unit:
                at += step
                unit -= self.tree[at][0]
                chars += self.tree[at][1]
            step >>= 1
        return at, unit, chars


def marks(raw: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the bytes lo..hi begin a unit, and which a code point."""
    letter = _LETTER[raw[lo:hi]]
    after = np.empty_like(letter)
    after[1:] = letter[:-1]
    after[:1] = lo > 0 and _LETTER[raw[lo - 1]]
    lead = _LEAD[raw[lo:hi]]
    return lead & ~(letter & after), lead


def count_blocks(raw: np.ndarray, block: int = BLOCK) -> tuple[Fenwick, int]:
    """The tree over the blocks of ``raw`` and the number of units."""
    tree, n = Fenwick(), 0
    for lo in range(0, len(raw), block * WINDOW):
        hi = min(lo + block * WINDOW, len(raw))
        at = np.arange(0, hi - lo, block)
        units, chars = (np.add.reduceat(m.view(np.uint8), at, dtype=np.int64).tolist() for m in marks(raw, lo, hi))
        for u, c in zip(units, chars, strict=True):
            tree.append(u, c)
        n += sum(units)
    return tree, n


def cut(raw: np.ndarray, tree: Fenwick, unit: int, block: int = BLOCK) -> tuple[int, int]:
    """(byte, code point) at which ``unit`` begins; the end of the text for the number of units."""
    at, rest, chars = tree.find(unit)
    lo = at * block
    if lo >= len(raw):
        return len(raw), chars
    begins, lead = marks(raw, lo, min(lo + block, len(raw)))
    i = int(np.flatnonzero(begins)[rest])
    return lo + i, chars + int(np.count_nonzero(lead[:i]))


def _transform(block: int):
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        for b in batches:
            size, rows = 0, []
            ids, forms = b.column("id"), b.column("form")
            for i, (text, form, h1, h2) in enumerate(zip(b.column("text"), forms.to_pylist(), b.column("h1").to_pylist(), b.column("h2").to_pylist(), strict=True)):
                buf = text.as_buffer()
                raw = np.frombuffer(buf, dtype=np.uint8)
                tree, n = count_blocks(raw, block)
                if form == "plain":
                    rows.append((i, n, None, None, text.as_py()))
                else:
                    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
                    (pb, pc), (mb, mc) = cut(raw, tree, a, block), cut(raw, tree, z, block)
                    parts = {PREFIX: raw[:pb].tobytes(), SUFFIX: raw[mb:].tobytes(), MIDDLE: raw[pb:mb].tobytes()}
                    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
                    rows.append((i, n, pc, mc - pc, b"".join(m.encode() + parts[m] for m in order)))
                size += len(raw)
                if size >= BATCH_BYTES or i == len(ids) - 1:
                    at, n_, p, m, out = zip(*rows, strict=True)
                    at = pa.array(at)
                    yield pa.RecordBatch.from_arrays([
                        ids.take(at), pa.array(n_, pa.int64()), forms.take(at), pa.array(p, pa.int64()),
                        pa.array(m, pa.int64()), pa.array(out, pa.binary())], names)
                    size, rows = 0, []

    return run


def _draw(id_: Column, salt: str, k: int) -> Column:
    """The k-th 8-digit group of the hex hash of salt and id, as an unsigned integer."""
    h = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(h, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, salt: str = "1",
                   changed: int = 90, spm: int = 20, block: int = BLOCK) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for each row of ``docs``.

    ``changed`` per cent of the ids are cut, ``spm`` per cent of these suffix first."""
    id_, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = docs.select(id_.alias("id"), text.alias("text"))
    held = [F.contains("text", F.lit(m)) for m in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("text") == "") | held[0] | held[1] | held[2] | (_draw(F.col("id"), salt, 3) % 100 >= changed)
    form = F.when(plain, "plain").when(_draw(F.col("id"), salt, 4) % 100 < spm, "spm").otherwise("psm")
    d = d.select("id", F.col("text").cast("binary").alias("text"), form.alias("form"),
                 _draw(F.col("id"), salt, 1).alias("h1"), _draw(F.col("id"), salt, 2).alias("h2"))
    id_type = d.schema["id"].dataType.simpleString()
    out = d.mapInArrow(_transform(block), f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.select(F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", F.col("output").cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    def between(first: str, last: str) -> Column:
        return F.split_part(F.split_part(output, F.lit(first), F.lit(2)), F.lit(last), F.lit(1))

    middle = F.split_part(output, F.lit(MIDDLE), F.lit(2))
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)


def digest(r: DataFrame) -> DataFrame:
    """The registered query's columns: output and rebuilt text as hashes."""
    return r.select(*[c for c in r.columns if c != "output"], F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, len(units)::BIGINT AS n,
         least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
