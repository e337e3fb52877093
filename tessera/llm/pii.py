"""PII: information-theoretic sanitisation, in DataFrame expressions only.

Patterns find the protected entities (e-mail and IP addresses, card and phone
numbers).  A word then discloses an entity if the corpus says so: with p(e) the
share of all words that stand in lines with entity e and p(e|t) the share of
the occurrences of term t that do, t tells PMI(t, e) = log2(p(e|t) / p(e))
bits of the IC(e) = -log2 p(e) bits that identify e.  A term is generalised where
PMI >= ``disclose`` * IC and removed from ``remove`` * IC on, in every text that holds it.  Any
token with a letter or digit can be a term, handles, hyphenated and short names and account
numbers too, unless it is a protected entity of that line or a part of one.  Only
pairs met in at least ``support`` different neighbourhoods (words to the left and right) count,
so copies of one line are no evidence.

Defined cases: a null text counts as empty; null ids are kept; rows equal in id
and text get equal results; other columns are not read.  No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, materialise, text_key

KINDS = ("email", "ip", "card", "phone")
# The leftmost non-overlapping matches of the plain patterns; possessive and
# anchored at the start of a run, so that a long run is read once.
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HOLDS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": "+"}
MASK = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
GENERAL, REMOVED = "<TERM>", "<REMOVED>"
# what stands between two tokens: no letter, digit or inner mark of an address
BETWEEN = r"(?:[^\p{L}\p{N}@._%+-]|[._%+-](?![\p{L}\p{N}@]))++"
TERM = r"[\p{L}\p{N}]"

SPAN = "array<struct<start:int,end:int,value:string>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + F.when((F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int"))
        .otherwise((F.substring(digits, i, F.lit(1)).cast("int") * 2) % 10 + F.floor(F.substring(digits, i, F.lit(1)).cast("int") / 5).cast("int")))
    return total % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def found(text: Column, kind: str) -> Column:
    """Spans of a kind in code points: the text is split at the matches, and the
    lengths of pieces and matches in turn give the places."""
    pattern = PATTERN[kind]
    values, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc, pair):
        lo = acc["at"] + F.length(pair["piece"])
        hi = lo + F.length(pair["value"])
        span = F.struct(lo.alias("start"), hi.alias("end"), pair["value"].alias("value"))
        return F.struct(hi.alias("at"), F.when(_passes(kind, pair["value"]), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    pairs = F.zip_with(values, F.slice(pieces, F.lit(1), F.size(values)), lambda v, p: F.struct(v.alias("value"), p.alias("piece")))
    holds = F.contains(text, F.lit(HOLDS[kind])) if kind in ("email", "phone") else text.rlike(HOLDS[kind])
    return F.when(holds, F.aggregate(pairs, start, step, lambda acc: acc["spans"])).otherwise(F.array().cast(SPAN))


def _joined(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def base_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, email, ip, card, phone, lines): spans by kind, and the lines that hold one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("t")).select("id", "t", text_key(F.col("t")).alias("key"))
    d = d.select("id", "key", "t", *[found(F.col("t"), k).alias(k) for k in KINDS])
    some = F.lit(False)
    for k in KINDS:
        some = some | (F.size(k) > 0)
    lines = F.filter(F.split("t", "\n", -1), _any)
    return d.select("id", "key", *KINDS, F.when(some, lines).otherwise(F.array().cast("array<string>")).alias("lines"))


def _any(s: Column) -> Column:
    c = F.contains(s, F.lit("@")) | F.contains(s, F.lit("+"))
    return c | s.rlike(HOLDS["ip"]) | s.rlike(HOLDS["card"])


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), BETWEEN, -1), lambda w: w != "")


def _entities(line: Column, kind: str) -> Column:
    return F.transform(found(line, kind), lambda s: F.concat(F.lit(f"{kind}:"), F.lower(s["value"])))


def _masks(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(MASK[kind]).alias("mask")))


def joint_counts(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((entity, term, together, support), (entity, words)): occurrences of a
    term in lines with an entity, their different neighbourhoods, and the words of those lines."""
    line = base.where(F.size("lines") > 0).select(F.explode("lines").alias("line"))
    ent = F.concat(*[_entities(F.col("line"), k) for k in KINDS])
    line = line.select(tokens(F.col("line")).alias("w"), F.array_distinct(ent).alias("entities"))
    named = F.flatten(F.transform("entities", lambda e: tokens(F.substring_index(e, ":", -1))))     # no entity holds a colon
    line = line.select("w", named.alias("named"), F.explode("entities").alias("entity"))
    words = line.groupBy("entity").agg(F.sum(F.size("w")).alias("words"))
    term = F.transform("w", lambda t, i: F.struct(t.alias("term"), F.xxhash64(F.get("w", i - 1), F.get("w", i + 1)).alias("near")))
    term = F.filter(term, lambda x: ~F.array_contains("named", x["term"]))
    pairs = line.select("entity", F.explode(term).alias("p")).select("entity", "p.term", "p.near").where(F.col("term").rlike(TERM))
    pairs = pairs.groupBy("entity", "term", "near").agg(F.count("*").alias("n"))
    return pairs.groupBy("entity", "term").agg(F.sum("n").alias("together"), F.count("*").alias("support")), words


def disclosing_terms(docs: DataFrame, base: DataFrame, text_col: str, disclose: float, remove: float, support: int) -> DataFrame | None:
    """(term, action) of the terms that exceed the threshold for some entity; None if no pair has the support."""
    pairs, words = joint_counts(base)
    pairs = materialise(pairs.where(F.col("support") >= support).join(words, "entity"), "pairs")
    if pairs.isEmpty():
        return None
    wanted = materialise(pairs.select(F.col("term").alias("_w")).distinct(), "terms")
    # one pass over the corpus: the word count of every text, and the occurrences of the wanted terms
    w = docs.select(tokens(F.col(text_col)).alias("w")).select(F.explode("w").alias("term"))
    per = w.groupBy("term").agg(F.count("*").alias("n"))
    per = materialise(per.join(broadcast_if_small(wanted), F.col("term") == F.col("_w"), "left")
                      .groupBy(F.col("_w").alias("term")).agg(F.sum("n").alias("all")), "counts")
    total = per.agg(F.sum("all")).first()[0] or 1
    p = pairs.join(per.where("term IS NOT NULL"), "term")
    ic = F.log2(F.lit(float(total)) / F.col("words"))
    pmi = F.log2(F.col("together") * F.lit(float(total)) / (F.col("all") * F.col("words")))
    p = p.withColumn("ratio", F.when(ic > 0, pmi / ic).otherwise(0.0)).where(F.col("ratio") >= disclose)
    return materialise(p.groupBy("term").agg(F.max("ratio").alias("ratio"))
                       .select("term", F.when(F.col("ratio") >= remove, "remove").otherwise("generalise").alias("action")), "disclosing")


def term_spans(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame) -> DataFrame:
    """(id, key, terms): places of the disclosing terms in every text that holds one, by start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), text.alias("t"), text_key(F.col(text_col)).alias("key"))
    names = terms.select(F.col("term").alias("_w"), "action")
    hits = (d.select("id", "key", F.explode(F.array_distinct(tokens(F.col("t")))).alias("term"))
            .join(broadcast_if_small(names), F.col("term") == F.col("_w")).groupBy("id", "key").agg(F.collect_set(F.struct("term", "action")).alias("hits")))
    hits = materialise(hits, "hits")
    d = d.join(broadcast_if_small(hits.select(F.col("id").alias("_i"), F.col("key").alias("_k"), "hits"), 20_000),
               F.col("id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k"))).select("id", "key", "t", F.explode("hits").alias("h"))
    # no token holds a backslash, so the quoting can't end early
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}@._%+-])\Q"), F.col("h.term"), F.lit(r"\E(?![\p{L}\p{N}@]|[._%+-][\p{L}\p{N}@])"))
    d = d.select("id", "key", "h", F.split("t", pattern, -1).alias("p"), F.regexp_extract_all("t", pattern, F.lit(0)).alias("v"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,action:string>>").alias("spans"))

    def step(acc, x):
        lo = acc["at"] + F.length(x["piece"])
        hi = lo + F.length(x["value"])
        return F.struct(hi.alias("at"), F.concat(acc["spans"], F.array(F.struct(lo.alias("start"), hi.alias("end"), F.col("h.action").alias("action")))).alias("spans"))

    pairs = F.zip_with("v", F.slice("p", F.lit(1), F.size("v")), lambda v, p: F.struct(v.alias("value"), p.alias("piece")))
    d = d.select("id", "key", F.explode(F.aggregate(pairs, start, step, lambda acc: acc["spans"])).alias("s"))
    return d.groupBy("id", "key").agg(F.array_sort(F.collect_set("s")).alias("terms"))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclose: float = 0.9, remove: float = 0.97, support: int = 3) -> DataFrame:
    """One row per document: id, key (of the text), email, ip, card, phone, terms (arrays of spans by start)."""
    base = materialise(base_spans(docs, id_col, text_col), "base")
    terms = disclosing_terms(docs, base, text_col, disclose, remove, support)
    base = base.drop("lines")
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    if terms is None or terms.isEmpty():
        return base.withColumn("terms", none)
    at = materialise(term_spans(docs, id_col, text_col, terms).select(F.col("id").alias("_i"), F.col("key").alias("_k"), "terms"), "spans")
    return (base.join(broadcast_if_small(at, 20_000), F.col("id").eqNullSafe(F.col("_i")) & (F.col("key") == F.col("_k")), "left")
            .select("id", "key", *KINDS, F.coalesce("terms", none).alias("terms")))


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The spans of ``pii_spans`` as counts, a hash of the base spans and one string of all."""
    base = F.concat_ws(",", *[_joined(k, F.col(k)) for k in KINDS])
    every = F.concat_ws(",", *[_joined(k, F.col(k)) for k in KINDS], _joined("term", F.col("terms")))
    return spans.select(F.col("id").alias(id_col), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with entities masked by kind and disclosing terms generalised or
    removed in the texts; overlapping spans are taken from the leftmost on."""
    s = pii_spans(docs, id_col, text_col, **params)
    every = F.array_sort(F.concat(
        *[_masks(k) for k in KINDS],
        F.transform("terms", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(x["action"] == "remove", REMOVED).otherwise(GENERAL).alias("mask")))))
    s = materialise(s.select(F.col("id").alias("_i"), F.col("key").alias("_k"), every.alias("_spans")).where(F.size("_spans") > 0).dropDuplicates(["_i", "_k"]), "masks")
    d = docs.join(broadcast_if_small(s, 20_000), docs[id_col].eqNullSafe(F.col("_i")) & (text_key(docs[text_col]) == F.col("_k")), "left")
    t = F.col(f"`{text_col}`")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        return F.when(x["start"] < acc["at"], acc).otherwise(F.struct(
            x["end"].alias("at"), F.concat(acc["out"], F.substring(t, acc["at"] + 1, x["start"] - acc["at"]), x["mask"]).alias("out")))

    clean = F.aggregate("_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    return d.select(*[F.coalesce(clean, t).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
