"""Licence scan by sentence rules, in DataFrame expressions only.

A text is cut into sentences; each sentence is normalised
(lower case, runs of other than letters and digits as one space) and named after
the first known licence sentence that it holds and every other licence that it names,
in text order; one without a name counts if it holds a licence word.  The names, in the order of the text,
are matched against ordered rules: a rule that finds its sequence of names
takes them out and adds its licence, so a longer or more special rule comes
before a general one.  Names that no rule took stay as ``unmatched``; licence sentences
without a known name are counted as ``unknown``.

Defined cases: a null or empty text has no sentences; null ids are kept;
repeated rows are rows like others; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words that make a sentence worth reading.
TRIGGER = (r"licen[sc]|copyright|rights reserved|public domain|permission|warrant|redistribut|spdx|merchantab|liabilit|"
           r"creative commons|cc by|cc0|unlicense|proprietary|confidential")
# Known licence sentences, special ones first, as patterns over a normalised sentence.
SENTENCES = (
    ("spdx-apache2", r"spdx licen[sc]e identifier apache 2 0"),
    ("spdx-mit", r"spdx licen[sc]e identifier mit\b"),
    ("spdx-bsd3", r"spdx licen[sc]e identifier bsd 3 clause"),
    ("spdx-bsd2", r"spdx licen[sc]e identifier bsd 2 clause"),
    ("spdx-gpl3", r"spdx licen[sc]e identifier gpl 3 0"),
    ("spdx-gpl2", r"spdx licen[sc]e identifier gpl 2 0"),
    ("spdx-lgpl", r"spdx licen[sc]e identifier lgpl"),
    ("spdx-agpl", r"spdx licen[sc]e identifier agpl"),
    ("spdx-mpl2", r"spdx licen[sc]e identifier mpl 2 0"),
    ("spdx-cc0", r"spdx licen[sc]e identifier cc0"),
    ("cc-by-nc-nd", r"\bcc by nc nd\b|creative commons attribution non ?commercial no ?deriv"),
    ("cc-by-nc-sa", r"\bcc by nc sa\b|creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", r"\bcc by nc\b|creative commons attribution non ?commercial"),
    ("cc-by-nd", r"\bcc by nd\b|creative commons attribution no ?deriv"),
    ("cc-by-sa", r"\bcc by sa\b|creative commons attribution share ?alike"),
    ("cc-by", r"\bcc by\b|creative commons attribution"),
    ("cc0", r"\bcc0\b|creative commons zero"),
    ("agpl3", r"(gnu )?affero general public licen[sc]e"),
    ("lgpl", r"(lesser|library) general public licen[sc]e"),
    ("gpl-later", r"general public licen[sc]e.*(or at your option any later version|or later)"),
    ("gpl3", r"general public licen[sc]e( version)? v?3|\bgpl ?v?3\b"),
    ("gpl2", r"general public licen[sc]e( version)? v?2|\bgpl ?v?2\b"),
    ("later-version", r"at your option any later version"),
    ("gpl", r"gnu general public licen[sc]e|\bgnu gpl\b"),
    ("mpl2", r"mozilla public licen[sc]e"),
    ("epl", r"eclipse public licen[sc]e"),
    ("apache2", r"apache licen[sc]e( version)? 2|apache 2 0 licen[sc]e"),
    ("apache", r"apache licen[sc]e"),
    ("apache-file", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-copy", r"you may obtain a copy of the licen[sc]e at"),
    ("apache-as-is", r"distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-language", r"see the licen[sc]e for the specific language governing permissions"),
    ("mit-name", r"\bmit licen[sc]e\b|licen[sc]ed under (the )?mit\b"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit-notice", r"the above copyright notice and this permission notice shall be included"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd-grant", r"redistribution and use in source and binary forms"),
    ("bsd-source", r"redistributions of source code must retain the above copyright"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright"),
    ("bsd-endorse", r"(neither the name|nor the names) .*endorse or promote"),
    ("bsd-name", r"\b(new |modified |simplified )?bsd licen[sc]e\b"),
    ("as-is", r"(is|are) provided (by .* )?as is"),
    ("no-liability", r"in no event shall"),
    ("warranty", r"without any warranty|implied warranty"),
    ("public-domain", r"public domain|unlicense"),
    ("all-rights", r"all rights reserved"),
    ("proprietary", r"proprietary|confidential"),
    ("copyright", r"\bcopyright\b"),
    ("see-licence", r"(see|refer to) (the )?(accompanying )?licen[sc]e( file)?"),
)
# Ordered rules, (sequence of sentence names, licence).
RULES = (
    (("spdx-apache2",), "Apache-2.0"), (("spdx-mit",), "MIT"), (("spdx-bsd3",), "BSD-3-Clause"), (("spdx-bsd2",), "BSD-2-Clause"),
    (("spdx-gpl3",), "GPL-3.0"), (("spdx-gpl2",), "GPL-2.0"), (("spdx-lgpl",), "LGPL"), (("spdx-agpl",), "AGPL-3.0"),
    (("spdx-mpl2",), "MPL-2.0"), (("spdx-cc0",), "CC0-1.0"),
    (("apache2", "apache-file", "apache-copy", "apache-as-is", "apache-language"), "Apache-2.0"),
    (("apache2", "apache-file", "apache-copy"), "Apache-2.0"),
    (("mit-name", "mit-grant", "mit-notice", "as-is", "no-liability"), "MIT"),
    (("mit-grant", "mit-notice", "as-is", "no-liability"), "MIT"),
    (("mit-grant", "mit-notice"), "MIT"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "as-is", "no-liability"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary", "as-is", "no-liability"), "BSD-2-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("isc-grant", "as-is", "no-liability"), "ISC"), (("isc-grant",), "ISC"),
    (("gpl3", "later-version"), "GPL-3.0-or-later"), (("gpl2", "later-version"), "GPL-2.0-or-later"), (("gpl-later",), "GPL-or-later"),
    (("cc-by-nc-nd",), "CC-BY-NC-ND"), (("cc-by-nc-sa",), "CC-BY-NC-SA"), (("cc-by-nc",), "CC-BY-NC"), (("cc-by-nd",), "CC-BY-ND"),
    (("cc-by-sa",), "CC-BY-SA"), (("cc-by",), "CC-BY"), (("cc0",), "CC0-1.0"),
    (("agpl3",), "AGPL-3.0"), (("lgpl",), "LGPL"), (("gpl3",), "GPL-3.0"), (("gpl2",), "GPL-2.0"), (("gpl",), "GPL"),
    (("mpl2",), "MPL-2.0"), (("epl",), "EPL"), (("apache2",), "Apache-2.0"), (("apache",), "Apache"),
    (("mit-name",), "MIT"), (("mit-grant",), "MIT"), (("bsd-name",), "BSD"), (("public-domain",), "Public-Domain"),
    (("all-rights",), "All-Rights-Reserved"), (("proprietary",), "Proprietary"),
)
# Licences by what they allow, the strictest first.
CLASSES = (
    ("restricted", ("All-Rights-Reserved", "Proprietary")),
    ("noncommercial", ("CC-BY-NC", "CC-BY-NC-ND", "CC-BY-NC-SA", "CC-BY-ND")),
    ("copyleft", ("AGPL-3.0", "GPL", "GPL-2.0", "GPL-3.0", "GPL-2.0-or-later", "GPL-3.0-or-later", "GPL-or-later", "LGPL", "MPL-2.0", "EPL", "CC-BY-SA")),
    ("permissive", ("Apache", "Apache-2.0", "MIT", "BSD", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC-BY", "CC0-1.0", "Public-Domain")),
)
# Each known licence sentence and licence word holds one of these as it stands in the text; the rest is not normalised.
HINT = (rf"{TRIGGER}|cc[^a-z0-9]+by|gpl|creative|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved|endorse[^a-z0-9]+or|provided|in[^a-z0-9]+no[^a-z0-9]+event|"
        r"at[^a-z0-9]+your[^a-z0-9]+option")
# General names that a more exact name in the same sentence covers.
COVERED = {"gpl": ("gpl2", "gpl3", "gpl-later"), "apache": ("apache2",)}
CUT = r"([.;!?])\s+|\n\s*\n"


def _token(name: str) -> str:
    return f"<{name}>"


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_sentences (known ones and those with a licence word), n_unknown,
    sequence (names in order), licenses, unmatched (comma-joined strings) and
    license_class (of the strictest licence; ``unknown`` if there are only
    sentences without a rule, ``none`` if there are no sentences)."""
    known = "|".join([TRIGGER, *(p for _, p in SENTENCES)])
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.when(F.lower(t).rlike(HINT), t).alias("t"))
    parts = F.split(F.regexp_replace("t", CUT, "$1\n\n"), "\n\n", -1)
    hinted = F.filter(F.transform(parts, F.lower), lambda s: s.rlike(HINT))
    hits = F.filter(F.transform(hinted, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))), lambda s: s.rlike(known))
    d = d.select("id", F.coalesce(hits, F.array().cast("array<string>")).alias("s"))

    single = {r[0] for r, _ in RULES if len(r) == 1}
    mark = {n: chr(0xE000 + i) for i, (n, _) in enumerate(SENTENCES)}

    def first(s):
        c = F.when(s.rlike(SENTENCES[0][1]), mark[SENTENCES[0][0]])
        for n, p in SENTENCES[1:]:
            c = c.when(s.rlike(p), mark[n])
        return c.otherwise("")

    def licences(s):
        # each name becomes one mark in its place, so that names do not overlap, special ones first
        for n, p in SENTENCES:
            if n in single:
                # what stands between the two ends of a name can hold others
                head, gap, tail = p.partition(".*(")
                s = F.regexp_replace(s, f"{head}(.*?)({tail}" if gap else p, mark[n] + ("$1" if gap else ""))
        return s

    def place(x):
        c = F.when(F.lit(False), "")
        for n, p in SENTENCES:
            if n not in single:
                c = c.when(x["first"] == mark[n], F.regexp_replace(x["marked"], p, mark[n]))
        return F.struct(x["first"].alias("first"), F.array_distinct(F.regexp_extract_all(c.otherwise(x["marked"]), F.lit("([\uE000-\uF8FF])"))).alias("found"))

    def chosen(x):
        lost = (x["first"] != "") & ~F.array_contains(x["found"], x["first"])
        covered = [F.when(F.arrays_overlap(x["found"], F.array(*[F.lit(mark[e]) for e in exact])), mark[n]).otherwise("") for n, exact in COVERED.items()]
        return F.concat(F.when(lost, F.array(x["first"])).otherwise(F.array().cast("array<string>")), F.array_except(x["found"], F.array(*covered)))

    token = F.create_map(*[F.lit(x) for n, m in mark.items() for x in (m, _token(n))])
    d = d.select("id", F.size("s").cast("long").alias("n_sentences"), F.transform("s", lambda s: F.struct(first(s).alias("first"), licences(s).alias("marked"))).alias("names"))
    d = d.withColumn("names", F.transform(F.transform("names", place), chosen))
    d = d.withColumn("names", F.transform("names", lambda f: F.array_join(F.transform(f, lambda m: token[m]), "")))
    d = d.withColumn("seq", F.array_join("names", ""))
    rules = F.array(*[F.struct(F.lit("".join(map(_token, r))).alias("find"), F.lit(licence).alias("licence")) for r, licence in RULES])
    start = F.struct(F.col("seq").alias("seq"), F.array().cast("array<string>").alias("found"))
    state = F.aggregate(rules, start, lambda acc, r: F.when(F.contains(acc["seq"], r["find"]), F.struct(
        F.replace(acc["seq"], r["find"], F.lit("")).alias("seq"), F.array_union(acc["found"], F.array(r["licence"])).alias("found"))).otherwise(acc))
    d = d.withColumn("st", F.when(F.col("seq") == "", start).otherwise(state))

    def listed(c):
        return F.replace(F.replace(F.replace(c, F.lit("><"), F.lit(",")), F.lit("<"), F.lit("")), F.lit(">"), F.lit(""))

    found = F.col("st.found")
    cls = None
    for c, names in CLASSES:
        hit = F.arrays_overlap(found, F.array(*map(F.lit, names)))
        cls = F.when(hit, c) if cls is None else cls.when(hit, c)
    cls = cls.when(F.col("n_sentences") > 0, "unknown").otherwise("none")
    return d.select(F.col("id").alias(id_col), "n_sentences", F.size(F.filter("names", lambda n: n == "")).cast("long").alias("n_unknown"),
                    listed(F.col("seq")).alias("sequence"), F.array_join(found, ",").alias("licenses"),
                    listed(F.col("st.seq")).alias("unmatched"), cls.alias("license_class"))


def oracle() -> str:
    """The scan in DuckDB SQL, from the same fixed values: sentences are normalised and looked up one
    by one, and their names put together again in the order of the text."""
    known = "|".join([TRIGGER, *(p for _, p in SENTENCES)])
    single = {r[0] for r, _ in RULES if len(r) == 1}
    mark = {n: chr(0xE000 + i) for i, (n, _) in enumerate(SENTENCES)}
    first = " ".join(f"WHEN regexp_matches(s, '{p}') THEN '{mark[n]}'" for n, p in SENTENCES)
    place = " ".join(f"WHEN first = '{mark[n]}' THEN regexp_replace(marked, '{p}', '{mark[n]}', 'g')" for n, p in SENTENCES if n not in single)
    marked, tokens = "s", "array_to_string(l, '')"
    for n, p in SENTENCES:
        head, gap, tail = p.partition(".*(")
        if n in single:
            marked = f"regexp_replace({marked}, '{f'{head}(.*?)({tail}' if gap else p}', '{mark[n]}{chr(92) + '1' if gap else ''}', 'g')"
        tokens = f"replace({tokens}, '{mark[n]}', '{_token(n)}')"
    covered = " ".join(f"AND NOT (m = '{mark[n]}' AND list_has_any(found, [{', '.join(f"'{mark[e]}'" for e in exact)}]))" for n, exact in COVERED.items())
    sql = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    p AS (SELECT rid, [trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))
            FOR x IN string_split(regexp_replace(t, '{CUT.replace(chr(92) + "s", "[ " + chr(92) + "x09-" + chr(92) + "x0D]")}', '\\1' || chr(10) || chr(10), 'g'), chr(10) || chr(10))
            IF regexp_matches(lower(x), '{HINT}')] AS s FROM d),
    e AS (SELECT rid, generate_subscripts(s, 1) AS i, unnest(s) AS s FROM p),
    f AS (SELECT rid, i, CASE {first} ELSE '' END AS first, {marked} AS marked FROM e WHERE regexp_matches(s, '{known}')),
    g AS (SELECT rid, i, first, regexp_extract_all(CASE {place} ELSE marked END, '[{chr(0xE000)}-{chr(0xF8FF)}]') AS twice FROM f),
    h AS (SELECT rid, i, first, list_filter(twice, lambda m, k: list_position(twice, m) = k) AS found FROM g),
    o AS (SELECT rid, i, list_concat(CASE WHEN first <> '' AND NOT list_contains(found, first) THEN [first] ELSE [] END,
                                     list_filter(found, lambda m: true {covered})) AS l FROM h),
    a AS (SELECT rid, list({tokens} ORDER BY i) AS names FROM o GROUP BY rid),
    n AS (SELECT doc_id, coalesce(names, CAST([] AS VARCHAR[])) AS names, CAST(len(coalesce(names, [])) AS BIGINT) AS n_sentences FROM d LEFT JOIN a USING (rid)),
    r0 AS (SELECT *, coalesce(array_to_string(names, ''), '') AS seq, CAST([] AS VARCHAR[]) AS found, coalesce(array_to_string(names, ''), '') AS rest FROM n)"""
    for i, (r, licence) in enumerate(RULES):
        f = "".join(map(_token, r))
        sql += f""",
    r{i + 1} AS (SELECT doc_id, n_sentences, names, seq, CASE WHEN contains(rest, '{f}') AND NOT list_contains(found, '{licence}') THEN list_append(found, '{licence}') ELSE found END AS found,
      replace(rest, '{f}', '') AS rest FROM r{i})"""
    listed = "replace(replace(replace({0}, '><', ','), '<', ''), '>', '')"
    cls = " ".join(f"WHEN list_has_any(found, [{', '.join(repr(x) for x in names)}]) THEN '{c}'" for c, names in CLASSES)
    return sql + f"""
    SELECT doc_id, n_sentences, CAST(len([x FOR x IN names IF x = '']) AS BIGINT) AS n_unknown, {listed.format('seq')} AS sequence,
      coalesce(array_to_string(found, ','), '') AS licenses, {listed.format('rest')} AS unmatched,
      CASE {cls} WHEN n_sentences > 0 THEN 'unknown' ELSE 'none' END AS license_class FROM r{len(RULES)}"""
