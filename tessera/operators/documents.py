"""Document-collection operators over nested DataFrames.

Reads are filters / projections on struct paths (Catalyst prunes nested
columns at the Parquet scan).  Writes (set, add-to-set, pull, increment,
upsert, delete) are applied as *one batch job* from a change table
``(seq, op, student_id, value)``: changes are reduced per document by an
aggregation (bounded output per document), then merged with one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- F1
def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """nested structs become dotted top-level columns (arrays are kept)."""
    cols = []

    def walk(dt: T.DataType, path: list[str]):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                walk(f.dataType, path + [f.name])
        else:
            cols.append(F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)))

    walk(df.schema, [])
    return df.select(*cols)


# ---------------------------------------------------------------- N1-N9
def by_city(docs: DataFrame, city: str) -> DataFrame:
    """N1."""
    return docs.where(F.col("personal.city") == city)


def by_gpa_range(docs: DataFrame, lo: float, hi: float = 4.0) -> DataFrame:
    """N2."""
    return docs.where(F.col("academic.gpa").between(lo, hi))


def by_skills(docs: DataFrame, skills: list[str], require_all: bool = True) -> DataFrame:
    """``$all`` (every skill present) or ``$in`` (any)."""
    want = F.array(*[F.lit(s) for s in skills])
    if require_all:
        return docs.where(F.size(F.array_except(want, F.col("skills"))) == 0)
    return docs.where(F.arrays_overlap(F.col("skills"), want))


def project(docs: DataFrame, paths: list[str]) -> DataFrame:
    """Projection of nested paths (nested column pruning reaches the scan)."""
    return docs.select(*[F.col(p).alias(p) for p in paths])


def high_performers(docs: DataFrame, min_gpa: float = 3.5, min_attendance: int = 90) -> DataFrame:
    """N5."""
    return docs.where((F.col("academic.gpa") >= min_gpa) & (F.col("academic.attendance") >= min_attendance))


def by_project(docs: DataFrame, year: int, status: str = "Completed") -> DataFrame:
    """N6 ($elemMatch): one project element satisfies every condition."""
    return docs.where(F.exists("projects", lambda p: (p["year"] == year) & (p["status"] == status)))


def count_by_city(docs: DataFrame) -> DataFrame:
    """N7."""
    return docs.groupBy(F.col("personal.city").alias("city")).agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc())


def avg_gpa_by_city(docs: DataFrame) -> DataFrame:
    """N8."""
    g = docs.groupBy(F.col("personal.city").alias("city")).agg(
        F.avg("academic.gpa").alias("average_gpa"), F.count(F.lit(1)).alias("student_count"))
    return g.orderBy(F.col("average_gpa").desc())


def top_skills(docs: DataFrame, limit: int = 5) -> DataFrame:
    """Unwind -> group -> top-k (partial counts before the shuffle; ties by name)."""
    g = docs.select(F.explode("skills").alias("skill")).groupBy("skill").agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.col("count").desc(), "skill").limit(limit)


# ---------------------------------------------------------------- N10
# Skills flagged as features.
FLAG_SKILLS = ("Python", "SQL", "MongoDB", "Pandas", "Polars")


def add_features(flat: DataFrame) -> DataFrame:
    """Rate, five skill flags (False when skills is not a list), project count (0)."""
    out = flat
    if "academic.attendance" in flat.columns:
        out = out.withColumn("attendance_rate", F.col("`academic.attendance`") / 100)
    if "skills" in flat.columns:
        out = out.withColumns({
            f"skill_{s.lower()}": F.coalesce(F.array_contains("skills", s), F.lit(False)) for s in FLAG_SKILLS})
    if "projects" in flat.columns:
        out = out.withColumn("project_count", F.coalesce(F.size("projects"), F.lit(0)))
    return out


# ---------------------------------------------------------------- Q15
def validate_documents(docs: DataFrame) -> DataFrame:
    """Q15: required paths, types and ranges; adds ``is_valid`` and ``violations``."""
    checks: list[tuple[str, Column]] = [
        ("student_id required", F.col("student_id").isNotNull()),
        ("personal.name required", F.col("personal.name").isNotNull()),
        ("personal.city required", F.col("personal.city").isNotNull()),
        ("academic.gpa required", F.col("academic.gpa").isNotNull()),
        ("academic.gpa in [0,4]", F.coalesce(F.col("academic.gpa").between(0, 4), F.lit(True))),
        ("academic.attendance in [0,100]", F.coalesce(F.col("academic.attendance").between(0, 100), F.lit(True))),
        ("skills is an array", F.col("skills").isNotNull()),
    ]
    v = F.filter(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks]), lambda x: x.isNotNull())
    return docs.withColumn("violations", v).withColumn("is_valid", F.size("violations") == 0)


# ---------------------------------------------------------------- N11-N15
CHANGE_SCHEMA = "seq long, op string, student_id long, value string"


def apply_changes(docs: DataFrame, changes: DataFrame) -> DataFrame:
    """N11-N13 + N15 as one batch job over an ordered change table.

    ops: ``set_gpa`` (last by seq wins), ``add_skill`` / ``remove_skill`` (as
    if applied in seq order: a removal takes every copy of a skill, an addition
    appends a skill that is not there, so skills come in the order of their
    first addition after their last removal; untouched entries, repeated ones
    too, stay as stored), ``inc_attendance`` (deltas summed), ``delete``
    (removes the document).

    Per document the changes are reduced by an aggregation whose output is
    bounded by the number of distinct skills touched, then merged into the
    documents with one left join.  Adds a ``modified`` flag.
    """
    ch = changes
    gpa = ch.where(F.col("op") == "set_gpa").groupBy("student_id").agg(
        F.max_by(F.col("value").cast("double"), F.col("seq")).alias("__gpa"))
    inc = ch.where(F.col("op") == "inc_attendance").groupBy("student_id").agg(
        F.sum(F.col("value").cast("bigint")).alias("__inc"))
    pair = ["student_id", "value"]
    add, rm = F.col("op") == "add_skill", F.col("op") == "remove_skill"
    touched = ch.where((add | rm) & F.col("value").isNotNull()).select(*pair, "op", "seq")
    gone = touched.where(rm).groupBy(*pair).agg(F.max("seq").alias("__r"))
    sk = touched.join(gone, pair, "left").groupBy(*pair).agg(
        F.max("__r").alias("__r"),
        F.min(F.when(add & (F.col("__r").isNull() | (F.col("seq") > F.col("__r"))), F.col("seq"))).alias("__a"))
    skills = sk.groupBy("student_id").agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("__a").isNotNull(), F.struct("__a", "value")))),
                    lambda x: x["value"]).alias("__add"),
        F.collect_list(F.when(F.col("__r").isNotNull(), F.col("value"))).alias("__rm"))
    dele = ch.where(F.col("op") == "delete").select("student_id").distinct().withColumn("__del", F.lit(True))
    j = (docs.join(gpa, "student_id", "left").join(inc, "student_id", "left")
         .join(skills, "student_id", "left").join(dele, "student_id", "left"))
    kept = F.filter(F.coalesce("skills", F.array().cast("array<string>")),
                    lambda x: ~F.coalesce(F.array_contains(F.col("__rm"), x), F.lit(False)))
    j = j.where(F.col("__del").isNull()).withColumn("__kept", kept)
    new_skills = F.when(F.col("__add").isNull() & F.col("__rm").isNull(), F.col("skills")).otherwise(
        F.concat("__kept", F.filter("__add", lambda x: ~F.array_contains(F.col("__kept"), x))))
    new_gpa = F.coalesce("__gpa", F.col("academic.gpa"))
    new_att = F.col("academic.attendance") + F.coalesce("__inc", F.lit(0))
    changed = ((F.col("__gpa").isNotNull() & ~F.col("__gpa").eqNullSafe(F.col("academic.gpa")))
               | (F.coalesce("__inc", F.lit(0)) != 0)
               | ~F.array_sort(F.col("skills")).eqNullSafe(F.array_sort(new_skills)))
    out = j.withColumn("modified", F.coalesce(changed, F.lit(False))).withColumn("skills", new_skills).withColumn(
        "academic", F.col("academic").withField("gpa", new_gpa).withField("attendance", new_att))
    return out.drop("__gpa", "__inc", "__add", "__rm", "__kept", "__del")


def upsert(docs: DataFrame, incoming: DataFrame, key: str = "student_id", seq: str | None = None) -> DataFrame:
    """The fields of an incoming document (all its columns but ``key`` and
    ``seq``) replace the stored ones, NULL included; fields new to the store are
    added; stored fields that are not among them are kept; unknown keys are inserted.  Of several
    incoming documents of a key the one with the highest ``seq`` counts.  Adds ``_action`` in
    {'matched', 'inserted', 'unchanged'} for counting with an Observation."""
    fields = [c for c in incoming.columns if c not in (key, seq)]
    if seq is not None:
        incoming = (incoming.groupBy(key).agg(F.max_by(F.struct(*fields), seq).alias("__d"))
                    .select(key, *[F.col(f"__d.{c}").alias(c) for c in fields]))
    inc = incoming.select(key, *[F.col(c).alias(f"__n_{c}") for c in fields], F.lit(True).alias("__incoming"))
    j = docs.withColumn("__stored", F.lit(True)).join(inc, key, "full_outer")
    sel = [F.col(key)]
    for c in [*docs.columns, *[c for c in fields if c not in docs.columns]]:
        if c in fields and c in docs.columns:
            sel.append(F.when(F.col("__incoming"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c))
        elif c in fields:
            sel.append(F.col(f"__n_{c}").alias(c))
        elif c != key:
            sel.append(F.col(c))
    action = (F.when(F.col("__stored") & F.col("__incoming"), "matched")
              .when(F.col("__incoming"), "inserted").otherwise("unchanged"))
    return j.select(*sel, action.alias("_action"))


def delete_where(docs: DataFrame, condition: Column) -> DataFrame:
    """Delete by id / by city (negated filter; NULL condition keeps the row)."""
    return docs.where(~F.coalesce(condition, F.lit(False)))
