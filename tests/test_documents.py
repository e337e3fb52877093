"""Document operators on the reference's demo change script (FIXTURES.md §3)."""

from tessera.operators import documents as D

DOC_SCHEMA = ("student_id long, personal struct<name:string,age:bigint,city:string,country:string>, "
              "skills array<string>, academic struct<gpa:double,attendance:bigint>, "
              "projects array<struct<name:string,year:bigint,status:string,technologies:array<string>>>")


def _docs(spark):
    rows = [
        (1001, ("Ahmed Ali", 22, "Sanaa", "Yemen"), ["Python", "SQL", "MongoDB"], (3.5, 92),
         [("AI Pipeline", 2026, "Completed", ["Python", "PostgreSQL"])]),
        (1003, ("Khaled Hassan", 23, "Ibb", "Yemen"), ["Java", "Spring Boot"], (3.1, 88), []),
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def test_reads(spark):
    docs = _docs(spark)
    assert [r.student_id for r in D.by_skills(docs, ["Python", "SQL"]).collect()] == [1001]
    assert D.by_skills(docs, ["Java", "Rust"], require_all=False).count() == 1
    assert [r.student_id for r in D.by_project(docs, 2026).collect()] == [1001]
    flat = D.flatten(docs)
    assert "personal.city" in flat.columns and "academic.gpa" in flat.columns
    feats = D.add_features(flat).orderBy("student_id").collect()
    assert feats[0].skill_python and not feats[1].skill_python and feats[1].project_count == 0


def test_change_script(spark):
    docs = _docs(spark)
    changes = spark.createDataFrame([
        (1, "set_gpa", 1001, "3.75"), (2, "add_skill", 1001, "Docker"), (3, "add_skill", 1001, "Docker"),
        (4, "remove_skill", 1001, "MongoDB"), (5, "inc_attendance", 1001, "3"), (6, "delete", 1003, None),
    ], D.CHANGE_SCHEMA)
    out = D.apply_changes(docs, changes).collect()
    assert len(out) == 1
    d = out[0]
    assert d.academic.gpa == 3.75 and d.academic.attendance == 95
    assert d.skills == ["Python", "SQL", "Docker"] and d.modified


def test_skill_changes_keep_order_and_stored_repeats(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b", "c"], (3.0, 90)), (2, ["z", "z"], (3.0, 90)), (3, [], (3.0, 90))],
                                 "student_id long, skills array<string>, academic struct<gpa:double,attendance:bigint>")
    ops = [(1, "add_skill", 1, "y"), (2, "add_skill", 1, "x"), (3, "add_skill", 1, "y"), (4, "remove_skill", 1, "c"),
           (5, "add_skill", 1, "c"), (6, "add_skill", 1, "a"), (7, "remove_skill", 1, "x"), (8, "add_skill", 1, "d"),
           (9, "add_skill", 2, "z"), (10, "add_skill", 3, "q"), (11, "remove_skill", 3, "q"), (12, "add_skill", 1, None)]
    got = {r.student_id: (r.skills, r.modified) for r in D.apply_changes(docs, spark.createDataFrame(ops, D.CHANGE_SCHEMA)).collect()}

    def plain(skills, sid):
        out = list(skills)
        for _, op, s, v in ops:
            if s == sid and v is not None:
                out = [x for x in out if x != v] if op == "remove_skill" else out if v in out else [*out, v]
        return out

    for r in docs.collect():
        want = plain(r.skills, r.student_id)
        assert got[r.student_id] == (want, sorted(want) != sorted(r.skills))


def test_upsert(spark):
    docs = _docs(spark)
    inc = spark.createDataFrame([(2001, ("New", 20, "Taiz", "Yemen"))],
                                "student_id long, personal struct<name:string,age:bigint,city:string,country:string>")
    out = {r.student_id: r._action for r in D.upsert(docs, inc).collect()}
    assert out == {1001: "unchanged", 1003: "unchanged", 2001: "inserted"}


def test_upsert_sets_null_adds_fields_and_takes_the_last(spark):
    docs = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "student_id int, name string, n int")
    inc = spark.createDataFrame([(1, "x", "e0", 1), (1, None, "e1", 2), (3, "c", "e3", 1)], "student_id int, name string, email string, seq int")
    got = sorted(tuple(r) for r in D.upsert(docs, inc, seq="seq").collect())
    assert got == [(1, None, 5, "e1", "matched"), (2, "b", 6, None, "unchanged"), (3, "c", None, "e3", "inserted")]


def test_collection_scan_holds_only_the_asked_paths(spark):
    """Nested columns are pruned and nested filters are pushed to the landed files."""
    from tessera.plans.registry import REGISTRY
    import tessera.plans.corpus_documents  # noqa: F401

    from .conftest import SF_SMALL

    def plan(key):
        df = REGISTRY[key].build(spark, SF_SMALL)
        return df._jdf.queryExecution().executedPlan().toString()

    n4 = plan("N4_projection")
    assert "ReadSchema: struct<student_id:bigint,personal:struct<name:string>,academic:struct<gpa:double>>" in n4
    assert "Join" not in n4 and "Exchange" not in n4
    assert "EqualTo(personal.city" in plan("N1_by_city") and "GreaterThanOrEqual(academic.gpa" in plan("N5_high_performers")


def test_collection_reads_its_lines_once_and_keeps_orders_without_lines(spark, tmp_path):
    from pyspark.sql import functions as F

    from tessera.sources.documents import student_documents

    from .conftest import SF_SMALL

    plan = student_documents(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey") and len([x for x in plan.splitlines() if "Relation" in x and "l_partkey" in x]) == 1
    ts = "timestamp '1994-03-01 00:00:00'"
    tables = {
        "region": "SELECT 0 r_regionkey, 'R' r_name", "nation": "SELECT 0 n_nationkey, 'N' n_name, 0 n_regionkey",
        "customer": "SELECT id c_custkey, 'c' c_name, 0 c_nationkey, 5.0D c_acctbal FROM range(3)",
        "part": "SELECT * FROM VALUES (0L, 'LARGE'), (1L, 'odd'), (2L, NULL) t(p_partkey, p_type)",
        "orders": f"""SELECT *, {ts} o_orderdate FROM VALUES (0L, 0L, 'F', '1'), (1L, 0L, 'O', NULL), (2L, 1L, 'F', '2'),
                      (3L, 0L, 'F', '1') t(o_orderkey, o_custkey, o_orderstatus, o_orderpriority)""",
        "lineitem": "SELECT * FROM VALUES (0L, 0L), (0L, 0L), (1L, 1L), (3L, 2L) t(l_orderkey, l_partkey)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r.student_id: (r.skills, [(p.name, p.year, p.status, p.technologies) for p in r.projects])
           for r in student_documents(spark, str(tmp_path)).orderBy(F.col("student_id")).collect()}
    assert got == {0: (["MongoDB", "odd"], [(None, 1994, "In Progress", []), ("1", 1994, "Completed", ["MongoDB"])]),
                   1: ([], [("2", 1994, "Completed", [])]), 2: ([], [])}


def test_no_table_that_grows_is_broadcast_for_the_collection(spark):
    """Parts of compact files would pass Spark's size limit for a broadcast, and go whole through the driver."""
    from tessera.sources.documents import student_documents

    from .conftest import SF_SMALL

    plan = student_documents(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin" in x]
    assert joins and not [x for x in joins if any(k in x for k in ("partkey", "orderkey", "custkey"))]
