"""Readers on malformed input and sinks (reference test strategy: malformed
input, verification, refusal of empty output)."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.sinks import writers as W
from tessera.sources import readers as R
from tessera.sources.tables import load_tables, missing_tables

from .conftest import SF_SMALL


def test_csv_preflight_and_headers(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        R.read_csv(spark, str(tmp_path / "absent.csv"))
    p = tmp_path / "s.csv"
    p.write_text(" Student_ID ,NAME\n1,Ann\n2,Bo\n")
    df = R.normalize_headers(R.read_csv(spark, str(p), all_strings=True))
    assert df.columns[:2] == ["student_id", "name"] and df.count() == 2
    empty = tmp_path / "e.csv"
    empty.write_text("a,b\n")
    with pytest.raises(ValueError):
        R.read_csv(spark, str(empty), all_strings=True)


def test_json_array_and_lines(spark, tmp_path):
    arr = tmp_path / "a.json"
    arr.write_text(json.dumps([{"student_id": 1, "gpa": 3.25}, {"student_id": 2, "gpa": 2.5}]))
    df = R.read_json(spark, str(arr), "student_id long, gpa double", multiline_array=True)
    assert df.count() == 2
    lines = tmp_path / "l.json"
    lines.write_text('{"student_id": 3, "gpa": 1.0}\n{"student_id": 4, "gpa": 2.0}\n')
    assert R.read_json(spark, str(lines), "student_id long, gpa double").count() == 2


def test_api_pages_stop_at_empty_page_and_cache(spark, tmp_path):
    pages = [{"page": 0, "users": [{"id": 1, "firstName": " Ann", "lastName": None, "age": 20,
                                    "address": {"city": "Aden"}}, {"id": 2, "firstName": "Bo", "lastName": "Li"}]},
             {"page": 1, "users": []},
             {"page": 2, "users": [{"id": 9, "firstName": "Late"}]}]
    d = tmp_path / "pages"
    d.mkdir()
    (d / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    users = R.read_api_pages(spark, str(d))
    assert [r.id for r in users.orderBy("ingest_ord").collect()] == [1, 2]
    from tessera.operators.clean import api_user_mapping

    m = {r.student_id: r for r in api_user_mapping(users).collect()}
    assert m[1].name == "Ann" and m[1].city == "Aden" and m[2].name == "Bo Li" and m[2].city is None
    assert R.read_api_pages(spark, str(tmp_path / "none"), cache_path=str(d)).count() == 2
    with pytest.raises(FileNotFoundError):
        R.read_api_pages(spark, str(tmp_path / "none"), cache_path=str(tmp_path / "none2"))


def test_html_table_parser_robustness(spark):
    html = ('<table id="students"><tbody>'
            "<tr><td>1</td><td>  Ali   Hassan </td><td>20.9</td><td>3.5</td><td>90</td><td>sanaa</td></tr>"
            "<tr><td>2</td><td>Short</td><td>21</td><td>3.1</td><td>88</td></tr>"
            "<tr><td>3</td><td>Bad</td><td>x</td><td>n/a</td><td></td><td>al-ain</td></tr>"
            '</tbody></table><table id="other"><tbody><tr>' + "<td>9</td>" * 6 + "</tr></tbody></table>")
    pages = spark.createDataFrame([(0, "u", html)], "page_id long, url string, html string")
    rows = {r.student_id: r for r in R.parse_table_rows(pages).collect()}
    assert set(rows) == {1, 3}
    assert rows[1].name == "Ali Hassan" and rows[1].age == 20 and rows[1].city == "Sanaa"
    assert rows[3].age is None and rows[3].gpa is None and rows[3].attendance is None and rows[3].city == "Al-Ain"
    with pytest.raises(ValueError):
        R.require_rows(R.parse_table_rows(pages, "missing"), "missing table")


def test_table_set_checks(spark):
    assert missing_tables(spark, SF_SMALL, ["customer", "nope"]) == ["nope"]
    with pytest.raises(FileNotFoundError):
        load_tables(spark, SF_SMALL, ["customer", "nope"])


def test_sinks(spark, tmp_path):
    df = spark.range(10).withColumn("student_id", F.col("id"))
    assert W.write_csv(df, str(tmp_path / "c"), verify=True) == 10
    assert W.write_parquet(df, str(tmp_path / "p"), compression="zstd") == 10
    with pytest.raises(ValueError):
        W.write_parquet(df.where("id < 0"), str(tmp_path / "e"))
    with pytest.raises(ValueError):
        W.write_parquet(df, str(tmp_path / "x"), compression="rar")
    with pytest.raises(ValueError):
        W.save_table(df, "bad-name; drop")
    cmp = W.compare_formats(spark, str(tmp_path / "c"), str(tmp_path / "p")).first()
    assert cmp.csv_bytes > 0 and cmp.parquet_bytes > 0
    st = W.storage_stats(spark, str(tmp_path / "p")).first()
    assert st.rows == 10 and st.columns == 2


def test_a_source_partition_leaves_the_others(spark, tmp_path):
    from tessera.sinks import writers as W

    root = str(tmp_path / "clean")
    for source, n in (("csv", 3), ("api", 2), ("csv", 4)):
        W.write_source_partition(spark.range(n), root, source)
    got = {r.source: r["count"] for r in spark.read.parquet(root).groupBy("source").count().collect()}
    assert got == {"csv": 4, "api": 2}


def test_metrics_have_six_plain_decimals(spark, tmp_path):
    from tessera.sinks import writers as W

    folds = spark.createDataFrame([(1, 1234.567), (2, None)], "fold int, mae double")
    W.write_metrics(folds, folds, str(tmp_path))
    got = {r.fold: r.mae for r in spark.read.option("header", True).csv(str(tmp_path / "fold_metrics")).collect()}
    assert got == {"1": "1234.567000", "2": None}


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(500).select((F.col("id") % 90).alias("student_id"), "id")
    W.save_table(rows, "k3_left", buckets=4, path=str(tmp_path / "l"))
    W.save_table(spark.range(120).withColumnRenamed("id", "student_id"), "k3_right", buckets=4, path=str(tmp_path / "r"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per = spark.table("k3_left").join(spark.table("k3_right"), "student_id").groupBy("student_id").count()
        plan = per._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert per.count() == 90
        files = [f for f in (tmp_path / "l").iterdir() if f.name.startswith("part-")]
        assert len(files) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in ("k3_left", "k3_right"):
            spark.sql(f"DROP TABLE {n}")


def test_json_arrays_lose_one_bad_element_alone(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('[{"a": 1, "b": "x"}, "text", {"a": "no"}, null, {"b": "y"}]\n\n[]\n{"a": 5}\nbroken [\n')
    good, bad = R.read_json_arrays(spark, str(tmp_path / "lines"), "a long, b string")
    assert sorted(map(tuple, good.select("a", "b").collect()), key=str) == [(1, "x"), (5, None), (None, "y")]
    assert sorted(str(r.element) for r in bad.collect()) == ["None", "broken [", "text", '{"a":"no"}']
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "b.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    good, bad = R.read_json_arrays(spark, str(tmp_path / "file"), "a long", whole_files=True)
    assert [r.a for r in good.orderBy("ingest_ord").collect()] == [1, 2] and bad.count() == 0
    with pytest.raises(FileNotFoundError):
        R.read_json_arrays(spark, str(tmp_path / "nope"), "a long")
