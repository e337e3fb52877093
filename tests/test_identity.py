"""Entity resolution (I2): ids by first appearance, and no table of keys on the driver."""

from pyspark.sql import functions as F

from tessera.operators.identity import resolve_entities


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_follow_the_first_appearance_and_nulls_are_values(spark):
    df = spark.createDataFrame([("b", None, 3), ("a", "x", 5), ("b", None, 9), ("a", None, 4), (None, None, 0)],
                               "k string, l string, pos long")
    got = {r.pos: r.student_id for r in resolve_entities(df, ["k", "l"], "pos").collect()}
    assert got == {0: "S0000", 3: "S0001", 9: "S0001", 4: "S0002", 5: "S0003"}


def test_no_table_of_keys_is_broadcast(spark):
    """The keys of a compact file would pass Spark's size limit for a broadcast, but are wide in memory."""
    df = spark.range(2000).select((F.col("id") % 700).cast("string").alias("k"), F.lit("same").alias("l"), F.col("id").alias("pos"))
    assert not [x for x in _plan(resolve_entities(df, ["k", "l"], "pos")).splitlines()
                if "BroadcastHashJoin" in x and "__k0" in x]


def test_course_rows_do_not_broadcast_the_customers(spark):
    from tessera.sources.uci import uci_course_frame

    from .conftest import SF_SMALL

    assert "BroadcastHashJoin" not in _plan(uci_course_frame(spark, SF_SMALL, "mat"))
