from pyspark.sql import functions as F

from millrace.operators.index import row_index
from millrace.operators.latest import latest_by_key


def test_row_index_is_like_zip_with_index(spark):
    df = spark.range(10_000, numPartitions=5).select(F.col("id").cast("string").alias("x")).filter("x NOT LIKE '%7%'")
    out = row_index(df)
    assert out.columns == ["x", "index"]
    got = {r["index"]: r["x"] for r in out.collect()}
    want = {i: r["x"] for r, i in df.rdd.zipWithIndex().collect()}
    assert got == want


def test_row_index_by_a_hot_key(spark):
    """Two thirds of the rows share one key; it is spread over partitions all the same."""
    df = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = row_index(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = out.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(60_000))
    assert [(r["k"], r["id"]) for r in rows] == sorted((r["k"], r["id"]) for r in rows)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 20_000


def test_row_index_moves_no_rows_to_number_them(spark):
    plan = row_index(spark.range(1000, numPartitions=4))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_row_index_of_nothing(spark):
    assert row_index(spark.range(0)).collect() == []


def test_latest_by_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 5, None), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    got = sorted(map(tuple, latest_by_key(df, ["k"], ["t"]).collect()), key=str)
    assert got == sorted([("a", 3, "y"), ("b", 5, None), (None, 1, "n")], key=str)


def test_latest_by_key_keeps_one_row_per_task_and_key(spark):
    df = spark.range(0, 100_000, numPartitions=8).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_by_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
