"""Two-pass numbering equals the window form, also with one group holding a third of
all rows and with the single-task fast path disabled."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators.ranking import dense_index, global_row_number, grouped_row_number


def _skewed(spark, n=6000):
    # group "hot" holds a third of the rows; the rest spread over 50 groups; some null groups
    return spark.range(n).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 97 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("grp"),
        (F.col("id") * 7919 % 1000).alias("score"))


def test_grouped_two_pass_equals_window(spark):
    df = _skewed(spark)
    mine = grouped_row_number(df, ["grp"], ["score", "key"], out="rn", num_partitions=12)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("grp").orderBy("score", "key")))
    a = {(r.key, r.rn) for r in mine.collect()}
    b = {(r.key, r.rn) for r in ref.collect()}
    assert a == b and len(a) == df.count()


def test_global_two_pass_equals_window(spark):
    df = _skewed(spark, 3000)
    mine = {(r.key, r.rn) for r in global_row_number(df, ["score", "key"], num_partitions=7).collect()}
    forced = {(r.key, r.rn) for r in grouped_row_number(df, [], ["score", "key"], num_partitions=7).collect()}
    ref = {(r.key, r.rn) for r in df.withColumn("rn", F.row_number().over(Window.orderBy("score", "key"))).collect()}
    assert mine == ref == forced


def test_two_pass_plan_has_no_single_partition_window(spark):
    df = _skewed(spark)
    plan = grouped_row_number(df, ["grp"], ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_dense_index(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v string")
    assert {r.v: r.idx for r in dense_index(df, "v").collect()} == {"a": 0, "b": 1, "c": 2}
