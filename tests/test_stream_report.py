import pytest
from pyspark.sql import functions as F

from vigil.streaming.report import newest_batch, read_report, report_as_it_arrives

ROWS = [(k, i) for i, k in enumerate(["a", "b", None, "a", "c", "a", "b", None, "d", "a", "a", "c"])]


def measures():
    return [F.count("*").alias("n"), F.sum("v").alias("total"), F.max("v").alias("top")]


@pytest.mark.parametrize("cuts", [[12], [1, 11], [4, 4, 4], [5, 0, 7]])
def test_any_cut_gives_the_batch_report(spark, scratch, cuts):
    src, at = scratch("src"), 0
    for i, n in enumerate(cuts):
        spark.createDataFrame(ROWS[at:at + n], "k string, v long").coalesce(1).write.parquet(f"{src}/b={i:03d}")
        at += n
    out, ck = scratch("out"), scratch("ck")
    read = lambda: spark.readStream.schema("k string, v long").option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
    report_as_it_arrives(read(), ["k"], measures(), out, ck)
    want = spark.createDataFrame(ROWS, "k string, v long").groupBy("k").agg(*measures())
    order = lambda df: sorted(map(tuple, df.select("k", "n", "total", "top").collect()), key=str)
    assert order(read_report(spark, out)) == order(want)
    # more rows arrive: the same checkpoint goes on, and only changed groups are in the newest batch
    spark.createDataFrame([("b", 100), ("e", 1)], "k string, v long").coalesce(1).write.parquet(f"{src}/b=900")
    report_as_it_arrives(read(), ["k"], measures(), out, ck)
    assert order(newest_batch(spark, out)) == [("b", 3, 107, 100), ("e", 1, 1, 1)]
    # a new checkpoint counts from the start, in a table of its own
    report_as_it_arrives(read(), ["k"], measures(), out, scratch("ck"))
    more = spark.createDataFrame(ROWS + [("b", 100), ("e", 1)], "k string, v long").groupBy("k").agg(*measures())
    assert order(read_report(spark, out)) == order(more)


def test_no_report(spark, scratch):
    with pytest.raises(ValueError):
        read_report(spark, scratch("none"))
