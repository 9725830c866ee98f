from pyspark.sql import functions as F

from vigil.llm.common import with_ids
from vigil.llm.components import components


def test_with_ids_is_a_semi_join(spark, monkeypatch):
    from vigil.llm import common

    rows = spark.range(-500, 2000).select("id", F.concat(F.lit("t"), "id").alias("text")).union(spark.createDataFrame([(None, "n"), (7, "t7")], "id long, text string"))
    ids = spark.range(0, 3000, 7).select("id").union(spark.createDataFrame([(None,)], "id long"))
    for bits in (common.FILTER_BITS, 64):
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        assert sorted(map(tuple, with_ids(rows, ids).collect())) == sorted(map(tuple, rows.join(ids, "id", "left_semi").collect()))
    assert with_ids(rows, ids.limit(0)).count() == 0 and with_ids(rows.limit(0), ids).count() == 0


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(400, 480)] + [(9, 9), (8, 7), (7, 8), (300, 2), (2, 301)]
    df = spark.createDataFrame(edges, "src long, dst long")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: find(n) for n in parent}
    assert components(df.limit(0)).count() == 0
