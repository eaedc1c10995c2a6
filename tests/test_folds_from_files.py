from pyspark.sql import functions as F

from tabweave.operators import cells as K
from tabweave.operators import models as G


def test_no_fold_of_a_long_table_is_cached(spark, monkeypatch):
    monkeypatch.setattr(K, "CELLS_FROM", 1)
    rows = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3 == 0).cast("double").alias("y"), (F.col("id") % 2).cast("int").alias("fold"))
    cached, persist = [], type(rows).persist

    def spy(df, *level):
        cached.append(df.columns)
        return persist(df, *level)

    monkeypatch.setattr(type(rows), "persist", spy)
    out = G.out_of_fold(rows, ["id"], ["a"], "y", "random_forest", "classification", "fold", 2, numTrees=3, maxDepth=2)
    assert out.select("id").distinct().count() == 300 == out.where(F.col("p1").between(0, 1)).count()
    # Cells are cached, whose number the rows do not change; rows are not.
    assert cached and not [c for c in cached if "a" in c]
