from mnemolake.functions.ranks import group_rank
from pyspark.sql import functions as F


def test_rank_of_a_hot_group(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise("hot").alias("k"), (F.col("id") * 7919 % 3001).alias("v"), F.lit(1).alias("_x"))
    got = group_rank(df, ["k"], [F.col("v")], "place", 5).collect()
    for k in (None, "hot"):
        part = sorted((r["v"], r["place"]) for r in got if r["k"] == k)
        assert [p for _, p in part] == list(range(len(part)))
    assert group_rank(df.limit(0), ["k"], [F.col("v")], "place").count() == 0


def test_written_tables_can_be_forgotten(spark):
    import os

    from mnemolake.runtime import forget_written, shared_path, written

    assert written(spark.range(3), "three").count() == 3
    folder = os.path.dirname(shared_path(spark, "x").removeprefix("file://"))
    assert os.listdir(folder)
    forget_written(spark)
    assert not os.path.exists(folder) and written(spark.range(2), "two").count() == 2
