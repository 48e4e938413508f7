"""Exact ranks inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.runtime import written


def group_rank(df: DataFrame, keys: list[str], order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name``: the 0-based place of each row in its group, groups cut across tasks.

    Rows are range-partitioned by (keys, order), so a hot group is spread over many partitions;
    each partition ranks its own part, and the parts before it are added from a table of counts
    (one row per group and partition that holds some of it). ``order`` must be total for the result
    to be deterministic. The partitioned rows are written once, so both uses see the same cut.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn("_part", F.spark_partition_id())
    cut = written(cut, "ranked")
    inside = Window.partitionBy("_part", *keys).orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("_part", *keys).agg(F.count("*").alias("_n"))
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    renamed = offsets.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before")
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ranked = cut.withColumn("_at", F.row_number().over(inside) - 1).join(renamed, same)
    return ranked.withColumn(name, (F.col("_at") + F.col("_before")).cast("bigint")).select(*df.columns, name)
