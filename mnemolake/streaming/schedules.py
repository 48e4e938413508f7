"""Who gets an update, when a failed target is tried again, what runs at all: rules over time as plans.

Rules that carry state from event to event are folds over the events of one key, which are bounded
by the key's own log (a target, a scope), never by the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType


def newest_consumer(updates: DataFrame, consumers: DataFrame) -> DataFrame:
    """Updates (``seq``, ``at``) with the ``consumer`` that gets them: of those open at the time the one registered last; none is null.

    ``consumers``: (``consumer``, ``opened_at``, ``closed_at``). Only the spans between two changes of the
    list are joined, one span an update.
    """
    times = consumers.select(F.col("opened_at").alias("t")).union(consumers.where("closed_at is not null").select("closed_at")).distinct()
    spans = times.select(F.col("t").alias("_from"), F.lead("t").over(Window.orderBy("t")).alias("_to"))  # as many as the list has changes
    open_ = (F.col("opened_at") <= F.col("_from")) & (F.col("closed_at").isNull() | (F.col("closed_at") > F.col("_from")))
    owner = spans.join(consumers, open_, "left").groupBy("_from", "_to").agg(F.max_by("consumer", F.struct("opened_at", "consumer")).alias("consumer"))
    inside = (F.col("at") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("at") < F.col("_to")))
    return updates.join(owner, inside, "left").drop("_from", "_to")


def retries(outcomes: DataFrame, base_ms: int = 2_000, cap_ms: int = 30_000) -> DataFrame:
    """Sync outcomes (``target``, ``seq``, ``ok``) with ``attempt`` (failures in a row, null after success) and ``retry_ms``: the growing delay."""
    w = Window.partitionBy("target").orderBy("seq")
    run = outcomes.withColumn("_run", F.coalesce(F.sum(F.col("ok").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    failed = run.withColumn("attempt", F.when(~F.col("ok"), F.row_number().over(Window.partitionBy("target", "_run").orderBy("seq"))))
    return failed.withColumn("retry_ms", F.least(F.lit(base_ms) * F.pow(F.lit(2), F.col("attempt") - 1), F.when(F.col("attempt").isNotNull(), cap_ms)).cast("bigint")).drop("_run")


def to_bootstrap(requests: DataFrame, done: DataFrame) -> DataFrame:
    """Scopes to index for the first time, once each however many ask: (``key``, ``visibility``, ``workspace``, ``agents``) without those of ``done`` (``key``)."""
    agents = F.array_sort("agents")
    key = F.concat_ws("\\u0000", F.col("visibility"), F.col("workspace"), F.array_join(agents, "\\u0000"))
    return requests.select(key.alias("key"), "visibility", "workspace", agents.alias("agents")).distinct().join(done.select("key").distinct(), "key", "left_anti")


def _events(events: DataFrame, key: str) -> DataFrame:
    return events.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at_ms", "kind"))).alias("_e"))


def maintenance_runs(triggers: DataFrame, key: str, run_ms: int) -> DataFrame:
    """Runs (``key``, ``start_ms``) that triggers (``key``, ``at_ms``) lead to, if one takes ``run_ms``.

    One run at a time; whatever triggers come while one is running make exactly one more right after it.
    """
    rows = _events(triggers.withColumn("kind", F.lit("run")), key)
    fold = f"""aggregate(_e, struct(cast(-1 as bigint) as free, cast(array() as array<bigint>) as runs),
      (s, e) -> if(e.at_ms >= s.free, struct(e.at_ms + {run_ms} as free, concat(s.runs, array(e.at_ms)) as runs),
        if(e.at_ms > element_at(s.runs, -1), struct(s.free + {run_ms} as free, concat(s.runs, array(s.free)) as runs), s)), s -> s.runs)"""
    return rows.select(key, F.explode(F.expr(fold)).alias("start_ms"))


def cache_outcomes(events: DataFrame, key: str, ttl_ms: int = 60_000) -> DataFrame:
    """Reads (``kind`` read) of a cache with their outcome (``hit`` or ``load``); ``kind`` drop makes the next read load again.

    A value is good for ``ttl_ms`` after its load; a drop at the same instant comes first. One pass over
    the sorted events, which keeps no more of a key than its last load, so its log may be of any length.
    """
    rows = events.select(key, F.col("at_ms").cast("bigint").alias("at_ms"), "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, loaded = object(), None
        for batch in batches:
            taken, outcomes = [], []
            for i, (k, at, kind) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                if k != last:
                    last, loaded = k, None
                if kind == "drop":
                    loaded = None
                    continue
                hit = loaded is not None and at is not None and at < loaded + ttl_ms
                if not hit:
                    loaded = at
                taken.append(i)
                outcomes.append("hit" if hit else "load")
            kept = batch.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(outcomes, pa.string())], names=[key, "at_ms", "outcome"])

    shape = StructType([StructField(key, rows.schema[key].dataType), StructField("at_ms", LongType()), StructField("outcome", StringType())])
    return rows.repartition(key).sortWithinPartitions(key, "at_ms", "kind").mapInArrow(run, shape)
