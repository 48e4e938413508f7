"""Growth of transcript files as keyed state: when is a file worth indexing again?

Updates (``seq``, ``path``, ``size``, ``messages``) arrive as a stream. State per path holds the last
size and what has piled up since the last pass. A file becomes dirty when its pending bytes or its
pending messages reach their thresholds; both thresholds are then subtracted once and the remainders
carried on. A file that shrank starts again from its new size. A byte threshold of 0 means that any
growth counts, a message threshold of 0 switches messages off; messages are counted only while the
bytes alone do not reach their threshold. Archives, and files whose size cannot be told, are always
dirty and change no state.

Defined results: updates without path are dropped; null message counts count as none; updates of one
path are taken in order of ``seq`` within a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mnemolake.operators.reading import session_path, transcript_kind

OUT = "path string, seq bigint, pending_bytes bigint, pending_messages bigint"
STATE = "last_size bigint, pending_bytes bigint, pending_messages bigint"


def advance(state: tuple[int, int, int], size: int | None, messages: int | None, max_bytes: int, max_messages: int, archive: bool) -> tuple[tuple[int, int, int], bool]:
    """State after one update, and whether the file is dirty."""
    last, held_bytes, held_messages = state
    if archive or size is None:
        return state, True
    held_bytes += size - last if size >= last else size
    if max_messages > 0 and (max_bytes <= 0 or held_bytes < max_bytes):
        held_messages += max(0, messages or 0)
    by_bytes = held_bytes > 0 if max_bytes <= 0 else held_bytes >= max_bytes
    dirty = by_bytes or (max_messages > 0 and held_messages >= max_messages)
    if dirty:
        held_bytes = max(0, held_bytes - max_bytes) if max_bytes > 0 else 0
        held_messages = max(0, held_messages - max_messages) if max_messages > 0 else 0
    return (size, held_bytes, held_messages), dirty


def dirty_files(updates: DataFrame, max_bytes: int = 100_000, max_messages: int = 50) -> DataFrame:
    """Stream of (``path``, ``seq``, pending values after it) for every update that makes a file dirty."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state = tuple(held.get) if held.exists else (0, 0, 0)
        rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
        out = []
        for seq, size, messages in zip(rows["seq"], rows["size"], rows["messages"]):
            whole = lambda v: None if pd.isna(v) else int(v)
            state, dirty = advance(state, whole(size), whole(messages), max_bytes, max_messages, ".jsonl." in key[0])
            if dirty:
                out.append((key[0], int(seq), state[1], state[2]))
        held.update(state)
        yield pd.DataFrame(out, columns=["path", "seq", "pending_bytes", "pending_messages"])

    rows = updates.where(F.col("path").isNotNull()).select("seq", "path", "size", "messages")
    return rows.groupBy("path").applyInPandasWithState(run, OUT, STATE, "append", GroupStateTimeout.NoTimeout)


def latest_updates(updates: DataFrame) -> DataFrame:
    """Debounce within a batch: the last update of each path."""
    return updates.where(F.col("path").isNotNull()).groupBy("path").agg(F.max_by(F.struct("size", "messages"), "seq").alias("u"), F.max("seq").alias("seq")).select("path", "seq", "u.*")


def routed(updates: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Updates with a sound path whose agent has a workspace, and the rejected rest with a reason."""
    parts = F.split("path", "/")
    sound = session_path(F.col("path")).isNotNull() & transcript_kind(F.get(parts, F.lit(2))).isNotNull()
    rows = updates.withColumns({"path_agent": F.when(sound, F.get(parts, F.lit(1)))})
    joined = rows.join(targets.select(F.col("agent_id").alias("path_agent"), "workspace").distinct(), "path_agent", "left")
    mismatch = F.col("agent_id").isNotNull() & (F.col("agent_id") != F.col("path_agent"))
    reason = F.when(F.col("path_agent").isNull(), "path").when(mismatch, "agent").when(F.col("workspace").isNull(), "workspace")
    marked = joined.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def throttled(rejected: DataFrame) -> DataFrame:
    """Of the rejected updates those worth a warning: the 1st, the 5th and every 20th of each path and reason, with their number."""
    w = Window.partitionBy("path", "reason").orderBy("seq")
    return rejected.withColumn("count", F.row_number().over(w)).where((F.col("count").isin(1, 5)) | (F.col("count") % 20 == 0))


def by_target(updates: DataFrame) -> DataFrame:
    """Dirty updates of each (``workspace``, ``agent_id``): the files to sync in one go, in order of their last update."""
    last = updates.groupBy("workspace", "agent_id", "path").agg(F.max("seq").alias("seq"))
    return last.groupBy("workspace", "agent_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "path"))), lambda x: x["path"]).alias("paths"))


def pending_totals(states: DataFrame, keys: list[str]) -> DataFrame:
    """What has piled up over the tracked files: (keys, ``pending_bytes``, ``pending_messages``, ``files``)."""
    return states.groupBy(*keys).agg(F.sum("pending_bytes").alias("pending_bytes"), F.sum("pending_messages").alias("pending_messages"), F.count("*").alias("files"))


def drain(stream: DataFrame, base: str) -> DataFrame:
    """Run a stream to the end of its input and read back what it wrote."""
    query = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/out")
