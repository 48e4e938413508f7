"""Append-log tables read as current state: items, audit, ledgers, embeddings, queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.functions.scalars import clamp

# Allowed labels of a stored item.
TYPES = ["fact", "note"]
SOURCES = ["user", "agent", "migration", "system", "integration"]


def scoped(df: DataFrame, scopes: DataFrame) -> DataFrame:
    """Rows of the given scopes (``user_id``, ``workspace_id``); equality on the partition columns, so it prunes."""
    return df.join(scopes.select("user_id", "workspace_id").distinct(), ["user_id", "workspace_id"], "left_semi")


def normalised_input(writes: DataFrame) -> DataFrame:
    """Input rules of a store call: blank content is refused, the rest gets defaults and bounds."""
    kept = writes.where(T.whole_trim(F.coalesce("content", F.lit(""))) != "")
    given = lambda c: T.whole_trim(F.coalesce(c, F.lit(""))) != ""
    key = F.when(given("canonical_key"), T.whole_trim(F.col("canonical_key")))
    is_map = F.coalesce(F.col("metadata").rlike(r"^\s*\{") & F.try_parse_json("metadata").isNotNull(), F.lit(False))
    return kept.withColumns({
        "title": F.when(given("title"), F.col("title")).otherwise(T.first_line_title(F.col("content"))),
        "type": F.when(F.col("type").isin(TYPES), F.col("type")).otherwise("note"),
        "namespace": F.when(given("namespace"), T.whole_trim(F.col("namespace"))).otherwise("default"),
        "source": F.when(F.col("source").isin(SOURCES), F.col("source")).otherwise("agent"),
        "tags": F.when(F.coalesce(F.forall("tags", lambda t: t.isNotNull()), F.lit(False)), F.col("tags")).otherwise(F.array().cast("array<string>")),
        "metadata": F.when(is_map, F.col("metadata")).otherwise("{}"),
        "canonical_key": key,
        "importance": clamp(F.coalesce("importance", F.lit(50)), 0, 100),
        "confidence": clamp(F.coalesce("confidence", F.lit(80)), 0, 100),
    })


KEY = ["user_id", "workspace_id", "namespace", "type", "canonical_key"]


def upserted(writes: DataFrame, order: list[Column]) -> DataFrame:
    """Current active items of an append log of writes and deletions, as (``id``, ``version``, last written columns).

    A write whose canonical key an active item has changes that item: its id and time of creation stay,
    its version rises by one, everything else is the write's. A deletion (``status`` deleted) of a key ends
    its item; the next write of the key makes a new one. Writes without a key are items of their own.
    Equal places in ``order`` must not occur; a null status counts as active.
    """
    keyed, free = writes.where("canonical_key is not null"), writes.where("canonical_key is null")
    w = Window.partitionBy(*KEY).orderBy(*order)
    gone = F.coalesce(F.col("status") == "deleted", F.lit(False))
    # the life of an item: from the write after a deletion to the next deletion
    lives = keyed.withColumn("_gone", gone).withColumn("_life", F.coalesce(F.sum(F.col("_gone").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    life = Window.partitionBy(*KEY, "_life")
    ranked = lives.withColumns({
        "_version": F.row_number().over(life.orderBy(*order)), "_last": F.count("*").over(life), "_dead": F.max("_gone").over(life),
        "_id": F.first("id").over(life.orderBy(*order)), "_created": F.first("created_at").over(life.orderBy(*order)),
    })
    latest = ranked.where((F.col("_version") == F.col("_last")) & ~F.col("_dead"))
    latest = latest.withColumns({"id": F.col("_id"), "created_at": F.col("_created"), "new_version": F.col("_version")})
    alone = free.where(~gone).withColumn("new_version", F.lit(1))
    return latest.select(*alone.columns).unionByName(alone)


IMAGE = ["id", "type", "namespace", "status", "source", "title", "content", "metadata", "tags", "importance", "confidence", "version", "updated_at"]


def audit_trail(writes: DataFrame, order: list[Column]) -> DataFrame:
    """Operation and whole images before and after each write of a canonical key; the id is the first write's."""
    w = Window.partitionBy(*KEY).orderBy(*order)
    rows = writes.where("canonical_key is not null").withColumns({"version": F.row_number().over(w), "id": F.first("id").over(w)})
    rows = rows.withColumn("after", F.to_json(F.struct(*IMAGE), {"ignoreNullFields": "false"}))
    rows = rows.withColumn("before", F.lag("after").over(w))
    return rows.withColumn("operation", F.when(F.col("before").isNull(), "insert").otherwise("update"))


def forgotten(items: DataFrame, ids: DataFrame) -> DataFrame:
    """Soft delete of ``ids``; items already deleted stay as they are, versions are not raised."""
    marked = items.join(ids.select(F.col("id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left")
    hit = F.col("_id").isNotNull() & (F.col("status") != "deleted")
    return marked.withColumns({"was": F.col("status"), "status": F.when(hit, "deleted").otherwise(F.col("status")), "changed": hit}).drop("_id")


def first_by_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def inserted_if_absent(existing: DataFrame, incoming: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of ``incoming`` whose key is new, once each (the first stands)."""
    return first_by_key(incoming, keys, order).join(existing.select(*keys).distinct(), keys, "left_anti")


def embedding_backlog(items: DataFrame, embeddings: DataFrame, profile: str) -> DataFrame:
    """Active items whose embedding for ``profile`` is missing, of another version, or of other length than it says."""
    emb = embeddings.where(F.col("profile_key") == profile).select(F.col("memory_item_id").alias("_id"), F.col("memory_item_version").alias("_v"), F.col("dimensions").alias("_d"), F.size("embedding").alias("_s"))
    joined = items.where("status = 'active'").join(emb, F.col("id") == F.col("_id"), "left")
    stale = F.col("_id").isNull() | ~F.col("_v").eqNullSafe(F.col("version")) | ~F.col("_d").eqNullSafe(F.col("_s"))
    return joined.where(stale).withColumn("state", F.when(F.col("_id").isNull(), "missing").otherwise("stale"))


def due_requests(queue: DataFrame, now: Column, limit: int = 5) -> DataFrame:
    """The ``limit`` pending requests of a scope that are due, oldest first."""
    due = queue.where((F.col("status") == "pending") & (F.col("next_attempt_at") <= now))
    w = Window.partitionBy("user_id", "workspace_id").orderBy("requested_at", "profile_key")
    return due.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def retried(queue: DataFrame, failed: Column, minutes: int = 15) -> DataFrame:
    """Failed requests stay pending with one attempt more and a later time; others are as they were."""
    later = F.col("next_attempt_at") + F.expr(f"INTERVAL {minutes} MINUTES")
    return queue.withColumns({
        "attempts": F.when(failed, F.col("attempts") + 1).otherwise(F.col("attempts")),
        "next_attempt_at": F.when(failed, later).otherwise(F.col("next_attempt_at")),
        "status": F.when(failed, "pending").otherwise(F.col("status")),
    })


QUEUE = ["user_id", "workspace_id", "profile_key"]


def enqueued(queue: DataFrame, requests: DataFrame, now: Column) -> DataFrame:
    """``queue`` after ``requests`` (``QUEUE``, ``agent_id``, ``reason``, ``seq``) were put in, one row a key.

    A known request becomes pending and due now and loses its error, but keeps its attempts and its
    first time; of several requests of one key the last by ``seq`` names agent and reason.
    """
    asked = requests.groupBy(*QUEUE).agg(F.max_by(F.struct("agent_id", "reason"), "seq").alias("_r"))
    joined = queue.join(asked, QUEUE, "full_outer")
    put = F.col("_r").isNotNull()
    return joined.select(
        *QUEUE, F.when(put, F.col("_r.agent_id")).otherwise(F.col("agent_id")).alias("agent_id"), F.when(put, F.col("_r.reason")).otherwise(F.col("reason")).alias("reason"),
        F.when(put, "pending").otherwise(F.col("status")).alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"),
        F.coalesce("requested_at", now).alias("requested_at"), F.when(put, now).otherwise(F.col("next_attempt_at")).alias("next_attempt_at"), F.when(~put, F.col("last_error")).alias("last_error"),
    )


def indexing_pass(queue: DataFrame, profiles: DataFrame, backlog: DataFrame, now: Column, limit: int = 5, batch: int = 25) -> DataFrame:
    """What one pass does with each due request: (``QUEUE``, ``outcome``, ``indexed``, queue columns after it).

    ``profiles`` (``agent_id``, ``current_key``): the profile in force; ``backlog`` (``QUEUE``, ``missing``):
    items without a current embedding. A request without profile waits 15 minutes more (``failed``), one
    whose profile changed is dropped and asked for under the new key (``superseded``), one with a rest
    after ``batch`` items is due at once (``requeued``), else it leaves the queue (``done``).
    """
    due = due_requests(queue, now, limit).join(profiles, "agent_id", "left").join(backlog, QUEUE, "left")
    missing = F.coalesce("missing", F.lit(0))
    outcome = (
        F.when(F.col("current_key").isNull(), "failed").when(F.col("current_key") != F.col("profile_key"), "superseded").when(missing > batch, "requeued").otherwise("done")
    )
    done = due.withColumn("outcome", outcome)
    indexed = F.when(F.col("outcome").isin("requeued", "done"), F.least(missing, F.lit(batch))).otherwise(0)
    again = F.col("outcome").isin("failed", "requeued")
    return done.select(
        *QUEUE, "outcome", indexed.alias("indexed"), F.when(again, F.col("attempts") + 1).alias("attempts"),
        F.when(F.col("outcome") == "failed", now + F.expr("INTERVAL 15 MINUTES")).when(again, now).alias("next_attempt_at"),
        F.when(F.col("outcome") == "superseded", F.col("current_key")).alias("new_key"),
    )


def candidates_for_embedding(items: DataFrame, embeddings: DataFrame, profile: str, limit: int) -> DataFrame:
    """Per scope, the ``limit`` newest active items whose embedding is missing or stale."""
    w = Window.partitionBy("user_id", "workspace_id").orderBy(F.col("updated_at").desc(), F.col("id"))
    return embedding_backlog(items, embeddings, profile).withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def merged_metadata(old: Column, new: Column) -> Column:
    """JSON objects put together as text maps, the right one wins; what is no object counts as empty."""
    read = lambda c: F.coalesce(F.from_json(c, "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    return F.map_zip_with(read(old), read(new), lambda k, a, b: F.coalesce(b, a))


def resolved(existing: DataFrame, wanted: DataFrame, keys: list[str], make_id: Column) -> DataFrame:
    """Resolve or create: each wanted key (once) with the id it has, or a new one, and its merged ``metadata`` (text map)."""
    one = wanted.groupBy(*keys).agg(F.max("metadata").alias("_new"))
    known = existing.groupBy(*keys).agg(F.min(F.struct("id", "metadata")).alias("_old"))
    joined = one.join(known, keys, "left")
    return joined.select(*keys, F.coalesce("_old.id", make_id).alias("id"), F.col("_old").isNull().alias("created"), merged_metadata(F.col("_old.metadata"), F.col("_new")).alias("metadata"))
