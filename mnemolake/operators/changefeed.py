"""Current state of a table from its change log (problem 6), as a signed multiset.

Every change that takes effect contributes minus one to its before-image and plus one to its
after-image; multiplicities are summed per image (item, version) together with an optional base,
and the images with a positive sum are the state. What takes effect is decided first, because the
log holds attempts that were made again after they had succeeded:

1. rows of one change ``id`` are one change (the smallest by instant and versions stands);
2. per item, in order of (``created_at``, ``before`` version, ``id``), an insert takes effect if the
   item is not alive, any other change if its ``before`` version is the item's current version.

Only (versions, content hash) of the JSON images enter a shuffle. Step 2 folds short histories
in JVM arrays; the fold knows the image that each change replaces, so every effective change gives
its two signed images, and images of one version with different content stay apart. A ``base`` is
the change before all others: its images are inserts that come first.

An item with more than ``max_history`` changes is cut by exact distributed ranks into segments of
``segment_size`` changes, whatever its history's length and however many changes share an instant.
Every segment is summed up as the function from "state before" to "state after" (entries that no
earlier segment can produce are left out), and the functions are composed in pairs, by joins, until
one is left: inside a segment and between segments the signed images cancel, so its value for an
item that is not alive is the whole sum. No group is ever collected whole.

Defined results: null item id or null change id: a null ``item_id`` is no item change and is
ignored; a null change ``id`` makes each distinct row its own change. Unreadable images have null
versions: such an insert makes the item alive in version null; a null before-version never equals
a current version. A null ``created_at`` sorts first.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.functions.ranks import group_rank
from mnemolake.runtime import written

DEAD = "dead"
ORDER = ["created_at", "before_version", "id", "kind", "after_version", "content_sha256"]
_IMAGE = "struct<version:bigint,content_sha256:string,times:int>"


def item_changes(log: DataFrame) -> DataFrame:
    """Compact, deduplicated item changes: one row per (item, change id)."""
    version = lambda image: F.get_json_object(image, "$.version").try_cast("bigint")
    kind = F.lower(F.trim("operation"))
    content = F.sha2(F.get_json_object("after", "$.content"), 256)
    rows = log.where("item_id is not null").where(kind.isin("insert", "update", "delete", "soft_delete")).select(
        "item_id",
        F.col("id"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        version("before").alias("before_version"),
        kind.alias("kind"),
        F.when(kind.isin("insert", "update"), version("after")).alias("after_version"),
        F.when(kind.isin("insert", "update"), content).alias("content_sha256"),
    )
    own = F.coalesce("id", F.concat(F.lit("?"), F.xxhash64("created_at", "before_version", "kind", "after_version", "content_sha256").cast("string")))
    return rows.groupBy("item_id", own.alias("change")).agg(F.min(F.struct(*ORDER)).alias("c")).select("item_id", "c.*")


def _signed_short(changes: DataFrame) -> DataFrame:
    """Fold whole histories; gives the signed images (``item_id``, ``version``, ``content_sha256``, ``times``) of the effective changes."""
    history = changes.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct(*ORDER))).alias("h"))
    minus = "struct(s.v as version, s.c as content_sha256, -1 as times)"
    plus = "struct(c.after_version as version, c.content_sha256 as content_sha256, 1 as times)"
    fold = f"""
        aggregate(h, struct(false as alive, cast(null as bigint) as v, cast(null as string) as c, cast(array() as array<{_IMAGE}>) as done),
          (s, c) -> if(
            if(c.kind = 'insert', not s.alive, s.alive and coalesce(c.before_version = s.v, false)),
            if(c.kind in ('insert', 'update'),
              struct(true as alive, c.after_version as v, c.content_sha256 as c, concat(s.done, if(s.alive, array({minus}, {plus}), array({plus}))) as done),
              struct(false as alive, cast(null as bigint) as v, cast(null as string) as c, concat(s.done, array({minus})) as done)),
            s), s -> s.done)
    """
    return history.select("item_id", F.inline(F.expr(fold)))


def _segment_function(rows: pd.DataFrame) -> pd.DataFrame:
    """Exit state of a segment for every entry state it can act on; one backward pass."""
    rows = rows.sort_values("rank", kind="stable")
    after: dict = {}  # version -> exit when entered alive in it; absent: unchanged
    dead: tuple = (DEAD, None)
    for kind, before, then, content in zip(rows["kind"][::-1], rows["before_version"][::-1], rows["after_version"][::-1], rows["content_sha256"][::-1]):
        reached = _state(then)
        leaves = after.get(reached, (reached, content))
        if kind == "insert":
            dead = leaves
        elif pd.notna(before):
            after[_state(before)] = leaves if kind == "update" else dead
    pairs = [(DEAD, dead), *after.items()]
    first = rows.iloc[0]
    return pd.DataFrame({"item_id": first["item_id"], "segment": first["segment"], "entry": [a for a, _ in pairs], "exit": [b[0] for _, b in pairs], "content_sha256": [b[1] for _, b in pairs]})


def _state(version) -> str:
    return "null" if pd.isna(version) else str(int(version))


def _composed(functions: DataFrame) -> DataFrame:
    """Functions of neighbouring segments (2n, 2n + 1) put together, row by row."""
    pair = functions.withColumn("pair", F.floor(F.col("segment") / 2).cast("bigint"))
    left = pair.where("segment % 2 = 0").select("item_id", "pair", "entry", "exit", "content_sha256")
    right = pair.where("segment % 2 = 1")
    onward = right.select("item_id", "pair", F.col("entry").alias("exit"), F.col("exit").alias("_exit"), F.col("content_sha256").alias("_content"))
    moved = F.col("_exit").isNotNull()
    first = left.join(onward, ["item_id", "pair", "exit"], "left").select(
        "item_id", F.col("pair").alias("segment"), "entry", F.when(moved, F.col("_exit")).otherwise(F.col("exit")).alias("exit"), F.when(moved, F.col("_content")).otherwise(F.col("content_sha256")).alias("content_sha256")
    )
    # what the left one leaves as it is enters the right one
    passed = right.join(left.select("item_id", "pair", "entry"), ["item_id", "pair", "entry"], "left_anti")
    return first.unionByName(passed.select("item_id", F.col("pair").alias("segment"), "entry", "exit", "content_sha256"))


def _signed_long(changes: DataFrame, segment_size: int) -> DataFrame:
    """The sum of signed images of histories too long for one array."""
    ranked = group_rank(changes, ["item_id"], [F.col(c).asc_nulls_first() for c in ORDER], "rank")
    parts = written(ranked.withColumn("segment", F.floor(F.col("rank") / segment_size).cast("bigint")), "changefeed-segments")
    functions = parts.groupBy("item_id", "segment").applyInPandas(_segment_function, "item_id string, segment bigint, entry string, exit string, content_sha256 string")
    # a version is an entry of a segment only if an earlier segment can leave it
    made = parts.where("kind in ('insert', 'update')").groupBy("item_id", F.coalesce(F.col("after_version").cast("string"), F.lit("null")).alias("entry")).agg(F.min("segment").alias("_made"))
    functions = functions.join(made, ["item_id", "entry"], "left").where((F.col("entry") == DEAD) | (F.col("_made") < F.col("segment"))).drop("_made")
    functions = written(functions, "changefeed-functions")
    last = parts.agg(F.max("segment")).first()[0] or 0
    while last > 0:
        functions, last = written(_composed(functions), "changefeed-composed"), last // 2
    alive = functions.where((F.col("entry") == DEAD) & (F.col("exit") != DEAD))
    return alive.select("item_id", F.col("exit").try_cast("bigint").alias("version"), "content_sha256", F.lit(1).alias("times"))


def signed_images(log: DataFrame, base: DataFrame | None = None, max_history: int = 1_000, segment_size: int = 20_000) -> DataFrame:
    """(``item_id``, ``version``, ``content_sha256``, ``times``): signed images of the changes that take effect, with the base."""
    changes = item_changes(log)
    # counted on the bare key column; repeated rows count too, which only sends more items the long way
    counts = log.where("item_id is not null").groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") > max_history)
    if base is not None:
        first = base.select("item_id", F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("bigint").alias("before_version"), F.lit("").alias("id"), F.lit("insert").alias("kind"), F.col("version").cast("bigint").alias("after_version"), "content_sha256")
        changes = changes.unionByName(first)
    if counts.isEmpty():
        return _signed_short(changes)
    changes, long_items = written(changes, "changefeed-changes"), written(counts.select("item_id"), "changefeed-long")
    short = changes.join(long_items, "item_id", "left_anti")
    return _signed_short(short).unionByName(_signed_long(changes.join(long_items, "item_id", "left_semi"), segment_size))


def current_state(log: DataFrame, base: DataFrame | None = None, max_history: int = 1_000, segment_size: int = 20_000) -> DataFrame:
    """(``item_id``, ``version``, ``content_sha256``) of the items alive after all changes.

    ``base`` (same columns, one row an item) holds images that were there before the log's first change.
    """
    summed = signed_images(log, base, max_history, segment_size).groupBy("item_id", "version", "content_sha256").agg(F.sum("times").alias("times"))
    return summed.where("times > 0").select("item_id", "version", "content_sha256")
