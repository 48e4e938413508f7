"""Normal forms of the timestamp texts of messages and daily entries (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.functions import timestamps as T


def workspace_zones(workspaces: DataFrame) -> DataFrame:
    """One row (``zone_workspace``, ``zone``) per workspace; ids repeat at most by accident, so the smallest zone stands."""
    zone = T.known_or_null(F.get_json_object("metadata", "$.timezone"), T.known_zones(workspaces.sparkSession))
    return workspaces.where("id is not null").groupBy(F.col("id").alias("zone_workspace")).agg(F.min(zone).alias("zone"))


def with_instant(messages: DataFrame, workspaces: DataFrame, name: str = "instant") -> DataFrame:
    """``messages`` plus ``name``: the UTC instant of ``timestamp`` (null where unreadable)."""
    zones = T.known_zones(messages.sparkSession)
    joined = messages.join(workspace_zones(workspaces), F.col("workspace_id") == F.col("zone_workspace"), "left")
    return T.with_instant_utc(joined, "timestamp", "zone", zones, name).drop("zone", "zone_workspace")


def normalised_messages(messages: DataFrame, workspaces: DataFrame) -> DataFrame:
    """(``src``, ``row_key``, ``normal_form``) of every readable message timestamp not in normal form; every row counts."""
    rows = with_instant(messages.select("row_id", "workspace_id", "timestamp"), workspaces)
    return rows.where(F.col("instant").isNotNull() & ~F.col("timestamp").rlike(T.INSTANT_FORM)).select(
        F.lit("session_messages").alias("src"), F.col("row_id").cast("string").alias("row_key"), T.instant_form(F.col("instant")).alias("normal_form")
    )


def normalised_days(entries: DataFrame, workspaces: DataFrame) -> DataFrame:
    """The same for ``logical_date``; repeated rows of one ``id`` count once (the smallest text stands)."""
    zones = T.known_zones(entries.sparkSession)
    once = entries.groupBy("id").agg(F.min(F.struct("logical_date", "workspace_id")).alias("e")).select("id", "e.*")
    joined = once.join(workspace_zones(workspaces), F.col("workspace_id") == F.col("zone_workspace"), "left")
    dated = T.with_calendar_day(joined, "logical_date", "zone", zones, "day")
    return dated.where(F.col("day").isNotNull() & ~F.col("logical_date").rlike(T.DAY_FORM)).select(
        F.lit("memory_daily_entries").alias("src"), F.col("id").alias("row_key"), F.col("day").alias("normal_form")
    )


def normalised_times(messages: DataFrame, entries: DataFrame, workspaces: DataFrame) -> DataFrame:
    return normalised_messages(messages, workspaces).unionByName(normalised_days(entries, workspaces))
