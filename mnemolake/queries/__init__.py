"""Registered queries of the core, with their SQL counterparts where SQL can say the same."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession

MODULES = ["pipeline", "basics", "retrieval", "transcripts", "selections", "functions", "writes", "upkeep"]


def _gather(name: str) -> dict:
    out: dict = {}
    for m in MODULES:
        out |= getattr(importlib.import_module(f"mnemolake.queries.{m}"), name)
    return out


def all_queries() -> dict:
    return _gather("QUERIES")


def all_sql() -> dict:
    return _gather("SQL")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_queries()["ret05_cascade"](spark, sf_dir)
