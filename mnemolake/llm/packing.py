"""Filling fixed-capacity containers with texts (problem 8): shortest-pack-first over the length histogram.

1. Texts are measured in tokens of a public tokenizer (its file is a parameter, read by every
   executor). A text longer than the capacity, and only such a text, is cut into full containers
   and a rest; all other texts stay whole.
2. Only the histogram of lengths (at most ``capacity`` numbers a budget) goes to the driver. Lengths
   are placed longest first, each into the packing pattern that is shortest so far and still has
   room; a pattern stands for as many equal containers as the counts allow, so the work depends on
   the number of lengths, not on the number of texts.
3. The patterns are joined back to the texts by rank: the n-th text of a length belongs to the n-th
   place that the patterns have for that length. Ranks are exact and never put a length into one
   task, even if a third of all texts have it.

Defined results: null and empty texts (no tokens) need no room and are left out, as are null ids;
budgets with a null or non-positive capacity give no rows; repeated rows are separate items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.functions.ranks import group_rank
from mnemolake.runtime import written

TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.json"


def token_counts(documents: DataFrame, tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    """(``doc_id``, ``tokens``) of every text with at least one token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        tokenizer.encode_special_tokens = True
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.iloc[i : i + 64]
                sizes = [len(e) for e in tokenizer.encode_batch_fast(part["text"].tolist(), add_special_tokens=False)]
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "tokens": sizes})

    rows = documents.where("doc_id is not null and text is not null and text <> ''").select("doc_id", "text")
    return rows.mapInPandas(run, "doc_id bigint, tokens int").where("tokens > 0")


@dataclass
class Pattern:
    """``count`` equal containers with the same lengths in them."""

    count: int
    room: int
    lengths: dict[int, int] = field(default_factory=dict)

    def split(self, n: int) -> Pattern:
        self.count -= n
        return Pattern(n, self.room, dict(self.lengths))

    def put(self, length: int) -> None:
        self.room -= length
        self.lengths[length] = self.lengths.get(length, 0) + 1


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Packing patterns for ``histogram`` (length to number of items, lengths up to ``capacity``)."""
    by_room: dict[int, list[Pattern]] = {}

    def shelve(p: Pattern) -> None:
        by_room.setdefault(p.room, []).append(p)

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            roomiest = max((r for r, shelf in by_room.items() if shelf), default=-1)
            if roomiest < length:  # no pattern has room: open as many containers as there are items
                fresh = Pattern(left, capacity)
                fresh.put(length)
                shelve(fresh)
                break
            shelf = by_room[roomiest]
            pattern = shelf.pop()
            used = pattern if pattern.count <= left else pattern.split(left)
            if used is not pattern:
                shelf.append(pattern)
            if not shelf:
                del by_room[roomiest]
            used.put(length)
            left -= used.count
            shelve(used)
    return [p for shelf in by_room.values() for p in shelf]


def _places(budget: str, patterns: list[Pattern], first: int) -> list[tuple]:
    """(budget, length, start rank, end rank, items a container, first container) of every pattern and length."""
    taken: dict[int, int] = {}
    rows, at = [], first
    for p in sorted(patterns, key=lambda p: sorted(p.lengths.items(), reverse=True), reverse=True):
        for length, k in p.lengths.items():
            start = taken.get(length, 0)
            rows.append((budget, length, start, start + k * p.count, k, at))
            taken[length] = start + k * p.count
        at += p.count
    return rows


def packed(documents: DataFrame, budgets: DataFrame, tokenizer_file: str = TOKENIZER_FILE) -> DataFrame:
    """(``budget_name``, ``container_no``, ``doc_id``, ``piece_no``, ``tokens``)."""
    spark = documents.sparkSession
    sized = written(token_counts(documents, tokenizer_file), "packing-sizes")
    wanted = budgets.where("budget_name is not null and capacity_tokens > 0").select("budget_name", "capacity_tokens").distinct()
    capacity = {r["budget_name"]: r["capacity_tokens"] for r in wanted.collect()}  # a table of parameters
    each = F.array(*[F.struct(F.lit(b).alias("budget_name"), F.lit(c).cast("int").alias("capacity_tokens")) for b, c in sorted(capacity.items())])
    none = F.array().cast("array<struct<budget_name:string,capacity_tokens:int>>")
    whole = sized.select("doc_id", "tokens", F.inline(each if capacity else none))  # every text for every budget
    full = F.floor(F.col("tokens") / F.col("capacity_tokens")).cast("int")
    rest = (F.col("tokens") % F.col("capacity_tokens")).cast("int")
    sizes = F.concat(F.array_repeat(F.col("capacity_tokens").cast("int"), full), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    pieces = whole.select("budget_name", "doc_id", F.posexplode(sizes).alias("piece_no", "tokens"))
    ranked = written(group_rank(pieces, ["budget_name", "tokens"], [F.col("doc_id"), F.col("piece_no")], "rank"), "packing-ranked")

    histograms: dict[str, dict[int, int]] = {b: {} for b in capacity}
    for r in ranked.groupBy("budget_name", "tokens").count().collect():  # at most the sum of the capacities
        histograms[r["budget_name"]][r["tokens"]] = r["count"]
    rows = [row for b, h in sorted(histograms.items()) for row in _places(b, shortest_pack_first(h, capacity[b]), 0)]
    places = F.broadcast(spark.createDataFrame(rows, "b string, length int, start bigint, stop bigint, each int, first bigint"))
    here = (F.col("budget_name") == F.col("b")) & (F.col("tokens") == F.col("length")) & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("stop"))
    container = F.col("first") + F.floor((F.col("rank") - F.col("start")) / F.col("each"))
    return ranked.join(places, here).select("budget_name", container.cast("bigint").alias("container_no"), "doc_id", "piece_no", "tokens")


def fill_report(containers: DataFrame, budgets: DataFrame) -> DataFrame:
    """(``budget_name``, ``containers``, ``tokens``, ``fill``) of a packing."""
    total = containers.groupBy("budget_name").agg(F.countDistinct("container_no").alias("containers"), F.sum("tokens").alias("tokens"))
    fill = F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))
    return total.join(budgets, "budget_name").select("budget_name", "containers", "tokens", fill.alias("fill"))
