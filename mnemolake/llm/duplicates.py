"""Duplicates hidden by formatting differences (problem 2): an incremental, bucketed ledger.

Two records are copies when their content and their key are the same sequence of words (runs of
letters and digits) whatever the case, white space and punctuation. Content made of fields (a JSON
object, or lines that all read ``key: value``) is compared without regard to field order, at every
level; lists keep their order.

The ledger keeps, per canonical key, how many records carry it and its earliest representative
(the smallest id). A batch is aggregated first (so a hot key is one row before any shuffle), then
full-outer-joined with the ledger rows of the buckets it touches; untouched buckets are not read,
neither their counts nor their members. The ledger lives in a folder: a batch becomes part of it by
the manifest written last, and a later process opens the folder and goes on.

Defined results: null content equals only null content, null key only null key; text without any
word (empty, blanks, punctuation) is the empty sequence; a record delivered again under the same id
counts once, also when it comes in a later batch; null ids are ignored; an empty batch changes
nothing; extra columns are not looked at.
"""

from __future__ import annotations

import json
import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mnemolake.runtime import shared_path, written

_WORD = re.compile(r"[^\W_]+")


def _fold(text: str) -> str:
    return " ".join(_WORD.findall(text.lower().replace("ß", "ss")))


def _flat(value) -> str:
    if isinstance(value, list) and value and isinstance(value[0], _Field):
        return " ".join(sorted(_fold(f.name) + " " + _flat(f.value) for f in value))
    if isinstance(value, list):
        return " ".join(_flat(v) for v in value)
    return _fold("" if value is None else str(value))


class _Field:
    def __init__(self, pair):
        self.name, self.value = pair


@F.pandas_udf(StringType())
def _json_words(texts: pd.Series) -> pd.Series:
    """Words of a JSON object with its fields in order of their words; null where it is no object."""

    def one(text):
        if text is None:
            return None
        try:
            value = json.loads(text, object_pairs_hook=lambda pairs: [_Field(p) for p in pairs], parse_int=str, parse_float=str)
            return _flat(value) if isinstance(value, list) else None
        except (ValueError, RecursionError):
            return None

    return texts.map(one)


def words(text: Column) -> Column:
    """Letters and digits in one case (a sharp s is ss, as in capitals), everything else one blank."""
    return F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), r"[^\p{L}\p{N}]+", " "))


def canonical_content(df: DataFrame, content: str, name: str) -> DataFrame:
    """``df`` plus ``name``: the canonical text of ``content``."""
    json_text = F.when(F.col(content).rlike(r"^\s*\{"), F.col(content))
    lines = F.filter(F.split(F.col(content), r"[\r\n]+"), lambda l: ~l.rlike(r"^\s*$"))
    is_fields = (F.size(lines) > 1) & F.forall(lines, lambda l: l.rlike(r"^\s*(?:[-*•+]\s*)?[\p{L}\p{N}_-]+(?: [\p{L}\p{N}_-]+){0,2}\s*:(?:\s|[\p{L}\p{N}])"))
    fields = F.array_join(F.array_sort(F.transform(lines, words)), " ")
    plain = F.when(is_fields, fields).otherwise(words(F.col(content)))
    return df.withColumn(name, F.coalesce(_json_words(json_text), plain))


def canonical_records(items: DataFrame, buckets: int) -> DataFrame:
    """(``id``, ``key``, ``bucket``) with a 128-bit key of both canonical texts."""
    rows = canonical_content(items.where("id is not null").select("id", "content", "canonical_key"), "content", "_c")
    part = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    key = F.unhex(F.md5(F.concat(part(F.col("_c")), F.lit("\n"), part(words(F.col("canonical_key"))))))
    rows = rows.select("id", key.alias("key"))
    return rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))


class DuplicateLedger:
    """Counts and members per canonical key, kept as bucketed tables in a folder (by default of the shared one).

    Each batch writes new tables of the buckets it touches and never overwrites any, so a job
    that is lost half-way leaves the ledger as it was. A folder that holds a ledger is opened with
    the buckets it was made with.
    """

    def __init__(self, spark: SparkSession, buckets: int = 16, path: str | None = None):
        self.spark, self.buckets = spark, buckets
        self.path = path or shared_path(spark, "duplicate-ledger")
        self.counts_at: dict[int, str] = {}  # bucket -> newest table of counts
        self.members_at: dict[int, list[str]] = {}  # bucket -> tables of members
        self.batches = 0
        if path:
            self._open()

    def _open(self) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest-*/_SUCCESS")
        done = pattern.getFileSystem(conf).globStatus(pattern)
        newest = max((f.getPath().getParent().toString() for f in done or []), default=None)
        if newest:
            said = json.loads(self.spark.read.text(newest).first()[0])
            self.buckets, self.batches = said["buckets"], said["batches"]
            self.counts_at = {int(b): p for b, p in said["counts"].items()}
            self.members_at = {int(b): ps for b, ps in said["members"].items()}

    def _commit(self) -> None:
        said = json.dumps({"buckets": self.buckets, "batches": self.batches, "counts": self.counts_at, "members": self.members_at})
        self.spark.createDataFrame([(said,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/manifest-{self.batches:09d}")

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def counts(self, only: set[int] | None = None) -> DataFrame:
        return self._read([p for b, p in self.counts_at.items() if only is None or b in only], "key binary, copies bigint, first_id string")

    def members(self, only: set[int] | None = None) -> DataFrame:
        return self._read([p for b, ps in self.members_at.items() if only is None or b in only for p in ps], "key binary, id string")

    def apply(self, items: DataFrame) -> None:
        """Add one batch of records (``id``, ``content``, ``canonical_key``)."""
        self.apply_records(canonical_records(items, self.buckets))

    def apply_records(self, records: DataFrame) -> None:
        """Add one batch of canonical records (``bucket``, ``key``, ``id``)."""
        batch = self.batches + 1
        at = f"{self.path}/batch-{batch}-{uuid.uuid4().hex[:8]}"  # a batch tried again leaves the lost one's tables alone
        shape = "key binary, id string, bucket int"
        self._distinct(records).write.partitionBy("bucket").parquet(f"{at}/arrived")
        new, into = self.spark.read.schema(shape).parquet(f"{at}/arrived"), "arrived"
        touched = {int(r[0]) for r in new.select("bucket").distinct().collect()}  # at most ``buckets`` numbers
        if touched & set(self.members_at):
            known = self.members(touched)
            new.join(known, ["key", "id"], "left_anti").write.partitionBy("bucket").parquet(f"{at}/members")
            new, into = self.spark.read.schema(shape).parquet(f"{at}/members"), "members"
            touched = {int(r[0]) for r in new.select("bucket").distinct().collect()}
        if not touched:
            return
        delta = new.groupBy("bucket", "key").agg(F.count("*").alias("more"), F.min("id").alias("least"))
        old = self.counts(touched & set(self.counts_at))
        merged = delta.join(old, "key", "full_outer") if set(self.counts_at) & touched else delta.withColumns({"copies": F.lit(0), "first_id": F.lit(None).cast("string")})
        merged.select(
            F.coalesce("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")).alias("bucket"),
            "key",
            (F.coalesce("copies", F.lit(0)) + F.coalesce("more", F.lit(0))).cast("bigint").alias("copies"),
            F.least("first_id", "least").alias("first_id"),
        ).write.partitionBy("bucket").parquet(f"{at}/counts")
        for b in touched:
            self.counts_at[b] = f"{at}/counts/bucket={b}"
            self.members_at.setdefault(b, []).append(f"{at}/{into}/bucket={b}")
        self.batches = batch
        self._commit()

    @staticmethod
    def _distinct(records: DataFrame) -> DataFrame:
        return records.groupBy("bucket", "key", "id").agg(F.lit(1).alias("one")).drop("one")

    def copies(self) -> DataFrame:
        """(``first_id``, ``copy_id``): every member of a group but its representative."""
        groups = self.counts().where("copies > 1").select("key", "first_id")
        return self.members().join(groups, "key").where("id <> first_id").select("first_id", F.col("id").alias("copy_id"))

    def collapsed(self) -> DataFrame:
        """(``first_id``, ``copies``): one row per distinct record."""
        return self.counts().select("first_id", "copies")


def build_ledger(items: DataFrame, batches: int = 2, buckets: int = 16) -> DuplicateLedger:
    """Feed a whole table in ``batches`` parts, as if it had arrived in that many deliveries; the table is read once."""
    ledger = DuplicateLedger(items.sparkSession, buckets)
    records = canonical_records(items, buckets)
    if batches > 1:
        records = written(records.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")), "canonical-records")
    for i in range(batches):
        ledger.apply_records(records.where(F.col("batch") == i).drop("batch") if batches > 1 else records)
    return ledger
