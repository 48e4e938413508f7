"""Hashes, identities, dates, versions, JSON helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of messages of errors that may pass when tried again.
TRANSIENT = [
    "connection terminated due to connection timeout", "timeout", "lock timeout", "deadlock detected", "econnreset", "econnrefused", "could not connect",
    "server closed the connection unexpectedly",
]
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?)?$"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def workspace_name(path: Column) -> Column:
    return F.concat(F.lit("dir:"), sha256(path))


def identity(configured: Column, user: Column) -> Column:
    """The configured id, else a hash of the user's name without case and edge blanks."""
    given = F.trim(F.coalesce(configured, F.lit("")))
    return F.when(given != "", given).otherwise(sha256(F.lower(F.trim(user))))


def is_uuid(text: Column) -> Column:
    return F.coalesce(text.rlike(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), F.lit(False))


def path_date(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"^memory/(\d{4}-\d{2}-\d{2})\.md$", 1), F.lit(""))


def explicit_date(text: Column) -> Column:
    """A text of the shape of a day that is one; else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.date_format(text.try_cast("date"), "yyyy-MM-dd"))


def coerced_millis(*texts: Column) -> Column:
    """The first of ``texts`` (a message's time, then its record's) that is a time: a positive number (below
    1e11 seconds, else milliseconds) or an ISO instant after 1970 (without zone: UTC); zero if none is."""

    def one(text: Column) -> Column:
        n = text.try_cast("double")
        number = F.when((n > 0) & ~F.isnan(n) & (n < 1e18), F.floor(F.when(n < 1e11, n * 1000).otherwise(n)))
        instant = F.when(text.rlike(_ISO), F.unix_millis(text.try_cast("timestamp")))
        return F.coalesce(number, F.when(instant > 0, instant))

    return F.coalesce(*[one(t) for t in texts], F.lit(0)).cast("bigint")


def result_limit(asked: Column, most: int) -> Column:
    """How many results to give: ``asked`` in whole numbers within 1 and ``most``; no number means one."""
    return clamp(F.coalesce(asked.cast("double"), F.lit(float("nan"))), 1, most)


def profile_key(provider: Column, model: Column, **options: Column) -> Column:
    """Hash of an embedding profile: its settings as JSON in one fixed order, absent ones as null."""
    given = lambda n: options.get(n, F.lit(None).cast("string")).alias(n)
    settings = F.struct(
        provider.alias("provider"), model.alias("model"), F.coalesce(options.get("outputDimensionality", F.lit(None).cast("string")), F.lit("auto")).alias("outputDimensionality"),
        *[given(n) for n in ("inputType", "queryInputType", "documentInputType", "remoteBaseUrl", "localModelPath", "localModelCacheDir")],
    )
    return F.sha2(F.to_json(settings, {"ignoreNullFields": "false"}), 256)


def capture_source_id(agent_id: Column, session_key: Column, session_id: Column, session_file: Column, content_hash: Column) -> Column:
    """First 32 hex digits of the hash of a capture's identity; the content counts only where nothing else names it."""
    unnamed = session_id.isNull() & session_file.isNull() & session_key.isNull()
    ident = F.struct(
        agent_id.alias("agentId"), session_key.alias("sessionKey"), session_id.alias("sessionId"), session_file.alias("sessionFile"), F.when(unnamed, content_hash).alias("fallbackContentSha256")
    )
    return F.substring(F.sha2(F.to_json(ident, {"ignoreNullFields": "false"}), 256), 1, 32)


def distinct_names(names: Column) -> Column:
    """Names trimmed, blank ones dropped, each once, in the order of their first place."""
    return F.array_distinct(F.filter(F.transform(names, lambda n: F.trim(n)), lambda n: n.isNotNull() & (n != "")))


def clamp(value: Column, low: int, high: int) -> Column:
    sound = value.isNotNull() & ~F.isnan(value.cast("double"))
    return F.when(sound, F.greatest(F.lit(low), F.least(F.lit(high), F.floor(value)))).otherwise(F.lit(low)).cast("int")


def backoff_ms(attempt: Column, base: int = 2_000, cap: int = 30_000) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2), F.greatest(attempt - 1, F.lit(0))), F.lit(cap)).cast("bigint")


def is_transient(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("|".join(TRANSIENT)), F.lit(False))


def version_key(text: Column) -> Column:
    """Sortable struct of a version ``a.b.c[-pre][+build]``; null if it is none.

    Numbers compare as numbers and before words, a pre-release comes before its release and a shorter
    one before what goes on from it; the build does not count.
    """
    number, word = r"(?:0|[1-9]\d*)", r"(?:0|[1-9]\d*|\d*[A-Za-z-][0-9A-Za-z-]*)"
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), "^v", ""), r"\+.*$", "")
    sound = plain.rlike(rf"^{number}\.{number}\.{number}(?:-{word}(?:\.{word})*)?$")
    core = lambda i: F.regexp_extract(plain, r"^(\d+)\.(\d+)\.(\d+)", i).try_cast("decimal(38,0)")
    pre = F.regexp_extract(plain, r"^[\d.]+-(.+)$", 1)
    parts = F.transform(
        F.when(pre != "", F.split(pre, r"\.")).otherwise(F.array().cast("array<string>")),
        lambda x: F.struct((~x.rlike(r"^\d+$")).alias("word"), F.coalesce(x.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("n"), F.when(x.rlike(r"^\d+$"), "").otherwise(x).alias("w")),
    )
    return F.when(sound, F.struct(core(1).alias("major"), core(2).alias("minor"), core(3).alias("patch"), (pre == "").alias("release"), parts.alias("parts")))


def version_order(left: Column, right: Column) -> Column:
    """-1, 0 or 1 as ``left`` is older than, the same as or newer than ``right``; null if one is no version."""
    a, b = version_key(left), version_key(right)
    return F.when(a.isNull() | b.isNull(), None).when(a < b, -1).when(a > b, 1).otherwise(0)


def chunked(values: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(size))
    return F.when(F.size(values) > 0, F.transform(starts, lambda i: F.slice(values, i, F.lit(size)))).otherwise(F.array().cast("array<array<string>>"))
