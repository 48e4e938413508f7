"""Search in a hot scope: which pairs of text and request meet at all, against brute force."""

import random
import re

import pytest
from mnemolake.functions import text as T
from mnemolake.operators import routing, search
from pyspark.sql import functions as F


def test_candidates_meet_by_the_rarest_lexeme(spark, monkeypatch):
    rng = random.Random(5)
    words = ["configuration", "a", "of", *[f"w{i}" for i in range(40)]]
    docs = [("u", "hot" if i % 4 else None, f"d{i:03d}", " ".join(["configuration", f"n{i}", *rng.choices(words, k=6)])) for i in range(300)]
    asked = [(f"r{i}", "u", "hot" if i % 3 else "cold", f"Configuration n{i} {'w1' if i % 2 else ''}") for i in range(120)] + [("none", "u", "hot", "configuration zzz"), ("empty", "u", "hot", "--"), ("null", "u", None, "configuration")]
    asked += [("all", "u", "hot", "configuration"), ("twice", "u", "hot", "a"), ("twice", "u", "hot", "of")]
    tables, keep = {}, search.written
    monkeypatch.setattr(search, "written", lambda df, tag: tables.setdefault(tag, keep(df, tag)))
    d = spark.createDataFrame(docs, "user_id string, workspace_id string, id string, content string").withColumn("_doc", T.lexemes(F.col("content")))
    r = spark.createDataFrame(asked, "request string, user_id string, workspace_id string, query string")
    split = lambda t: set(re.findall(r"[a-z0-9]+", t.lower()))
    want = sorted((x[0], x[3], y[2]) for x in asked for y in docs if x[1:3] == y[:2] and None not in y[:2] and split(x[3]) and split(x[3]) <= split(y[3]))
    for limit in (search.BROADCAST_ROWS, 0):  # by broadcast and by shuffle
        tables.clear()
        monkeypatch.setattr(search, "BROADCAST_ROWS", limit)
        assert sorted(map(tuple, search.candidates(search.indexed(d), r).select("request", "query", "id").collect())) == want
        picked = {x["request"]: x["_n"] for x in tables["search-picked"].join(tables["search-asked"], "_r").collect()}
        assert all(picked[k] == 1 for k in picked if k[1:].isdigit()) and "none" not in picked  # the longest lexeme is in all 300 texts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_has_many_rows_is_not_broadcast(spark, monkeypatch):
    """Small files in a compressed folder may be large in memory; only counted rows decide (F6)."""
    plans, keep = {}, search.written
    monkeypatch.setattr(search, "written", lambda df, tag: plans.setdefault(tag, _plan(df)) and keep(df, tag))
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(search, "BROADCAST_BYTES", 0, raising=False)
    d = spark.createDataFrame([("u", "w", "d1", "a b")], "user_id string, workspace_id string, id string, content string").withColumn("_doc", T.lexemes(F.col("content")))
    r = spark.createDataFrame([("r1", "u", "w", "B")], "request string, user_id string, workspace_id string, query string")
    found = search.candidates(search.indexed(d), r)
    assert [tuple(x) for x in found.select("request", "id").collect()] == [("r1", "d1")]
    assert "Broadcast" not in plans["search-picked"] and "Broadcast" not in _plan(found)


ITEM = "user_id string, workspace_id string, id string, version int, status string, type string, title string, content string, canonical_key string, importance int, updated_at timestamp"
ENTRY = "user_id string, workspace_id string, id string, path string, content string, source_kind string, logical_date string, updated_at timestamp"
CHUNK = "user_id string, workspace_id string, id string, path string, chunk_index int, start_line int, end_line int, text string, created_at timestamp"


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """Limits of nothing; tables of one scope and the requests for them."""
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(search, "BROADCAST_BYTES", 0, raising=False)
    i = spark.createDataFrame([("u", "w", f"i{n}", 1, "active", "note", f"title {n}", f"plain words {n}", None, 1, None) for n in range(3)], ITEM)
    e = spark.createDataFrame([("u", "w", "e1", "p1", "plain entry", "note", "2026-01-01", None)], ENTRY)
    c = spark.createDataFrame([("u", "w", "c1", "sessions/a/s.jsonl", 0, 1, 1, "plain text", None)], CHUNK)
    r = spark.createDataFrame([("r1", "u", "w", "plain words nowhere")], "request string, user_id string, workspace_id string, query string")
    return i, e, c, r


def _broadcast_by(df, key):
    return f"BroadcastHashJoin [{key}" in _plan(df)


def test_relaxed_forms_are_not_broadcast(no_broadcast):
    i, e, _, r = no_broadcast
    hits = search._relaxed_hits(search.item_docs(i), search.daily_docs(e), r, 10)
    assert {x["id"] for x in hits.collect()} == {"i0", "i1", "i2", "e1"} and not _broadcast_by(hits, "request#")


def test_requests_of_the_fuzzy_tier_are_not_broadcast(no_broadcast):
    i, _, _, r = no_broadcast
    hits = search.fuzzy_items(i, r)
    assert {x["id"] for x in hits.collect()} == {"i0", "i1", "i2"} and not _broadcast_by(hits, "user_id#")


def test_lists_to_be_fused_are_not_broadcast(no_broadcast):
    i, e, _, r = no_broadcast
    r = r.withColumn("query", F.lit("plain"))
    a = search._items_as_hits(search.strict_items(i, r)).unionByName(search._daily_as_hits(search.strict_daily(e, r)))
    fused = search.fuse(search._ranked(a, search.hit_order(), 10), a.limit(0).withColumn("rank", F.lit(1)))
    assert fused.count() == 4 and not _broadcast_by(fused, "_d#") and not _broadcast_by(fused, "_r#")


def test_said_candidates_are_not_broadcast(no_broadcast):
    i, _, _, r = no_broadcast
    c = r.select(F.col("request").alias("cid"), "user_id", "workspace_id", F.lit("note").alias("type"), F.lit(None).cast("string").alias("canonical_key"), F.lit("words").alias("content"))
    known = routing.known_candidates(c, i)
    assert [x["cid"] for x in known.collect()] == ["r1"] and not _broadcast_by(known, "_d#") and not _broadcast_by(known, "_r#")


def test_routed_requests_are_not_broadcast(no_broadcast):
    _, _, c, r = no_broadcast
    hits = routing.routed("sessions", routing.Corpus(chunks=c), r.withColumn("query", F.lit("plain")))
    assert [x["id"] for x in hits.collect()] == ["c1"] and not _broadcast_by(hits, "request#")


def test_sources_of_the_manager_are_not_broadcast(no_broadcast):
    _, _, c, r = no_broadcast
    hits = routing.manager(routing.Corpus(chunks=c), r.withColumn("query", F.lit("plain")), ("sessions",))
    assert [x["id"] for x in hits.collect()] == ["c1"] and not _broadcast_by(hits, "_d#") and not _broadcast_by(hits, "_r#")


EMBEDDING = "memory_item_id string, profile_key string, embedding array<float>, memory_item_version int, dimensions int, updated_at timestamp"
VECTORS = "request string, user_id string, workspace_id string, profile_key string, vector array<float>"


def test_no_join_of_the_vector_search_is_left_to_the_optimizer(spark, no_broadcast):
    """Items of a scan may be many times as large in memory as in their files (F7)."""
    i, _, _, _ = no_broadcast
    e = spark.createDataFrame([(f"i{n}", "p", [1.0, float(n)], 1, 2, None) for n in range(3)], EMBEDDING)
    v = spark.createDataFrame([("r1", "u", "w", "p", [0.0, 1.0])], VECTORS)
    i, e, v = (search.written(x, "vector-test") for x in (i, e, v))  # files, whose size the optimizer knows
    near = search.semantic(i, e, v)
    assert [x["id"] for x in near.orderBy("rank").collect()] == ["i2", "i1", "i0"] and "Broadcast" not in _plan(near)
    fused = search.fuse(near.withColumn("corpus", F.lit("memory")).limit(0), near.withColumn("corpus", F.lit("memory")))
    assert fused.count() == 3 and "Broadcast" not in _plan(fused)
    few = [r["id"] for r in search.semantic(i, e.limit(0), v).collect()] + [r["id"] for r in search.semantic(i, e, v.limit(0)).collect()]
    assert few == []


def test_no_join_of_said_candidates_is_left_to_the_optimizer(spark, no_broadcast):
    """By key, by text and by words (F8)."""
    i, _, _, r = no_broadcast
    i = i.unionByName(spark.createDataFrame([("u", "w", "k1", 1, "active", "note", None, "other", "key", 1, None)], ITEM))
    said = [("key", "u", "w", "note", "key", "nothing of it"), ("text", "u", "w", "fact", None, " Plain  WORDS 1 "), ("words", "u", "w", "fact", None, "words 2"), ("new", "u", "w", "fact", "key", "nothing of it"), ("far", "u", "v", "note", "key", "other")]
    known = routing.known_candidates(spark.createDataFrame(said, "cid string, user_id string, workspace_id string, type string, canonical_key string, content string"), i)
    assert sorted(x["cid"] for x in known.collect()) == ["key", "text", "words"] and "Broadcast" not in _plan(known)
