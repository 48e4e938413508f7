"""Rules that were once wrong, edges of the operators, and brute-force comparisons of what SQL does not say."""

import itertools
import json
import random
import re
from datetime import datetime, timedelta

from mnemolake.functions import scalars as S
from mnemolake.functions import text as T
from mnemolake.functions import transcript_text as X
from mnemolake.operators import daily, prompts, records, routing, search, selection
from mnemolake.operators.batches import BatchTable
from mnemolake.sources import transcripts
from mnemolake.streaming import drains
from pyspark.sql import functions as F

AT = datetime(2026, 1, 1)


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").select("i", expression(F.col("v")).alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def test_versions(spark):
    pairs = [("1.0.0-rc.2", "1.0.0-rc.10", -1), ("1.0.0-rc.10", "1.0.0", -1), ("v1.2.3+build", "1.2.3", 0), ("1.10.0", "1.9.9", 1), ("1.0.0-1", "1.0.0-a", -1), ("1.0.0-a", "1.0.0-a.1", -1), ("01.2.3", "1.2.3", None), ("1.2", "1.2.0", None), ("1.0.0-", "1.0.0", None), (None, "1.0.0", None), ("1.0.0-01", "1.0.0", None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(pairs)], "i int, a string, b string")
    got = {r["i"]: r["o"] for r in df.select("i", S.version_order(F.col("a"), F.col("b")).alias("o")).collect()}
    assert [got[i] for i in range(len(pairs))] == [p[2] for p in pairs]


def test_errors_times_labels_markers(spark):
    assert column(spark, ["deadlock detected", "Could Not Connect", "server closed the connection unexpectedly", "connection refused", "too many clients", None, ""], S.is_transient) == [True, True, True, False, False, False, False]
    assert column(spark, ["-5", "5", "1787321844000", "2026-01-01T00:00:00Z", "2026-01-01", "1969-01-01T00:00:00Z", "soon", None], S.coerced_millis) == [0, 5000, 1787321844000, 1767225600000, 1767225600000, 0, 0, 0]
    assert column(spark, ["a[b]{c}", "x\n\ty", "ü!?z", " q ", None], T.label) == ["a_b__c_", "x y", "_z", "q", None]
    assert column(spark, ["A_B_C", "say A_B_C", "@abc", "123456", "12345", None], T.is_marker) == [True, False, True, True, False, False]
    assert column(spark, ["a😀b", "a😀b", None], lambda c: T.utf16_slice(c, F.lit(1), F.lit(3))) == ["😀", "😀", None]
    assert column(spark, ["a😀b"], lambda c: T.utf16_slice(c, F.lit(2), F.lit(3))) == [None] and column(spark, ["ab"], lambda c: T.utf16_slice(c, F.lit(0), F.lit(3))) == [None]
    assert column(spark, ["  first\n\nsecond", "x" * 130, "\n \n", None], T.first_line_title) == ["first", "x" * 120 + "…", None, None]


def test_upsert_keeps_the_first_id(spark):
    rows = [("i1", "k", "a", "active", AT), ("i2", "k", "b", "active", AT + timedelta(1)), ("x", "k", None, "deleted", AT + timedelta(2)), ("i3", "k", "c", "active", AT + timedelta(3)), ("f", None, "free", "active", AT), ("g", None, "gone", "deleted", AT)]
    w = spark.createDataFrame([(*r, "u", "w", "n", "fact") for r in rows], "id string, canonical_key string, content string, status string, created_at timestamp, user_id string, workspace_id string, namespace string, type string")
    got = {(r["id"], r["content"], r["new_version"]) for r in records.upserted(w, [F.col("created_at")]).collect()}
    assert got == {("i3", "c", 1), ("f", "free", 1)}
    got = {(r["id"], r["content"], r["new_version"]) for r in records.upserted(w.where("created_at < '2026-01-03'"), [F.col("created_at")]).collect()}
    assert got == {("i1", "b", 2), ("f", "free", 1)} and records.upserted(w.limit(0), [F.col("created_at")]).count() == 0


def test_cover_density_and_candidates(spark):
    rng = random.Random(3)

    def brute(doc, query):
        places = [i for i, w in enumerate(doc, 1) if w in query]
        covers = {}
        for e in places:
            last = [max((i for i in places if doc[i - 1] == q and i <= e), default=None) for q in query]
            if None not in last:
                covers.setdefault(min(last), e)
        return sum(0.1 / (1 + (e - b) - (sum(b <= p <= e for p in places) - 1)) for b, e in covers.items())

    docs = [[rng.choice("abcdefg") for _ in range(rng.randint(0, 30))] for _ in range(60)]
    queries = [rng.sample("abcdefg", rng.randint(1, 3)) for _ in docs]
    df = spark.createDataFrame(list(zip(range(60), docs, queries)), "i int, d array<string>, q array<string>")
    got = {r["i"]: r["x"] for r in df.select("i", search.cover_density(F.col("d"), F.col("q")).alias("x")).collect()}
    assert all(abs(got[i] - brute(d, q)) < 1e-9 for i, (d, q) in enumerate(zip(docs, queries)))


def test_word_similarity_against_brute_force():
    rng = random.Random(8)
    for _ in range(40):
        text, query = (" ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(n)) for n in (5, 2))
        grams = {f"  {w} "[i : i + 3] for w in query.split() for i in range(len(w) + 1)}
        ordered = [f"  {w} "[i : i + 3] for w in text.split() for i in range(len(w) + 1)]
        runs = [set(ordered[a:b]) for a, b in itertools.combinations(range(len(ordered) + 1), 2)]
        want = max((len(r & grams) / len(r | grams) for r in runs if r & grams), default=0.0)
        assert abs(search.word_similarity(text, grams) - want) < 1e-9


ITEM = "user_id string, workspace_id string, id string, version int, status string, type string, title string, content string, canonical_key string, importance smallint, updated_at timestamp, corpus string, rank int"
ENTRY = "user_id string, workspace_id string, id string, path string, content string, source_kind string, logical_date string, updated_at timestamp, score int"


def search_tables(spark):
    item = lambda i, title, content, **k: ("u", "w", i, 1, k.get("status", "active"), "fact", title, content, k.get("key"), k.get("importance"), AT, "x", 1)
    items = spark.createDataFrame([
        item("a", "Red door", "the red door is open"), item("a", "Red door", "the red door is open"), item("b", None, "red paint", importance=9), item("c", "Blue", None), item("d", "red door", "gone", status="deleted"),
        item("e", "Kitchen", "the quarterly statement of the kitchen"), item("f", None, None),
    ], ITEM)
    entries = spark.createDataFrame([("u", "w", "z", "memory/2026-01-01.md", "red door painted", "memory_log", "2026-01-01", AT, 1), ("u", "w", "y", "memory/x.md", "red door secret", "session_memory", "2026-01-01", AT, 1), ("u", "w", "n", None, None, "memory_log", None, None, 1)], ENTRY)
    return items, entries


def test_cascade_tiers_and_routing(spark):
    items, entries = search_tables(spark)
    asked = spark.createDataFrame([("r1", "u", "w", "Red door"), ("r2", "u", "w", "red zebra"), ("r3", "u", "w", "quartely statment"), ("r4", "u", "w", "  !"), ("r5", "u", "other", "red")], "request string, user_id string, workspace_id string, query string")
    hits = search.cascade(items, entries, asked)
    got = {}
    for r in hits.orderBy("request", "rank").collect():
        got.setdefault(r["request"], []).append((r["tier"], r["corpus"], r["id"]))
    assert got["r1"] == [(1, "memory", "a"), (1, "daily", "z")] and got["r2"][0] == (2, "memory", "a") and {h[2] for h in got["r2"]} == {"a", "b", "z"}
    assert got["r3"] == [(3, "memory", "e")] and set(got) == {"r1", "r2", "r3"}
    assert search.cascade(items.limit(0), entries.limit(0), asked).count() == 0 and search.cascade(items, entries, asked.limit(0)).count() == 0
    corpus = routing.Corpus(items, entries)
    found = routing.routed("memory", corpus, asked)
    told = {r["request"]: (r["exact_top1"], r["exact_value"], r["action"]) for r in routing.advice(found, asked).collect()}
    assert told["r1"] == (True, "Red door", "return_exact") and told["r2"][2] == "inspect_top" and told["r5"] == (False, None, "stop_not_found")
    assert routing.routed("memory", corpus, asked, min_score=2.0).count() == 1 and routing.routed("wiki", corpus, asked).count() == 0
    assert {r["mode"] for r in routing.routed("daily", corpus, asked).collect()} == {"fts_daily"}


def test_fusion_prefers_the_higher_appearance(spark):
    shape = "request string, corpus string, id string, path string, score double, importance int, updated_at timestamp, rank int"
    lexical = spark.createDataFrame([("q", "memory", "a", "pa", 0.1, 5, AT, 1), ("q", "daily", "d", "pd", 0.1, None, AT, 2), ("p", "daily", "z", "pz", 0.2, None, AT, 1), ("p", "memory", "y", "py", 0.2, 1, AT, 2)], shape)
    vector = spark.createDataFrame([("q", "memory", "b", "pb", 0.9, 7, AT, 2), ("q", "memory", "a", "pa", 0.8, 5, AT, 3)], shape)
    got = [(r["request"], r["id"], r["rank"], r["shown_score"]) for r in search.fuse(lexical, vector).orderBy("request", "rank").collect()]
    # d and b have the same sum: the durable one comes first; p has no vector hits and keeps its order
    assert got == [("p", "z", 1, 0.2), ("p", "y", 2, 0.2), ("q", "a", 1, 0.8), ("q", "b", 2, 0.9), ("q", "d", 3, 0.1)]


def test_known_candidates(spark):
    items, _ = search_tables(spark)
    cand = spark.createDataFrame([("1", "u", "w", "fact", None, "The  RED door is open"), ("2", "u", "w", "fact", None, "red door"), ("3", "u", "w", "fact", None, "green door"), ("4", "u", "w", "fact", None, " "), ("5", "u", "w", "note", None, None)], "cid string, user_id string, workspace_id string, type string, canonical_key string, content string")
    assert {r["cid"] for r in routing.known_candidates(cand, items).collect()} == {"1", "2", "4", "5"}


def test_captured_messages_against_brute_force(spark):
    rng = random.Random(2)
    texts = ["hello", "ok NO_REPLY then", "NO_REPLY", "/new", "", None, '[{"type":"text","text":"part"},{"text":"two"}]', '[{"image":1}]', "<system>x</system>shown", "tea", "tea"]
    rows = [(s, n, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(texts), rng.choice([None, '{"kind":"inter_session"}', "{}"]), rng.random() < 0.4) for s in range(20) for n in range(rng.randint(0, 25))]

    def clean(t):
        if t is None or t.startswith("/") or t in ("", "NO_REPLY", '[{"image":1}]'):
            return None
        return {"ok NO_REPLY then": "ok  then", texts[6]: "part", texts[8]: "shown"}.get(t, t)

    want = []
    for s in range(20):
        kept, last = [], None
        for _, n, role, text, prov, mirror in sorted(r for r in rows if r[0] == s):
            if role == "tool" or (role == "user" and prov and "inter" in prov):
                continue
            last = None if role == "user" else last
            said = clean(text)
            if said is None or (mirror and role == "assistant" and said == last):
                continue
            kept.append((role, said))
            last = said if role == "assistant" else last
        want += [(s, i, *m) for i, m in enumerate(kept[-4:], 1)]
    df = spark.createDataFrame(rows, "s int, n int, role string, content string, provenance string, m boolean")
    got = transcripts.captured_messages(df, ["s"], [F.col("n")], F.col("m"), most=4)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_visible_text_steps():
    m = X.Markers("Acme")
    event = f"{X.EVENT}\n{X.RESULT_BEGIN}x{X.RESULT_END}{X.ACTION}do"
    assert X.without_legacy_events(f"a\n\n{m.legacy}{event}{X.EVENT_BREAK}{event}\n\nb", m) == "a\n\nb" and X.without_legacy_events(f"{m.legacy}no event", m) == f"{m.legacy}no event"
    assert X.without_prefaces(f"{m.prefaces[1]}\n{X.NOTICE}\n\n\nhello", m) == "hello" and X.without_prefaces(f"{m.prefaces[1]}\nhello", m).endswith("hello")
    memory = f"{X.MEMORY_HEADER}\n{X.MEMORY_OPEN}\nold\n{X.MEMORY_CLOSE}\n\nhello"
    assert X.without_envelope(memory, m) == "hello" and X.without_envelope("My notes (untrusted, mine):\n```json\n{}\n```\nx", m).startswith("My notes")
    assert X.without_envelope(f"Chat {m.context}\nline\n\nhello", m) == "hello" and X.without_envelope(f"hi\nContext: {m.context}\nrest", m) == "hi"
    silent = ["NO_REPLY", "no_reply NO_REPLY", '{"action": " NO_REPLY "}', "<think>x</think> NO_REPLY", "<thinking>a</thinking>I'll stay quiet here. NO_REPLY", "<think>I do not reply. NO_REPLY", "Reasoning:\nprivate thoughts\nNO_REPLY", "thinking\nThe bot will stay silent\nNO_REPLY"]
    spoken = ["hello", "I will stay quiet. NO_REPLY", '{"action": "NO_REPLY", "x": 1}', "<think>x</think> The answer is 4. NO_REPLY", "analysis\nPlease retry\nI will stay silent\nNO_REPLY", ""]
    assert [X.is_silent(t, m) for t in silent] == [True] * len(silent) and [X.is_silent(t, m) for t in spoken] == [False] * len(spoken)
    assert X.visible(f"Read it. {m.poll}", "user", m) and X.visible(m.poll, "user", m) is None and X.visible(X.HEARTBEATS[0] + "\nnow", "user", m) == X.HEARTBEATS[0] + " now"
    assert X.visible("System: [x] exec finished: 0", "assistant", m) is None and X.visible("HEARTBEAT_OK", "assistant", m) is None and X.visible("[cron:1] go", "user", m) is None and X.visible("[cron:1] go", "assistant", m) == "[cron:1] go"


def test_prompt_sections():
    assert prompts.memory_section([], 500, {"fact": 1}) == "" and prompts.daily_section([], 500, 100) == ""
    block = lambda n: f"- (fact) t{n}\n  {'x' * 50}\n\n"
    whole = prompts.memory_section([("fact", block(1)), ("task", block(2)), ("fact", block(3)), ("fact", block(4))], 2_000, {"fact": 2})
    assert "t1" in whole and "t3" in whole and "t2" not in whole and "t4" not in whole and not whole.endswith("\n")
    short = prompts.memory_section([("fact", block(n)) for n in range(9)], len("\n".join(prompts.MEMORY_HEAD)) + 150, {"fact": 9})
    assert "t0" in short and "t1" in short and "t2" not in short
    day = prompts.daily_section([("memory_log", "memory/[a].md", "note ``` end"), ("session_memory", "p", "user: a\nassistant: b"), ("session_memory", "p", " ")], 2_000, 100)
    assert "[Untrusted daily memory: memory/_a_.md]" in day and "\\`\\`\\`" in day and "recent-session-capture-1]" in day and "capture-2" not in day
    head = len("\n".join(prompts.DAILY_HEAD))
    cut = prompts.daily_section([("memory_log", "m", "y" * 500)], head + 200, 500)
    assert "...[truncated]..." in cut and len(cut) <= head + 200 and prompts.daily_section([("memory_log", "m", "y" * 500)], head + 5, 500) == "\n".join(prompts.DAILY_HEAD[:-1])
    assert prompts.newest_messages(["user: a", "user: b"], 7) == "user: b" and prompts.newest_messages(["a" * 50, "user: b"], 49).endswith("omitted]...\nuser: b")


def test_documents_of_blocks(spark):
    rows = [("b1", 0, "one \n", "memory_log", "s1"), ("b2", 1, " \n", "memory_log", "s2"), ("b3", 2, "two\n", "memory_log", None)]
    b = spark.createDataFrame([("u", "w", "p", "2026-01-01", *r) for r in rows], "user_id string, workspace_id string, path string, logical_date string, id string, block_index bigint, content string, source_kind string, source_path string")
    doc = daily.documents(b).first()
    assert doc["content"] == "one\n\ntwo\n" and doc["source_kind"] == "memory_log" and json.loads(doc["metadata"])["lastBlockId"] == "b3" and doc["source_path"] is None
    assert daily.documents(b.limit(0)).count() == 0 and daily.documents(b.where("id <> 'b1'")).first()["content"] == "\n\ntwo\n"


def test_flush_inbox_as_a_stream(spark, tmp_path):
    shape = "user_id string, workspace_id string, rel_path string, logical_date string, content string, extra int"
    put = lambda rows: spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    put([("u", "w", "a.md", "2026-01-01", "one", 1), ("u", "w", "a.md", "2026-01-01", "one", 1), ("u", "w", "b.md", "2026-01-01", "  ", 1)])
    blocks, ledger = BatchTable(spark, f"{tmp_path}/blocks"), BatchTable(spark, f"{tmp_path}/ledger")
    take = lambda files, known: drains.flushed(files, known, F.lit("T"))
    run = lambda: drains.drain_batches(spark.readStream.schema(shape).parquet(str(tmp_path / "in")), blocks, ledger, f"{tmp_path}/state", take)
    run()
    put([("u", "w", "a.md", "2026-01-02", "one", 1), ("u", "w", "a.md", "2026-01-02", "two", 1)])
    run()
    run()
    got = sorted(r["content"] for r in blocks.read(drains.flushed(spark.createDataFrame([], shape), spark.createDataFrame([], "user_id string, workspace_id string, rel_path string, sha256 string"), F.lit("T"))[0].schema).collect())
    assert got == ["## Compaction Flush - T\n- Source: a.md\n\none", "## Compaction Flush - T\n- Source: a.md\n\ntwo"]


def test_files_of_a_folder(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "z.md").write_text("zed")
    (tmp_path / "a.md").write_text("äh")
    (tmp_path / "big.jsonl").write_text("x" * 100)
    (tmp_path / "s.jsonl.reset.2026-01-02T03-04-05Z").write_text("{}")
    assert [tuple(r) for r in transcripts.markdown_files(spark, str(tmp_path)).collect()] == [("a.md", "äh"), ("b/z.md", "zed")]
    assert {r["kind"] for r in transcripts.transcript_files(spark, str(tmp_path), 50).collect()} == {"reset"}
    assert {r["kind"] for r in transcripts.transcript_files(spark, str(tmp_path)).collect()} == {"reset", "primary"}


def test_generated_sessions(spark):
    say = lambda text, role="user", **k: json.dumps({"type": "message", "timestamp": "2026-01-01T00:00:00Z", "message": {"role": role, "content": text}, **k})
    files = [("sessions/a/x.jsonl", "\n".join([say("one"), json.dumps({"type": "custom", "runId": "dreaming-narrative-1"}), say("two")])), ("sessions/a/y.jsonl.reset.2026-01-02T03-04-05Z", "\n".join([say("one"), say("[cron:1] go"), say("two")])), ("sessions/a/z.jsonl", "\n".join([say("[cron:1] go"), say("two", "assistant")]))]
    lines = transcripts.visible_lines(transcripts.parsed_lines(spark.createDataFrame(files, "path string, value string")))
    assert sorted((r["path"][11], r["shown"], r["ms"]) for r in lines.collect()) == [("x", "one", 1767225600000), ("z", "two", 1767225600000)]
    frame = spark.createDataFrame(files, "path string, value string")
    entries = {r["path"][11]: r["line_count"] for r in transcripts.entries(transcripts.chunks(lines), frame).collect()}
    assert entries == {"x": 1, "y": 0, "z": 1}


def test_extractor_answers(spark):
    good = '{"summary": "s", "candidates": [{"content": " tea ", "type": "fact", "canonicalKey": "k", "confidence": 97.9}, {"content": "x", "type": "note"}]}'
    bad = [good.replace('"s"', "1"), good.replace('"fact"', '"task"'), good.replace('"k"', '" "'), good.replace("97.9", '"high"'), good.replace(" tea ", " "), "no json", '{"summary": "s"}', None, "[1]"]
    df = spark.createDataFrame([("g", f"Sure:\n```json\n{good}\n```"), ("p", f"Here {good} done")] + [(f"b{i}", b) for i, b in enumerate(bad)], "k string, t string")
    got = sorted(tuple(r) for r in selection.extractor_candidates(df, "k", "t").collect())
    assert got == [(k, 0, "tea", "fact", "k", 97) for k in "g"] + [("g", 1, "x", "note", None, None)] + [("p", 0, "tea", "fact", "k", 97), ("p", 1, "x", "note", None, None)]


def test_trim_of_white_space():
    assert re.fullmatch(r"\s+", "".join(map(chr, [c for c in T.BLANKS if c != 65279])))


def test_markdown_import(spark):
    from mnemolake.operators import reading

    text = "intro line\n\n# Memory\n## User Preferences\r\n- tea\n- milk\n\nsecond block\n### Facts\nblue\n## Other\nlast\n# Long-term memory\n# Top\n\nend"
    docs = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "", "x"), (4, "# only\n", "x")], "doc_id int, text string, title string")
    got = [(r["title"], r["type"], r["canonical_key"], r["content"]) for r in reading.markdown_items(docs, "doc_id", "text").orderBy("doc_id", "block").collect()]
    assert got == [
        ("Memory", "note", "note:memory", "intro line"), ("User Preferences", "fact", "fact:user-preferences", "- tea\n- milk"), ("User Preferences", "fact", "fact:user-preferences", "second block"),
        ("User Preferences > Facts", "fact", "fact:user-preferences:facts", "blue"), ("Other", "note", "note:other", "last"), ("Top", "note", "note:top", "end"),
    ]
    key = docs.limit(1).select(reading.import_key(F.lit("k"), F.lit(" a\r\nb ")).alias("k")).first()["k"]
    assert key == "memory.md:k:" + __import__("hashlib").sha256(b"a\nb").hexdigest()
