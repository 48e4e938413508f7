from mnemolake.llm import duplicates as D

SHAPE = "id string, content string, canonical_key string, key int, bucket string, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SHAPE)


ROWS = [
    ("a", "The  deadline—moved!", "Law/Key"), ("b", "the deadline moved", "law key"), ("b", "the deadline moved", "law key"), ("c", "the deadline moved", None),
    ("d", '{"x": [1, 2], "y": {"b": 1.50, "a": "Ü"}}', None), ("e", '{\n "Y": {"a": "ü", "b": 1.50},\n "x": [1,2]}', None), ("f", '{"x": [2, 1], "y": {"b": 1.50, "a": "Ü"}}', None), ("f2", '{"x": [1, 2], "y": {"b": 1.5, "a": "Ü"}}', None),
    ("g", "owner: me\ndue : now", None), ("h", "* DUE: now\n* Owner:me", None), ("i", "first line\nsecond line", None), ("j", "second line\nfirst line", None),
    ("k", None, None), ("l", None, None), ("m", "", None), ("n", "...", None), (None, "x", None), ("s1", "Straße", None), ("s2", "STRASSE", None), ("z1", "w " * 100_000, None), ("z2", "W  " * 100_000, None), ("bad", '{"x": ', None),
]
PAIRS = {("a", "b"), ("d", "e"), ("g", "h"), ("k", "l"), ("m", "n"), ("s1", "s2"), ("z1", "z2")}


def test_groups_in_any_number_of_batches(spark):
    for batches in (1, 3):
        ledger = D.build_ledger(frame(spark, ROWS), batches=batches, buckets=3)
        assert {tuple(r) for r in ledger.copies().collect()} == PAIRS
    counts = {r["first_id"]: r["copies"] for r in ledger.collapsed().collect()}
    assert counts["a"] == 2 and counts["c"] == 1 and sum(counts.values()) == len({r[0] for r in ROWS if r[0]})


def test_same_delivery_again_and_empty(spark):
    ledger = D.build_ledger(frame(spark, ROWS), batches=1)
    ledger.apply(frame(spark, ROWS))
    ledger.apply(frame(spark, []))
    assert {tuple(r) for r in ledger.copies().collect()} == PAIRS
    assert D.build_ledger(frame(spark, [])).copies().count() == 0


def test_reopened_ledger_reads_touched_buckets_only(spark, tmp_path):
    at = f"file://{tmp_path}/ledger"
    D.DuplicateLedger(spark, 64, at).apply(frame(spark, ROWS))
    again = D.DuplicateLedger(spark, 3, at)
    assert again.buckets == 64 and again.batches == 1
    asked, members = [], again.members
    again.members = lambda only=None: asked.append(only) or members(only)
    again.apply(frame(spark, [("a0", "THE DEADLINE MOVED", "law key"), ("a", "The deadline moved", "law key")]))
    assert [len(b) for b in asked] == [1]
    assert {tuple(r) for r in D.DuplicateLedger(spark, path=at).copies().collect()} == (PAIRS - {("a", "b")}) | {("a", "b"), ("a", "a0")}
