import hashlib
import json
import random
from datetime import datetime, timedelta

import pytest
from mnemolake.operators.changefeed import current_state

SHAPE = "id string, item_id string, operation string, before string, after string, created_at timestamp, place int"


def image(version, content):
    return None if version is None else json.dumps({"version": version, "content": content})


def brute(rows):
    by = {}
    for id_, item, op, b, a, at, _ in rows:
        if item is not None and op in ("insert", "update", "delete", "soft_delete"):
            by.setdefault(item, {}).setdefault(id_, (at, json.loads(b)["version"] if b else -1, id_, op, json.loads(a) if a else None))
    out = set()
    for item, changes in by.items():
        now = None
        for at, before, _, op, after in sorted(changes.values(), key=lambda c: c[:3]):
            if op == "insert":
                now = after if now is None else now
            elif now is not None and now["version"] == before:
                now = after if op == "update" else None
        if now is not None:
            out.add((item, now["version"], hashlib.sha256(now["content"].encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bound", [(1_000, 20_000), (3, 4)])
def test_against_brute_force(spark, bound):
    rng, rows, start = random.Random(5), [], datetime(2026, 1, 1)
    for i in range(40):
        version, at = 0, start
        for n in range(rng.randint(1, 12)):
            op = rng.choice(["insert", "update", "update", "update", "delete", "soft_delete"])
            at += timedelta(seconds=rng.choice([0, 1, 5]))
            before = None if op == "insert" else max(1, version - rng.choice([0, 0, 1]))
            version += op in ("insert", "update")
            rows.append((f"c{i}-{n}", f"i{i}", op, image(before, "b"), image(version, f"text {version} ü") if op != "delete" else None, at, 1))
            if rng.random() < 0.3:
                rows.append(rows[-1])
    rng.shuffle(rows)
    rows += [("n1", None, "daily_block_append", None, "{}", start, 0), ("n2", None, "insert", None, None, None, 0)]
    got = {tuple(r) for r in current_state(spark.createDataFrame(rows, SHAPE), max_history=bound[0], segment_size=bound[1]).collect()}
    assert got == brute(rows)


def test_edges(spark):
    at = datetime(2026, 1, 1)
    rows = [("a", "x", "insert", None, "not json", at, 0), ("b", "y", "insert", None, image(1, ""), None, 0), ("c", "z", "update", None, image(2, "q"), at, 0)]
    got = {tuple(r) for r in current_state(spark.createDataFrame(rows, SHAPE)).collect()}
    assert got == {("x", None, None), ("y", 1, hashlib.sha256(b"").hexdigest())}
    assert current_state(spark.createDataFrame([], SHAPE)).count() == 0
    base = spark.createDataFrame([("q", 4, "h")], "item_id string, version bigint, content_sha256 string")
    assert [tuple(r) for r in current_state(spark.createDataFrame([], SHAPE), base).collect()] == [("q", 4, "h")]


def test_base_and_images_of_one_version(spark):
    at = datetime(2026, 1, 1)
    rows = [
        ("a", "x", "insert", None, image(1, "old"), at, 0), ("b", "x", "delete", image(1, "old"), None, at + timedelta(1), 0),
        ("c", "x", "insert", None, image(1, "new"), at + timedelta(2), 0), ("d", "q", "update", image(4, "?"), image(5, "then"), at, 0),
    ]
    base = spark.createDataFrame([("q", 4, "h"), ("r", 1, "k")], "item_id string, version bigint, content_sha256 string")
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for bound in ((1_000, 20_000), (0, 1)):
        got = {tuple(r) for r in current_state(spark.createDataFrame(rows, SHAPE), base, *bound).collect()}
        assert got == {("x", 1, digest("new")), ("q", 5, digest("then")), ("r", 1, "k")}


def test_one_item_with_a_long_history_at_one_instant(spark):
    n, at = 3_000, datetime(2026, 1, 1)
    rows = [("c000000", "hot", "insert", None, image(1, "t1"), at, 0)] + [(f"c{i:06d}", "hot", "update", image(i, f"t{i}"), image(i + 1, f"t{i + 1}"), at, 0) for i in range(1, n)]
    rows += [(f"d{i:06d}", "hot", "update", image(i, "again"), image(i + 1, "again"), at + timedelta(1), 0) for i in range(1, n, 7)]
    got = [tuple(r) for r in current_state(spark.createDataFrame(rows, SHAPE), max_history=100, segment_size=150).collect()]
    assert got == [("hot", n, hashlib.sha256(f"t{n}".encode()).hexdigest())]
