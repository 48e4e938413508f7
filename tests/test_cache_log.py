"""Outcomes of a cache for one key with a long log."""

import random
import time

from mnemolake.streaming import schedules


def test_long_log_of_one_key(spark):
    rng = random.Random(4)
    events = [("a", rng.randrange(40_000_000), "drop" if rng.random() < 0.1 else "read") for _ in range(120_000)] + [("b", 5, "read"), ("b", None, "read"), (None, 5, "read"), (None, 6, "read")]
    want, last, loaded = [], "", None
    for k, at, kind in sorted(events, key=lambda e: (e[0] or "", e[1] if e[1] is not None else -1, e[2])):
        if k != last:
            last, loaded = k, None
        if kind == "drop":
            loaded = None
        elif loaded is not None and at < loaded + 60_000:
            want.append((k, at, "hit"))
        else:
            loaded = at
            want.append((k, at, "load"))
    df = spark.createDataFrame(events, "agent string, at_ms bigint, kind string").cache()
    df.count()
    began = time.time()
    got = [tuple(r) for r in schedules.cache_outcomes(df, "agent").collect()]
    assert time.time() - began < 60  # a copy of the outcomes at each event takes many times that
    order = lambda r: (r[0] or "", r[1] if r[1] is not None else -1, r[2])
    assert sorted(got, key=order) == sorted(want, key=order)
