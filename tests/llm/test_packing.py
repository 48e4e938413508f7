import os
import random
from collections import Counter

import pytest
from mnemolake.llm import packing as K


def test_algorithm_fills_and_keeps_counts():
    rng = random.Random(3)
    for capacity in (7, 64, 1000):
        histogram = Counter(rng.randint(1, capacity) for _ in range(5000))
        patterns = K.shortest_pack_first(dict(histogram), capacity)
        placed = Counter()
        for p in patterns:
            assert sum(n * k for n, k in p.lengths.items()) == capacity - p.room and p.room >= 0 and p.count > 0
            for n, k in p.lengths.items():
                placed[n] += k * p.count
        assert placed == histogram
        used = sum(n * k for n, k in histogram.items())
        assert used / (capacity * sum(p.count for p in patterns)) > 0.9
    assert K.shortest_pack_first({}, 5) == []


@pytest.mark.skipif(not os.path.exists(K.TOKENIZER_FILE), reason="no tokenizer file")
def test_texts(spark):
    texts = [(i, "word " * (i % 9 + 1), 1) for i in range(300)] + [(1000, "long " * 200, 1), (1001, "", 1), (1002, None, 1), (None, "x", 1), (5, "word ", 1)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, tokens int")
    budgets = spark.createDataFrame([("a", 16), ("b", 64), ("none", None), ("zero", 0)], "budget_name string, capacity_tokens int")
    rows = K.packed(docs, budgets).collect()
    capacity = {"a": 16, "b": 64}
    fill, pieces = Counter(), Counter()
    for r in rows:
        fill[r["budget_name"], r["container_no"]] += r["tokens"]
        pieces[r["budget_name"], r["doc_id"]] += 1
    assert all(v <= capacity[b] for (b, _), v in fill.items())
    for b in capacity:
        assert {n for (x, n) in fill if x == b} == set(range(sum(x == b for x, _ in fill)))
        assert {d for (x, d) in pieces if x == b} == {*range(300), 1000}
        assert pieces[b, 5] == 2 and pieces[b, 7] == 1 and pieces[b, 1000] > 2
    assert K.packed(docs.limit(0), budgets).count() == 0 and K.packed(docs, budgets.limit(0)).count() == 0
