import numpy as np
from mnemolake.llm import neighbours as N

SHAPE = "memory_item_id string, profile_key string, embedding array<float>, dimensions int, g int, q string, id string"


def exact(rows, k=5):
    pairs = set()
    for profile in {r[1] for r in rows if r[1]}:
        vectors = {}
        for id_, p, v, n in rows:
            if p == profile and id_ and v is not None and n == len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
                vectors[id_] = np.array(v, dtype=np.float64)
        ids = sorted(vectors)
        x = np.stack([vectors[i] / np.linalg.norm(vectors[i]) for i in ids]) if ids else np.zeros((0, 1))
        sims = np.round(x @ x.T, 6)
        for a, row in enumerate(sims):
            order = [b for b in np.lexsort((np.arange(len(ids)), -row)) if b != a][:k]
            pairs |= {(profile, min(ids[a], ids[b]), max(ids[a], ids[b])) for b in order}
    return pairs


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SHAPE)
    return {tuple(r) for r in N.neighbour_pairs(df, **kw).collect()}


def test_copies_bad_vectors_and_small_profiles(spark):
    rng = np.random.default_rng(1)
    same = [float(x) for x in rng.normal(size=8)]
    rows = [(f"c{i:02d}", "p", same, 8) for i in range(9)] + [(f"v{i:02d}", "p", [float(x) for x in rng.normal(size=8)], 8) for i in range(30)]
    rows += [rows[0], ("bad1", "p", None, 8), ("bad2", "p", [1.0], 8), ("bad3", "p", [float("nan")] * 8, 8), ("bad4", "p", [0.0] * 8, 8), ("bad5", "p", [None] * 8, 8), (None, "p", same, 8), ("bad6", None, same, 8)]
    rows += [(f"s{i}", "small", [1.0, float(i)], 2) for i in range(4)] + [("only", "one", [1.0], 1)]
    assert found(spark, rows) == exact(rows)
    assert found(spark, []) == set()


def test_recall_with_many_lists_and_blocks(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    x = (centres[rng.integers(0, 30, 2500)] + 0.5 * rng.normal(size=(2500, 16))).astype(np.float32)
    rows = [(f"i{i:05d}", "p", [float(a) for a in v], 16) for i, v in enumerate(x)]
    want = exact(rows)
    assert len(found(spark, rows, list_size=100) & want) >= 0.95 * len(want)
    # one centroid only: every list is cut into blocks, and the search is exhaustive
    blocked = found(spark, rows, list_size=100, max_lists=1)
    assert len(blocked & want) >= 0.999 * len(want)


def test_many_profiles_with_and_without_broadcast(spark):
    rng = np.random.default_rng(3)
    rows = [(f"i{i:04d}", f"p{i % 60}", [float(a) for a in rng.normal(size=4)], 4) for i in range(600)]
    assert found(spark, rows) == found(spark, rows, broadcast_bytes=0) == exact(rows)
