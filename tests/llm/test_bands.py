"""Bands of long sentences, against all pairs of their words."""

import math

from mnemolake.llm import subjects as S


def test_every_verified_pair_is_a_band(spark):
    # in the last text two rare words stand at both ends of the alphabet, with more than eight words between them
    common = [f"m{chr(97 + i)}x" for i in range(14)]
    docs = [(i, [common]) for i in range(400)] + [(1000, [["aaa", *common, "zzz"]]), (1001, [["only"]]), (1002, [["one", "two", "three"]])]
    df = spark.createDataFrame(docs, "doc_id int, sents array<array<string>>")
    n = 403
    seen = {}
    for _, sents in docs:
        for w in sents[0]:
            seen[w] = seen.get(w, 0) + 1
    want = {}
    for d, sents in docs:
        i = {w: math.log((n + 1) / seen[w]) for w in sents[0]}
        pairs = [(i[a] + i[b]) / sum(i.values()) for a in i for b in i if a < b] or [1.0]
        want[d] = sorted(round(v, 9) for v in pairs if v >= S.VERIFIED)
    got = {r["doc_id"]: sorted(round(b["v"], 9) for b in r["bands"]) for r in S.banded(df, n, 1).collect()}
    assert got == {d: v for d, v in want.items() if v}
