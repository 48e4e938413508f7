import random

from mnemolake.llm import contamination as C

DOC, ITEM = "doc_id bigint, text string, item_id string, h int", "item_id bigint, passage string, question string, text string"


def test_against_brute_force(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta", "7", "days", "Orzan", "und"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, say(20), say(14)) for i in range(6)] + [(6, None, "short"), (7, None, None), (None, say(20), None), (0, items0 := say(15), None)]
    docs = [(d, say(rng.randint(0, 30))) for d in range(30)]
    docs += [(100, "x " + items[1][1][5:].upper() + "!"), (101, items[2][2].replace(" ", ",\n")), (102, items0), (103, None), (104, ""), (104, items[3][1]), (None, items[3][1]), (105, "w " * 30_000 + items[4][1])]
    split = lambda t: __import__("re").findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
    want = {(d, i) for d, t in docs if d is not None for i, p, q in items if i is not None and grams(split(t)) & (grams(split(p)) | grams(split(q)))}
    dd = spark.createDataFrame([(*d, "x", 1) for d in docs], DOC)
    ii = spark.createDataFrame([(*i, "x") for i in items], ITEM)
    assert {tuple(r) for r in C.verbatim_leaks(dd, ii).collect()} == want and len(want) >= 5
    assert C.verbatim_leaks(dd.limit(0), ii).count() == 0 and C.verbatim_leaks(dd, ii.limit(0)).count() == 0


def test_reparameterised(spark):
    items = spark.createDataFrame([(1, "When the keeper Orzan left Mossar with 14 pots he came back to Mossar after 3 days.", None)], "item_id bigint, passage string, question string")
    docs = spark.createDataFrame([
        (1, "when the keeper mossar left orzan with 99 pots he came back to orzan after 5 weeks."),  # consistent
        (2, "when the keeper mossar left orzan with 99 pots he came back to mossar after 5 weeks."),  # inconsistent
        (3, "When the keeper Orzan left Mossar with 14 pots he came back to Mossar after 3 days."),  # verbatim
    ], "doc_id bigint, text string")
    assert [(r["doc_id"], r["item_id"]) for r in C.reparameterised_leaks(docs, items).collect()] == [(1, 1)]


def test_an_edited_word_hides_neither_run(spark):
    twin = "Orzan sold {a} cups to Mossar and kept {b} cups for the long winter {w} then Orzan walked {a} miles to the old town where nobody knew that he kept {b} cups"
    items = spark.createDataFrame([(1, twin.format(a=3, b=5, w="and"), None)], "item_id bigint, passage string, question string")
    docs = spark.createDataFrame([(1, twin.format(a=8, b=9, w="but")), (2, "unrelated " * 40)], "doc_id bigint, text string")
    assert [(r["doc_id"], r["item_id"]) for r in C.reparameterised_leaks(docs, items).collect()] == [(1, 1)]


def test_tables_of_numbers_stay_linear(spark):
    items = spark.createDataFrame([(1, None, " ".join(map(str, range(15))))], "item_id bigint, passage string, question string")
    docs = spark.createDataFrame([(1, " ".join(map(str, range(1_000, 5_000))))], "doc_id bigint, text string")
    pairs = C.aligned_windows(docs, items, 13)
    assert pairs.count() == 3 * 3_988 and "_w" not in pairs.columns and C.verbatim_leaks(docs, items).count() == 0
