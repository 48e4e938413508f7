import random

from mnemolake.llm import subjects as S

WORDS = {"law": ["court", "statute", "verdict", "clause"], "music": ["choir", "violin", "melody", "tempo"], "sport": ["league", "striker", "referee", "sprint"]}


def test_propagation(spark):
    rng, docs, truth, labels = random.Random(6), [], {}, []
    filler = ["The rest stays open for now.", "Nothing else was decided.", "We will confirm on Monday."]
    for d in range(240):
        subjects = rng.sample(sorted(WORDS), rng.choice([0, 1, 1, 2]))
        lines = [f"The {rng.choice(WORDS[s])} comes before the {rng.choice(WORDS[s])} again." for s in subjects for _ in range(4)] + [rng.choice(filler) for _ in range(2)]
        rng.shuffle(lines)
        docs.append((d, "<!-- export -->\n## 2026-01-01\n" + "\n".join(f"- 06:1{i % 10} {x}" for i, x in enumerate(lines)), "x"))
        truth[d] = set(subjects)
        if d % 4 == 0:
            labels += [(d, s, "r") for s in subjects] * 2
    labels += [(3, "law", "wrong"), (4, "no such subject", "r"), (None, "law", "r"), (9999, "law", "r"), (1, None, "r")]
    docs += [(900, None, "x"), (901, "", "x"), (None, "The court.", "x")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, subject string")
    l = spark.createDataFrame(labels, "doc_id bigint, subject string, rater string")
    s = spark.createDataFrame([(k, "about") for k in WORDS] + [(None, None)], "subject string, description string")
    got = {}
    for r in S.document_subjects(d, l, s).collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    right = sum(got.get(k, set()) == v for k, v in truth.items())
    assert right >= 0.95 * len(truth) and not {900, 901, None} & set(got)
    assert S.document_subjects(d, l.limit(0), s).count() == 0 and S.document_subjects(d.limit(0), l, s).count() == 0


def test_trusted_seed_stays(spark):
    # the labels of 100 to 107 are borne out by their own sentences; that other documents use "forum" for sport takes nothing away
    rng, docs, labels = random.Random(1), [], []
    for d in range(60):
        s = "law" if d % 6 == 0 else ("music", "sport")[d % 2]
        docs.append((d, "\n".join(f"The {rng.choice(WORDS[s])} comes before the {rng.choice(WORDS[s])} again." for _ in range(4))))
        labels.append((d, s))
    docs += [(d, "The forum comes before the forum again.") for d in range(100, 108)]
    labels += [(d, "law") for d in range(100, 108)] + [(59, "law")]  # the last is borne out by nothing
    docs += [(d, "The forum saw the striker and the referee sprint for the league.") for d in range(200, 224)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    l = spark.createDataFrame(labels, "doc_id bigint, subject string")
    s = spark.createDataFrame([(k,) for k in WORDS], "subject string")
    assert {r["doc_id"] for r in S.propagated(d, l, s, rounds=1).where("subject = 'law' and doc_id between 100 and 107").collect()} == set(range(100, 108))
    got = {(r["doc_id"], r["subject"]) for r in S.document_subjects(d, l, s).collect()}
    assert {(d, "law") for d in range(100, 108)} <= got and not {(59, "law"), (200, "law")} & got


def test_sentences(spark):
    text = "# Head\n<!-- x -->\n- 06:10 One thing. Is it two? user: no\nassistant: Three things; and more!\n\n2026-01-01"
    got = spark.createDataFrame([(text,)], "t string").select(S.sentence_array(S.F.col("t")).alias("s")).first()["s"]
    assert got == ["One thing.", "Is it two? user: no", "Three things; and more!"]
