"""Subject areas of documents (problem 10): label propagation by iterative DataFrame joins.

The similarity graph joins documents through their sentences by banded signatures. A band is a pair
of distinctive words of one sentence, and every pair is one if it is verified; words that stand in more documents than a subject has (``COMMON`` of
an even share) are no part of any band. All sentences with one band are similar by it, if the
similarity is verified for each of them: the two words make up at least ``VERIFIED`` of the weight
(inverse document frequency) of the sentence's distinctive words. One word of such a pair makes up half of that, which few words of a sentence can, so
only pairs with one of those are looked at. So two documents are linked where
they share two rare words in one sentence of each, and those are a good part of both sentences. A
band is a node between its sentences, which keeps the graph linear in the text however many
documents share it; pairs of documents are never listed.

Labels start at the documents labelled by hand and flow document -> sentence -> band -> sentence ->
document, ``rounds`` times, each flow a join. A band passes on a subject as far as its votes agree
(with ``SMOOTH`` votes for none of them), a sentence takes the subject that its bands agree on by at
least ``enough``. A hand label is trusted once ``share`` of the sentences of its document bear it out
in some round, and clamped from then on: the sentences of its document without a subject of their
own vote for it in every later round, and the result holds it with the most sentences that bore it
out. Labels that the text never supports so far are dropped, and missing ones are found. Every
sentence has one subject or none, a document keeps every subject that at least ``share`` of its
sentences are about, so several subjects stay side by side.

Counts are over all sentences of all documents. The tables of words and of bands are broadcast only
if their counted size allows.

Defined results: null or empty texts have no sentences and no subject; null ids are ignored;
repeated label rows count once; without any label, or with none on existing documents, no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemolake.functions.timestamps import once
from mnemolake.runtime import written

COMMON = 1.2
VERIFIED = 0.3
SMOOTH = 0.5
BROADCAST_ROWS = 1_000_000


def sentence_array(text: Column) -> Column:
    """Sentences without list marks, clock times, speaker names, headings and comments."""
    plain = F.regexp_replace(text, r"(?s)<!--.*?-->", "\n")
    plain = F.regexp_replace(plain, r"(?m)^\s*#{1,6} .*$", "\n")
    plain = F.regexp_replace(plain, r"(?m)^\s*(?:[-*•]\s+)?(?:\d{1,2}:\d{2}(?::\d{2})?\s+)?(?:(?i:user|assistant): )?", "")
    parts = F.split(plain, r"\n+|(?<=[.!?…][\"')\]]{0,1})\s+(?=[\p{Lu}\p{N}¿¡\"'(\[-])")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda s: s.rlike(r"\p{L}{2}"))


def word_set(sentence: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(sentence), F.lit(r"(\p{L}{3,})"), F.lit(1)))


def sentences(documents: DataFrame) -> DataFrame:
    """(``doc_id``, ``sents``: the word sets of its sentences in order) of every document with a sentence."""
    rows = documents.where("doc_id is not null and text is not null").select("doc_id", F.transform(sentence_array(F.col("text")), word_set).alias("sents"))
    return once(rows, "sents").where(F.size("sents") > 0)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def banded(docs: DataFrame, documents: int, subjects: int) -> DataFrame:
    """(``doc_id``, ``sent``, ``bands``: array of (``b``, ``v``)) of every sentence with a verified band; ``v`` is its part of the sentence's weight."""
    spread = docs.select(F.explode(F.array_distinct(F.flatten("sents"))).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    rare = written(spread.where(F.col("df") <= F.lit(COMMON) * documents / subjects).select("w", F.log(F.lit(documents + 1) / F.col("df")).alias("i")), "subject-words")
    kept = docs.select("doc_id", F.posexplode("sents").alias("sent", "words")).select("doc_id", "sent", F.explode("words").alias("w")).join(_small(rare), "w")
    kept = kept.groupBy("doc_id", "sent").agg(F.array_sort(F.collect_list(F.struct("w", "i"))).alias("ws"), F.sum("i").alias("all"))
    alone = F.size("ws") == 1  # a sentence with one distinctive word has it as its band

    def bands(a: Column) -> Column:
        pair = F.filter("ws", lambda b: (b["w"] != a["w"]) & ((b["w"] > a["w"]) | (b["i"] < half)) & ((a["i"] + b["i"]) / F.col("all") >= VERIFIED))
        return F.transform(pair, lambda b: F.struct(F.xxhash64(F.least(a["w"], b["w"]), F.greatest(a["w"], b["w"])).alias("b"), ((a["i"] + b["i"]) / F.col("all")).alias("v")))

    half = VERIFIED / 2 * F.col("all") * (1 - 1e-9)  # of a verified pair one word has as much; of two such words the first lists the pair
    paired = F.flatten(F.transform(F.filter("ws", lambda a: a["i"] >= half), bands))
    single = F.array(F.struct(F.xxhash64(F.get("ws", F.lit(0))["w"], F.get("ws", F.lit(0))["w"]).alias("b"), F.lit(1.0).alias("v")))
    verified = F.when(alone, single).otherwise(paired)
    return once(kept.select("doc_id", "sent", verified.alias("bands")), "bands").where(F.size("bands") > 0)


def propagated(documents: DataFrame, labels: DataFrame, subjects: DataFrame, rounds: int = 3, enough: float = 0.7, share: float = 0.2) -> DataFrame:
    """(``doc_id``, ``subject``, ``n``, ``of``): sentences of each subject, and sentences in all."""
    known = subjects.where("subject is not null").select("subject").distinct()
    names = sorted(r["subject"] for r in known.collect())  # a table of parameters
    if not names:
        return labels.limit(0).select("doc_id", "subject", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("of"))
    split = written(sentences(documents), "subject-sentences")
    sizes = written(split.groupBy("doc_id").agg(F.sum(F.size("sents")).alias("of")), "subject-sizes")
    sents = written(banded(split, sizes.count(), len(names)), "subject-bands")
    seeds = labels.where("doc_id is not null").join(F.broadcast(known), "subject", "left_semi").select("doc_id", "subject").distinct()
    seeds = written(seeds.join(sizes, "doc_id", "left_semi"), "subject-seeds")

    # first votes: the sentences of a labelled document vote for its labels, in equal parts
    weight = seeds.groupBy("doc_id").agg(F.collect_list("subject").alias("subjects"))
    votes = sents.join(weight, "doc_id").select("bands", F.explode("subjects").alias("subject"), (1.0 / F.size("subjects")).alias("x"))
    docs = clamp = None
    for turn in range(rounds):
        sums = votes.select("subject", "x", F.inline("bands")).groupBy("b").agg(*[F.sum(F.when(F.col("subject") == n, F.col("x"))).alias(f"n{i}") for i, n in enumerate(names)], F.sum("x").alias("t"))
        passed = written(sums.select("b", *[(F.coalesce(f"n{i}", F.lit(0.0)) / (F.col("t") + SMOOTH)).alias(f"p{i}") for i in range(len(names))]), f"subject-passed-{turn}")
        edges = sents.select("doc_id", "sent", F.inline("bands")).join(_small(passed), "b")
        scores = edges.groupBy("doc_id", "sent").agg(*[F.sum(F.col(f"p{i}") * F.col("v")).alias(f"s{i}") for i in range(len(names))], F.sum("v").alias("v"))
        held = lambda i: F.col(f"s{i}") / F.col("v")
        if docs is not None:  # what the document is about already helps its doubtful sentences
            known_of = docs.groupBy("doc_id").agg(*[F.max(F.when(F.col("subject") == n, F.col("n") / F.col("of"))).alias(f"q{i}") for i, n in enumerate(names)])
            scores = scores.join(known_of, "doc_id", "left")
            held = lambda i: F.col(f"s{i}") / F.col("v") * (1 + 0.5 * F.coalesce(f"q{i}", F.lit(0.0)))
        best = F.array_max(F.array(*[F.struct(held(i).alias("score"), F.lit(n).alias("subject")) for i, n in enumerate(names)]))
        best = once(scores.select("doc_id", "sent", best.alias("b")), "b")
        needed = enough if turn else 0.6 * enough  # the votes of documents with several labels are split at first
        told = written(best.where(F.col("b.score") >= needed).select("doc_id", "sent", F.col("b.subject").alias("subject")), f"subject-told-{turn}")
        tally = told.groupBy("doc_id", "subject").agg(F.count("*").alias("n"))
        borne = seeds.join(tally, ["doc_id", "subject"]).join(sizes, "doc_id").where(F.col("n") >= share * F.col("of") - 1e-9).select("doc_id", "subject", F.col("n").alias("held"))
        clamp = borne if clamp is None else clamp.unionByName(borne).groupBy("doc_id", "subject").agg(F.max("held").alias("held"))
        clamp = written(clamp, f"subject-trusted-{turn}")  # only grows: trusted once is trusted from then on
        n = F.greatest(F.coalesce("n", F.lit(0)), F.coalesce("held", F.lit(0)))
        docs = written(tally.join(clamp, ["doc_id", "subject"], "full").join(sizes, "doc_id").select("doc_id", "subject", n.alias("n"), "of"), f"subject-docs-{turn}")
        clamped = clamp.groupBy("doc_id").agg(F.collect_list("subject").alias("subjects"))
        silent = sents.join(clamped, "doc_id").join(told, ["doc_id", "sent"], "left_anti")
        votes = sents.join(told, ["doc_id", "sent"]).select("bands", "subject", F.lit(1.0).alias("x"))
        votes = votes.unionByName(silent.select("bands", F.explode("subjects").alias("subject"), (1.0 / F.size("subjects")).alias("x")))
    return docs


def document_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, share: float = 0.2) -> DataFrame:
    """(``doc_id``, ``subject``) for every subject that at least ``share`` of the sentences are about."""
    return propagated(documents, labels, subjects, share=share).where(F.col("n") >= share * F.col("of") - 1e-9).select("doc_id", "subject")


def composition(documents: DataFrame, labels: DataFrame, subjects: DataFrame, share: float = 0.2) -> DataFrame:
    """(``subject``, ``documents``, ``sentences``): how the corpus is made up."""
    return propagated(documents, labels, subjects, share=share).where(F.col("n") >= share * F.col("of") - 1e-9).groupBy("subject").agg(F.count("*").alias("documents"), F.sum("n").alias("sentences"))
