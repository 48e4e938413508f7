"""Evaluation texts leaking into training text (problem 9): template windows.

Both sides are cut into words (runs of letters and digits, one case). Every word is replaced by a
typed placeholder where it is a number, a unit or a name of the evaluation set, which makes a
question and its re-parameterised twin the same template. Every window of ``width`` words is one
row with two hashes, of its template and of its words; windows are hash-joined on the template.
An aligned pair of windows is then

* a verbatim leak if the words behind the placeholders are the same too (both hashes agree), or
* a re-parameterised leak if the slots are filled consistently: within a run of adjoining windows
  the same item word always stands for the same document word and the other way round. A run ends
  where a window is missing, so an edited word splits a twin into two runs and hides neither.

The placeholders depend on the lower-case word alone, so a verbatim window always has the same
template on both sides whatever its case. Every window of every text takes part, and nothing of a
document but its matching windows leaves the scan, so the work is linear in the text also where a
table of numbers matches a template of numbers at every place. Windows that thousands of documents
share meet one row of the item side each, so there is no skew.

Defined results: null or short texts (fewer than ``width`` words) have no windows; null ids are
ignored; repeated items or documents give one row per (document, item).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: item windows that may be broadcast (about 60 bytes each); more are joined by shuffle
BROADCAST_WINDOWS = 2_000_000

#: starts of item windows that may stand in the plan as a set; with more of them every window is hashed
STARTS = 50_000

# Words of measure that a re-parameterised question may swap.
UNITS = [
    "seconds", "second", "minutes", "minute", "hours", "hour", "days", "day", "weeks", "week", "months", "month",
    "years", "year", "mm", "cm", "m", "km", "miles", "mile", "g", "kg", "tons", "ton", "litres", "litre",
    "percent", "degrees", "degree", "euros", "euro", "dollars", "dollar",
]


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def name_lexicon(items: DataFrame) -> list[str]:
    """Lower-case names of the evaluation set: words written with a capital inside a sentence.

    All of them: their number is bounded by the evaluation set, whose size does not follow the corpus.
    """
    inner = F.regexp_extract_all(F.concat_ws(" ", "passage", "question"), F.lit(r"[\p{L}\p{N},;]\s+(\p{Lu}[\p{L}]+)"), F.lit(1))
    names = items.select(F.explode(inner).alias("w")).select(F.lower("w").alias("w")).where(F.length("w") > 1).distinct()
    return sorted(r["w"] for r in names.collect())


def slot(w: Column, names: list[str]) -> Column:
    """Placeholder of a lower-case word: 1 for a number, 2 for a unit, 3 for a name, null for any other."""
    # words that begin with a Latin small letter are no numbers, which spares most of them the pattern
    number = F.when(w.between("a", "{"), F.lit(False)).otherwise(w.rlike(r"^\p{N}+$"))
    out = F.when(number, 1).when(w.isin(UNITS), 2)
    return out.when(w.isin(names), 3) if names else out


def windows(texts: DataFrame, ids: list[str], names: list[str], width: int, with_words: bool = False, starts: list[int] | None = None) -> DataFrame:
    """(ids..., ``at``, ``start``, ``h``, ``v``): hashes of the first two placeholders, of the template and of the words of each window, with its 0-based place.

    Words are hashed once each, windows over the hashes. ``with_words`` adds the words of the window.
    With ``starts`` only windows that begin in one of these ways are made: no other can be equal.
    """
    t = texts.where(F.size("_w") >= width)
    t = t.withColumns({"_v": F.transform("_w", lambda w: F.xxhash64(w)), "_t": F.transform("_w", lambda w: F.coalesce(slot(w, names).cast("bigint"), F.xxhash64(w)))})
    cut = lambda c, i: F.slice(F.col(c), i + 1, F.lit(width))
    start = lambda i: F.xxhash64(F.get("_t", i), F.get("_t", i + 1))
    parts = lambda i: [i.alias("at"), start(i).alias("start"), F.xxhash64(cut("_t", i)).alias("h"), F.xxhash64(cut("_v", i)).alias("v"), *([cut("_w", i).alias("words")] if with_words else [])]
    places = F.sequence(F.lit(0), F.size("_w") - F.lit(width))
    if starts is not None:
        places = F.filter(places, lambda i: start(i).isin(starts))
    return t.select(*ids, F.inline(F.transform(places, lambda i: F.struct(*parts(i)))))


def aligned_windows(documents: DataFrame, items: DataFrame, width: int, with_words: bool = False) -> DataFrame:
    """Window pairs with equal templates: ids, places and word hashes (and words) of both sides."""
    spoken = items.where("item_id is not null").select("item_id", F.explode(F.array("passage", "question")).alias("text")).where("text is not null")
    item_words = spoken.distinct().select("item_id", word_array(F.col("text")).alias("_w"), F.xxhash64("text").alias("part"))
    doc_words = documents.where("doc_id is not null and text is not null").select("doc_id", word_array(F.col("text")).alias("_w"))
    names = name_lexicon(items)
    wanted = windows(item_words, ["item_id", "part"], names, width, with_words)
    ways = wanted.select("start").distinct().limit(STARTS + 1).collect()  # of the evaluation set alone
    starts = [r["start"] for r in ways] if width >= 2 and 0 < len(ways) <= STARTS else None
    wanted = wanted.select("item_id", "part", "h", F.col("at").alias("item_at"), F.col("v").alias("item_v"), *([F.col("words").alias("item_words")] if with_words else []))
    bounded = wanted.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    found = windows(doc_words, ["doc_id"], names, width, with_words, starts).drop("start")
    return found.join(F.broadcast(wanted) if bounded else wanted, "h").drop("h")


def verbatim_leaks(documents: DataFrame, items: DataFrame, width: int = 13) -> DataFrame:
    """(``doc_id``, ``item_id``): at least ``width`` consecutive words are shared (equal by two 64-bit hashes)."""
    return aligned_windows(documents, items, width).where("v = item_v").select("doc_id", "item_id").distinct()


def reparameterised_leaks(documents: DataFrame, items: DataFrame, width: int = 13) -> DataFrame:
    """(``doc_id``, ``item_id``, ``windows``): the template is shared, its slots are filled otherwise, but consistently."""
    pairs = aligned_windows(documents, items, width, with_words=True).withColumn("shift", F.col("at") - F.col("item_at"))
    line = ["doc_id", "item_id", "part", "shift"]  # one diagonal: no longer than the item's text
    pairs = pairs.groupBy(*line, "at").agg(F.first("words").alias("d"), F.first("item_words").alias("i"))
    pairs = pairs.withColumn("run", F.col("at") - F.row_number().over(Window.partitionBy(*line).orderBy("at")))
    slots = F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("d", "i"))))
    runs = pairs.groupBy(*line, "run").agg(slots.alias("slots"), F.count("*").alias("n"))
    a, b = F.transform("slots", lambda s: s["d"]), F.transform("slots", lambda s: s["i"])
    consistent = (F.size(F.array_distinct(a)) == F.size("slots")) & (F.size(F.array_distinct(b)) == F.size("slots"))
    changed = F.exists("slots", lambda s: s["d"] != s["i"])
    return runs.where(consistent & changed).groupBy("doc_id", "item_id").agg(F.sum("n").alias("windows"))
