"""Text expressions: tokens, relaxed queries, trigrams, normalisation, snippets, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that a relaxed query leaves out.
STOP_WORDS = [
    "a", "an", "and", "are", "did", "do", "does", "i", "is", "me", "my", "of", "the", "to", "what", "which", "who",
    "как", "какая", "какие", "какой", "какое", "меня", "мне", "мой", "мои", "моя", "мое", "моё", "у", "что",
]
# Words that mark a durable statement.
SIGNALS = ["remember", "preference", "prefer", "always", "never", "rule", "policy", "decision", "decide", "todo", "must"]
SNIPPET, RELAXED_LIMIT = 240, 12


def lexemes(text: Column) -> Column:
    """Lower-case runs of letters and digits in order; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def search_text(title: Column, content: Column, key: Column) -> Column:
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.trim(F.concat(part(title), F.lit(" "), part(content), F.lit(" "), part(key)))


def matches_all(doc: Column, query: Column) -> Column:
    """Every query lexeme is among the document's; no lexeme matches nothing."""
    return (F.size(query) > 0) & (F.size(F.array_except(query, doc)) == 0)


def relaxed_queries(query: Column) -> Column:
    """Adjacent pairs, then single words, of the content words of ``query``; at most twelve."""
    words = F.regexp_extract_all(F.lower(query), F.lit(r"([\p{L}\p{N}_@.-]+)"), F.lit(1))
    kept = F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(STOP_WORDS)))
    pairs = F.transform(F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.element_at(kept, (i + 2).cast("int"))))
    wanted = F.filter(F.array_distinct(F.concat(pairs, kept)), lambda c: c != F.lower(F.trim(query)))
    return F.when(F.size(kept) >= 2, F.slice(wanted, 1, RELAXED_LIMIT)).otherwise(F.array().cast("array<string>"))


def snippet(content: Column) -> Column:
    return F.when(F.length(content) > SNIPPET, F.concat(F.substring(content, 1, SNIPPET), F.lit("…"))).otherwise(content)


def trigrams(text: Column) -> Column:
    """Distinct three-letter windows of each word, padded by two blanks before and one after."""
    padded = F.transform(lexemes(text), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def one_line(text: Column) -> Column:
    """White space of any kind and line ends to single blanks, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def comparable(text: Column) -> Column:
    return F.lower(one_line(text))


def slugify(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def is_durable(text: Column) -> Column:
    body = F.lower(F.trim(text))
    return (F.length(F.trim(text)) >= 48) & body.rlike("|".join(SIGNALS))


def is_marker(text: Column) -> Column:
    """The whole text is an upper-case constant of three parts, a UUID, an @handle or a long number."""
    t = F.trim(text)
    return F.coalesce(
        t.rlike(r"^[A-Z0-9]+(?:_[A-Z0-9]+){2,}$") | t.rlike(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$") | t.rlike(r"^@\w{3,}$") | t.rlike(r"^[0-9]{6,}$"),
        F.lit(False),
    )


# Parts of queries that ask for breadth, and parts that ask for one value.
BROAD = ["summarize", "summary", "overview", "around", "what values", "какие", "кратко", "обзор", "сгруппируй", "вокруг"]
EXACT = ["exact", "top-1", "only", "value only", "string only", "id", "key", "marker", "token", "uuid", "login", "точн", "только", "значени"]


def query_mode(query: Column) -> Column:
    """``exact_value`` where a query asks for one value and not for breadth, else ``contextual``."""
    low = F.lower(F.trim(query))
    some = lambda words: F.greatest(*[low.contains(w) for w in words])
    return F.when(F.coalesce(some(EXACT) & ~some(BROAD), F.lit(False)), "exact_value").otherwise("contextual")


def first_line_title(content: Column, limit: int = 120) -> Column:
    line = F.get(F.filter(F.transform(F.split(content, "\n"), lambda x: F.trim(x)), lambda x: x != ""), F.lit(0))
    return F.when(F.length(line) > limit, F.concat(F.substring(line, 1, limit), F.lit("…"))).otherwise(line)


def label(text: Column) -> Column:
    """Line ends and tabs to a blank, square brackets each to an underscore, runs of other signs to one."""
    t = F.regexp_replace(F.regexp_replace(text, r"[\r\n\t]+", " "), r"[\[\]]", "_")
    return F.trim(F.regexp_replace(t, r"[^A-Za-z0-9._/\- ]+", "_"))


def cut_short(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, and an ellipsis where something was cut."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, max(0, limit)), F.lit("…"))).otherwise(text)


def head_cut(text: Column, limit: int, mark: str = "\n...[truncated]...") -> Column:
    """The trimmed text, or its head and ``mark`` within ``limit`` characters; of too small a limit as much of the mark as fits."""
    t = whole_trim(text)
    if limit <= len(mark):
        return F.when(F.length(t) <= limit, t).otherwise(F.lit(mark[: max(0, limit)]))
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.substring(t, 1, limit - len(mark)), F.lit(mark)))


def message_cut(text: Column, limit: int) -> Column:
    """A message within about ``limit`` characters: its head without blanks at the end, and a mark on its own line."""
    head = F.regexp_replace(F.substring(text, 1, max(0, limit - 20)), r"\s+\z", "")
    return F.when(F.length(text) > limit, F.concat(head, F.lit("\n[truncated]"))).otherwise(text)


# The white space that is trimmed from daily content.
BLANKS = [9, 10, 11, 12, 13, 32, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288, 65279]


def whole_trim(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit("".join(map(chr, BLANKS))))


def plain_daily(text: Column) -> Column:
    """Line ends in one form, white space of any kind trimmed."""
    return whole_trim(F.replace(text, F.lit("\r\n"), F.lit("\n")))


def utf16_slice(text: Column, start: Column, end: Column) -> Column:
    """UTF-16 units ``start`` to ``end`` of a text; null out of bounds or where a cut parts a surrogate pair."""
    units = F.encode(text, "UTF-16BE")
    n = (F.octet_length(units) / 2).cast("int")
    parts = lambda at: F.coalesce(F.hex(F.substring(units, 2 * at + 1, F.lit(1))).between("DC", "DF"), F.lit(False))
    sound = (start >= 0) & (end >= start) & (end <= n) & ~parts(start) & ~parts(end)
    return F.when(sound, F.decode(F.substring(units, 2 * start + 1, 2 * (end - start)), "UTF-16BE"))


def utf16_length(text: Column) -> Column:
    return (F.octet_length(F.encode(text, "UTF-16BE")) / 2).cast("int")


def without_comments(text: Column) -> Column:
    return whole_trim(F.regexp_replace(text, r"(?s)<!--.*?-->", ""))
