"""Operator 7: line-first cleaning, then document rules.

Every line with a word is judged by itself: too many symbols or too much
shouting (punctuation), separators and short unfinished fragments (navigation),
and licence, copyright, cookie or script notices (boilerplate). Failing lines
go; a document goes if it loses too much of its text that way, or fails the base
counts. All of it happens inside the row, so nothing is shuffled and one very
long or very frequent text is one row's work. Repeated three-word windows are
found by sorting their 64-bit hashes with their positions.

Results by case: a null text counts as empty; a text without words has zero
counts and is not kept; rows with equal values get equal results. Extra columns
are ignored by ``measure`` and kept by ``clean``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bind, quoted, split_words, text_of

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Fixed values of the rules.
MAX_SYMBOL_SHARE, MAX_UPPER_SHARE, MAX_SHOUTS, MAX_SEPARATORS = 0.06, 0.6, 2, 3
SHORT_WORDS, MIN_LETTERS, MAX_LOST_SHARE = 3, 20, 0.5
MIN_WORDS, MAX_REPEATED = 50, 50
ENDS = r"""[.!?\x{2026}:;,"'\x{201D}\x{BB})\]]\s*$"""
SEPARATORS = "|»·"
NOTICES = (
    "all rights reserved", "licensed under", "licenced under", "released under the", "public license", "public licence",
    "copyright (c)", "©", "accept cookies", "accept all cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "enable javascript", "lorem ipsum", "sign up for our newsletter", "subscribe to our",
)


def _count(text: Column, chars: str) -> Column:
    """Characters of ``text`` among ``chars``; dropping all others first is one pass over the text."""
    listed = "".join(f"\\{c}" if ord(c) < 128 else c for c in chars)
    return F.length(F.regexp_replace(text, f"[^{listed}]+", ""))


def failed_rule(line: Column) -> Column:
    """The rule a line fails: punctuation, navigation, boilerplate, or null."""
    size = F.length(line)
    few = F.size(F.split(F.trim(line, F.lit(" \t\n\x0b\f\r")), SPACE, SHORT_WORDS + 1)) <= SHORT_WORDS  # stops splitting there
    shouts = F.size(F.split(line, r"[!?]{2,}")) - 1
    upper = F.length(F.regexp_replace(line, r"[^\p{Lu}]+", ""))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    lower = F.lower(line)
    notice = reduce(lambda a, b: a | b, (F.contains(lower, F.lit(n)) for n in NOTICES))
    # Capitals are counted first: few lines have enough of them for the letters to matter.
    loud = (upper > MAX_UPPER_SHARE * MIN_LETTERS) & (letters >= MIN_LETTERS) & (upper > MAX_UPPER_SHARE * letters)
    return (
        F.when(_count(line, SYMBOLS) > MAX_SYMBOL_SHARE * size, "punctuation")
        .when(shouts > MAX_SHOUTS, "punctuation")
        .when(loud, "punctuation")
        .when(_count(line, SEPARATORS) >= MAX_SEPARATORS, "navigation")
        .when(few & ~line.rlike(ENDS), "navigation")
        .when(notice, "boilerplate")
    )


def judged_lines(text: Column) -> Column:
    """The lines with a word, each with the rule it fails."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.transform(lines, lambda line: F.struct(line.alias("line"), failed_rule(line).alias("rule")))


def _lost(lines: Column) -> Column:
    """The share of the lines' characters that failing lines hold."""
    add = lambda n, x: F.struct(
        (n["all"] + F.length(x["line"])).alias("all"), (n["lost"] + F.when(x["rule"].isNotNull(), F.length(x["line"])).otherwise(0)).alias("lost")
    )
    zero = F.lit(0).cast("long")
    total = F.aggregate(lines, F.struct(zero.alias("all"), zero.alias("lost")), add)
    return bind(total, lambda n: F.coalesce(F.try_divide(n["lost"], n["all"]), F.lit(1.0)))


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur more than once."""
    n = F.size(words)
    # One struct (hash, place) for each window, sorted: equal windows become neighbours.
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    gram = lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))

    def places(grams: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(grams, k)["h"] == x["h"], F.lit(False))
        again = F.filter(grams, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    add = lambda s, p: F.struct((p + 3).alias("end"), (s["n"] + p + 3 - F.greatest(s["end"], p)).alias("n"))
    found = bind(F.sort_array(F.transform(starts, gram)), places)
    return F.aggregate(found, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")), add)["n"]


def facts(text: Column) -> Column:
    """All counts of a text and the share its failing lines hold, as one struct."""
    of_words = bind(
        split_words(text, SPACE),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words")
        ),
    )
    of_lines = bind(
        judged_lines(text),
        lambda ls: F.struct((F.size(ls) - F.size(F.array_distinct(F.transform(ls, lambda x: x["line"])))).cast("long").alias("n_dup_lines"), _lost(ls).alias("lost_share")),
    )
    return F.struct(of_words.alias("words"), of_lines.alias("lines"), _count(text, SYMBOLS).cast("long").alias("n_symbols"))


def _verdict(rows: DataFrame) -> DataFrame:
    """Adds the counts, base_failed, kept and lost_share to rows with a text."""
    counted = rows.withColumn("_facts", facts(text_of()))
    counted = counted.select(
        *rows.columns, "_facts.words.n_words", "_facts.words.word_chars", "_facts.n_symbols", "_facts.lines.n_dup_lines", "_facts.words.n_repeat_words", "_facts.lines.lost_share"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= MAX_LOST_SHARE))


def measure(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept and lost_share."""
    return _verdict(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_share"
    )


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows, their text without the failing lines."""
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"), "text")
    good = F.transform(F.filter(judged_lines(text_of()), lambda x: x["rule"].isNull()), lambda x: x["line"])
    return _verdict(rows).where("kept").select(F.col("_row").withField("text", F.array_join(good, "\n")).alias("_row")).select("_row.*")
