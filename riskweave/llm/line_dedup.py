"""Operator 8: remove text that repeats as windows of consecutive lines.

Every three consecutive lines with a word, hashed, make a window; windows
overlap. A hash seen more than once keeps its first occurrence, by document and
place, and every later one marks its three lines; the marks are merged per
document and the lines removed. The first occurrence is a ``min`` aggregate, so
a window that half the corpus shares combines before the shuffle; telling the
later occurrences apart is a join that AQE can split.

Results by case: a text with one or two lines is one window of all its lines;
null, empty and blank texts have none and come back unchanged (null as ''). The
order of documents is that of doc_id, null last; rows with equal doc_id and text
are one document and all get its result; rows sharing doc_id with other texts
are ordered by the hash of their text. Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bind, quoted, row_key, text_of
from riskweave.session import cut

WIDTH = 3
MADE = ("line_text", "n_lines", "n_removed")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _worded(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def occurrences(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(hash, at): every window; ``at`` orders occurrences: no id, id, text hash, size, place."""
    worded = F.filter(F.transform(_lines(text_of()), lambda line: F.trim(line)), _worded)
    rows = docs.select(row_key().alias("key"), worded.alias("lines")).where(F.size("lines") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("lines") - width + 1, F.lit(1)))
    each = rows.select("key", "lines", F.explode(starts).alias("s"))
    window = F.array_join(F.slice("lines", F.col("s"), F.lit(width)), "\n")
    at = F.struct(F.col("key.id").isNull().alias("no_id"), F.col("key.id").alias("id"), F.col("key.h").alias("h"), F.col("key.n").alias("n"), F.col("s"))
    # 128 bits: at 10^11 windows a chance meeting of two hashes stays below one in 10^16.
    return each.select(F.xxhash64(window).alias("h1"), F.xxhash64(F.lit(1), window).alias("h2"), at.alias("at"))


def later(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, h, n, starts): for each document the windows that occurred before, counted from 1."""
    found = cut(occurrences(docs, width))
    first = found.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    repeats = found.join(first, ["h1", "h2"]).where("at > first")
    return repeats.groupBy("at.id", "at.h", "at.n").agg(F.collect_set("at.s").alias("starts"))


def marked(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """All rows and columns of ``docs``, but its own of these names, with line_text, the text without repeats, n_lines and n_removed."""
    names = [c for c in docs.columns if c not in MADE]
    return _stripped(docs, width).select(*[F.col("old") if c == "text" else F.col(f"row.{quoted(c)}") for c in names], *MADE).toDF(*names, *MADE)


def _stripped(docs: DataFrame, width: int) -> DataFrame:
    """(row, old, line_text, n_lines, n_removed): ``row`` has all columns but the text, ``old``, so no names clash."""
    docs = docs.select("doc_id", "text", F.struct(*[F.col(quoted(c)) for c in docs.columns if c != "text"]).alias("row"))
    gone = cut(later(docs, width)).select(*[F.col(c).alias(f"gone_{c}") for c in ("id", "h", "n", "starts")])
    keyed = docs.withColumn("key", row_key())
    same = [keyed[f"key.{c}"].eqNullSafe(gone[f"gone_{c}"]) for c in ("id", "h", "n")]
    # The removals are the built side: the texts stream past and are never sorted.
    joined = keyed.join(gone.hint("shuffle_hash"), same[0] & same[1] & same[2], "left")

    def without(lines: Column) -> Column:
        """The lines left and the number gone; only hash sets and lookups by place, so linear in the text."""
        places = F.filter(F.transform(lines, lambda line, i: F.when(_worded(line), i)), lambda i: i.isNotNull())
        marks = F.array_distinct(F.flatten(F.transform("gone_starts", lambda s: F.sequence(s - 1, s + width - 2))))

        def drop(at: Column) -> Column:
            gone = F.filter(F.transform(marks, lambda k: F.get(at, k)), lambda i: i.isNotNull())
            left = lambda g: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), g)
            return bind(
                gone,
                lambda g: F.struct(F.transform(left(g), lambda i: F.get(lines, i)).alias("kept"), F.size(g).alias("cut"), F.size(at).alias("all")),
            )

        return bind(places, drop)

    state = F.when(F.col("gone_starts").isNotNull(), bind(_lines(text_of()), without))
    done = joined.select("row", F.col("text").alias("old"), state.alias("state"))
    return done.select(
        "row",
        "old",
        F.coalesce(F.array_join("state.kept", "\n"), text_of("old")).alias("line_text"),
        F.coalesce("state.all", F.size(F.filter(_lines(text_of("old")), _worded))).cast("long").alias("n_lines"),
        F.coalesce("state.cut", F.lit(0)).cast("long").alias("n_removed"),
    )


def clean(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` with all their columns, their text without repeated lines; a text left blank stays as ''."""
    names = docs.columns
    return _stripped(docs, width).select(*[F.col("line_text") if c == "text" else F.col(f"row.{quoted(c)}") for c in names]).toDF(*names)
