"""Operator 5: benchmark decontamination over a distributed positional inverted index.

The documents are cut into words once; their postings (document, term, position)
are written to the shared folder, each file sorted by term, so a term's list lies
together in every part of the corpus and a reader skips what it isn't asked for.
The list of the empty term, which is no word, names the documents. The index
knows nothing of the benchmark: keep its path and search again.

Every item is cut into windows of consecutive words, whose terms are put in order
of how rare they are in the corpus. A search takes the list of each window's
rarest term and shifts it by the term's offset in the item, which gives
alignments of the item with a document; these are intersected with the shifted
list of the next rarest term, and what is left of them with the lists of all
other terms. A window whose terms are all in place is an exact phrase match. With
``slop`` the other terms may lie up to that many positions off their places while
the rarest is in its own; that gives proximity matches. Overlapping windows share
their alignments and terms, so each is looked up once.

Only tables of benchmark terms and windows are broadcast, and those after their
size is measured. What grows with the corpus is shuffled at every size, by
document, term and position, so no term's list meets in one task. Matches of a document are merged under its own number, so no list grows
with the corpus.

Results by case: null texts have no words; items without words have no windows,
repeated items are items of their own; every row is a document of its own, so
equal rows get equal results; a null doc_id is an id like any other. Null
item_ids are left out of item lists. An empty benchmark leaves every document
clean. Extra columns are ignored; ``remove`` returns them whatever their names.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskweave.llm.common import lower_ascii, quoted, row_key, split_words, text_of
from riskweave.session import broadcast_below, cut, shared_folder

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WIDTH = 10
#: How far a term may lie off its place in a proximity match of the report.
SLOP = 1


def words(text: str = "text") -> Column:
    """The words of the text, A-Z in lower case."""
    return split_words(lower_ascii(text_of(text)), GAPS)


@dataclass(frozen=True)
class PositionalIndex:
    """Stored postings: ``documents`` (doc, id, h, n, n_words) and ``postings`` (doc, term, pos)."""

    documents: DataFrame
    postings: DataFrame


def build(docs: DataFrame, path: str | None = None) -> PositionalIndex:
    """Write the index of ``docs`` to ``path``, or to a new folder below the shared one."""
    spark = docs.sparkSession
    path = path or f"{shared_folder(spark)}/index-{uuid.uuid4().hex}"
    key = row_key()
    numbered = docs.select(F.monotonically_increasing_id().alias("doc"), key.alias("key"), words().alias("w"))
    # One posting of the empty term for each document: its key, and its number of words for a position.
    each = numbered.select("doc", "key", F.size("w").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("at", "term"))
    named = F.col("at") == 0
    rows = each.select(
        "doc", "term", F.when(named, F.col("n_words")).otherwise(F.col("at") - 1).alias("pos"),
        F.when(named, F.col("key")).alias("key"),
    )
    rows.sortWithinPartitions("term", "doc", "pos").write.parquet(path)
    return load(spark, path)


def load(spark: SparkSession, path: str) -> PositionalIndex:
    """An index that ``build`` has written."""
    stored = spark.read.parquet(path)
    documents = stored.where("term = ''").select("doc", "key.*", F.col("pos").cast("long").alias("n_words"))
    return PositionalIndex(documents, stored.where("term <> ''").select("doc", "term", "pos"))


def numbered_items(items: DataFrame) -> DataFrame:
    """(i, w, item_id): the words of every item; equal texts share a number."""
    rows = cut(items.select(words().alias("w"), "item_id").where(F.size("w") > 0))
    numbers = cut(rows.select("w").distinct().select(F.monotonically_increasing_id().alias("i"), "w"))
    return rows.join(numbers, "w").select("i", "w", "item_id")


def _bytes(rows: DataFrame, text: str | None = None) -> int:
    """About what the rows take in memory: four times their text and a fixed share each."""
    return rows.agg(F.sum((F.octet_length(text) * 4 if text else F.lit(0)) + 64)).first()[0] or 0


def _small(rows: DataFrame, text: str | None = None) -> DataFrame:
    """``rows``, broadcast if their measured size allows."""
    return broadcast_below(rows, _bytes(rows, text))


def ordered_windows(postings: DataFrame, numbered: DataFrame, width: int = WIDTH) -> DataFrame:
    """(i, s, length, terms): every window of every distinct item; ``terms`` are (n, term, at), the rarest in the corpus
    first, ``at`` the place in the item. Windows with a term that no document has are left out."""
    distinct = numbered.select("i", "w").dropDuplicates(["i"])
    each = distinct.select("i", F.posexplode("w").alias("at", "term"))
    terms = cut(each.select("term").distinct())
    # Counted before the join: one row a term and task is shuffled, never a posting.
    counts = postings.groupBy("term").agg(F.count("*").alias("n")).join(_small(terms, "term"), "term")
    listed = each.join(counts, "term", "left").groupBy("i").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - width, F.lit(0)))
    wins = listed.select("i", "all", F.explode(starts).alias("s")).select("i", "s", F.slice("all", F.col("s") + 1, F.lit(width)).alias("part"))
    order = F.array_sort(F.transform("part", lambda t: F.struct(t["n"].alias("n"), t["term"].alias("term"), t["at"].alias("at"))))
    return wins.select("i", "s", F.size("part").alias("length"), order.alias("terms")).where(F.col("terms")[0]["n"] > 0)


def intersect(postings: DataFrame, asked: DataFrame, slop: int = 0) -> DataFrame:
    """The (doc, i, align, at, exact) of ``asked`` (doc, i, align, at, term) whose term the document has at align + at,
    or, with ``slop``, up to that many positions off."""
    place = F.col("align") + F.col("at")
    near = F.explode(F.sequence(place - slop, place + slop)) if slop else place
    wanted = asked.withColumn("pos", near).where("pos >= 0")
    lists = postings.join(_small(asked.select("term").distinct(), "term"), "term", "left_semi")
    met = lists.join(wanted, ["doc", "term", "pos"])
    keys = ["doc", "i", "align", "at"]
    if not slop:
        return met.select(*keys, F.lit(True).alias("exact"))
    return met.groupBy(*keys).agg(F.max(F.col("pos") == F.col("align") + F.col("at")).alias("exact"))


def search(index: PositionalIndex, numbered: DataFrame, width: int = WIDTH, slop: int = 0) -> DataFrame:
    """(doc, i, start, length, exact): the windows of the items in the documents; inexact ones only with ``slop``."""
    wins = cut(ordered_windows(index.postings, numbered, width))
    first, second = F.col("terms")[0], F.col("terms")[1]
    rarest = wins.select("i", first["at"].alias("p"), first["term"].alias("term")).distinct()
    lists = index.postings.join(_small(rarest, "term"), "term")
    starts = cut(lists.select("doc", "i", (F.col("pos") - F.col("p")).alias("align"), "p"))
    pairs = wins.where("length > 1").select("i", first["at"].alias("p"), second["at"].alias("at"), second["term"].alias("term")).distinct()
    asked = cut(starts.join(_small(pairs, "term"), ["i", "p"]).select("doc", "i", "align", "at", "term").distinct())
    met = cut(intersect(index.postings, asked, slop))
    both = cut(
        starts.join(_small(pairs.drop("term")), ["i", "p"]).join(met, ["doc", "i", "align", "at"]).select("doc", "i", "align", "p", "at", "exact")
    )
    others = wins.where("length > 2").select("i", first["at"].alias("p"), second["at"].alias("at"), F.explode(F.slice("terms", 3, width)).alias("t"))
    others = others.select("i", "p", "at", F.col("t.at").alias("r"), F.col("t.term").alias("term")).distinct()
    rest = cut(both.join(_small(others, "term"), ["i", "p", "at"]).select("doc", "i", "align", F.col("r").alias("at"), "term").distinct())
    alone = wins.where("length = 1").select("i", first["at"].alias("p"))
    keys = ["doc", "i", "align"]
    places = (
        both.select(*keys, "at", "exact")
        .unionByName(both.select(*keys, F.col("p").alias("at"), F.lit(True).alias("exact")))
        .unionByName(intersect(index.postings, rest, slop))
        .unionByName(starts.join(_small(alone), ["i", "p"]).select(*keys, F.col("p").alias("at"), F.lit(True).alias("exact")))
    )
    # Bounded by the item's length.
    aligned = places.groupBy(*keys).agg(F.collect_set(F.when(F.col("exact"), F.col("at"))).alias("exactly"), F.collect_set("at").alias("nearly"))
    of_item = wins.select("i", F.struct("s", "length", first["at"].alias("p")).alias("win")).groupBy("i").agg(F.collect_list("win").alias("wins"))
    placed = aligned.join(_small(of_item), "i")
    span = lambda x: F.sequence(x["s"], x["s"] + x["length"] - 1)
    inside = lambda x, found: F.size(F.array_except(span(x), F.col(found))) == 0
    hits = F.filter("wins", lambda x: F.array_contains("exactly", x["p"]) & inside(x, "nearly"))
    each = placed.select(*keys, "exactly", F.explode(hits).alias("x")).withColumn("exact", F.size(F.array_except(span(F.col("x")), F.col("exactly"))) == 0)
    return each.select("doc", "i", (F.col("align") + F.col("x.s")).alias("start"), F.col("x.length").alias("length"), "exact")


def covered(spans: Column) -> Column:
    """Positions inside any of the (start, length) spans."""
    state = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["start"] + x["length"]).cast("long").alias("end"),
            (s["n"] + F.greatest(x["start"] + x["length"] - F.greatest(s["end"], x["start"]), F.lit(0))).cast("long").alias("n"),
        ),
    )
    return state["n"]


def find(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = 0, index: PositionalIndex | None = None) -> tuple[PositionalIndex, DataFrame, DataFrame]:
    """(index, matches, owners): where the items' windows are in the documents; ``owners`` is (i, item_id)."""
    index = index or build(docs)
    numbered = numbered_items(items)
    return index, cut(search(index, numbered, width, slop)), numbered.select("i", "item_id").distinct()


def contaminated(matches: DataFrame, owners: DataFrame) -> DataFrame:
    """(doc, n_hit, items, n_near): per document with a match its hit words, the items found, and the number of those found or nearly so."""
    exact = F.col("exact")
    spans = matches.groupBy("doc").agg(F.collect_set(F.when(exact, F.struct("start", "length"))).alias("spans"))
    ids = matches.groupBy("doc", "i").agg(F.max("exact").alias("exact")).join(owners.where("item_id is not null"), "i")
    per = ids.groupBy("doc", F.col("item_id").cast("string").alias("item")).agg(F.max("exact").alias("exact"))
    listed = per.groupBy("doc").agg(F.array_sort(F.collect_list(F.when(exact, F.col("item")))).alias("items"), F.count("*").alias("n_near"))
    return spans.select("doc", covered(F.col("spans")).alias("n_hit")).join(listed, "doc", "left")


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = SLOP) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items, contaminated and n_near, the number of items with a match
    that is exact or within ``slop``."""
    index, matches, owners = find(docs, items, width, slop)
    found = contaminated(matches, owners)
    rows = index.documents.select("doc", F.col("id").alias("doc_id"), "n_words").join(found, "doc", "left")
    listed, hit = F.coalesce("items", F.array().cast("array<string>")), F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"),
        (hit > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def remove(docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = 0) -> DataFrame:
    """The rows of ``docs`` without any match, with all their columns; proximity matches count with ``slop``."""
    index, matches, _ = find(docs, items, width, slop)
    found = index.documents.join(matches.select("doc").distinct(), "doc", "left_semi").select(*[F.col(x).alias(f"of_{x}") for x in ("id", "h", "n")]).distinct()
    keyed = docs.select(row_key().alias("key"), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"))
    same = keyed["key.id"].eqNullSafe(found["of_id"]) & (keyed["key.h"] == found["of_h"]) & (keyed["key.n"] == found["of_n"])
    return keyed.join(found.hint("shuffle_hash"), same, "left_anti").select("row.*")


def merge_windows(spans: DataFrame) -> DataFrame:
    """Per key the merged (start, end) runs of overlapping or touching matches."""
    order = Window.partitionBy("key").orderBy("start", "end")
    ends = spans.select("key", "start", (F.col("start") + F.col("length")).alias("end"))
    marked = ends.withColumn("before", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = marked.withColumn("run", F.sum((F.coalesce("before", F.lit(-1)) < F.col("start")).cast("int")).over(order))
    return runs.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")
