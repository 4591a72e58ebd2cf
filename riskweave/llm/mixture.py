"""Operator 3: mix sources to target weights by subset-sum budget fitting.

Targets: every source gets its weight's share of the budget; a target above the
cap (a multiple of the source's size) stops there and the excess is reshared by
weight, until none is above. Whole copies of the source fill a target as far as
they go. The rest of it is fitted by counts per exact document length: each
length class gives its proportional count, seeded classes close the gap down to
a bounded remainder, and a bounded-knapsack table over that remainder finds the
counts that hit it, or come as near below as any. Which documents of a class are
taken is decided by a seeded hash, so reruns agree.

Only (source, length) histograms meet in one task, never documents: a group of
equal (source, length) is ranked in slices of the hash range, whose counts give
each slice its offset. Rows that repeat each other are counted per input
partition first and ranked as one, so no window holds them all.

Results by case: a null text has size 0; sizes of 0 take 0; a null source is a
source of its own, the last; the order hashes id and text, so rows without an id
or with one in common are told apart by their texts, and equal rows are
interchangeable. An empty table gives no rows. Extra columns are ignored by
``mix``; ``apply_mix`` returns them whatever their names.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskweave.llm.common import quoted, split_words, text_of
from riskweave.session import cut

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET, CAP, SEED, SLICES = 1.5, 2.0, 20, 256
SPACE = r"[\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, size, order, part): the exact word count, the seeded place in line, the input partition."""
    size = F.size(split_words(text_of(), SPACE)).cast("long")
    h = F.xxhash64(text_of())
    return docs.select("doc_id", "source", h.alias("h"), size.alias("size"), F.xxhash64(F.lit(SEED), "doc_id", h).alias("order"), F.spark_partition_id().alias("part"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size): one row for each source.

    Sources are numbered over range partitions, so their number may grow with
    the data. Each resharing round is one small aggregate over the sources; a
    round that caps no source is the last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = cut(ordered.select("source", "source_size", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")))
    before, run = {}, 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("part").count().collect()):  # one row a partition
        before[part], run = run, run + n
    offset = F.create_map([F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map().cast("map<int,int>")
    number = F.col("at") + F.element_at(offset, F.col("part"))
    weight = F.element_at(F.array([F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    rows = placed.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("most"))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:  # the level only rises, and so does the number of full sources
        at_cap = F.col("most") <= F.col("weight") * level
        held, free, n = rows.agg(
            F.sum(F.when(at_cap, F.col("most"))), F.sum(F.when(~at_cap, F.col("weight"))), F.sum(at_cap.cast("int"))
        ).first()
        if not free or (n or 0) == full:
            break
        full, level = n or 0, (budget * total - (held or 0.0)) / free
    return rows.select("source", "source_size", F.least("most", F.col("weight") * level).cast("double").alias("target"))


def fit(counts: dict[int, int], goal: int, window: int = 1 << 16) -> dict[int, int]:
    """How many of each length to take for a sum as near to ``goal`` as can be, from below.

    ``counts`` has the documents of each length. After the proportional share and
    the largest lengths that fit, ``window`` words are missing, give or take one
    document; the knapsack table covers that remainder, so its size depends on
    neither the documents nor the budget.
    """
    sizes = sorted((s for s in counts if s > 0), reverse=True)
    total = sum(s * counts[s] for s in sizes)
    if goal >= total:
        return {s: counts[s] for s in sizes}
    taken = {s: int(counts[s] * goal // total) for s in sizes}
    rest = goal - sum(s * n for s, n in taken.items())
    for s in sizes:  # down to the window
        n = min(counts[s] - taken[s], max(0, rest - window) // s)
        taken[s] += n
        rest -= s * n
    # A subset-sum over bits: bit i of reach says that i words can be added.
    reach, steps, full = 1, [], (1 << (rest + 1)) - 1
    for s in sizes:
        left, part = min(counts[s] - taken[s], rest // s), 1
        while left > 0:
            n = min(part, left)
            steps.append((reach, s, n))
            reach |= (reach << (s * n)) & full
            left, part = left - n, part * 2
            if reach >> rest & 1:
                break
        if reach >> rest & 1:
            break
    at = reach.bit_length() - 1
    for before, s, n in reversed(steps):
        if not before >> at & 1:
            taken[s] += n
            at -= s * n
    return taken


def _fit_source(frame: pd.DataFrame) -> pd.DataFrame:
    """Whole copies and extra counts of each length of one source."""
    first = frame.iloc[0]
    whole = int(first["target"] // first["source_size"]) if first["source_size"] else 0
    counts = dict(zip(frame["size"].tolist(), frame["n"].tolist(), strict=True))
    extra = fit(counts, int(first["target"]) - whole * int(first["source_size"]))
    return pd.DataFrame(
        {"of": frame["source"], "len": frame["size"], "whole": whole, "extra": [extra.get(s, 0) for s in frame["size"]]}
    )


def plan(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """(doc_id, source, h, size, n, source_size, target, whole, more): of each ``n`` equal rows, ``more`` are taken
    once more than ``whole`` times."""
    rows = cut(sized(docs))
    goals = cut(targets(rows, weights, budget, cap))
    # Slices of the hash range in rising order: a slice's offset is the count of those before it.
    slice_of: Column = F.shiftright("order", 56).alias("slice")
    slices = rows.groupBy("source", "size", slice_of).agg(F.count("*").alias("n"))
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    lengths = slices.groupBy(F.col("source").alias("in_source"), "size").agg(F.sum("n").alias("n"))
    fitted = (
        lengths.join(goals, F.col("in_source").eqNullSafe(F.col("source")))
        .select("source", "size", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(_fit_source, "of source_type, len long, whole long, extra long".replace("source_type", dict(docs.dtypes)["source"]))
    )
    asked = (
        offsets.join(fitted, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len")))
        .select("of", "len", F.col("slice").alias("cell"), "whole", (F.col("extra") - F.col("before")).alias("extra"))
        .join(goals, F.col("of").eqNullSafe(F.col("source")))
        .drop("source")
    )
    alike = rows.groupBy("source", "size", slice_of, "order", "doc_id", "h", "part").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("source", "size", "slice").orderBy("order", "doc_id", "h", "part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = alike.withColumn("ahead", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    joined = ranked.join(asked, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("len")) & (F.col("slice") == F.col("cell")))
    more = F.greatest(F.least(F.col("extra") - F.col("ahead"), F.col("n")), F.lit(0))
    return joined.select("doc_id", "source", "h", "size", "n", "source_size", "target", "whole", more.alias("more"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """Per row: doc_id, size, source_size, target and taken, the words the mix takes of it."""
    # ``n`` counts equal rows of one input partition, which bounds the sequence.
    each = plan(docs, weights, budget, cap).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    copies = F.col("whole") + (F.col("i") <= F.col("more")).cast("long")
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def apply_mix(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; of equal rows, as many in all as it takes."""
    key = ("doc_id", "source", "h")
    takes = plan(docs, **settings).where("size > 0").groupBy(*key).agg(
        F.sum("n").alias("n"), F.min("whole").alias("whole"), F.sum("more").alias("more")
    )
    takes = cut(takes.where("whole > 0 or more > 0").select(*[F.col(c).alias(f"of_{c}") for c in key], "n", "whole", "more"))
    keyed = docs.select("doc_id", "source", F.xxhash64(text_of()).alias("h"), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"))
    same = lambda a: F.col("doc_id").eqNullSafe(a["of_doc_id"]) & F.col("source").eqNullSafe(a["of_source"]) & (F.col("h") == a["of_h"])
    # All rows of a key alike: the texts stream past the takes.
    even = takes.where("more = 0 or more = n")
    joined = keyed.join(even.hint("shuffle_hash"), same(even)).withColumn("times", F.col("whole") + (F.col("more") > 0).cast("int"))
    # Of some keys a part of the equal rows is taken once more: those rows are numbered, by input partition and within it.
    odd = takes.where("more > 0 and more < n")
    if not odd.isEmpty():
        some = cut(keyed.join(odd, same(odd)).withColumn("part", F.spark_partition_id()))
        counts = some.groupBy(*key, "part").agg(F.count("*").alias("c"))
        ahead = counts.withColumn("ahead", F.coalesce(F.sum("c").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        ahead = ahead.select(*[F.col(c).alias(f"in_{c}") for c in (*key, "part")], "ahead")
        within = some.withColumn("i", F.row_number().over(Window.partitionBy(*key, "part").orderBy("h")))
        met = within["doc_id"].eqNullSafe(ahead["in_doc_id"]) & within["source"].eqNullSafe(ahead["in_source"]) & (within["h"] == ahead["in_h"]) & (within["part"] == ahead["in_part"])
        numbered = within.join(ahead, met).withColumn("times", F.col("whole") + (F.col("i") + F.col("ahead") <= F.col("more")).cast("int"))
        joined = joined.select("row", "times").unionByName(numbered.where("times > 0").select("row", "times"))
    copied = joined.select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    return copied.select("row.*")
