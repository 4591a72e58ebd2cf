"""Operator 9 for edited copies: SimHash balls over several fingerprints, confirmed by Jaccard similarity.

Texts at a Jaccard similarity of 0.8 lie about ten of 64 bits apart, further than
a ball can reach. So every text has ``BLOCKS`` independent SimHash fingerprints of
``BITS`` bits over its set of five-word shingles. As in ``simhash_ball``, each
fingerprint emits itself and all variants within half the radius, the variants
are shuffled, and nodes that collide are verified: first by the bits of all their
fingerprints together, then by the exact similarity of their whole sets. Texts
with equal sets are one node however many documents carry them.

A node is first compared with the least node that it meets in each block, and with
the other of each bucket of two, most of which meet by chance; those are done. Where
this leaves a larger bucket with several classes, each node outside its largest class is
compared with a member of it, in some of the node's buckets, which joins most of
what belongs together. Buckets that still hold several classes are compared in
full, but only pairs across classes, each in one of the buckets that it shares.
So a crowd of copies never turns into all its pairs, and no link between classes
is lost. Every comparison streams through a join; no bucket is collected.

Recall and random collisions depend on ``BITS`` and ``BLOCKS``; the README has the
figures. Results by case: null, empty and blank texts are one class; a text of
fewer words than a shingle is hashed whole. Extra columns stay, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from riskweave.llm.common import connected_components
from riskweave.llm.simhash_ball import best_rows
from riskweave.session import cut

SHINGLE, SIMILARITY, SEED = 5, 0.8, 42
BLOCKS, BITS = 8, 28
#: Every block is the lower end of a 64-bit number; all 512 bits verify. Texts at the wanted similarity differ in 78 of them
#: on average, with a deviation of 8.1, so one in a thousand differs in more than this; texts at 0.6 differ in 118.
FAR = 103
#: With how many members of its buckets' largest classes a node is compared before whole buckets are.
TRIES = 24
_MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, BLOCKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the shingles of UTF-8 bytes, A-Z read as a-z."""
    words = text.lower().split() if text else []
    if len(words) < shingle:
        grams = [b" ".join(words)] if words else []
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8"))


def signature(grams: np.ndarray) -> list[int]:
    """One number for each block: a bit is 1 if it is set in over half of the hashes."""
    found = []
    for times in _MULTIPLIERS:
        ones = np.zeros(64, np.int64)
        for start in range(0, len(grams), 65536):  # bounded memory on very long texts
            mixed = grams[start : start + 65536] * times
            mixed = (mixed ^ (mixed >> np.uint64(32))) * times
            mixed ^= mixed >> np.uint64(29)
            ones += np.unpackbits(mixed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        found.append(int(np.packbits(ones * 2 > max(len(grams), 1), bitorder="little").view("<i8")[0]))
    return found


def _node(grams: np.ndarray) -> int:
    key = xxhash.xxh64_intdigest(grams.tobytes(), SEED)
    return key - (1 << 64) if key >> 63 else key


def marked_rows(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp, sig) for every row; fp names the set of shingles, h is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text.as_py(), shingle) for text in batch.column("text")]
            signs = [signature(s) if len(s) else None for s in sets]
            arrays = [pa.array(map(_node, sets), pa.int64()), pa.array(signs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), *arrays], names=["doc_id", "h", "fp", "sig"])

    kept = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, h long, fp long, sig array<long>")


def balls(nodes: DataFrame) -> DataFrame:
    """(bucket, fp): every fingerprint of every node and its variants with one bit turned; the bucket's upper bits number the block."""
    each = nodes.select("fp", F.posexplode("sig").alias("k", "number"))
    masks = F.array(*[F.lit(m) for m in (0, *(1 << i for i in range(BITS)))])
    turned = each.select("fp", F.shiftleft(F.col("k").cast("long"), BITS).alias("block"), F.col("number").bitwiseAND(F.lit((1 << BITS) - 1)).alias("bits"), F.explode(masks).alias("mask"))
    return turned.select(F.col("block").bitwiseOR(F.col("bits").bitwiseXOR(F.col("mask"))).alias("bucket"), "fp")


def _apart(a: str, b: str) -> Column:
    """In how many bits two signatures differ."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(1, BLOCKS)), F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0])))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def sets_of(docs: DataFrame, marked: DataFrame, nodes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(fp, grams): the whole shingle set of each node asked for, from the text of one of its rows."""
    one = marked.join(nodes, "fp", "left_semi").groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("r"))
    wanted = one.select(F.col("r.doc_id").alias("wanted"), F.col("r.h").alias("wanted_h")).distinct()
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("wanted")) & (F.col("h") == F.col("wanted_h"))
    picked = rows.join(wanted.hint("shuffle_hash"), same, "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text.as_py(), shingle) for text in batch.column("text")]
            arrays = [pa.array(map(_node, sets), pa.int64()), pa.array([s.view("<i8") for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["fp", "grams"])

    return picked.mapInArrow(run, "fp long, grams array<long>").dropDuplicates(["fp"])


def similar(docs: DataFrame, marked: DataFrame, pairs: DataFrame, similarity: float, shingle: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).distinct()
    sets = cut(sets_of(docs, marked, nodes, shingle))
    both = pairs.join(sets.select(F.col("fp").alias("a"), F.col("grams").alias("x")), "a").join(sets.select(F.col("fp").alias("b"), F.col("grams").alias("y")), "b")
    return both.where(jaccard(F.col("x"), F.col("y")) >= similarity).select("a", "b")


def links(docs: DataFrame, marked: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """Edges (a, b) of nodes that keep every connection of similar nodes sharing a bucket."""
    nodes = cut(marked.where("sig is not null").groupBy("fp").agg(F.first("sig").alias("sig")))
    bucket = Window.partitionBy("bucket")
    met = balls(nodes).select("bucket", "fp", F.min("fp").over(bucket).alias("centre"), F.count(F.lit(1)).over(bucket).alias("n"))
    # A node has at most BLOCKS * (BITS + 1) buckets, so they are one row of it.
    shared = met.where("n > 1").groupBy("fp").agg(F.collect_list(F.struct("bucket", "centre", "n")).alias("at"))
    crowd = cut(shared.join(nodes, "fp"))
    signed = lambda name, sig: crowd.select(F.col("fp").alias(name), F.col("sig").alias(sig))
    least = F.array(*[F.array_min(F.expr(f"transform(filter(at, x -> shiftright(x.bucket, {BITS}) = {k}), x -> x.centre)")) for k in range(BLOCKS)])
    # The two of a bucket are compared here, whoever else its block holds, so only larger buckets go on.
    pair = F.expr("transform(filter(at, x -> x.n = 2), x -> x.centre)")
    closest = crowd.select(F.explode(F.array_distinct(F.concat(least, pair))).alias("a"), F.col("fp").alias("b")).where("a < b")
    near = _near(closest, signed)
    direct = cut(similar(docs, marked, near, similarity, shingle))
    tried = _near(_tries(_rooted_crowd(crowd, direct)).join(near, ["a", "b"], "left_anti"), signed)
    direct = cut(direct.unionByName(similar(docs, marked, tried, similarity, shingle)))
    split = cut(_split(_rooted_crowd(crowd, direct)))
    # A pair across classes has a node outside the largest class of its bucket.
    outside = split.where("root <> main").select("bucket", F.col("fp").alias("p"), F.col("root").alias("rp"), F.col("sig").alias("x"))
    all_ = split.select("bucket", F.col("fp").alias("q"), F.col("root").alias("rq"), F.col("main").alias("m"), F.col("sig").alias("y"))
    # Pairs with a node of the largest class come once, others once by order.
    once = (F.col("rq") == F.col("m")) | (F.col("p") < F.col("q"))
    across = outside.join(all_, "bucket").where((F.col("rp") != F.col("rq")) & once & (_apart("x", "y") <= FAR) & _first_shared("bucket", "x", "y"))
    rest = across.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct().join(near.unionByName(tried), ["a", "b"], "left_anti")
    return direct.unionByName(similar(docs, marked, cut(rest), similarity, shingle))


def _near(pairs: DataFrame, signed) -> DataFrame:
    """The (a, b) of ``pairs`` whose signatures are near, stored."""
    return cut(pairs.join(signed("a", "x"), "a").join(signed("b", "y"), "b").where(_apart("x", "y") <= FAR).select("a", "b"))


def _first_shared(bucket: str, a: str, b: str) -> Column:
    """True in just one of the buckets that two signatures share: that of the first block within two bits, its least common variant.

    Fingerprints x and y up to two bits apart have x with either of those bits turned in common.
    """
    low = (1 << BITS) - 1

    def part(sig: str, k: int) -> Column:
        return F.col(sig)[k].bitwiseAND(F.lit(low))

    found = F.when(F.lit(False), F.lit(0).cast("long"))
    for k in range(BLOCKS):
        x, y = part(a, k), part(b, k)
        apart = x.bitwiseXOR(y)
        one = apart.bitwiseAND(-apart)
        least = F.least(x.bitwiseXOR(one), x.bitwiseXOR(apart.bitwiseXOR(one)))
        found = found.when(F.bit_count(apart) <= 2, F.lit(k << BITS).cast("long").bitwiseOR(least))
    return F.col(bucket) == found


def _rooted_crowd(crowd: DataFrame, found: DataFrame) -> DataFrame:
    """(fp, sig, root, buckets), one row a node: its class under the links ``found`` and the buckets that it shares with two others or more."""
    roots = connected_components(found).withColumnRenamed("node", "fp")
    return cut(crowd.join(roots, "fp", "left").select("fp", "sig", F.coalesce("root", "fp").alias("root"), F.expr("transform(filter(at, x -> x.n > 2), x -> x.bucket)").alias("buckets")))


def _tries(crowd: DataFrame) -> DataFrame:
    """The distinct (a, b) of each node and a member of the largest class around it, in ``TRIES`` of its buckets at most."""
    sizes = crowd.select("fp", "root", F.explode("buckets").alias("bucket")).groupBy("bucket", "root")
    sizes = sizes.agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("fp", "bucket").alias("o"), "fp")).alias("one"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("k", "root", F.col("one.fp").alias("other"))).alias("m"), F.count("*").alias("classes"))
    mixed = F.array_sort(F.transform("buckets", lambda b: F.struct(F.xxhash64("fp", b).alias("o"), b.alias("bucket"))))
    asked = crowd.select("fp", "root", F.explode(F.slice(mixed, 1, TRIES)["bucket"]).alias("bucket"))
    met = asked.join(largest.where("classes > 1"), "bucket").where("root <> m.root")
    return met.select(F.least("fp", "m.other").alias("a"), F.greatest("fp", "m.other").alias("b")).distinct()


def _split(crowd: DataFrame) -> DataFrame:
    """(bucket, fp, sig, root, main): the buckets whose nodes are of several classes, with the largest one; sorted on disk where memory ends."""
    bucket = Window.partitionBy("bucket")
    placed = crowd.select("fp", "sig", "root", F.explode("buckets").alias("bucket")).repartition("bucket")
    sized = placed.withColumn("k", F.count("*").over(Window.partitionBy("bucket", "root")))
    told = sized.select("*", F.max(F.struct("k", "root")).over(bucket).alias("m"), F.min("root").over(bucket).alias("least"), F.max("root").over(bucket).alias("most"))
    return told.where("least <> most").select("bucket", "fp", "sig", "root", F.col("m.root").alias("main"))


def rooted(docs: DataFrame, marked: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """(fp, root): the class of every node."""
    roots = connected_components(links(docs, marked, similarity, shingle)).withColumnRenamed("node", "fp")
    return marked.select("fp").distinct().join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """One row of each class: that of the least doc_id, null last; of several, that of the least text hash."""
    marked = cut(marked_rows(docs, shingle))
    return best_rows(docs, marked, rooted(docs, marked, similarity, shingle))
