"""Operator 9: near-duplicate classes by SimHash and meet-in-the-middle balls.

Fingerprints at most r bits apart share a point at most r/2 bits from both. So
every distinct fingerprint emits itself and all its variants within r/2 bits,
the variants are shuffled, and whatever collides is checked bit by bit. A
variant has at most 65 fingerprints within one bit, so no bucket can grow with
the data; equal fingerprints are one node however many documents carry them.
Inside a bucket all members link to the least one, which keeps every
connection without emitting all pairs; at other radii the pairs between a bucket
and its least member may be further apart than r, so there every bucket pair
is verified.

Results by case: a null, empty or blank text has fingerprint zero, linked like
any other; a text of fewer words than a shingle is hashed whole; rows with a
null doc_id are fingerprinted and linked, and only their own id is missing from
the minimum (a class of null ids only has a null component_id); repeated rows
give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskweave.llm.common import connected_components, quoted
from riskweave.session import cut

SEED = 42


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of UTF-8 bytes, as a signed number.

    On bytes, ``lower`` touches A-Z only and ``split`` separates at the six
    ASCII space characters only.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65536):  # bounded memory on very long texts
        block = hashes[start : start + 65536]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, h, fp) for every row; h is a hash of the text, for rows that share an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(fps, pa.int64())], names=["doc_id", "h", "fp"])

    kept = docs.select("doc_id", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
    return kept.mapInArrow(run, f"doc_id {dict(kept.dtypes)['doc_id']}, h long, fp long")


def masks(bits: int) -> list[int]:
    """All 64-bit masks of at most ``bits`` ones, as signed numbers."""
    found = [sum(1 << i for i in chosen) for n in range(bits + 1) for chosen in combinations(range(64), n)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) of distinct fingerprints that keep every connection within ``radius`` bits."""
    half = masks((radius + 1) // 2)
    nodes = fps.select("fp").where("fp is not null").distinct()
    balls = nodes.select("fp", F.explode(F.array([F.lit(m) for m in half])).alias("mask")).select(
        F.col("fp"), F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= radius
    if radius % 2 == 0 and radius <= 2:
        # Both lie within one bit of the variant, so each is within two of the least.
        pairs = balls.select(F.min("fp").over(Window.partitionBy("variant")).alias("a"), F.col("fp").alias("b"))
    else:
        pairs = balls.select("variant", F.col("fp").alias("a")).join(balls.select("variant", F.col("fp").alias("b")), "variant")
    return pairs.where("a < b").where(near("a", "b")).select("a", "b").distinct()


def rooted(marked: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, root): the class of every distinct fingerprint."""
    roots = connected_components(links(marked, radius)).withColumnRenamed("node", "fp")
    return marked.select("fp").distinct().join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def classes(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable."""
    marked = cut(fingerprints(docs, shingle))
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    members = least.join(rooted(marked, radius), "fp")
    named = members.join(members.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return marked.join(named.select("fp", "component_id"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """One row of each class: that of the least doc_id, null last; of several, that of the least text hash."""
    marked = cut(fingerprints(docs, shingle))
    return best_rows(docs, marked, rooted(marked, radius))


def best_rows(docs: DataFrame, marked: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stand for their class: ``marked`` has (doc_id, h, fp), ``roots`` (fp, root)."""
    rank = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("best")
    least = marked.groupBy("fp").agg(rank).join(roots, "fp")
    best = cut(least.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.doc_id").alias("of_id"), F.col("best.h").alias("of_h")))
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h"))
    kept = rows.join(best.hint("shuffle_hash"), same, "left_semi")
    keys = marked.join(best, same, "left_semi")
    if not keys.groupBy("doc_id", "h").count().where("count > 1").isEmpty():  # rows given more than once
        kept = kept.dropDuplicates(["doc_id", "h"])
    return kept.select("row.*")
