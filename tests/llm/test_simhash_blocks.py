from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from riskweave.llm import simhash_blocks as m
from tests.conftest import DATA


def grams(text):
    w = (text or "").encode().lower().split()
    return frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def least_of_classes(rows):
    """Brute force: the least id of each component of the pairs with a Jaccard similarity of 0.8."""
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a and b and 5 * len(a & b) >= 4 * len(a | b)):
                root[top(i)] = top(j)
    return sorted(min(d for k, (d, _) in enumerate(rows) if top(k) == r) for r in {top(k) for k in range(len(rows))})


def test_stage_finds_edited_copies(spark):
    """Copies with edited words, many and few bits apart, chains and a crowd around one text."""
    rng = random.Random(3)
    rows = []
    for family in range(12):
        base = [f"f{family}w{rng.randrange(5000)}" for _ in range(200)]
        for edits in (0, 0, 1, 2, 3, 4, 5, 8, 20) if family else (0, *range(1, 7)) * 8:
            w = list(base)
            for i in rng.sample(range(200), edits):
                w[i] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, t) for i, t in enumerate((None, "", " \n", "one two", "One two", "one three"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, wanted = {r.doc_id for r in cp.one_of_each(spark, df, DATA).collect()}, set(least_of_classes(rows))
    # Nothing goes without a similar text that stays; of the rows that should go, the fingerprints find nearly all.
    assert wanted <= got
    assert len(got - wanted) <= 0.1 * (len(rows) - len(wanted))


def test_stage_on_documents_against_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got, wanted = {r.doc_id for r in cp.one_of_each(spark, df, DATA).collect()}, set(least_of_classes(rows))
    assert wanted <= got
    assert len(got - wanted) <= 0.1 * (len(rows) - len(wanted))


def test_links_past_the_centre_of_a_bucket(spark, monkeypatch):
    """A chain whose ends are not similar, all in one bucket: what the least node doesn't link is compared across classes."""
    text = lambda k: " ".join(f"t{i}" for i in range(k, k + 300))
    rows = [(i, text(16 * i)) for i in range(12)] + [(50, text(5000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(m, "balls", lambda nodes: nodes.select(F.lit(1).alias("bucket"), "fp"))
    monkeypatch.setattr(m, "_first_shared", lambda bucket, a, b: F.lit(True))
    assert sorted(r.doc_id for r in m.deduplicate(df).collect()) == least_of_classes(rows) == [0, 50]


def test_a_pair_counts_in_one_of_its_buckets(spark):
    rng = random.Random(2)
    sigs = []
    for _ in range(6):
        base = [rng.getrandbits(62) for _ in range(m.BLOCKS)]
        for _ in range(6):
            sigs.append([x ^ sum(1 << b for b in rng.sample(range(62), rng.randint(0, 6))) for x in base])
    nodes = spark.createDataFrame(list(enumerate(sigs)), "fp long, sig array<long>")
    met = m.balls(nodes).join(nodes, "fp")
    a, b = met.selectExpr("bucket", "fp as p", "sig as x"), met.selectExpr("bucket", "fp as q", "sig as y")
    pairs = a.join(b, "bucket").where("p < q")
    shared = {tuple(r) for r in pairs.select("p", "q").distinct().collect()}
    counted = pairs.where(m._first_shared("bucket", "x", "y")).select("p", "q").collect()
    assert len(counted) == len(shared) > 0 and {tuple(r) for r in counted} == shared


def test_signature_is_the_majority_of_bits():
    grams = m.shingles(" ".join(f"w{i}" for i in range(50)).encode())
    with np.errstate(over="ignore"):
        for number, times in zip(m.signature(grams), m._MULTIPLIERS, strict=True):
            mixed = [int(x) * int(times) % 2**64 for x in grams]
            mixed = [(x ^ (x >> 32)) * int(times) % 2**64 for x in mixed]
            mixed = [x ^ (x >> 29) for x in mixed]
            for bit in range(64):
                assert ((number & (2**64 - 1)) >> bit & 1) == (2 * sum(x >> bit & 1 for x in mixed) > len(mixed))


def test_rows_of_one_id(spark, docs, crowded):
    out = m.deduplicate(docs)
    assert out.columns == docs.columns and m.deduplicate(crowded).columns == crowded.columns
    assert m.deduplicate(out).count() == out.count()


def test_buckets_of_two_are_left_out_of_the_later_steps(spark):
    """Chance meetings are mostly of two; they are compared once and not tried again."""
    at = "array(struct(1L as bucket, 5L as centre, 2L as n), struct(2L as bucket, 5L as centre, 3L as n))"
    crowd = spark.sql(f"select 7L as fp, array(1L) as sig, {at} as at")
    rows = m._rooted_crowd(crowd, spark.createDataFrame([], "a long, b long")).collect()
    assert [r.buckets for r in rows] == [[2]]
