from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import common
from riskweave.llm import simhash_ball as s
from riskweave.llm.common import connected_components
from tests.conftest import DATA
from tests.llm.conftest import words


def plain_fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, radius=2):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, f"{fps[i]:016x}", least.get(top(i))) for i, (doc, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_edges_of_the_contract(spark, docs, crowded, nothing):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(s.classes(crowded)) == brute(rows)
    assert s.classes(nothing).collect() == []


def test_documents_against_brute_force(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert got(s.classes(df)) == brute(rows)


def test_links_find_every_near_pair(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(4):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << bit
            fps.add(x)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    for radius in (1, 2, 3):
        edges = s.links(spark.createDataFrame(signed, "fp long"), radius)
        near = [(a, b) for i, (a,) in enumerate(signed) for (b,) in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
        for a, b in edges.collect():
            assert ((a ^ b) & (2**64 - 1)).bit_count() <= radius
        same = {r.node: r.root for r in connected_components(edges).collect()}
        assert all(same[a] == same[b] for a, b in near)


def test_radius_one_keeps_links_past_the_least_of_a_bucket(spark):
    b = 0b1000
    fps = [0b1001, b, 0b1100, 0b0001, 0b0000]  # the bucket of each meets some least member that is two bits away
    edges = s.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 1)
    near = {(x, y) for x in fps for y in fps if x < y and (x ^ y).bit_count() == 1}
    assert {(r.a, r.b) for r in edges.collect()} == near


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5001), (5001, 5000), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0}
    assert {got[i] for i in range(1000, 1300)} == {1000}
    assert got[5001] == 5000
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("edges_a_task", [1 << 16, 100, 1])
def test_components_take_tasks_by_their_edges(spark, monkeypatch, edges_a_task):
    """Whatever the number of shuffle partitions: the tasks of all rounds, empty ones too, weigh on the driver and the disk."""
    monkeypatch.setattr(common, "EDGES_A_TASK", edges_a_task)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)], "a long, b long")
    given, context = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}, spark.sparkContext
    context.setJobGroup("components", "")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.node: r.root for r in connected_components(edges).collect()}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in given.items():
            spark.conf.set(k, v)
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1300), 1000)}
    told = context.statusTracker()
    stages = {i for j in told.getJobIdsForGroup("components") for i in told.getJobInfo(j).stageIds}
    tasks = sum(x.numTasks for i in stages if (x := told.getStageInfo(i)) and x.numCompletedTasks)
    if edges_a_task >= 1000:  # reading and counting the edges takes more than the rounds
        assert tasks < 1000


def test_bytes_outside_ascii_keep_their_case():
    assert s.fingerprint("Ä b c".encode()) != s.fingerprint("ä b c".encode())
    assert s.fingerprint("A b c d".encode()) == s.fingerprint("a B\tc\x0bd".encode())


def test_one_of_each_stays(spark, docs, crowded):
    out = s.deduplicate(docs)
    left = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    n = s.rooted(s.fingerprints(docs)).select("root").distinct().count()
    assert len(left) == n
    assert (1, words(120)) in left and all(d != 2 for d, _ in left)
    assert s.deduplicate(crowded).columns == crowded.columns
    assert s.deduplicate(out).count() == len(left)
    assert out.groupBy(F.xxhash64("text")).count().where("count > 1").count() == 0
