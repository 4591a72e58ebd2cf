from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from riskweave.llm import mixture as m
from tests.conftest import DATA


@pytest.mark.parametrize("seed", range(6))
def test_fit_reaches_what_can_be_reached(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(6)}
    total = sum(s * n for s, n in counts.items())
    reach = {0}
    for s, n in counts.items():
        reach = {r + s * k for r in reach for k in range(n + 1)}
    for goal in range(total + 1):
        got = m.fit(counts, goal)
        assert all(0 <= got.get(s, 0) <= n for s, n in counts.items())
        words = sum(s * n for s, n in got.items())
        assert words <= goal
        # What the proportional share has settled aside, the table finds the best.
        assert goal - words <= goal - max(r for r in reach if r <= goal) + max(counts)


def test_fit_of_many_documents_is_exact():
    counts = {s: 50 for s in range(20, 400)}
    for goal in (1, 17, 12345, 999_999):
        got = sum(s * n for s, n in m.fit(counts, goal).items())
        assert got == goal or goal < 20 and got == 0


def plain_targets(sizes: dict, budget=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, out = budget * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if cap * sizes[s] <= weight[s] * level}
        if not full:
            out.update({s: weight[s] * level for s in free})
            break
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= full
    return out


def test_targets_and_taken(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("source", F.when(F.col("source") != "src3", F.col("source")))
    rows = m.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert len(rows) == docs.count()
    sizes = {r.source: r.n for r in m.sized(docs).groupBy("source").agg(F.sum("size").alias("n")).collect()}
    wanted = plain_targets(sizes)
    assert (rows.taken % rows["size"].where(rows["size"] > 0, 1) == 0).all()
    assert (rows.taken <= 2 * rows["size"]).all()
    for source, part in rows.groupby(rows.source.where(rows.source.notna(), None), dropna=False):
        source = None if source != source else source
        assert part.target.iloc[0] == pytest.approx(wanted[source])
        assert part.source_size.iloc[0] == sizes[source]
        assert abs(part.taken.sum() - wanted[source]) <= 1 + part["size"].min()


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    first = {r.doc_id: r.taken for r in m.mix(docs).collect()}
    again = {r.doc_id: r.taken for r in m.mix(docs.repartition(7, "lang")).collect()}
    assert first == again


def test_sizes(spark):
    df = spark.createDataFrame([(1, " a\tb\x0bc\x0cd\r\ne\xa0f g ", "s"), (2, None, "s"), (3, "", "s")], "doc_id long, text string, source string")
    assert {r.doc_id: r.size for r in m.sized(df).collect()} == {1: 5, 2: 0, 3: 0}


def test_edge_rows(docs, crowded, nothing):
    out = m.mix(crowded).collect()
    assert len(out) == docs.count()
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in out)
    assert m.mix(nothing).collect() == []
    assert m.apply_mix(crowded).columns == crowded.columns
    assert m.mix(docs.where("text is null")).select("taken", "target").distinct().collect() == [(0, 0.0)]
