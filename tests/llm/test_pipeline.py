from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from riskweave.llm import mixture, queries, quality_knn, sharding
from riskweave.session import table
from tests.conftest import DATA
from tests.llm.test_decontaminate import brute
from tests.llm.test_mixture import plain_targets
from tests.llm.test_simhash_blocks import least_of_classes
from tests.oracle import assert_same, connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, DATA).toPandas(), connect(DATA).sql(queries.ORACLES[name]).df())


def test_one_query_for_each_operator():
    assert [sum(n.startswith(f"op{i}_") for n in queries.QUERIES) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in queries.QUERIES


def words_of(text, pattern):
    return re.findall(pattern, text or "")


def test_run_equals_decisions_taken_in_plain_python(spark):
    """The classifier's votes and the near-duplicates, which are held against brute force elsewhere, are taken from their
    operators; all other stages are computed from the texts in plain Python."""
    docs = table(spark, DATA, "documents")
    names = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    good = sorted(r.doc_id for r in quality_knn.classify(docs, table(spark, DATA, "labels")).collect() if r.predicted)
    left = spark.createDataFrame([rows[i] for i in good], docs.schema)
    single = sorted(r.doc_id for r in cp.one_of_each(spark, left, DATA).collect())
    assert set(least_of_classes([(i, rows[i].text) for i in good])) <= set(single)
    items = [(r.item_id, r.text) for r in table(spark, DATA, "benchmark").collect()]
    clean = [d for d, *_, bad in brute([(i, rows[i].text) for i in single], items) if not bad]
    size = {i: len(words_of(rows[i].text, r"[^\x20\x09-\x0D]+")) for i in clean}
    totals = Counter()
    for i in clean:
        totals[rows[i].source] += size[i]
    goals = plain_targets(totals)

    out = cp.run(spark, DATA)
    assert out.columns == [*names, "slot", "shard"]
    found = out.collect()
    copies = Counter(r.doc_id for r in found)
    # Which documents fill a length's count is the seed's choice; sums, copies and the rest are not.
    assert set(copies) <= set(clean)
    for source, goal in goals.items():
        mine = [i for i in clean if rows[i].source == source]
        whole = int(goal // totals[source])
        assert all(copies[i] in (whole, whole + 1) for i in mine if size[i])
        taken = sum(copies[i] * size[i] for i in mine)
        assert taken <= goal and goal - taken <= max(size[i] for i in mine)
    lookup = sharding.lookup_table([f"shard-{i:05d}" for i in range(sharding.SHARDS)])
    assert all((r.slot, r.shard) == (sharding_slot(r.doc_id), lookup[sharding_slot(r.doc_id)]) for r in found)
    assert all(tuple(r)[: len(names)] == tuple(rows[r.doc_id]) for r in found)


def sharding_slot(doc_id: int) -> int:
    return sharding.digest(str(doc_id)) % sharding.SLOTS


def test_stages(spark, docs, crowded):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "mixing", "sharding"]
    for name, stage in cp.STAGES:
        added = ["slot", "shard"] if name == "sharding" else []
        kept = [c for c in crowded.columns if c not in added]
        out = stage(spark, crowded, DATA)
        assert out.columns == [*kept, *added], name
        for r in out.select("doc_id", "key", "row", "h").distinct().collect():
            assert (r["key"], r["row"], r["h"]) == ("mine key", "mine row", "mine h"), name
        assert stage(spark, docs.where("false"), DATA).collect() == []
    assert cp.ORACLE_SQL is None


def test_mix_of_rows_without_ids_is_exact(spark):
    """Rows without an id, and many equal rows: the stage returns the copies that operator 3 plans, to the row."""
    rows = [(None, f"text {i % 50} " + "w " * (i % 9), f"s{i % 3}") for i in range(400)] + [(7, "same words here", "s1")] * 301
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plan = mixture.mix(df).collect()
    taken = sum(r.taken for r in plan)
    times = sum(r.taken // r["size"] for r in plan if r["size"])
    out = mixture.apply_mix(df).collect()
    assert len(out) == times
    assert sum(len(r.text.split()) for r in out) == taken
