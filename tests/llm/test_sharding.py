from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave.llm import sharding as s


def test_even_and_stable():
    names = [f"s{i}" for i in range(20)]
    table = s.lookup_table(names, 2039)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    gone = s.lookup_table(names[:-1], 2039)
    moved = sum(a != b for a, b in zip(table, gone, strict=True) if a != 19)
    assert moved / 2039 < 0.2


def test_bad_sizes():
    for names, slots in (([], 7), (["a"], 8), (["a"] * 8, 7)):
        with pytest.raises(ValueError):
            s.lookup_table(names, slots)


def test_rows(docs, crowded, nothing):
    out = s.shard(crowded)
    assert out.count() == docs.count()
    assert sorted(out.columns) == sorted(crowded.columns)
    assert out.groupBy("doc_id", "text").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0
    by_id = s.shard(docs).where("doc_id is not null").groupBy("doc_id").agg(F.count_distinct("shard").alias("n"))
    assert by_id.where("n > 1").count() == 0
    assert s.shard(nothing).collect() == []
    assert s.shard(docs.select("doc_id")).count() == docs.count()


def test_written_shards_hold_all_rows(spark, docs, tmp_path):
    s.write_shards(s.shard(docs), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == docs.count()


def test_spread(spark):
    out = s.shard(spark.range(20_000).select(F.col("id").alias("doc_id")))
    n = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(n) == s.SHARDS and max(n) < 1.25 * 20_000 / s.SHARDS
