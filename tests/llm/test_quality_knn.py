from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.llm import quality_knn as q
from tests.conftest import DATA


def labels_for(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = q.classify(docs, labels).cache()
    assert out.count() == docs.count()
    seen = out.join(labels, "doc_id").where("held_out")
    right, n = seen.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 50 and right / n >= 0.97
    assert out.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.5 as int)").count() == 0
    assert out.where("held_out <> (crc32(cast(doc_id as string)) % 3 = 1)").count() == 0


def test_labels_of_held_out_ids_do_not_count(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in q.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in q.classify(docs, turned).collect()}
    assert a == b


def test_edge_rows(spark, docs, crowded, nothing):
    labels = labels_for(spark, [(i, i % 2, 0) for i in range(1, 10)] + [(None, 1, 0), (2, None, 0), (2, 1, 0)])
    out = q.classify(crowded, labels).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 for r in out)
    blank = {r.score for r in q.classify(docs.where("trim(text, ' \t\n') = '' or text is null"), labels).collect()}
    assert len(blank) == 1
    assert q.classify(nothing, labels).collect() == []
    assert {r.score for r in q.classify(docs, labels.where("false")).collect()} == {0.5}
    assert {r.score for r in q.classify(docs, labels_for(spark, [(i, 1, 0) for i in range(1, 10)])).collect()} == {1.0}
    kept = q.keep_good(crowded, labels)
    assert kept.columns == crowded.columns
