from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave.llm import decontaminate as d
from tests.conftest import DATA
from tests.llm.conftest import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, width=10):
    wins = {}
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - width + 1, 1) if w else 0):
            wins.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for win, of in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    found |= of
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in df.collect()), key=str)


ITEMS = [
    (1, words(12)), (2, words(12)), (3, "Short ONE"), (4, None), (5, "..."), (6, words(10, 100)), (None, words(11, 5)), (10, "É é e " * 5),
    (7, "the the the the the the the the the the the"), (7, "a b"),
]
TEXTS = [
    (1, words(40)), (2, "x " + words(12).upper() + "! y"), (3, "a short, one; here"), (4, None), (5, ""), (None, words(10, 100)), (6, "the " * 300),
    (7, words(9)), (8, "é é e é é e É é e é é e É é e É é e É é e É é e"), (8, "another a b text"), (9, words(8) + " zz " + words(8, 8)), (1, words(40)), (11, "A\x00B"),
]


def tables(spark, docs=TEXTS, items=ITEMS):
    extra = ["1 as key", "2 as w", "3 as term", "4 as n_hit", "5 as found"]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", *extra),
        spark.createDataFrame(items, "item_id long, text string").selectExpr("*", *extra),
    )


def test_windows_against_brute_force(spark):
    a, b = tables(spark)
    assert got(d.report(a, b)) == brute(TEXTS, ITEMS)


def test_without_broadcast(spark, monkeypatch):
    with_it = sorted(d.report(*tables(spark)).collect(), key=str)
    monkeypatch.setattr(d, "broadcast_below", lambda df, size: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(d.report(*tables(spark)).collect(), key=str) == with_it
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_documents_against_brute_force(spark):
    a, b = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [(r[0], r[1]) for r in a.select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in b.select("item_id", "text").collect()]
    assert got(d.report(a, b)) == brute(rows, items)


def test_removal(spark, crowded):
    a, b = tables(spark)
    left = d.remove(a, b)
    assert left.columns == a.columns
    clean = {x[0] for x in brute(TEXTS, ITEMS) if not x[4]}
    assert {r.doc_id for r in left.collect()} == clean
    assert d.remove(crowded, b).columns == crowded.columns


def test_empty_tables(spark, docs, nothing):
    a, b = tables(spark)
    assert d.report(nothing, b).collect() == []
    assert d.report(docs, b.where("false")).where("contaminated or n_hit > 0").count() == 0
    assert d.report(docs, b).count() == docs.count()


def brute_near(docs, items, width=10, slop=1):
    """Per document the items with a window whose rarest term is in its place and all others within ``slop`` of theirs."""
    often = Counter(t for _, text in docs for t in split(text))
    out = []
    for doc, text in docs:
        w, found = split(text), set()
        for item, other in items:
            v = split(other)
            for i in range(max(len(v) - width + 1, 1) if v else 0):
                win = v[i : i + width]
                r = min(range(len(win)), key=lambda k: (often[win[k]], win[k], k))
                for s in (p - r for p in range(len(w)) if w[p] == win[r]):
                    if all(t in w[max(s + k - slop, 0) : max(s + k + slop + 1, 0)] for k, t in enumerate(win)):
                        found.add(item)
        out.append((doc, len(found - {None})))
    return sorted(out, key=str)


@pytest.mark.parametrize("slop", [1, 2])
def test_proximity_against_brute_force(spark, slop):
    dice = random.Random(6)
    items = [(i, " ".join(dice.choices("abcdefgh", k=dice.randint(1, 14)))) for i in range(12)] + ITEMS
    texts = []
    for i in range(30):
        w = dice.choices("abcdefghijkl", k=dice.randint(0, 40))
        moved = (dice.choice(items)[1] or "").split() if dice.random() < 0.7 else []
        for k in range(len(moved) - 1):
            if dice.random() < 0.2:
                moved[k], moved[k + 1] = moved[k + 1], moved[k]
        texts.append((100 + i, " ".join([*w, *moved, *w])))
    texts += TEXTS
    a, b = tables(spark, texts, [(i, t) for i, t in items if t is not None])
    rows = d.report(a, b, slop=slop).collect()
    assert sorted(((r.doc_id, r.n_near) for r in rows), key=str) == brute_near(texts, items, slop=slop)
    assert got(d.report(a, b, slop=slop)) == brute(texts, items)
    clean = [x[0] for x in brute(texts, items) if not x[4]]
    assert sorted((r.doc_id for r in d.remove(a, b).collect()), key=str) == sorted(clean, key=str)


def test_a_stored_index_serves_other_benchmarks(spark, tmp_path):
    a, b = tables(spark)
    d.build(a, f"{tmp_path}/index")
    index = d.load(spark, f"{tmp_path}/index")
    assert index.postings.columns == ["doc", "term", "pos"]
    assert index.postings.count() == sum(len(split(t)) for _, t in TEXTS)
    for items in (b, b.where("item_id = 3"), b.where("false")):
        _, matches, _ = d.find(a, items, index=index)
        ids = {r.id for r in matches.join(index.documents, "doc").select("id").collect()}
        wanted = brute(TEXTS, [(r.item_id, r.text) for r in items.collect()])
        assert ids == {x[0] for x in wanted if x[4]}


def test_merged_windows(spark):
    df = spark.createDataFrame([(1, 0, 3), (1, 2, 3), (1, 9, 1)], "key int, start int, length int")
    assert sorted((r.start, r.end) for r in d.merge_windows(df).collect()) == [(0, 5), (9, 10)]
    n = df.groupBy("key").agg(d.covered(F.collect_list(F.struct("start", "length"))).alias("n")).first().n
    assert n == 6
