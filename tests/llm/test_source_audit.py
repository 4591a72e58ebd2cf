from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from riskweave.llm import source_audit as s
from tests.conftest import DATA
from tests.oracle import assert_same, connect


def plain(rows):
    """The contract in plain Python over (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    find = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t))
    df, group = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        df[lang].update(set(find(text)))
        group[lang, source].update(find(text))
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in df[lang].items() if n >= 10]
        v = len(kept)
        share = lambda c, n: 1 + 10**9 * (c + 2) // (n + 2 * v)  # noqa: B023,E731
        mine = {g[1]: c for g, c in group.items() if g[0] == lang}
        p = {src: {t: share(c[t], sum(c[k] for k in kept)) for t in kept} for src, c in mine.items()}
        whole = {t: sum(c[t] for c in mine.values()) for t in kept}
        q = {t: share(whole[t], sum(whole.values())) for t in kept}
        for src in mine:
            parts = {
                "pair": [(sum(f(p[src][t], p[o][t]) for t in kept), o) for o in mine if o != src],
                "term": [(f(p[src][t], q[t]), t) for t in kept if mine[src][t] > 0 and p[src][t] > q[t]],
            }
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, src, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < 10]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def fixture(spark):
    rng = random.Random(3)
    rows = [(None, "en", "empty"), ("", None, None), ("1 2 3 --", "xx", "a"), (None, "xx", "b"), ("Word " * 50_000, "en", "s0"), ("once", None, "s0")]
    for i in range(240):
        lang = rng.choice(["en", "de", None])
        own = rng.choice(["s0", "s0", "s0", f"s{i % 7}", None])
        text = " ".join(rng.choice(["alpha", "Beta", "gämma", "Ärger", "it's", "x-y", f"rare{chr(97 + i % 26)}", f"{own}tok"]) for _ in range(rng.randint(0, 30)))
        rows += [(text, lang, own)] * rng.choice([1, 1, 3])
    return rows, spark.createDataFrame(rows, "text string, lang string, source string")


def test_against_plain_python(spark):
    rows, df = fixture(spark)
    assert got(s.audit(df)) == plain(rows)


def test_a_narrow_sketch_changes_nothing(spark, monkeypatch):
    rows, df = fixture(spark)
    monkeypatch.setattr(s, "HELD", 5)  # emptied again and again
    assert got(s.audit(df.repartition(7), width=s.BLOCK)) == plain(rows)


def test_against_sql(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    assert_same(s.audit(df).toPandas(), connect(DATA).sql(s.ORACLE).df())


def test_clashing_columns_and_empty_tables(spark, docs, crowded, nothing):
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert got(s.audit(crowded)) == plain(rows)
    assert s.audit(nothing).collect() == []


def test_the_sketch_never_underestimates_and_drops_most_rare_terms(spark):
    names = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    often = names[:40]
    rows = [(" ".join(often), "en") for _ in range(10)] + [(name, "en") for name in names[40:] for _ in range(3)]
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("source", F.lit("a"))
    bits = s.possible(df.repartition(5), s.BLOCK)
    passed = lambda some: s.survivors("en", [n.encode() for n in some], bits, s.BLOCK)
    assert passed(often).all()
    assert not passed(names[40:]).any()
    assert not s.survivors("de", [n.encode() for n in often], bits, s.BLOCK).all()


def test_shares_stay_exact_past_64_bits(spark):
    row = spark.range(1).selectExpr("cast(99999999999999999 as long) c", "cast(100000000000000003 as long) n", "cast(7 as long) v")
    assert row.select(s.share("c", "n").alias("p")).first().p == 1 + 10**9 * (99999999999999999 + 2) // (100000000000000003 + 14)
    assert np.array_equal(s.cells("en", [b"a"], 1 << 20), s.cells("en", [b"a"], 1 << 20))
