from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave.llm import line_rules as r
from tests.conftest import DATA
from tests.llm.conftest import words


def brute(text):
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def test_counts(spark, docs, crowded, nothing):
    rows = [(i, t) for i, t in enumerate(["a b c a b c a b c", "x " * 200, "\n\n a\n a\na\n", "| < > # 漢字 é", None, "", words(60)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in r.measure(df).collect()}
    for i, text in rows:
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == brute(text)
        assert not (x.base_failed and x.kept)
    assert got[6].kept and not got[4].kept
    assert r.measure(crowded).count() == docs.count()
    assert r.measure(nothing).collect() == []
    assert r.clean(crowded).columns == crowded.columns


def test_documents(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = dict(df.select("doc_id", "text").collect())
    for x in r.measure(df).collect():
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == brute(texts[x.doc_id])


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("A plain sentence of some words.", None),
        ("Home", "navigation"),
        ("Home | News | Sport | More", "punctuation"),
        ("first and » second and » third and » fourth of all these many words in a row", "navigation"),
        ("WIN NOW!! TODAY!! ONLY HERE!! COME", "punctuation"),
        ("THIS LINE IS NOTHING BUT SHOUTED WORDS", "punctuation"),
        ("a*** b$$$ c### d&&&", "punctuation"),
        ("Copyright (c) 2020 Someone. All rights reserved.", "boilerplate"),
        ("Yes.", None),
    ],
)
def test_line(spark, line, rule):
    from pyspark.sql import functions as F

    assert spark.range(1).select(r.failed_rule(F.lit(line))).first()[0] == rule


def test_good_documents_stay_and_bad_ones_go(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = r.measure(docs).join(labels, "doc_id")
    assert out.where("quality = 0 and kept").count() == 0
    assert out.where("quality = 1 and not kept and not base_failed").count() == 0


def test_cleaned_text(spark):
    text = words(60) + ".\nHome\nAll rights reserved by all.\n" + words(30, 70) + "."
    out = r.clean(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert out.text == words(60) + ".\n" + words(30, 70) + "."


def test_blanks_around_a_line_do_not_count_as_words(spark):
    lines = ["three short words", "\tthree short words", "three short words\r", "\x0b three short words \f"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").select(r.failed_rule(F.col("line")).alias("rule"))
    assert {row.rule for row in df.collect()} == {"navigation"}
