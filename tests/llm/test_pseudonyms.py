from __future__ import annotations

import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from riskweave.llm import pseudonyms as p
from tests.conftest import DATA


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def run(spark, texts, key=p.KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.n_pii, r.pii_kinds) for r in p.protect(df, key).orderBy("doc_id").collect()]


SHAPES = {
    "mail bob.smith42@mail3.example.com now": r"mail [a-z]{3}\.[a-z]{5}\d{2}@mail3\.example\.com now",
    "card 4041894974608795.": r"card 4\d{15}\.",
    "card 4041-8949-7460-8795": r"card 4\d{3}-\d{4}-\d{4}-\d{4}",
    "call +1 (988) 555-2485 ok": r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} ok",
    "call +1 (025) 155-2485 ok": r"call \+1 \(0\d\d\) 1\d\d-\d{4} ok",
    "at 70.123.182.155": r"at (\d{1,3}\.){3}\d{1,3}",
    "ssn 123-45-6789": r"ssn \d{3}-\d{2}-\d{4}",
    "on 2024-02-29": r"on (19|20)\d\d-\d\d-\d\d",
    "iban DE89 3704 0044 0532 0130 00": r"iban DE\d\d( \d{4}){4} \d\d",
    "to BE68 5390 0754 7034 NOW": r"to BE\d\d( \d{4}){3} NOW",
    "ES9121000418450200051332 BIC": r"ES\d{22} BIC",
    "AT61 1904 3002 3457 3201 BIC": r"AT\d\d( \d{4}){4} BIC",
    "BE68539007547034 2024": r"BE\d{14} 2024",
    "amex 3782 822463 10005 x": r"amex 3\d{3} \d{6} \d{5} x",
    "diners 3056 930902 5904": r"diners 3\d{3} \d{6} \d{4}",
    "born 25/12/1980.": r"born (1[3-9]|2\d|30|31)/(0[1-9]|1[0-2])/(19|20)\d\d\.",
    "born 29/02/2000.": r"born 29/02/(19|20)\d[02468]\.",
    "call +44 20 7946 0958 today": r"call \+44 \d\d \d{4} \d{4} today",
    "call +49 (30) 901820": r"call \+49 \(\d\d\) \d{6}",
    "call +33142685300": r"call \+331\d{8}|call \+33\d{9}",
}


def test_format_is_kept_and_value_is_not(spark):
    for (new, n, _), (text, shape) in zip(run(spark, list(SHAPES)), SHAPES.items(), strict=True):
        assert n == 1 and new != text and re.fullmatch(shape, new), (text, new)


UNCHANGED = ["card 4041894974608796", "300.1.1.1", "000-12-3456", "2023-02-29", "1850-01-01", "DE00 3704 0044 0532 0130 00", "version 1.2.3", "plain", "", "12345"]


def test_what_fails_validation_stays(spark):
    assert run(spark, UNCHANGED) == [(text, 0, "") for text in UNCHANGED]


def test_links_and_keys(spark):
    a, b, c = run(spark, ["x 4041894974608795 y", "4041894974608795", "4041894974608795 bob@a.org 2024-01-05 bob@a.org"])
    assert a[0].split()[1] == b[0] == c[0].split()[0]
    assert c[0].split()[1] == c[0].split()[3] and c[2] == "card,email,date,email"
    assert luhn(b[0])
    assert run(spark, ["4041894974608795"], key="another") != [b]


@pytest.mark.parametrize(("left", "right"), [(319, 229), (10, 10), (1, 7), (898, 11)])
def test_permutation_is_a_bijection(spark, left, right):
    n = left * right
    got = spark.range(n).select(p.permute(F.col("id"), left, right, "k", "t").alias("x")).agg(F.count_distinct("x"), F.min("x"), F.max("x")).first()
    assert tuple(got) == (n, 0, n - 1)


def test_large_domains_use_whole_numbers(spark):
    n = 10**17 - 1
    df = spark.createDataFrame([(n,), (n - 1,), (10**9,), (0,)], "x long")
    got = [r[0] for r in df.select(p.permute(F.col("x"), 10**9, 10**8, "k", "t")).collect()]
    assert len(set(got)) == 4 and all(0 <= x < 10**17 for x in got)


def test_characters_are_permuted_within_their_class(spark):
    names = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "0123456789"]
    df = spark.createDataFrame([(x,) for x in names], "x string")
    got = [r[0] for r in df.select(p.permute_chars(F.col("x"), "k", F.lit("t"))).collect()]
    assert sorted(got) == sorted(names)


def test_made_values_are_valid(spark):
    texts = [f"{i:03d}-{10 + i % 80}-{1000 + i}" for i in range(1, 200)] + [str(dt.date(2000, 1, 1) + dt.timedelta(i)) for i in range(100)]
    out = run(spark, texts)
    assert len({x[0] for x in out if x[1]}) == sum(x[1] for x in out)
    for (new, n, kind), old in zip(out, texts, strict=True):
        if kind == "date":
            dt.date.fromisoformat(new)
        if kind == "ssn":
            assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", new), (old, new, n)


def test_tables(spark, docs, crowded, nothing):
    out = p.protect(crowded)
    assert out.count() == docs.count()
    assert set(out.columns) == {*crowded.columns, "pii_kinds"}
    assert p.protect(nothing).collect() == []
    same = p.protect(docs).collect()
    assert sorted((str(r.text) for r in same)) == sorted(str(r.text) for r in docs.collect())


def test_documents(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    out = p.protect(df.select("doc_id", "text"))
    pairs = out.join(df.select("doc_id", F.col("text").alias("old")), "doc_id").where("n_pii > 0").collect()
    assert pairs
    for r in pairs:
        for mail in re.findall(r"\S+@\S+\.\w+", r.old):
            assert mail not in r.text
        for card in re.findall(r"(?<!\d)\d{16}(?!\d)", r.old):
            assert card not in r.text if luhn(card) else card in r.text
        assert r.old.count("\n") == r.text.count("\n")


def test_long_runs_without_a_blank(spark):
    """A run of a million letters takes linear time; so do very many labels after an @."""
    run_of = "a" * 1_000_000
    many = "me@x" + ".y" * 20_000
    out = run(spark, [run_of, many, "write to jo@example.org"])
    assert out[0] == (run_of, 0, "")
    assert out[1][2].startswith("email") and "me@" not in out[1][0]
    assert out[2][2] == "email"


def test_day_first_dates_are_a_bijection(spark):
    days = [dt.date(1900, 1, 1) + dt.timedelta(i) for i in range(73049)]
    texts = [f"{d.day:02d}/{d.month:02d}/{d.year}" for d in days if d.day > 12]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(p._date(F.col("v"), "k")).collect()]
    assert sorted(got) == sorted(texts)


def feistel(x, left, right, key, tag):
    """The network, value by value."""
    def keyed(*parts):
        return int(hashlib.sha256("|".join([key, *map(str, parts)]).encode()).hexdigest()[:13], 16)

    a, b = divmod(x, right)
    for i in range(p.ROUNDS):
        if i % 2 == 0:
            a = (a + keyed(tag, i, b)) % left
        else:
            b = (b + keyed(tag, i, a)) % right
    return a * right + b


def brute(text: str, key: str = p.KEY) -> str:
    """Cards, social security numbers, addresses and month-first or ISO dates, match by match in plain Python."""
    def card(m):
        number = re.sub(r"\D", "", m[0])
        if not luhn(number):
            return m[0]
        n = len(number)
        head = number[0] + str(feistel(int(number[1:-1]), 10 ** ((n - 1) // 2), 10 ** ((n - 2) // 2), key, f"card{n}:{number[0]}")).zfill(n - 2)
        new = iter(next(head + d for d in "0123456789" if luhn(head + d)))
        return "".join(next(new) if c.isdigit() else c for c in m[0])

    def ssn(m):
        a, g, s = map(int, m[0].split("-"))
        if a in (0, 666) or a >= 900 or not g or not s:
            return m[0]
        top, low = divmod(feistel((a - (2 if a > 666 else 1)) * 989901 + (g - 1) * 9999 + s - 1, 898, 989901, key, "ssn"), 989901)
        top += 1
        return f"{top + (top >= 666):03d}-{low // 9999 + 1:02d}-{low % 9999 + 1:04d}"

    def ip(m):
        parts = list(map(int, m[0].split(".")))
        if max(parts) > 255:
            return m[0]
        new = feistel(int.from_bytes(bytes(parts)), 65536, 65536, key, "ip")
        return ".".join(map(str, new.to_bytes(4)))

    def date(m):
        try:
            day = dt.date.fromisoformat(m[0])
        except ValueError:
            return m[0]
        first = dt.date(1900, 1, 1)
        return str(first + dt.timedelta(feistel((day - first).days, 319, 229, key, "date"))) if 1900 <= day.year < 2100 else m[0]

    makers = {"ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn), "ip": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", ip),
              "date": (r"(?<![\d.])\d{4}-\d{2}-\d{2}(?!\d)", date), "card": (r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\d-])", card)}
    whole = re.compile("|".join(f"(?P<{k}>{pattern})" for k, (pattern, _) in makers.items()), re.A)
    return whole.sub(lambda m: makers[m.lastgroup][1](m), text)


def test_against_plain_python(spark):
    dice = random.Random(4)
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(dice.randint(1, 8)):
            digits = "".join(dice.choice("0123456789") for _ in range(15))
            check = next(d for d in "0123456789" if luhn(digits + d))
            day = dt.date(1900, 1, 1) + dt.timedelta(dice.randrange(80000))
            parts.append(dice.choice([
                digits + check, f"{digits[:4]} {digits[4:8]} {digits[8:12]} {digits[12:]}{check}", f"{digits[:3]}-{digits[3:5]}-{digits[5:9]}", str(day),
                ".".join(str(dice.randrange(0, 300)) for _ in range(4)), "word", "漢字",
            ]))
        texts.append(" ; ".join(parts))
    assert [x[0] for x in run(spark, texts)] == [brute(t) for t in texts]
