from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import hmm_scoring as h
from tests.conftest import DATA


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(x.lower() if x.isascii() else x for x in text or "")) if w]


def out_of_training(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def plain_base(rows):
    counts = Counter()
    for doc, text in rows:
        if not out_of_training(doc):
            counts.update(plain_words(text))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        tokens = [*plain_words(text), None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((doc, out_of_training(doc), len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return sorted(out, key=str)


def check_base(df, rows):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()), key=str)
    want = plain_base(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def tiny_model(states=2, seed=1):
    rng = np.random.default_rng(seed)
    some = lambda *shape: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(shape) + 0.05)
    return h.Model(some(states), some(states), some(states, states), np.ascontiguousarray(some(states, h.CLASSES).T))


def by_all_paths(seq, m, begin):
    """(likelihood, expected classes, moves, starts) by the sum over all state sequences."""
    total, moves, states = 0.0, np.zeros_like(m.moves), np.zeros((len(seq), len(m.start)))
    for path in itertools.product(range(len(m.start)), repeat=len(seq)):
        p = begin[path[0]] * m.words[seq[0], path[0]]
        for a, b, x in zip(path, path[1:], seq[1:], strict=False):
            p *= m.moves[a, b] * m.words[x, b]
        total += p
        for t, s in enumerate(path):
            states[t, s] += p
        for a, b in itertools.pairwise(path):
            moves[a, b] += p
    return total, states / total, moves / total


def test_recursions_against_all_paths():
    m = tiny_model(3)
    seqs = [np.array(s, np.uint16) for s in ([5, 9, 5, 0], [7], [0], [9, 9, 9, 9, 9, 0], [65535, 1])]
    first = np.array([True, False, True, True, False])
    likelihoods = h.log_likelihoods(seqs, m)
    by_class, by_move, start, resume = h.expectations(seqs, first, m)
    want = [np.zeros_like(by_class), np.zeros_like(by_move), np.zeros(3), np.zeros(3)]
    for seq, begins, got in zip(seqs, first, likelihoods, strict=True):
        assert got == pytest.approx(math.log(by_all_paths(seq, m, m.start)[0]))
        _, states, moves = by_all_paths(seq, m, m.start if begins else m.resume)
        np.add.at(want[0], seq, states)
        want[1] += moves
        want[2 if begins else 3] += states[0]
    for a, b in zip((by_class, by_move, start, resume), want, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-4, atol=1e-6)


def test_each_round_raises_the_likelihood(monkeypatch):
    monkeypatch.setattr(h, "WORD_PRIOR", 0.01)  # smoothing is no part of the guarantee
    monkeypatch.setattr(h, "COMMON", 1e-6)
    monkeypatch.setattr(h, "MOVE_PRIOR", 1e-6)
    rng = random.Random(2)
    seqs = [np.array([rng.choice([10, 11, 12] if i % 2 else [20, 21, 12]) for _ in range(40)] + [0], np.uint16) for i in range(60)]
    mass = np.bincount(np.concatenate(seqs), minlength=h.CLASSES).astype(float)
    model, last = h.beginning(mass, 2), -np.inf
    for _ in range(6):
        now = h.log_likelihoods(seqs, model).sum()
        assert now > last - 1e-6
        last, model = now, h.improved(mass, *h.expectations(seqs, np.ones(len(seqs), bool), model))
    hidden = model.words[[10, 11, 20, 21]]
    assert abs(hidden[:2].sum(0).argmax() - hidden[2:].sum(0).argmax()) == 1  # a state for each kind of text


def test_the_model_is_a_distribution():
    m = tiny_model()
    assert sum(np.exp(h.log_likelihoods([np.array([x], np.uint16) for x in range(0, h.CLASSES)], m))) == pytest.approx(1)
    made = h.improved(np.arange(h.CLASSES, dtype=float), np.zeros((h.CLASSES, 2)), np.zeros((2, 2)), np.zeros(2), np.zeros(2))
    np.testing.assert_allclose([made.words.sum(0), made.moves.sum(1)], 1)


def test_base_columns_and_scores_against_plain_python(spark, docs, crowded, nothing):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_base(h.score(crowded, rounds=1), rows)
    assert h.score(nothing, rounds=1).collect() == []
    same = [r.score for r in h.score(docs, rounds=1).where("doc_id = 1").collect()]
    assert len(same) == 2 and same[0] == same[1]


def test_shared_classes_are_exact(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(300)], k=rng.randint(0, 60)))) for i in range(120)]
    rows += [(None, "w0 never-seen"), (next(i for i in range(1000, 2000) if out_of_training(i)), "unknown words W1 " + "x" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(h, "HEAD", h.CLASSES - 20)  # all but a few words share classes
    out = h.score(df, rounds=2)
    check_base(out, rows)
    known = h.vocabulary(df.select(h.held_out().alias("o"), F.col("text").cast("binary").alias("text")).where("not o"))
    assert 0 < len(known.codes) <= 20
    rest = {bytes(r.word): r for r in known.rest.collect()}
    masses, sizes = Counter(), Counter()
    for r in rest.values():
        assert r["class"] == h.shared_class(bytes(r.word))
        masses[r["class"]] += r.n
        sizes[r["class"]] += 1
    assert all(known.mass[k] == n for k, n in masses.items())
    coded = h.coded(df.withColumn("held_out", h.held_out()).withColumn("text", F.coalesce(F.col("text"), F.lit("")).cast("binary")), known)
    model = h.train(coded.where("not held_out"), known.mass, rounds=2)
    want = []
    for doc, text in rows:
        tokens = [w.encode() for w in plain_words(text)]
        seq = np.array([known.codes.get(w) or h.shared_class(w) for w in tokens] + [0], np.uint16)
        inside = sum(math.log10(((rest[w].n if w in rest else 0) + 0.1) / (masses[h.shared_class(w)] + 0.1 * (sizes[h.shared_class(w)] + 1))) for w in tokens if w not in known.codes)
        want.append((doc, h.log_likelihoods([seq], model)[0] / math.log(10) + inside))
    got = sorted(((r.doc_id, r.score) for r in out.collect()), key=str)
    want.sort(key=str)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], rel=1e-4)


def test_held_out_texts_are_likelier_than_by_the_base_model(spark):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    out = h.score(df).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert out.s > out.b + 0.01 * abs(out.b)


def test_without_training_texts(spark):
    only = [i for i in range(300) if out_of_training(i)][:3]
    rows = [(i, "a b") for i in only]
    check_base(h.score(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1), rows)
