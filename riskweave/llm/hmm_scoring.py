"""Operator 12: log-probabilities of texts from a hidden Markov language model.

Training texts are counted word by word. The words with the greatest counts are
classes of their own, all others share hashed classes, so the model has CLASSES
classes whatever the corpus holds: a word of a shared class has, inside it, the
share of its exact count, and unknown words together one share more. Baum-Welch
trains STATES latent states over the classes: in each round every task runs the
scaled forward-backward recursion on pieces of at most PIECE tokens of whole
training texts, the expected counts are added up across tasks, and the driver
gets one row a class. The score of a text is the scaled forward recursion over
its whole sequence, end token included, and the shares inside shared classes.

What grows with the corpus stays distributed: the counts of all words, and the
words of shared classes in each text, which meet in a join on the word.

Results by case: a null text is empty and has the end token only; a null doc_id
is never held out; repeated rows get equal scores; without training texts every
token is unknown and the model knows no words; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import text_of
from riskweave.session import cut

#: Classes: the end token, shared ones, and from HEAD on words of their own; they fit two bytes.
END, SHARED, HEAD, CLASSES = 0, 4095, 4096, 65536
STATES, ROUNDS, PIECE, STICK, SEED = 8, 6, 512, 0.9, 42
#: Pseudo-counts: of a token in the base model, of a move between states, of tokens in each state by the shares of all words; and the part that these shares have of every state besides.
TOKEN_PRIOR, MOVE_PRIOR, WORD_PRIOR, COMMON = 0.1, 1.0, 5000.0, 0.05
#: Words of a class of their own have at most that many bytes; grades of counts per power of two; entries of a task's dictionary; sequences and cells run side by side.
HEAD_BYTES, GRADES, HELD, LANES, LANE_CELLS = 64, 64, 500_000, 1024, 1 << 22


class Vocabulary(NamedTuple):
    """The counts of the training texts: a class of each frequent word, the mass of each class, and the table of all others."""

    codes: dict[bytes, int]
    mass: np.ndarray
    rest: DataFrame
    tokens: int
    distinct: int


class Model(NamedTuple):
    start: np.ndarray
    resume: np.ndarray
    moves: np.ndarray
    words: np.ndarray


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def tokens_of(text: bytes) -> list[bytes]:
    """Words in order; on bytes, only A-Z change and only the six ASCII spaces separate."""
    return text.lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column ``text`` of bytes; the empty word counts the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for text in batch.column("text"):
                held.update(tokens_of(text.as_py()))
                held[b""] += 1
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def shared_class(word: bytes) -> int:
    return 1 + zlib.crc32(word) % SHARED


def vocabulary(texts: DataFrame) -> Vocabulary:
    """Counts of the training texts. To the driver come one row a grade, at most CLASSES - HEAD words and one row for each shared class."""
    counts = cut(word_counts(texts))
    own = (F.octet_length("word") > 0) & (F.octet_length("word") <= HEAD_BYTES)
    grade = F.floor(F.log2("n") * GRADES)
    grades = sorted(((r.grade, r.words) for r in counts.where(own).groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, room = float("inf"), CLASSES - HEAD
    for found, words in grades:
        if words > room:
            break
        least, room = found, room - words
    head = own & (grade >= F.lit(least))
    codes, mass = {}, np.zeros(CLASSES)
    for i, (word, n) in enumerate(sorted((-r.n, bytes(r.word)) for r in counts.where(head).collect())):
        codes[bytes(n)] = HEAD + i
        mass[HEAD + i] = -word
    rest = counts.where(~head & (F.octet_length("word") > 0)).select("word", "n", (1 + F.crc32("word") % SHARED).cast("int").alias("class"))
    for r in _shares(rest).collect():
        mass[r["class"]] = r.n
    total = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct"), F.sum(F.when(F.octet_length("word") == 0, F.col("n"))).alias("texts")).first()
    mass[END] = total.texts or 0
    return Vocabulary(codes, mass, rest, total.tokens or 0, total.distinct)


def _shares(rest: DataFrame) -> DataFrame:
    """(class, n, words): the count of each shared class; SHARED rows at most."""
    return rest.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words"))


def base_log(n: np.ndarray | float, known: Vocabulary) -> np.ndarray | float:
    """The base model's log10 share of a token with count ``n``."""
    return np.log10((n + TOKEN_PRIOR) / (known.tokens + TOKEN_PRIOR * (known.distinct + 1)))


def coded(docs: DataFrame, known: Vocabulary) -> DataFrame:
    """Per row its classes (two bytes each, end included), the part of the base score of words with their own class, and its other words with their counts."""
    codes = docs.sparkSession.sparkContext.broadcast(known.codes)
    logs, end_known = base_log(known.mass, known), int(known.mass[END] > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = codes.value.get
        for batch in batches:
            n_tokens, n_known, base, seq, words, times = [], [], [], [], [], []
            for text in batch.column("text"):
                found = tokens_of(text.as_py())
                classes = np.fromiter(map(get, found, repeat(0)), np.uint16, len(found))
                others = [found[i] for i in np.flatnonzero(classes == 0)]
                n_tokens.append(len(found) + 1)
                n_known.append(len(found) - len(others) + end_known)
                base.append(float(logs[classes[classes > 0]].sum() + logs[END]))
                classes[classes == 0] = [*map(shared_class, others)]
                seq.append(classes.astype("<u2").tobytes() + b"\0\0")
                each = Counter(others)
                words.append(list(each))
                times.append(list(each.values()))
            made = [pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(seq, pa.binary()), pa.array(words, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), *made], names=["doc_id", "held_out", "n_tokens", "n_known", "base", "seq", "words", "times"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, base double, seq binary, words array<binary>, times array<long>"
    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def _lanes(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which, classes, running): sequences side by side, the longest first; running: how many have a token at each step."""
    order = np.argsort([-len(s) for s in sequences], kind="stable")
    at = 0
    while at < len(order):
        longest = len(sequences[order[at]])
        which = order[at : at + max(1, min(LANES, LANE_CELLS // longest))]
        at += len(which)
        lengths = np.array([len(sequences[i]) for i in which])
        classes = np.zeros((longest, len(which)), np.intp)
        for lane, i in enumerate(which):
            classes[: lengths[lane], lane] = sequences[i]
        yield which, classes, np.searchsorted(-lengths, -np.arange(longest), side="left")


def _rows(words: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return words.take(classes, axis=0, mode="clip")  # quicker than indexing; classes are always in range


def expectations(pieces: list[np.ndarray], first: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts over the pieces: of classes by state, of moves, and of states at the starts of texts and of later pieces."""
    words, moves = model.words.astype(np.float32), model.moves.astype(np.float32)
    back, states = np.ascontiguousarray(moves.T), len(model.start)
    every = np.ones((states, states), np.float32)  # a product with it puts a row's sum in all its places
    by_class, by_move = np.zeros((CLASSES, states)), np.zeros((states, states))
    starts = np.zeros((2, states))
    for which, classes, running in _lanes(pieces):
        steps, lanes = classes.shape
        seen = np.zeros((steps, lanes, states), np.float32)
        state = np.where(first[which, None], model.start, model.resume).astype(np.float32)
        for t in range(steps):
            m = running[t]
            state = (state[:m] @ moves if t else state[:m]) * _rows(words, classes[t, :m])
            state /= state @ every
            seen[t, :m] = state
        later = np.ones((lanes, states), np.float32)
        for t in range(steps - 1, 0, -1):
            m = running[t]
            ahead = later[:m] * _rows(words, classes[t, :m])
            seen[t, :m] *= later[:m]
            before = ahead @ back
            scale = (seen[t - 1, :m] * before) @ every
            by_move += seen[t - 1, :m].T @ (ahead / scale)
            later[:m] = before / scale
        seen[0] *= later
        for kind in (0, 1):
            starts[kind] += seen[0, first[which] == (kind == 0)].sum(0)
        there = np.arange(lanes) < running[:, None]
        flat, found = classes[there], seen[there]
        for s in range(states):
            by_class[:, s] += np.bincount(flat, found[:, s], CLASSES)
    return by_class, by_move * model.moves, starts[0], starts[1]


def _round(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The expected counts of one round over all training sequences, added up across tasks; a row for each class and state comes back."""
    shared = train.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)
    names = [f"s{i}" for i in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            pieces, first = [], []
            for seq in batch.column("seq"):
                whole = np.frombuffer(seq.as_py(), "<u2")
                for at in range(0, len(whole), PIECE):
                    pieces.append(whole[at : at + PIECE])
                    first.append(at == 0)
            if pieces:
                got = expectations(pieces, np.array(first), shared.value)
                sums = got if sums is None else tuple(a + b for a, b in zip(sums, got, strict=True))
        if sums is not None:
            filled = np.flatnonzero(sums[0].any(1))
            rows = np.concatenate([sums[0][filled], sums[1], sums[2][None], sums[3][None]]).astype(np.float32)
            item = np.concatenate([filled, CLASSES + np.arange(states + 2)])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], names=["item", *names])

    found = train.select("seq").mapInArrow(run, ", ".join(["item int", *(f"{n} float" for n in names)]))
    rows = np.zeros((CLASSES + states + 2, states))
    for r in found.groupBy("item").agg(*[F.sum(n).alias(n) for n in names]).collect():
        rows[r.item] = [r[n] for n in names]
    shared.destroy()
    return rows[:CLASSES], rows[CLASSES:-2], rows[-2], rows[-1]


def beginning(mass: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """Shares of all words, unevenly changed in each state; states that tend to stay."""
    noise = np.random.default_rng(seed).normal(size=(CLASSES, states))
    words = _unigram(mass)[:, None] * np.exp(noise)
    moves = np.full((states, states), (1 - STICK) / max(states - 1, 1)) + np.eye(states) * (STICK - (1 - STICK) / max(states - 1, 1))
    even = np.full(states, 1 / states)
    return Model(even, even, moves / moves.sum(1, keepdims=True), words / words.sum(0))


def _unigram(mass: np.ndarray) -> np.ndarray:
    return (mass + TOKEN_PRIOR) / (mass + TOKEN_PRIOR).sum()


def improved(mass: np.ndarray, by_class: np.ndarray, by_move: np.ndarray, start: np.ndarray, resume: np.ndarray) -> Model:
    """The model of the expected counts; a state that has none has the shares of all words."""
    even = lambda x: (x + MOVE_PRIOR) / (x + MOVE_PRIOR).sum(-1, keepdims=True)
    words = COMMON * _unigram(mass)[:, None] + (1 - COMMON) * (by_class + WORD_PRIOR * _unigram(mass)[:, None]) / (by_class.sum(0) + WORD_PRIOR)
    return Model(even(start), even(resume), even(by_move), words)


def train(sequences: DataFrame, mass: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    model = beginning(mass, states)
    for _ in range(rounds):
        model = improved(mass, *_round(sequences, model))
    return model


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """The natural log-probability of each sequence of classes, by the forward recursion scaled at every token."""
    out, every = np.zeros(len(sequences)), np.ones((len(model.start), len(model.start)))
    for which, classes, running in _lanes(sequences):
        state = np.broadcast_to(model.start, (len(which), len(model.start)))
        total = np.zeros(len(which))
        for t in range(len(classes)):
            m = running[t]
            state = (state[:m] @ model.moves if t else state[:m]) * _rows(model.words, classes[t, :m])
            scale = state @ every
            state /= scale
            total[:m] += np.log(scale[:, 0])
        out[which] = total
    return out


def _forward(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [c for c in rows.columns if c != "seq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = log_likelihoods([np.frombuffer(x.as_py(), "<u2") for x in batch.column("seq")], shared.value) / math.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found)], names=[*names, "forward"])

    return rows.mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in rows.dtypes if n != "seq"), "forward double"]))


def score(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    rows = docs.select("doc_id", held_out().alias("held_out"), text_of().cast("binary").alias("text"))
    known = vocabulary(rows.where("not held_out"))
    parts = cut(coded(rows, known)).withColumn("rid", F.monotonically_increasing_id())
    model = train(parts.where("not held_out"), known.mass, states, rounds)
    forward = _forward(parts.select("rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "seq"), model)
    others = parts.select("rid", F.explode(F.arrays_zip("words", "times")).alias("x")).select("rid", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    met = others.join(known.rest.select("word", "n"), "word", "left").select("rid", "times", F.coalesce("n", F.lit(0)).alias("n"), (1 + F.crc32("word") % SHARED).cast("int").alias("class"))
    shares = _shares(known.rest).select("class", F.col("n").alias("class_n"), F.col("words").alias("class_words"))
    met = met.join(F.broadcast(shares), "class", "left").na.fill(0, ["class_n", "class_words"])  # SHARED rows at most
    base = F.log10((F.col("n") + TOKEN_PRIOR) / F.lit(known.tokens + TOKEN_PRIOR * (known.distinct + 1)))
    inside = F.log10((F.col("n") + TOKEN_PRIOR) / (F.col("class_n") + TOKEN_PRIOR * (F.col("class_words") + 1)))
    sums = met.groupBy("rid").agg(F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * base).alias("more_base"), F.sum(F.col("times") * inside).alias("inside"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return forward.join(sums, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("more_known")).alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("more_base")).alias("base_score"), (F.col("forward") + zero("inside")).alias("score"),
    )
