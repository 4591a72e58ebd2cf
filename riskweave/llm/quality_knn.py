"""Operator 2: document quality by nearest-neighbour votes in a latent semantic space.

Terms are hashed into a fixed number of columns. Half of the columns hold words;
the other half hold their shapes (the runs of letters by case, of digits and of
signs, over the whole word, with rough lengths) and repetitions of the word one or two places before, since
form tells quality better than topic does. Document frequencies are counted
over all documents. A bounded, seeded, class-balanced sample of the training
labels is weighted by TF-IDF and decomposed (SVD), which gives the latent axes
and one vector for each sampled row; both are broadcast. Every document is
projected, compared with all labelled vectors by blocked exact cosine products,
and the nearest ones vote, weighted by similarity and by how common their class
is among the training labels.

Only texts enter a score. Rows with a null doc_id are scored and never held out.
Results by case: null, empty and blank texts have no direction, so they score the
share of good labels; so does everything if no label of both classes is known
(0.5 without any label). Several labels of one id count by their mean, a null
label not at all. Repeated rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of hashed words and shapes, latent axes, and the most labelled rows that are broadcast.
WORDS, SHAPES, AXES, SAMPLE = 128, 256, 48, 4096
NEIGHBOURS, SHARPNESS, BLOCK, WORD_WEIGHT = 25, 4.0, 1024, 0.3
WIDTH = WORDS + SHAPES

_CLASSES = bytearray(b"a" * 256)
for _code in range(128):
    _sign = chr(_code)
    _CLASSES[_code] = ord("A") if _sign.isupper() else ord("a") if _sign.islower() else ord("0") if _sign.isdigit() else _code
SHAPE_OF = bytes(_CLASSES)


def _shape_column(shape: bytes) -> int:
    """The column of a whole shape; runs count roughly, letters and digits as 1 or more, signs as 1, 2-3, 4-7, ..."""
    runs = ((chr(c), sum(1 for _ in run)) for c, run in groupby(shape))
    name = "".join(f"{c}{min(n, 2) if c in 'aA0' else n.bit_length()}" for c, n in runs)
    return WORDS + zlib.crc32(name.encode()) % (SHAPES - 2)


#: Columns of terms up to this length are remembered; longer ones are computed each time.
REMEMBERED = 256


class Terms:
    """Term counts of texts; remembers the columns of recent terms."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.shapes: dict[bytes, int] = {}

    @staticmethod
    def _keep(known: dict[bytes, int], term: bytes, column: int) -> int:
        if len(known) > 200_000:
            known.clear()
        if len(term) <= REMEMBERED:
            known[term] = column
        return column

    def counts(self, text: bytes | None) -> np.ndarray:
        row = np.zeros(WIDTH, np.float32)
        words = text.split() if text else []
        if not words:
            return row
        for word, n in Counter(words).items():
            column = self.words.get(word)
            if column is None:
                column = self._keep(self.words, word, zlib.crc32(word) % WORDS)
            row[column] += n
        for shape, n in Counter(text.translate(SHAPE_OF).split()).items():
            column = self.shapes.get(shape)
            if column is None:
                column = self._keep(self.shapes, shape, _shape_column(shape))
            row[column] += n
        row[WIDTH - 2] = sum(map(eq, words, words[1:]))
        row[WIDTH - 1] = sum(map(eq, words, words[2:]))
        return row


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows: relative counts under a square root, words and shapes each of unit length."""
    total = np.maximum(counts[:, :WORDS].sum(1, keepdims=True), 1)
    rows = np.sqrt(counts / total) * idf
    for part, weight in ((slice(0, WORDS), WORD_WEIGHT), (slice(WORDS, WIDTH), 1.0)):
        rows[:, part] *= weight / np.maximum(np.linalg.norm(rows[:, part], axis=1, keepdims=True), 1e-12)
    return rows


def _only_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("binary").alias("text"))


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many documents have words, and how many have each column; one small row per task is summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n, seen = Terms(), 0, np.zeros(WIDTH, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                row = terms.counts(text.as_py())
                n += bool(row.any())
                seen += row > 0
        yield pa.RecordBatch.from_arrays([pa.array(range(WIDTH + 1), pa.int32()), pa.array([n, *seen.tolist()], pa.int64())], names=["c", "n"])

    rows = _only_text(docs).mapInArrow(run, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()
    counts = dict(map(tuple, rows))
    return counts.get(0, 0), np.array([counts.get(c + 1, 0) for c in range(WIDTH)], np.float64)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the ids that no label is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


class Model:
    """Latent axes, labelled unit vectors and vote weights; ``vectors`` is None without two classes."""

    def __init__(self, idf: np.ndarray, axes: np.ndarray | None, vectors: np.ndarray | None, good: np.ndarray | None, weight: np.ndarray | None, prior: float):
        self.idf, self.axes, self.vectors, self.good, self.weight, self.prior = idf, axes, vectors, good, weight, prior

    def latent(self, counts: np.ndarray) -> np.ndarray:
        rows = weighted(counts, self.idf) @ self.axes
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        if self.vectors is None:
            return np.full(len(counts), self.prior)
        near = np.maximum(self.latent(counts) @ self.vectors.T, 0)
        k = min(NEIGHBOURS, near.shape[1])
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        votes = np.take_along_axis(near, best, 1) ** SHARPNESS * self.weight[best]
        total = votes.sum(1)
        return np.where(total > 0, (votes * self.good[best]).sum(1) / np.maximum(total, 1e-30), self.prior)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows, half of each class, chosen by a seeded hash of the id."""
    known = (
        labels.where("doc_id is not null and quality is not null").where(~held_out()).groupBy("doc_id")
        .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("good"))
    )
    share = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    n, seen = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    prior = share.get(1, 0) / sum(share.values()) if share else 0.5
    order = F.xxhash64(F.lit(2), "doc_id")
    chosen = [known.where(F.col("good") == c).orderBy(order, "doc_id").limit(sample // 2) for c in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most ``sample`` ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            rows = [terms.counts(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(rows, pa.binary())], names=["doc_id", "good", "row"])

    texts = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "good", F.col("text").cast("binary").alias("text"))
    rows = texts.mapInArrow(run, f"doc_id {dict(texts.dtypes)['doc_id']}, good int, row binary").groupBy("doc_id").agg(F.first("good").alias("good"), F.min("row").alias("row")).orderBy("doc_id").collect()
    good = np.array([r["good"] for r in rows], np.float32)
    if len(set(good.tolist())) < 2:
        return Model(idf, None, None, None, None, prior)
    counts = np.stack([np.frombuffer(r["row"], np.float32) for r in rows])
    some = counts.any(1)
    counts, good = counts[some], good[some]
    _, _, axes = np.linalg.svd(weighted(counts, idf), full_matrices=False)
    model = Model(idf, axes[:AXES].T.astype(np.float32), None, good, None, prior)
    model.vectors = model.latent(counts).astype(np.float32)
    # Undo the balance of the sample: a vote weighs as many labels as it stands for.
    model.weight = np.where(good > 0, prior / max(good.mean(), 1e-9), (1 - prior) / max(1 - good.mean(), 1e-9)).astype(np.float32)
    return model


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, out: str = "score", least: float | None = None) -> DataFrame:
    """The rows of ``docs`` and ``out``, the vote for good quality between 0 and 1; only those that reach ``least``, if given."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample))
    plain = docs.drop(out) if least is None else docs
    place = plain.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, found = Terms(), model.value
        for batch in batches:
            texts, scores = batch.column(place), []
            for start in range(0, len(texts), BLOCK):
                block = [terms.counts(None if (t := x.as_py()) is None else t.encode()) for x in texts.slice(start, BLOCK)]
                scores.extend(found.scores(np.stack(block)).tolist())
            scores = np.array(scores)
            if least is not None:
                yield batch.filter(pa.array(scores >= least))
                continue
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, out])

    # Columns go through the tasks by place, since their names may have any sign.
    names = plain.columns
    placed = plain.toDF(*[f"c{i}" for i in range(len(names))])
    schema = ", ".join(f"{c} {kind}" for c, kind in placed.dtypes)
    if least is not None:
        return placed.mapInArrow(run, schema).toDF(*names)
    return placed.mapInArrow(run, f"{schema}, `{out}` double").toDF(*names, out)


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted (1 from a score of 0.5)."""
    return scored(docs.select("doc_id", "text"), labels, sample).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the vote does not reject, with all their columns."""
    return scored(docs, labels, sample, least=0.5)
