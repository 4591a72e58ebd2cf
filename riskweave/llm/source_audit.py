"""Operator 13: how far the sources of a language differ in their words.

A language keeps the terms that at least ten of its documents have. Whether a
term can be one of them is asked of a count-min sketch first: every task adds
its document frequencies to a sketch of its own, whose filled cells are shuffled
by block and merged in two steps. A cell's sum is never below the frequency of
a term in it, so a term with any cell below ten can't be kept and is dropped
before its counts are shuffled. Cells stop at ten, and what is broadcast is one
bit a cell. The width follows the measured size of the texts up to a fixed
bound; a sketch that is too narrow drops fewer terms and changes no result.

The survivors are counted exactly per language, source and term, and their exact
document frequencies decide. Divergences are sums over all kept terms, but two
sources need only meet at the terms that both have: a term of one of them alone
counts against the other's value for absent terms, which depends on nothing but
its own count, and terms of neither count alike.

Results by case: null text, lang and source are ''; a group without terms has
count 0 of each; a language without kept terms gives its pairs with value 0;
documents are counted by rows, so repeated rows count again, whatever their ids.
An empty table gives no rows. Extra columns are ignored. A language's sources
meet pairwise in the result itself, so their number must be one whose square can
be stored. Counts may reach 10^18.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import text_of
from riskweave.session import cut

#: Documents of its language that a kept term is in, ranks of the term part, scale of the shares.
LEAST_DOCS, TERM_RANKS, SCALE = 10, 10, 1_000_000_000
#: Rows of the sketch, bytes of text for each cell of a row, and the bounds of a row's width: 12 MiB of bits at most.
DEPTH, BYTES_A_CELL, WIDTHS = 3, 40, (1 << 16, 1 << 25)
BLOCK = 1 << 16
#: Parts that the tasks' sketches are merged in before the last step, and entries of a task's dictionaries before they are emptied.
SALTS, HELD = 32, 500_000

#: Bytes outside terms become blanks, A-Z become a-z; bytes of characters past ASCII stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order."""
    return text.translate(_TERM_BYTES).split()


def cells(lang: str, found: list[bytes], width: int) -> np.ndarray:
    """(DEPTH, n): the cell of every term in each row of the sketch."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    h = np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(seed)), np.uint64, len(found))
    step = (h >> np.uint64(32)) | np.uint64(1)
    rows = [(h + np.uint64(r) * step) & np.uint64(width - 1) for r in range(DEPTH)]
    return np.stack(rows).astype(np.int64)


def _summed(at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different places and the sum at each."""
    order = np.argsort(at, kind="stable")
    at, n = at[order], n[order]
    starts = np.flatnonzero(np.diff(at, prepend=-1))
    return at[starts], np.add.reduceat(n, starts)


def _inputs(docs: DataFrame) -> DataFrame:
    """(lang, source, text): the text as bytes, no nulls."""
    return docs.select(text_of("lang").alias("lang"), text_of("source").alias("source"), text_of().cast("binary").alias("text"))


_CELLS = "salt int, block long, places binary, sums binary"


def _cell_rows(salt: list[int], block: list[int], places: list[bytes], sums: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(salt, pa.int32()), pa.array(block, pa.int64()), pa.array(places, pa.binary()), pa.array(sums, pa.binary())], names=["salt", "block", "places", "sums"]
    )


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """(salt, block, places, sums): the filled cells of each task's sketch; sums stop at LEAST_DOCS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(DEPTH * width, np.uint8)
        held: dict[str, Counter] = defaultdict(Counter)

        def add() -> None:
            for lang, counted in held.items():
                if not counted:
                    continue
                n = np.minimum(np.fromiter(counted.values(), np.int64, len(counted)), LEAST_DOCS)
                for row, at in enumerate(cells(lang, list(counted), width)):
                    at, sums = _summed(at + row * width, n)
                    own[at] = np.minimum(own[at] + sums, LEAST_DOCS)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                held[lang].update(set(terms(text.as_py())))
                if sum(map(len, held.values())) > HELD:
                    add()
        add()
        salt = TaskContext.get().partitionId() % SALTS
        for block in range(len(own) // BLOCK):
            part = own[block * BLOCK : (block + 1) * BLOCK]
            filled = np.flatnonzero(part)
            if len(filled):
                yield _cell_rows([salt], [block], [filled.astype("<u2").tobytes()], [part[filled].tobytes()])

    return _inputs(docs).mapInArrow(run, _CELLS)


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Sketches with equal keys added up; a task holds one block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(0, np.uint8)

        def done() -> pa.RecordBatch:
            filled = np.flatnonzero(total)
            return _cell_rows([key[0]], [key[1]], [filled.astype("<u2").tobytes()], [total[filled].tobytes()])

        for batch in batches:
            for salt, block, places, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                this = (salt if "salt" in keys else 0, block)
                if this != key:
                    if key:
                        yield done()
                    key, total = this, np.zeros(BLOCK, np.uint8)
                at = np.frombuffer(places, "<u2")
                total[at] = np.minimum(total[at] + np.frombuffer(sums, np.uint8), LEAST_DOCS)
        if key:
            yield done()

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _CELLS)


def width_for(docs: DataFrame) -> int:
    """The width of a sketch's row: a power of two by the size of the texts, within WIDTHS."""
    size = docs.select(F.sum(F.octet_length(text_of()))).first()[0] or 0
    return int(min(max(1 << max(size // BYTES_A_CELL, 1).bit_length(), WIDTHS[0]), WIDTHS[1]))


def possible(docs: DataFrame, width: int) -> np.ndarray:
    """One bit for each cell of the merged sketch, set where its sum has reached LEAST_DOCS."""
    bits = np.zeros((DEPTH * width // BLOCK, BLOCK // 8), np.uint8)
    whole = merged(merged(sketch(docs, width), "salt", "block"), "block")
    for row in whole.toLocalIterator(prefetchPartitions=True):
        full = np.zeros(BLOCK, np.uint8)
        full[np.frombuffer(row.places, "<u2")] = np.frombuffer(row.sums, np.uint8) >= LEAST_DOCS
        bits[row.block] = np.packbits(full, bitorder="little")
    return bits.ravel()


def survivors(lang: str, found: list[bytes], bits: np.ndarray, width: int) -> np.ndarray:
    """Which of the terms have reached LEAST_DOCS in all their cells."""
    passed = np.ones(len(found), bool)
    for row, at in enumerate(cells(lang, found, width)):
        at += row * width
        passed &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return passed


def counted(docs: DataFrame, width: int | None = None) -> DataFrame:
    """(lang, source, term, c, lang_c, leads): exact counts of the kept terms in each group and in its language, ``leads`` in one of a
    term's rows; each group has a row without a term besides.

    The tasks' counts are shuffled once, by language and term, with a row for each group at most; sums by group and the
    document frequencies of whole languages both come from there.
    """
    width = width or width_for(docs)
    shared = docs.sparkSession.sparkContext.broadcast(possible(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (times, in_docs) in held.items():
                names = list(times)
                left = [t for t, ok in zip(names, survivors(lang, names, shared.value, width), strict=True) if ok]
                n = len(left) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), pa.array([*left, None], pa.binary()).cast(pa.string()),
                        pa.array([*map(times.__getitem__, left), 0], pa.int64()), pa.array([*map(in_docs.__getitem__, left), 0], pa.int64()),
                    ],
                    names=["lang", "source", "term", "c", "d"],
                )
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                words = terms(text.as_py())
                times, in_docs = held[lang, source]
                size -= len(times)
                times.update(words)
                in_docs.update(set(words))
                size += len(times)
                if size > HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    found = _inputs(docs).mapInArrow(run, "lang string, source string, term string, c long, d long")
    sums = found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    whole = sums.withColumns({"docs": F.sum("d").over(term), "lang_c": F.sum("c").over(term), "leads": F.col("source") == F.min("source").over(term)})
    return whole.where((F.col("docs") >= LEAST_DOCS) | F.col("term").isNull()).select("lang", "source", "term", "c", "lang_c", "leads")


def share(count: str, total: str, kept: str = "v") -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exact; null without kept terms."""
    return F.expr(f"1 + cast({SCALE} * cast({count} + 2 as decimal(20, 0)) div cast(nullif({total} + 2 * {kept}, 0) as decimal(20, 0)) as long)")


def distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)), exact."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div ({p} + {q})")


def audit(docs: DataFrame, width: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of each source from the others of its language (`pair`) and its most unusual terms (`term`)."""
    found = cut(counted(docs, width))
    counts = found.where("term is not null")
    of_lang = counts.groupBy("lang").agg(F.count_if("leads").alias("v"), F.sum("c").alias("lang_total"))
    of_group = counts.groupBy("lang", "source").agg(F.sum("c").alias("total"), F.count("*").alias("own"))
    groups = found.select("lang", "source").distinct().join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = cut(groups.na.fill(0, ["total", "own", "v", "lang_total"]).withColumn("absent", share("0L", "total")))
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "absent", share("c", "total").alias("p"), share("lang_c", "lang_total").alias("q"))
    return _pairs(shares, groups).unionByName(_terms(shares))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    one, two = (groups.select("lang", F.col("source").alias(n), F.col("absent").alias(f"absent_{n}"), F.col("own").alias(f"own_{n}"), "v") for n in ("a", "b"))
    alike = one.join(two.drop("v"), "lang").where("a < b").select("lang", "a", "b", F.coalesce((F.col("v") - F.col("own_a") - F.col("own_b")) * distance("absent_a", "absent_b"), F.lit(0)).alias("value"))
    # A term of one group against the other's share of absent terms: as many sums as the group has different shares.
    grades = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n"))
    against = grades.join(two.select("lang", "b", "absent_b"), "lang").where("source <> b")
    against = against.select("lang", F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b"), (F.col("n") * distance("p", "absent_b")).alias("value"))
    # What both have replaces what was assumed of it above.
    left, right = (shares.select("lang", "term", F.col("source").alias(n), F.col("p").alias(f"p_{n}"), F.col("absent").alias(f"absent_{n}")) for n in ("a", "b"))
    both = left.join(right, ["lang", "term"]).where("a < b")
    both = both.select("lang", "a", "b", (distance("p_a", "p_b") - distance("p_a", "absent_b") - distance("absent_a", "p_b") + distance("absent_a", "absent_b")).alias("value"))
    sums = alike.unionByName(against).unionByName(both).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way")
    return _ranked(sums.select("lang", "value", ways).select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value"))


def _terms(shares: DataFrame) -> DataFrame:
    over = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance("p", "q").alias("value"))
    return _ranked(over).where(F.col("rank") <= TERM_RANKS)


def _ranked(rows: DataFrame) -> DataFrame:
    best_first = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(best_first))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), o AS (
  SELECT id, lang, source, unnest(w) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lc FROM o GROUP BY ALL HAVING count(DISTINCT id) >= {LEAST_DOCS}
), langs AS (
  SELECT lang, count(*) AS v, sum(lc)::HUGEINT AS nl FROM kept GROUP BY lang
), c AS (
  SELECT o.lang, o.source, o.term, count(*) AS c FROM o JOIN kept USING (lang, term) GROUP BY ALL
), g AS (
  SELECT lang, source, coalesce(n, 0)::HUGEINT AS n, coalesce(v, 0) AS v, coalesce(nl, 0) AS nl
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN langs USING (lang)
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, 1 + {SCALE}::HUGEINT * (coalesce(c.c, 0) + 2) // (g.n + 2 * g.v) AS p, 1 + {SCALE}::HUGEINT * (k.lc + 2) // (g.nl + 2 * g.v) AS q
  FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b USING (lang) LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source WHERE a.source <> b.source
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= {TERM_RANKS}
"""
