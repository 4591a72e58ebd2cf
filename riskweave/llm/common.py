"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def quoted(name: str) -> str:
    """A column's name as a reference to it, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def text_of(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` does just that on text made of single-byte characters only.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def split_words(text: Column, gaps: str) -> Column:
    """What lies between matches of ``gaps``.

    ``split`` and ``array_remove`` stay in generated code; extracting all
    matches instead copies the whole text for each of them.
    """
    return F.array_remove(F.split(text, gaps), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    Inside a lambda an expression over columns is evaluated for each element,
    also one that the optimizer has merged in from an earlier projection or
    pushed down with a filter; a bound variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(text: str = "text", id_col: str = "doc_id") -> Column:
    """A key that equal (id, text) rows share; null ids have keys too."""
    whole = text_of(text)
    return F.struct(
        F.col(id_col).alias("id"), F.xxhash64(whole).alias("h"), F.octet_length(whole).alias("n")
    )


#: How many edges a task of ``connected_components`` takes.
EDGES_A_TASK = 1 << 16


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected edges (a, b): one row (node, root) per node, root the least.

    Alternating large-star and small-star rounds: each hooks a node's neighbours
    onto the least one it knows, so the edge count never grows and the rounds
    are logarithmic in the longest chain. The least neighbour is a plain
    ``min`` aggregate, which combines before the shuffle, and it is joined back
    by a join that AQE can split, so a hub with very many edges is no
    bottleneck. Each round is cut through the checkpoint folder.

    The edges are counted once and every stage has a task for each
    ``EDGES_A_TASK`` of them at most, since what a round costs the driver and
    the disk follows its tasks; those of one task need no shuffle.
    """
    links = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    tasks = -(-links.count() // EDGES_A_TASK) or 1
    links = links.coalesce(tasks)
    for _ in range(max_rounds):
        both = links.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # Each v > u is one edge, so this makes no more rows than there are edges.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        each = large.join(least, "u").select(F.explode(hooked).alias("e")).select("e.*").where("u <> v").coalesce(tasks)
        links = cut(each.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().coalesce(tasks)).coalesce(tasks)
        # A star forest: every node has one greater or smaller neighbour at most, and no root has an edge to a smaller node.
        ends = links.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("down")))).alias("e"))
        ends = ends.groupBy("e.node").agg(F.sum("e.down").alias("down"), F.count("*").alias("n")).coalesce(tasks)
        if ends.where("down > 1 or down = 1 and n > 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
