"""Configuration of an index, and runs that compute only what a change concerns.

A configuration names data sets (where they have landed, and their version),
settings of indicators, and aggregates with weights and means. Together they are a graph: data
sets feed tables, tables feed indicators, indicators feed aggregates. Every node
has a digest of its own settings and of the digests it depends on; what has been
saved with another digest, or none, is stale, and so is all that depends on it.
``run`` computes stale indicators and aggregates, in order, and enters each with
its digest once it has been saved, so a run that was cut off goes on where it stopped.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import calendar
from riskweave.operators import impute, scale
from riskweave.operators.combine import Index, evaluate
from riskweave.plans.indicators import CELL, DIMENSIONS, EXPOSED, INDICATORS, KEYS, PILLARS, RISKS, START, TIME, validated
from riskweave.session import cut
from riskweave.sources.datasets import DATASETS, RECIPE_TABLES
from riskweave.sources.store import Store

#: Where digests of what has been saved are kept.
MANIFEST = "digests"


@dataclass(frozen=True)
class Config:
    """``data``: settings of data sets, ``tables``: versions of tables that come from elsewhere, ``indicators``: those to run, with
    settings, ``aggregates``: as ``Index.from_dict`` reads them, ``exposure``: the version of the exposure layer, None without one."""

    start: int = START
    data: Mapping[str, Mapping] = field(default_factory=dict)
    tables: Mapping[str, str] = field(default_factory=dict)
    indicators: Mapping[str, Mapping] = field(default_factory=lambda: {n: {} for n in INDICATORS})
    aggregates: Mapping[str, Mapping] = field(default_factory=lambda: {**DIMENSIONS, **PILLARS, **RISKS})
    exposure: str | None = None
    regenerate: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        unknown = {"data set": set(self.data) - set(DATASETS), "indicator": set(self.indicators) - set(INDICATORS)}
        parts = {p for spec in self.aggregates.values() for p in spec["weights"]}
        unknown["part"] = parts - set(self.aggregates) - set(INDICATORS)
        unknown["node to regenerate"] = set(self.regenerate) - set(self.graph())
        for what, names in unknown.items():
            if names:
                raise KeyError(f"unknown {what}: {sorted(names)}")

    @staticmethod
    def from_dict(spec: Mapping) -> Config:
        """From nested settings; keys that mean nothing are an error. ``aggregates`` may change some of the standard ones only."""
        allowed = set(Config.__dataclass_fields__)
        if extra := set(spec) - allowed:
            raise KeyError(f"unknown settings: {sorted(extra)}")
        given = dict(spec)
        if "aggregates" in given:
            standard = {**DIMENSIONS, **PILLARS, **RISKS}
            given["aggregates"] = {**standard, **{n: {**standard.get(n, {}), **s} for n, s in given["aggregates"].items()}}
        given["regenerate"] = frozenset(given.get("regenerate", ()))
        return Config(**given)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Config:
        """From a JSON file, read by Spark, so it may lie in any store."""
        return Config.from_dict(json.loads(spark.read.text(path, wholetext=True).first()[0]))

    def graph(self) -> dict[str, tuple[str, ...]]:
        """The nodes that each node depends on; names of data sets and tables are prefixed."""
        nodes: dict[str, tuple[str, ...]] = {f"data:{k}": () for k in self.data}
        used = {t for n in self.indicators for t in INDICATORS[n].inputs}
        for t in used:
            sources = RECIPE_TABLES.get(t, ((), None))[0]
            landed = sources and t not in self.tables and set(sources) <= set(self.data)
            nodes[f"table:{t}"] = tuple(f"data:{s}" for s in sources) if landed else ()
        nodes.update({n: tuple(f"table:{t}" for t in INDICATORS[n].inputs) for n in self.indicators})
        if self.exposure is not None:
            nodes["exposure"] = ()
        for name, spec in self.aggregates.items():
            parts = tuple(p for p in spec["weights"] if p in self.aggregates or p in self.indicators)
            nodes[name] = (*parts, "exposure") if name in EXPOSED and self.exposure is not None else parts
        return nodes

    def order(self) -> list[str]:
        return list(TopologicalSorter(self.graph()).static_order())

    def digests(self) -> dict[str, str]:
        """A digest for each node: of its settings, the first year, and the digests of what it depends on."""
        graph, found = self.graph(), {}
        own = {f"data:{k}": v for k, v in self.data.items()} | {f"table:{k}": v for k, v in self.tables.items()} | dict(self.indicators) | dict(self.aggregates) | {"exposure": self.exposure}
        for node in self.order():
            text = json.dumps([node, own.get(node), self.start, {d: found[d] for d in sorted(graph[node])}], sort_keys=True, default=str)
            found[node] = hashlib.sha256(text.encode()).hexdigest()
        return found

    def stale(self, saved: Mapping[str, str]) -> list[str]:
        """The indicators and aggregates to compute, in order: those saved with another digest, asked for, or dependent on such."""
        graph, digests, old = self.graph(), self.digests(), set()
        for node in self.order():
            mine = (node in self.indicators or node in self.aggregates) and saved.get(node) != digests[node]
            if mine or node in self.regenerate or any(d in old for d in graph[node]):
                old.add(node)
        return [n for n in self.order() if n in old and (n in self.indicators or n in self.aggregates)]


def saved_digests(store: Store) -> dict[str, str]:
    """The last digest of each node; one small row for each that has ever been saved."""
    if not store.exists("processing", MANIFEST):
        return {}
    rows = store.load("processing", MANIFEST).groupBy("node").agg(F.max_by("digest", "number").alias("digest")).collect()
    return {r.node: r.digest for r in rows}


def _enter(store: Store, nodes: Iterable[str], digests: Mapping[str, str]) -> None:
    number = store.load("processing", MANIFEST).agg(F.max("number")).first()[0] + 1 if store.exists("processing", MANIFEST) else 0
    rows = store.spark.createDataFrame([(n, digests[n], number) for n in nodes], "node string, digest string, number long").coalesce(1)
    rows.write.mode("append").parquet(store.path("processing", MANIFEST))


def run(store: Store, config: Config, tables: Callable[[str], DataFrame], at: tuple[int, int], exposure: DataFrame | None = None) -> list[str]:
    """Bring all indicators and aggregates up to date; returns the names of those that were computed.

    ``tables`` gives a recipe's table by name and is asked only for what stale indicators read. Aggregates are computed
    together, from saved panels of the parts that are not stale.
    """
    digests = config.digests()
    todo = config.stale(saved_digests(store))
    for name in (n for n in todo if n in config.indicators):
        inputs = {t: tables(t) for t in INDICATORS[name].inputs}
        store.save(validated(INDICATORS[name].run(inputs, config.indicators[name].get("start", config.start)), name), "output", name)
        _enter(store, [name], digests)
    made = [n for n in config.aggregates if n in todo]
    if not made:
        return todo
    index = Index.from_dict({n: config.aggregates[n] for n in made})
    panel = tables("panel").where((F.col("year") >= config.start) & (calendar.ordinal(F.col("year"), F.col("quarter")) <= at[0] * 4 + at[1] - 1))
    df, needed = panel.select(*KEYS), sorted(index.needs())
    for part in needed:
        known = part in config.indicators or part in config.aggregates
        df = df.join(store.load("output", part).select(*KEYS, part), KEYS, "left") if known else df.withColumn(part, F.lit(None).cast("double"))
    df = impute.forward_fill(df, CELL, TIME, [p for p in needed if p in INDICATORS])
    weighed = {p: f"{p}_exposure" for n in made if n in EXPOSED for p in config.aggregates[n]["weights"]} if config.exposure is not None else {}
    if weighed:
        df = scale.exposed_all(cut(df.join(exposure.select(*KEYS, "exposure"), KEYS, "left")), weighed, "exposure")
    out = cut(evaluate(df, index.with_parts(weighed)))
    for n in made:
        store.save(out.select(*KEYS, n), "output", n)
    _enter(store, made, digests)
    return todo
