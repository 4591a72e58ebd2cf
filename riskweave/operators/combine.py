"""From indicators to dimensions, pillars and risk scores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.scores import combined, rescale
from riskweave.session import cut


@dataclass(frozen=True)
class Aggregate:
    """A score made of others.

    ``parts`` maps component names to weights; ``level`` decides what a missing
    component means: dimensions average the rest, pillars and risks need all.
    """

    name: str
    parts: dict[str, float]
    method: str = "mean"
    level: str = "dimension"
    rescale: bool = True

    def __post_init__(self) -> None:
        if self.level not in ("dimension", "pillar", "risk"):
            raise ValueError(f"unknown level {self.level}")
        if not self.parts:
            raise ValueError(f"{self.name} has no parts")

    @property
    def missing(self) -> str:
        return "omit" if self.level == "dimension" else "propagate"

    def without(self, part: str) -> Aggregate:
        """The same aggregate short of one part."""
        return Aggregate(self.name, {k: w for k, w in self.parts.items() if k != part}, self.method, self.level, self.rescale)


@dataclass(frozen=True)
class Index:
    """Aggregates in the order in which they are computed; later ones may use earlier ones."""

    aggregates: tuple[Aggregate, ...] = field(default_factory=tuple)

    @staticmethod
    def from_dict(spec: dict) -> Index:
        """From nested configuration: {name: {weights, method, level, rescale}}."""
        return Index(tuple(Aggregate(n, s["weights"], s.get("method", "mean"), s.get("level", "dimension"), s.get("rescale", True)) for n, s in spec.items()))

    def with_parts(self, renamed: dict[str, str]) -> Index:
        """The same index, made of other columns."""
        return Index(tuple(Aggregate(a.name, {renamed.get(p, p): w for p, w in a.parts.items()}, a.method, a.level, a.rescale) for a in self.aggregates))

    def needs(self) -> set[str]:
        """The indicators that no aggregate makes."""
        made = {a.name for a in self.aggregates}
        return {p for a in self.aggregates for p in a.parts} - made


def _score(spec: Aggregate):
    return combined(spec.method, [(F.col(p), w) for p, w in spec.parts.items()], spec.missing)


def aggregate(df: DataFrame, spec: Aggregate) -> DataFrame:
    """``df`` with the score of one aggregate, scaled to 0-1 over the panel if asked."""
    return evaluate(df, Index((spec,)))


def evaluate(df: DataFrame, index: Index) -> DataFrame:
    """``df`` with all scores of an index.

    Aggregates whose parts are all there make one level; the bounds of a level
    are one pass over the panel, however many aggregates it has. The panel is
    stored first, so that those passes don't compute it anew.
    """
    pending = list(index.aggregates)
    if sum(a.rescale for a in pending) > 1 or any(a.rescale and any(p in {b.name for b in pending} for p in a.parts) for a in pending):
        df = cut(df)
    while pending:
        made = {a.name for a in pending}
        ready = [a for a in pending if all(p in df.columns and (p not in made or p == a.name) for p in a.parts)]
        if not ready:
            spec = pending[0]
            raise KeyError(f"{spec.name} needs {[p for p in spec.parts if p not in df.columns]}")
        df = df.withColumns({a.name: _score(a) for a in ready})
        if names := [a.name for a in ready if a.rescale]:
            ends = df.agg(*[f(n) for n in names for f in (F.min, F.max)]).first()
            scaled = {}
            for i, name in enumerate(names):
                low, high = ends[2 * i], ends[2 * i + 1]
                scaled[name] = F.lit(None).cast("double") if low is None else rescale(F.col(name), low, high)
            df = df.withColumns(scaled)
        pending = [a for a in pending if a not in ready]
    return df
