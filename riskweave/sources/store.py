"""Where panels and releases live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.panel import recency

AREAS = ("input", "processing", "output")


def component_id(*parts: str) -> str:
    """Pillar, dimension and indicator as one id; parts must not hold underscores."""
    if not parts or any(not p or "_" in p for p in parts):
        raise ValueError(f"not the parts of an id: {parts}")
    return "_".join(parts)


@dataclass(frozen=True)
class Store:
    """Parquet tables below a root, which may be any file system that Spark reads."""

    spark: SparkSession
    root: str

    def path(self, area: str, name: str, folder: str = "") -> str:
        if area not in AREAS:
            raise ValueError(f"areas are {AREAS}")
        return "/".join(x for x in (self.root.rstrip("/"), area, folder, f"{name}.parquet") if x)

    def save(self, df: DataFrame, area: str, name: str, folder: str = "", by: list[str] | None = None) -> None:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*by) if by else writer).parquet(self.path(area, name, folder))

    def load(self, area: str, name: str, folder: str = "") -> DataFrame:
        return self.spark.read.parquet(self.path(area, name, folder))

    def exists(self, area: str, name: str, folder: str = "") -> bool:
        try:
            self.load(area, name, folder)
        except AnalysisException as missing:
            if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def current(self, name: str, column: str, year: int, quarter: int, folder: str = "") -> bool:
        """True if a saved panel has values up to the given quarter."""
        if not self.exists("output", name, folder):
            return False
        at = F.col("year") * 4 + F.col("quarter")
        last = self.load("output", name, folder).agg(F.max(F.when(F.col(column).isNotNull(), at))).first()[0]
        return last is not None and last >= year * 4 + quarter

    def release(self, scores: DataFrame, year: int, quarter: int) -> str:
        """Save a release and how recent each of its columns is."""
        name = f"{year}_Q{quarter}"
        keys = ("pgid", "year", "quarter")
        self.save(scores, "output", f"scores_{name}", name, by=["year"])
        self.save(recency(scores, [c for c in scores.columns if c not in keys]), "output", f"recency_{name}", name)
        return name

    def restore(self, release: str, overwrite: bool = True) -> list[str]:
        """Split a release into one table for each component: its score and raw columns, without exposure ones."""
        scores = self.load("output", f"scores_{release}", release)
        keys = ["pgid", "year", "quarter"]
        names = [c for c in scores.columns if c not in keys and not c.endswith(("_raw", "_exposure"))]
        for name in names:
            if not overwrite and self.exists("output", name):
                continue
            group = [c for c in (name, f"{name}_raw") if c in scores.columns]
            self.save(scores.select(*keys, *group), "output", name)
        return names
