"""Session builder and the two helpers every operator shares: table access and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "riskweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    UTC keeps timestamps comparable across machines; AQE sizes shuffles at run
    time, so no partition count is fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the tables below ``root``; Spark's own reader, so any store works."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``.

    Only on one machine (a local master) a temporary folder stands in where that is unset.
    """
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if given is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="riskweave-"))
    return given or context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` through the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: The most rows that ``few`` broadcasts.
FEW = 100_000


def are_few(stored: DataFrame) -> bool:
    return stored.limit(FEW + 1).count() <= FEW


def few(df: DataFrame) -> DataFrame:
    """``df`` stored, for the right side of a join: broadcast if its rows are counted and few, else never.

    Spark's own estimate of a table's size leaves out what ``explode`` adds, so it may broadcast millions of rows.
    """
    stored = cut(df)
    return F.broadcast(stored) if are_few(stored) else stored.hint("merge")


#: The most bytes that are broadcast.
BROADCAST_LIMIT = 64 << 20


def broadcast_below(df: DataFrame, size_bytes: int, limit_bytes: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if its measured size is below the limit.

    Past the limit the plan is left to Spark, which then shuffles both sides.
    """
    return F.broadcast(df) if size_bytes <= limit_bytes else df
