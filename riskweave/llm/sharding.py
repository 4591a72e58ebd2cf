"""Operator 6: stable shard placement by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table
(start and step taken from hashes of its name). The shards take turns, each
claiming its most preferred free slot, until the table is full: all get an even
share, and if a shard leaves, few slots of the others move. A row's key is
hashed to a slot and the slot looked up in the broadcast table, whose size is
that prime and independent of the data, so placement needs no shuffle.

Results by case: rows with equal doc_id share a shard; a null doc_id is placed
by its text, and a null id with null text as the empty text. An input column
named ``shard`` or ``slot`` is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import quoted, text_of

#: Production parameters: a prime over a hundred times the shards keeps shares within one percent.
SHARDS, SLOTS = 32, 4093


def digest(text: str) -> int:
    """The first 32 bits of MD5."""
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot the index of its shard."""
    if slots < 2 or any(slots % i == 0 for i in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} slots: a prime is needed, for every step to reach every slot")
    if not 0 < len(shards) <= slots:
        raise ValueError(f"{len(shards)} shards for {slots} slots")
    at = [digest(f"offset:{s}") % slots for s in shards]
    step = [digest(f"skip:{s}") % (slots - 1) + 1 for s in shards]
    table, filled = [-1] * slots, 0
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            filled += 1
            if filled == slots:
                return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a string key: the first 32 bits of its MD5, modulo the table size."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % slots).cast("int")


def shard(docs: DataFrame, shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` with their ``slot`` and ``shard``."""
    names = shards or [f"shard-{i:05d}" for i in range(SHARDS)]
    filled = F.from_json(F.lit(str(lookup_table(names, slots))), "array<int>")
    table = docs.sparkSession.range(1).select(F.posexplode(filled).alias("slot", "shard"))
    text = text_of() if "text" in docs.columns else F.lit("")
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), text))
    placed = docs.drop("slot", "shard").withColumn("slot", slot_of(key, slots))
    return placed.join(F.broadcast(table), "slot").select(*[quoted(c) for c in placed.columns if c != "slot"], "slot", "shard")


def write_shards(placed: DataFrame, path: str, pieces: int = 8) -> None:
    """Write one folder per shard.

    Each shard is dealt to ``pieces`` tasks by a salt, so that none has to hold
    a whole shard.
    """
    salt = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in placed.columns]), F.lit(pieces))
    placed.repartition(F.col("shard"), salt).write.partitionBy("shard").parquet(path)


ORACLE = f"""
WITH RECURSIVE names AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 5, '0') AS name FROM range({SHARDS}) t(i)
), prefs AS (
  SELECT list(('0x' || md5('offset:' || name)[1:8])::BIGINT % {SLOTS} ORDER BY i) AS start,
         list(('0x' || md5('skip:' || name)[1:8])::BIGINT % {SLOTS - 1} + 1 ORDER BY i) AS step FROM names
), fill AS (
  SELECT 0 AS turn, start AS pos, step, list_transform(range({SLOTS}), lambda x: -1::BIGINT) AS owner, -1::BIGINT AS slot, -1::BIGINT AS shard FROM prefs
  UNION ALL
  SELECT turn + 1, list_concat(pos[1:i], [(slot + step[i + 1]) % {SLOTS}], pos[i + 2:{SHARDS}]), step,
         list_concat(owner[1:slot], [i], owner[slot + 2:{SLOTS}]), slot, i
  FROM (SELECT turn, pos, step, owner, i,
               (pos[i + 1] + step[i + 1] * list_filter(range({SLOTS}), lambda j: owner[((pos[i + 1] + j * step[i + 1]) % {SLOTS} + 1)::BIGINT] = -1)[1]) % {SLOTS} AS slot
        FROM (SELECT *, (turn % {SHARDS})::BIGINT AS i FROM fill WHERE turn < {SLOTS}))
)
SELECT d.doc_id, f.slot::INTEGER AS slot, f.shard::INTEGER AS shard
FROM (SELECT doc_id, ('0x' || md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, '')))[1:8])::BIGINT % {SLOTS} AS slot FROM documents) d
JOIN (SELECT slot, shard FROM fill WHERE slot >= 0) f ON f.slot = d.slot
"""
