"""Sharding by a permutation-filled lookup table (operator 8).

Every shard has its own preference order over the slots of a prime-sized
table. Shards take turns, each claiming the first slot of its order that is
still free, until the table is full: every shard holds nearly the same number
of slots, and adding or removing a shard moves few of them. A key is placed by
looking up its hash modulo the table size, in constant time.

The table has ``table_size`` rows whatever the data, so it is broadcast.

Results by case: keys are compared as text; a null key counts as the empty
text and so has a fixed shard. Repeated rows share a shard. All columns are
kept, in their order, before ``slot`` and ``shard``; a column that has such a
name is replaced. An empty table gives no rows; no shards are an error.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: list[str], table_size: int = TABLE_SIZE) -> list[int]:
    """The shard's index for every slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if table_size < 2 or any(table_size % d == 0 for d in range(2, int(table_size**0.5) + 1)):
        raise ValueError("the table size must be prime, so that every step visits every slot")
    at = [_number(f"{s}#offset") % table_size for s in shards]
    skip = [_number(f"{s}#skip") % (table_size - 1) + 1 for s in shards]
    owner, free = [-1] * table_size, table_size
    while True:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % table_size
            owner[at[i]] = i
            free -= 1
            if not free:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """``(slot, shard)``, one row per slot."""
    owner = F.from_json(F.lit(json.dumps(fill_table(shards, table_size))), "array<int>")
    names = F.from_json(F.lit(json.dumps(shards)), "array<string>")
    return spark.range(1).select(F.posexplode(owner).alias("slot", "owner")).select(
        "slot", F.element_at(names, F.col("owner") + 1).alias("shard"))


def slot_of(key, table_size: int = TABLE_SIZE):
    """The first 60 bits of the key's MD5, modulo the table size."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return (F.conv(digits, 16, 10).cast("long") % F.lit(table_size)).cast("int")


def assign_shards(df: DataFrame, key_col: str, shards: list[str], table_size: int = TABLE_SIZE) -> DataFrame:
    table = F.broadcast(lookup_table(df.sparkSession, shards, table_size))  # table_size rows
    keep = [c for c in df.columns if c not in ("slot", "shard") or c == key_col]
    placed = df.select(*[F.col(f"`{c}`") for c in keep if c not in ("slot", "shard")],
                       slot_of(F.col(f"`{key_col}`"), table_size).alias("slot"))
    return placed.join(table, "slot").select(*[f"`{c}`" for c in placed.columns if c != "slot"], "slot", "shard")


def write_shards(df: DataFrame, path: str, key_col: str, shards: list[str], table_size: int = TABLE_SIZE,
                 tasks_per_shard: int = 1) -> None:
    """One folder per shard. Rows of a shard are spread over ``tasks_per_shard`` files by their slot."""
    placed = assign_shards(df, key_col, shards, table_size)
    (placed.repartition(len(shards) * tasks_per_shard, "shard", F.col("slot") % tasks_per_shard)
     .write.partitionBy("shard").parquet(path))
