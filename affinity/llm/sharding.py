"""Placement of rows on shards by a permutation-filled lookup table.

The shards take turns; each claims the first slot still free in its own
permutation of a prime-sized table. A row is hashed to a slot, so placing it is
one look-up, loads differ by a slot at most (by a turn with weights), and
adding or losing a shard moves few rows between the others.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Slots for each shard, and the largest table that is ever broadcast.
SLOTS_PER_SHARD = 100
MOST_SLOTS = 2_000_003


def next_prime(n: int) -> int:
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: dict[str, int], size: int) -> list[int]:
    """The shard number that holds each slot. ``shards``: turns by name; a shard of weight 2 claims twice as often.

    The size must be prime, so that every step walks through all slots.
    """
    names = list(shards)
    if not names or size < sum(shards.values()) or size > MOST_SLOTS or next_prime(size) != size:
        raise ValueError("needs at least one shard and a prime number of slots, as many as turns at least")
    start = [_number(f"start:{n}") % size for n in names]
    step = [_number(f"step:{n}") % (size - 1) + 1 if size > 2 else 1 for n in names]
    holder, left = [-1] * size, size
    while left:
        for k, name in enumerate(names):
            for _ in range(shards[name]):
                if not left:
                    break
                while holder[start[k]] >= 0:
                    start[k] = (start[k] + step[k]) % size
                holder[start[k]] = k
                left -= 1
    return holder


def slot_of(keys: list[str], size: int) -> Column:
    """The slot of a row: 60 bits of the keys' md5, modulo the table size. Null has a value of its own."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("\x1f", *parts)), 1, 15), 16, 10).cast("bigint"), F.lit(size))


def table_frame(spark: SparkSession, shards: dict[str, int], size: int) -> DataFrame:
    """(slot, shard): as many rows as slots, which MOST_SLOTS bounds."""
    held = ",".join(map(str, lookup_table(shards, size)))
    names = F.array(*[F.lit(n) for n in shards])
    slots = spark.range(1).select(F.posexplode(F.split(F.lit(held), ",")).alias("slot", "holder"))
    return slots.select(F.col("slot").cast("bigint").alias("slot"), F.element_at(names, F.col("holder").cast("int") + 1).alias("shard"))


def assign(df: DataFrame, keys: list[str], shards: dict[str, int], size: int | None = None, names: tuple[str, str] = ("slot", "shard")) -> DataFrame:
    """``df`` with the slot and shard of each row.

    Rows with equal keys go to one shard. Where a key may hold much of the
    table, give a second key that tells its rows apart, which splits it over
    all shards. Rows with null keys are placed like any other; repeated rows
    stay repeated; an empty table gives an empty one. Columns of ``df`` that
    bear one of the two new names are replaced.
    """
    size = size or next_prime(SLOTS_PER_SHARD * sum(shards.values()))
    slot, shard = names
    placed = df.drop(slot, shard).withColumn(slot, slot_of(keys, size))
    lookup = table_frame(df.sparkSession, shards, size).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    # Bounded by MOST_SLOTS rows of a number and a short name.
    return placed.join(F.broadcast(lookup), slot)


def write_shards(placed: DataFrame, path: str, tasks_per_shard: int, shard: str = "shard") -> None:
    """One folder for each shard; the rows of a shard are dealt over several tasks, so that none writes a whole one."""
    dealt = placed.withColumn("_deal", F.pmod(F.monotonically_increasing_id(), F.lit(tasks_per_shard)))
    dealt.repartition(F.col(shard), F.col("_deal")).drop("_deal").write.partitionBy(shard).parquet(path)
