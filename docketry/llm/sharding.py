"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size: it starts at an
offset and goes on by a skip, both taken from a digest of its name. The shards take turns; at its
turn a shard claims the first slot of its order that is still free. A key's slot is its digest
modulo the size, so placing a row is one lookup in a table of fixed size, which is broadcast. A
shard more or less moves few keys besides its own, and slots per shard differ by one at most."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketry.llm.common import picked

#: The most slots that are broadcast; two integers each.
MOST_SLOTS = 1_000_003


def digest(text: str) -> int:
    """The first 15 hex digits of the MD5, which Spark and any SQL engine can also take."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_slots(shards: list[str], slots: int) -> list[int]:
    """The shard number of every slot."""
    if not shards:
        raise ValueError("no shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names must differ")
    if not len(shards) <= slots <= MOST_SLOTS or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime of {len(shards)} to {MOST_SLOTS}")
    at = [digest(f"{name}/offset") % slots for name in shards]
    skip = [digest(f"{name}/skip") % (slots - 1) + 1 for name in shards]
    owner = [-1] * slots
    left = slots
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            left -= 1
            if not left:
                return owner


def lookup_table(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """(slot, shard, shard_name), one row per slot, made in Spark from the literal list of owners."""
    owner = ",".join(map(str, lookup_slots(shards, slots)))
    names = F.array(*map(F.lit, shards))
    return (
        spark.range(1)
        .select(F.posexplode(F.from_json(F.lit(f"[{owner}]"), "array<int>")).alias("slot", "shard"))
        .withColumn("shard_name", F.element_at(names, F.col("shard") + 1))
    )


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key by its text; a null key counts as the empty text."""
    hexed = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(hexed, 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(rows: DataFrame, key: str, shards: list[str], slots: int = 65_537) -> DataFrame:
    """(key, slot, shard, shard_name) of every row, without a shuffle.

    Equal keys get equal shards, repeated rows stay repeated, an empty table gives no rows, and
    other columns of the rows are not read. A null key goes where the empty text goes."""
    table = lookup_table(rows.sparkSession, shards, slots)
    keyed = picked(rows, key).select(F.col(key), slot_of(F.col(key), slots).alias("slot"))
    return keyed.join(F.broadcast(table), "slot").select(keyed[key], "slot", "shard", "shard_name")
