"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: a start and a step, both from
hashes of the shard's number. The shards take turns; each claims the first free slot in its order, until the table is
full. Slots per shard differ by one at most, and when a shard is added or removed few slots change hands. A document's
slot is a digest of its doc_id modulo the table size; the table is broadcast (its size is fixed by the parameters), so
placement is one lookup without a shuffle, and a hot source spreads like any other.

Cases: a null doc_id has the slot of the empty string; repeated rows go to the same shard; an empty table gives no rows;
other columns, also ones called slot or shard_id, are kept by `place`, which fails if its output names are taken.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aduana.functions.frames import quoted

#: Production parameters: 32 shards, a prime table with about 128 slots for each.
N_SHARDS = 32
TABLE_SIZE = 4099


def _number(text: str) -> int:
    """The leading 60 bits of the MD5 digest: the same number in Python, Spark and other SQL engines."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(n_shards: int, size: int) -> list[int]:
    """Shard of each slot."""
    if n_shards < 1 or size < max(2, n_shards) or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the table needs a prime size of at least the number of shards, not {size} for {n_shards}")
    starts = [_number(f"start:{s}") % size for s in range(n_shards)]
    steps = [_number(f"step:{s}") % (size - 1) + 1 for s in range(n_shards)]
    table, claimed, turn = [-1] * size, 0, 0
    at = list(starts)
    while claimed < size:
        shard = turn % n_shards
        while table[at[shard]] >= 0:
            at[shard] = (at[shard] + steps[shard]) % size
        table[at[shard]] = shard
        claimed, turn = claimed + 1, turn + 1
    return table


def slot_of(doc_id: Column, size: int) -> Column:
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(size)).cast("int")


def place(spark: SparkSession, docs: DataFrame, n_shards: int = N_SHARDS, size: int = TABLE_SIZE,
          slot: str = "slot", shard: str = "shard_id") -> DataFrame:
    """`docs` with the slot and the shard of each row."""
    if taken := {slot, shard} & set(docs.columns):
        raise ValueError(f"columns already there: {sorted(taken)}")
    table = spark.createDataFrame(list(enumerate(lookup_table(n_shards, size))), f"{quoted(slot)} int, {quoted(shard)} int")
    placed = docs.withColumn(slot, slot_of(F.col("doc_id"), size)).join(F.broadcast(table), slot, "left")
    return placed.select(*[F.col(quoted(c)) for c in docs.columns], F.col(quoted(slot)), F.col(quoted(shard)))
