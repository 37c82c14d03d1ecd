"""Sharding through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size; the shards
take turns, each claiming its most preferred free slot, until the table is full. A key's hash
picks a slot, the slot names the shard. Shards differ by one slot at most (or in proportion to
their weights), and adding or removing a shard moves few keys besides its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bundlelake.llm.common import own_name, quoted

#: Slots of the table; prime, and over a hundred times the number of shards.
SLOTS = 65_537
SHARDS = 64


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], slots: int = SLOTS, weights: Mapping[str, int] | None = None) -> list[int]:
    """The number of the shard that owns each slot.

    A shard of weight w takes w turns a round; weights are positive and 1 by default.
    """
    if not _is_prime(slots):
        raise ValueError("the number of slots must be prime")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be distinct names, one at least and no more than slots")
    plans = []
    for name in shards:
        seed = hashlib.sha256(name.encode()).digest()
        offset = int.from_bytes(seed[:8], "big") % slots
        skip = int.from_bytes(seed[8:16], "big") % (slots - 1) + 1
        plans.append((offset, skip))
    turns = [(weights or {}).get(name, 1) for name in shards]
    if min(turns) < 1:
        raise ValueError("weights must be positive")
    owner, reached, free = [-1] * slots, [0] * len(shards), slots
    while free:
        for k, (offset, skip) in enumerate(plans):
            for _ in range(turns[k]):
                if not free:
                    break
                while owner[slot := (offset + reached[k] * skip) % slots] >= 0:
                    reached[k] += 1
                owner[slot] = k
                free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: its MD5 digest's first 60 bits; a null key counts as the empty string."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % slots


def place(
    documents: DataFrame,
    shards: Sequence[str] | None = None,
    key: str = "doc_id",
    slots: int = SLOTS,
    weights: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add ``slot`` and ``shard`` to every document.

    The table is sent to all tasks: its size is the parameter ``slots``, whatever the input, and
    placing a row takes one lookup, without a shuffle. Rows with equal keys go to one shard, rows
    without a key to that of the empty string. Columns named ``slot`` or ``shard`` are replaced.
    """
    names = list(shards) if shards is not None else [f"shard-{k:05d}" for k in range(SHARDS)]
    spark: SparkSession = documents.sparkSession
    rows = [(slot, names[k]) for slot, k in enumerate(lookup_table(names, slots, weights))]
    table = F.broadcast(spark.createDataFrame(rows, "slot long, shard string"))
    documents = documents.drop("slot", "shard")
    return documents.withColumn("slot", slot_of(quoted(key), slots)).join(table, "slot").select(
        *[quoted(c) for c in documents.columns], "slot", "shard"
    )


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Write placed documents as one folder per shard, each in a few files.

    Shards are dealt out by shard and a part of the slot, so no task holds a whole shard.
    """
    part = own_name(placed, "_part")
    (
        placed.withColumn(part, F.col("slot") % files_per_shard)
        .repartition("shard", part)
        .drop(part)
        .write.partitionBy("shard")
        .mode("overwrite")
        .parquet(path)
    )
