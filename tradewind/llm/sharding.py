"""Sharding by jump consistent hashing, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import gapless, table

# Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757


def jump_shards(key: Column, shards: int, grown: int) -> tuple[Column, Column]:
    """Shard of a 64-bit key among ``shards`` and among ``grown`` (at least as many).

    The jumps of a key do not depend on the number of shards; the shard is the last
    jump below that number. One walk over the jumps therefore answers both. The state
    is an exact decimal, as 64-bit products wrap around.
    """
    if not 0 < shards <= grown:
        raise ValueError("0 < shards <= grown is needed")
    whole = F.lit(str(1 << 64)).cast("decimal(20,0)")
    state = key.cast("decimal(20,0)")
    state = F.when(state < 0, (state + whole).cast("decimal(20,0)")).otherwise(state)
    start = F.struct(
        state.alias("state"), F.lit(0).cast("long").alias("next"),
        F.lit(0).cast("long").alias("small"), F.lit(0).cast("long").alias("large"),
    )

    def step(acc: Column, _: Column) -> Column:
        product = acc["state"] * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        state = (product % whole).cast("decimal(20,0)")
        high = F.floor(state / F.lit(1 << 33).cast("decimal(10,0)")).cast("double")
        jump = F.floor((acc["next"] + 1).cast("double") * (F.lit(float(1 << 31)) / (high + 1.0))).cast("long")
        moved = F.struct(
            state.alias("state"),
            jump.alias("next"),
            F.when(acc["next"] < shards, acc["next"]).otherwise(acc["small"]).alias("small"),
            acc["next"].alias("large"),
        )
        return F.when(acc["next"] < grown, moved).otherwise(acc)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(grown)), start, step)
    return end["small"].cast("int"), end["large"].cast("int")


def shard_by_key(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its shard, its slot there, and its shard after one more is added.

    The id's 64-bit hash is the key, so the id and the number of shards alone decide. Slots
    number a shard's documents from 0 in an order fixed by id, size and checksum. A null id is
    a key like any other; a null text has size 8 and the checksum of no bytes, as has an
    empty one; repeated rows get slots of their own; further columns are not read; an
    empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    shard, grown = jump_shards(F.xxhash64("doc_id"), shards, shards + 1)
    placed = rows.withColumns({"shard": shard, "grown_shard": grown})
    numbered = gapless(placed, "shard", docs.count() // shards, "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op5_jump_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_key(table(spark, folder, "documents"))
