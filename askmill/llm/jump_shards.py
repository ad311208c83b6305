"""Sharding by jump consistent hashing: no ring table, and growth moves rows only into the new shard.

The key's 64-bit generator is kept as two halves of 32 bits, since a product that wraps is an
error in ANSI mode. The walk stops at the first jump past the last shard, so it takes about
``ln(shards)`` steps; it runs in column expressions. A null key counts as 0.

``slot`` numbers the rows of a shard without gaps. A shard is cut into ``SLICES`` by a hash of its
rows, rows are numbered inside a slice, and the sizes of the slices before are added: no task
holds a whole shard. Equal rows are interchangeable, so a lost task numbers them alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
SLICES = 64

_MASK = (1 << 32) - 1
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & _MASK


def _low_product(a: Column, b: int) -> Column:
    """The lower 32 bits of a product of 32-bit numbers."""
    upper = (a * (b >> 16)).bitwiseAND(0xFFFF)
    return (a * (b & 0xFFFF) + upper * 65536).bitwiseAND(_MASK)


def _stepped(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1, modulo 2 ** 64, as halves."""
    upper = low * (_LOW >> 16)
    below = low * (_LOW & 0xFFFF) + upper.bitwiseAND(0xFFFF) * 65536 + 1
    above = F.shiftright(upper, 16) + F.shiftright(below, 32)
    above = above + _low_product(high, _LOW) + _low_product(low, _HIGH)
    return above.bitwiseAND(_MASK), below.bitwiseAND(_MASK)


def jump_pair(key: Column, shards: int) -> Column:
    """A struct of the key's shard among ``shards`` and its shard among one more."""
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"),
        key.bitwiseAND(_MASK).alias("low"),
        zero.alias("jump"),
        zero.alias("shard"),
        zero.alias("grown"),
    )

    def step(state: Column, _) -> Column:
        high, low = _stepped(state["high"], state["low"])
        share = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
        jump = F.floor((state["jump"] + 1).cast("double") * share).cast("long")
        moved = F.struct(
            high.alias("high"),
            low.alias("low"),
            jump.alias("jump"),
            F.when(state["jump"] < shards, state["jump"]).otherwise(state["shard"]).alias("shard"),
            state["jump"].alias("grown"),
        )
        return F.when(state["jump"] > shards, state).otherwise(moved)

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(shards)),
        start,
        step,
        lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown_shard")),
    )


def shard(rows: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """Add ``shard`` (0 to ``shards - 1``) and ``grown_shard`` (with one shard more); columns of these names go."""
    if shards < 1:
        raise ValueError("at least one shard")
    rows = rows.drop("shard", "grown_shard")
    return rows.withColumn("_jump", jump_pair(rows[key], shards)).select(*rows.columns, "_jump.*")


def number_slots(rows: DataFrame, order: list[str], slices: int = SLICES) -> DataFrame:
    """Add ``slot``: 0, 1, 2 ... in every ``shard``, over slices by a hash of the ``order`` columns."""
    cut = rows.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    sizes = cut.groupBy("shard", "_slice").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(
        "shard", "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("shard", "_slice").orderBy(*order)
    return (
        cut.withColumn("_place", F.row_number().over(inside) - 1)
        .join(bases, ["shard", "_slice"])
        .select(*rows.columns, (F.col("_base") + F.col("_place")).cast("long").alias("slot"))
    )
