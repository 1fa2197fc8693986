"""Order within long conversations, without one task per conversation.

One conversation may hold a third of all rows. Its rows are numbered and summed
in blocks: each block by itself, and the blocks' totals, of which there are few,
by one window more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def numbered(rows: DataFrame, key: str, turn: str, ties: list[str], out: str = "place", block: int = BLOCK) -> DataFrame:
    """rows with their number from 1 within ``key``, by turn (null first) and then by the columns ``ties``.

    A task orders the rows of one key whose turns lie in one range of ``block``. Rows that are equal in all of
    these columns come in any order. A null key is a key.
    """
    ranged = rows.withColumn("_range", F.coalesce(F.floor(F.col(turn) / block).cast("long"), F.lit(-(1 << 62))))
    sizes = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(key).alias("_key"), F.col("_range").alias("_at"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(key, "_range").orderBy(F.col(turn).asc_nulls_first(), *ties)
    local = ranged.withColumn("_n", F.row_number().over(within))
    joined = local.join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_at")))
    return joined.select(*rows.columns, (F.col("_start") + F.col("_n")).cast("long").alias(out))


def running(
    rows: DataFrame, key: str, place: str, sums: dict[str, Column], longest: int, backward: bool = False, block: int = BLOCK
) -> DataFrame:
    """rows with running sums along dense places 1 to ``longest`` (from the last one down if ``backward``).

    ``sums`` maps new columns to what they sum up. Keys must not be null.
    """
    order = F.col(place).desc() if backward else F.col(place)
    blocked = rows.withColumn("_block", F.floor((F.col(place) - 1) / block).cast("long"))
    within = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if longest <= block:  # no sequence has a second block
        return blocked.select(*rows.columns, *[F.sum(c).over(within).alias(name) for name, c in sums.items()])
    totals = blocked.groupBy(key, "_block").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    side = F.col("_block").desc() if backward else F.col("_block")
    before = Window.partitionBy(key).orderBy(side).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col(key), F.col("_block"), *[F.coalesce(F.sum(f"_{name}").over(before), F.lit(0)).alias(f"_{name}") for name in sums]
    )
    local = blocked.select(
        *rows.columns, "_block", *[F.sum(c).over(within).alias(f"_own_{name}") for name, c in sums.items()]
    )
    return local.join(starts, [key, "_block"]).select(
        *rows.columns, *[(F.col(f"_own_{name}") + F.col(f"_{name}")).alias(name) for name in sums]
    )
