"""Running values over all rows in order, without bringing the rows into one task.

Rows are cut into blocks of equally long ranges of the order column. Inside a block an ordinary window runs; blocks are
reduced to one row each, whose running value is found in the same way one level up and carried back into the block. A block
spans 2^BITS of the order, or of the blocks below it, so no window ever holds more than 2^BITS rows and none lacks a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BITS = 12


def largest_before(df: DataFrame, order: str, value: str, name: str, order_bits: int = 62, bits: int = BITS) -> DataFrame:
    """Adds `name`: the largest `value` of all rows with a smaller `order`; null for the first.

    `order` is a whole number from 0 to below 2^`order_bits`, without repeats; `value` is anything that has an order, a struct too.
    """
    block, top, carried = (f"_{part}_{order_bits}" for part in ("block", "top", "carried"))
    rows = df.withColumn(block, F.shiftright(F.col(order).cast("bigint"), bits))
    inside = Window.partitionBy(block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn(name, F.max(value).over(inside))
    if order_bits > bits:
        heads = rows.groupBy(block).agg(F.max(value).alias(top))
        above = largest_before(heads, block, top, carried, order_bits - bits, bits).select(block, carried)
        found = found.join(above, block, "left").withColumn(name, F.greatest(name, carried)).drop(carried)
    return found.drop(block)
