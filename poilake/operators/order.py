"""Positions in a total order, and the rotating batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poilake.session import materialize

# monotonically_increasing_id keeps the partition number above this many bits.
_OFFSET_BITS = 33


def global_index(df: DataFrame, order: Sequence[Column | str], name: str = "idx") -> DataFrame:
    """Adds each row's position (from 0) in a total order, without a single-task window.

    Range partitions are sorted in parallel and written once to the shared folder, so the
    partition sizes and the rows come from the same data. ``order`` must have no ties
    between many rows, or those rows meet in one range.
    """
    # No fixed number: adaptive execution joins small neighbouring ranges, in order.
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "index").withColumns(
        {"_part": F.shiftright("_at", _OFFSET_BITS), "_at": F.col("_at").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1))}
    )
    sizes = {row["_part"]: row["count"] for row in placed.groupBy("_part").count().collect()}
    starts = [0]  # one entry per range partition
    for part in range(max(sizes, default=-1)):
        starts.append(starts[-1] + sizes.get(part, 0))
    start = F.get(F.array(*[F.lit(n).cast("long") for n in starts]), F.col("_part").cast("int"))
    return placed.withColumn(name, start + F.col("_at")).drop("_part", "_at")


def daily_batch(
    df: DataFrame, order: Sequence[str], day_of_year: int, batch: int, strict_reference: bool = False
) -> DataFrame:
    """The day's circular slice of ``batch`` rows, starting at day x batch modulo the total.

    ``order`` names the columns of a total order; only they are sorted, and the slice is
    joined back to the rows. When ``batch`` covers everything, all rows are returned;
    ``strict_reference`` then returns the tail from the start position only.
    """
    total = df.count()
    if total == 0 or (batch >= total and not strict_reference):
        return df
    keys = global_index(df.select(*order), order)
    start = day_of_year * batch % total
    if batch >= total:
        wanted = keys.where(F.col("idx") >= start)
    else:
        wanted = keys.where(F.pmod(F.col("idx") - start, F.lit(total)) < batch)
    # Stored, the keys have a size by which Spark chooses between sending and shuffling them.
    wanted = materialize(wanted.select(*order), "batch")
    condition = F.lit(True)
    for c in order:
        condition = condition & df[c].eqNullSafe(wanted[c])
    return df.join(wanted, condition, "left_semi")
