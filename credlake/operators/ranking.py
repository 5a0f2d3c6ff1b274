"""Rows numbered in a total order without a single-task window.

``row_number()`` over an unpartitioned window moves the whole table into one
task.  Here the rows are range-partitioned and sorted within partitions, a
row's place in its partition is counted as it is read, and the sizes of the
partitions before it are added.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlake.session import cut_lineage

PLACE_BITS = 33  # ``monotonically_increasing_id`` holds the partition above these


def with_rank(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with ``out``, 1 for the first row of ``order``.

    ``order`` should end in a unique key: rows that it ties are numbered in any
    order, and all land in one partition, since a range cannot split them.
    The numbered rows are stored in the shared folder before the sizes are
    counted, since another run of the range partitioning may draw other
    bounds.  The sizes are one number per partition.
    """
    mark, part = f"{out}_place", f"{out}_part"
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(sorted_rows.withColumn(mark, F.monotonically_increasing_id()).withColumn(part, F.shiftright(mark, PLACE_BITS)))
    sizes = dict(placed.groupBy(part).agg(F.count(F.lit(1))).collect())
    if not sizes:
        return placed.select(*df.columns, F.lit(0).cast("long").alias(out))
    last = max(sizes)
    before = list(accumulate((sizes.get(p, 0) for p in range(last)), initial=0))
    offset = F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col(part).cast("int"))
    place = F.col(mark).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.select(*df.columns, (offset + place + 1).alias(out))
