"""Dense numbers for the rows of a table of any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.scratch import materialize


def numbered(table: DataFrame, name: str, start: int = 0) -> DataFrame:
    """The rows, written once, with a column ``name`` of numbers from ``start`` on without gaps.

    Rows are counted within a task as they are written; the tasks' sizes, one row each, give the rest.
    """
    written = materialize(table.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_row", 33)
    sizes = sorted(tuple(r) for r in written.groupBy(part).agg(F.count(F.lit(1))).collect())
    before = np.cumsum([start] + [n for _, n in sizes])
    offsets = table.sparkSession.createDataFrame([(p, int(b)) for (p, _), b in zip(sizes, before)], "_part long, _before long")
    placed = written.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")).drop("_row", "_part", "_before")
