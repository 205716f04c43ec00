"""Dense, deterministic ids without a single-task window.

``row_number()`` over an un-partitioned window moves every row into one
task.  Here the rows are range-partitioned on the order columns (sampled
bounds, so partitions are balanced), the partition is materialised by a
reliable checkpoint (both passes below then read identical partitions),
each row gets its index inside its partition from
``monotonically_increasing_id`` (partition id in the upper bits, row index
in the lower 33), and a per-partition offset — one row per partition,
joined as a broadcast frame — turns it into a global rank.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import materialize

_ROW_BITS = 33


def assign_dense_ids(
    df: DataFrame, order_cols: list[str], start: int, id_col: str = "id", partitions: int | None = None
) -> DataFrame:
    """``df`` plus ``id_col`` = ``start + 1, start + 2, …`` in ``order_cols`` order."""
    spark = df.sparkSession
    n = partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))
    parted = materialize(
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("__p", F.spark_partition_id())
        .withColumn("__m", F.monotonically_increasing_id())
    )
    counts = sorted((r["__p"], r["count"]) for r in parted.groupBy("__p").count().collect())  # one row per partition
    before = accumulate((c for _, c in counts), initial=start)
    rows = [(p, b) for (p, _), b in zip(counts, before, strict=False)]
    offsets = spark.createDataFrame(rows, "__p int, __before bigint")
    local = F.col("__m") - F.shiftleft(F.col("__p").cast("bigint"), _ROW_BITS)
    out = parted.join(F.broadcast(offsets), "__p")
    return out.withColumn(id_col, F.col("__before") + local + F.lit(1)).drop("__p", "__m", "__before")
