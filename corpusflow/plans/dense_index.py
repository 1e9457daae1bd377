"""Dense 0-based row index and distributed prefix sums, without a single-partition window.

Plan (two passes):
  1. range-partition on the order key and sort inside partitions;
  2. checkpoint to the session's checkpoint folder: partition contents are now fixed,
     so a lost executor recomputes nothing inconsistent;
  3. one tiny aggregate per partition (row count, or sum of a length column);
  4. cumulative offsets over that table (one row per partition) broadcast back;
  5. index = partition offset + position inside the partition (running sums inside a partition
     come from an ordered Arrow pass over each partition: no extra shuffle).

Optional ``within``: the index restarts for each value of those columns (index
counted inside each split).  A hot value just spans many range partitions, so a
split holding a third of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id: partition id in the upper 31 bits, row position in the lower 33


def sorted_checkpoint(df: DataFrame, keys: list, partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    ck = ranged.checkpoint(eager=True)
    mono = F.monotonically_increasing_id()
    return ck.select("*", F.shiftright(mono, _POS_BITS).alias("_part"),
                     mono.bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"))


def _local_offsets(ck: DataFrame, within: list[str], weighted: bool) -> DataFrame:
    """Exclusive running count / weight sum of each row inside its partition (and split), in partition order.

    Per-partition sequential logic over data that is already in order: an Arrow ``mapInArrow``
    pass, which keeps the partitioning (no shuffle) and leaves the other columns untouched
    (only the weight and split columns are read; running totals carry across batches).
    """
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType(ck.schema.fields + [StructField("_local", LongType(), False)])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        carry, total = None, 0  # rows come sorted by split: only the last split's total goes on
        for rb in batches:
            n = rb.num_rows
            w = (np.nan_to_num(rb.column("_w").to_numpy(zero_copy_only=False).astype("float64")).astype("int64")
                 if weighted else np.ones(n, dtype="int64"))
            if not n:
                continue
            # first rows of the runs of equal splits
            new = np.zeros(n, dtype=bool)
            for c in within:
                code = rb.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            first = [rb.column(c)[0].as_py() for c in within]
            if first != carry:
                total = 0
            starts = np.flatnonzero(np.concatenate(([True], new[1:])))
            before = np.cumsum(w) - w
            local = before - np.repeat(before[starts], np.diff(np.append(starts, n)))
            local[:starts[1] if len(starts) > 1 else n] += total
            carry = [rb.column(c)[n - 1].as_py() for c in within]
            total = int(local[-1] + w[-1])
            yield pa.RecordBatch.from_arrays(list(rb.columns) + [pa.array(local, type=pa.int64())],
                                             names=list(rb.schema.names) + ["_local"])

    return ck.mapInArrow(run, schema)


def with_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx",
               within: Sequence[str] = (), weight: Column | str | None = None,
               partitions: int | None = None) -> DataFrame:
    """Add ``name``: dense 0-based rank by ``order`` (which must be unique within ``within``).

    With ``weight`` the column is instead the exclusive prefix sum of ``weight`` in that order
    (e.g. token offsets for packing), and ``name + '_end'`` is the inclusive sum.
    """
    within = list(within)
    keys = [F.col(c) for c in within] + [F.col(c) if isinstance(c, str) else c for c in order]
    base = df if weight is None else df.withColumn("_w", F.col(weight) if isinstance(weight, str) else weight)
    ck = sorted_checkpoint(base, keys, partitions)
    wcol = F.lit(1).cast("bigint") if weight is None else F.col("_w").cast("bigint")
    # per partition and split: count / weight sum; tiny (partitions x splits rows)
    grp = ["_part", *within]
    counts = ck.groupBy(*grp).agg(F.sum(wcol).alias("_cnt"))
    wo = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*grp, F.coalesce(F.sum("_cnt").over(wo), F.lit(0)).cast("bigint").alias("_poff"))
    if weight is None and not within:
        local = ck.withColumn("_local", F.col("_pos").cast("bigint"))
    else:
        local = _local_offsets(ck, within, weight is not None)
    # one offset row per partition: bounded by the partition count, so broadcast; with splits it is
    # (partitions + splits) rows, which grows with the number of splits: the join strategy is left to AQE
    out = local.join(F.broadcast(offsets) if not within else offsets, grp)
    out = out.withColumn(name, F.col("_poff") + F.col("_local"))
    if weight is not None:
        out = out.withColumn(f"{name}_end", F.col(name) + F.col("_w").cast("bigint")).drop("_w")
    return out.drop("_part", "_pos", "_local", "_poff")


def total_rows(df: DataFrame, name: str = "_total") -> DataFrame:
    """One-row frame with the row count, to cross-join as a scalar (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(name))
