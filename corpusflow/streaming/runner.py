"""Running streams to completion: file sources, idempotent per-batch sinks, read-back of the latest state.

Sources: a fixture table copied into time-ordered parquet files under the shared scratch folder (their
number follows the table's size), read as a file stream of several batches (so state crosses them); where there
are many files, a batch takes several, so that it keeps all cores busy and the batches do not become many.
Sinks: ``foreachBatch`` writes each micro-batch to ``<path>/batch=<id>`` with overwrite, so a
retried batch replaces its own output (exactly-once at the sink).  Update-mode aggregates are
read back as the latest row per key.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusflow.sources.readers import scratch_path
from corpusflow.sources.tables import table

FILE_BYTES = 32 << 20
LEAST_FILES = 4  # so that state crosses batches on small tables, too
LEAST_BATCHES = 8  # a batch takes more than one file only when that leaves as many


def _order_mtimes(spark: SparkSession, folder: str) -> None:
    """Give the data files below ``folder`` increasing modification times in name order (Hadoop FS API)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, found = [], fs.listFiles(path, True)
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(".parquet"):
            files.append(name)
    base = int(__import__("time").time() * 1000) - 10_000 * (len(files) + 1)
    for i, f in enumerate(sorted(files)):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(f), base + 10_000 * i, -1)


def file_count(spark: SparkSession, path: str) -> int:
    """Files for a copy of the data at ``path``: one per ``FILE_BYTES``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return max(LEAST_FILES, -(-size // FILE_BYTES))


def files_a_batch(spark: SparkSession, files: int) -> int:
    """Files of a micro-batch: up to one per core, but one only as long as there are few."""
    return max(1, min(spark.sparkContext.defaultParallelism, files // LEAST_BATCHES))


def stream_of(df: DataFrame, name: str, order: str, files: int, flush_rows: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as ``files`` parquet files in ``order`` and open them as a stream, see :func:`files_a_batch`.

    The file source replays files by modification time, so the copies get increasing times in
    file-name (= range) order.  ``flush_rows`` (rows far in the future) come last, in two files, so
    the watermark passes every real window and the final windows are emitted.
    """
    spark = df.sparkSession
    src = scratch_path(spark, f"stream-src-{name}")
    parts = df.repartitionByRange(files, order).sortWithinPartitions(order)
    if flush_rows is not None:
        tail = flush_rows.select(*df.columns)
        parts = parts.unionByName(tail.withColumn("_k", F.lit(0))
                                  .unionByName(tail.withColumn("_k", F.lit(1))).repartitionByRange(2, "_k").drop("_k"))
    parts.write.mode("overwrite").parquet(src)
    _order_mtimes(spark, src)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_a_batch(spark, files)).parquet(src)


def file_stream(spark: SparkSession, sf_dir: str, name: str, order: str, files: int | None = None, zoned: bool = True,
                flush_rows: DataFrame | None = None) -> DataFrame:
    """A fixture table as a stream, see :func:`stream_of`."""
    files = files or file_count(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    return stream_of(table(spark, sf_dir, name, zoned), name, order, files, flush_rows)


def epoch_stream(df: DataFrame, name: str, epoch: str) -> DataFrame:
    """A stream of one micro-batch per value of ``epoch``, in its order."""
    spark = df.sparkSession
    src = scratch_path(spark, f"stream-src-{name}")
    df.repartition(epoch).write.mode("overwrite").partitionBy(epoch).parquet(src)
    _order_mtimes(spark, src)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


#: fixed value: Spark's store for keyed state with lists and timers
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_sink(sdf: DataFrame, mode: str = "append", timeout_s: int | None = None,
                per_batch: Callable[[DataFrame, int], DataFrame] | None = None, stateful: bool = False,
                out: str | None = None, ckpt: str | None = None) -> tuple[str, object]:
    """Run with ``availableNow``; every batch (optionally transformed by ``per_batch``) is written under its batch id.

    ``stateful`` streams keep their state in RocksDB.  With the ``out`` and ``ckpt`` of an earlier run the stream goes
    on where that ended.  Returns (sink path, last progress).  Raises if the query failed or, with ``timeout_s``, did not finish in time.
    """
    spark = sdf.sparkSession
    out = out or scratch_path(spark, "stream-out")
    ckpt = ckpt or scratch_path(spark, "stream-ckpt")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)

    def sink(batch: DataFrame, batch_id: int) -> None:
        b = per_batch(batch, batch_id) if per_batch else batch
        b.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    before = spark.conf.get(STATE_STORE)
    if stateful:
        spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        q = (sdf.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(STATE_STORE, before)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out, q.lastProgress


def read_sink(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows written by a stream; an empty frame of ``schema`` when it had no batch.  A missing sink is an error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        raise FileNotFoundError(path)
    if len(fs.listStatus(folder)) == 0:
        return spark.createDataFrame([], schema + ", _batch bigint")
    return spark.read.parquet(path).drop("batch")


def latest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-mode read-back: the row of the last batch for each key."""
    w = Window.partitionBy(*keys).orderBy(F.col("_batch").desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "_batch")
