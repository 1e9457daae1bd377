"""Batch sink for a keyed index: whole batches or none, rows replaced by key.

Rows are dealt into blocks that only depend on the key (``block_of``), so a block is always written by one
task and has the same name in every run. Tasks stage their blocks; the driver publishes them when all tasks
have ended, and a failed job discards what was staged. A published block keeps the stored rows whose keys
are not in the new data, so part of the keys can be sent again.

The index behind it is a plug-in: option ``client`` names a ``module:factory`` that takes the options and
returns an object with ``stage``, ``publish`` and ``discard``; the default is a folder of Parquet objects.
"""

import importlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import ByteType, IntegerType, LongType, MapType, ShortType

BLOCK = "_block"


def block_of(key: Column, integral: bool, rows: int, bits: int) -> Column:
    """Name of a key's block: ``rows`` consecutive integers, or the first ``bits`` bits of another key's hash."""
    number = F.floor(key / rows) if integral else F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    return F.coalesce(number.cast("string"), F.lit("none"))


class FolderIndex:
    """One Parquet object per block under ``path``; staged ones stand in a folder that readers skip."""

    def __init__(self, options: dict):
        self.key = options["key"]
        self.fs, self.base = fs.FileSystem.from_uri(options["path"])
        self.staging = f"{self.base}/_staging/{options['job']}"

    def _final(self, block: str) -> str:
        return f"{self.base}/block-{block}.parquet"

    def stage(self, block: str, table: pa.Table) -> tuple[str, str]:
        """Writes the block as it will be, and returns (block, staged file); attempts never share a file."""
        if self.fs.get_file_info(self._final(block)).type == fs.FileType.File:
            with self.fs.open_input_file(self._final(block)) as f:
                old = pq.read_table(f).select(table.schema.names).cast(table.schema)
            known = pc.is_in(old.column(self.key), value_set=table.column(self.key).combine_chunks())
            table = pa.concat_tables([old.filter(pc.invert(known)), table])
        self.fs.create_dir(self.staging, recursive=True)
        file = f"{self.staging}/{uuid.uuid4().hex}.parquet"
        pq.write_table(table, file, filesystem=self.fs)
        return block, file

    def publish(self, staged: list[tuple[str, str]]) -> None:
        for block, file in staged:
            if self.fs.get_file_info(self._final(block)).type == fs.FileType.File:
                self.fs.delete_file(self._final(block))
            self.fs.move(file, self._final(block))
        self.discard()

    def discard(self) -> None:
        if self.fs.get_file_info(self.staging).type == fs.FileType.Directory:
            self.fs.delete_dir(self.staging)


def _client(options: dict):
    if "client" not in options:
        return FolderIndex(options)
    module, factory = options["client"].split(":")
    return getattr(importlib.import_module(module), factory)(options)


@dataclass
class Staged(WriterCommitMessage):
    blocks: list


class UpsertWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = dict(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        client, staged, block, held = _client(self.options), [], None, []

        def flush():
            if held:
                staged.append(client.stage(block, pa.Table.from_batches(held)))
                held.clear()

        for batch in iterator:
            if not batch.num_rows:
                continue
            names = batch.column(batch.schema.get_field_index(BLOCK)).to_pylist()
            rows = batch.select([c for c in batch.schema.names if c != BLOCK])
            cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
            for lo, hi in zip(cuts, cuts[1:]):
                if names[lo] != block:
                    flush()
                    block = names[lo]
                held.append(rows.slice(lo, hi - lo))
        flush()
        return Staged(staged)

    def commit(self, messages: list) -> None:
        _client(self.options).publish([b for m in messages if m for b in m.blocks])

    def abort(self, messages: list) -> None:
        _client(self.options).discard()


class UpsertSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_blocks"

    def writer(self, schema, overwrite: bool) -> UpsertWriter:
        return UpsertWriter(self.options)


def bulk_upsert(df: DataFrame, key: str, path: str, rows: int = 200, bits: int = 16, **options: str) -> None:
    """Sends ``df`` to the index at ``path``, replacing stored rows with the same key.

    Of rows with one key that with the smallest hash is taken, so a rerun sends the same. A block holds ``rows``
    keys where they are integers, else about a 2**``bits``-th of the table. Rows without a key count as one key.
    """
    spark = df.sparkSession
    spark.dataSource.register(UpsertSink)
    integral = isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType))
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    one = df.groupBy(F.col(key).alias("k")).agg(F.min_by(F.struct(*df.columns), F.xxhash64(*plain)).alias("r")).select("r.*")
    dealt = one.withColumn(BLOCK, block_of(F.col(key), integral, rows, bits)).repartition(BLOCK).sortWithinPartitions(BLOCK, key)
    dealt.write.format("keyed_blocks").mode("append").options(key=key, path=path, job=uuid.uuid4().hex, **options).save()
