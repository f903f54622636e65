"""Process the files that arrived since the last run, then stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.scalars import convert_timestamps
from granary.schemas import TIMESTAMP_COLUMNS
from granary.session import configure


def stream_schema(schema: T.StructType, nanoseconds: bool) -> T.StructType:
    """The schema a stream declares up front.

    Files written with nanosecond timestamps declare those columns as whole
    numbers; a declared timestamp would not read them.
    """
    def kind(f: T.StructField) -> T.DataType:
        timed = f.name in TIMESTAMP_COLUMNS and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        return T.LongType() if nanoseconds and timed else f.dataType

    return T.StructType([T.StructField(f.name, kind(f), True) for f in schema.fields])


def new_rows(
    spark: SparkSession, path: str, schema: T.StructType, nanoseconds: bool = False
) -> DataFrame:
    """An unbounded frame over the date folders of one bronze table."""
    configure(spark)
    stream = spark.readStream.schema(stream_schema(schema, nanoseconds)).parquet(path)
    return convert_timestamps(stream, TIMESTAMP_COLUMNS)


def process_new_files(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], bookmark: str
) -> int:
    """Hand every new file's rows to ``handle`` in batches; returns the batches run.

    ``bookmark`` is the checkpoint folder that remembers the files. A batch
    that failed is handed over again with the same id, so ``handle`` should
    replace rather than append: a keyed upsert, or a folder named by the id.
    """
    handled = 0

    def counted(batch: DataFrame, batch_id: int) -> None:
        nonlocal handled
        handle(batch, batch_id)
        handled += 1

    run = (
        stream.writeStream.foreachBatch(counted)
        .option("checkpointLocation", bookmark)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return handled


def append_batches(target: str) -> Callable[[DataFrame, int], None]:
    """Store each batch under its own id, so that a repeated batch replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(target)
        )

    return handle
