"""Incremental indexing with Structured Streaming (A12 as a stream).

New corpus files arriving in a folder are mapped to records and written as
one load of the two keyed tables in ``foreachBatch``. A micro-batch replayed
after a failure replaces its own load, so the stream is effectively
exactly-once. Mappings that keep the first row of an id are read with
``first=True``. The streaming checkpoint must live on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusforge.plans.mappings import CorpusMapping
from corpusforge.sources import sink


def index_batch(mapping: CorpusMapping, meta_path: str, data_path: str, bucket: str | None = None,
                collisions_path: str | None = None, **sides):
    """A ``foreachBatch`` function that writes one micro-batch of documents as a load."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        # Loads of a stream start at 1; the load 0 is that of an empty table.
        sink.write_index(mapping.records(batch, bucket, **sides), meta_path, data_path, mapping.num_meta_shards,
                         mapping.num_data_shards, epoch_id + 1, collisions_path=collisions_path)
    return run


def start_incremental_index(spark: SparkSession, source_dir: str, schema: StructType, mapping: CorpusMapping,
                            meta_path: str, data_path: str, checkpoint: str, fmt: str = "parquet",
                            bucket: str | None = None, available_now: bool = True,
                            **sides) -> StreamingQuery:
    """Stream corpus files from ``source_dir`` into the index tables."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    writer = (stream.writeStream.foreachBatch(index_batch(mapping, meta_path, data_path, bucket, **sides))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
