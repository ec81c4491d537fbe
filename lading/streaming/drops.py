"""Drops that keep arriving: the file sources and sinks as Structured Streaming.

A remote folder that receives a new drop every day is read incrementally: each
micro-batch picks up only files not seen before (the stream checkpoint records
them), with the same file-type dispatch and options as the batch reader.
``latestFirst`` processes the newest files first; ``copyLatest`` (only the newest
drop) has no meaning for a stream and raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import session
from ..sources import formats


def stream_files(spark: SparkSession, uri: str, file_type: str, schema, **options) -> DataFrame:
    """Streaming DataFrame over the files arriving under ``uri`` (schema required)."""
    ft = formats.file_type(file_type)
    opts = formats.normalise(options)
    if formats.flag(opts, "copyLatest"):
        raise ValueError("copyLatest reads one drop and is for batch reads; a stream takes latestFirst")
    reader_opts = formats.read_options(ft, opts)
    reader = spark.readStream.options(**reader_opts).schema(schema)
    # the avro file format class resolves whether or not the short name is registered
    fmt = formats.AVRO_CLASS if ft == "avro" else formats.spark_format(ft)
    return reader.format(fmt).load(uri)


def deliver_stream(stream: DataFrame, path: str, file_type: str, checkpoint: str | None = None,
                   available_now: bool = True, partition_by=None, **options) -> StreamingQuery:
    """Write a stream as files of ``file_type`` under ``path``; exactly-once via the checkpoint."""
    spark = stream.sparkSession
    ft = formats.file_type(file_type)
    where = checkpoint or session.new_staging_dir(spark, "stream-checkpoint")
    if ft == "xml":
        return _deliver_batches(stream, path, ft, where, available_now, partition_by, options)
    writer = (stream.writeStream.options(**formats.write_options(ft, formats.normalise(options)))
              .option("checkpointLocation", where).option("path", path))
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if available_now:
        writer = writer.trigger(availableNow=True)
    fmt = formats.AVRO_CLASS if ft == "avro" else formats.spark_format(ft)
    return writer.format(fmt).start()


def _deliver_batches(stream, path, ft, checkpoint, available_now, partition_by, options):
    """File types without a streaming sink (xml): each micro-batch is a batch write.

    A batch lands in ``<path>/batch=<id>`` with overwrite, so a batch replayed
    after a failure replaces its own output: still exactly once per batch id.
    """
    from ..operators.sink import write_files

    def deliver(batch, batch_id):
        write_files(batch, f"{path}/batch={batch_id}", ft, mode="overwrite",
                    partition_by=partition_by, **options)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(deliver)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
