"""Continuous bulk indexing with Structured Streaming.

A stream of JSON documents (any streaming source: files, Kafka, ...) is indexed one micro-batch at a time. Each
micro-batch goes through the same job as a batch bulk write (conform, quarantine, last-duplicate-wins upsert, publish),
so the collection only ever moves from one complete version to the next.

A micro-batch that is run again after a failure writes the same rows: given ids replace, and generated ids are salted
with the batch's number. Its report row may then stand in the report table twice, with the same ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import Collection


def index_stream(stream: DataFrame, store, collection: Collection, checkpoint: str, raw_col: str = "doc",
                 id_expr: Column | None = None, report_table: str | None = None, trigger: dict | None = None):
    """Start a streaming query that bulk-indexes every micro-batch into ``collection``; returns the query."""
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        if not store.exists(collection.logical_name):
            store.create(collection)
        res = store.bulk_index(collection, batch, raw_col=raw_col, id_expr=id_expr, batch=f"stream-{batch_id}")
        if report_table:
            spark.createDataFrame([(int(batch_id), res.total, res.succeeded, res.failed)],
                                  "batch_id long, total long, succeeded long, failed long") \
                .write.mode("append").saveAsTable(report_table)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()


def json_file_stream(spark, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """A stream of JSON-lines files, one document per line (column ``doc``)."""
    return (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(path)
            .select(F.col("value").alias("doc")))
