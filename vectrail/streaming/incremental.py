"""Embedding of rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vectrail.operators.embedding import Embedder, digest_prefix, embed, embed_with_reuse, embedded_texts


def embed_new_rows(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    text_column: str,
    embedder: Embedder,
    key: str,
    vector_column: str = "embedding",
    reuse: bool = False,
    files: str = "*.parquet",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Embed the parquet files added to ``source`` since the last run, then stop.

    ``source`` is a folder, or a pattern of files and folders.  ``files`` is what file names must match.

    The checkpoint remembers what was read, so every row is embedded once.
    Without ``reuse`` the file sink commits each batch exactly once.  With it
    equal texts share one model call, within a batch and with the batches and runs before,
    and a batch that is run again replaces its own folders.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(source)
    if not reuse:
        return (
            embed(rows, text_column, embedder, vector_column)
            .writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    digests = "text_digest string, vector array<float>, batch_id bigint, prefix string"

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # The folder of this batch may be there from a run that was cut short.
        path = f"{target}/_known"
        known = session.createDataFrame([], digests)
        if batch_id > 0:
            known = session.read.schema(digests).parquet(path).filter(F.col("batch_id") < batch_id)
        done = embed_with_reuse(batch, text_column, embedder, key, vector_column, known=known)
        out = f"{target}/batch_id={batch_id}"
        done.write.mode("overwrite").parquet(out)
        stored = session.read.schema(done.schema).parquet(out)
        fresh = embedded_texts(stored, text_column, vector_column, known)
        # By prefix of the digest, so that later batches read only the folders of their own texts.
        fresh = fresh.withColumn("prefix", digest_prefix(F.col("text_digest"))).repartition("prefix")
        fresh.write.mode("overwrite").partitionBy("prefix").parquet(f"{path}/batch_id={batch_id}")

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def embedded_rows(spark: SparkSession, target: str) -> DataFrame:
    """Everything embedded so far."""
    return spark.read.parquet(target)
