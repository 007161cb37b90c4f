"""Documents that arrive as a stream: chunked and enriched as they come, late copies dropped, packs appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from packloom.operators import chunk, enrich


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files at ``path``, a folder or one file."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if status.isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())


def chunked(stream: DataFrame, size: int = 512, overlap: int = 50, arrived: str = "ingested_at", late: str = "7 days") -> DataFrame:
    """Enriched chunks of a stream of documents; copies of a ``doc_id`` within the ``late`` time are dropped.

    Chunking keeps no state; only the keys of the watermark's span are remembered.
    """
    once = stream.withWatermark(arrived, late).dropDuplicatesWithinWatermark(["doc_id"])
    return enrich.enrich(chunk.chunk(once, size, overlap), now=F.lit(None).cast("timestamp"))


def counts(stream: DataFrame, arrived: str = "ingested_at", every: str = "1 day", late: str = "7 days") -> DataFrame:
    """How many documents and characters arrived in each window of time, once it can't change any more."""
    return stream.withWatermark(arrived, late).groupBy(F.window(arrived, every), "source").agg(F.count("*").alias("documents"), F.sum(F.length("text")).alias("characters"))


def append(stream: DataFrame, path: str, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Write chunks as they come. A batch that is run again replaces its own folder, so nothing is written twice."""

    def each(batch: DataFrame, number: int) -> None:
        (sink or (lambda df, n: df.write.mode("overwrite").parquet(f"{path}/batch={n}")))(batch, number)

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def counted_until_empty(spark: SparkSession, path: str, place: str) -> DataFrame:
    """``counts`` of the documents at ``path``, read as a stream until none is left, of the windows that are closed then.

    A row without an arrival time or a source has no window of its own and isn't counted.
    """
    rows = parquet(spark, path).where("ingested_at is not null and source is not null")
    query = counts(rows).writeStream.format("parquet").option("checkpointLocation", f"{place}/state").option("path", f"{place}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.read.schema("window struct<start: timestamp, end: timestamp>, source string, documents long, characters long").parquet(f"{place}/out")
    return out.select(F.col("window.start").alias("day"), "source", "documents", "characters")
