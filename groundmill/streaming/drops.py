"""Reports that arrive as files: streams that chunk each batch, or take it to verified pairs, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from groundmill.config import Config
from groundmill.operators.chunks import chunk_documents
from groundmill.operators.completion import Client
from groundmill.operators.html import parse_html
from groundmill.plans.dataset import run_live, with_meta

PAGE = "page_id long, url string, html string"


def chunk_stream(spark: SparkSession, source: str, out: str, checkpoint: str, cfg: Config, files_per_batch: int = 100) -> StreamingQuery:
    """Chunk Parquet drops of pages (page_id, url, html) into ``out``, one folder per batch.

    A batch that is repeated after a failure overwrites its own folder, so each page ends up there once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        texts = parse_html(batch).select(F.col("page_id").alias("doc_id"), "text")
        chunk_documents(texts, cfg).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    pages = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pairs_stream(spark: SparkSession, source: str, out: str, checkpoint: str, cache_path: str, make_client: Callable[[], Client], cfg: Config, files_per_batch: int = 100) -> StreamingQuery:
    """Verified pairs from Parquet drops of pages, one folder of decisions per batch.

    Completions go through the cache table by an anti-join, so that a batch that is repeated after a failure, or a
    page that drops again, calls only what was never answered.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        texts = parse_html(batch).select(F.col("page_id").alias("doc_id"), "text").dropDuplicates(["doc_id"])
        run = run_live(with_meta(chunk_documents(texts, cfg), {}), make_client, cache_path, cfg, f"{out}/judged/batch={batch_id}")
        run.decided.write.mode("overwrite").parquet(f"{out}/decided/batch={batch_id}")

    pages = spark.readStream.schema(PAGE).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_rates(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums by window and type over a stream or table with ``ts``; later rows than ``late`` are dropped by a stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, begin, end, n, total, n_errors) of runs of a user's events, in a table or stream with ``ts``, of which each is no more than ``gap`` behind the one before.

    A session ends ``gap`` after its last event. A stream gives a session when the watermark has passed its end, and
    leaves out events that come later than ``late``; a table has all. Values are summed as cents.
    """
    cents = F.col("value").cast("decimal(18,2)")
    runs = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w"))
    counted = runs.agg(F.count("*").alias("n"), F.sum(cents).alias("total"), F.count_if(F.col("event_type") == "error").alias("n_errors"))
    return counted.select("user_id", F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "n", "total", "n_errors")


def session_stream(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, gap: str = "30 minutes", late: str = "10 minutes", files_per_batch: int = 100) -> StreamingQuery:
    """Sessions of events that drop as Parquet into ``source``, each once, into ``out``, until what is there now is read; open ones stay in the checkpoint."""
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(source)
    return sessions(events, gap, late).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
