"""Incremental ingest: files not seen before, once, with a checkpoint; and what is pending by a done table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pending(work: DataFrame, done: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Work that is not done; all of it if forced.  A null key is never done."""
    return work if force else work.join(done.select(key).distinct(), key, "left_anti")


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str) -> None:
    """Append the files that came since the last call to a Parquet table; what was read is kept in the checkpoint folder, which the cluster must share."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.withColumn("ingested_from", F.col("_metadata.file_name")).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def with_retry(call, fallback: str = "<!-- TRANSLATION FAILED -->", limited=lambda e: "rate" in str(e).lower(), wait=lambda: None):  # noqa: ANN001, ANN201
    """A text function that tries once more after a rate limit and otherwise gives (marker with the text, status)."""

    def run(text: str) -> tuple[str, str]:
        for attempt in (1, 2):
            try:
                return call(text), "ok" if attempt == 1 else "retried"
            except Exception as error:  # noqa: BLE001
                if attempt == 1 and limited(error):
                    wait()
                    continue
                return f"{fallback}\n{text}", "failed"
        return text, "failed"

    return run
