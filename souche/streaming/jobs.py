"""Structured Streaming jobs: resume by key, cache upsert, online scoring, windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from souche.operators.graph import dot
from souche.sources.files import append_cache


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def resume(stream: DataFrame, target: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Append rows whose keys the target does not hold yet; a restart goes on where it stopped."""
    return stream.writeStream.foreachBatch(lambda batch, _: append_cache(batch, target, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(stream: DataFrame, ts: str = "ts", late: str = "1 hour", size: str = "1 day", by: str = "event_type") -> DataFrame:
    """Counts and sums per window and kind, late rows within the watermark included."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, size).alias("w"), F.col(by).alias("kind"))
        .agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "kind", "n", "total")
    )


def scored(stream: DataFrame, corpus: DataFrame, on: str, vector: str, centre: str, least: float) -> DataFrame:
    """Stream of new vectors against a static table of centres: the stream's columns, similarity and decision.

    A row whose key has no centre keeps a null similarity and is refused.
    """
    sim = F.round(dot(F.col(vector), F.col(centre)), 6)
    rows = stream.join(corpus, on, "left").withColumn("sim", F.when(F.col(centre).isNotNull(), sim))
    return rows.withColumn("decision", F.when(F.col("sim") >= least, "FUSION").otherwise("REJET")).drop(centre)


def drain(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what there is now into Parquet, then stop."""
    df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
