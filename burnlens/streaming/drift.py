"""Monthly residual drift over a stream (extension; the reference is batch).

New scored-flight files land in a folder; a Structured Streaming query keeps
the mean residual per 30-day event-time window, with a watermark so late
rows within the allowed delay still update their window and state for
closed windows is dropped. Output goes to a Parquet sink in append mode;
the streaming checkpoint lives under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import checkpoint_dir


def drift_stream(spark: SparkSession, source_dir: str, schema, ts: str = "DepartureScheduled",
                 residual: str = "Residual_kg", window: str = "30 days", delay: str = "7 days") -> DataFrame:
    """Streaming DataFrame: (window, flights, mean residual, mean |residual|)."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    return (
        src.withColumn("_ts", F.col(ts).cast("timestamp"))
        .withWatermark("_ts", delay)
        .groupBy(F.window("_ts", window).alias("Window"))
        .agg(
            F.count(F.lit(1)).alias("Flights"),
            F.avg(residual).alias("MeanResidual"),
            F.avg(F.abs(residual)).alias("MeanAbsResidual"),
        )
        .select(F.col("Window.start").alias("WindowStart"), F.col("Window.end").alias("WindowEnd"),
                "Flights", "MeanResidual", "MeanAbsResidual")
    )


def start_drift_sink(stream: DataFrame, out_dir: str, name: str = "drift", available_now: bool = False) -> StreamingQuery:
    """Append finished windows to Parquet; ``available_now`` processes what is
    there and stops (batch-style runs and tests)."""
    ckpt = f"{checkpoint_dir(stream.sparkSession)}/burnlens/stream-{name}"
    w = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", ckpt).option(
        "path", out_dir
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
