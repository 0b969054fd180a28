"""Scene arrivals as a stream: the month table kept up to date as pixel files come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.statistics import weighted_mean


def pixel_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def monthly_stream(stream: DataFrame, time: str = "acquired", late: str = "90 days") -> DataFrame:
    """Weighted means, a row for each month and zone; the watermark is on the month, so months older than it are final
    and leave the state."""
    rows = stream.withColumn("month", F.date_trunc("month", time)).withWatermark("month", late)
    return rows.groupBy("month", "zone_id").agg(weighted_mean(F.col("ndvi"), F.col("n")).alias("ndvi"), weighted_mean(F.col("lst_c"), F.col("n")).alias("lst_c"), F.sum("n").alias("n"))
