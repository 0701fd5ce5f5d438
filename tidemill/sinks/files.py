"""File sinks: text, CSV, time buckets, and the compaction of small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.times import bucket_label

BUCKET = "bucket"


def write_lines(df: DataFrame, path: str, column: str = "line", compression: str | None = None) -> None:
    """Overwrite ``path`` with the text lines of a column; the result is a folder of part files."""
    writer = df.select(F.col(column).alias("value")).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def write_csv(
    df: DataFrame, path: str, field_delimiter: str = ",", line_delimiter: str = "\n", header: bool = False
) -> None:
    """Overwrite ``path`` with delimited text."""
    df.write.mode("overwrite").csv(path, sep=field_delimiter, lineSep=line_delimiter, header=header)


def show_rows(df: DataFrame, n: int, prefix: str = "") -> None:
    """Print n rows, each after a prefix; the number is the caller's to choose."""
    for row in df.take(n):
        print(f"{prefix}{row}")


def write_buckets(df: DataFrame, path: str, ts: str, rows_per_file: int = 1_000_000) -> None:
    """Append rows under ``bucket=yyyy-MM-dd--HHmm`` folders by their time.

    The rebalance hint gathers a bucket's rows into few files and splits a heavy bucket over several tasks.
    """
    bucketed = df.withColumn(BUCKET, bucket_label(F.col(ts)))
    spread = bucketed.hint("rebalance", BUCKET)
    spread.write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy(BUCKET).parquet(path)


def stream_buckets(stream: DataFrame, path: str, ts: str, rollover: str, checkpoint: str):
    """The streaming form: one file set per trigger, each row written exactly once. Returns the running query."""
    return (
        stream.withColumn(BUCKET, bucket_label(F.col(ts)))
        .writeStream.partitionBy(BUCKET)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=rollover)
        .start()
    )


def compact_buckets(spark: SparkSession, source: str, target: str, file_bytes: int = 256 * 1024 * 1024) -> None:
    """Rewrite a bucketed table with files of about ``file_bytes``; the source stays as it is until the switch."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, str(file_bytes))
    try:
        spread = spark.read.parquet(source).hint("rebalance", BUCKET)
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    finally:
        spark.conf.set(advisory, before)
