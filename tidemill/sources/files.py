"""File scans: text lines, typed CSV, sequence files, inline rows and number ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str, recursive: bool = False, charset: str = "UTF-8") -> DataFrame:
    """One row ``line`` per text line; .gz and .bz2 files are unpacked by extension.

    ``charset`` may be any encoding whose line feed is the single byte 0x0A.
    """
    raw = spark.read.option("recursiveFileLookup", recursive).text(path)
    line = F.col("value")
    if charset.upper() != "UTF-8":
        line = F.decode(line.cast("binary"), charset)
    return raw.select(line.alias("line"))


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files of a folder as a stream of ``line`` rows."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).withColumnRenamed("value", "line")


def stream_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket the user names, for demos; it cannot replay after a failure."""
    reader = spark.readStream.format("socket").option("host", host).option("port", port)
    return reader.load().withColumnRenamed("value", "line")


def read_typed_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    field_delimiter: str = ",",
    line_delimiter: str = "\n",
    quote: str | None = None,
    skip_first_line: bool = False,
    comment: str | None = None,
    lenient: bool = False,
    columns: Sequence[str | int] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """CSV with an explicit schema. A bad record fails the job, or is dropped when ``lenient``.

    ``columns`` picks fields by name or position; only those are parsed.
    """
    reader = (
        spark.read.schema(schema)
        .option("sep", field_delimiter)
        .option("lineSep", line_delimiter)
        .option("quote", quote or "")
        .option("header", skip_first_line)
        .option("enforceSchema", True)
        .option("mode", "DROPMALFORMED" if lenient else "FAILFAST")
        .option("recursiveFileLookup", recursive)
    )
    if comment:
        reader = reader.option("comment", comment)
    df = reader.csv(path)
    if columns is None:
        return df
    return df.select(*[df.columns[c] if isinstance(c, int) else c for c in columns])


def inline_rows(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Rows written in the program; a bare value is a one-column row."""
    return spark.createDataFrame([r if isinstance(r, (tuple, list, dict)) else (r,) for r in rows], schema)


def number_range(spark: SparkSession, first: int, last: int, partitions: int | None = None) -> DataFrame:
    """The whole numbers from ``first`` to ``last``, both included, generated in parallel."""
    return spark.range(first, last + 1, 1, partitions)


def read_sequence_file(spark: SparkSession, path: str, schema: str = "key int, value string") -> DataFrame:
    """Binary key/value files. Spark has no DataFrame reader for them, so rows pass through the RDD reader once,
    in Python; the schema is taken at its word instead of checked row by row."""
    return spark.createDataFrame(spark.sparkContext.sequenceFile(path), schema, verifySchema=False)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a batch or streaming DataFrame known to SQL."""
    df.createOrReplaceTempView(name)
    return df
