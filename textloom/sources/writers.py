"""Writers: feature tables, distributions and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def features(rows: DataFrame, path: str, by: str | None = None, format: str = "parquet", mode: str = "overwrite") -> None:
    """A table of features, in one folder for each value of `by`; rows of a value are gathered, so
    a value makes few files."""
    writer = (rows.repartition(by) if by else rows).write.mode(mode)
    (writer.partitionBy(by) if by else writer).format(format).save(path)


def works(rows: DataFrame, path: str) -> None:
    """Raw text, plain text and header fields of works in one table."""
    rows.write.mode("overwrite").parquet(path)


def distribution(rows: DataFrame, path: str) -> None:
    """A small result as one JSON file."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def report(text: str, path: str, rows: DataFrame) -> None:
    """A text without spaces at its end and with one line feed, as one file in a folder."""
    spark = rows.sparkSession
    spark.createDataFrame([(text.rstrip(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
