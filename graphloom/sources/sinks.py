"""Sinks: byte-compatible text exports, XML subsets, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def write_relation(df: DataFrame, path: str, quote: tuple[str, ...] = (), compression: str = "none") -> None:
    """One tuple a line, fields joined by commas; the columns in ``quote`` in quotes, unescaped."""
    fields = [quoted(F.col(c)) if c in quote else F.col(c).cast("string") for c in df.columns]
    df.select(F.concat_ws(",", *fields).alias("value")).write.option("compression", compression).text(path)


def write_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    df.select("value").write.option("compression", compression).text(path)


def write_xml(pages: DataFrame, path: str) -> None:
    """Pages as a dump again."""
    pages.drop("position").write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)


def write_split(df: DataFrame, path: str) -> None:
    """One folder a part (column ``part``)."""
    df.write.partitionBy("part").parquet(path)
